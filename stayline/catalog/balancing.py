"""Queries over synthetic resampling, checked against brute-force neighbours."""

from __future__ import annotations

from stayline import schema as S
from stayline.catalog.registry import query, rounded
from stayline.operators import resample
from stayline.operators.clean import encode_label
from stayline.operators.features import standardize
from stayline.sources.fixtures import subscribers

FEATURES = ["tenure_z", "MonthlyCharges_z"]

_BASE = """m as (select avg(tenure) ta, stddev_pop(tenure) ts, avg(MonthlyCharges) ca, stddev_pop(MonthlyCharges) cs from subscribers),
p as (select customerID k, case when Churn = 'Yes' then 1 else 0 end y, round((tenure - ta) / ts, 6) a, round((MonthlyCharges - ca) / cs, 6) b
  from subscribers, m),
cls as (select y, count(*) n from p group by 1), need as (select (select max(n) from cls) - n as need, y, n from cls
  where n < (select max(n) from cls)),
q as (select p.*, need, n from p join need using (y)),
near as (select q.k, q.a, q.b, o.a oa, o.b ob, row_number() over (partition by q.k order by
  ((q.a - o.a) * (q.a - o.a) + (q.b - o.b) * (q.b - o.b)), o.k) i from q join q o on q.k <> o.k and q.y = o.y)"""

_MADE = """d as (select k || '#' || c as id, k, c, need_y from (select k, y need_y, unnest(range(1, copies + 1)) c from g)),
u as (select *, cast(('0x' || substr(md5(concat(id, ':42n')), 1, 8)) as bigint) / 4294967296.0 un,
  cast(('0x' || substr(md5(concat(id, ':42g')), 1, 8)) as bigint) / 4294967296.0 ug from d)
select k as "customerID", y as label, a as tenure_z, b as "MonthlyCharges_z", false as synthetic from p
union all select id, need_y, round(near.a + ug * (oa - near.a), 6), round(near.b + ug * (ob - near.b), 6), true
from u join near on near.k = u.k and near.i = floor(un * 5) + 1"""


def scaled(spark, sf):
    df = standardize(encode_label(subscribers(spark, sf)), ["tenure", "MonthlyCharges"])
    return rounded(df.select(S.KEY, "label", *FEATURES))


@query("smote", f""", {_BASE},
g as (select k, y, cast(need // n + case when row_number() over (order by md5(concat(k, ':42')), k) <= need % n then 1 else 0 end as bigint) copies from q),
{_MADE}""", ("subscribers",))
def smote(spark, sf):
    return rounded(resample.smote(scaled(spark, sf), S.KEY, "label", FEATURES))


@query("adasyn", f""", {_BASE},
aroundq as (select q.k, q.y, q.need, o.y oy, row_number() over (partition by q.k order by
  ((q.a - o.a) * (q.a - o.a) + (q.b - o.b) * (q.b - o.b)), o.k) i from q join p o on q.k <> o.k),
f as (select k, y, need, count(*) filter (oy <> y) foreigners from aroundq where i <= 5 group by all),
g as (select k, y, cast(round_even(foreigners * need::double / (select sum(foreigners) from f), 0) as bigint) copies from f),
{_MADE}""", ("subscribers",))
def adasyn(spark, sf):
    return rounded(resample.adasyn(scaled(spark, sf), S.KEY, "label", FEATURES))
