"""Mergeable column summaries against exact counts."""

import pytest
from pyspark.sql import functions as F

from stayline.operators import sketches


def test_distinct_sketches_unite_over_days(spark):
    rows = spark.range(60_000).select((F.col("id") % 7).alias("day"), (F.col("id") % 20_000).alias("many"),
                                      F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("few"), F.lit(None).cast("string").alias("a.b"))
    daily = sketches.distinct_sketches(rows, ["many", "few", "a.b"], ["day"])
    assert daily.count() == 21
    got = {r["column"]: r for r in sketches.distinct_estimates(daily).collect()}
    assert got["few"]["n_unique"] == 5 and got["few"]["non_null"] == 40_000 and got["few"]["rows"] == 60_000
    assert got["a.b"]["n_unique"] == 0 and got["a.b"]["non_null"] == 0
    assert abs(got["many"]["n_unique"] - 20_000) < 4 * sketches.distinct_error() * 20_000
    one = {r["column"]: r["n_unique"] for r in sketches.distinct_estimates(daily, ["day"]).where("day = 3").collect()}
    assert one["few"] == 5


def test_distinct_sketches_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "day date, v string")
    assert sketches.distinct_sketches(empty, ["v"], ["day"]).count() == 0
    assert [tuple(r) for r in sketches.distinct_estimates(sketches.distinct_sketches(empty, ["v"])).collect()] == [("v", 0, 0, 0)]


@pytest.mark.parametrize("share", [0.3, 0.02, 0.001])
def test_heavy_values_are_exact(spark, share):
    """A third of the rows is one value, the others thin out over 200,000 rows, most values are met once."""
    n = F.col("id")
    value = F.when(n % 3 == 0, "hot").when(n % 50 == 1, F.concat(F.lit("w"), n % 37)).when(n % 10 == 4, F.lit(None)).otherwise(n.cast("string"))
    rows = spark.range(200_000).select(value.alias("v"), (n % 10).alias("digit"), F.lit(None).cast("int").alias("none"))
    got = {(r["column"], r["value"]): (r["n"], r["total"]) for r in sketches.heavy_values(rows, rows.columns, share).collect()}
    want = {}
    for c in rows.columns:
        counts = {r[0]: r[1] for r in rows.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string")).count().collect()}
        total = sum(counts.values())
        want.update({(c, v): (k, total) for v, k in counts.items() if k >= share * total})
    assert got == want and got


def test_heavy_values_of_empty_tables_and_wrong_shares(spark):
    assert sketches.heavy_values(spark.createDataFrame([], "v string"), ["v"], 0.1).count() == 0
    with pytest.raises(ValueError):
        sketches.heavy_values(spark.createDataFrame([], "v string"), ["v"], 0.0)
