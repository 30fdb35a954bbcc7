"""Order-dependent results without a global sort in one task.

A running total or a rank is split into (total of everything in earlier buckets) + (running total inside the
bucket). Buckets come from value quantiles or from a uniform hash, so no bucket holds more than about 1/B of the
rows, however the rows are spread over groups. Only the B bucket totals per group ever meet in one window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayline.functions.scalars import order_key
from stayline.plans.durable import cut_lineage
from stayline.plans.small import fetch, join_groups, settle, settled

BUCKETS = 1024
HASH_DIGITS = 4  # 65536 hash buckets
CELL_ROWS = 20_000_000  # a wanted quantile bucket with more rows is cut further before it is sorted
ROUNDS = 4


def range_bounds(df: DataFrame, columns: Sequence[str], buckets: int = BUCKETS) -> list[list[float]]:
    """Bucket edges per numeric column from one sketch pass; at most ``buckets`` numbers each come back."""
    grid = [i / buckets for i in range(1, buckets)]
    found = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).approxQuantile(
        list(columns), grid, 0.5 / buckets)
    inner = [sorted({b for b in bounds if abs(b) != float("inf")}) or [0.0] for bounds in found]
    return [[-float("inf"), *bounds, float("inf")] for bounds in inner]


def with_buckets(df: DataFrame, columns: Sequence[str], bounds: Sequence[Sequence[float]], suffix: str) -> DataFrame:
    """Add the bucket number of each column; binary search on the JVM."""
    stage = Bucketizer(splitsArray=[list(b) for b in bounds], inputCols=list(columns),
                       outputCols=[f"{c}{suffix}" for c in columns], handleInvalid="keep")
    return stage.transform(df)


def running_totals(df: DataFrame, order: str, sums: Sequence[str], bounds: Sequence[float], by: Sequence[str] = (),
                   descending: bool = False) -> DataFrame:
    """Inclusive running sums ``run_<c>`` and group totals ``tot_<c>`` along a numeric column.

    Rows must be unique per (by, order): aggregate equal values first, which also takes the heat out of hot values.
    """
    def direction(name: str) -> Column:
        return F.col(name).desc() if descending else F.col(name).asc()

    rows = with_buckets(df, [order], [bounds], "_bucket")
    bucket = f"{order}_bucket"
    keys = [F.col(b) for b in by]
    earlier = W.partitionBy(*keys).orderBy(direction(bucket)).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*keys)
    totals = (rows.groupBy(*by, bucket).agg(*[F.sum(c).alias(c) for c in sums])
              .select(*by, bucket,
                      *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"off_{c}") for c in sums],
                      *[F.sum(c).over(whole).alias(f"tot_{c}") for c in sums]))
    inside = W.partitionBy(*keys, F.col(bucket)).orderBy(direction(order)).rowsBetween(W.unboundedPreceding, 0)
    return (join_groups(rows, totals, [*by, bucket])
            .select(*df.columns, *[(F.col(f"off_{c}") + F.sum(c).over(inside)).alias(f"run_{c}") for c in sums],
                    *[f"tot_{c}" for c in sums]))


def _finer(numbers: DataFrame, columns: Sequence[str], bounds: list[list[float]], cells: Sequence[tuple[int, int]],
           buckets: int) -> list[list[float]]:
    """The bounds with the given (column, bucket) cells cut by a sketch of the values inside them."""
    ends = [(c, bounds[c][b], bounds[c][b + 1]) for c, b in cells]
    inside = numbers.select(*[F.when((F.col(columns[c]) >= lo) & (F.col(columns[c]) < hi), F.col(columns[c])).alias(f"_v{i}")
                              for i, (c, lo, hi) in enumerate(ends)])
    out = [set(b) for b in bounds]
    for (c, lo, hi), found in zip(ends, range_bounds(inside, inside.columns, buckets)):
        out[c] |= {x for x in found if lo < x < hi}
    return [sorted(b) for b in out]


def _locate(numbers: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str],
            bounds: list[list[float]]) -> tuple[DataFrame, DataFrame]:
    """(by..., _c, value, bucket) of all values, and the buckets that hold a wanted rank with the ranks in them."""
    marked = with_buckets(numbers, columns, bounds, "_b")
    long = (marked.select(*by, F.posexplode(F.array(*[
        F.struct(F.col(c).alias("value"), F.col(f"{c}_b").alias("bucket")) for c in columns])).alias("_c", "_e"))
        .select(*by, "_c", "_e.*").where(F.col("value").isNotNull() & ~F.isnan("value")))
    group = [*by, "_c"]  # the column's number groups faster than its name
    keys = [F.col(g) for g in group]
    counts = long.groupBy(*group, "bucket").agg(F.count("*").alias("cnt"))
    upto = W.partitionBy(*keys).orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    placed = (counts.withColumn("before", F.sum("cnt").over(upto) - F.col("cnt"))
              .withColumn("n", F.sum("cnt").over(W.partitionBy(*keys))))
    ranks = F.array_distinct(F.array(*[f(p).cast("long") for p in _positions(probs) for f in (F.floor, F.ceil)]))
    wanted = placed.withColumn("ranks", F.filter(
        ranks, lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("cnt")))).where(F.size("ranks") > 0)
    return long, wanted.select(*group, "bucket", "cnt", "before", "n", "ranks")


def _positions(probs: Sequence[float]) -> list[Column]:
    return [F.lit(float(p)) * (F.col("n") - 1) for p in probs]


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                    buckets: int = BUCKETS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Exact quantiles with linear interpolation: (by..., column, n, q array in the order of ``probs``).

    A sketch pass fixes the buckets, a count pass finds the buckets that hold the wanted ranks, and only values of
    those buckets are sorted. Wanted buckets that are still large are cut again first. Nulls and NaNs are left out.
    """
    numbers = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    bounds = range_bounds(numbers, columns, buckets)
    for _ in range(ROUNDS):
        long, wanted = _locate(numbers, columns, probs, by, bounds)
        rows = fetch(wanted)
        large = sorted({(r["_c"], int(r["bucket"])) for r in rows or () if r["cnt"] > cell_rows})
        finer = _finer(numbers, columns, bounds, large, buckets) if large else bounds
        if finer == bounds:
            break
        bounds = finer

    group = [*by, "_c"]
    near = join_groups(long, settled(wanted, rows).drop("cnt"), [*group, "bucket"])
    values = near.groupBy(*group, "bucket", "before", "n", "ranks", "value").agg(F.count("*").alias("cnt"))
    inside = W.partitionBy(*[F.col(g) for g in group], F.col("bucket")).orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    hits = (values.withColumn("stop", F.col("before") + F.sum("cnt").over(inside))
            .withColumn("rank", F.explode(F.filter(
                "ranks", lambda r: (r >= F.col("stop") - F.col("cnt")) & (r < F.col("stop"))))))
    found = hits.groupBy(*group).agg(F.max("n").alias("n"), F.map_from_entries(
        F.collect_list(F.struct("rank", "value"))).alias("at"))

    def interpolate(p: Column) -> Column:
        low, high = F.floor(p).cast("long"), F.ceil(p).cast("long")
        a, b = F.element_at("at", low), F.element_at("at", high)
        return F.when(low == high, a).otherwise(a + (b - a) * (p - low))

    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("_c") + 1).alias("column")
    return found.select(*by, name, "n", F.array(*[interpolate(p) for p in _positions(probs)]).alias("q"))


def hash_rank(df: DataFrame, key: str, by: Sequence[str] = (), seed: int = 42, out: str = "rank") -> DataFrame:
    """1-based rank inside each group by the hash order of a unique key, spread over 65536 buckets per group."""
    # text stand-ins make null groups equal to themselves, so the join and the window share one shuffle
    group = [f"_g{i}" for i in range(len(by))]
    rows = (df.withColumn("_k", order_key(key, seed)).withColumn("_b", F.substring("_k", 1, HASH_DIGITS))
            .withColumns({g: F.concat(F.lit("="), F.col(b).cast("string")) for g, b in zip(group, by)})
            .withColumns({g: F.coalesce(g, F.lit("")) for g in group}))
    keys = [F.col(g) for g in group]
    earlier = W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = (rows.groupBy(*group, "_b").agg(F.count("*").alias("_n"))
               .select(*group, "_b", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off")))
    inside = W.partitionBy(*keys, F.col("_b")).orderBy("_k", key)
    small = offsets if by else F.broadcast(offsets)  # without groups: one row per bucket
    return (rows.join(small, [*group, "_b"])
            .withColumn(out, F.col("_off") + F.row_number().over(inside)).select(*df.columns, out))


def hash_cutoffs(df: DataFrame, key: str, quota: Callable[[Column], Column], by: Sequence[str] = (),
                 seed: int = 42) -> DataFrame:
    """Per group the last (order key, key) among the first ``quota(n)`` rows: (by..., n, cut_k, cut_id).

    Counts per hash bucket tell in which bucket the cut lies, so only 1/65536 of a group is sorted. Groups whose
    quota is 0 have null cuts.
    """
    rows = (df.select(*by, F.col(key).alias("_id")).withColumn("_k", order_key("_id", seed))
            .withColumn("_b", F.substring("_k", 1, HASH_DIGITS)))
    keys = [F.col(b) for b in by]
    upto = W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, 0)
    placed = (rows.groupBy(*by, "_b").agg(F.count("*").alias("_c"))
              .withColumn("_before", F.sum("_c").over(upto) - F.col("_c"))
              .withColumn("n", F.sum("_c").over(W.partitionBy(*keys)))
              .withColumn("_take", F.least(quota(F.col("n")).cast("long"), F.col("n"))))
    edge = placed.where((F.col("_before") < F.col("_take")) & (F.col("_take") <= F.col("_before") + F.col("_c")))
    edge = settle(edge.select(*by, "_b", (F.col("_take") - F.col("_before")).alias("_need")))
    near = join_groups(rows, edge, [*by, "_b"])
    cut = (near.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy("_k", "_id")))
           .where(F.col("_r") == F.col("_need")).select(*by, F.col("_k").alias("cut_k"), F.col("_id").alias("cut_id")))
    sizes = placed.groupBy(*by).agg(F.max("n").alias("n"))
    return join_groups(sizes, cut, by, "left")


def mark_first(df: DataFrame, key: str, quota: Callable[[Column], Column], by: Sequence[str] = (), seed: int = 42,
               out: str = "chosen") -> DataFrame:
    """Flag exactly ``quota(n)`` rows of each group, the first ones in hash order, without shuffling the rows."""
    cuts = settle(hash_cutoffs(df, key, quota, by, seed).drop("n"))
    rows = df.withColumn("_k", order_key(key, seed))
    chosen = F.coalesce((F.col("_k") < F.col("cut_k"))
                        | ((F.col("_k") == F.col("cut_k")) & (F.col(key) <= F.col("cut_id"))), F.lit(False))
    return join_groups(rows, cuts, by, "left").withColumn(out, chosen).select(*df.columns, out)


def global_rank(df: DataFrame, order: Sequence[str], out: str = "rank") -> DataFrame:
    """0-based position in the total order of ``order`` columns.

    Range partitioning sorts the table across tasks (equal leading values are split by the later columns), the
    partition-local position comes from the row id, and partition sizes give the offsets. The sorted rows are
    checkpointed because a recomputed range partitioning may draw other edges.
    """
    in_part = (1 << 33) - 1
    placed = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_m", F.monotonically_increasing_id())
                         .withColumn("_p", F.shiftright("_m", 33))
                         .withColumn("_m", F.col("_m").bitwiseAND(F.lit(in_part))))
    sizes = placed.groupBy("_p").agg(F.count("*").alias("_n"))
    earlier = W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    return join_groups(placed, settle(offsets), ["_p"]).withColumn(out, F.col("_off") + F.col("_m")).drop("_p", "_m", "_off")
