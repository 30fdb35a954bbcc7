"""Distributed order statistics against plain sorting, with ties, hot values and several groups."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.plans import ordered
from stayline.plans.durable import shared_folder


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows hold one value, one group holds most rows, some values are null or NaN."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(3000):
        x = 7.25 if i % 3 == 0 else float(rng.normal(0, 50))
        x = None if i % 101 == 0 else float("nan") if i % 103 == 0 else x
        rows.append((i, "big" if i % 10 else "small" if i % 20 else None, x, float(i % 4)))
    return spark.createDataFrame(rows, "id long, g string, x double, y double").repartition(5).cache()


@pytest.mark.parametrize("buckets,cell_rows", [(2, 10**6), (16, 10**6), (1024, 10**6), (4, 20), (2, 1)])
def test_quantiles(skewed, buckets, cell_rows):
    pdf = skewed.toPandas().dropna(subset=["x"])
    probs = [0.0, 0.1, 0.25, 0.5, 0.8, 1.0]
    got = {r["column"]: r for r in ordered.exact_quantiles(
        skewed, ["x", "y"], probs, buckets=buckets, cell_rows=cell_rows).collect()}
    assert got["x"]["n"] == len(pdf)
    assert got["x"]["q"] == pytest.approx(list(np.quantile(pdf["x"], probs)))
    assert got["y"]["q"] == pytest.approx(list(np.quantile(skewed.toPandas()["y"], probs)))


def test_quantiles_by_group(skewed):
    got = {r["g"]: r["q"] for r in ordered.exact_quantiles(skewed, ["x"], [0.25, 0.5], ["g"], 8, 30).collect()}
    pdf = skewed.toPandas().dropna(subset=["x"])
    for g in ("big", "small", None):
        part = pdf[pdf["g"].isna()] if g is None else pdf[pdf["g"] == g]
        assert got[g] == pytest.approx(list(np.quantile(part["x"], [0.25, 0.5])))


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "x double")
    assert ordered.exact_quantiles(empty, ["x"], [0.5]).count() == 0
    one = spark.createDataFrame([(3.0,)], "x double")
    assert ordered.exact_quantiles(one, ["x"], [0.0, 0.5, 1.0]).first()["q"] == [3.0, 3.0, 3.0]


def key(i, seed=42):
    return hashlib.md5(f"{i}:{seed}".encode()).hexdigest()


def test_hash_rank(skewed):
    got = {r["id"]: r["rank"] for r in ordered.hash_rank(skewed.select("id", "g"), "id", ["g"]).collect()}
    groups = {}
    for r in skewed.collect():
        groups.setdefault(r["g"], []).append(r["id"])
    for ids in groups.values():
        for place, i in enumerate(sorted(ids, key=key), start=1):
            assert got[i] == place


@pytest.mark.parametrize("quota", [0, 1, 17, 5000])
def test_mark_first(skewed, quota):
    out = ordered.mark_first(skewed.select("id", "g"), "id", lambda n: F.lit(quota), ["g"]).toPandas()
    assert len(out) == 3000
    for g, part in out.groupby("g", dropna=False):
        wanted = set(sorted(part["id"], key=key)[:quota])
        assert set(part.loc[part["chosen"], "id"]) == wanted


def test_mark_first_without_groups(skewed):
    out = ordered.mark_first(skewed.select("id"), "id", lambda n: F.floor(n * 0.1)).toPandas()
    assert out["chosen"].sum() == 300


def test_global_rank(skewed):
    out = ordered.global_rank(skewed.select("y", "id"), ["y", "id"]).toPandas().sort_values(["y", "id"])
    assert list(out["rank"]) == list(range(3000))


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    rng = np.random.default_rng(2)
    rows = [(m, float(s), int(w)) for m in "ab" for s, w in zip(rng.permutation(500), rng.integers(1, 9, 500))]
    df = spark.createDataFrame(rows, "m string, s double, w long")
    bounds = ordered.range_bounds(df, ["s"], 16)[0]
    out = ordered.running_totals(df, "s", ["w"], bounds, ["m"], descending).toPandas()
    for m, part in out.groupby("m"):
        part = part.sort_values("s", ascending=not descending)
        assert list(part["run_w"]) == list(part["w"].cumsum())
        assert (part["tot_w"] == part["w"].sum()).all()


def test_shared_folder_is_the_cluster_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_folder(spark) == configured.rstrip("/")
    assert shared_folder(spark)
