import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline import schema as S
from stayline.functions.binning import cut, risk_level, risk_level_cut, tenure_bin
from stayline.functions.scalars import clip, currency, safe_ratio, unit_draw
from stayline.operators import clean, explore, features
from stayline.sources import tables
from stayline.sources.fixtures import subscribers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def five(spark):
    """Five subscribers, one without total charges."""
    rows = [("a", 1, 20.0, "20.0", "Month-to-month", "No"), ("b", 10, 50.0, "500", "One year", "Yes"),
            ("c", 20, 70.0, " ", "Two year", "No"), ("d", 30, 80.0, "2400.5", "Month-to-month", "Yes"),
            ("e", 40, 90.0, "3600", "One year", None)]
    return spark.createDataFrame(rows, "customerID string, tenure int, MonthlyCharges double, TotalCharges string, Contract string, Churn string")


def col(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_coercion_gives_one_null(five):
    out = clean.coerce_numeric(five, ["TotalCharges"])
    assert col(out, "TotalCharges") == [20.0, 500.0, None, 2400.5, 3600.0]
    assert clean.drop_null_rows(out, ["TotalCharges"]).count() == 4
    assert clean.drop_null_rows(out).count() == 3


@pytest.mark.parametrize("text,number", [("1e3", 1000.0), ("-5", -5.0), (" 7 ", 7.0), ("", None), ("x1", None), (None, None)])
def test_to_number(spark, text, number):
    df = spark.createDataFrame([(text,)], "v string")
    assert col(clean.coerce_numeric(df, ["v"]), "v") == [number]


def test_label(five):
    assert col(clean.encode_label(five), "label") == [0, 1, 0, 1, None]


def test_category_bins(five):
    assert col(features.add_tenure_group(five, "category"), "tenure_group") == [
        "Short-term", "Short-term", "Mid-term", "Long-term", "Long-term"]


@pytest.mark.parametrize("version,expected", [
    ("prepared", ["0-12", "0-12", "13-24", "49-72", None, None]),
    ("model", [None, "0-12", "12-24", "60+", "60+", None]),
    ("category", [None, "Short-term", "Mid-term", "Loyal", "Loyal", None]),
    ("left", ["1-12", "13-24", "13-24", None, None, None]),
])
def test_bin_edges(spark, version, expected):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([0, 12, 13, 72, 73, None])], "i int, tenure int")
    assert col(df.orderBy("i").select(tenure_bin("tenure", version).alias("b")), "b") == expected


def test_risk_levels(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (0.7,), (1.0,)], "p double").coalesce(1)
    assert col(df.select(risk_level("p").alias("r")), "r") == ["Low", "Medium", "High", "High"]
    assert col(df.select(risk_level_cut("p").alias("r")), "r") == [None, "Low", "Medium", "High"]


def test_cut_rejects_wrong_labels():
    with pytest.raises(ValueError):
        cut("x", [0, 1, 2], ["only one"])


def test_cut_ignores_nan(spark):
    df = spark.createDataFrame([(math.nan,)], "x double")
    assert col(df.select(cut("x", [0, math.inf], ["any"]).alias("c")), "c") == [None]


def test_imputation(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (10.0, None), (None, "b"), (4.0, "a")], "x double, s string").coalesce(1)
    assert col(clean.impute_median(df, ["x"]), "x")[3] == 3.0
    assert col(clean.impute_mean(df, ["x"]), "x")[3] == 4.25
    assert col(clean.impute_mode(df, ["s"]), "s")[2] == "a"  # tie goes to the smallest


def test_fill_only_when_all_null(spark):
    some = spark.createDataFrame([(None,), (1.0,)], "x double").coalesce(1)
    none = spark.createDataFrame([(None,), (None,)], "x double")
    assert col(clean.fill_if_all_null(some, "x"), "x") == [None, 1.0]
    assert col(clean.fill_if_all_null(none, "x"), "x") == [0.0, 0.0]


def test_validation(five):
    with pytest.raises(ValueError, match="gender"):
        clean.validate_rows(five, ["gender"], ["tenure"])
    errors = col(clean.validate_rows(five, ["Contract"], ["tenure", "TotalCharges"]), "error")
    assert errors == [None, None, "TotalCharges is not numeric", None, None]


def test_align_schema(five):
    out = clean.align_schema(five, S.subscriber_schema())
    assert out.schema.names == S.subscriber_schema().names
    assert col(out, "gender") == [None] * 5


def test_column_kinds(five):
    assert clean.numeric_columns(five) == ["tenure", "MonthlyCharges"]
    assert "Contract" in clean.text_columns(five)


def test_ratio_and_clip(spark):
    df = spark.createDataFrame([(10.0, 0), (10.0, 4), (None, 4)], "a double, b int").coalesce(1)
    assert col(df.select(safe_ratio("a", "b").alias("r")), "r") == [0.0, 2.5, 0.0]
    assert col(df.select(clip("a", 0.0, 5.0).alias("r")), "r") == [5.0, 5.0, None]


def test_currency(spark):
    df = spark.createDataFrame([(1234.5,)], "x double")
    assert col(df.select(currency("x").alias("c")), "c") == ["$1,234.50"]


def test_service_columns_by_name(spark):
    df = subscribers(spark, SF)
    assert features.service_named_columns(df) == [
        "PhoneService", "InternetService", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies"]


def test_service_count_treats_null_as_different(spark):
    df = spark.createDataFrame([("No", "No internet service", None)], "PhoneService string, OnlineBackup string, TechSupport string")
    assert col(features.add_service_count(df), "service_count") == [2]


def test_group_mean_keeps_null_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0)], "g string, x double").coalesce(1)
    assert col(features.vs_group_mean(df, "x", "g", "d").orderBy("x"), "d") == [-1.0, 1.0, 0.0]


def test_scaling_constant_column(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert col(features.standardize(df, ["x"]), "x_z") == [0.0, 0.0]
    assert col(features.minmax(df, ["x"]), "x_01") == [0.0, 0.0]


def test_five_thousand_categories(spark):
    names = [f"v{i:05d}" for i in range(5000)]
    df = spark.createDataFrame([(i, names[i * 7 % 5000]) for i in range(6000)] + [(9999, None)], "id long, c string")
    got = {r.id: r.n for r in features.string_index(df, "c", "n").collect()}
    assert all(got[i] == i * 7 % 5000 for i in range(6000)) and got[9999] == 5000
    slots = {r.id: r.v for r in features.one_hot_vector(df, "c", "v").collect()}
    assert slots[3].size == 5000 and slots[3].indices.tolist() == [21] and slots[9999].indices.tolist() == []
    pairs = explore.crosstab(df.withColumn("a", F.col("id") % 2), "a", "c")
    assert pairs.count() == len({(i % 2, i * 7 % 5000) for i in range(6000)})
    assert pairs.agg(F.sum("n")).first()[0] == 6000
    pct = explore.crosstab_pct(df.withColumn("a", F.col("id") % 2), "a", "c").groupBy("a").agg(F.sum("pct").alias("s"))
    assert all(abs(r.s - 100) < 1e-6 for r in pct.collect())


def test_unit_draw_range(spark):
    low, high, mean = spark.range(5000).agg(F.min(unit_draw("id")), F.max(unit_draw("id")), F.avg(unit_draw("id"))).first()
    assert 0 <= low < 0.01 and 0.99 < high < 1 and abs(mean - 0.5) < 0.02


def test_csv_keeps_blank_empty_and_null(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    rows = [(" ", "x"), ("", "y"), (None, "z"), ('q"uote, comma', "w")]
    tables.write_csv(spark.createDataFrame(rows, schema).coalesce(1), str(tmp_path / "t"))
    assert {tuple(r) for r in tables.read_csv(spark, str(tmp_path / "t"), schema).collect()} == set(rows)


def test_missing_csv_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_subscribers(spark, str(tmp_path / "absent.csv"))


def test_broken_csv_line_is_kept(spark, tmp_path):
    names = S.subscriber_schema().names
    good = ["1"] * len(names)
    (tmp_path / "s.csv").write_text("\n".join([",".join(names), ",".join(good), ",".join(["x"] * len(names))]))
    rows = tables.read_subscribers(spark, str(tmp_path / "s.csv")).cache()
    assert rows.count() == 2
    assert rows.where(f"{tables.CORRUPT} is not null").count() == 1


def test_predictions_are_partitioned_by_run(spark, tmp_path):
    df = spark.createDataFrame([("a", 0.4)], "customerID string, churn_probability double")
    for t in ("2024-01-01 10:00:00", "2024-01-02 10:00:00"):
        tables.write_predictions(df, str(tmp_path / "p"), F.lit(t).cast("timestamp"))
    runs = {r[0] for r in spark.read.parquet(str(tmp_path / "p")).select("run_id").collect()}
    assert runs == {"20240101_100000", "20240102_100000"}


def test_json_nan_becomes_null(spark):
    df = spark.createDataFrame([("k", math.nan, None)], "customerID string, x double, y string")
    assert tables.encode_json(df, "customerID").first()["value"] == '{"customerID":"k","x":null,"y":null}'
