"""Exact evaluation of classifiers from (label, prediction) and (label, score), optionally per model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions.scalars import safe_ratio
from stayline.plans.ordered import range_bounds, running_totals
from stayline.plans.small import join_groups


def confusion_matrix(df: DataFrame, by: Sequence[str] = (), label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """tn, fp, fn, tp."""
    def cell(y: int, p: int) -> Column:
        return F.count_if((F.col(label) == y) & (F.col(prediction) == p))

    return df.groupBy(*by).agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"),
                               cell(1, 1).alias("tp"))


def binary_metrics(df: DataFrame, by: Sequence[str] = (), label: str = "label",
                   prediction: str = "prediction") -> DataFrame:
    """accuracy, precision, recall, f1 of the positive class; 0 where a denominator is 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return confusion_matrix(df, by, label, prediction).select(
        *by, safe_ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"), safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, tp + fn).alias("recall"), safe_ratio(tp * 2, tp * 2 + fp + fn).alias("f1"))


def _per_class(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(class, tp, support, predicted, total) for any number of classes, from the small label x prediction table."""
    pairs = df.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(F.count("*").alias("n"))
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("y").cast("int").alias("class"), F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("tp"),
                 F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("p").cast("int").alias("class"), F.lit(0).cast("long").alias("tp"),
                 F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")))).alias("s")).select("s.*")
    total = pairs.agg(F.sum("n").alias("total"))
    return sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")]).withColumn(
        "total", total.scalar())


def _averages(report: DataFrame, measures: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    """Append macro and/or support-weighted means of the class rows."""
    parts = [report.select(F.col("class").cast("string").alias("class"), *measures, "support")]
    for kind in kinds:
        mean = {"macro avg": lambda m: F.avg(m),
                "weighted avg": lambda m: F.try_divide(F.sum(F.col(m) * F.col("support")), F.sum("support"))}[kind]
        parts.append(report.agg(*[mean(m).alias(m) for m in measures], F.sum("support").alias("support"))
                     .select(F.lit(kind).alias("class"), *measures, "support"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """precision, recall, f1, support per class with macro and weighted averages."""
    rows = _per_class(df, label, prediction).select(
        "class", safe_ratio("tp", "predicted").alias("precision"), safe_ratio("tp", "support").alias("recall"),
        safe_ratio(F.col("tp") * 2, F.col("predicted") + F.col("support")).alias("f1"), "support")
    return _averages(rows, ["precision", "recall", "f1"], ["macro avg", "weighted avg"])


def imbalance_report(df: DataFrame, label: str = "label", prediction: str = "prediction", alpha: float = 0.1) -> DataFrame:
    """Adds specificity, geometric mean and index of balanced accuracy per class."""
    negatives = F.col("total") - F.col("support")
    rows = (_per_class(df, label, prediction).select(
        "class", safe_ratio("tp", "predicted").alias("precision"), safe_ratio("tp", "support").alias("recall"),
        safe_ratio(negatives - (F.col("predicted") - F.col("tp")), negatives).alias("specificity"),
        safe_ratio(F.col("tp") * 2, F.col("predicted") + F.col("support")).alias("f1"), "support")
        .withColumn("geo", F.sqrt(F.col("recall") * F.col("specificity")))
        .withColumn("iba", (1 + alpha * (F.col("recall") - F.col("specificity"))) * F.col("recall") * F.col("specificity")))
    return _averages(rows, ["precision", "recall", "specificity", "f1", "geo", "iba"], ["weighted avg"])


def _score_totals(df: DataFrame, by: Sequence[str], label: str, score: str) -> DataFrame:
    """Per distinct score, highest first: pos, neg there, running and total pos, neg."""
    counts = df.groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    bounds = range_bounds(df, [score])[0]
    return running_totals(counts, "score", ["pos", "neg"], bounds, by, descending=True)


def roc_auc(df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score") -> DataFrame:
    """Share of (positive, negative) pairs ranked right, ties counted half; null when a class is absent."""
    below = F.col("tot_neg") - F.col("run_neg")
    won = F.sum(F.col("pos") * (below + F.col("neg") / 2.0))
    return _score_totals(df, by, label, score).groupBy(*by).agg(
        F.try_divide(won, F.max(F.col("tot_pos").cast("double") * F.col("tot_neg"))).alias("roc_auc"))


def roc_curve(df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, plus the start (null, 0, 0)."""
    points = _score_totals(df, by, label, score).select(
        *by, F.col("score").alias("threshold"), safe_ratio("run_neg", "tot_neg").alias("fpr"),
        safe_ratio("run_pos", "tot_pos").alias("tpr"))
    return points.unionByName(_extra_point(df, by, fpr=0.0, tpr=0.0))


def _extra_point(df: DataFrame, by: Sequence[str], **values: float) -> DataFrame:
    fixed = [F.lit(None).cast("double").alias("threshold"), *[F.lit(v).alias(n) for n, v in values.items()]]
    if by:
        return df.select(*by).distinct().select(*by, *fixed)
    return df.sparkSession.range(1).select(*fixed)


def _pr_points(df: DataFrame, by: Sequence[str], label: str, score: str) -> DataFrame:
    """Precision and recall at each score and just above it; above the highest they are 1 and 0."""
    tp, taken = F.col("run_pos"), F.col("run_pos") + F.col("run_neg")
    tp_before, taken_before = tp - F.col("pos"), taken - F.col("pos") - F.col("neg")
    return _score_totals(df, by, label, score).select(
        *by, "score", safe_ratio(tp, taken).alias("precision"), safe_ratio(tp, "tot_pos").alias("recall"),
        safe_ratio(tp_before, taken_before, 1.0).alias("precision_above"),
        safe_ratio(tp_before, "tot_pos").alias("recall_above"))


def pr_curve(df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, precision, recall) for every distinct score, plus the closing point (null, 1, 0)."""
    points = _pr_points(df, by, label, score).select(*by, F.col("score").alias("threshold"), "precision", "recall")
    return points.unionByName(_extra_point(df, by, precision=1.0, recall=0.0))


def pr_auc(df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score") -> DataFrame:
    """Trapezoid area under the precision-recall curve."""
    step = F.col("recall") - F.col("recall_above")
    return _pr_points(df, by, label, score).groupBy(*by).agg(
        F.sum(step * (F.col("precision") + F.col("precision_above")) / 2).alias("pr_auc"))


def long_scores(df: DataFrame, scores: Mapping[str, str], keep: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """One row per (row, model) with score and prediction; ``scores`` maps model name to score column."""
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("score")) for m, c in scores.items()])
    return df.select(*keep, F.explode(pairs).alias("s")).select(
        *keep, "s.model", "s.score", (F.col("s.score") >= threshold).cast("int").alias("prediction"))


def compare_models(long: DataFrame, label: str = "label") -> DataFrame:
    """One row per model: threshold metrics and both areas. Models share one scan and one set of buckets."""
    by = ["model"]
    totals = _score_totals(long, by, label, "score")
    tp, taken = F.col("run_pos"), F.col("run_pos") + F.col("run_neg")
    tp_before, taken_before = tp - F.col("pos"), taken - F.col("pos") - F.col("neg")
    below = F.col("tot_neg") - F.col("run_neg")
    areas = totals.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("pos") * (below + F.col("neg") / 2.0)),
                     F.max(F.col("tot_pos").cast("double") * F.col("tot_neg"))).alias("roc_auc"),
        F.sum(safe_ratio("pos", "tot_pos") * (safe_ratio(tp, taken) + safe_ratio(tp_before, taken_before, 1.0)) / 2)
        .alias("pr_auc"))
    return join_groups(binary_metrics(long, by, label), areas, by)


def best_by(df: DataFrame, metric: str, name: str) -> DataFrame:
    """The row with the highest metric, ties to the first name."""
    return df.orderBy(F.desc(metric), name).limit(1)


def stability(folds: DataFrame, by: Sequence[str] = (), metric: str = "score", limit: float = 0.05) -> DataFrame:
    """Mean and population deviation of fold scores, and whether the deviation stays below the limit."""
    return folds.groupBy(*by).agg(
        F.count("*").alias("folds"), F.avg(metric).alias("mean_score"), F.stddev_pop(metric).alias("std_score"),
        (F.stddev_pop(metric) < limit).alias("stable"))
