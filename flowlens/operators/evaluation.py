"""Confusion counts, binary and multiclass metrics, per-class score tables, model comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.functions.predicates import binary_label, matches_any, ratio
from flowlens.operators.ranking import auc_expr, running_counts, truth_counts


# --- binary ---

def binary_confusion(df: DataFrame, flag: str = K.FLAG, truth: str = K.TRUTH) -> DataFrame:
    """One row tp, fp, fn, tn. Rows with a NULL flag or truth are in none; no rows give zeros."""
    hit, attack = F.col(flag) == 1, F.col(truth) == 1
    miss, benign = F.col(flag) == 0, F.col(truth) == 0
    return df.agg(
        F.count_if(hit & attack).alias("tp"),
        F.count_if(hit & benign).alias("fp"),
        F.count_if(miss & attack).alias("fn"),
        F.count_if(miss & benign).alias("tn"),
    )


def with_binary_metrics(cells: DataFrame) -> DataFrame:
    """Add precision, recall, f1, fpr and accuracy to rows of tp, fp, fn, tn; 0.0 for empty denominators."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    rates = cells.withColumns(
        {
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "fpr": ratio(fp, fp + tn),
            "accuracy": ratio(tp + tn, tp + fp + fn + tn),
        }
    )
    p, r = F.col("precision"), F.col("recall")
    return rates.withColumn("f1", ratio(2 * p * r, p + r))


def evaluate_at_threshold(
    df: DataFrame, threshold: float, score: str = K.SCORE, truth: str = K.TRUTH, ranges: int | None = None
) -> DataFrame:
    """Full binary report of a score at a threshold, AUC included, from one ranking of the scores."""
    return report_at(running_counts(df, score, truth_counts(truth), ranges=ranges), threshold)


def report_at(running: DataFrame, threshold: float) -> DataFrame:
    """The report from a ranking (``rank_truth``), which serves any number of thresholds."""
    above = F.col("score") > F.lit(float(threshold))

    def total(count: str, cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col(count))), F.lit(0))

    cells = running.agg(
        total("pos", above).alias("tp"),
        total("neg", above).alias("fp"),
        total("pos", ~above).alias("fn"),
        total("neg", ~above).alias("tn"),
        auc_expr().alias("auc_roc"),
    )
    report = with_binary_metrics(cells).withColumn("threshold", F.lit(float(threshold)))
    return report.withColumn("total_records", F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))


def binary_from_cells(cells: DataFrame, truth: str, pred: str, benign=0.0) -> DataFrame:
    """One row tp, fp, fn, tn from confusion cells: every class but the benign one is an attack."""
    attack, hit = binary_label(F.col(truth), benign) == 1, binary_label(F.col(pred), benign) == 1

    def total(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))

    return cells.agg(
        total(hit & attack).alias("tp"), total(hit & ~attack).alias("fp"),
        total(~hit & attack).alias("fn"), total(~hit & ~attack).alias("tn"),
    )


# --- multiclass ---

def confusion_cells(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Count per pair of true and predicted class; at most the square of the number of classes."""
    return df.groupBy(truth, pred).agg(F.count("*").alias("n"))


def per_class_metrics(cells: DataFrame, truth: str, pred: str) -> DataFrame:
    """Precision, recall and F1 of every class that is true or predicted somewhere.

    Each cell counts once for its true class and once for its predicted class, so one grouping of
    the small cell table is enough.
    """
    hit = F.when(F.col(truth) == F.col(pred), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col(truth).alias("class"), F.col("n").alias("support"), zero.alias("predicted"), hit.alias("hits")),
        F.struct(F.col(pred).alias("class"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("hits")),
    )
    sums = (
        cells.select(F.inline(sides))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    rates = sums.withColumns(
        {
            "precision": ratio(F.col("hits"), F.col("predicted")),
            "recall": ratio(F.col("hits"), F.col("support")),
        }
    )
    p, r = F.col("precision"), F.col("recall")
    return rates.withColumn("f1", ratio(2 * p * r, p + r))


def multiclass_metrics(per_class: DataFrame) -> DataFrame:
    """Accuracy and support-weighted averages, one row."""
    weight = F.sum("support")
    return per_class.agg(
        ratio(F.sum("hits"), weight).alias("accuracy"),
        *[ratio(F.sum(F.col(m) * F.col("support")), weight).alias(f"{m}_weighted") for m in ("precision", "recall", "f1")],
    )


def macro_metrics(per_class: DataFrame) -> DataFrame:
    """Plain averages over the classes that occur as truth, one row."""
    present = per_class.where(F.col("support") > 0)
    return present.agg(*[F.avg(m).alias(f"{m}_macro") for m in ("precision", "recall", "f1")])


# --- per class ---

def score_by_class(df: DataFrame, cls: str, score: str = K.SCORE, flag: str = K.FLAG) -> DataFrame:
    """Mean, spread and count of the score and the detection rate per true class."""
    return df.groupBy(cls).agg(
        F.avg(score).alias("mean_dist"),
        F.stddev_samp(score).alias("std_dist"),
        F.count("*").alias("num_records"),
        F.avg(F.col(flag).cast("double")).alias("detection_rate"),
    )


def detection_by_class(df: DataFrame, cls: str, flag: str = K.FLAG, score: str | None = None) -> DataFrame:
    """Records, detections, recall and a verdict per class."""
    extra = [F.avg(score).alias("mean_dist")] if score else []
    groups = df.groupBy(cls).agg(
        F.count("*").alias("num_records"),
        F.coalesce(F.sum(F.col(flag).cast("long")), F.lit(0)).alias("detected_as_attack"),
        *extra,
    )
    recall = ratio(F.col("detected_as_attack"), F.col("num_records"))
    return groups.withColumn("detection_recall", recall).withColumn(
        "detection", F.when(recall >= F.lit(K.FULL_DETECTION), "full").otherwise("partial")
    )


def unseen_detection(
    train: DataFrame, test: DataFrame, cls: str, flag: str = K.FLAG, score: str | None = None
) -> DataFrame:
    """Detection of the test classes that training never saw.

    The test rows are grouped first; the anti join then compares one row per class.
    """
    known = train.select(cls).distinct()
    return detection_by_class(test, cls, flag, score).join(known, cls, "left_anti")


def benign_rows(df: DataFrame, cls: str, benign) -> DataFrame:
    """Rows of the benign class."""
    return df.where(F.col(cls) == F.lit(benign))


def classes_in(df: DataFrame, cls: str, wanted: Sequence) -> DataFrame:
    """Rows of the given classes, for instance those that training didn't have."""
    return df.where(F.col(cls).isin(*wanted))


def match_classes(df: DataFrame, cls: str, patterns: Sequence[str] = K.UNSEEN_PATTERNS) -> DataFrame:
    return df.where(matches_any(F.col(cls), patterns))


def distinct_classes(df: DataFrame, cls: str) -> DataFrame:
    return df.select(cls).distinct()


def score_stats(df: DataFrame, score: str = K.SCORE) -> DataFrame:
    return df.agg(
        F.avg(score).alias("mean_dist"),
        F.stddev_samp(score).alias("std_dist"),
        F.min(score).alias("min_dist"),
        F.max(score).alias("max_dist"),
    )


def class_share(df: DataFrame, cls: str) -> DataFrame:
    """Count and percentage per class; the window runs over one row per class."""
    counts = df.groupBy(cls).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()) * 100)


def top_classes(df: DataFrame, cls: str, benign, k: int = 3) -> DataFrame:
    """The k most frequent classes other than the benign one."""
    attacks = df.where(F.col(cls) != F.lit(benign)).groupBy(cls).agg(F.count("*").alias("n"))
    return attacks.orderBy(F.desc("n"), F.asc(cls)).limit(k)


def dominant_label(df: DataFrame, pred: str, label: str) -> DataFrame:
    """For each predicted class, the true label it covers most often (the first of equals)."""
    pairs = df.groupBy(pred, label).agg(F.count("*").alias("n"))
    ranked = F.min_by(label, F.struct((-F.col("n")).alias("n"), F.col(label).alias("label")))
    return pairs.groupBy(pred).agg(F.sum("n").alias("n"), ranked.alias("dominant_label"))


# --- reports ---

def long_report(df: DataFrame, metrics: Sequence[str], value: str) -> DataFrame:
    """A one-row report as (metric, value) rows."""
    entries = [
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias(value)) for m in metrics
    ]
    return df.select(F.inline(F.array(*entries)))


def compare_models(base: DataFrame | None, optimised: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Base against optimised report, metric by metric; NULL where the base report is missing."""
    right = long_report(optimised, metrics, "optimised")
    if base is None:
        compared = right.withColumn("base", F.lit(None).cast("double"))
    else:
        compared = right.join(long_report(base, metrics, "base"), "metric", "left")
    return compared.select("metric", "base", "optimised", (F.col("optimised") - F.col("base")).alias("change"))


def compare_reports(spark: SparkSession, base: Mapping, optimised: Mapping) -> list[dict]:
    """``compare_models`` of two reports given as values: their single figures, those without one as NULL."""
    figures = [m for m, x in optimised.items() if not isinstance(x, (dict, list, str))]

    def one_row(report: Mapping) -> DataFrame:
        values = [None if report.get(m) is None else float(report[m]) for m in figures]
        return spark.createDataFrame([tuple(values)], ", ".join(f"{m} double" for m in figures))

    return [r.asDict() for r in compare_models(one_row(base), one_row(optimised), figures).orderBy("metric").collect()]


def run_figures(rows: int, seconds: float, partitions: int) -> dict:
    """Throughput and cost per record of a timed run."""
    return {
        "throughput_records_per_second": round(rows / seconds, 2) if seconds > 0 else 0.0,
        "average_latency_us": round(seconds / rows * 1e6, 4) if rows else 0.0,
        "num_partitions": int(partitions),
        "inference_time_seconds": round(float(seconds), 4),
    }


def run_metrics(spark: SparkSession, rows: int, seconds: float, partitions: int) -> DataFrame:
    """The same figures as one row."""
    values = {"num_records": int(rows), **run_figures(rows, seconds, partitions)}
    return spark.createDataFrame([tuple(values.values())], list(values))
