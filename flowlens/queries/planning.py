"""Whole plans over the given tables, from raw CSV files to tables ready for training."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.plans.clusters import calibrate_clusters, train_clusters
from flowlens.plans.layout import Layout
from flowlens.plans.prepare import prepare
from flowlens.queries.registry import dirty, query
from flowlens.sources.documents import read_doc
from flowlens.sources.tables import read_table
from flowlens.workspace import shared_dir

_PREPARED: dict[tuple[str, str], Layout] = {}


def prepared(spark, sf) -> Layout:
    """The dirty rows as raw files of train and test days, prepared once per session and folder.

    One job writes both splits. Text that is no number would make its column text, so it is missing here. All copies of a row lie in
    one file, as a row's file is part of the row.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _PREPARED:
        day = F.dayofweek("l_shipdate")
        split = F.when(day.isin(2, 4, 6), "train").when(day.isin(3, 5), "test")
        quantity = F.when(F.col("q_txt") != "abc", F.col("q_txt"))
        rows = dirty(spark, sf).select(
            "l_orderkey", "l_linenumber", "l_partkey", quantity.alias("q"), F.col("p_txt").alias("p"), "label", split.alias("split")
        )
        raw = shared_dir(spark, "raw")
        known = rows.where(F.col("split").isNotNull())
        known.repartition(*known.columns).write.partitionBy("split").option("header", True).csv(raw)
        layout = Layout(shared_dir(spark, "project"))
        prepare(spark, f"{raw}/split=train", f"{raw}/split=test", layout)
        _PREPARED[key] = layout
    return _PREPARED[key]


RAW_SQL = """(SELECT l_orderkey, l_linenumber, l_partkey, TRY_CAST(q_txt AS DOUBLE) AS q, TRY_CAST(p_txt AS DOUBLE) AS p, label,
    CASE WHEN dayofweek(l_shipdate) IN (1, 3, 5) THEN 'train' ELSE 'test' END AS split
    FROM @dirty WHERE dayofweek(l_shipdate) BETWEEN 1 AND 5)"""
VALUES_SQL = f"""(SELECT * FROM {RAW_SQL} r WHERE q IS NOT NULL AND NOT isnan(q) AND p IS NOT NULL AND NOT isnan(p)
    AND label IS NOT NULL)"""
FINITE_SQL = f"(SELECT * FROM {VALUES_SQL} v WHERE NOT isinf(q) AND NOT isinf(p))"
CLEAN_SQL = f"(SELECT DISTINCT * FROM {FINITE_SQL} f)"


def count_sql(source: str) -> str:
    return f"(SELECT split, count(*) AS n FROM {source} s GROUP BY split)"


@query(
    "plan_prepare_audit",
    f"""WITH n AS (SELECT a.split, a.n AS n0, b.n AS n1, c.n AS n2, d.n AS n3 FROM {count_sql(RAW_SQL)} a
        JOIN {count_sql(VALUES_SQL)} b ON a.split = b.split JOIN {count_sql(FINITE_SQL)} c ON a.split = c.split
        JOIN {count_sql(CLEAN_SQL)} d ON a.split = d.split)
    SELECT split, 'nulls' AS step, n0 AS rows_before, n1 AS rows_after, n0 - n1 AS removed FROM n
    UNION ALL SELECT split, 'infinite', n1, n2, n1 - n2 FROM n
    UNION ALL SELECT split, 'duplicates', n2, n3, n2 - n3 FROM n""",
)
def plan_prepare_audit(spark, sf) -> DataFrame:
    """What cleaning removed from both splits, as the plan reports it."""
    layout = prepared(spark, sf)
    schema = "step string, rows_before long, rows_after long, removed long"
    parts = [
        read_doc(spark, layout("reports", f"cleaning_{split}"), schema).select(F.lit(split).alias("split"), "*")
        for split in ("train", "test")
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "plan_train_table",
    f"""WITH n AS (SELECT label, count(*) AS n FROM {CLEAN_SQL} c WHERE split = 'train' GROUP BY label)
    SELECT label, n, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS DOUBLE) AS label_index, 5 AS features,
        round(count(*) OVER () / CAST(n AS DOUBLE) / sum(1 / CAST(n AS DOUBLE)) OVER (), 9) AS class_weight FROM n""",
)
def plan_train_table(spark, sf) -> DataFrame:
    """Rows, label index, vector length and class weight of each class in the processed training table."""
    from pyspark.ml.functions import vector_to_array

    rows = read_table(spark, prepared(spark, sf)("processed", "train"))
    return rows.groupBy(K.LABEL, K.LABEL_INDEX, F.round(K.CLASS_WEIGHT, 9).alias(K.CLASS_WEIGHT)).agg(
        F.count("*").alias("n"), F.max(F.size(vector_to_array(K.SCALED_VECTOR))).alias("features")
    )


@query(
    "plan_crossfit_threshold",
    f"""SELECT count(*) AS records, count(*) FILTER (label <> 'N') AS attacks, TRUE AS consistent
    FROM {CLEAN_SQL} c WHERE split = 'train'""",
)
def plan_crossfit_threshold(spark, sf) -> DataFrame:
    """The calibration plan with three folds scores every cleaned training row once; the threshold it
    reports has the counts it reports."""
    layout = prepared(spark, sf)
    train_clusters(spark, layout, "N", "crossfit", k=3, max_iter=10)
    report = calibrate_clusters(spark, layout, "N", "crossfit", folds=3)
    scored = read_table(spark, layout("scores", "crossfit_calibration"))
    above, attack = F.col(K.SCORE) > report["threshold_optimal"], F.col(K.TRUTH) == 1
    tp, fp = F.count_if(above & attack), F.count_if(above & ~attack)
    return scored.agg(
        F.count("*").alias("records"),
        F.count_if(attack).alias("attacks"),
        (
            (F.abs(tp / F.greatest(tp + fp, F.lit(1)) - report["precision"]) < 1e-9)
            & (F.lit(report["calibration_records"]) == F.count("*"))
        ).alias("consistent"),
    )
