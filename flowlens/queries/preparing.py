"""Label index, feature arrays, scaling, class weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.operators.evaluation import class_share, distinct_classes, dominant_label, top_classes
from flowlens.operators.features import (
    apply_label_index,
    assemble,
    attach_class_name,
    class_distribution,
    class_weights,
    fit_label_index,
    fit_scaler,
    scale,
    weighted_training_set,
)
from flowlens.queries.registry import (
    FLOW_FEATURES,
    calibration_part,
    flows,
    labelled,
    multi,
    query,
    table,
    typed,
)

KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]

INDEX_SQL = """SELECT label, n, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS DOUBLE) AS label_index
    FROM (SELECT label, count(*) AS n FROM @flows WHERE label IS NOT NULL GROUP BY label) c"""
WEIGHT_SQL = """SELECT label, inv * count(*) OVER () / sum(inv) OVER () AS class_weight
    FROM (SELECT label, sum(n) OVER () / n AS inv FROM (SELECT label, count(*) AS n FROM @flows GROUP BY label) c) i"""


@query("class_distribution", "SELECT label, count(*) AS n FROM @flows GROUP BY label")
def class_distribution_query(spark, sf):
    return class_distribution(flows(spark, sf), "label")


@query("distinct_classes", "SELECT DISTINCT event_type FROM events")
def distinct_classes_query(spark, sf):
    return distinct_classes(table(spark, sf, "events"), "event_type")


@query(
    "class_share",
    """SELECT event_type, count(*) AS n, round(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM events) * 100, 6) AS share
    FROM events GROUP BY event_type""",
)
def class_share_query(spark, sf):
    return class_share(table(spark, sf, "events"), "event_type").withColumn("share", F.round("share", 6))


@query(
    "top_attack_classes",
    """SELECT p_type, count(*) AS n FROM part WHERE p_type <> 'MEDIUM' GROUP BY p_type ORDER BY n DESC, p_type LIMIT 3""",
)
def top_attack_classes(spark, sf):
    return top_classes(table(spark, sf, "part"), "p_type", benign="MEDIUM", k=3)


@query(
    "dominant_label",
    """SELECT pred, CAST(sum(n) AS BIGINT) AS n, arg_min(truth, place) AS dominant_label FROM
    (SELECT pred, truth, n, row_number() OVER (PARTITION BY pred ORDER BY n DESC, truth) AS place
     FROM (SELECT pred, truth, count(*) AS n FROM @multi GROUP BY pred, truth) c) r GROUP BY pred""",
)
def dominant_label_query(spark, sf):
    return dominant_label(multi(spark, sf), "pred", "truth")


@query("label_index_sql", INDEX_SQL)
def label_index_sql(spark, sf):
    """The index table alone: labels by frequency."""
    return fit_label_index(flows(spark, sf))


@query(
    "label_index",
    """WITH counts AS (SELECT label, count(*) AS n FROM @labelled WHERE day(ts) <= 20 AND label IS NOT NULL GROUP BY label),
    idx AS (SELECT label, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS DOUBLE) AS label_index FROM counts)
    SELECT e.event_id, e.label, coalesce(i.label_index, (SELECT CAST(count(*) AS DOUBLE) FROM idx)) AS label_index
    FROM @labelled e LEFT JOIN idx i ON e.label = i.label""",
)
def label_index(spark, sf):
    """Index fitted on the first days, applied to all days; new and missing labels share the last index."""
    rows = labelled(spark, sf)
    known = fit_label_index(calibration_part(rows))
    return apply_label_index(rows, known).select("event_id", "label", "label_index")


@query(
    "join_class_name",
    """SELECT o_orderkey, truth, CASE WHEN truth IN ('F', 'O') THEN truth ELSE '__unseen__' END AS class FROM @multi""",
)
def join_class_name(spark, sf):
    """Class names looked up by index; indexes beyond the known classes get a marker."""
    known = spark.createDataFrame([("F", 0.0), ("O", 1.0)], "label string, label_index double")
    index = F.when(F.col("truth") == "F", 0.0).when(F.col("truth") == "O", 1.0).otherwise(2.0)
    named = attach_class_name(multi(spark, sf).withColumn("idx", index), known, "idx", "class")
    return named.select("o_orderkey", "truth", "class")


@query(
    "assemble_features",
    """SELECT l_orderkey, l_linenumber, l_partkey, p AS f0, q AS f1 FROM @typed
    WHERE q IS NOT NULL AND NOT isnan(q) AND p IS NOT NULL AND NOT isnan(p)""",
)
def assemble_features(spark, sf):
    rows = assemble(typed(spark, sf), ["q", "p"], out="features")
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("features")[0].alias("f0"), F.col("features")[1].alias("f1")
    )


@query(
    "scaler_stats",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 8) AS mean, round(stddev_samp({c}), 8) AS std FROM @flows"
        for c in FLOW_FEATURES
    ),
)
def scaler_stats(spark, sf):
    stats = fit_scaler(flows(spark, sf), FLOW_FEATURES)
    return stats.select("feature", F.round("mean", 8).alias("mean"), F.round("std", 8).alias("std"))


@query(
    "scale_features",
    "SELECT "
    + ", ".join(KEYS)
    + "".join(f", round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in FLOW_FEATURES)
    + " FROM @flows, (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in FLOW_FEATURES)
    + " FROM @flows) t",
)
def scale_features(spark, sf):
    rows = flows(spark, sf).select(*KEYS, *FLOW_FEATURES)
    scaled = scale(rows, fit_scaler(rows, FLOW_FEATURES))
    return scaled.select(*KEYS, *[F.round(c, 6).alias(c) for c in FLOW_FEATURES])


@query("class_weights", f"SELECT label, round(class_weight, 6) AS class_weight FROM ({WEIGHT_SQL}) w")
def class_weights_query(spark, sf):
    weights = class_weights(flows(spark, sf), "label")
    return weights.withColumn("class_weight", F.round("class_weight", 6))


@query(
    "join_class_weight",
    f"""SELECT {", ".join("f." + k for k in KEYS)}, f.label, round(w.class_weight, 6) AS class_weight
    FROM @flows f LEFT JOIN ({WEIGHT_SQL}) w ON f.label = w.label""",
)
def join_class_weight(spark, sf):
    rows = weighted_training_set(flows(spark, sf).select(*KEYS, "label"), "label")
    return rows.withColumn("class_weight", F.round("class_weight", 6))
