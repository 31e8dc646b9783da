"""Filters, row cleaning and its audit, sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.functions.predicates import (
    binary_label,
    flag_anomaly,
    rate_band,
    ratio_band,
    value_band,
    weekday_token,
)
from flowlens.operators.clean import clean_audit, clean_rows, dedup_by_hash, drop_invalid, drop_nan, drop_nulls, inf_to_nan
from flowlens.operators.evaluation import benign_rows, classes_in, match_classes
from flowlens.operators.sampling import bernoulli_sample, hash_sample, stratified_sample
from flowlens.operators.schema import route_split, with_split
from flowlens.queries.registry import ATTACK, flows, multi, query, scored, table, typed

NUMERIC = ["q", "p"]


@query("clean_single_pass", "SELECT *, 'train' AS _split FROM @valid")
def clean_single_pass(spark, sf):
    return drop_invalid(with_split(typed(spark, sf), "train"), NUMERIC)


HAS_VALUES = "q IS NOT NULL AND NOT isnan(q) AND p IS NOT NULL AND NOT isnan(p) AND label IS NOT NULL"


@query("clean_drop_nulls", f"SELECT * FROM @typed WHERE {HAS_VALUES}")
def clean_drop_nulls(spark, sf):
    return drop_nulls(typed(spark, sf), [*NUMERIC, "label"])


@query(
    "clean_inf_to_nan",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, p, label,
        CASE WHEN isinf(q) THEN CAST('NaN' AS DOUBLE) ELSE q END AS q FROM @typed""",
)
def clean_inf_to_nan(spark, sf):
    return inf_to_nan(typed(spark, sf), NUMERIC)


@query("clean_drop_nan", "SELECT * FROM @typed WHERE NOT (q IS NOT NULL AND isnan(q)) AND NOT (p IS NOT NULL AND isnan(p))")
def clean_drop_nan(spark, sf):
    return drop_nan(typed(spark, sf), NUMERIC)


@query("clean_dedup", "SELECT DISTINCT * FROM @valid")
def clean_dedup(spark, sf):
    return clean_rows(typed(spark, sf), NUMERIC)


@query(
    "clean_dedup_hash",
    """SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_partkey % 20 = 0) rows
    WHERE l_returnflag IS NOT NULL AND l_quantity IS NOT NULL AND l_tax IS NOT NULL""",
)
def clean_dedup_hash(spark, sf):
    """Whole rows of lineitem, a twentieth of them twice: only hashes and the copies are shuffled."""
    rows = table(spark, sf, "lineitem")
    again = rows.where("l_partkey % 20 = 0")
    return clean_rows(rows.unionAll(again), ["l_quantity", "l_tax"], "l_returnflag", by_hash=True)


COPIES_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, q, p, label, 'a.csv' AS _source_file FROM @valid
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, q, p, label, 'b.csv' FROM @valid WHERE l_partkey % 3 = 0"""


@query(
    "clean_dedup_content",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, q, p, label, min(_source_file) AS _source_file
    FROM ({COPIES_SQL}) c GROUP BY l_orderkey, l_linenumber, l_partkey, l_shipdate, q, p, label""",
)
def clean_dedup_content(spark, sf):
    """Copies that differ only in the file they come from count as copies."""
    rows = drop_invalid(typed(spark, sf), NUMERIC)
    again = rows.where("l_partkey % 3 = 0").withColumn("_source_file", F.lit("b.csv"))
    return dedup_by_hash(rows.withColumn("_source_file", F.lit("a.csv")).unionByName(again), ignore=["_source_file"])


@query(
    "clean_audit",
    f"""WITH n AS (SELECT
        (SELECT count(*) FROM @typed) AS n0,
        (SELECT count(*) FROM @typed WHERE {HAS_VALUES}) AS n1,
        (SELECT count(*) FROM @valid) AS n2,
        (SELECT count(*) FROM (SELECT DISTINCT * FROM @valid ) u) AS n3)
    SELECT 1 AS step_no, 'nulls' AS step, n0 AS rows_before, n1 AS rows_after, n0 - n1 AS removed,
        n0 - n1 > n0 * CAST(0.3 AS DOUBLE) AS excessive FROM n
    UNION ALL SELECT 2, 'infinite', n1, n2, n1 - n2, n1 - n2 > n1 * CAST(0.3 AS DOUBLE) FROM n
    UNION ALL SELECT 3, 'duplicates', n2, n3, n2 - n3, n2 - n3 > n2 * CAST(0.3 AS DOUBLE) FROM n""",
)
def clean_audit_query(spark, sf):
    return clean_audit(typed(spark, sf), NUMERIC)


@query(
    "route_split_by_day",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, label,
        CASE dayofweek(l_shipdate) WHEN 1 THEN 'train' WHEN 3 THEN 'train' WHEN 5 THEN 'train' ELSE 'test' END AS _split
    FROM @flows WHERE dayofweek(l_shipdate) BETWEEN 1 AND 5""",
)
def route_split_by_day(spark, sf):
    """Rows go to train or test by the weekday named in a file-like text; weekends are dropped."""
    name = F.concat(F.date_format("l_shipdate", "EEEE"), F.lit("-WorkingHours.csv"))
    rows = flows(spark, sf).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "label", name.alias("file"))
    return route_split(rows, weekday_token(F.col("file"))).drop("file")


@query("benign_subset", "SELECT event_id, event_type, score FROM @scored WHERE truth = 0")
def benign_subset(spark, sf):
    kept = benign_rows(scored(spark, sf), "truth", 0)
    return kept.select("event_id", "event_type", "score")


@query("unseen_by_index", "SELECT o_orderkey, truth FROM @multi WHERE truth IN ('O', 'P')")
def unseen_by_index(spark, sf):
    return classes_in(multi(spark, sf), "truth", ["O", "P"]).select("o_orderkey", "truth")


@query(
    "unseen_by_name",
    "SELECT p_partkey, p_type FROM part WHERE lower(p_type) LIKE '%promo%' OR lower(p_type) LIKE '%small%'",
)
def unseen_by_name(spark, sf):
    return match_classes(table(spark, sf, "part"), "p_type", ["promo", "Small"]).select("p_partkey", "p_type")


@query(
    "binary_label",
    """SELECT l_orderkey, l_linenumber, l_partkey, label, CASE WHEN label = 'R' THEN 0 ELSE 1 END AS binary
    FROM @typed""",
)
def binary_label_query(spark, sf):
    """A missing label counts as an attack."""
    rows = typed(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "label")
    return rows.withColumn("binary", binary_label(F.col("label"), "R"))


@query(
    "flag_anomaly",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN q IS NULL THEN NULL WHEN q > 25 THEN 1 ELSE 0 END AS flag
    FROM @typed""",
)
def flag_anomaly_query(spark, sf):
    """NULL stays NULL; NaN and infinity are above every threshold."""
    return typed(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", flag_anomaly(F.col("q"), 25).alias("flag")
    )


@query(
    "rate_band",
    """SELECT user_id, rate, CASE WHEN rate < 10 THEN 'ok' WHEN rate < 30 THEN 'warn' ELSE 'high' END AS band
    FROM (SELECT user_id, avg(truth) * 100 AS rate FROM @scored GROUP BY user_id) r""",
)
def rate_band_query(spark, sf):
    rates = scored(spark, sf).groupBy("user_id").agg((F.avg("truth") * 100).alias("rate"))
    return rates.withColumn("band", rate_band(F.col("rate")))


@query(
    "value_band",
    """SELECT event_id, CASE WHEN score <= 40 THEN 'ok' WHEN score >= 120 THEN 'bad' ELSE 'warn' END AS value_band,
        CASE WHEN score / 100 >= 1.2 THEN 'ok' WHEN score / 100 >= 1.0 THEN 'warn' ELSE 'bad' END AS ratio_band
    FROM @scored""",
)
def value_band_query(spark, sf):
    return scored(spark, sf).select(
        "event_id",
        value_band(F.col("score"), 40, 120).alias("value_band"),
        ratio_band(F.col("score") / 100).alias("ratio_band"),
    )


@query("sample_bernoulli", "SELECT l_returnflag, count(*) AS n, TRUE AS within FROM lineitem GROUP BY l_returnflag")
def sample_bernoulli(spark, sf):
    """Share of each flag that a sample keeps, against six standard deviations."""
    rows = table(spark, sf, "lineitem").select("l_returnflag")
    kept = bernoulli_sample(rows).groupBy("l_returnflag").agg(F.count("*").alias("kept"))
    full = rows.groupBy("l_returnflag").agg(F.count("*").alias("n"))
    rate = K.SEARCH_FRACTION
    off = F.abs(F.coalesce("kept", F.lit(0)) - rate * F.col("n"))
    both = full.join(kept, "l_returnflag", "left")
    return both.select("l_returnflag", "n", (off <= 6 * F.sqrt(F.col("n") * rate * (1 - rate))).alias("within"))


RATES = {ATTACK: 1.0, "click": 0.3, "view": 0.3, "purchase": 0.3, "signup": 0.3}


@query(
    "sample_stratified",
    f"""SELECT count(*) FILTER (event_type = '{ATTACK}') AS attacks, 0 AS foreign_rows, 0 AS repeated FROM events""",
)
def sample_stratified(spark, sf):
    """A class with rate 1 is kept whole, and a sample has rows of the table only, each once."""
    rows = scored(spark, sf).select("event_id", "event_type")
    sample = stratified_sample(rows, "event_type", RATES)
    known = sample.join(rows.withColumn("known", F.lit(True)), ["event_id", "event_type"], "left")
    return known.agg(
        F.count_if(F.col("event_type") == ATTACK).alias("attacks"),
        F.count_if(F.col("known").isNull()).cast("int").alias("foreign_rows"),
        (F.count("*") - F.count_distinct("event_id")).cast("int").alias("repeated"),
    )


@query("sample_rates", "SELECT event_type, count(*) AS n, TRUE AS within FROM @scored GROUP BY event_type")
def sample_rates(spark, sf):
    """Share of each class that a stratified sample keeps, against six standard deviations."""
    rows = scored(spark, sf)
    kept = stratified_sample(rows, "event_type", RATES).groupBy("event_type").agg(F.count("*").alias("kept"))
    full = rows.groupBy("event_type").agg(F.count("*").alias("n"))
    rate = F.when(F.col("event_type") == ATTACK, 1.0).otherwise(0.3)
    off = F.abs(F.coalesce("kept", F.lit(0)) - rate * F.col("n"))
    both = full.join(kept, "event_type", "left")
    return both.select("event_type", "n", (off <= 6 * F.sqrt(F.col("n") * rate * (1 - rate))).alias("within"))


@query(
    "sample_hash",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem
    WHERE CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber)), 1, 4) AS BIGINT)
        % 100 < 30""",
)
def sample_hash(spark, sf):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return hash_sample(table(spark, sf, "lineitem").select(*keys), keys)
