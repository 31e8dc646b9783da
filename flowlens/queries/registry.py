"""The query table and the inputs that several queries share."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` computes the same table and may refer to ``VIEWS`` as ``@name``."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- lineitem as labelled flows ---

FLOW_FEATURES = ["l_discount", "l_extendedprice", "l_quantity", "l_tax"]
BENIGN_FLOW = "R"


def flows(spark: SparkSession, sf: str) -> DataFrame:
    cols = [F.col(c) for c in FLOW_FEATURES]
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", *cols,
        F.col("l_returnflag").alias("label"),
    )


# --- the whole of lineitem with bad values written over good ones and copies of some rows added ---

def dirty(spark: SparkSession, sf: str) -> DataFrame:
    part = F.col("l_partkey")
    quantity = (
        F.when(part % 50 == 0, None)
        .when(part % 50 == 1, "Infinity")
        .when(part % 50 == 2, "-Infinity")
        .when(part % 50 == 3, "NaN")
        .when(part % 50 == 4, "abc")
        .otherwise(F.col("l_quantity").cast("string"))
    )
    base = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_shipdate",
        quantity.alias("q_txt"),
        F.col("l_extendedprice").cast("string").alias("p_txt"),
        F.when(part % 97 != 0, F.col("l_returnflag")).alias("label"),
    )
    copies = F.when(part % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return base.select("*", F.explode(copies).alias("copy")).drop("copy")  # one scan, where a union takes two


def typed(spark: SparkSession, sf: str) -> DataFrame:
    """The dirty rows with both text features as doubles."""
    return dirty(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_shipdate",
        F.col("q_txt").try_cast("double").alias("q"),
        F.col("p_txt").try_cast("double").alias("p"),
        "label",
    )


# --- events as scored rows ---

ATTACK = "error"


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        F.col("value").alias("score"),
        F.when(F.col("event_type") == ATTACK, 1).otherwise(0).alias("truth"),
    )


SCORED_SPLIT_DAY = 20


def calibration_part(df: DataFrame) -> DataFrame:
    return df.where(F.dayofmonth("ts") <= SCORED_SPLIT_DAY)


def held_out_part(df: DataFrame) -> DataFrame:
    return df.where(F.dayofmonth("ts") > SCORED_SPLIT_DAY)


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Events whose class is their type and part of the month, so that later days bring new classes."""
    part = F.floor(F.dayofmonth("ts") / 5).cast("string")
    label = F.concat_ws("-", "event_type", part)
    return scored(spark, sf).withColumn("label", F.when(F.col("score") >= 1, label))


# --- orders as a multiclass prediction ---

def multi(spark: SparkSession, sf: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    guess = F.when(priority == "1-URGENT", "O").when(priority == "2-HIGH", "P").otherwise("F")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("truth"), guess.alias("pred")
    )


# --- embeddings as clustered vectors ---

def vecs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("x"), F.col("label").alias("cluster_id")
    )


# --- events as the log of a stream with one batch per day ---

def daily_progress(spark: SparkSession, sf: str) -> DataFrame:
    """Progress rows whose figures are functions of the day's number and rows."""
    days = table(spark, sf, "events").groupBy(F.dayofmonth("ts").cast("long").alias("d")).agg(
        F.count("*").alias("n")
    )
    d, n = F.col("d"), F.col("n")
    return days.select(
        d.alias("batchId"),
        F.concat(F.lit("day "), d.cast("string")).alias("ts"),
        (n * 10 + (d * 7919) % 61000).alias("L_E2E_ms"),
        F.when(d % 10 == 0, F.lit(0.0)).otherwise(n / 8.0).alias("in_rate"),
        (n * (d % 5 + 7) / 64.0).alias("out_rate"),
        n.alias("numRows"),
        (d % 7).alias("t_read_ms"),
        (n * 9).alias("t_add_batch_ms"),
        (d % 3).alias("t_commit_ms"),
    )


# --- the same inputs in SQL ---

VIEWS = {
    "flows": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_discount,
        l_extendedprice, l_quantity, l_tax, l_returnflag AS label FROM lineitem""",
    "base": """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
        CASE WHEN l_partkey % 50 = 0 THEN NULL WHEN l_partkey % 50 = 1 THEN 'Infinity'
             WHEN l_partkey % 50 = 2 THEN '-Infinity' WHEN l_partkey % 50 = 3 THEN 'NaN'
             WHEN l_partkey % 50 = 4 THEN 'abc' ELSE CAST(l_quantity AS VARCHAR) END AS q_txt,
        CAST(l_extendedprice AS VARCHAR) AS p_txt,
        CASE WHEN l_partkey % 97 <> 0 THEN l_returnflag END AS label FROM lineitem""",
    "dirty": "SELECT * FROM @base UNION ALL SELECT * FROM @base WHERE l_partkey % 20 = 0",
    "typed": """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
        TRY_CAST(q_txt AS DOUBLE) AS q, TRY_CAST(p_txt AS DOUBLE) AS p, label FROM @dirty""",
    "valid": """SELECT * FROM @typed WHERE label IS NOT NULL AND q IS NOT NULL AND p IS NOT NULL
        AND NOT isnan(q) AND NOT isinf(q) AND NOT isnan(p) AND NOT isinf(p)""",
    "scored": f"""SELECT event_id, ts, user_id, event_type, value AS score,
        CASE WHEN event_type = '{ATTACK}' THEN 1 ELSE 0 END AS truth FROM events""",
    "calibration": f"SELECT * FROM @scored WHERE day(ts) <= {SCORED_SPLIT_DAY}",
    "held_out": f"SELECT * FROM @scored WHERE day(ts) > {SCORED_SPLIT_DAY}",
    "labelled": """SELECT *, CASE WHEN score >= 1 THEN event_type || '-' || CAST(day(ts) // 5 AS VARCHAR) END AS label
        FROM @scored""",
    "multi": """SELECT o_orderkey, o_orderstatus AS truth,
        CASE WHEN o_orderpriority = '1-URGENT' THEN 'O' WHEN o_orderpriority = '2-HIGH' THEN 'P'
             ELSE 'F' END AS pred FROM orders""",
    "elements": """SELECT vec_id, label AS cluster_id, unnest(range(1, 65)) AS pos,
        CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings""",
    "centroids": "SELECT cluster_id, pos, avg(x) AS c FROM @elements GROUP BY cluster_id, pos",
    "daily": "SELECT CAST(day(ts) AS BIGINT) AS d, count(*) AS n FROM events GROUP BY 1",
    "progress": """SELECT d AS "batchId", 'day ' || d AS ts, n * 10 + (d * 7919) % 61000 AS "L_E2E_ms",
        CASE WHEN d % 10 = 0 THEN CAST(0 AS DOUBLE) ELSE n / CAST(8 AS DOUBLE) END AS in_rate,
        n * (d % 5 + 7) / CAST(64 AS DOUBLE) AS out_rate, n AS "numRows", d % 7 AS t_read_ms,
        n * 9 AS t_add_batch_ms, d % 3 AS t_commit_ms FROM @daily""",
    "rated": """SELECT *, CASE WHEN in_rate > 0 THEN out_rate / in_rate ELSE CAST(0 AS DOUBLE) END AS r
        FROM @progress""",
    "sla": """SELECT "batchId", ts, "L_E2E_ms", round(in_rate, 1) AS "inputRps",
        round(out_rate, 1) AS "procRps", round(r, 3) AS ratio, "numRows",
        CASE WHEN "L_E2E_ms" > 60000 OR r < 1.0 THEN 'VIOLATION'
             WHEN "L_E2E_ms" > 35000 OR r < 1.1 THEN 'CRITICAL'
             WHEN "L_E2E_ms" > 22000 OR r < 1.2 THEN 'WARNING' ELSE 'OK' END AS status,
        t_read_ms, t_add_batch_ms, t_commit_ms FROM @rated""",
}


def with_views(sql: str) -> str:
    """Put the shared inputs a statement refers to as ``@name`` before it."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name in re.findall(r"@(\w+)", text):
            if name not in needed:
                add(VIEWS[name])
                needed.append(name)

    add(sql)
    body = sql.strip().replace("@", "")
    if not needed:
        return body
    views = ",\n".join(f"{name} AS ({VIEWS[name].replace('@', '')})" for name in needed)
    for start in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(start):
            return f"{start}{views},\n{body[len(start):]}"
    return f"WITH {views}\n{body}"
