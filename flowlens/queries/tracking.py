"""Service levels and batch history over a log with one batch per day of events."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.operators.ranking import nearest_rank
from flowlens.queries.registry import daily_progress, query, scored
from flowlens.streaming.sla import batch_trend, recent_batches, sla_percentiles, sla_records, sla_summary


@query("sla_status", "SELECT * FROM @sla")
def sla_status_query(spark, sf):
    return sla_records(daily_progress(spark, sf))


@query(
    "sla_summary",
    """SELECT count(*) AS batches, CAST(sum("numRows") AS BIGINT) AS total_rows, count(*) FILTER (status = 'OK') AS compliant,
    max("L_E2E_ms") AS max_latency_ms, arg_max("inputRps", "batchId") AS last_input_rps,
    arg_max("procRps", "batchId") AS last_proc_rps, arg_max(ratio, "batchId") AS last_ratio,
    arg_max(status, "batchId") AS last_status, CASE WHEN arg_max(ratio, "batchId") >= 1.2 THEN 'ok'
        WHEN arg_max(ratio, "batchId") >= 1.0 THEN 'warn' ELSE 'bad' END AS last_ratio_band,
    CASE WHEN max("L_E2E_ms") <= 42000 THEN 'ok' WHEN max("L_E2E_ms") >= 60000 THEN 'bad' ELSE 'warn' END AS max_latency_band
    FROM @sla""",
)
def sla_summary_query(spark, sf):
    return sla_summary(sla_records(daily_progress(spark, sf)))


def rank_sql(percent: int, col: str, source: str, value: str) -> str:
    return f"""(SELECT {value} FROM (SELECT {value}, row_number() OVER (ORDER BY {value}) AS k, count(*) OVER () AS n
        FROM {source}) r WHERE k = least(n, CAST(floor(n * {percent} / 100) AS BIGINT) + 1)) AS {col}"""


LATENCY = '"L_E2E_ms"'


@query(
    "sla_percentiles",
    f"""SELECT *, CASE WHEN p50 <= 9600 THEN 'ok' WHEN p50 >= 12000 THEN 'bad' ELSE 'warn' END AS p50_band,
    CASE WHEN p95 <= 17600 THEN 'ok' WHEN p95 >= 22000 THEN 'bad' ELSE 'warn' END AS p95_band,
    CASE WHEN p99 <= 22000 THEN 'ok' WHEN p99 >= 60000 THEN 'bad' ELSE 'warn' END AS p99_band FROM (SELECT
    {", ".join(rank_sql(p, f"p{p}", "(SELECT CAST(" + LATENCY + " AS DOUBLE) AS v FROM @sla)", "v") for p in (50, 95, 99))}) p""",
)
def sla_percentiles_query(spark, sf):
    return sla_percentiles(sla_records(daily_progress(spark, sf)))


@query("nearest_rank", f"""SELECT {", ".join(rank_sql(p, f"p{p}", "@scored", "score") for p in (1, 50, 95, 99, 100))}""")
def nearest_rank_query(spark, sf):
    """The same percentile rule over all event values."""
    return nearest_rank(scored(spark, sf), "score", [1, 50, 95, 99, 100])


@query(
    "recent_batches",
    f"""SELECT "batchId", "numRows", status FROM @sla ORDER BY "batchId" DESC LIMIT {K.SLA_HISTORY_SHOWN}""",
)
def recent_batches_query(spark, sf):
    log = sla_records(daily_progress(spark, sf))
    return recent_batches(log, K.SLA_HISTORY_SHOWN).select("batchId", "numRows", "status")


DAILY_RATE = """SELECT CAST(day(ts) AS BIGINT) AS batch_id, count(*) AS n, count(*) FILTER (truth = 1) AS anomalies,
    count(*) FILTER (truth = 1) / CAST(count(*) AS DOUBLE) * 100 AS rate FROM @scored GROUP BY 1"""


@query(
    "batch_trend",
    f"""SELECT batch_id, n, anomalies, round(rate, 6) AS rate, round(before, 6) AS previous_rate,
    CASE WHEN rate > before THEN 'up' WHEN rate < before THEN 'down' ELSE 'flat' END AS trend
    FROM (SELECT *, lag(rate, 1, CAST(0 AS DOUBLE)) OVER (ORDER BY batch_id) AS before FROM ({DAILY_RATE}) d) l""",
)
def batch_trend_query(spark, sf):
    days = scored(spark, sf).groupBy(F.dayofmonth("ts").cast("long").alias("batch_id")).agg(
        F.count("*").alias("n"), F.count_if(F.col("truth") == 1).alias("anomalies")
    )
    rated = days.withColumn("rate", F.col("anomalies") / F.col("n") * 100)
    return batch_trend(rated, "rate").withColumns({c: F.round(c, 6) for c in ("rate", "previous_rate")})
