"""Scans, sinks and column names."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.functions.names import normalized
from flowlens.operators.schema import (
    align_schema,
    cast_features,
    cast_failures,
    castable_profile,
    detect_numeric,
    normalize_columns,
    rename_guarded,
    schema_diff,
    union_by_name,
)
from flowlens.queries.registry import dirty, query, table
from flowlens.sources.csv import read_csv_files, read_raw_csv, read_raw_csv_by_name
from flowlens.sources.documents import (
    FEATURE_SCHEMA,
    append_metrics,
    read_doc,
    read_metrics,
    save_manifest,
    write_doc,
)
from flowlens.sources.tables import read_table, write_table
from flowlens.sources.wire import to_wire
from flowlens.workspace import shared_dir


def as_text(df):
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


@query(
    "scan_csv",
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_key, CAST(o_custkey AS VARCHAR) AS customer_key,
        o_orderstatus AS order_status, CAST(o_totalprice AS VARCHAR) AS total_prices,
        o_orderpriority AS order_priority FROM orders""",
)
def scan_csv(spark, sf):
    """Orders written as CSV with awkward headers, read back as text with normalised names."""
    path = shared_dir(spark, "csv")
    raw = as_text(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    ).toDF(" Order Key", "Customer  Key", "Order Status ", "Total Price/s", "ORDER Priority")
    raw.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(f"{path}/orders")
    # what the plans generate lies in a folder that scans leave out
    as_text(table(spark, sf, "region")).write.option("header", True).csv(f"{path}/processed/region")
    return read_raw_csv(spark, path).drop(K.SOURCE_FILE)


@query(
    "scan_csv_fallback",
    """SELECT CAST(c_custkey AS VARCHAR) AS key, 'Ünïcode ' || c_name AS name FROM customer
    UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'Größe ' || s_name FROM supplier""",
)
def scan_csv_fallback(spark, sf):
    """CSV files in two encodings: each is read in the first one that decodes it."""
    path = shared_dir(spark, "csv")
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("key"), F.concat(F.lit("Ünïcode "), "c_name").alias("name")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.concat(F.lit("Größe "), "s_name").alias("name"), F.col("s_suppkey").cast("string").alias("key")
    )
    customers.write.option("header", True).csv(f"{path}/customers")
    suppliers.write.option("header", True).option("encoding", "ISO-8859-1").csv(f"{path}/suppliers")
    return read_csv_files(spark, path, ("UTF-8", "ISO-8859-1")).drop(K.SOURCE_FILE)


@query(
    "scan_csv_by_name",
    """SELECT CAST(c_custkey AS VARCHAR) AS acct_key, c_name AS name, CAST(c_acctbal AS VARCHAR) AS balance,
        c_mktsegment AS segment FROM customer
    UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, CAST(s_acctbal AS VARCHAR), NULL FROM supplier""",
)
def scan_csv_by_name(spark, sf):
    """Two sets of CSV files with other headers in another order, united by name."""
    path = shared_dir(spark, "csv")
    customers = as_text(table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"))
    suppliers = as_text(table(spark, sf, "supplier").select("s_acctbal", "s_suppkey", "s_name"))
    customers.toDF("Acct Key", "Name", "Balance", "Segment").write.option("header", True).csv(f"{path}/customers")
    suppliers.toDF("balance", "ACCT KEY", "name").write.option("header", True).csv(f"{path}/suppliers")
    return read_raw_csv_by_name(spark, path).drop(K.SOURCE_FILE)


@query(
    "source_file_counts",
    """SELECT 'customer' AS source, count(*) AS n FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier
    UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem""",
)
def source_file_counts(spark, sf):
    """Rows per source file, from the file path each row carries."""
    paths = [f"{sf}/{t}.parquet" for t in ("customer", "supplier", "orders", "lineitem")]
    parts = [
        read_table(spark, p).select(F.col("_metadata.file_path").alias(K.SOURCE_FILE)) for p in paths
    ]
    source = F.regexp_extract(K.SOURCE_FILE, r"/(\w+)\.parquet", 1)
    return union_by_name(parts).groupBy(source.alias("source")).agg(F.count("*").alias("n"))


@query("parquet_roundtrip", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def parquet_roundtrip(spark, sf):
    path = shared_dir(spark, "table")
    write_table(table(spark, sf, "orders"), path, ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"])
    return read_table(spark, path)


@query(
    "report_roundtrip",
    """SELECT event_type, count(*) AS n, min(value) AS min_value, max(value) AS max_value
    FROM events GROUP BY event_type""",
)
def report_roundtrip(spark, sf):
    """A nested report written as a JSON document and read back."""
    path = shared_dir(spark, "report")
    stats = table(spark, sf, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.struct(F.min("value").alias("lo"), F.max("value").alias("hi")).alias("value")
    )
    write_doc(stats, path)
    doc = read_doc(spark, path, "event_type string, n long, value struct<lo: double, hi: double>")
    return doc.select("event_type", "n", F.col("value.lo").alias("min_value"), F.col("value.hi").alias("max_value"))


@query(
    "manifest_roundtrip",
    """SELECT CAST(pos AS INTEGER) AS pos, feature FROM (SELECT row_number() OVER (ORDER BY feature) - 1 AS pos, feature
    FROM (SELECT 'l_orderkey' AS feature FROM lineitem WHERE l_orderkey IS NOT NULL
          UNION SELECT 'l_linenumber' FROM lineitem WHERE l_linenumber IS NOT NULL
          UNION SELECT 'l_partkey' FROM lineitem WHERE l_partkey IS NOT NULL
          UNION SELECT 'p_txt' FROM lineitem WHERE l_extendedprice IS NOT NULL) f) r""",
)
def manifest_roundtrip(spark, sf):
    """The numeric columns found in the dirty table, frozen as a feature list and read back."""
    path = shared_dir(spark, "manifest")
    save_manifest(spark, detect_numeric(dirty(spark, sf), exclude=["label", "l_shipdate"]), path)
    return read_doc(spark, path, FEATURE_SCHEMA).select(F.posexplode("feature_cols").alias("pos", "feature"))


@query("metric_log_read", """SELECT "batchId", "numRows", "L_E2E_ms" FROM @progress""")
def metric_log_read(spark, sf):
    """A JSON-lines log in which some lines do not parse."""
    from flowlens.queries.registry import daily_progress

    path = shared_dir(spark, "log")
    log = daily_progress(spark, sf).select("batchId", "numRows", "L_E2E_ms")
    append_metrics(log, path)
    torn = log.select(F.substring(F.to_json(F.struct("*")), 1, 20).alias("value"))
    torn.write.mode("append").text(path)
    return read_metrics(spark, path, "batchId long, numRows long, L_E2E_ms long")


@query(
    "normalize_names",
    r"""SELECT p_partkey, regexp_replace(lower(regexp_replace(trim(raw), '\s+', '_', 'g')), '[^0-9a-z_]', '', 'g')
        AS name FROM (SELECT p_partkey, ' ' || p_name || '/s  (' || p_type || ') ' AS raw FROM part) p""",
)
def normalize_names(spark, sf):
    raw = F.concat(F.lit(" "), "p_name", F.lit("/s  ("), "p_type", F.lit(") "))
    return table(spark, sf, "part").select("p_partkey", normalized(raw).alias("name"))


@query(
    "normalize_columns",
    "SELECT c_custkey AS cust_key, c_name AS full_name, c_acctbal AS acctbal_s FROM customer",
)
def normalize_columns_query(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return normalize_columns(df.toDF(" Cust\tKey", "Full  Name ", "AcctBal_/s"))


@query(
    "homologate",
    """SELECT l_quantity AS total_fwd_packets, l_extendedprice AS max_packet_length, l_tax AS pkt_len_max,
        l_discount AS flow_duration FROM lineitem""",
)
def homologate(spark, sf):
    """Abbreviated names become feature names unless the feature already has a column."""
    df = table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("tot_fwd_pkts"),
        F.col("l_extendedprice").alias("max_packet_length"),
        F.col("l_tax").alias("pkt_len_max"),
        F.col("l_discount").alias("flow_duration"),
    )
    return rename_guarded(df)


@query(
    "detect_numeric",
    """SELECT "column", non_null, castable, non_null > 0 AND non_null = castable AS is_numeric FROM (
        SELECT 'l_orderkey' AS "column", count(l_orderkey) AS non_null, count(l_orderkey) AS castable FROM @dirty
        UNION ALL SELECT 'l_linenumber', count(l_linenumber), count(l_linenumber) FROM @dirty
        UNION ALL SELECT 'l_partkey', count(l_partkey), count(l_partkey) FROM @dirty
        UNION ALL SELECT 'q_txt', count(q_txt), count(TRY_CAST(q_txt AS DOUBLE)) FROM @dirty
        UNION ALL SELECT 'p_txt', count(p_txt), count(TRY_CAST(p_txt AS DOUBLE)) FROM @dirty
        UNION ALL SELECT 'flag', count(label), count(TRY_CAST(label AS DOUBLE)) FROM @dirty ) c""",
)
def detect_numeric_query(spark, sf):
    df = dirty(spark, sf).withColumnRenamed("label", "flag")
    return castable_profile(df, exclude=["l_shipdate"])


@query(
    "cast_features",
    """SELECT l_orderkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber, q AS q_txt, p AS p_txt, label FROM @typed""",
)
def cast_features_query(spark, sf):
    return cast_features(dirty(spark, sf), ["l_linenumber", "q_txt", "p_txt"], keep=["l_orderkey", "label"])


@query(
    "align_schema",
    """SELECT CAST(0 AS DOUBLE) AS a_missing, l_discount, CAST(0 AS DOUBLE) AS l_missing, l_quantity,
        l_returnflag AS label FROM lineitem""",
)
def align_schema_query(spark, sf):
    df = table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "label")
    return align_schema(df, ["a_missing", "l_discount", "l_missing", "l_quantity"], keep=["label"])


@query(
    "schema_diff",
    """SELECT 'q_txt' AS "column", 'extra' AS status, count(q_txt) AS non_null FROM @dirty
    UNION ALL SELECT 'p_txt', 'extra', count(p_txt) FROM @dirty
    UNION ALL SELECT 'l_missing', 'imputed', 0""",
)
def schema_diff_query(spark, sf):
    features = ["l_linenumber", "l_missing", "l_orderkey", "l_partkey"]
    return schema_diff(dirty(spark, sf), features, exclude=["label", "l_shipdate"])


@query(
    "union_by_name",
    """SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, NULL AS size FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, NULL FROM supplier
    UNION ALL SELECT p_partkey, p_name, p_retailprice, NULL, p_size FROM part""",
)
def union_by_name_query(spark, sf):
    customers = table(spark, sf, "customer").selectExpr(
        "c_custkey AS key", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment"
    )
    suppliers = table(spark, sf, "supplier").selectExpr("s_acctbal AS balance", "s_name AS name", "s_suppkey AS key")
    parts = table(spark, sf, "part").selectExpr(
        "p_size AS size", "p_partkey AS key", "p_name AS name", "p_retailprice AS balance"
    )
    return union_by_name([customers, suppliers, parts])


@query(
    "wire_encode",
    """SELECT CAST(l_linenumber AS VARCHAR) || ',' || CAST(l_quantity AS VARCHAR) || ',' || l_returnflag AS value
    FROM lineitem""",
)
def wire_encode(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_quantity", F.col("l_returnflag").alias("label"), "l_linenumber"
    )
    return to_wire(df)


FAILED_COLUMNS = {"q_txt": "q_txt", "p_txt": "p_txt", "flag": "label", "l_partkey": "l_partkey"}
FAILED_SQL = " UNION ALL ".join(
    f"""SELECT l_linenumber % 2 AS half, '{name}' AS "column", count(*) AS row_count, count(*) - count({c}) AS nulls,
    count(TRY_CAST({c} AS DOUBLE)) AS castable, count({c}) - count(TRY_CAST({c} AS DOUBLE)) AS failed FROM @dirty GROUP BY 1"""
    for name, c in FAILED_COLUMNS.items()
)


@query("cast_failures", FAILED_SQL)
def cast_failures_query(spark, sf):
    """Text that is no number told apart from missing values, by column and split."""
    rows = dirty(spark, sf).select((F.col("l_linenumber") % 2).alias("half"), *[F.col(c).alias(n) for n, c in FAILED_COLUMNS.items()])
    return cast_failures(rows, "half", exclude=[])
