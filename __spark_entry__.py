"""

Each query stands next to the ANSI SQL that must give the same rows. The given tables hold
no nulls and no untidy strings, so where an operator needs them they are derived from the
keys, in the same way on both sides, for every row of the table.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import millrace as m  # noqa: E402

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLE: dict[str, str] = {}


def query(sql: str):
    """Register a query under its function name together with its SQL."""

    def register(function):
        _QUERIES[function.__name__] = function
        _ORACLE[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return m.read_table(spark, f"{sf_dir}/{name}.parquet")


# --- untidy customers -----------------------------------------------------------------------

DIRTY = """
SELECT c_custkey,
  CASE c_custkey % 7 WHEN 0 THEN ' N/A ' WHEN 1 THEN '' WHEN 2 THEN '-' WHEN 3 THEN 'none'
    WHEN 4 THEN NULL ELSE '  ' || c_name || ' ' END AS raw_name,
  CASE c_custkey % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN 'n' WHEN 2 THEN 'TRUE' WHEN 3 THEN '0'
    WHEN 4 THEN ' yes' ELSE 'maybe' END AS raw_flag,
  CASE c_custkey % 4 WHEN 0 THEN 'abc' WHEN 1 THEN NULL
    ELSE CAST(c_custkey AS VARCHAR(20)) END AS raw_num
FROM customer
"""
WITH_DIRTY = f"WITH d AS ({DIRTY})"
NULLS = "('N/A', 'NA', 'null', 'NULL', 'none', 'None', '', '-')"


def nulled(column: str) -> str:
    return f"CASE WHEN {column} IN {NULLS} THEN NULL ELSE {column} END"


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    by7, by6, by4 = key % 7, key % 6, key % 4
    return table(spark, sf_dir, "customer").select(
        key,
        F.when(by7 == 0, " N/A ")
        .when(by7 == 1, "")
        .when(by7 == 2, "-")
        .when(by7 == 3, "none")
        .when(by7 > 4, F.concat(F.lit("  "), "c_name", F.lit(" ")))
        .alias("raw_name"),
        F.when(by6 == 0, "Yes")
        .when(by6 == 1, "n")
        .when(by6 == 2, "TRUE")
        .when(by6 == 3, "0")
        .when(by6 == 4, " yes")
        .otherwise("maybe")
        .alias("raw_flag"),
        F.when(by4 == 0, "abc").when(by4 > 1, key.cast("string")).alias("raw_num"),
    )


# --- column clean-up ------------------------------------------------------------------------


@query(
    f"""{WITH_DIRTY} SELECT c_custkey, trim(raw_name) AS raw_name, trim(raw_flag) AS raw_flag,
    trim(raw_num) AS raw_num FROM d"""
)
def trim_whitespace(spark, sf_dir):
    return dirty(spark, sf_dir).transform(m.trim_whitespace)


@query(
    f"""{WITH_DIRTY} SELECT c_custkey, {nulled('raw_name')} AS raw_name,
    {nulled('raw_flag')} AS raw_flag, {nulled('raw_num')} AS raw_num FROM d"""
)
def standardize_nulls(spark, sf_dir):
    return dirty(spark, sf_dir).transform(m.standardize_nulls)


@query(
    f"""{WITH_DIRTY}, t AS (SELECT c_custkey, trim(raw_name) AS raw_name,
    trim(raw_flag) AS raw_flag, trim(raw_num) AS raw_num FROM d)
    SELECT c_custkey AS cust_key, {nulled('raw_name')} AS raw_name,
    {nulled('raw_flag')} AS raw_flag_, {nulled('raw_num')} AS _raw_num FROM t"""
)
def cleanse_chain(spark, sf_dir):
    odd = dirty(spark, sf_dir).toDF(" Cust Key", "Raw Name", "Raw.Flag%", "#RAW num")
    return (
        odd.transform(m.trim_whitespace)
        .transform(m.standardize_nulls)
        .transform(m.normalize_column_names)
    )


@query(
    f"""{WITH_DIRTY} SELECT c_custkey, raw_name, raw_num,
    CASE WHEN lower(raw_flag) IN ('true', 'yes', 'y', '1') THEN TRUE
         WHEN lower(raw_flag) IN ('false', 'no', 'n', '0') THEN FALSE END AS raw_flag FROM d"""
)
def standardize_boolean(spark, sf_dir):
    return m.standardize_boolean(dirty(spark, sf_dir), ["raw_flag"])


@query(f"{WITH_DIRTY} SELECT * FROM d WHERE NOT (raw_name IS NULL AND raw_num IS NULL)")
def drop_empty_rows(spark, sf_dir):
    return m.drop_empty_rows(dirty(spark, sf_dir), ["raw_name", "raw_num"])


@query(
    """SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(month(o_orderdate) AS INTEGER) AS month FROM orders"""
)
def derive_partitions(spark, sf_dir):
    return m.derive_partitions(table(spark, sf_dir, "orders"), "o_orderdate")


@query(
    f"""{WITH_DIRTY} SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, raw_name, raw_flag,
    TRY_CAST(raw_num AS INTEGER) AS raw_num FROM d"""
)
def cast_to_schema(spark, sf_dir):
    declared = [{"name": "c_custkey", "type": "string"}, {"name": "raw_num", "type": "integer"}]
    return m.cast_to_schema(dirty(spark, sf_dir), declared)


# --- deduplication --------------------------------------------------------------------------

LINEITEM_REST = """l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST,
    l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
    l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST"""
LINE_KEY = ["l_orderkey", "l_linenumber"]


def first_row(source: str, keys: str, order: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
    PARTITION BY {keys} ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1"""


@query("SELECT DISTINCT text, lang, source, n_chars FROM documents")
def remove_duplicates_full(spark, sf_dir):
    return m.remove_duplicates(table(spark, sf_dir, "documents").drop("doc_id"))


@query(first_row("lineitem", "l_orderkey, l_linenumber", LINEITEM_REST))
def remove_duplicates_subset(spark, sf_dir):
    return m.remove_duplicates(table(spark, sf_dir, "lineitem"), LINE_KEY)


EVENT_REST = "event_id NULLS FIRST, event_type NULLS FIRST, value NULLS FIRST, props NULLS FIRST"


@query(first_row("events", "user_id", f"ts DESC NULLS LAST, {EVENT_REST}"))
def dedup_latest(spark, sf_dir):
    return m.window_dedup(table(spark, sf_dir, "events"), ["user_id"], "ts")


@query(first_row("events", "user_id", f"ts ASC NULLS FIRST, {EVENT_REST}"))
def dedup_earliest(spark, sf_dir):
    return m.window_dedup(table(spark, sf_dir, "events"), ["user_id"], "ts", descending=False)


@query(
    first_row(
        "orders",
        "o_custkey",
        """o_orderdate DESC NULLS LAST, o_orderkey NULLS FIRST, o_orderstatus NULLS FIRST,
        o_totalprice NULLS FIRST, o_orderpriority NULLS FIRST""",
    )
)
def dedup_ties(spark, sf_dir):
    return m.window_dedup(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate")


@query(
    first_row(
        """(SELECT *, md5(concat_ws('||', CAST(l_orderkey AS VARCHAR),
        CAST(l_linenumber AS VARCHAR))) AS _row_hash FROM lineitem)""",
        "_row_hash",
        f"l_orderkey NULLS FIRST, l_linenumber NULLS FIRST, {LINEITEM_REST}",
    )
)
def hash_dedup(spark, sf_dir):
    return m.hash_dedup(table(spark, sf_dir, "lineitem"), LINE_KEY)


@query(
    first_row(
        """(SELECT *, md5(concat_ws('||', coalesce(text, ''), coalesce(lang, ''))) AS _row_hash
        FROM documents)""",
        "_row_hash",
        "doc_id NULLS FIRST, text NULLS FIRST",
    )
)
def hash_dedup_text(spark, sf_dir):
    return m.hash_dedup(table(spark, sf_dir, "documents"), ["text", "lang"])


# --- quality --------------------------------------------------------------------------------

CLEAN = f"""SELECT c_custkey, {nulled('trim(raw_name)')} AS raw_name,
    {nulled('trim(raw_flag)')} AS raw_flag, {nulled('trim(raw_num)')} AS raw_num FROM d"""
CLEAN_COLUMNS = ["c_custkey", "raw_name", "raw_flag", "raw_num"]


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty(spark, sf_dir).transform(m.trim_whitespace).transform(m.standardize_nulls)


def rate_sql(source: str, columns: list[str], threshold: float) -> str:
    return " UNION ALL ".join(
        f"""SELECT 'null_rate' AS "check", '{c}' AS subject,
        CAST(count(*) - count({c}) AS DOUBLE) / count(*) AS observed,
        CAST({threshold} AS DOUBLE) AS threshold,
        CAST(count(*) - count({c}) AS DOUBLE) / count(*) <= {threshold} AS passed FROM {source}"""
        for c in columns
    )


def unique_sql(source: str, keys: list[str]) -> str:
    listed = ", ".join(keys)
    return f"""SELECT 'uniqueness' AS "check", '{listed}' AS subject,
    CAST(sum(n) - count(*) AS DOUBLE) AS observed, CAST(0 AS DOUBLE) AS threshold,
    sum(n) = count(*) AS passed
    FROM (SELECT count(*) AS n FROM {source} GROUP BY {listed})"""


def count_sql(source: str, minimum: int) -> str:
    return f"""SELECT 'row_count' AS "check", '*' AS subject, CAST(count(*) AS DOUBLE) AS observed,
    CAST({minimum} AS DOUBLE) AS threshold, count(*) >= {minimum} AS passed FROM {source}"""


@query(
    f"{WITH_DIRTY}, c AS ({CLEAN}) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS row_count, count(*) - count({c}) AS null_count,
        CAST(count(*) - count({c}) AS DOUBLE) / count(*) AS null_rate,
        CAST(count(*) - count({c}) AS DOUBLE) / count(*) <= 0.3 AS passed FROM c"""
        for c in CLEAN_COLUMNS
    )
)
def null_rates(spark, sf_dir):
    return m.null_rates(clean(spark, sf_dir), 0.3)


@query(
    """SELECT 'l_orderkey, l_linenumber' AS keys, CAST(sum(n) AS BIGINT) AS row_count,
    count(*) AS distinct_count, CAST(sum(n) - count(*) AS BIGINT) AS duplicate_count,
    sum(n) = count(*) AS passed
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"""
)
def uniqueness(spark, sf_dir):
    return m.uniqueness(table(spark, sf_dir, "lineitem"), LINE_KEY)


@query(
    """SELECT count(*) AS row_count, CAST(1000 AS BIGINT) AS row_count_min,
    count(*) >= 1000 AS passed FROM orders"""
)
def row_count_min(spark, sf_dir):
    return m.row_count_check(table(spark, sf_dir, "orders"), 1000)


@query(
    f"""{WITH_DIRTY}, c AS ({CLEAN}) {rate_sql('c', CLEAN_COLUMNS, 0.3)}
    UNION ALL {unique_sql('c', ['c_custkey'])} UNION ALL {count_sql('c', 1000)}"""
)
def quality_gate(spark, sf_dir):
    checks = {"null_threshold": 0.3, "uniqueness_keys": ["c_custkey"], "row_count_min": 1000}
    return m.quality_gate(clean(spark, sf_dir), checks)


LINE_COLUMNS = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]


@query(
    f"""WITH c AS ({first_row('lineitem', 'l_orderkey, l_linenumber',
    'l_shipdate DESC NULLS LAST, ' + LINEITEM_REST)})
    {rate_sql('c', LINE_COLUMNS, 0.05)}
    UNION ALL {unique_sql('c', LINE_KEY)} UNION ALL {count_sql('c', 1000)}"""
)
def quality_gate_after_dedup(spark, sf_dir):
    latest = m.window_dedup(table(spark, sf_dir, "lineitem"), LINE_KEY, "l_shipdate")
    return m.quality_gate(latest, {"uniqueness_keys": LINE_KEY, "row_count_min": 1000})


FLAGSHIP = f"""WITH t AS (SELECT event_id, ts, user_id, {nulled('trim(event_type)')} AS event_type,
    value, {nulled('trim(props)')} AS props FROM events),
    c AS ({first_row('t', 'user_id', 'ts DESC NULLS LAST, ' + EVENT_REST)})
    {rate_sql('c', ['event_id', 'ts', 'user_id', 'event_type', 'value', 'props'], 0.05)}
    UNION ALL {unique_sql('c', ['user_id'])} UNION ALL {count_sql('c', 10)}"""


@query(FLAGSHIP)
def latest_event_gate(spark, sf_dir):
    latest = (
        table(spark, sf_dir, "events")
        .transform(m.trim_whitespace)
        .transform(m.standardize_nulls)
        .transform(m.normalize_column_names)
        .transform(m.window_dedup, ["user_id"], "ts")
    )
    return m.quality_gate(latest, {"uniqueness_keys": ["user_id"], "row_count_min": 10})


@query(
    f"""WITH u AS ({first_row('lineitem', 'l_orderkey, l_linenumber', LINEITEM_REST)}),
    s AS (SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY 1),
    t AS (SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS q FROM u GROUP BY 1)
    SELECT l_returnflag, coalesce(s.n, 0) AS source_rows, coalesce(s.q, 0) AS source_l_quantity,
    coalesce(t.n, 0) AS target_rows, coalesce(t.q, 0) AS target_l_quantity,
    coalesce(s.n, 0) - coalesce(t.n, 0) AS diff_rows,
    coalesce(s.q, 0) - coalesce(t.q, 0) AS diff_l_quantity,
    coalesce(s.n, 0) = coalesce(t.n, 0) AND coalesce(s.q, 0) = coalesce(t.q, 0) AS matched
    FROM s FULL OUTER JOIN t USING (l_returnflag)"""
)
def reconcile(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    kept = m.remove_duplicates(lines, LINE_KEY)
    return m.reconcile(lines, kept, ["l_returnflag"], ["l_quantity"])


@query(
    f"""{WITH_DIRTY}
    SELECT 'c_custkey' AS "column", 'bigint' AS expected, FALSE AS nullable,
      count(*) AS row_count, count(*) - count(c_custkey) AS null_violations,
      CAST(0 AS BIGINT) AS cast_failures, count(*) = count(c_custkey) AS passed FROM d
    UNION ALL SELECT 'raw_name', 'string', FALSE, count(*), count(*) - count(raw_name),
      0, count(*) = count(raw_name) FROM d
    UNION ALL SELECT 'raw_num', 'int', TRUE, count(*), 0,
      count(raw_num) - count(TRY_CAST(raw_num AS INTEGER)),
      count(raw_num) = count(TRY_CAST(raw_num AS INTEGER)) FROM d
    UNION ALL SELECT 'email', 'string', FALSE, count(*), count(*), 0, count(*) = 0 FROM d"""
)
def contract_violations(spark, sf_dir):
    declared = [
        {"name": "c_custkey", "type": "long", "nullable": False},
        {"name": "raw_name", "type": "string", "nullable": False},
        {"name": "raw_num", "type": "integer", "nullable": True},
        {"name": "email", "type": "string", "nullable": False},
    ]
    return m.contract_violations(dirty(spark, sf_dir), declared)


@query(
    """SELECT 'session_id' AS "column", 'missing' AS kind, 'string' AS expected,
      CAST(NULL AS VARCHAR) AS actual, count(*) AS affected_rows FROM events
    UNION ALL SELECT 'props', 'new', NULL, 'string', count(props) FROM events
    UNION ALL SELECT 'ts', 'type', 'timestamp', 'timestamp_ntz',
      count(ts) - count(TRY_CAST(ts AS TIMESTAMP)) FROM events
    UNION ALL SELECT 'event_type', 'type', 'int', 'string',
      count(event_type) - count(TRY_CAST(event_type AS INTEGER)) FROM events
    UNION ALL SELECT 'user_id', 'type', 'string', 'bigint',
      count(user_id) - count(CAST(user_id AS VARCHAR)) FROM events"""
)
def schema_drift(spark, sf_dir):
    declared = [
        {"name": "event_id", "type": "long", "nullable": False},
        {"name": "ts", "type": "timestamp"},
        {"name": "user_id", "type": "string"},
        {"name": "event_type", "type": "integer"},
        {"name": "value", "type": "double"},
        {"name": "session_id", "type": "string"},
    ]
    return m.drift_report(table(spark, sf_dir, "events"), declared)


# --- sources and sinks ----------------------------------------------------------------------


@query(
    """SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(month(o_orderdate) AS INTEGER) AS month FROM orders"""
)
def partitioned_roundtrip(spark, sf_dir):
    """Write by month, then rerun one month, which must leave the others alone."""
    path = m.new_folder(spark, "orders")
    dated = m.derive_partitions(table(spark, sf_dir, "orders"), "o_orderdate")
    m.write_table(dated, path, partition_by=["year", "month"])
    rerun = dated.filter("year = 1996 AND month = 3")
    m.write_table(rerun, path, partition_by=["year", "month"])
    return m.read_table(spark, path)


@query(
    """SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
    WHERE year(o_orderdate) >= 1997"""
)
def partition_pruned_read(spark, sf_dir):
    path = m.new_folder(spark, "orders")
    dated = m.derive_partitions(table(spark, sf_dir, "orders"), "o_orderdate", ["year"])
    m.write_table(dated, path, partition_by=["year"])
    return m.read_table(spark, path).filter("year >= 1997")


@query("SELECT * FROM orders UNION ALL SELECT * FROM orders")
def append_roundtrip(spark, sf_dir):
    path = m.new_folder(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    m.write_table(orders, path, mode="error")
    m.write_table(orders, path, mode="append")
    m.write_table(orders, path, mode="ignore")
    return m.read_table(spark, path)


@query("SELECT * FROM customer")
def read_csv(spark, sf_dir):
    path = m.new_folder(spark, "customer")
    customers = table(spark, sf_dir, "customer")
    m.write_table(customers, path, "csv", options={"header": True})
    return m.read_table(spark, path, "csv", customers.schema, {"header": True})


@query("SELECT * FROM documents")
def read_json(spark, sf_dir):
    path = m.new_folder(spark, "documents")
    documents = table(spark, sf_dir, "documents")
    m.write_table(documents, path, "json")
    return m.read_table(spark, path, "json", documents.schema)


@query("SELECT *, DATE '2024-01-15' AS ingest_date FROM supplier")
def raw_landing(spark, sf_dir):
    root = m.new_folder(spark, "raw")
    path = m.land_raw(table(spark, sf_dir, "supplier"), root, "supplier", "2024-01-15")
    return m.read_table(spark, path)


# --- ledger ---------------------------------------------------------------------------------

# Every order is a run of its customer's job: it starts on the order date and, unless the
# order is open, ends some hours later.
LEDGER = """
SELECT CAST(o_custkey AS VARCHAR) AS job_name, CAST(o_orderkey AS VARCHAR) AS run_id,
  o_orderdate AS start_time,
  CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'P' THEN 'FAILED' ELSE 'RUNNING' END AS status,
  CASE WHEN o_orderstatus IN ('F', 'P')
    THEN o_orderdate + to_hours(CAST(1 + o_orderkey % 48 AS INTEGER)) END AS end_time,
  CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS rows_read,
  CASE WHEN o_orderstatus = 'F' THEN o_orderkey - o_orderkey % 10 END AS rows_written,
  CASE WHEN o_orderstatus = 'P' THEN repeat(o_orderpriority || ' failed. ', 100) END AS message
FROM orders
"""
RUNS = f"""WITH r AS (SELECT job_name, run_id, status, start_time, end_time, rows_read,
  rows_written, CAST(NULL AS VARCHAR) AS watermark, message AS error_message
  FROM ({LEDGER}))"""


def ledger_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    hours = (1 + F.col("o_orderkey") % 48).cast("int")
    done = F.when(status == "F", F.col("o_orderkey"))
    run = [
        F.col("o_custkey").cast("string").alias("job_name"),
        F.col("o_orderkey").cast("string").alias("run_id"),
    ]
    started = orders.select(
        *run, F.lit("RUNNING").alias("status"), F.col("o_orderdate").alias("event_time")
    )
    ended = orders.filter(status.isin("F", "P")).select(
        *run,
        F.when(status == "F", "SUCCESS").otherwise("FAILED").alias("status"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=hours)).alias("event_time"),
        done.alias("rows_read"),
        (done - done % 10).alias("rows_written"),
        F.when(status == "P", F.repeat(F.concat("o_orderpriority", F.lit(" failed. ")), 100)).alias(
            "error_message"
        ),
    )
    return started, ended


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = m.new_folder(spark, "ledger")
    for events in ledger_events(spark, sf_dir):
        m.append_run_events(events, path)
    return m.read_ledger(spark, path)


@query(f"{RUNS} SELECT * FROM r")
def run_state(spark, sf_dir):
    return m.run_state(ledger(spark, sf_dir))


@query(f"{RUNS} SELECT *, CAST(CASE status WHEN 'RUNNING' THEN 1 ELSE 2 END AS BIGINT) AS ledger_rows FROM r")
def ledger_compacted(spark, sf_dir):
    """Starts, successes and failures land one after another and are compacted in between; the
    files that were replaced are still there, and no row is counted twice."""
    started, ended = ledger_events(spark, sf_dir)
    path = m.new_folder(spark, "ledger")
    m.append_run_events(started, path)
    m.append_run_events(ended.filter("status = 'SUCCESS'"), f"{path}/succeeded")
    m.compact_ledger(spark, path, min_files=1)
    m.append_run_events(ended.filter("status = 'FAILED'"), f"{path}/failed")
    m.compact_ledger(spark, path, min_files=1)
    rows = m.read_ledger(spark, path)
    counted = rows.groupBy("job_name", "run_id").agg(F.count(F.lit(1)).alias("ledger_rows"))
    return m.run_state(rows).join(counted, ["job_name", "run_id"])


@query(
    f"""{RUNS} SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY job_name
    ORDER BY end_time DESC, run_id DESC) AS rn FROM r WHERE status = 'SUCCESS') WHERE rn = 1"""
)
def last_success(spark, sf_dir):
    return m.last_success(ledger(spark, sf_dir))


@query(
    f"""{RUNS} SELECT job_name, count(*) AS runs,
    count(*) FILTER (WHERE status = 'SUCCESS') AS succeeded,
    count(*) FILTER (WHERE status = 'FAILED') AS failed,
    count(*) FILTER (WHERE status = 'RUNNING') AS running,
    CAST(count(*) FILTER (WHERE status = 'SUCCESS') AS DOUBLE) / count(*) AS success_rate,
    CAST(coalesce(sum(rows_read), 0) AS BIGINT) AS rows_read,
    CAST(coalesce(sum(rows_written), 0) AS BIGINT) AS rows_written,
    CAST(sum(date_diff('second', start_time, end_time)) AS BIGINT) AS total_seconds,
    max(date_diff('second', start_time, end_time)) AS longest_seconds
    FROM r GROUP BY job_name"""
)
def run_metrics(spark, sf_dir):
    return m.run_metrics(ledger(spark, sf_dir))


@query("SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-10 00:00:00'")
def incremental_filter(spark, sf_dir):
    return m.incremental_filter(table(spark, sf_dir, "events"), "ts", "2024-01-10 00:00:00")


@query(
    """SELECT ts AS timestamp, 'user-' || CAST(user_id AS VARCHAR) AS job_name,
    event_type AS event, event_id AS rows_in, user_id AS rows_out
    FROM events WHERE event_type = 'error'"""
)
def event_log_errors(spark, sf_dir):
    """Every event as a line of a JSON log, then the error lines, newest first."""
    path = m.new_folder(spark, "log")
    events = table(spark, sf_dir, "events").select(
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("level"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("job_name"),
        F.col("event_type").alias("event"),
        F.col("event_id").alias("rows_in"),
        F.col("user_id").alias("rows_out"),
        F.col("props").alias("detail"),
    )
    m.append_log_events(events, path)
    return m.logged_events(m.read_event_log(spark, path))


# --- jobs and the curated layer -------------------------------------------------------------

RAW_ORDERS = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_key, o_custkey AS cust_key,
  CASE o_orderstatus WHEN 'P' THEN ' N/A' ELSE ' ' || o_orderstatus || '  ' END AS order_status,
  CAST(o_totalprice AS VARCHAR) AS total_price, o_orderdate AS order_date,
  '  ' || o_orderpriority AS order_priority
FROM orders
"""


@query(
    f"""WITH raw AS ({RAW_ORDERS}), c AS (SELECT {nulled('trim(order_key)')} AS order_key, cust_key,
      {nulled('trim(order_status)')} AS order_status, {nulled('trim(total_price)')} AS total_price,
      order_date, {nulled('trim(order_priority)')} AS order_priority FROM raw),
    u AS ({first_row('c', 'cust_key', '''order_date DESC NULLS LAST, order_key NULLS FIRST,
      order_status NULLS FIRST, total_price NULLS FIRST, order_priority NULLS FIRST''')})
    SELECT CAST(order_key AS BIGINT) AS order_key, cust_key, order_status,
      CAST(total_price AS DOUBLE) AS total_price, order_date, order_priority,
      CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month
    FROM u"""
)
def staging_job(spark, sf_dir):
    """The whole configured job: read, drift, cleanse, newest per key, cast, gate, write."""
    orders = table(spark, sf_dir, "orders")
    raw = orders.select(
        F.col("o_orderkey").cast("string").alias("Order Key"),
        F.col("o_custkey").alias("Cust Key"),
        F.when(F.col("o_orderstatus") == "P", " N/A")
        .otherwise(F.concat(F.lit(" "), "o_orderstatus", F.lit("  ")))
        .alias("Order Status"),
        F.col("o_totalprice").cast("string").alias("Total.Price"),
        F.col("o_orderdate").alias("Order-Date"),
        F.concat(F.lit("  "), "o_orderpriority").alias("ORDER_PRIORITY"),
    )
    root = m.new_folder(spark, "job")
    m.write_table(raw, f"{root}/raw")
    run = {
        "job_name": "orders_raw_to_staging",
        "source": {"path": f"{root}/raw"},
        "target": {"path": f"{root}/staging", "partition_by": ["year", "month"]},
        "schema": {
            "fields": [
                {"name": "order_key", "type": "long", "nullable": False},
                {"name": "cust_key", "type": "long", "nullable": False},
                {"name": "order_status", "type": "string"},
                {"name": "total_price", "type": "double"},
                {"name": "order_date", "type": "timestamp_ntz"},
                {"name": "order_priority", "type": "string"},
            ]
        },
        "transforms": [
            "cleanse",
            "deduplicate",
            "cast",
            {"step": "derive_partitions", "column": "order_date"},
        ],
        "dedup": {"partition_by": ["cust_key"], "order_by": "order_date"},
        "quality_checks": {
            "null_threshold": 0.9,
            "uniqueness_keys": ["cust_key"],
            "row_count_min": 100,
        },
        "ledger": f"{root}/ledger",
        "event_log": f"{root}/log",
    }
    m.run_pipeline(spark, run)
    return m.read_table(spark, f"{root}/staging")


@query(
    """SELECT c.*, n.n_name, n.n_regionkey FROM customer c
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""
)
def enrich_lookup(spark, sf_dir):
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return m.enrich(customers, nations, {"c_nationkey": "n_nationkey"})


@query(
    f"""WITH o AS (SELECT o_custkey, o_totalprice, o_orderdate FROM orders),
    u AS ({first_row('o', 'o_custkey', 'o_orderdate DESC NULLS LAST, o_totalprice NULLS FIRST')})
    SELECT c.*, u.o_orderdate, u.o_totalprice FROM customer c
    LEFT JOIN u ON c.c_custkey = u.o_custkey"""
)
def enrich_newest(spark, sf_dir):
    """A lookup that repeats its key: each customer gets its newest order."""
    return m.enrich(
        table(spark, sf_dir, "customer"),
        table(spark, sf_dir, "orders"),
        {"c_custkey": "o_custkey"},
        columns=["o_orderdate", "o_totalprice"],
        order_by="o_orderdate",
    )


STAR = """
SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, l.l_discount,
  o.o_custkey, o.o_orderdate, c.c_mktsegment, n.n_name, r.r_name
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""


def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales lines with their order, customer, nation and region.

    The chain is joined from its far end, so that the lines, the largest table, are
    shuffled once at most. That the key of the orders is unique is proved by a group-by over
    the key alone, so the orders themselves are shuffled only for their two joins.
    """
    nations = m.fact_table(
        table(spark, sf_dir, "nation"),
        [m.Link(table(spark, sf_dir, "region"), {"n_regionkey": "r_regionkey"})],
    )
    customers = m.fact_table(
        m.dimension(
            table(spark, sf_dir, "customer"), ["c_custkey"], ["c_mktsegment", "c_nationkey"]
        ),
        [m.Link(nations, {"c_nationkey": "n_nationkey"}, ["n_name", "r_name"])],
    )
    orders = m.fact_table(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"),
        [
            m.Link(
                customers,
                {"o_custkey": "c_custkey"},
                ["c_mktsegment", "n_name", "r_name"],
                unique=True,
            )
        ],
    )
    proved = m.uniqueness(table(spark, sf_dir, "orders"), ["o_orderkey"]).first()["passed"]
    return m.fact_table(
        table(spark, sf_dir, "lineitem"),
        [m.Link(orders, {"l_orderkey": "o_orderkey"}, unique=proved)],
        [
            "l_orderkey",
            "l_linenumber",
            "l_quantity",
            "l_extendedprice",
            "l_discount",
            "o_custkey",
            "o_orderdate",
            "c_mktsegment",
            "n_name",
            "r_name",
        ],
    )


@query(STAR)
def star_fact(spark, sf_dir):
    return star(spark, sf_dir)


@query(
    f"""SELECT r_name, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS lines,
    sum(l_quantity) AS quantity,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(12, 2)) * (1 - CAST(l_discount AS DECIMAL(4, 2))))
      AS DOUBLE) AS revenue
    FROM ({STAR}) GROUP BY 1, 2"""
)
def curated_view(spark, sf_dir):
    """Revenue per region and year, kept as a table partitioned by year."""
    path = m.new_folder(spark, "view")
    dated = m.derive_partitions(star(spark, sf_dir), "o_orderdate", ["year"])
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    m.refresh_view(
        dated,
        path,
        ["r_name", "year"],
        {
            "lines": F.count(F.lit(1)),
            "quantity": F.sum("l_quantity"),
            "revenue": F.sum(price * (1 - discount)).cast("double"),
        },
        partition_by=["year"],
    )
    return m.read_table(spark, path)


# --- reruns and contracts -------------------------------------------------------------------


@query(
    f"""SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(month(o_orderdate) AS INTEGER) AS month FROM ({first_row('orders', 'o_custkey',
    'o_orderdate DESC, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority')})"""
)
def staging_reload(spark, sf_dir):
    """Newest order per customer by month: loaded to the end of 1995, then loaded with all."""
    orders = table(spark, sf_dir, "orders")
    root = m.new_folder(spark, "reload")
    job = {
        "job_name": "newest_orders",
        "source": {"path": f"{root}/raw"},
        "target": {"path": f"{root}/newest", "partition_by": ["year", "month"]},
        "transforms": ["deduplicate", {"step": "derive_partitions", "column": "o_orderdate"}],
        "dedup": {"partition_by": ["o_custkey"], "order_by": "o_orderdate"},
        "quality_checks": {"uniqueness_keys": ["o_custkey"], "reconcile": True},
        "ledger": f"{root}/ledger",
    }
    for source in (orders.filter("o_orderdate < '1996-01-01'"), orders):
        m.write_table(source, f"{root}/raw")
        m.run_pipeline(spark, job)
    return m.read_table(spark, job["target"]["path"])


@query("SELECT * FROM events")
def incremental_reload(spark, sf_dir):
    """All events in three arrivals that share times, the second run twice under one run id."""
    events = table(spark, sf_dir, "events")
    root = m.new_folder(spark, "increments")
    job = {
        "job_name": "events",
        "source": {"path": f"{root}/raw/events", "incremental": {"column": "ingest_date"}},
        "target": {"path": f"{root}/events", "mode": "append"},
        "transforms": [],
        "ledger": f"{root}/ledger",
    }
    third = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for day, run_ids in enumerate((["first"], ["second", "second"], [None])):
        m.land_raw(events.filter(third == day), f"{root}/raw", "events", f"2024-02-0{day + 1}")
        for run_id in run_ids:
            m.run_pipeline(spark, job, run_id)
    return m.read_table(spark, f"{root}/events").drop("ingest_date", "run_id")


@query("SELECT * FROM events")
def incremental_replay(spark, sf_dir):
    """All events landed on three days; the second run is repeated after the third day has
    landed and once more at the end, and reads its own interval each time."""
    events = table(spark, sf_dir, "events")
    root = m.new_folder(spark, "replays")
    job = {
        "job_name": "events",
        "source": {"path": f"{root}/raw/events", "incremental": {"column": "ingest_date"}},
        "target": {"path": f"{root}/events", "mode": "append"},
        "transforms": [],
        "ledger": f"{root}/ledger",
    }
    third = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for day, run_ids in enumerate((["first"], ["second"], ["second", "third", "second"])):
        m.land_raw(events.filter(third == day), f"{root}/raw", "events", f"2024-02-0{day + 1}")
        for run_id in run_ids:
            m.run_pipeline(spark, job, run_id)
    return m.read_table(spark, f"{root}/events").drop("ingest_date", "run_id")


@query(
    """SELECT 'reconcile' AS "check", "check" || ', ' || kind AS subject, observed,
      observed AS threshold, true AS passed
    FROM (SELECT 'rows' AS "check", event_type AS kind, CAST(count(*) AS DOUBLE) AS observed
      FROM events GROUP BY event_type
      UNION ALL SELECT 'cents', event_type, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE)
      FROM events GROUP BY event_type)"""
)
def append_reconciled(spark, sf_dir):
    """The gate lines of an appending run whose id looks like a number."""
    root = m.new_folder(spark, "reconciled")
    cents = F.round(F.col("value") * 100).cast("long").alias("cents")
    table(spark, sf_dir, "events").select("*", cents).write.parquet(f"{root}/raw")
    job = {
        "job_name": "events",
        "source": {"path": f"{root}/raw"},
        "target": {"path": f"{root}/events", "mode": "append"},
        "transforms": [],
        "quality_checks": {
            "null_threshold": 1,
            "reconcile": {"group_by": ["event_type"], "sums": ["cents"]},
        },
    }
    for run_id in ("006", "007"):
        run = m.run_pipeline(spark, job, run_id)
    lines = [tuple(q) for q in run.quality if q.check == "reconcile"]
    kinds = "check string, subject string, observed double, threshold double, passed boolean"
    return spark.createDataFrame(lines, kinds)


DIRTY_CONTRACT = [
    {"name": "c_custkey", "type": "long", "nullable": False},
    {"name": "raw_name", "type": "string", "nullable": False},
    {"name": "raw_num", "type": "int", "nullable": False},
    {"name": "absent", "type": "string", "nullable": False},
]


@query(
    f"""{WITH_DIRTY}, n AS (SELECT count(*) AS n, count(raw_name) AS names, count(raw_num) AS nums,
      count(*) FILTER (WHERE raw_num IS NOT NULL AND TRY_CAST(raw_num AS INTEGER) IS NULL) AS lost
      FROM d), v AS (
      SELECT 'contract_cast' AS "check", 'c_custkey' AS subject, 0 AS observed FROM n
      UNION ALL SELECT 'contract_cast', 'raw_name', 0 FROM n
      UNION ALL SELECT 'contract_cast', 'raw_num', lost FROM n
      UNION ALL SELECT 'contract_cast', 'absent', 0 FROM n
      UNION ALL SELECT 'contract_null', 'c_custkey', 0 FROM n
      UNION ALL SELECT 'contract_null', 'raw_name', n - names FROM n
      UNION ALL SELECT 'contract_null', 'raw_num', n - nums FROM n
      UNION ALL SELECT 'contract_null', 'absent', n FROM n)
    SELECT "check", subject, CAST(observed AS DOUBLE) AS observed, CAST(0 AS DOUBLE) AS threshold,
      observed = 0 AS passed FROM v"""
)
def contract_gate(spark, sf_dir):
    return m.contract_gate(dirty(spark, sf_dir), DIRTY_CONTRACT)


@query(
    """WITH o AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS y, count(*) AS n,
      CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total,
      count(*) FILTER (WHERE o_orderstatus <> 'P') AS kept,
      CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18, 2))) FILTER (WHERE o_orderstatus <> 'P'), 0)
        AS DOUBLE) AS kept_total
      FROM orders GROUP BY 1)
    SELECT 'reconcile' AS "check", 'rows, ' || y AS subject, CAST(kept AS DOUBLE) AS observed,
      CAST(n AS DOUBLE) AS threshold, kept = n AS passed FROM o
    UNION ALL SELECT 'reconcile', 'price, ' || y, kept_total, total, kept_total = total FROM o"""
)
def reconcile_gate(spark, sf_dir):
    """Orders against the copy that lost its pending ones, per year, as gate lines."""
    orders = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        "o_orderstatus",
    )
    written = orders.filter("o_orderstatus <> 'P'")
    return m.reconcile_lines(m.reconcile(orders, written, ["year"], ["price"]), ["year"])


# --- tables that follow their source ------------------------------------------------------------

VIEW = {
    "group_by": ["year", "priority"],
    "measures": {
        "orders": "count",
        "total": ("sum", "price"),
        "mean": ("avg", "price"),
        "least": ("min", "price"),
        "most": ("max", "price"),
    },
}
#: Of 1997's orders every seventh is replaced: another priority, twice the price.
CHANGED = "year(o_orderdate) = 1997 AND o_orderkey % 7 = 0"


@query(
    f"""WITH o AS (SELECT year(o_orderdate) AS y, {CHANGED} AS c, o_orderpriority AS p,
      CAST(o_totalprice AS DECIMAL(18, 2)) AS price FROM orders)
    SELECT CAST(y AS INTEGER) AS "year", CASE WHEN c THEN '0-NEW' ELSE p END AS priority, count(*) AS orders,
      CAST(sum(CASE WHEN c THEN 2 * price ELSE price END) AS DOUBLE) AS total,
      CAST(sum(CASE WHEN c THEN 2 * price ELSE price END) AS DOUBLE) / count(*) AS mean,
      CAST(min(CASE WHEN c THEN 2 * price ELSE price END) AS DOUBLE) AS least,
      CAST(max(CASE WHEN c THEN 2 * price ELSE price END) AS DOUBLE) AS most
    FROM o GROUP BY ALL"""
)
def view_delta(spark, sf_dir):
    """A kept aggregate after two changes: every tenth order comes later, some are replaced."""
    path = f"{m.new_folder(spark, 'views')}/orders"
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr(CHANGED).alias("changed"),
        F.year("o_orderdate").alias("year"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
    )
    price = F.when(F.col("changed"), F.col("price") * 2).otherwise(F.col("price"))
    after = orders.withColumns(
        {
            "priority": F.when(F.col("changed"), "0-NEW").otherwise(F.col("priority")),
            "price": price.cast("decimal(18,2)"),
        }
    )
    late = F.col("o_orderkey") % 10 == 0
    m.create_view(orders.filter(~late), path, **VIEW, partition_by=["year"])
    m.apply_delta(path, **VIEW, added=orders.filter(late), partition_by=["year"], run_id="late")
    m.apply_delta(
        path,
        **VIEW,
        added=after.filter("changed"),
        removed=orders.filter("changed"),
        source=after,
        partition_by=["year"],
        run_id="replaced",
    )
    view = m.read_view(spark, path, **VIEW)
    return view.withColumns({c: F.col(c).cast("double") for c in ("total", "least", "most")})


@query(
    """WITH c AS (SELECT o_custkey AS k, o_orderdate AS t, max(o_orderpriority) AS p
      FROM orders WHERE o_orderkey % 3 = 0 GROUP BY ALL),
    h AS (SELECT k, t, p FROM (SELECT *, lag(p) OVER (PARTITION BY k ORDER BY t) AS q FROM c)
      WHERE q IS DISTINCT FROM p)
    SELECT o_orderkey, o_custkey, o_orderdate, p AS priority, t AS since
    FROM orders ASOF LEFT JOIN h ON o_custkey = k AND o_orderdate >= t"""
)
def fact_as_of(spark, sf_dir):
    """Orders with the priority their customer had at the time; priorities change by every third order."""
    orders = table(spark, sf_dir, "orders")
    changes = orders.filter("o_orderkey % 3 = 0").withColumnRenamed("o_orderpriority", "priority")
    history = m.version_history(changes, ["o_custkey"], "o_orderdate", ["priority"])
    history = history.withColumn("since", F.col("valid_from"))
    facts = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return m.as_of_join(facts, history, ["o_custkey"], "o_orderdate", columns=["priority", "since"])


@query(
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus
    FROM orders WHERE o_orderkey % 11 <> 0 OR o_orderkey % 5 = 0
    UNION ALL SELECT o_orderkey + 10000000, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 13 = 0"""
)
def cdc_merge(spark, sf_dir):
    """Orders after two lots of changes: updates and rows that come too late, then inserts and
    deletions, of which those older than an update do nothing."""
    path = f"{m.new_folder(spark, 'kept')}/orders"
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("year")
    )
    rule = {"key": ["o_orderkey"], "sequence": "seq", "partition_by": ["year"]}

    def changes(where, operation, seq, **columns):
        rows = orders.filter(where).withColumns({n: F.expr(e) for n, e in columns.items()})
        return rows.withColumns({"operation": F.lit(operation), "seq": F.lit(seq)})

    m.apply_changes(changes("true", "insert", 1), path, **rule)
    late = changes("o_orderkey % 7 = 0", "update", 0, o_orderstatus="'L'")
    m.apply_changes(changes("o_orderkey % 5 = 0", "update", 3, o_orderstatus="'X'").union(late), path, **rule)
    more = changes("o_orderkey % 13 = 0", "insert", 1, o_orderkey="o_orderkey + 10000000")
    m.apply_changes(changes("o_orderkey % 11 = 0", "delete", 2).union(more), path, **rule)
    return m.read_kept(spark, path).drop("year", "seq")


@query(
    """SELECT o_orderkey, 'missing' AS status FROM orders WHERE o_orderkey % 101 = 0
    UNION ALL SELECT o_orderkey, 'changed' FROM orders WHERE o_orderkey % 89 = 0 AND o_orderkey % 101 <> 0
    UNION ALL SELECT o_orderkey + 10000000, 'added' FROM orders WHERE o_orderkey % 97 = 0"""
)
def reconcile_rows(spark, sf_dir):
    """Orders against a copy that lost some, has others besides, and other prices for some."""
    orders = table(spark, sf_dir, "orders")
    copy = orders.filter("o_orderkey % 101 <> 0").withColumn(
        "o_totalprice", F.expr("CASE WHEN o_orderkey % 89 = 0 THEN o_totalprice + 1 ELSE o_totalprice END")
    )
    more = orders.filter("o_orderkey % 97 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 10000000)
    return m.reconcile_rows(orders, copy.unionByName(more), ["o_orderkey"])


@query("SELECT * FROM events")
def stream_landing(spark, sf_dir):
    """Events that arrive in three lots, each landed twice, as a stream that leaves out duplicates."""
    events = table(spark, sf_dir, "events")
    root = m.new_folder(spark, "stream")
    third = events.agg(F.expr("percentile_approx(unix_micros(cast(ts AS timestamp)), array(0.33, 0.66), 100)"))
    low, high = third.first()[0]
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    for lot in (at <= low, (at > low) & (at <= high), at > high):
        for _ in range(2):
            m.write_table(events.filter(lot), f"{root}/raw", mode="append")
            m.land_stream(
                spark, f"{root}/raw", events.schema, f"{root}/events", f"{root}/progress", ["event_id"], "ts", "60 days"
            )
    return m.read_table(spark, f"{root}/events").drop("batch_id")


@query(
    """SELECT 'user_id' AS "column", count(*) AS row_count, count(*) - count(user_id) AS null_count,
      CAST(min(user_id) AS VARCHAR) AS min_value, CAST(max(user_id) AS VARCHAR) AS max_value FROM events
    UNION ALL SELECT 'value', count(*), count(*) - count(value), CAST(min(value) AS VARCHAR),
      CAST(max(value) AS VARCHAR) FROM events
    UNION ALL SELECT 'props', count(*), count(*) - count(props), min(props), max(props) FROM events"""
)
def profile_merged(spark, sf_dir):
    """Profiles of events kept by type; the last type is appended and only it is profiled anew."""
    events, columns = table(spark, sf_dir, "events"), ["user_id", "value", "props"]
    path = f"{m.new_folder(spark, 'profiles')}/events"
    m.refresh_profiles(events.filter("event_type <> 'error'"), path, ["event_type"], columns)
    m.refresh_profiles(events.filter("event_type = 'error'"), path, ["event_type"], columns)
    return m.merged_profile(m.read_profiles(spark, path), columns).drop("distinct_count")


@query(
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS suppkey,
      s_name FROM lineitem LEFT JOIN supplier
      ON s_suppkey = CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END"""
)
def enrich_hot(spark, sf_dir):
    """Lines with the name of their supplier, where one supplier has a third of all lines."""
    key = F.expr("CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", key.alias("suppkey"))
    return m.enrich_hot(lines, table(spark, sf_dir, "supplier"), {"suppkey": "s_suppkey"}, ["s_name"])


@query(
    """WITH t AS (SELECT user_id, ts, count(*) FILTER (event_type = 'error') AS n FROM events GROUP BY ALL),
    i AS (SELECT *, lead(ts) OVER w AS after, sum(CASE WHEN n = 0 THEN 1 ELSE 0 END) OVER w AS island
      FROM t WINDOW w AS (PARTITION BY user_id ORDER BY ts))
    SELECT user_id, min(ts) AS started, max(ts) AS ended, CAST(sum(n) AS BIGINT) AS failures,
      CASE WHEN count(after) = count(*) THEN max(after) END AS recovered_at,
      date_sub('second', min(ts), CASE WHEN count(after) = count(*) THEN max(after) END) AS seconds_to_recover
    FROM i WHERE n > 0 GROUP BY user_id, island"""
)
def failure_episodes(spark, sf_dir):
    """Runs of errors of each user, and the seconds until an event without one."""
    return m.failure_episodes(table(spark, sf_dir, "events"), ["user_id"], "ts", F.col("event_type") == "error")


@query(
    """SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate,
      CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority END AS o_orderpriority,
      CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END AS status,
      CASE WHEN o_orderkey % 3 = 2 THEN o_custkey END AS cust FROM orders"""
)
def schema_evolution(spark, sf_dir):
    """Orders written in three generations, with wider types and new fields from one to the next."""
    orders, root = table(spark, sf_dir, "orders"), m.new_folder(spark, "generations")
    generations = [
        ["int(o_orderkey) AS o_orderkey", "CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice",
         "date(o_orderdate) AS o_orderdate"],
        ["o_orderkey", "CAST(o_totalprice AS DECIMAL(14,3)) AS o_totalprice",
         "CAST(o_orderdate AS TIMESTAMP_NTZ) AS o_orderdate", "o_orderpriority",
         "named_struct('status', o_orderstatus) AS info"],
        ["o_orderkey", "o_totalprice", "CAST(o_orderdate AS TIMESTAMP_NTZ) AS o_orderdate",
         "named_struct('status', o_orderstatus, 'cust', o_custkey) AS info"],
    ]
    for i, columns in enumerate(generations):
        orders.filter(f"o_orderkey % 3 = {i}").selectExpr(*columns).write.parquet(f"{root}/{i}")
    read = m.read_generations(spark, [f"{root}/{i}" for i in range(3)])
    return read.select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority", "info.status", "info.cust")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
    WHERE l_partkey BETWEEN 20 AND 60 AND l_quantity BETWEEN 10 AND 14"""
)
def clustered_read(spark, sf_dir):
    """Lines clustered by part and quantity, read by a range of both."""
    path = f"{m.new_folder(spark, 'clustered')}/lineitem"
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    m.write_table(m.cluster_by(lines, ["l_partkey", "l_quantity"], 16), path)
    return m.read_table(spark, path).filter("l_partkey BETWEEN 20 AND 60 AND l_quantity BETWEEN 10 AND 14")


# --- driver contract ------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """The quality gate over each user's newest event."""
    return latest_event_gate(spark, "/root/testdata/sf0.001")


def _training_data() -> tuple[dict[str, Callable], dict[str, str]]:
    """The queries of subpackage llm and of its pipeline; nothing where these are not there."""
    try:
        import corpus_pipeline
        from millrace.llm import queries as llm
    except ModuleNotFoundError as missing:
        if missing.name not in ("millrace.llm", "corpus_pipeline"):
            raise
        return {}, {}
    found, sql = dict(llm.QUERIES), dict(llm.ORACLE)
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    return _ORACLE | _training_data()[1]
