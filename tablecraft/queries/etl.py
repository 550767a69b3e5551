"""Registered queries: jobs on tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tablecraft.operators import aggregates as A
from tablecraft.operators import etl as L
from tablecraft.plans.registry import query, rounded
from tablecraft.plans.storage import path_exists, shared_dir


@query("et1_publish", "SELECT * FROM customer WHERE c_acctbal >= 0")
def publish(t):
    root = shared_dir(t.spark, "dim-customer")
    L.publish(t.customer, root)
    L.publish(t.customer.filter("c_acctbal >= 0"), root)
    try:
        L.publish(t.customer.filter("c_acctbal < 0"), root, min_rows=t.customer.count())
    except L.GateFailed:
        pass  # the published table is untouched
    return L.current(t.spark, root, t.customer.schema)


@query("et1_rollback", "SELECT * FROM customer")
def rollback(t):
    root = shared_dir(t.spark, "dim-customer")
    L.publish(t.customer, root)
    L.publish(t.customer.filter("c_acctbal >= 0"), root)
    L.rollback(t.spark, root)
    return L.current(t.spark, root, t.customer.schema)


@query(
    "et2_run_job",
    """
    SELECT 'sales_load' AS job_name, 'SUCCESS' AS status, count(*) AS rows_affected, CAST(1 AS BIGINT) AS run_ids,
           count(*) AS stamped_rows, TRUE AS ended FROM orders
    """,
)
def run_job(t):
    target, history = shared_dir(t.spark, "fact-sales"), shared_dir(t.spark, "job-history")
    L.run_job(t.spark, "sales_load", lambda: t.orders, target, history)
    loaded = t.spark.read.parquet(target)
    stamped = loaded.agg(F.count_distinct("etl_run_id").alias("run_ids"), F.count("etl_run_id").alias("stamped_rows"))
    log = L.job_history(t.spark, history).select(
        "job_name", "status", "rows_affected", (F.col("end_time") >= F.col("start_time")).alias("ended")
    )
    return L.with_scalars(log, stamped)


@query(
    "et3_quality_metrics",
    """
    SELECT count(*) AS total_rows, count(*) - count(custkey) AS null_custkey, round(sum(o_totalprice), 2) AS total_o_totalprice
    FROM (SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS custkey, o_totalprice FROM orders)
    """,
)
def quality_metrics(t):
    rows = t.orders.select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("custkey"), "o_totalprice"
    )
    return rounded(L.quality_metrics(rows, ["custkey"], ["o_totalprice"]), 2, "total_o_totalprice")


@query("et3_gated_load", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def gated_load(t):
    staged = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    L.quality_gate(staged, ["o_custkey"], ["o_totalprice"])
    path = shared_dir(t.spark, "fact-revenue")
    staged.write.parquet(path)
    return t.spark.read.parquet(path)


@query(
    "et4_replace_day",
    """
    SELECT CAST(ts AS DATE) AS day, event_type, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' THEN round(sum(value), 2) ELSE 0 END AS total
    FROM events GROUP BY 1, 2
    """,
    text=("day",),
)
def replace_day(t):
    path = shared_dir(t.spark, "daily-revenue")
    rows = t.events.withColumn("day", F.to_date("ts"))
    blank = rows.groupBy("day", "event_type").agg(F.lit(0.0).alias("total"))
    L.replace_day(blank, path, "day")

    def load(day: str):
        one = F.col("day") == F.lit(day).cast("date")
        fresh = rows.filter(one).groupBy("day", "event_type").agg(F.sum("value").alias("total"))
        L.run_if_present(rows, one, lambda: L.replace_day(fresh, path, "day"))

    load("2024-01-10")
    load("2031-01-01")  # no source rows: skipped
    return rounded(t.spark.read.parquet(path), 2, "total")


@query("et5_incremental", "SELECT event_id, user_id, event_type, value, ts FROM events")
def incremental(t):
    """Two loads; the second rewrites only the days that its rows fall in."""
    source = t.events.select("event_id", "user_id", "event_type", "value", "ts", F.to_date("ts").alias("day"))
    marks, path = shared_dir(t.spark, "marks"), shared_dir(t.spark, "events-copy")
    for arrived in (source.filter(F.col("ts") < F.lit(dt.datetime(2024, 1, 16))), source):
        fresh, mark = L.incremental(arrived, "ts", L.load_mark(t.spark, marks, "events"))
        if path_exists(t.spark, path):
            L.upsert_partitions(t.spark, path, fresh, ["event_id", "day"], ["user_id", "event_type", "value", "ts"], "day")
        else:
            L.replace_day(fresh, path, "day")
        L.save_mark(t.spark, marks, "events", mark)  # last, so that a crash repeats the load
    return t.spark.read.parquet(path).drop("day")


UPSERT = """
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'O'
  UNION ALL SELECT o_orderkey, o_custkey, round(o_totalprice + 3, 2), 'P' FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT o_orderkey + 100000000, o_custkey, round(o_totalprice + 3, 2), 'P' FROM orders WHERE o_orderpriority = '1-URGENT'
"""


def _changes(t):
    """Each change twice, at steps 2 and 3; the later one holds."""
    cols = ["o_orderkey", F.col("o_custkey"), "o_totalprice", F.lit("P").alias("o_orderstatus")]
    changed = t.orders.filter("o_orderstatus = 'O'").select(*cols)
    added = t.orders.filter("o_orderpriority = '1-URGENT'").select(*cols)
    added = added.withColumn("o_orderkey", F.col("o_orderkey") + 100000000)
    steps = changed.unionByName(added).withColumn("step", F.explode(F.array(F.lit(2), F.lit(3))))
    return steps.withColumn("o_totalprice", F.round(F.col("o_totalprice") + F.col("step"), 2))


@query("et6_upsert", UPSERT)
def upsert(t):
    target = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    return L.upsert(target, _changes(t), ["o_orderkey"], ["o_totalprice", "o_orderstatus"], ["step"])


@query("et6_upsert_twice", UPSERT)
def upsert_twice(t):
    once = upsert(t)
    return L.upsert(once, _changes(t), ["o_orderkey"], ["o_totalprice", "o_orderstatus"], ["step"])


@query(
    "et6_upsert_partitions",
    """
    SELECT event_id, day, user_id, CASE WHEN day >= DATE '2024-01-20' AND event_type = 'purchase' THEN round(value + 1, 2) ELSE value END AS value
    FROM (SELECT *, CAST(ts AS DATE) AS day FROM events)
    """,
    text=("day",),
)
def upsert_partitions(t):
    path = shared_dir(t.spark, "events-upsert")
    rows = t.events.select("event_id", F.to_date("ts").alias("day"), "user_id", "value", "event_type")
    L.replace_day(rows.drop("event_type"), path, "day")
    changed = rows.filter("day >= DATE '2024-01-20' AND event_type = 'purchase'").drop("event_type")
    changed = changed.withColumn("value", F.round(F.col("value") + 1, 2))
    L.upsert_partitions(t.spark, path, changed, ["event_id", "day"], ["value"], "day")
    return t.spark.read.parquet(path).select("event_id", "day", "user_id", "value")


RAW = """
  SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' AND l_tax = 0 THEN NULL ELSE l_suppkey END AS user_id,
         CASE WHEN l_discount = 0.03 THEN 'n/a' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS event_date,
         CASE WHEN l_tax = 0.05 THEN 'free' WHEN l_returnflag = 'R' AND l_discount = 0 THEN '-' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
              ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS amount FROM lineitem
"""
# Reasons for quarantine, in the order they are tested.
MISSING_KEY = "CRITICAL: Missing Primary Key"
BAD_DATE = "ERROR: Invalid Date Format"
BAD_AMOUNT = "ERROR: Non-Numeric Amount"
NEGATIVE_AMOUNT = "LOGIC: Negative Amount"

# Which fault a line has follows from how RAW plants it.
FAULTS = {
    MISSING_KEY: "l_linestatus = 'O' AND l_tax = 0", BAD_DATE: "l_discount = 0.03", BAD_AMOUNT: "l_tax = 0.05",
    NEGATIVE_AMOUNT: "l_returnflag = 'R' AND l_discount = 0",
}
REASON = "coalesce(" + ", ".join(f"if({fault}, '{text}', NULL)" for text, fault in FAULTS.items()) + ")"


def _split(t):
    amount = F.col("l_quantity").cast("int").cast("string")
    raw = t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.when(~((F.col("l_linestatus") == "O") & (F.col("l_tax") == 0)), F.col("l_suppkey")).alias("user_id"),
        F.when(F.col("l_discount") == 0.03, "n/a").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("event_date"),
        F.when(F.col("l_tax") == 0.05, "free")
        .when((F.col("l_returnflag") == "R") & (F.col("l_discount") == 0), F.concat(F.lit("-"), amount))
        .otherwise(amount).alias("amount"),
    )
    day, money = F.col("event_date").try_cast("date"), F.col("amount").try_cast("decimal(18,2)")
    checks = [
        (MISSING_KEY, F.col("user_id").isNull()),
        (BAD_DATE, day.isNull()),
        (BAD_AMOUNT, money.isNull()),
        (NEGATIVE_AMOUNT, money < 0),
    ]
    typed = {c: F.col(c) for c in ("l_orderkey", "l_linenumber", "user_id")} | {"event_date": day, "amount": money}
    return L.split_valid(raw, checks, typed)


@query("et7_quarantine", f"SELECT * FROM ({RAW.replace(' FROM lineitem', f', {REASON} AS error_reason FROM lineitem')}) WHERE error_reason IS NOT NULL")
def quarantine(t):
    return _split(t)[1]


@query(
    "et7_valid_rows",
    f"""
    SELECT l_orderkey, l_linenumber, user_id, CAST(event_date AS DATE) AS event_date, CAST(CAST(amount AS DECIMAL(18,2)) AS DOUBLE) AS amount
    FROM ({RAW.rstrip()} WHERE {REASON} IS NULL)
    """,
    text=("event_date",),
)
def valid_rows(t):
    return _split(t)[0].withColumn("amount", F.col("amount").cast("double"))


@query(
    "et8_delete_where",
    "SELECT event_id, user_id, value FROM events WHERE NOT coalesce(CASE WHEN event_type <> 'view' THEN value > 100 END, FALSE)",
)
def delete_where(t):
    unknown = F.when(F.col("event_type") != "view", F.col("value") > 100)
    return L.delete_where(t.events, unknown).select("event_id", "user_id", "value")


@query(
    "et8_purge_partitions",
    "SELECT event_id, CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-10'",
    text=("day",),
)
def purge_partitions(t):
    path = shared_dir(t.spark, "events-archive")
    L.replace_day(t.events.select("event_id", F.to_date("ts").alias("day")), path, "day")
    L.purge_partitions(t.spark, path, "day", "2024-01-10")
    return t.spark.read.parquet(path)


@query(
    "et9_update_where",
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal,
           CASE WHEN c_acctbal < 0 THEN 'WATCH' ELSE c_mktsegment END AS c_mktsegment FROM customer
    """,
)
def update_where(t):
    rows = t.customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    return L.update_where(rows, F.col("c_acctbal") < 0, {"c_mktsegment": F.lit("WATCH"), "c_acctbal": F.lit(0.0)})


@query(
    "et10_cascade_delete",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 1000)",
)
def cascade_delete(t):
    deleted = t.customer.filter("c_acctbal < 1000")
    return L.cascade_delete(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", deleted, "c_custkey")


@query(
    "et10_cascade_set_null",
    """
    SELECT o_orderkey, CASE WHEN o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 1000) THEN o_custkey END AS o_custkey
    FROM orders
    """,
)
def cascade_set_null(t):
    deleted = t.customer.filter("c_acctbal < 1000")
    return L.cascade_set_null(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", deleted, "c_custkey")


@query(
    "et11_stamp_modified",
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal, c_mktsegment,
           CASE WHEN c_acctbal < 0 THEN TIMESTAMP '2024-06-01' ELSE TIMESTAMP '2024-01-01' END AS last_modified FROM customer
    """,
)
def stamp_modified(t):
    old = t.customer.select(
        "c_custkey", "c_acctbal", "c_mktsegment", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("last_modified")
    )
    new = L.update_where(old, F.col("c_acctbal") < 0, {"c_acctbal": F.lit(0.0)})
    return L.stamp_modified(old, new, ["c_custkey"], F.lit(dt.datetime(2024, 6, 1)).cast("timestamp_ntz"))


@query(
    "et12_unique_violations",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def unique_violations(t):
    return L.unique_violations(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "et12_orphan_rows",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)",
)
def orphan_rows(t):
    parents = t.customer.filter("c_nationkey < 20")
    return L.orphan_rows(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", parents, "c_custkey")


@query(
    "et13_reusable",
    """
    SELECT count(*) AS n, round(avg(value), 4) AS average, count(DISTINCT user_id) AS users FROM events WHERE event_type = 'purchase'
    """,
)
def reusable(t):
    """One written result, used by two queries."""
    L.reusable(t.events.filter("event_type = 'purchase'"), "purchases_kept", "materialised")
    one = t.spark.sql("SELECT count(*) AS n, avg(value) AS average FROM purchases_kept")
    two = t.spark.sql("SELECT count(DISTINCT user_id) AS users FROM purchases_kept")
    return rounded(L.with_scalars(one, two), 4, "average")


@query(
    "et14_fill_from_group",
    """
    SELECT o_orderkey, phone, max(email) OVER (PARTITION BY phone) AS email FROM (
      SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS phone,
             CASE WHEN o_orderstatus = 'F' THEN o_orderpriority || o_custkey END AS email FROM orders) WHERE phone IS NOT NULL
    """,
)
def fill_from_group(t):
    return L.fill_from_group(_calls(t), "phone", "email")


def _calls(t):
    return t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("phone"),
        F.when(F.col("o_orderstatus") == "F", F.concat("o_orderpriority", F.col("o_custkey").cast("string"))).alias("email"),
    )


@query(
    "et14_calls_with_donations",
    """
    SELECT o_orderkey, email, donations
    FROM (SELECT o_orderkey, o_orderpriority, max(if(o_orderstatus = 'F', o_custkey, NULL)) OVER (PARTITION BY o_custkey) AS email FROM orders) c,
    LATERAL (SELECT string_agg(CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR), ', ' ORDER BY event_id) AS donations
             FROM events WHERE event_type = 'purchase' AND user_id = c.email) g
    WHERE o_orderpriority = '1-URGENT' AND donations IS NOT NULL
    """,
)
def calls_with_donations(t):
    calls = t.orders.select(
        "o_orderkey", F.col("o_custkey").alias("phone"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("email"), F.col("o_orderpriority").alias("campaign"),
    )
    cleaned = L.fill_from_group(calls, "phone", "email").filter("campaign = '1-URGENT'").select("o_orderkey", "email")
    gifts = t.events.filter("event_type = 'purchase'").select(
        F.col("user_id").alias("email"), "event_id", F.round(F.col("value") * 100).cast("long").alias("cents")
    )
    return cleaned.join(A.string_agg(gifts, ["email"], "cents", ["event_id"], out="donations"), "email")


PAIRS = "SELECT DISTINCT l_suppkey AS i_id, o_custkey AS s_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


def _pairs(t):
    pairs = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_suppkey").alias("s_suppkey"), F.col("o_custkey").alias("c_custkey")
    ).distinct()
    named = pairs.join(t.supplier, "s_suppkey").join(t.customer, "c_custkey").join(
        t.nation, F.col("s_nationkey") == F.col("n_nationkey")
    )
    return named.select(
        F.col("n_name").alias("dept"), F.col("s_suppkey").alias("instructor_id"), F.col("s_name").alias("instructor_name"),
        F.col("c_custkey").alias("advisee_id"), F.col("c_name").alias("advisee_name"),
    )


def _people(t):
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))


@query(
    "et15_advisor_list",
    f"""
    SELECT i_id AS instructor_id, s_name AS instructor_name, s_id AS advisee_id, c_name AS advisee_name, CAST(NULL AS VARCHAR) AS status
    FROM ({PAIRS}) JOIN supplier ON i_id = s_suppkey JOIN customer ON s_id = c_custkey JOIN nation ON s_nationkey = n_nationkey
    WHERE n_name = 'NATION_3'
    """,
)
def advisor_list(t):
    return L.advisor_list("NATION_3", _people(t), "n_name", _pairs(t))


@query(
    "et15_advisor_list_missing",
    """
    SELECT CAST(NULL AS BIGINT) AS instructor_id, CAST(NULL AS VARCHAR) AS instructor_name, CAST(NULL AS BIGINT) AS advisee_id,
           CAST(NULL AS VARCHAR) AS advisee_name, 'Department NATION_X does not exist' AS status
    WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_name = 'NATION_X')
    """,
)
def advisor_list_missing(t):
    return L.advisor_list("NATION_X", _people(t), "n_name", _pairs(t))
