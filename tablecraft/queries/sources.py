"""Registered queries: sources and sinks."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tablecraft.plans.registry import query, rounded
from tablecraft.plans.storage import shared_dir
from tablecraft.sources import tables as S

ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@query("sc1_scan_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def scan_columns(t):
    return S.scan(t.spark, t.path("orders"), ["o_orderkey", "o_custkey", "o_totalprice"])


@query("sc1_scan_all", "SELECT * FROM customer")
def scan_all(t):
    return S.scan(t.spark, t.path("customer"))


@query("sc2_load_csv", "SELECT * FROM customer")
def load_csv(t):
    path = shared_dir(t.spark, "customer-csv")
    t.customer.write.option("sep", ",").option("quoteAll", "true").csv(path)
    return S.load_csv(t.spark, path, t.customer.schema)


@query(
    "sc3_literal_rows",
    """
    WITH weights(o_orderpriority, weight) AS (
      VALUES ('1-URGENT', 5), ('2-HIGH', 4), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 2), ('5-LOW', 1))
    SELECT o_orderpriority, weight, count(*) AS orders, round(sum(o_totalprice * weight), 2) AS weighted
    FROM orders JOIN weights USING (o_orderpriority) GROUP BY 1, 2
    """,
)
def literal_rows(t):
    weights = S.literal_rows(
        t.spark,
        [("1-URGENT", 5), ("2-HIGH", 4), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 2), ("5-LOW", 1)],
        "o_orderpriority string, weight int",
    )
    totals = t.orders.groupBy("o_orderpriority").agg(
        F.count("*").alias("orders"), F.sum("o_totalprice").alias("total")
    )
    out = totals.join(weights, "o_orderpriority").select(
        "o_orderpriority", "weight", "orders", (F.col("total") * F.col("weight")).alias("weighted")
    )
    return rounded(out, 2, "weighted")


@query(
    "sc4_json_records",
    "SELECT c_custkey, c_name, c_acctbal, n_name AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def json_records(t):
    records = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", "c_acctbal", F.col("n_name").alias("nation")
    )
    path = shared_dir(t.spark, "customer-json")
    S.write_json_records(records, path)
    return S.read_json_records(t.spark, path, records.schema)


@query("sc5_append", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def append(t):
    path = shared_dir(t.spark, "orders-append")
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    finished = F.col("o_orderstatus") == "F"
    S.append(orders.filter(finished), path)
    S.append(orders.filter(~finished), path)
    return t.spark.read.schema(orders.schema).parquet(path)


@query("sc6_create_from_query", "SELECT * FROM orders WHERE o_orderstatus = 'O'")
def create_from_query(t):
    made = S.ctas(t.orders.filter("o_orderstatus = 'O'"), shared_dir(t.spark, "orders-copy"))
    return S.empty_like(made).unionByName(made)


@query(
    "sc6_schema_change",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
           CASE WHEN o_totalprice > 200000 THEN 'yes' ELSE 'no' END AS is_sale, CAST(NULL AS VARCHAR) AS note
    FROM orders
    """,
)
def schema_change(t):
    wide = S.with_added_column(
        t.orders, "is_sale", "string", F.when(F.col("o_totalprice") > 200000, "yes").otherwise("no")
    )
    wide = S.with_added_column(wide, "note", "string")
    return S.without_column(wide, "o_orderpriority")


@query(
    "sc7_partitioned_range",
    """
    SELECT event_type, count(*) AS hits FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' GROUP BY event_type
    """,
)
def partitioned_range(t):
    path = shared_dir(t.spark, "events-by-date")
    S.write_partitioned(t.events.withColumn("event_date", F.to_date("ts")), path, ["event_date"])
    week = S.scan_partitions(t.spark, path, "event_date", dt.date(2024, 1, 8), dt.date(2024, 1, 14))
    return week.groupBy("event_type").agg(F.count("*").alias("hits"))


@query(
    "sc8_list_partitioned",
    """
    SELECT c_custkey, c_acctbal, CASE WHEN c_mktsegment = 'BUILDING' OR c_acctbal > 5000 THEN TRUE
           WHEN c_acctbal < 0 THEN FALSE END AS hot FROM customer
    """,
)
def list_partitioned(t):
    path = shared_dir(t.spark, "customer-hot")
    flag = F.when(F.col("c_acctbal") > 5000, True).when(F.col("c_acctbal") < 0, False)
    S.write_list_partitioned(
        t.customer.select("c_custkey", "c_acctbal", "c_mktsegment", flag.alias("hot")), path, "hot"
    )
    S.move_rows(t.spark, path, "hot", F.col("c_mktsegment") == "BUILDING", True)
    return S.scan_list_partitioned(t.spark, path, "hot").select("c_custkey", "c_acctbal", "hot")


@query("sc9_hash_partitioned", f"SELECT {ORDER_COLS} FROM orders")
def hash_partitioned(t):
    path = shared_dir(t.spark, "orders-hash")
    S.write_hash_partitioned(t.orders, path, "o_orderkey", 3)
    return t.spark.read.parquet(path).drop("bucket")


def bucketed(t, n=8):
    """Orders and line items as tables of equal buckets, ``n`` or as many more as their rows need."""
    tables, n = [], max(n, S.buckets_for(t.orders, t.lineitem))
    for table, key in ((t.orders, "o_orderkey"), (t.lineitem, "l_orderkey")):
        name = f"{key[0]}_bucketed_{uuid.uuid4().hex[:8]}"
        tables.append(S.write_bucketed(table, name, shared_dir(t.spark, name), key, n))
    return tables


@query(
    "sc9_bucketed_join",
    """
    SELECT o_orderkey, o_orderpriority, n_lines, last_ship FROM orders
    JOIN (SELECT l_orderkey, count(*) AS n_lines, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey
    """,
)
def bucketed_join(t):
    orders, lines = bucketed(t)
    per_order = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), F.max("l_shipdate").alias("last_ship"))
    joined = orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select("o_orderkey", "o_orderpriority", "n_lines", "last_ship")


@query(
    "sc10_detach_attach",
    """
    SELECT event_id, user_id, value, CAST(ts AS DATE) AS event_date FROM events
    WHERE CAST(ts AS DATE) <> DATE '2024-01-03'
    """,
    text=("event_date",),
)
def detach_attach(t):
    path = shared_dir(t.spark, "events-parts")
    rows = t.events.select("event_id", "user_id", "value", F.to_date("ts").alias("event_date"))
    S.write_partitioned(rows, path, ["event_date"])
    name = f"events_parts_{uuid.uuid4().hex[:8]}"
    S.partitioned_table(
        t.spark, name, path, "event_id long, user_id long, value double, event_date date", "event_date"
    )
    S.detach_partition(t.spark, name, "event_date", "2024-01-02")
    S.detach_partition(t.spark, name, "event_date", "2024-01-03")
    S.attach_partition(t.spark, name, "event_date", "2024-01-02", f"{path}/event_date=2024-01-02")
    return t.spark.table(name)


@query(
    "sc11_generate_rows",
    """
    SELECT i AS id, 'Name ' || i AS name, 'Address ' || i AS address
    FROM generate_series(1, (SELECT count(*) FROM orders)) AS g(i)
    """,
)
def generate_rows(t):
    return S.generate_rows(t.spark, t.orders.count())
