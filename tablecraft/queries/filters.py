"""Registered queries: projections, filters, predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tablecraft.operators import filters as P
from tablecraft.plans.registry import query, rounded


def _gaps(t):
    """Orders where an open price and a pending customer are unknown."""
    return t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("custkey"),
        F.when(F.col("o_orderstatus") == "O", "").otherwise(F.col("o_orderpriority")).alias("note"),
    )


GAPS = """
  SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS custkey,
         CASE WHEN o_orderstatus = 'O' THEN '' ELSE o_orderpriority END AS note FROM orders
"""


@query(
    "pf1_filter_rows",
    """
    SELECT * FROM orders WHERE (o_orderstatus = 'O' AND o_totalprice > 100000)
       OR (o_orderpriority = '1-URGENT' AND o_orderdate = TIMESTAMP '1998-10-03')
    """,
)
def filter_rows(t):
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderdate") == F.lit(dt.datetime(1998, 10, 3)))
    return P.filter_rows(t.orders, ((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 100000)) | urgent)


@query(
    "pf2_or_as_union",
    "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' OR c_acctbal > 5000",
)
def or_as_union(t):
    return P.or_as_union(t.customer, F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") > 5000)


@query(
    "pf2_union_all_branches",
    "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' UNION ALL SELECT * FROM customer WHERE c_acctbal > 5000",
)
def union_all_branches(t):
    return P.or_as_union(t.customer, F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") > 5000, literal=True)


@query("pf3_not_equal", "SELECT * FROM customer WHERE c_nationkey <> 7")
def not_equal(t):
    return P.not_equal(t.customer, "c_nationkey", 7)


@query(
    "pf3_ne_split",
    "SELECT * FROM customer WHERE c_nationkey < 7 UNION ALL SELECT * FROM customer WHERE c_nationkey > 7",
)
def ne_split(t):
    below, above = P.ne_split(t.customer, "c_nationkey", 7)
    return below.unionAll(above)


@query(
    "pf4_like",
    """
    SELECT c_custkey, c_name, 'suffix' AS kind FROM customer WHERE c_name LIKE '%7'
    UNION ALL SELECT c_custkey, c_name, 'prefix' FROM customer WHERE c_name LIKE 'Customer#00000012%'
    """,
)
def like(t):
    names = t.customer.select("c_custkey", "c_name")
    suffix = P.like_filter(names, "c_name", "%7").withColumn("kind", F.lit("suffix"))
    prefix = P.like_filter(names, "c_name", "Customer#00000012%").withColumn("kind", F.lit("prefix"))
    return suffix.unionByName(prefix)


@query(
    "pf5_time_slice",
    """
    SELECT o_orderkey, o_orderdate, 'between' AS kind FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-01-31'
    UNION ALL SELECT o_orderkey, o_orderdate, 'half-open' FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-02-01'
    """,
)
def time_slice(t):
    days = t.orders.select("o_orderkey", "o_orderdate")
    closed = P.time_slice(days, "o_orderdate", dt.datetime(1997, 1, 1), dt.datetime(1997, 1, 31), closed=True)
    half = P.time_slice(days, "o_orderdate", dt.datetime(1998, 1, 1), dt.datetime(1998, 2, 1))
    return closed.withColumn("kind", F.lit("between")).unionByName(half.withColumn("kind", F.lit("half-open")))


@query("pf6_null_rows", f"SELECT * FROM ({GAPS}) WHERE price IS NULL AND custkey IS NULL")
def null_rows(t):
    return P.null_rows(_gaps(t), "price", "custkey")


@query("pf6_non_null_rows", f"SELECT * FROM ({GAPS}) WHERE price IS NOT NULL AND custkey IS NOT NULL")
def non_null_rows(t):
    return P.non_null_rows(_gaps(t), "price", "custkey")


@query("pf7_positive_rows", "SELECT * FROM customer WHERE c_acctbal > 0")
def positive_rows(t):
    return P.positive_rows(t.customer, "c_acctbal")


@query(
    "pf8_fill_null",
    f"""
    SELECT o_orderkey, coalesce(price, 0) AS price, coalesce(custkey, -1) AS custkey, note,
           coalesce(CAST(custkey AS VARCHAR), note, 'N/A') AS contact FROM ({GAPS})
    """,
)
def fill_null(t):
    wide = _gaps(t).withColumn("contact", F.col("custkey").cast("string"))
    return P.fill_null(wide, {"price": 0.0, "custkey": -1, "contact": F.coalesce("note", F.lit("N/A"))})


@query(
    "pf9_nullif",
    f"""
    SELECT o_orderkey, nullif(note, '') AS note, coalesce(nullif(note, ''), CAST(custkey AS VARCHAR)) AS primary_note
    FROM ({GAPS})
    """,
)
def nullif(t):
    clean = P.blank_to_null(_gaps(t), "note")
    return clean.select(
        "o_orderkey", "note", F.coalesce("note", F.col("custkey").cast("string")).alias("primary_note")
    )


@query(
    "pf9_return_rate",
    """
    SELECT l_suppkey, total, returned, open_lines,
           round(returned / CAST(total AS DOUBLE), 6) AS return_rate,
           round(returned / nullif(CAST(open_lines AS DOUBLE), 0), 6) AS per_open FROM (
      SELECT l_suppkey, count(*) AS total, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned,
             CAST(sum(CASE WHEN l_linestatus = 'O' AND l_quantity > 49 AND l_tax = 0 THEN 1 ELSE 0 END) AS BIGINT) AS open_lines
      FROM lineitem GROUP BY l_suppkey)
    """,
)
def return_rate(t):
    open_line = (F.col("l_linestatus") == "O") & (F.col("l_quantity") > 49) & (F.col("l_tax") == 0)
    counts = t.lineitem.groupBy("l_suppkey").agg(
        F.count("*").alias("total"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("returned"),
        F.sum(F.when(open_line, 1).otherwise(0)).alias("open_lines"),
    )
    wide = counts.withColumns(
        {"return_rate": P.safe_divide("returned", "total"), "per_open": P.safe_divide("returned", "open_lines")}
    )
    return rounded(wide, 6, "return_rate", "per_open")


@query(
    "pf10_first_non_null",
    f"""
    SELECT o_orderkey, CASE WHEN a IS NOT NULL THEN a WHEN b IS NOT NULL THEN b ELSE 'N/A' END AS chosen FROM (
      SELECT o_orderkey, CAST(custkey AS VARCHAR) AS a, nullif(note, '') AS b FROM ({GAPS}))
    """,
)
def first_non_null(t):
    two = P.blank_to_null(_gaps(t), "note").withColumn("a", F.col("custkey").cast("string"))
    return two.select("o_orderkey", P.first_non_null("a", "note", default="N/A").alias("chosen"))


@query(
    "pf11_band",
    f"""
    SELECT o_orderkey, price, CASE WHEN price > 300000 THEN 'High' WHEN price BETWEEN 100000 AND 300000 THEN 'Medium'
           WHEN price < 100000 THEN 'Low' ELSE 'Unknown' END AS level FROM ({GAPS})
    """,
)
def band(t):
    level = P.band("price", [300000, 100000], ["High", "Medium", "Low"])
    return _gaps(t).select("o_orderkey", "price", level.alias("level"))


@query(
    "pf12_standardise",
    """
    SELECT event_id, user_id, CASE WHEN raw IN ('click', 'view') THEN 'browse' WHEN raw = 'purchase' THEN 'buy'
           ELSE coalesce(raw, 'UNKNOWN') END AS clean_type, raw AS original_type FROM (
      SELECT event_id, user_id, CASE WHEN value >= 1 THEN event_type END AS raw FROM events)
    """,
)
def standardise(t):
    raw = t.events.select("event_id", "user_id", F.when(F.col("value") >= 1, F.col("event_type")).alias("raw"))
    return P.standardised_view(
        raw, "clean_user_events", "raw", {"browse": ["click", "view"], "buy": ["purchase"]}, "clean_type", "original_type"
    )


@query("pf13_rename", "SELECT c_custkey AS id, c_name AS full_name, c_mktsegment AS segment FROM customer")
def rename(t):
    cols = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return P.rename(cols, {"c_custkey": "id", "c_name": "full_name", "c_mktsegment": "segment"})


@query("pf14_prefix_match", "SELECT * FROM customer WHERE substr(c_mktsegment, 1, 1) = 'M'")
def prefix_match(t):
    return P.prefix_match(t.customer, "c_mktsegment", "M")


@query(
    "pf15_node_type",
    """
    WITH tree AS (SELECT p_partkey AS node, CASE WHEN p_partkey > 0 THEN (p_partkey - 1) // 3 END AS parent FROM part)
    SELECT node, parent, CASE WHEN parent IS NULL THEN 'Root'
           WHEN node IN (SELECT parent FROM tree WHERE parent IS NOT NULL) THEN 'Inner' ELSE 'Leaf' END AS node_type
    FROM tree
    """,
)
def node_type(t):
    tree = t.part.select(
        F.col("p_partkey").alias("node"),
        F.expr("CASE WHEN p_partkey > 0 THEN (p_partkey - 1) div 3 END").alias("parent"),
    )
    return P.node_type(tree, "node", "parent")


@query(
    "pf16_is_member",
    "SELECT count(*) > 0 AS is_member FROM customer WHERE c_custkey = 42 AND c_acctbal > -2000",
)
def is_member(t):
    return P.is_member(t.customer, (F.col("c_custkey") == 42) & (F.col("c_acctbal") > -2000))


@query(
    "pf16_members",
    "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
)
def members(t):
    keys = t.orders.select("o_custkey").distinct()
    flagged = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return P.members(flagged, keys, ["o_custkey"])
