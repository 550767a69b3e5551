"""Registered queries: sort, limit, paging, duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecraft.operators import ordering as O
from tablecraft.plans.registry import query


@query("so1_sort_rows", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_custkey, o_totalprice DESC")
def sort_rows(t):
    return O.sort_rows(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), "o_custkey", "-o_totalprice")


@query("so2_top_k", "SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 10")
def top_k(t):
    return O.top_k(t.orders, ["-o_orderdate", "o_orderkey"], 10)


@query("so3_page_offset", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10 OFFSET 10000")
def page_offset(t):
    return O.page_offset(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 10000, 10)


@query(
    "so3_page_keyset",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 10000 ORDER BY o_orderkey LIMIT 10",
)
def page_keyset(t):
    return O.page_keyset(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 10000, 10)


@query("so4_distinct_column", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def distinct_column(t):
    return O.distinct_rows(t.customer, "c_nationkey", "c_mktsegment")


@query("so4_distinct_rows", "SELECT DISTINCT * FROM nation")
def distinct_rows(t):
    return O.distinct_rows(t.nation)


@query(
    "so5_distinct_on",
    "SELECT DISTINCT ON (o_custkey) * FROM orders ORDER BY o_custkey, o_orderdate DESC, o_orderkey",
)
def distinct_on(t):
    return O.distinct_on(t.orders, ["o_custkey"], ["-o_orderdate", "o_orderkey"])


@query(
    "so6_duplicate_rows",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicate_rows(t):
    return O.duplicate_rows(t.lineitem, "l_orderkey", "l_linenumber")


@query(
    "so6_top_customers",
    """
    SELECT c_name, c_mktsegment, c_name || ' ' || c_mktsegment AS full_name, n_orders FROM (
      SELECT c_name, c_mktsegment, count(*) AS n_orders FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2)
    ORDER BY n_orders DESC, full_name LIMIT 10
    """,
)
def top_customers(t):
    counts = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    named = counts.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_name", "c_mktsegment", "n_orders")
    return O.top_customers(named, ["c_name", "c_mktsegment"], "n_orders", 10)
