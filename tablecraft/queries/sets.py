"""Registered queries: set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecraft.operators import sets as S
from tablecraft.plans.registry import query


def _names(df, prefix):
    return df.select(F.col(f"{prefix}_name").alias("name"), F.col(f"{prefix}_nationkey").alias("nationkey"))


@query(
    "st1_union_all",
    "SELECT c_name AS name, c_nationkey AS nationkey FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier",
)
def union_all(t):
    return S.union_all(_names(t.customer, "c"), _names(t.supplier, "s"))


@query(
    "st2_union_distinct",
    """
    SELECT c_nationkey AS nationkey FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION SELECT s_nationkey FROM supplier WHERE s_acctbal < 0
    """,
)
def union_distinct(t):
    first = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_nationkey").alias("nationkey"))
    second = t.supplier.filter("s_acctbal < 0").select(F.col("s_nationkey").alias("nationkey"))
    return S.union_distinct(first, second)


@query(
    "st2_reused_counts",
    """
    WITH busy AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey)
    SELECT c_name, c_mktsegment FROM customer JOIN busy ON c_custkey = o_custkey WHERE n > 5
    UNION SELECT c_name, c_mktsegment FROM customer JOIN busy ON c_custkey = o_custkey WHERE n < 0
    """,
)
def reused_counts(t):
    busy = t.orders.filter("o_orderstatus = 'O'").groupBy("o_custkey").agg(F.count("*").alias("n"))
    joined = t.customer.join(busy, F.col("c_custkey") == F.col("o_custkey")).select("c_name", "c_mktsegment", "n")
    many, none = joined.filter("n > 5").drop("n"), joined.filter("n < 0").drop("n")
    return S.union_distinct(many, none)


@query(
    "st3_minus",
    "SELECT n_nationkey FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000",
)
def minus(t):
    return S.minus(
        t.nation.select("n_nationkey"),
        t.supplier.filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("n_nationkey")),
    )
