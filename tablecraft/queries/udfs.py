"""Registered queries: user-defined functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecraft.functions import udfs as U
from tablecraft.plans.registry import query, rounded


@query(
    "ud1_add_two_numbers",
    "SELECT l_orderkey, l_linenumber, l_linenumber + CAST(l_quantity AS INTEGER) AS added FROM lineitem",
)
def add_two_numbers(t):
    U.register_add_two_numbers(t.spark)
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", U.add_two_numbers("l_linenumber", F.col("l_quantity").cast("int")).alias("added")
    )


@query("ud2_table_function", "SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_nationkey = 11")
def table_function(t):
    people = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_nationkey")
    people.createOrReplaceTempView("people_by_nation")
    U.register_table_function(
        t.spark, "people_in_nation", "people_by_nation", "INT", {"id": "BIGINT", "name": "STRING"}, "c_nationkey"
    )
    return U.employees_in(t.spark, "people_in_nation", 11)


@query(
    "ud3_median",
    "SELECT user_id, round(quantile_cont(value, 0.5), 4) AS median FROM events GROUP BY user_id",
)
def median(t):
    return rounded(U.median(t.events, ["user_id"], "value"), 4, "median")


@query(
    "ud4_named_query",
    "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_nationkey = 3",
)
def named_query(t):
    U.define_query("customers_of_segment", lambda segment: t.customer.filter(F.col("c_mktsegment") == segment))
    U.define_query(
        "customers_of_nation",
        lambda segment, nation: U.named_query("customers_of_segment", segment=segment)
        .filter(F.col("c_nationkey") == nation)
        .select("c_custkey", "c_name", "c_nationkey"),
    )
    return U.named_query("customers_of_nation", segment="MACHINERY", nation=3)
