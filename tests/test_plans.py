"""The plans Spark makes: pruning, push-down, partial work before shuffles."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import functions as F

from tablecraft.operators import aggregates as A
from tablecraft.operators import filters as P
from tablecraft.operators import joins as J
from tablecraft.operators import ordering as O
from tablecraft.operators import windows as V
from tablecraft.sources import tables as S


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_columns_are_pruned(spark, tables):
    text = plan(S.scan(spark, tables.path("orders"), ["o_orderkey"]))
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_aggregate_reads_two_columns(tables):
    text = plan(A.having(tables.orders, ["o_custkey"], F.col("s") > 1, s=F.sum("o_totalprice")))
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text
    assert "partial_sum" in text


def test_filters_reach_the_reader(tables):
    text = plan(P.like_filter(tables.customer, "c_name", "Customer#00%"))
    assert "StringStartsWith(c_name,Customer#00)" in text
    both = plan(P.filter_rows(tables.orders, (F.col("o_orderkey") == 1) | (F.col("o_custkey") == 2)))
    assert re.search(r"PushedFilters: \[Or\(EqualTo\(o_orderkey,1\),EqualTo\(o_custkey,2\)\)\]", both)
    keyset = plan(O.page_keyset(tables.orders, "o_orderkey", 100, 10))
    assert "GreaterThan(o_orderkey,100)" in keyset and "TakeOrderedAndProject" in keyset


def test_partition_folders_are_pruned(spark, tables, tmp_path):
    path = str(tmp_path / "by-date")
    S.write_partitioned(tables.events.withColumn("event_date", F.to_date("ts")), path, ["event_date"])
    week = S.scan_partitions(spark, path, "event_date", dt.date(2024, 1, 3), dt.date(2024, 1, 5))
    assert re.search(r"PartitionFilters: \[.*event_date.*>=.*event_date.*<=", plan(week))
    assert week.select(F.input_file_name()).distinct().count() == 3


def test_top_rows_are_limited_before_the_shuffle(tables):
    for df in (
        V.top_n_rank(tables.lineitem, ["l_suppkey"], ["-l_extendedprice"], 5),
        V.top_n_rows(tables.lineitem, ["l_suppkey"], ["-l_extendedprice"], 2),
        O.distinct_on(tables.orders, ["o_custkey"], ["-o_orderdate"]),
    ):
        text = plan(df)
        assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_no_product_joins(tables):
    """Scalars are subqueries, not one-row joins, and NOT IN needs no broadcast list."""
    params = tables.orders.agg(F.avg("o_totalprice").alias("a"))
    assert "Join" not in plan(J.with_params(tables.orders, params))
    text = plan(J.not_in(tables.customer, "c_custkey", tables.orders, "o_custkey"))
    assert "NestedLoop" not in text and "Cartesian" not in text
    mismatch = J.mismatch_pairs(
        tables.customer, F.col("c_custkey") == 4, "c_nationkey", tables.supplier, "s_nationkey", tables.nation, "n_nationkey"
    )
    assert "NestedLoop" not in plan(mismatch) and "Cartesian" not in plan(mismatch)


def test_asof_is_one_shuffle(tables):
    e = tables.events
    left = e.filter("event_type = 'error'").select("event_id", "user_id", "ts")
    right = e.filter("event_type = 'view'").select(F.col("event_id").alias("v"), "user_id", F.col("ts").alias("vts"))
    text = plan(J.asof_join(left, right, "ts", "vts", ["v"], ["user_id"]))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_one_shuffle_for_several_frames(tables):
    df = tables.events.select("user_id", "ts", "value")
    for before in (2, 6):
        df = V.moving_avg(df, ["user_id"], ["ts"], "value", before, 0, f"b{before}")
    assert plan(df).count("Exchange") == 1


def test_tables_of_equal_buckets_meet_without_a_shuffle(spark, tables):
    from tablecraft.queries.sources import bucketed

    orders, lines = bucketed(tables)
    joined = orders.join(lines.groupBy("l_orderkey").count(), orders.o_orderkey == lines.l_orderkey)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert joined.count() == lines.select("l_orderkey").distinct().count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_buckets_grow_with_the_rows(spark, tables, monkeypatch):
    from tablecraft.queries.sources import bucketed
    from tablecraft.sources import tables as S

    assert len(bucketed(tables)[1].inputFiles()) == 8
    monkeypatch.setattr(S, "BUCKET_ROWS", 250)
    rows = tables.lineitem.count()
    orders, lines = bucketed(tables)
    wanted = -(-rows // 250)
    assert S.buckets_for(tables.orders, tables.lineitem) == wanted == len(lines.inputFiles())
    most = lines.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert most < 3 * 250 and lines.count() == rows and orders.count() == tables.orders.count()
