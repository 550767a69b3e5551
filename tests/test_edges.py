"""NULL keys, awkward folder names, late rows and names that hold a separator."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablecraft.operators import etl as L
from tablecraft.operators import hierarchy as H
from tablecraft.operators import timeseries as S
from tablecraft.plans.ordered import cut, order_of, ranked, running
from tablecraft.sources import tables as T
from tablecraft.streaming import streams


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_keeps_the_null_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "id int, day date, v int"
    L.replace_day(spark.createDataFrame([(1, dt.date(2024, 1, 1), 1), (2, None, 1)], schema), path, "day")
    L.upsert_partitions(spark, path, spark.createDataFrame([(3, None, 7)], schema), ["id", "day"], ["v"], "day")
    day = dt.date(2024, 1, 1)
    assert rows_of(spark.read.parquet(path).select("id", "day", "v")) == sorted([(1, day, 1), (2, None, 1), (3, None, 7)], key=str)


def test_upsert_twice_with_null_keys(spark):
    target = spark.createDataFrame([(1, "a"), (None, "b")], "id int, v string")
    source = spark.createDataFrame([(None, "c"), (2, "d")], "id int, v string")
    once = L.upsert(target, source, ["id"], ["v"])
    assert rows_of(L.upsert(once, source, ["id"], ["v"])) == rows_of(once) == sorted([(1, "a"), (None, "c"), (2, "d")], key=str)


def test_moved_text_flag_leaves_its_folder(spark, tmp_path):
    path = str(tmp_path / "f")
    T.write_list_partitioned(spark.createDataFrame([(1, "Hot Stuff/1"), (2, "Hot Stuff/1"), (3, "Cold")], "id int, flag string"), path, "flag")
    T.move_rows(spark, path, "flag", F.col("flag") == "Hot Stuff/1", "Cold", kind="string")
    assert rows_of(T.scan_list_partitioned(spark, path, "flag", "string").select("id", "flag")) == [(1, "Cold"), (2, "Cold"), (3, "Cold")]


def test_purge_compares_numbers_as_numbers(spark, tmp_path):
    path = str(tmp_path / "n")
    spark.createDataFrame([(1, 5), (2, 30), (3, 100), (4, None)], "id int, d int").write.partitionBy("d").parquet(path)
    assert L.purge_partitions(spark, path, "d", "20") == 1
    assert rows_of(spark.read.parquet(path).select("id")) == [(2,), (3,), (4,)]


def test_grids_of_a_null_key(spark):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    df = spark.createDataFrame([(None, at(0), 1.0), (None, at(12), 2.0), ("a", at(3), 5.0)], "k string, ts timestamp_ntz, v double")
    filled = S.grid_ffill(df, "k", "ts", "v", 300)
    assert [r.imputed_value for r in filled.filter("k IS NULL").orderBy("bucket_ts").collect()] == [1.0, 1.0, 2.0]
    gaps = S.gap_fill_prev(df, "k", "ts", "v", 300)
    assert [r.v for r in gaps.filter("k IS NULL").orderBy("ts").collect()] == [1.0, 1.0, 2.0]
    assert rows_of(S.grid_ffill(df, "k", "ts", "v", 300, max_rows=2)) == rows_of(filled)


def test_names_that_hold_the_separator(spark):
    edges = spark.createDataFrame([("A>B", None), ("A", "A>B"), ("C", "A"), ("A>B", "C")], "name string, boss string")
    got = {r.path for r in H.descendants(edges, "name", "boss", "A>B").collect()}
    assert got == {"A>B", "A>B>A", "A>B>A>C"}


def test_two_feeds_into_one_table(spark, tmp_path):
    schema = "id int, at timestamp_ntz, v int"
    for k in (1, 2):
        path = str(tmp_path / f"feed{k}")
        spark.createDataFrame([(k, dt.datetime(2024, 1, k), k)], schema).write.parquet(path)
        feed = streams.event_source(spark, path, spark.read.parquet(path).schema)
        streams.stream_upsert(feed, str(tmp_path / "root"), ["id"], ["v"], "at")
    assert rows_of(L.current(spark, str(tmp_path / "root")).select("id", "v")) == [(1, 1), (2, 2)]


def test_rollback_goes_to_the_last_other_version(spark, tmp_path):
    root = str(tmp_path / "p")
    for k in (1, 2):
        L.publish(spark.range(k), root, version=f"v{k}")
    assert L.rollback(spark, root) == "v1" and L.current_version(spark, root) == "v1"
    assert L.rollback(spark, root) == "v2"


def test_cut_by_text_wide_numbers_and_ties(spark):
    big = 1 << 60
    df = spark.range(3000).select(
        "id", F.concat(F.lit("Customer#0000000"), (F.col("id") * 7919 % 3000).cast("string")).alias("name"),
        F.when(F.col("id") % 50 != 0, big + F.col("id") * 7919 % 3000).alias("wide"), F.lit(1).alias("same"),
        F.when(F.col("id") % 7 == 0, F.col("id")).alias("maybe"),
    )
    for order in (["name"], ["-name"], ["wide", "id"], ["-wide", "id"], ["same", "-name"]):
        by = order_of(*order)
        w = W.orderBy(*[F.col(c).asc() if up else F.col(c).desc() for c, up in by])
        plain = df.withColumns({"rn": F.row_number().over(w), "l": F.last("maybe", True).over(w.rowsBetween(W.unboundedPreceding, 0))})
        got = running(ranked(df, [], by, row_number="rn", max_rows=100), [], by, {"l": ("last", "maybe")}, max_rows=100)
        assert rows_of(got.select("id", "rn", "l")) == rows_of(plain.select("id", "rn", "l")), order
        largest = cut(df, [], by, 100)[0].groupBy("_piece").count().agg(F.max("count")).first()[0]
        assert largest <= 300
    tied = ranked(df, [], order_of("same"), row_number="rn", max_rows=100)
    assert sorted(r.rn for r in tied.select("rn").collect()) == list(range(1, 3001))
    assert cut(df, [], order_of("same"), 100)[0].groupBy("_piece").count().agg(F.max("count")).first()[0] <= 300


def jobs_before_action(spark, build):
    group = f"plan-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        build()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_one_look_at_group_sizes(spark, tables):
    from tablecraft.operators import stats as M
    from tablecraft.operators import windows as V

    rows = tables.events.select("event_id", "user_id", "ts", "value").persist()
    rows.count()
    frames = {f"a{k}": (k, k) for k in range(5)}
    once = jobs_before_action(spark, lambda: V.moving_avg(rows, ["user_id"], ["ts"], "value", 1, 1))
    assert jobs_before_action(spark, lambda: V.moving_avgs(rows, ["user_id"], ["ts"], "value", frames)) <= max(once, 2)
    assert jobs_before_action(spark, lambda: V.rolling_sums(rows, ["user_id"], "ts", "value", 9, 3600)) <= max(once, 2)
    assert jobs_before_action(spark, lambda: M.mad_score(rows, "value")) <= 2


def test_filters_reach_the_scan(spark, tables):
    from tablecraft.functions.exprs import contains_token
    from tablecraft.operators.filters import prefix_match

    def pushed(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "StringStartsWith(p_name" in pushed(prefix_match(tables.part, "p_name", "a"))
    assert "StringContains(p_name" in pushed(tables.part.filter(contains_token("p_name", "ab")))


def test_a_small_change_rewrites_its_own_folder(spark, tmp_path):
    path = str(tmp_path / "days")
    schema = "id int, day date, v int"
    days = [dt.date(2024, 1, d) for d in range(1, 11)]
    L.replace_day(spark.createDataFrame([(k, d, 0) for k, d in enumerate(days)], schema), path, "day")
    files = lambda: {f.parent.name: f.name for f in (tmp_path / "days").glob("day=*/*.parquet")}
    before = files()
    L.upsert_partitions(spark, path, spark.createDataFrame([(3, days[3], 5), (99, days[3], 6)], schema), ["id", "day"], ["v"], "day")
    after = files()
    assert [d for d in after if after[d] != before.get(d)] == ["day=2024-01-04"]
    assert spark.read.parquet(path).agg(F.sum("v"), F.count("*")).first()[:] == (11, 11)
