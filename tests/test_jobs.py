"""Jobs on tables: what they leave behind, also when run twice or stopped."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablecraft.operators import etl as L
from tablecraft.sources import tables as S


def values(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_old_versions_go_and_the_pointer_log_stays_short(spark, tmp_path):
    root, now = str(tmp_path / "t"), dt.timedelta(0)
    for k in range(1, 7):
        L.publish(spark.range(k), root, version=f"v{k}")
    with pytest.raises(L.GateFailed):
        L.publish(spark.range(0), root, version="refused")
    assert L.clear_versions(spark, root) == []  # all were current within a day
    reader = L.current(spark, root)
    assert L.clear_versions(spark, root, keep=3, grace=now, files=4) == ["refused", "v1", "v2", "v3"]
    assert L.clear_versions(spark, root, keep=3, grace=now, files=4) == []
    assert len(list((tmp_path / "t" / "pointer").glob("*.parquet"))) == 1
    assert reader.count() == 6 and L.current(spark, root).count() == 6
    L.publish(spark.range(7), root, version="v7")
    assert L.rollback(spark, root) == "v6" and L.current(spark, root).count() == 6
    assert L.clear_versions(spark, root, keep=2, grace=now) == ["v4", "v5"]
    assert L.rollback(spark, root) == "v7"
    with pytest.raises(ValueError):
        L.clear_versions(spark, root, keep=1, grace=now)


def test_a_reader_may_finish_what_was_current_within_the_grace(spark, tmp_path):
    root = str(tmp_path / "t")
    L.publish(spark.range(1), root, version="a")
    reader = L.current(spark, root)
    for k in "bcd":
        L.publish(spark.range(2), root, version=k)
    assert L.clear_versions(spark, root, keep=2, grace=dt.timedelta(minutes=10)) == [] and reader.count() == 1
    assert L.clear_versions(spark, str(tmp_path / "nothing")) == []


def test_refused_publication_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        L.current(spark, root)
    first = L.publish(spark.range(5), root)
    with pytest.raises(L.GateFailed):
        L.publish(spark.range(2), root, min_rows=3)
    assert L.current_version(spark, root) == first and L.current(spark, root).count() == 5
    with pytest.raises(L.GateFailed):
        L.rollback(spark, root)
    L.publish(spark.range(7), root)
    assert L.current(spark, root, view="published").count() == 7
    assert L.rollback(spark, root) == first and L.current(spark, root).count() == 5


def test_gates(spark):
    df = spark.createDataFrame([(1, 5.0), (None, -5.0)], "id int, v double")
    with pytest.raises(L.GateFailed, match="empty"):
        L.quality_gate(df.filter("false"))
    with pytest.raises(L.GateFailed, match="Null id"):
        L.quality_gate(df, ["id"])
    with pytest.raises(L.GateFailed, match="Total v is 0"):
        L.quality_gate(df, totals=["v"])
    assert L.quality_gate(df, ["id"], max_null_rate=0.5)["null_id"] == 1


def test_failed_job_is_logged(spark, tmp_path):
    history, target = str(tmp_path / "h"), str(tmp_path / "t")

    def broken():
        raise ValueError("no source")

    with pytest.raises(ValueError):
        L.run_job(spark, "load", broken, target, history)
    good = L.run_job(spark, "load", lambda: spark.range(9), target, history)
    log = {r.run_id: (r.status, r.rows_affected) for r in L.job_history(spark, history).collect()}
    assert sorted(log.values(), key=str) == [("FAILED", None), ("SUCCESS", 9)]
    assert {r.etl_run_id for r in spark.read.parquet(target).collect()} == {good}


def test_upsert_rules(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], "id int, status string, made string")
    new = spark.createDataFrame([(2, "B", "y", 1), (2, "BB", "y", 2), (3, "c", "y", 1)], "id int, status string, made string, at int")
    once = L.upsert(old, new, ["id"], ["status"], ["at"])
    assert values(once) == [(1, "a", "x"), (2, "BB", "x"), (3, "c", "y")]
    assert values(L.upsert(once, new, ["id"], ["status"], ["at"])) == values(once)
    null = spark.createDataFrame([(1, None, "z")], "id int, status string, made string")
    assert (1, None, "x") in values(L.upsert(old, null, ["id"], ["status"]))


def test_older_rows_do_not_overwrite(spark):
    old = spark.createDataFrame([(1, "new", 5)], "id int, v string, at int")
    late = spark.createDataFrame([(1, "old", 3), (2, "x", 3)], "id int, v string, at int")
    assert values(L.upsert(old, late, ["id"], ["v", "at"], if_newer="at")) == [(1, "new", 5), (2, "x", 3)]


def test_incremental_starts_at_the_latest_time_loaded(spark, tmp_path):
    marks = str(tmp_path / "m")
    src = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2))], "id int, at timestamp_ntz")
    fresh, mark = L.incremental(src, "at", L.load_mark(spark, marks, "t"))
    assert fresh.count() == 2 and mark == dt.datetime(2024, 1, 2)
    L.save_mark(spark, marks, "t", mark)
    L.save_mark(spark, marks, "other", dt.datetime(2030, 1, 1))
    again, mark = L.incremental(src, "at", L.load_mark(spark, marks, "t"))
    assert [r.id for r in again.collect()] == [2] and mark == dt.datetime(2024, 1, 2)
    late = src.unionByName(spark.createDataFrame([(3, dt.datetime(2024, 1, 2))], src.schema))
    assert {r.id for r in L.incremental(late, "at", mark)[0].collect()} == {2, 3}


def test_replace_day_leaves_other_days(spark, tmp_path):
    path = str(tmp_path / "d")
    L.replace_day(spark.createDataFrame([("a", 1), ("b", 2)], "d string, v int"), path, "d")
    L.replace_day(spark.createDataFrame([("b", 9)], "d string, v int"), path, "d")
    assert values(spark.read.parquet(path).select("d", "v")) == [("a", 1), ("b", 9)]
    ran = []
    assert not L.run_if_present(spark.range(3), F.col("id") > 5, lambda: ran.append(1)) and not ran
    assert L.run_if_present(spark.range(3), F.col("id") > 1, lambda: ran.append(1)) and ran


def test_moved_rows_empty_their_folder(spark, tmp_path):
    path = str(tmp_path / "hot")
    df = spark.createDataFrame([(1, True), (2, None), (3, False)], "id int, hot boolean")
    S.write_list_partitioned(df, path, "hot")
    S.move_rows(spark, path, "hot", F.col("id") > 0, True)
    assert values(S.scan_list_partitioned(spark, path, "hot")) == [(1, True), (2, True), (3, True)]
    S.move_rows(spark, path, "hot", F.col("id") == 2, None)
    assert values(S.scan_list_partitioned(spark, path, "hot")) == [(1, True), (2, None), (3, True)]


def test_hash_buckets_hold_every_row_once(spark, tmp_path):
    path = str(tmp_path / "b")
    S.write_hash_partitioned(spark.range(1000), path, "id", 3)
    back = spark.read.parquet(path)
    assert back.count() == back.select("id").distinct().count() == 1000
    assert back.select("bucket").distinct().count() == 3


def test_adopted_folder_is_a_partition(spark, tmp_path):
    path, old = str(tmp_path / "t"), str(tmp_path / "old")
    S.write_partitioned(spark.createDataFrame([(1, "2021-02-01")], "id int, month string"), path, ["month"])
    spark.createDataFrame([(7,), (8,)], "id int").write.parquet(old)
    S.partitioned_table(spark, "measured", path, "id int, month string", "month")
    S.adopt_table(spark, "measured", "month", old)
    assert values(spark.table("measured")) == [(1, "2021-02-01"), (7, "0001-01-01"), (8, "0001-01-01")]
    S.detach_partition(spark, "measured", "month", "0001-01-01")
    assert values(spark.table("measured")) == [(1, "2021-02-01")]
    assert spark.read.parquet(old).count() == 2
    spark.sql("DROP TABLE measured")


def test_cascades(spark):
    child = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, parent int")
    gone = spark.createDataFrame([(10,), (10,)], "pid int")
    assert values(L.cascade_delete(child, "parent", gone, "pid")) == [(2, 20), (3, None)]
    assert values(L.cascade_set_null(child, "parent", gone, "pid")) == [(1, None), (2, 20), (3, None)]
    assert values(L.orphan_rows(child, "parent", gone, "pid")) == [(2, 20)]


def test_key_checks(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    assert values(L.unique_violations(df, ["id"])) == [(1, 2), (None, 1)]


def test_stamp_only_changed_rows(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, None, 1)], "id int, v string, last_modified int")
    new = spark.createDataFrame([(1, "b"), (2, None), (3, "c")], "id int, v string")
    assert values(L.stamp_modified(old, new, ["id"], F.lit(9))) == [(1, "b", 9), (2, None, 1), (3, "c", 9)]


def test_reuse_modes(spark):
    for mode in ("view", "cached", "lazy_cached", "materialised"):
        assert L.reusable(spark.range(4), f"kept_{mode}", mode).count() == 4
        assert spark.sql(f"SELECT sum(id) FROM kept_{mode}").first()[0] == 6
        L.release(spark, f"kept_{mode}")


def test_fill_from_group_and_null_keys(spark):
    df = spark.createDataFrame([("p", "a"), ("p", None), ("p", "b"), (None, "z")], "phone string, email string")
    assert values(L.fill_from_group(df, "phone", "email")) == [("p", "b")] * 3
    assert (None, "z") in values(L.fill_from_group(df, "phone", "email", keep_null_keys=True))


def test_advisor_status_rows(spark):
    people = spark.createDataFrame([("Math",), ("Art",)], "dept string")
    pairs = spark.createDataFrame([("Math", 1, "Ann")], "dept string, id int, name string")
    show = lambda d: values(L.advisor_list(d, people, "dept", pairs))
    assert show("Math") == [(1, "Ann", None)]
    assert show("Art") == [(None, None, "Department Art has no instructors")]
    assert show("Law") == [(None, None, "Department Law does not exist")]


def test_csv_and_purge(spark, tmp_path):
    path = str(tmp_path / "p")
    L.replace_day(spark.createDataFrame([("2024-01-01", 1), ("2024-01-05", 2)], "d string, v int"), path, "d")
    assert L.purge_partitions(spark, path, "d", "2024-01-03") == 1
    assert [r.v for r in spark.read.parquet(path).collect()] == [2]
