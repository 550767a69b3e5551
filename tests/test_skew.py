"""Large groups cut into pieces give what one plain window gives.

A third of all rows belongs to one key, a few rows have a NULL key, NULL values
and repeated times.  ``max_rows`` is set so low that the large key, or the whole
table, has to be cut.
"""

from __future__ import annotations

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablecraft.operators import aggregates as A
from tablecraft.operators import joins as J
from tablecraft.operators import stats as M
from tablecraft.operators import timeseries as S
from tablecraft.operators import windows as V
from tablecraft.plans.ordered import asked, cut, framed, next_known, order_of, ranked, running, tiles, time_framed, time_totals
from tablecraft.plans.quantiles import percentiles
from tablecraft.plans.skew import attach, find_hot, over_group

SMALL = 40


@pytest.fixture(scope="module")
def rows(tables):
    e = tables.events
    key = (
        F.when(F.col("event_id") % 3 == 0, F.lit(7))
        .when(F.col("event_id") % 50 == 1, F.lit(None))
        .otherwise(F.col("user_id"))
    )
    return e.select(
        "event_id", "event_type", "value",
        key.alias("user_id"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"),
        "ts",
        F.when(F.col("event_type") == "error", F.col("value")).alias("maybe"),
    ).persist()


def same(left, right, by="event_id"):
    cols = sorted(left.columns)
    a = left.select(cols).toPandas().sort_values(by, ignore_index=True)
    b = right.select(cols).toPandas().sort_values(by, ignore_index=True)
    assert len(a) == len(b)
    pd.testing.assert_frame_equal(a, b, check_dtype=False, rtol=1e-9, atol=1e-9)


def both(fn, by="event_id"):
    same(fn(None), fn(SMALL), by)


AGGS = {"s": ("sum", "value"), "c": ("count", "maybe"), "low": ("min", "value"), "high": ("max", "maybe"), "l": ("last", "maybe")}


@pytest.mark.parametrize("by", [["user_id"], []])
@pytest.mark.parametrize("kw", [{}, {"frame": "range"}, {"current": False}])
def test_running(rows, by, kw):
    order = order_of("hour") if kw.get("frame") else order_of("ts", "event_id")
    aggs = {k: v for k, v in AGGS.items() if not (kw.get("frame") and k == "l")}  # no last among peers
    both(lambda m: running(rows, by, order, aggs, max_rows=m, **kw))


def test_running_down(rows):
    both(lambda m: running(rows, ["user_id"], order_of("-ts"), {"s": ("sum", "value")}, max_rows=m))


def test_running_with_null_order(rows):
    holes = rows.withColumn("at", F.when(F.col("event_id") % 4 != 0, F.col("maybe")))
    both(lambda m: running(holes, ["user_id"], order_of("at"), {"n": ("count", F.lit(1))}, "range", max_rows=m))
    both(lambda m: running(holes, ["user_id"], order_of("-at"), {"n": ("count", F.lit(1))}, "range", max_rows=m))


def test_next_known(rows):
    both(lambda m: next_known(rows, ["user_id"], order_of("ts"), {"nx": "maybe"}, max_rows=m))


@pytest.mark.parametrize("by", [["user_id"], []])
def test_ranked(rows, by):
    both(lambda m: ranked(rows, by, order_of("-value", "event_id"), "rn", "r", "d", max_rows=m))
    both(lambda m: ranked(rows, by, order_of("hour"), rank="r", dense_rank="d", max_rows=m))


def test_one_order_value_holds_most_rows(rows):
    """Ties are cut along the second order column, or counted as one row."""
    flat = rows.withColumn("day", F.when(F.col("event_id") % 10 < 8, 3).otherwise(F.col("event_id") % 7))
    for order in (order_of("day", "event_id"), order_of("-day", "-event_id"), order_of("day", "-maybe", "event_id")):
        both(lambda m, o=order: ranked(flat, [], o, row_number="rn", max_rows=m))
        both(lambda m, o=order: running(flat, ["user_id"], o, {"s": ("sum", "value")}, max_rows=m))
    both(lambda m: ranked(flat, [], order_of("day"), rank="r", dense_rank="d", max_rows=m))
    both(lambda m: running(flat, [], order_of("day"), {"s": ("sum", "value"), "n": ("count", "maybe")}, "range", max_rows=m))
    pieces = cut(flat, [], order_of("day", "event_id"), SMALL)[0].groupBy("_piece").count().agg(F.max("count")).first()[0]
    assert pieces <= 3 * SMALL


def test_framed(rows):
    def columns(w):
        return {"lag2": F.lag("value", 2).over(w), "lead3": F.lead("value", 3).over(w), "avg": F.avg("value").over(w.rowsBetween(-6, 3))}

    both(lambda m: framed(rows, ["user_id"], order_of("ts"), 6, 3, columns, max_rows=m))
    both(lambda m: framed(rows, [], order_of("ts"), 6, 3, columns, max_rows=m))


def test_frame_longer_than_the_limit(rows):
    both(lambda m: V.moving_avg(rows, ["user_id"], ["ts"], "value", 100, 90, max_rows=m and 10))


def test_time_framed(rows):
    both(lambda m: time_framed(rows, ["user_id"], "ts", 86_400, lambda w: {"s": F.sum("value").over(w), "n": F.count("*").over(w)}, max_rows=m))
    both(lambda m: time_framed(rows, ["user_id"], "hour", 20 * 86_400, lambda w: {"n": F.count("*").over(w)}, max_rows=m))


TOTALS = {"s": ("sum", "value"), "n": ("count", "maybe"), "low": ("min", "maybe"), "high": ("max", "maybe")}


@pytest.mark.parametrize("seconds", [0, 3600, 86_400, 9 * 86_400, 4000 * 86_400])
def test_time_totals(rows, seconds):
    holes = rows.withColumn("ts", F.when(F.col("event_id") % 41 != 0, F.col("ts")))
    for ts in ("ts", "hour"):
        cut_, plain = (time_totals(holes, ["user_id"], ts, seconds, TOTALS, max_rows=m) for m in (SMALL, None))
        assert sorted(cut_.columns) == sorted(plain.columns)
        key = lambda r: (r.user_id is None, r.user_id, r[ts] is None, r[ts] or 0)
        got, want = (sorted(d.select("user_id", ts, *TOTALS).collect(), key=lambda r: repr(key(r))) for d in (cut_, plain))
        assert len(got) == len(want)
        for g, w in zip(got, want):
            assert g[:2] == w[:2] and g.n == w.n and g.low == w.low and g.high == w.high
            assert (g.s is None and w.s is None) or abs(g.s - w.s) < 1e-6


def test_time_totals_copies_a_row_once_however_far_the_frame_reaches(rows):
    points = rows.groupBy("user_id", "ts").agg(F.sum("value").alias("s")).withColumn("_us", F.unix_micros(F.col("ts").cast("timestamp")))
    hot = find_hot(points, ["user_id"], SMALL)
    in_pieces, spread, _ = asked(points, ["user_id"], 4000 * 86_400 * 1_000_000, ["s"], hot)
    assert in_pieces.select("_piece").distinct().count() > 5
    n = points.count()
    assert in_pieces.count() == n < spread.count() <= 2 * n


def test_percentiles_of_repeated_values(rows):
    flat = rows.withColumn("v", F.floor(F.col("value") / 50))
    plain = percentiles(flat, [], "v", {"p50": 0.5, "p90": 0.9}, max_rows=None)
    cut = percentiles(flat, [], "v", {"p50": 0.5, "p90": 0.9}, max_rows=SMALL)
    assert [float(x) for x in plain.first()] == [float(x) for x in cut.first()]


def test_percentile_brackets_on_many_rows(spark):
    big = spark.range(300_000).select((F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7).alias("v"))
    plain = percentiles(big, [], "v", {"a": 0.5, "b": 0.999}, max_rows=None).first()
    cut = percentiles(big, [], "v", {"a": 0.5, "b": 0.999}, max_rows=50_000).first()
    assert plain.a == pytest.approx(cut.a) and plain.b == pytest.approx(cut.b)


def test_exact_percentiles_keep_their_buffer_bound(spark):
    """600,000 distinct values in one group, with the row limits that the operators have by default."""
    big = spark.range(600_001).select(F.lit(1).alias("k"), (F.pmod(F.col("id") * 7919, F.lit(600_001)) * 1.0).alias("v"))
    for out in (V.median_over(big, ["k"], "v"), percentiles(big, ["k"], "v", {"median": 0.5})):
        assert " percentile(" not in out._jdf.queryExecution().optimizedPlan().toString()
        assert [r.median for r in out.select("median").distinct().collect()] == [300_000.0]
    scored = M.mad_score(big.select("v"), "v")
    assert " percentile(" not in scored._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.median, r.mad) for r in scored.select("median", "mad").distinct().collect()] == [(300_000.0, 150_000.0)]
    assert "percentile(" in V.median_over(big.limit(10), ["k"], "v")._jdf.queryExecution().optimizedPlan().toString()


def test_over_group_and_attach(rows):
    both(lambda m: over_group(rows, ["user_id"], {"m": F.avg("value"), "x": F.max("maybe")}, m))
    per_key = rows.groupBy("user_id").agg(F.count("*").alias("n"))
    both(lambda m: attach(rows, per_key, ["user_id"], "left", m))


def test_hot_groups_are_found(rows):
    hot = find_hot(rows, ["user_id"], SMALL)
    found = [(r.user_id, r._hot_rows) for r in hot.groups.collect()]
    assert found[0][0] == 7 and all(n > SMALL for _, n in found)
    assert find_hot(rows, ["user_id"], 10**6) is None


def test_window_operators(rows):
    both(lambda m: V.event_distance(rows, ["user_id"], "ts", F.col("event_type") == "error", m))
    both(lambda m: V.median_over(rows, ["user_id"], "value", max_rows=m))
    both(lambda m: V.rank_all(rows, ["hour"], ["event_id"], max_rows=m))
    both(lambda m: V.pct_change(rows, ["ts"], "value", ["user_id"], m))
    both(lambda m: V.first_last_value(rows, "ts", "value", ["user_id"], m))


def test_time_series_operators(rows):
    known = rows.filter("user_id IS NOT NULL")
    both(lambda m: S.state_runs(rows, "user_id", "ts", "event_type", "error", m))
    both(lambda m: S.sessionize(rows, "user_id", "ts", 6 * 3600, max_rows=m))
    both(lambda m: S.rolling_volatility(rows, "user_id", "ts", "value", 5, 9, max_rows=m))
    both(lambda m: S.detrend_dow(rows, "ts", "value", m))
    both(lambda m: S.ema(known, "user_id", "ts", "value", 0.1, max_rows=m))
    both(lambda m: M.zscore_flags(rows, "user_id", "ts", "value", 20, 1.5, m))
    both(lambda m: M.mad_score(rows, "value", m))


def test_ema_after_a_null_value(rows):
    holes = rows.filter("user_id = 7").withColumn("v", F.when(F.col("event_id") != 300, F.col("value")))
    both(lambda m: S.ema(holes, "user_id", "ts", "v", 0.2, max_rows=m))
    out = S.ema(holes, "user_id", "ts", "v", 0.2, max_rows=SMALL)
    assert out.filter("event_id >= 300 AND ema IS NOT NULL").count() == 0
    assert out.filter("event_id < 300 AND ema IS NULL").count() == 0


def test_joins(rows):
    left = rows.filter("event_type = 'error'").select("event_id", "user_id", F.col("ts").alias("at"))
    right = rows.filter("event_type <> 'error'").select(F.col("event_id").alias("other"), "user_id", F.col("ts").alias("was"))
    for by in (["user_id"], []):
        r = right if by else right.drop("user_id")
        both(lambda m: J.asof_join(left, r, "at", "was", ["other", "was"], by, "other", max_rows=m))
        both(lambda m: J.nearest_within(left, r, "at", "was", "other", ["was"], 7200, by, max_rows=m))
    both(lambda m: J.latest_by_anti(rows, ["user_id"], "hour", m))
    both(lambda m: J.first_rows(rows, ["user_id"], "hour", m))


def test_null_keys_match_nothing(rows):
    left = rows.filter("user_id IS NULL").select("event_id", "user_id", F.col("ts").alias("at"))
    right = rows.select(F.col("event_id").alias("other"), "user_id", F.col("ts").alias("was"))
    out = J.asof_join(left, right, "at", "was", ["other"], ["user_id"], "other")
    assert out.count() == left.count() and out.filter("other IS NOT NULL").count() == 0


@pytest.mark.parametrize("start", ["hour", "ts"])
def test_overlaps_against_all_pairs(rows, start):
    spans = rows.filter("user_id IS NOT NULL").select(
        "event_id", "user_id", F.col(start).alias("a"), (F.col(start) + F.expr("interval 40 minutes")).alias("b")
    )
    got = J.overlap_counts(spans, "user_id", "a", "b", max_rows=SMALL).select("event_id", "n_overlaps").toPandas()
    pdf = spans.toPandas()
    want = [
        int(((pdf.user_id != r.user_id) & (pdf.a <= r.b) & (pdf.b >= r.a)).sum()) for r in pdf.itertuples()
    ]
    assert dict(zip(got.event_id, got.n_overlaps)) == dict(zip(pdf.event_id, want))


def test_string_parts_make_the_whole(rows):
    whole = A.string_agg(rows, ["user_id"], "event_id", ["ts"], out="listed")
    parts = A.string_agg_parts(rows, ["user_id"], "event_id", ["ts"], 7, max_rows=SMALL)
    glued = A.string_agg(parts, ["user_id"], "listed", ["part"], out="listed")
    same(whole, glued, "user_id")


def test_grids_whose_keys_share_every_step_are_not_sorted(spark, monkeypatch):
    """No cut points are looked for, and what is sent are values and chunks, however long the grids are."""
    from tablecraft.plans import ordered

    monkeypatch.setattr(ordered, "_cuts", lambda *_: pytest.fail("grids are cut by the number of the step"))
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    rows = [(k, at(s), v) for k in (*range(30), None) for s, v in ((0, 1.0), (400 + (k or 0), None), (700, 2.0), (705, 3.0), (999, None))]
    df = spark.createDataFrame([*rows, (99, None, 4.0)], "k int, ts timestamp_ntz, v double")
    for size in (1, 7, 100, 999, 1000, None):
        got = S.grid_ffill(df, "k", "ts", "v", 1, max_rows=size)
        want = [1.0] * 700 + [2.0] * 5 + [3.0] * 295
        for k in (0, 29, None):
            own = got.filter(F.col("k").eqNullSafe(F.lit(k))).orderBy("bucket_ts").collect()
            assert [r.imputed_value for r in own] == want and [r.bucket_ts for r in own] == [at(s) for s in range(1000)], (size, k)
        none = got.filter("k = 99").collect()
        assert len(none) == 1000 and {r.imputed_value for r in none} == {None}
        assert S.gap_fill_prev(df, "k", "ts", "v", 1, max_rows=size).count() == 31_000
