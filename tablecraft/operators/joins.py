"""Joins and subqueries, written as joins that Spark can distribute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablecraft.functions.exprs import seconds_between
from tablecraft.plans.ordered import last_known, next_known, order_of, running
from tablecraft.plans.skew import MAX_ROWS, Limit, attach, find_hot, over_group, with_scalars


def join_chain(first: DataFrame, *steps: tuple[DataFrame, str, str], how: str = "inner") -> DataFrame:
    """Equi-join several tables in turn; each step is (table, left key, right key).

    The join algorithm is left to AQE, which broadcasts a side only after
    measuring it and splits skewed partitions of the others.
    """
    out = first
    for table, left, right in steps:
        out = out.join(table, F.col(left) == F.col(right), how)
    return out


def left_join_chain(first: DataFrame, *steps: tuple[DataFrame, str, str]) -> DataFrame:
    return join_chain(first, *steps, how="left")


def spine_join(spine: DataFrame, data: DataFrame, key: str, counts: Sequence[str]) -> DataFrame:
    """Every spine value with its counts, 0 where the data has none.

    ``data`` is already aggregated to one row per key.
    """
    return spine.join(data, key, "left").na.fill(0, list(counts))


def natural_left_unmatched(left: DataFrame, right: DataFrame, probe: str) -> DataFrame:
    """NATURAL LEFT JOIN kept where a right-hand column came back NULL."""
    shared = [c for c in left.columns if c in right.columns]
    return left.join(right, shared, "left").filter(F.col(probe).isNull()).select(*left.columns)


def anti_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right, list(on), "left_anti").select(*left.columns)


def anti_join_is_null(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """The LEFT JOIN .. IS NULL form over distinct right-hand keys."""
    keys = right.select(*on).distinct().withColumn("_there", F.lit(True))
    return left.join(keys, list(on), "left").filter(F.col("_there").isNull()).select(*left.columns)


def _extreme_rows(df: DataFrame, ids: Sequence[str], ts: str, pick, max_rows: int) -> DataFrame:
    best = over_group(df, ids, {"_best": pick(F.col(ts))}, max_rows)
    keep = F.col("_best").isNull() | F.col(ts).isNull() | (F.col(ts) == F.col("_best"))
    for c in ids:
        keep = keep | F.col(c).isNull()
    return best.filter(keep).drop("_best")


def latest_by_anti(df: DataFrame, ids: Sequence[str], ts: str, max_rows: Limit = MAX_ROWS) -> DataFrame:
    """Rows with no later row of the same id; ties stay.

    Same rows as the self anti join on ``t2.ts > t1.ts``, from one maximum per
    id instead of all pairs.  As in the join, a row with a NULL id or time stays.
    """
    return _extreme_rows(df, ids, ts, F.max, max_rows)


def first_rows(df: DataFrame, ids: Sequence[str], ts: str, max_rows: Limit = MAX_ROWS) -> DataFrame:
    """Rows with no earlier row of the same id (NOT EXISTS); ties stay."""
    return _extreme_rows(df, ids, ts, F.min, max_rows)


def not_in(df: DataFrame, col: str, sub: DataFrame, sub_col: str) -> DataFrame:
    """``col NOT IN (sub)`` with its NULL rules, as an ordinary anti join.

    A NULL in the list gives no rows; an empty list gives all rows; otherwise a
    NULL on the left is dropped.  The built-in form must broadcast the list.
    """
    keys = sub.select(F.col(sub_col).alias(col))
    facts = sub.agg(
        F.coalesce(F.max(F.col(sub_col).isNull()), F.lit(False)).alias("_has_null"),
        (F.count(F.lit(1)) == 0).alias("_empty"),
    )
    rest = with_scalars(df.join(keys.filter(F.col(col).isNotNull()), col, "left_anti"), facts)
    kept = rest.filter(~F.col("_has_null") & (F.col(col).isNotNull() | F.col("_empty")))
    return kept.select(*df.columns)


def in_heavy_keys(df: DataFrame, key: str, facts: DataFrame, fact_key: str, more_than: int) -> DataFrame:
    """Rows whose key has more than ``more_than`` fact rows."""
    heavy = facts.groupBy(F.col(fact_key).alias(key)).count().filter(F.col("count") > more_than)
    return df.join(heavy, key, "left_semi").select(*df.columns)


def divide(keys: DataFrame, facts: DataFrame, key: str, val: str, divisor: DataFrame) -> DataFrame:
    """Keys that occur with every divisor value; all keys if there is none."""
    wanted = divisor.select(val).filter(F.col(val).isNotNull()).distinct()
    found = (
        facts.select(key, val).distinct().join(wanted, val, "left_semi")
        .groupBy(key).agg(F.count(F.lit(1)).alias("_found"))
    )
    matched = with_scalars(keys.join(found, key, "left"), wanted.agg(F.count(F.lit(1)).alias("_wanted")))
    return matched.filter(F.coalesce("_found", F.lit(0)) == F.col("_wanted")).select(*keys.columns)


def gt_some(df: DataFrame, col: str, sub: DataFrame, sub_col: str, strict: bool = True) -> DataFrame:
    """``col > SOME (sub)``: greater than the smallest of them."""
    low = with_scalars(df, sub.agg(F.min(sub_col).alias("_low")))
    test = F.col(col) > F.col("_low") if strict else F.col(col) >= F.col("_low")
    return low.filter(test).select(*df.columns)


def gt_threshold(df: DataFrame, col: str, sub: DataFrame, sub_col: str) -> DataFrame:
    """The self-join form, which admits equality."""
    return gt_some(df, col, sub, sub_col, strict=False)


def arg_max_groups(df: DataFrame, by: Sequence[str], count: str = "n") -> DataFrame:
    """Groups whose size is ``>= ALL`` group sizes; ties stay."""
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias(count))
    best = with_scalars(sizes, sizes.agg(F.max(count).alias("_best")))
    return best.filter(F.col(count) >= F.col("_best")).drop("_best")


def scalar_filter(df: DataFrame, col: str, value: Column, source: DataFrame | None = None) -> DataFrame:
    """Rows where ``col`` equals an aggregate of the whole table."""
    one = (df if source is None else source).agg(value.alias("_value"))
    return with_scalars(df, one).filter(F.col(col) == F.col("_value")).select(*df.columns)


def corr_count(outer: DataFrame, key: str, inner: DataFrame, inner_key: str, out: str = "n") -> DataFrame:
    """Correlated ``count(*)`` per outer row; 0 where there is none."""
    counts = inner.groupBy(F.col(inner_key).alias(key)).agg(F.count(F.lit(1)).alias(out))
    return outer.join(counts, key, "left").na.fill(0, [out])


def cte_count_join(outer: DataFrame, key: str, inner: DataFrame, inner_key: str, out: str = "n") -> DataFrame:
    """The grouped-CTE form: outer rows without inner rows are absent."""
    counts = inner.groupBy(F.col(inner_key).alias(key)).agg(F.count(F.lit(1)).alias(out))
    return outer.join(counts, key)


def top_id_per_day(df: DataFrame, day: str, id_: str, out: str = "n") -> DataFrame:
    """Busiest id of each day, lowest id on a tie.

    Counted first; the best id of a day is a mergeable aggregate.
    """
    counts = df.groupBy(day, id_).agg(F.count(F.lit(1)).alias(out))
    best = counts.groupBy(day).agg(F.min(F.struct((-F.col(out)).alias("_neg"), F.col(id_))).alias("_best"))
    return best.select(day, F.col(f"_best.{id_}").alias(id_), (-F.col("_best._neg")).alias(out))


def streak_count(df: DataFrame, day: str, id_: str, out: str = "n_ids") -> DataFrame:
    """Per day, the ids that were active on that day and every day before it."""
    active = df.select(day, id_).distinct()
    # After the distinct an id has at most one row per calendar day.
    nth = active.withColumn("_nth", F.row_number().over(W.partitionBy(id_).orderBy(day)))
    first = with_scalars(nth, df.agg(F.min(day).alias("_first")))
    kept = F.col("_nth") == F.datediff(F.col(day), F.col("_first")) + 1
    return first.groupBy(day).agg(F.count(F.when(kept, 1)).alias(out))


def with_params(df: DataFrame, params: dict | DataFrame) -> DataFrame:
    """Parameters beside every row, from a dict or a one-row table."""
    if isinstance(params, dict):
        return df.withColumns({k: F.lit(v) for k, v in params.items()})
    return with_scalars(df, params)


def overlap_counts(
    df: DataFrame, id_: str, start: str, end: str, out: str = "n_overlaps", max_rows: Limit = MAX_ROWS
) -> DataFrame:
    """How many spans of other ids each span overlaps (ends inclusive).

    A span misses another only if that one starts after it ends or ends before
    it starts.  So the spans it touches are the starts up to its end less the
    ends before its start: two counts along the time line, taken over all ids and
    over its own id.  No pairs are made.
    """
    kind = df.schema[start].dataType
    ticks = df.select(
        id_,
        F.inline(
            F.array(
                F.struct(F.col(start).alias("_t"), F.lit(1).alias("_s"), F.lit(0).alias("_e")),
                F.struct(F.col(end).cast(kind).alias("_t"), F.lit(0).alias("_s"), F.lit(1).alias("_e")),
            )
        ),
    )
    sums = [F.sum("_s").alias("_s"), F.sum("_e").alias("_e")]
    counts = {"_started": ("sum", "_s"), "_ended": ("sum", "_e")}
    gone = F.col("_ended") - F.col("_e")

    # A group of spans is hot only where its id, or its end or start, is.
    by_id = find_hot(df, [id_], max_rows)
    by_end = by_id and find_hot(df, [id_, end], by_id.max_rows)
    by_start = by_id and find_hot(df, [id_, start], by_id.max_rows)

    everyone = running(ticks.groupBy("_t").agg(*sums), [], order_of("_t"), counts, max_rows=max_rows)
    line = everyone.select("_t", F.col("_started").alias("_all_started"), gone.alias("_all_gone"))
    points = ticks.groupBy(id_, "_t").agg(*sums)
    own = running(points, [id_], order_of("_t"), counts, max_rows=by_id and by_id.max_rows)
    # what others have started, and ended before, at each tick of an id; one row per id and tick
    both = attach(own.withColumn("_gone", gone), line, ["_t"], "left", find_hot(ticks, ["_t"], max_rows))
    others = both.select(
        id_, "_t", (F.col("_all_started") - F.col("_started")).alias("_started"), (F.col("_all_gone") - F.col("_gone")).alias("_gone")
    )
    at_end = others.select(id_, F.col("_t").alias(end), F.col("_started"))
    at_start = others.select(id_, F.col("_t").alias(start), F.col("_gone"))
    known = attach(attach(df, at_end, [id_, end], "left", by_end), at_start, [id_, start], "left", by_start)
    return known.withColumn(out, F.col("_started") - F.col("_gone")).drop("_started", "_gone")


def overlap_flag(df: DataFrame, id_: str, start: str, end: str, max_rows: Limit = MAX_ROWS) -> DataFrame:
    """1 for ids with a span that overlaps some other id's span."""
    counts = overlap_counts(df, id_, start, end, "_n", max_rows)
    return counts.groupBy(id_).agg(F.max((F.col("_n") > 0).cast("int")).alias("overlap"))


def mismatch_pairs(
    people: DataFrame, person: Column, person_dept: str, courses: DataFrame, course_dept: str,
    departments: DataFrame, dept: str,
) -> DataFrame:
    """Courses outside the person's department, beside that department.

    The third table only asks for some department other than the course's; the
    smallest and largest department answer that.  The person's departments are
    one array value, so no product of tables is formed.
    """
    mine = people.filter(person).agg(F.collect_set(person_dept).alias("_mine"))
    ends = departments.agg(F.min(dept).alias("_low"), F.max(dept).alias("_high"))
    wide = with_scalars(with_scalars(courses, ends), mine).withColumn(person_dept, F.explode("_mine"))
    c = F.col(course_dept)
    kept = wide.filter((F.col(person_dept) != c) & ((F.col("_low") != c) | (F.col("_high") != c)))
    return kept.drop("_mine", "_low", "_high").distinct()


_LEFT, _RIGHT = 1, 0


def _timeline(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, by: Sequence[str], cols: Sequence[str]):
    """Both series in one: right rows carry ``_found``, left rows carry ``_row``."""
    for k in by:
        right = right.filter(F.col(k).isNotNull())
    payload = F.struct(*[F.col(c) for c in cols])
    row = F.struct(*[F.col(c) for c in left.columns])
    kind = left.select(row.alias("_row")).schema["_row"].dataType
    found = right.select(payload.alias("_found")).schema["_found"].dataType
    lefts = left.select(
        *by, F.col(left_ts).alias("_t"), F.lit(_LEFT).alias("_side"), row.alias("_row"), F.lit(None).cast(found).alias("_found")
    )
    rights = right.select(
        *by, F.col(right_ts).alias("_t"), F.lit(_RIGHT).alias("_side"), F.lit(None).cast(kind).alias("_row"), payload.alias("_found")
    )
    return lefts.unionByName(rights)


def _one_per_time(right: DataFrame, ts: str, by: Sequence[str], tie: str | None, pick) -> DataFrame:
    """One row per key and time: the lowest or highest tie value among equal times."""
    if tie is None:
        return right
    others = [c for c in right.columns if c not in (*by, ts, tie)]
    best = right.groupBy(*by, ts).agg(pick(F.struct(F.col(tie), *[F.col(c) for c in others])).alias("_b"))
    return best.select(*by, ts, F.col(f"_b.{tie}").alias(tie), *[F.col(f"_b.{c}").alias(c) for c in others])


def asof_join(
    left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, cols: Sequence[str],
    by: Sequence[str] = (), tie: str | None = None, lag: str = "seconds_lag", max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """Latest right row at or before each left row; NULLs where there is none.

    The two series are merged and the last right row is carried forward, so the
    work is one sort per key.  ``by=()`` treats all rows as one series.  ``cols``
    are the right-hand columns to bring; ``tie`` picks the highest of equal times.
    """
    by = list(by)
    right = _one_per_time(right, right_ts, by, tie, F.max)
    line = _timeline(left, right, left_ts, right_ts, by, list(dict.fromkeys([*cols, right_ts])))
    # right rows come first at equal times
    seen = last_known(line, by, order_of("_t", "_side"), {"_found": "_found"}, max_rows=max_rows)
    out = seen.filter(F.col("_side") == _LEFT)
    return out.select(
        "_row.*", *[F.col(f"_found.{c}").alias(c) for c in cols],
        seconds_between(F.col("_t"), F.col(f"_found.{right_ts}")).alias(lag),
    )


def nearest_within(
    left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, id_: str, cols: Sequence[str],
    seconds: float, by: Sequence[str] = (), max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """Closest right row within ``seconds`` on either side; NULLs where none.

    The closest row is either the last at or before or the first after, so two
    scans of the merged series answer it without forming pairs.  Equal distance
    goes to the lower ``id_``.
    """
    by = list(by)
    cols = list(dict.fromkeys([id_, *cols]))
    single = _one_per_time(right, right_ts, by, id_, F.min)
    line = _timeline(left, single, left_ts, right_ts, by, list(dict.fromkeys([*cols, right_ts])))
    line = line.withColumn("_ahead", F.col("_found"))
    hot = find_hot(line, by, max_rows)
    seen = last_known(line, by, order_of("_t", "_side"), {"_found": "_found"}, max_rows=hot)
    seen = next_known(seen, by, order_of("_t", "_side"), {"_ahead": "_ahead"}, max_rows=hot)
    back = seconds_between(F.col("_t"), F.col(f"_found.{right_ts}"))
    ahead = seconds_between(F.col(f"_ahead.{right_ts}"), F.col("_t"))
    options = F.array(
        F.when(back <= seconds, F.struct(back.alias("d"), F.col(f"_found.{id_}").alias("i"), F.col("_found").alias("r"))),
        F.when(ahead <= seconds, F.struct(ahead.alias("d"), F.col(f"_ahead.{id_}").alias("i"), F.col("_ahead").alias("r"))),
    )
    best = seen.filter(F.col("_side") == _LEFT).withColumn("_best", F.array_min(options))
    return best.select(
        "_row.*", *[F.col(f"_best.r.{c}").alias(c) for c in cols], F.col("_best.d").alias("time_diff")
    )


def max_then_join(
    dim: DataFrame, key: str, links: DataFrame, link_key: str, link_value: str, details: DataFrame, detail_key: str
) -> DataFrame:
    """Each dimension row with its largest linked value and that value's details."""
    best = links.groupBy(F.col(link_key).alias(key)).agg(F.max(link_value).alias("_latest"))
    linked = dim.join(best, key, "left")
    return linked.join(details, F.col("_latest") == F.col(detail_key), "left").drop("_latest")


def multi_fact_rollup(
    base: DataFrame, key: str, facts: Sequence[DataFrame], group: Sequence[str]
) -> DataFrame:
    """Sum several facts by a dimension without fan-out.

    Each fact is summed to one row per ``key`` before it is joined.  Groups in
    which no sum is non-zero are dropped, NULL sums included.
    """
    measures: list[str] = []
    out = base
    for fact in facts:
        cols = [c for c in fact.columns if c != key]
        measures += cols
        out = out.join(fact.groupBy(key).agg(*[F.sum(c).alias(c) for c in cols]), key, "left")
    sums = out.groupBy(*group).agg(*[F.sum(c).alias(c) for c in measures])
    nonzero = F.lit(False)
    for c in measures:
        nonzero = nonzero | (F.col(c) != 0)
    return sums.filter(nonzero)
