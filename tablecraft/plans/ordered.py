"""Ordered work inside groups of any size.

Running totals, last-known values, ranks and moving frames need the rows of a
group in order.  For ordinary groups a Spark window does that.  A group with a
large share of all rows would put one task to sort it, so such a group is cut
into pieces along its order:

* *carry*: each piece is scanned on its own; one summary row per piece is
  combined over the earlier pieces and added back (running values, ranks);
* *overlap*: frames of a fixed reach are answered inside a piece that also holds
  copies of the neighbouring rows the frame can touch.

Cut points are approximate quantiles of the order column.  They decide only
where pieces end, never the result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from tablecraft.plans.skew import (
    HOT, MAX_ROWS, Hot, Limit, attach, find_hot, join_keys, mark_hot, over_group, with_scalars,
)

PIECE = "_piece"
POS = "_pos"
MAX_PIECES = 10_000

Order = Sequence[tuple[str, bool]]


def order_of(*cols: str) -> list[tuple[str, bool]]:
    """``"ts"`` ascending, ``"-ts"`` descending."""
    return [(c[1:], False) if c.startswith("-") else (c, True) for c in cols]


def _sort(order: Order) -> list[Column]:
    return [F.col(c).asc() if up else F.col(c).desc() for c, up in order]


def _reverse(order: Order) -> list[tuple[str, bool]]:
    return [(c, not up) for c, up in order]


# Bytes of a text, and bits of a whole number, that a double holds exactly.
_TEXT_BYTES, _LOW_BITS = 6, 32


def as_number(df: DataFrame, name: str) -> Column:
    """A double that never falls where the column rises; equal values stay equal.

    NULL is the least value and NaN the greatest, as in Spark's sort order.
    """
    return _levels(df, name)[0][0]


def _levels(df: DataFrame, name: str) -> list[tuple[Column, bool]]:
    """Numbers whose order, one after the other, is that of the column.

    The flag says that rows with equal numbers so far have equal values.  Texts are
    read six bytes at a time, so a text column has as many levels as its longest
    value needs; wide whole numbers are read in two halves.
    """
    kind, col = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        longest = df.agg(F.max(F.octet_length(col))).first()[0] or 1
        raw = col.cast("binary")
        out = []
        for at in range(1, longest + 1, _TEXT_BYTES):
            digits = F.rpad(F.hex(F.substring(raw, at, _TEXT_BYTES)), 2 * _TEXT_BYTES, "0")
            # one more, so that an end and a zero byte differ by the length that follows
            out.append((F.conv(digits, 16, 10).cast("double"), False))
        return [(_known(c), exact) for c, exact in [*out, (F.octet_length(col).cast("double"), True)]]
    if isinstance(kind, T.LongType):
        return [
            (_known(F.shiftright(col, _LOW_BITS).cast("double")), False),
            (_known(col.bitwiseAND(F.lit((1 << _LOW_BITS) - 1)).cast("double")), True),
        ]
    exact = True
    if isinstance(kind, T.TimestampNTZType):
        col = F.unix_micros(col.cast("timestamp"))
    elif isinstance(kind, T.TimestampType):
        col = F.unix_micros(col)
    elif isinstance(kind, T.DateType):
        col = F.unix_date(col)
    elif isinstance(kind, T.BooleanType):
        col = col.cast("int")
    elif isinstance(kind, T.DecimalType):
        exact = kind.precision <= 15
    elif not isinstance(kind, T.NumericType):
        raise TypeError(f"cannot order by {name}: {kind.simpleString()}")
    return [(_known(col.cast("double")), exact)]


def _known(number: Column) -> Column:
    return F.when(number.isNull(), F.lit(-math.inf)).when(F.isnan(number), F.lit(math.inf)).otherwise(number)


def _cuts(hot_rows: DataFrame, max_rows: int) -> tuple[list[float], list[float]]:
    """Cut points along ``POS`` and the values so frequent that they fill a piece."""
    pieces = min(MAX_PIECES, math.ceil(hot_rows.count() / max_rows))
    # Two per piece, so that a value which fills one shows at least twice.
    probs = [i / (2 * pieces) for i in range(1, 2 * pieces)] if pieces > 1 else []
    found = hot_rows.approxQuantile(POS, probs, 1.0 / (8 * pieces)) if probs else []
    # A value that is several quantiles becomes a piece of its own.
    heavy = sorted(v for v, times in Counter(found).items() if times > 1)
    ends = set(found) | {math.nextafter(v, math.inf) for v in heavy}
    return sorted(v for v in ends if -math.inf < v < math.inf), heavy


def cut(
    df: DataFrame, by: Sequence[str], order: Order, max_rows: Limit = MAX_ROWS, ties: bool = True
) -> tuple[DataFrame, Hot, list[float]] | None:
    """Rows with their piece number, hot groups cut along their order.

    Returns None when no group is hot.  Pieces are numbered in the order of the
    rows; rows of other groups are all in piece 0.  Values so frequent that they
    fill a piece are cut further along what orders them next: the rest of a text or
    wide number, the next order column, and at last a hash of the whole row, since
    rows that tie in every order column may come in any order.  With ``ties=False``
    only the first number of the first order column cuts, and ties stay together.
    """
    hot = find_hot(df, by, max_rows)
    if hot is None:
        return None
    rows = mark_hot(df, by, hot).withColumn(PIECE, F.lit(0).cast("long"))
    active, firsts = F.col(HOT).isNotNull(), None
    depth = 0
    for name, up in [*order, (None, True)] if ties else order[:1]:
        if name is None:
            levels = [(F.xxhash64(*[F.col(c) for c in df.columns]).cast("double"), True)]
        else:
            levels = _levels(df, name)
        exact = False
        for number, exact in levels if ties else levels[:1]:
            pos = f"{POS}{depth}" if depth else POS
            rows = rows.withColumn(pos, number)
            place = f"{depth}:{name}:{','.join(c for c, _ in order)}"
            if place not in hot.cuts:
                hot.cuts[place] = _cuts(rows.filter(active).withColumn(POS, F.col(pos)), hot.max_rows)
            cuts, heavy = hot.cuts[place]
            firsts = cuts if firsts is None else firsts
            span = len(cuts) + 1
            rows = _bucket(rows, pos, cuts, "_bucket")
            step = F.when(~active, 0).otherwise(F.col("_bucket") if up else span - 1 - F.col("_bucket"))
            rows = rows.withColumn(PIECE, (F.col(PIECE) * span + step).cast("long")).drop("_bucket")
            active = active & F.col(pos).isin(heavy) if heavy else F.lit(False)
            depth += 1
            if not heavy:
                break
        if not heavy or not exact:
            break
    return rows.drop(*[f"{POS}{k}" for k in range(1, depth)]), hot, firsts


def _bucket(rows: DataFrame, pos: str, cuts: list[float], out: str) -> DataFrame:
    """Index of the interval between cuts that holds the position."""
    if not cuts:
        return rows.withColumn(out, F.lit(0))
    find = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="_bin_in", outputCol="_bin_out", handleInvalid="keep")
    placed = find.transform(rows.withColumn("_bin_in", F.coalesce(F.col(pos), F.lit(0.0))))
    return placed.withColumn(out, F.col("_bin_out").cast("int")).drop("_bin_in", "_bin_out")


def _piece_summary(rows: DataFrame, by: Sequence[str], aggs: list[Column]) -> DataFrame:
    return rows.filter(F.col(HOT).isNotNull()).groupBy(*by, PIECE).agg(*aggs)


def _earlier(by: Sequence[str]) -> WindowSpec:
    # One row per piece: at most MAX_PIECES + 2 rows of a group.
    return W.partitionBy(*by).orderBy(PIECE).rowsBetween(W.unboundedPreceding, -1)


_RUN: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "count": F.count,
    "min": F.min,
    "max": F.max,
    "last": lambda c: F.last(c, ignorenulls=True),
}


def _combine(fn: str, carried: Column, local: Column) -> Column:
    if fn == "count":
        return F.coalesce(carried, F.lit(0)) + local
    if fn == "sum":
        return F.when(carried.isNull(), local).otherwise(carried + F.coalesce(local, F.lit(0)))
    if fn == "max":
        return F.greatest(carried, local)
    if fn == "min":
        return F.least(carried, local)
    return F.coalesce(local, carried)


def running(
    df: DataFrame,
    by: Sequence[str],
    order: Order,
    aggs: dict[str, tuple[str, str | Column]],
    frame: str = "rows",
    current: bool = True,
    max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """Running ``sum``, ``count``, ``min``, ``max`` or ``last`` (non-null) values.

    ``frame="range"`` includes all peers of the current row; ``current=False``
    (row frames only) stops at the row before.
    """
    by = list(by)
    values = {out: (F.col(c) if isinstance(c, str) else c) for out, (_, c) in aggs.items()}
    if frame == "range":
        max_rows = find_hot(df, by, max_rows)
        if max_rows is not None:
            return _running_peers(df, by, order, aggs, values, max_rows)
    done = cut(df, by, order, max_rows)
    keys = by if done is None else [*by, PIECE]
    rows = df if done is None else done[0]
    w = W.partitionBy(*keys).orderBy(*_sort(order))
    end = 0 if current else -1
    w = w.rangeBetween(W.unboundedPreceding, end) if frame == "range" else w.rowsBetween(W.unboundedPreceding, end)
    local = rows.withColumns({out: _RUN[fn](values[out]).over(w) for out, (fn, _) in aggs.items()})
    if done is None:
        return local
    in_order = W.partitionBy(*keys).orderBy(*_sort(order))
    lasts = {f"_own_{out}": values[out] for out, (fn, _) in aggs.items() if fn == "last"}
    if lasts:
        # One sort gives the window and the place in it.
        marks = {n: c for n, c in lasts.items()} | {"_at": F.row_number().over(in_order)}
        local = rows.withColumns(marks).withColumns({out: _RUN[fn](values[out]).over(w) for out, (fn, _) in aggs.items()})

    parts = []
    for out, (fn, _) in aggs.items():
        if fn == "last":
            # what the last row of the piece hands on, as a mergeable aggregate
            handed = F.struct(F.coalesce(F.col(f"_own_{out}"), F.col(out)).alias("v"))
            parts.append(F.max_by(handed, "_at")["v"].alias(f"_part_{out}"))
        else:
            parts.append(_RUN[fn](values[out]).alias(f"_part_{out}"))
    summary = _piece_summary(local if lasts else rows, by, parts)
    w_before = _earlier(by)
    carry = summary.select(
        *by,
        PIECE,
        *[
            (F.sum if fn in ("sum", "count") else _RUN[fn])(F.col(f"_part_{out}")).over(w_before).alias(f"_carry_{out}")
            for out, (fn, _) in aggs.items()
        ],
    )
    joined = join_keys(local, carry, [*by, PIECE], "left")
    return joined.select(
        *[joined[c] for c in df.columns if c not in aggs],
        *[_combine(fn, F.col(f"_carry_{out}"), F.col(out)).alias(out) for out, (fn, _) in aggs.items()],
    )


def _running_peers(df: DataFrame, by: list[str], order: Order, aggs: dict, values: dict, hot: Hot) -> DataFrame:
    """Running values up to the last peer: one row per order value, then back to the rows.

    However many rows share an order value, they are one row while in order.
    """
    at = list(dict.fromkeys([*by, *(c for c, _ in order)]))
    points = df.groupBy(*at).agg(*[_RUN[fn](values[out]).alias(out) for out, (fn, _) in aggs.items()])
    merged = {out: ("sum" if fn == "count" else fn, out) for out, (fn, _) in aggs.items()}
    line = running(points, by, order, merged, max_rows=hot.max_rows).select(*at, *aggs)
    return attach(df.drop(*aggs), line, at, "left", hot.max_rows)


def last_known(
    df: DataFrame, by: Sequence[str], order: Order, cols: dict[str, str | Column],
    current: bool = True, max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """Latest non-null value at or before each row."""
    return running(df, by, order, {o: ("last", c) for o, c in cols.items()}, "rows", current, max_rows)


def next_known(
    df: DataFrame, by: Sequence[str], order: Order, cols: dict[str, str | Column],
    current: bool = False, max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """Earliest non-null value after (or at) each row."""
    return running(df, by, _reverse(order), {o: ("last", c) for o, c in cols.items()}, "rows", current, max_rows)


def ranked(
    df: DataFrame,
    by: Sequence[str],
    order: Order,
    row_number: str | None = None,
    rank: str | None = None,
    dense_rank: str | None = None,
    max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """Row numbers and ranks over whole groups."""
    by = list(by)
    hot = find_hot(df, by, max_rows)
    if hot is None:
        w = W.partitionBy(*by).orderBy(*_sort(order))
        asked = {row_number: F.row_number(), rank: F.rank(), dense_rank: F.dense_rank()}
        return df.withColumns({name: fn.over(w) for name, fn in asked.items() if name})
    out = df
    if rank or dense_rank:
        # one row per order value: ties are counted before anything is in order
        at = list(dict.fromkeys([*by, *(c for c, _ in order)]))
        points = df.groupBy(*at).agg(F.count(F.lit(1)).alias("_n"))
        before = {"_better": ("sum", "_n"), "_above": ("count", F.lit(1))}
        line = running(points, by, order, before, current=False, max_rows=hot.max_rows)
        ranks = {rank: F.coalesce("_better", F.lit(0)) + 1, dense_rank: F.col("_above") + 1}
        out = attach(out, line.select(*at, *[c.alias(n) for n, c in ranks.items() if n]), at, "left", hot.max_rows)
    if row_number:
        rows = cut(out, by, order, hot)[0]
        local = rows.withColumn(row_number, F.row_number().over(W.partitionBy(*by, PIECE).orderBy(*_sort(order))))
        sizes = _piece_summary(rows, by, [F.count(F.lit(1)).alias("_n")])
        carry = sizes.select(*by, PIECE, F.sum("_n").over(_earlier(by)).alias("_before"))
        joined = join_keys(local, carry, [*by, PIECE], "left")
        total = F.col(row_number) + F.coalesce(F.col("_before"), F.lit(0))
        out = joined.withColumn(row_number, total).select(*out.columns, row_number)
    return out


def framed(
    df: DataFrame,
    by: Sequence[str],
    order: Order,
    before: int,
    after: int,
    columns: Callable[[WindowSpec], dict[str, Column]],
    max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """Window columns that look at most ``before`` rows back and ``after`` ahead.

    ``columns`` receives the ordered window (no frame yet) and returns the
    columns to add, for example ``lag`` or an average over a row frame.
    """
    by = list(by)
    hot = find_hot(df, by, max_rows)
    if hot is None:
        return df.withColumns(columns(W.partitionBy(*by).orderBy(*_sort(order))))
    size = max(hot.max_rows, before + after + 1)
    numbered = ranked(df, by, order, row_number="_rn", max_rows=hot)
    at = F.pmod(F.col("_rn") - 1, F.lit(size))
    home = F.floor((F.col("_rn") - 1) / size)
    spots = F.array(
        F.lit(0),
        F.when(at >= size - before, F.lit(1)) if before else F.lit(None).cast("int"),
        F.when(at < after, F.lit(-1)) if after else F.lit(None).cast("int"),
    )
    copies = (
        numbered.withColumn("_home", home)
        .withColumn("_shift", F.explode(F.array_compact(spots)))
        .withColumn("_block", F.col("_home") + F.col("_shift"))
    )
    # by row number: ties keep the order they were numbered in
    wide = copies.withColumns(columns(W.partitionBy(*by, "_block").orderBy("_rn")))
    return wide.filter(F.col("_shift") == 0).drop("_rn", "_home", "_shift", "_block")


def time_framed(
    df: DataFrame,
    by: Sequence[str],
    ts: str,
    seconds: int,
    columns: Callable[[WindowSpec], dict[str, Column]],
    max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """Window columns over all rows of the last ``seconds`` up to the current row.

    ``columns`` receives the window with its RANGE frame.
    """
    by = list(by)
    reach = seconds * 1_000_000
    micros = df.withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp")))
    timed = micros.withColumn("_pos_us", F.col("_us").cast("double"))
    done = cut(timed, by, [("_pos_us", True)], max_rows, ties=False)
    if done is None:
        w = W.partitionBy(*by).orderBy("_us").rangeBetween(-reach, 0)
        return micros.withColumns(columns(w)).drop("_us")
    rows, _, cuts = done
    ahead = _bucket(rows.withColumn("_reach", F.col(POS) + reach), "_reach", cuts, "_until")
    last = F.when(F.col(HOT).isNull() | F.col(POS).isNull(), F.col(PIECE)).otherwise(F.col("_until"))
    copies = ahead.withColumn("_at", F.explode(F.sequence(F.col(PIECE), last.cast("long"))))
    w = W.partitionBy(*by, "_at").orderBy("_us").rangeBetween(-reach, 0)
    wide = copies.withColumns(columns(w))
    return wide.filter(F.col("_at") == F.col(PIECE)).drop("_us", "_at", "_until", "_reach", "_pos_us", PIECE, POS, HOT)


#: Rows of a piece where a moving frame is read row by row.
FRAME_ROWS = 10_000

_MERGE: dict[str, Callable[[Column], Column]] = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def time_totals(
    df: DataFrame, by: Sequence[str], ts: str, seconds: int, aggs: dict[str, tuple[str, str]],
    max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """``sum``, ``count``, ``min`` or ``max`` over the last ``seconds``: one row per group and time.

    A hot group is cut along its time.  A frame is the part of its own piece, the
    part of the piece where it begins, and the pieces between.  The first is a frame
    inside the piece; for the second the row asks that piece with one extra row,
    however far the frame reaches; the third is put together from totals of 1, 2, 4,
    ... neighbouring pieces, so nothing is subtracted and one table serves all four.
    Rows without a time are the frame of each other.
    """
    by = list(by)
    reach = seconds * 1_000_000
    hot = find_hot(df, by, max_rows)
    points = df.groupBy(*by, ts).agg(*[_RUN[fn](F.col(c)).alias(out) for out, (fn, c) in aggs.items()])
    timed = points.withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp")))
    if hot is None:
        w = W.partitionBy(*by).orderBy("_us").rangeBetween(-reach, 0)
        return timed.withColumns({out: _MERGE[fn](out).over(w) for out, (fn, _) in aggs.items()}).drop("_us")
    rows, spread, levels = asked(timed, by, reach, list(aggs), hot)
    asks = F.col("_asks")
    piece = W.partitionBy(*by, "_at")
    inside, onward = piece.orderBy("_time").rangeBetween(-reach, 0), piece.orderBy(F.desc("_time"))
    read = spread.withColumns(
        {f"_own_{out}": _MERGE[fn](out).over(inside) for out, (fn, _) in aggs.items()}
        | {f"_edge_{out}": _MERGE[fn](out).over(onward.rangeBetween(W.unboundedPreceding, 0)) for out, (fn, _) in aggs.items()}
    )
    edges = read.groupBy(*by, ts).agg(
        F.max("_from").alias("_from"), F.max(PIECE).alias("_to"),
        *[F.max(F.when(~asks, F.col(f"_own_{out}"))).alias(f"_own_{out}") for out in aggs],
        *[F.max(F.when(asks, F.col(f"_edge_{out}"))).alias(f"_edge_{out}") for out in aggs],
    )

    between = _totals_between(rows, edges, by, aggs, levels)
    whole = join_keys(edges, between, [*by, "_from", "_to"], "left")
    return whole.select(
        *by, ts,
        *[
            _combine(fn, F.col(f"_mid_{out}"), _combine(fn, F.col(f"_edge_{out}"), F.col(f"_own_{out}"))).alias(out)
            for out, (fn, _) in aggs.items()
        ],
    )


def asked(timed: DataFrame, by: list[str], reach: int, cols: list[str], hot: Hot) -> tuple[DataFrame, DataFrame, int]:
    """Rows in pieces, the same once as themselves and once where their frame begins, and the block sizes needed."""
    fine = Hot(hot.groups, min(hot.max_rows, FRAME_ROWS))
    rows, _, cuts = cut(timed.withColumn("_pos_us", F.col("_us").cast("double")), by, [("_pos_us", True)], fine, ties=False)
    rows = _bucket(rows.withColumn("_start", F.col(POS) - reach), "_start", cuts, "_from").withColumn(
        "_from", F.when(F.col(HOT).isNull() | F.col("_us").isNull(), F.col(PIECE)).otherwise(F.col("_from").cast("long"))
    )
    begins = F.when(F.col("_from") < F.col(PIECE), F.lit(True))
    asks = F.col("_asks")
    spread = rows.withColumn("_asks", F.explode(F.array_compact(F.array(F.lit(False), begins)))).withColumns(
        {
            "_at": F.when(asks, F.col("_from")).otherwise(F.col(PIECE)),
            "_time": F.when(asks, F.col("_us") - reach).otherwise(F.col("_us")),
            **{c: F.when(~asks, F.col(c)) for c in cols},
        }
    )
    return rows, spread, len(cuts).bit_length()


def _totals_between(rows: DataFrame, edges: DataFrame, by: list[str], aggs: dict, levels: int) -> DataFrame:
    """Totals of the pieces strictly between ``_from`` and ``_to``, for the pairs that occur.

    Both ends rise with time, so a group has at most twice as many pairs as pieces,
    and a pair takes at most two blocks of each size.
    """
    totals = _piece_summary(rows.filter(F.col("_us").isNotNull()), by, [_MERGE[fn](out).alias(out) for out, (fn, _) in aggs.items()])
    sized = totals.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    blocks = sized.groupBy(*by, "_level", F.expr(f"shiftright({PIECE}, _level)").alias("_block")).agg(
        *[_MERGE[fn](out).alias(f"_mid_{out}") for out, (fn, _) in aggs.items()]
    )
    pairs = edges.filter("_to - _from > 1").select(*by, "_from", "_to").distinct()
    # At size 2^k the open ends are ceil((_from + 1) / 2^k) and floor(_to / 2^k); an odd end is a block of its own.
    ends = pairs.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(levels)))).withColumns(
        {
            "_low": F.expr("shiftright(_from + shiftleft(1L, _level), _level)"),
            "_high": F.expr("shiftright(_to, _level)"),
        }
    ).filter("_low < _high")
    taken = ends.withColumn(
        "_block",
        F.explode(F.array_compact(F.array(F.expr("IF(_low % 2 = 1, _low, NULL)"), F.expr("IF(_high % 2 = 1, _high - 1, NULL)")))),
    ).drop("_low", "_high")
    found = join_keys(taken, blocks, [*by, "_level", "_block"], "inner")
    return found.groupBy(*by, "_from", "_to").agg(*[_MERGE[fn](f"_mid_{out}").alias(f"_mid_{out}") for out, (fn, _) in aggs.items()])


def tiles(df: DataFrame, by: Sequence[str], order: Order, n: int, out: str, max_rows: Limit = MAX_ROWS) -> DataFrame:
    """NTILE from the row number and the group size."""
    hot = find_hot(df, by, max_rows)
    numbered = ranked(df, by, order, row_number="_rn", max_rows=hot)
    if by:
        sized = over_group(numbered, by, {"_n": F.count(F.lit(1))}, hot)
    else:
        sized = with_scalars(numbered, df.agg(F.count(F.lit(1)).alias("_n")))
    small = F.floor(F.col("_n") / n)
    wide = F.col("_n") % n
    edge = wide * (small + 1)
    tile = F.when(F.col("_rn") <= edge, F.ceil(F.col("_rn") / (small + 1))).otherwise(
        wide + F.ceil((F.col("_rn") - edge) / F.greatest(small, F.lit(1)))
    )
    return sized.withColumn(out, tile.cast("int")).drop("_rn", "_n")
