"""Best-fit packing of token sequences with large-item matching.

Only lengths decide a packing, and there are at most ``capacity`` different ones.
So Spark counts the pieces of each length, the plan is made on these counts (never
on pieces), and each piece finds its place by its rank among pieces of its length.
The plan has a bounded number of lines, whatever the number of pieces: each step
uses up a length or a gap, and splits off two runs of sequences at most.
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.llm.text import as_bytes, fields_of, map_rows
from tablecraft.llm.tokens import encoder
from tablecraft.plans.storage import written

CAPACITY = 4096
END_ID = 1
#: Rows of one length that are ranked together.
RANK_ROWS = 1_000


class Plan:
    """Places for counted lengths: runs of sequences with equal contents, and who lies in them."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.opened = 0
        self.used: dict[int, int] = {}
        self.lines: list[tuple[int, int, int, int, int, int]] = []
        self.gaps: dict[int, list[tuple[int, int, int]]] = {}
        self.sizes: list[int] = []

    def open(self, n: int) -> tuple[int, int]:
        self.opened += n
        return self.opened - n, n

    def place(self, length: int, first: int, n: int, each: int, offset: int) -> None:
        """``n`` pieces of a length go, ``each`` together, to the sequences from ``first`` on."""
        rank = self.used.get(length, 0)
        self.used[length] = rank + n
        self.lines.append((length, rank, rank + n, first, each, offset))

    def leave(self, first: int, n: int, filled: int) -> None:
        gap = self.capacity - filled
        if n and gap:
            if not self.gaps.get(gap):
                bisect.insort(self.sizes, gap)
                self.gaps[gap] = []
            self.gaps[gap].append((first, n, filled))

    def tightest(self, length: int) -> tuple[int, int, int] | None:
        at = bisect.bisect_left(self.sizes, length)
        if at == len(self.sizes):
            return None
        gap = self.sizes[at]
        run = self.gaps[gap].pop()
        if not self.gaps[gap]:
            self.sizes.pop(at)
        return run


def plan_places(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Lines ``(length, rank from, rank to, first sequence, pieces of it in each, offset)``.

    Pieces above a third of the capacity: from the longest down, each takes the
    longest one left that fits beside it, so no sequence holds more than two of
    them.  Then the others, from the longest down, go to the tightest gap that
    takes them, and to new sequences where none does.
    """
    plan = Plan(capacity)
    left = {n: c for n, c in sorted(counts.items(), reverse=True) if 3 * n > capacity and c}
    for length in list(left):
        while left.get(length):
            n = left[length]
            mate = next((m for m in left if left[m] and length + m <= capacity and (m != length or n > 1)), None)
            if mate is None:
                first, k = plan.open(n)
                plan.place(length, first, k, 1, 0)
                plan.leave(first, k, length)
                left[length] = 0
            else:
                k = n // 2 if mate == length else min(n, left[mate])
                first, _ = plan.open(k)
                if mate == length:
                    plan.place(length, first, 2 * k, 2, 0)
                    left[length] -= 2 * k
                else:
                    plan.place(length, first, k, 1, 0)
                    plan.place(mate, first, k, 1, length)
                    left[length] -= k
                    left[mate] -= k
                plan.leave(first, k, length + mate)
    for length in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
        rest = counts[length]
        while rest:
            run = plan.tightest(length)
            if run is None:
                need = -(-rest // (capacity // length))
                first, n = plan.open(need)
                run = (first, n, 0)
            first, n, filled = run
            each = (capacity - filled) // length
            full = min(n, rest // each)
            if full:
                plan.place(length, first, full * each, each, filled)
                plan.leave(first, full, filled + each * length)
                rest -= full * each
                first, n = first + full, n - full
            if n and rest:
                # fewer are left than one more sequence takes
                plan.place(length, first, rest, rest, filled)
                plan.leave(first, 1, filled + rest * length)
                first, n, rest = first + 1, n - 1, 0
            plan.leave(first, n, filled)
    return plan.lines


def pieces(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """``(id, piece, start, length, ids)``: token ids plus the end id, cut where they exceed the capacity.

    ids are little-endian 32-bit numbers.  Null and empty texts are one piece that
    holds the end id only.
    """
    end = end_id.to_bytes(4, "little")

    def worker(batches):
        encode = encoder(path)
        for b in batches:
            out = {n: [] for n in (id_col, "piece", "start", "length", "ids")}
            for doc, text in zip(b[id_col], b["_text"]):
                ids = encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for name, value in zip(out, (doc, piece, at // 4, len(part) // 4, part)):
                        out[name].append(value)
            yield out

    fields = [
        *fields_of(docs, id_col), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
    ]
    return map_rows(docs.select(id_col, as_bytes(text_col).alias("_text")), fields, worker)


def pack(parts: DataFrame, keys: Sequence[str], capacity: int = CAPACITY, rank_rows: int = RANK_ROWS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    ``keys`` name a row; rows that are equal in them still get places of their own.
    ``parts`` is read twice and should be a written table.  Rows of a length are
    ranked in slices of about ``rank_rows``, since one length may hold most rows.
    """
    spark = parts.sparkSession
    # At most one row for each length up to the capacity: a bounded histogram, not the data.
    counts = {r[0]: r[1] for r in parts.groupBy("length").agg(F.count("*")).collect()}
    if any(not 1 <= n <= capacity for n in counts):
        raise ValueError(f"lengths must be 1 to {capacity}")
    slices = max(1, -(-max(counts.values(), default=0) // rank_rows))
    sliced = parts.withColumn("_slice", F.pmod(F.xxhash64(*keys), F.lit(slices)).cast("int"))
    ranked = sliced.withColumn(
        "_rank", F.row_number().over(W.partitionBy("length", "_slice").orderBy(*keys)).cast("long") - 1
    )
    starts = (
        sliced.groupBy("length", "_slice").agg(F.count("*").alias("_n"))
        .withColumn("_before", F.sum("_n").over(W.partitionBy("length").orderBy("_slice")) - F.col("_n"))
        .drop("_n")
    )
    lines = spark.createDataFrame(
        plan_places(counts, capacity),
        "length long, _from long, _to long, _first long, _each long, _at long",
    )
    at = ranked.join(starts, ["length", "_slice"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    # The plan has a bounded number of lines, see Plan; a rank lies in exactly one of its length.
    lists = lines.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("_from", "_to", "_first", "_each", "_at"))).alias("_lines"))
    placed = at.join(F.broadcast(lists), "length").withColumn(
        "_line", F.element_at(F.filter("_lines", lambda x: (x["_from"] <= F.col("_rank")) & (x["_to"] > F.col("_rank"))), 1)
    )
    into = F.col("_rank") - F.col("_line._from")
    return placed.select(
        *[F.col(c) for c in parts.columns],
        (F.col("_line._first") + F.floor(into / F.col("_line._each"))).cast("long").alias("sequence_id"),
        (F.col("_line._at") + (into % F.col("_line._each")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their ids and places; see :func:`pieces` and :func:`pack`."""
    return pack(written(pieces(docs, path, id_col, text_col), "pieces"), [id_col, "piece"])


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)``: the packed sequences themselves, at most one capacity each."""

    def join(table):
        rows = sorted(zip(table.column("offset").to_pylist(), table.column("ids").to_pylist()))
        joined = pa.array([b"".join(ids for _, ids in rows)], pa.binary())
        return pa.table({"sequence_id": table.column("sequence_id")[:1], "ids": joined})

    return packed.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInArrow(
        join, "sequence_id long, ids binary"
    )
