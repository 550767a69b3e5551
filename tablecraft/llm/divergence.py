"""Which terms and which other sources set a source of a language apart.

Terms are counted by sorted pointers: in each slice of an Arrow buffer the starts of
all words are pointers, ordered by (language, source) and multikey-quicksorted inside
it.  A run of equal strings is one term of one source; its length is the number of
occurrences, its distinct rows are the documents.  Spark adds the runs of all shards up.

A language keeps the terms of at least ``min_docs`` of its documents.  With ``V`` kept
terms and ``N`` of their occurrences, a term that occurs ``n`` times has the share
``1 + floor(10^9 * (n + 5) / (N + 5 V))``; sums and comparisons are of whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablecraft.llm.multikey import padded, sorted_runs
from tablecraft.llm.text import LOWER, as_bytes
from tablecraft.plans.skew import join_keys
from tablecraft.plans.storage import written

MIN_DOCS, TOP = 30, 50
#: Share of the whole and smoothing, fixed values of the contract.
WHOLE, ADD = 1_000_000_000, 5
#: Bytes of text that a task sorts at once; a longer text is a slice of its own.
SLICE_BYTES = 8_000_000
#: Sums of all pairs of a language are held in a task up to so many sources, else sent by rows of terms.
HELD_SOURCES = 1_000
#: Numbers in a block of shares that a task compares at once.
BLOCK = 2_000_000

_LOWER = np.frombuffer(LOWER, np.uint8)
_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    a = 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + SLICE_BYTES, side="right")) - 1)
        yield a, b
        a = b


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    before = np.cumsum(length) - length
    return np.repeat(start - before, length) + np.arange(int(length.sum()))


def term_runs(flat: bytes, ends: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Group, term, occurrences and documents of each run; texts end at ``ends`` and belong to ``group``."""
    buffer = _LOWER[padded(flat)]
    size = len(flat)
    letter = _LETTER[buffer[:size]]
    edge = np.zeros(size + 1, bool)
    edge[ends] = True
    start = np.flatnonzero(letter & (edge[:size] | np.append(True, ~letter[:-1])[:size]))
    stop = np.flatnonzero(letter & (edge[1:] | np.append(~letter[1:], True)[:size])) + 1
    length, row = stop - start, np.searchsorted(ends, start, side="right")
    by_group = np.argsort(group[row].astype(np.uint16 if len(ends) < 1 << 16 else np.int64), kind="stable")
    start, length, row = start[by_group], length[by_group], row[by_group]
    order, new = sorted_runs(buffer, start, length, group[row])
    run = np.cumsum(new) - 1
    first = order[new]
    n = np.bincount(run, minlength=len(first))
    # A text is whole in its slice: distinct rows of a run are its documents.
    own = np.sort((run << 32) + row[order])
    docs = np.bincount(own[np.append(True, own[1:] != own[:-1])[: len(own)]] >> 32, minlength=len(first))
    bytes_of = length[first]
    terms = pa.Array.from_buffers(
        pa.string(), len(first),
        [None, pa.py_buffer(np.append(0, np.cumsum(bytes_of)).astype(np.int32)), pa.py_buffer(buffer[_ranges(start[first], bytes_of)])],
    )
    return group[row[first]], terms, n, docs


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)`` over all rows of ``docs(lang, source, _text)``, none of them null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = pa.StructArray.from_arrays([batch.column(0), batch.column(1)], ["lang", "source"])
            text = batch.column(2)
            _, places, data = text.buffers()
            offsets = np.frombuffer(places, np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
            data = memoryview(data) if data else b""
            for a, b in _slices(offsets):
                own = [(x["lang"], x["source"]) for x in kinds.slice(a, b - a).to_pylist()]
                names = {k: i for i, k in enumerate(dict.fromkeys(own))}
                group = np.array([names[k] for k in own])
                code, terms, n, seen = term_runs(bytes(data[offsets[a] : offsets[b]]), offsets[a + 1 : b + 1] - offsets[a], group)
                if len(n):
                    lang, source = (pa.array([k[i] for k in names], pa.string()).take(pa.array(code)) for i in (0, 1))
                    yield pa.RecordBatch.from_arrays(
                        [lang, source, terms, pa.array(n, pa.int64()), pa.array(seen, pa.int64())],
                        names=["lang", "source", "term", "n", "docs"],
                    )

    runs = docs.select("lang", "source", "_text").mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return runs.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: str, total: str, kinds: str) -> Column:
    """Exact for every count: the product has 31 digits at most."""
    return F.expr(f"1 + (cast({n} + {ADD} as decimal(20,0)) * {WHOLE}BD) div cast({total} + {ADD} * {kinds} as decimal(21,0))")


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(lang, term, lang_n, per)`` of the terms in at least ``min_docs`` documents; per: (source, n), one per source."""
    return counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.collect_list(F.struct("source", "n")).alias("per")
    ).filter(F.col("docs") >= min_docs).drop("docs")


def pair_sums(shares: DataFrame) -> DataFrame:
    """``(lang, a, b, value)``, a < b: summed differences between sources.

    ``shares(lang, per, zeros)`` has a row per term: per, its (idx, p) of the sources that
    hold it; zeros, the share of no occurrence by idx of all sources of the language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(lang, a, b, value):
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(a), pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(value, pa.int64())],
                names=["lang", "a", "b", "value"],
            )

        held: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            per, zeros = batch.column(1), batch.column(2)
            for lang in dict.fromkeys(langs.tolist()):
                rows = np.flatnonzero(langs == lang)
                base = np.array(zeros[int(rows[0])].as_py(), np.int64)
                size = len(base)
                for at in range(0, len(rows), max(1, BLOCK // size)):
                    own = rows[at : at + max(1, BLOCK // size)]
                    lists = per.take(pa.array(own))
                    flat = lists.flatten()
                    table = np.tile(base, (len(own), 1))
                    row = np.repeat(np.arange(len(own)), np.diff(lists.offsets.to_numpy()))
                    table[row, flat.field(0).to_numpy()] = flat.field(1).to_numpy()
                    if size <= HELD_SOURCES and lang not in held:
                        held[lang] = np.zeros((size, size), np.int64)
                    for a in range(size - 1):
                        sums = np.abs(table[:, a + 1 :] - table[:, a : a + 1]).sum(axis=0)
                        if size <= HELD_SOURCES:
                            held[lang][a, a + 1 :] += sums
                        else:
                            yield out(lang, np.full(len(sums), a), np.arange(a + 1, size), sums)
            if sum(x.size for x in held.values()) > 4 * HELD_SOURCES**2:
                for lang, sums in held.items():
                    a, b = np.triu_indices(len(sums), 1)
                    yield out(lang, a, b, sums[a, b])
                held = {}
        for lang, sums in held.items():
            a, b = np.triu_indices(len(sums), 1)
            yield out(lang, a, b, sums[a, b])

    return shares.select("lang", "per", "zeros").mapInArrow(run, "lang string, a int, b int, value long").groupBy(
        "lang", "a", "b"
    ).agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``.

    Part ``pair``: each other source of the language and the summed difference of the
    shares of all kept terms.  Part ``term``: the ``top`` terms of the source whose share
    exceeds that of the language, and by how much.  Null texts, languages and sources are
    empty; every row is a document, so repeated rows count again; a source without a kept
    term has pairs only, a source that is alone in its language has none.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(empty(lang_col).alias("lang"), empty(source_col).alias("source"), as_bytes(text_col).alias("_text"))
    counts = written(term_counts(rows), "term-counts")
    kept = written(kept_terms(counts, min_docs), "kept-terms")
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("kinds"), F.sum("lang_n").alias("lang_total"))
    single = kept.select("lang", "term", "lang_n", F.inline("per"))
    totals = single.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    # One row per source of a language.
    every = join_keys(join_keys(rows.select("lang", "source").distinct(), totals, ["lang", "source"]), of_lang, ["lang"])
    groups = written(
        every.select("lang", "source", zero("total"), zero("kinds"), zero("lang_total"))
        .withColumn("idx", F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1),
        "sources",
    )
    shares = written(
        join_keys(single, groups, ["lang", "source"], "inner")
        .select("lang", "source", "term", "idx", share("n", "total", "kinds").alias("p"), share("lang_n", "lang_total", "kinds").alias("q")),
        "shares",
    )
    zeros = groups.filter("kinds > 0").groupBy("lang").agg(
        F.array_sort(F.collect_list(F.struct("idx", share("0", "total", "kinds").alias("p")))).alias("_zeros")
    ).select("lang", F.col("_zeros.p").alias("zeros"))
    per = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("idx", "p")).alias("per"))
    sums = pair_sums(join_keys(per, zeros, ["lang"], "inner"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("idx").alias("_b"))
    pairs = (
        groups.select("lang", "source", F.col("idx").alias("_a")).join(other, "lang").filter("_a <> _b")
        .select("lang", "source", "item", F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
    )
    pairs = join_keys(pairs, sums, ["lang", "a", "b"]).select("lang", "source", F.lit("pair").alias("part"), "item", zero("value"))
    terms = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")).alias("rank")
    best = terms.select("*", rank).filter(F.col("rank") <= top)
    return pairs.select("*", rank).unionByName(best)
