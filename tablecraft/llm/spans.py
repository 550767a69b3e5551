"""Substring dedup by sliding spans of consecutive sentences.

A text is cut into sentences, and sentences of more than ``REACH`` words into parts at
places set by their words: of every ``REACH`` neighbouring places the one where the hash
of the two words around it is least.  So no part is longer, and a passage is cut alike
wherever it stands, but for at most ``REACH`` words at either end.  What is left of 51
words is at least three parts; at its end fewer than ``WORDS`` more may stay, which make
no span of their own.  From each part starts one span: the fewest consecutive parts
that are at least ``PARTS`` and hold at least ``WORDS`` words.  A span is known by a
64-bit hash of its words, A-Z lowered.  The first document of a span is the one with
the least id, and in it the first place; at all other places the parts that the span
covers are removed.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.llm.text import LOWER, as_bytes, fields_of, map_rows
from tablecraft.plans.skew import join_keys
from tablecraft.plans.storage import written

PARTS = 3
WORDS = 12
REACH = 10

_GAP = re.compile(rb"(?<=[.!?])\s+|\s*\n\s*|(?<=\xe3\x80\x82)\s*")
_WORD = re.compile(rb"\S+")
_BASE = 0x9E3779B97F4A7C15


def cut(text: bytes) -> tuple[list[int], list[list[bytes]]]:
    """Where each part starts, and its words; what lies between parts belongs to the one before."""
    sentences, at = [], 0
    for end, after in [*(m.span() for m in _GAP.finditer(text)), (len(text), len(text))]:
        words = text[at:end].translate(LOWER).split()
        if words:
            sentences.append((at, end, words))
        at = after
    inner = _inner_cuts([words for _, _, words in sentences])
    starts, parts = [], []
    for (at, end, words), own in zip(sentences, inner):
        if len(own):
            edges = [0, *own, len(words)]
            places = [m.start() for m in _WORD.finditer(text[at:end])]
            starts += [at, *(at + places[i] for i in own)]
            parts += [words[i:j] for i, j in zip(edges, edges[1:])]
        else:
            starts.append(at)
            parts.append(words)
    return starts, parts


def _inner_cuts(sentences: list[list[bytes]]) -> list[list[int]]:
    """Words before which each sentence is cut: the least pair hash of every REACH neighbouring places."""
    out: list[list[int]] = [[] for _ in sentences]
    long = [k for k, words in enumerate(sentences) if len(words) > REACH]
    if not long:
        return out
    sizes = np.array([len(sentences[k]) for k in long])
    ends = np.cumsum(sizes)
    digest = xxhash.xxh64_intdigest
    own = np.array([digest(w) for k in long for w in sentences[k]], np.uint64)
    pair = (own[:-1] * np.uint64(_BASE)) ^ (own[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    pair = (pair ^ (pair >> np.uint64(31))) * np.uint64(_BASE)
    sentence = np.repeat(np.arange(len(long)), sizes)
    # pair[i] is the place before word i + 1; windows that leave their sentence do not count.
    windows = np.lib.stride_tricks.sliding_window_view(pair, REACH)[:, ::-1]
    at = np.arange(len(windows))
    at = at[sentence[at] == sentence[at + REACH]]
    for word in np.unique(at + REACH - windows[at].argmin(axis=1)).tolist():
        k = sentence[word]
        out[long[k]].append(int(word - ends[k] + sizes[k]))
    return out


def span_hashes(parts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and number of parts of the span that starts at each part; spans beyond the end are left out."""
    n = len(parts)
    digest = xxhash.xxh64_intdigest
    own = np.array([digest(b" ".join(p)) for p in parts], np.uint64)
    total = np.cumsum([len(p) for p in parts])
    before = np.concatenate([[0], total[:-1]])
    last = np.maximum(np.arange(n) + PARTS - 1, np.searchsorted(total, before + WORDS))
    size = (last - np.arange(n) + 1)[last < n]  # spans that fit are the first ones: last never falls
    out, at = size.astype(np.uint64), np.arange(len(size))
    for k in range(int(size.max(initial=0))):
        inside = k < size
        out[inside] = (out[inside] ^ own[at[inside] + k]) * np.uint64(_BASE)
        out[inside] ^= out[inside] >> np.uint64(29)
    return out.view(np.int64), size


def document_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, text_key, pos, n, span, again)``; again: the document has the span at an earlier place."""

    def worker(batches):
        for b in batches:
            rows, out = [], {n: [] for n in ("pos", "n", "span", "again")}
            for i, text in enumerate(b["_text"]):
                hashes, size = span_hashes(cut(text)[1])
                if not len(hashes):
                    continue
                again = np.ones(len(hashes), bool)
                again[np.unique(hashes, return_index=True)[1]] = False
                rows.append(np.full(len(hashes), i))
                for name, values in zip(out, (np.arange(len(hashes), dtype=np.int32), size.astype(np.int32), hashes, again)):
                    out[name].append(values)
            if rows:
                at = pa.array(np.concatenate(rows))
                yield {id_col: pa.array(b[id_col], kind).take(at), "text_key": pa.array(b["text_key"], pa.int64()).take(at)} | {
                    n: pa.array(np.concatenate(v)) for n, v in out.items()
                }

    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(docs.schema[id_col].dataType)
    fields = [
        *fields_of(docs, id_col), T.StructField("text_key", T.LongType()), T.StructField("pos", T.IntegerType()),
        T.StructField("n", T.IntegerType()), T.StructField("span", T.LongType()), T.StructField("again", T.BooleanType()),
    ]
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col), F.xxhash64(text).alias("text_key"), as_bytes(text_col).alias("_text"))
    return map_rows(rows, fields, worker)


def repeated_places(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text_key, places)``: the non-first spans of each document that has some, as (pos, n)."""
    spans = written(document_spans(docs, id_col, text_col), "spans")
    once = spans.filter("NOT again").drop("again")
    shared = once.groupBy("span").agg(F.count("*").alias("_docs"), F.min(id_col).alias("_first")).filter("_docs > 1")
    later = once.join(shared.drop("_docs"), "span").filter(~F.col(id_col).eqNullSafe(F.col("_first")))
    cover = [id_col, "text_key", "pos", "n"]
    # At most one entry per part of the document itself.
    return later.select(*cover).unionByName(spans.filter("again").select(*cover)).groupBy(id_col, "text_key").agg(
        F.collect_list(F.struct("pos", "n")).alias("places")
    )


def without(text: bytes, places: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The text without the parts at ``places``, and the number of parts removed."""
    starts, parts = cut(text)
    covered = np.zeros(len(starts), bool)
    for pos, n in places:
        covered[pos : pos + n] = True
    ends = [*starts[1:], len(text)]
    kept = b"".join(text[a:b] for a, b, c in zip([0, *starts[1:]], ends, covered) if not c)
    return kept.rstrip() if covered.any() else text, int(covered.sum())


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text, n_removed)``, one row per document row.

    Documents without a repeated span keep their text as it is, null included.  Rows
    of one id count as one document: none of them is later than another.  A null id
    is later than all others.  A document whose parts all go has an empty text.
    """
    places = repeated_places(docs, id_col, text_col)
    keyed = docs.select(
        F.col(id_col), F.col(text_col).alias("text"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key")
    )
    joined = join_keys(keyed, places, [id_col, "text_key"], "left")

    def worker(batches):
        for b in batches:
            texts, removed = b["text"], [0] * len(b["text"])
            for i, places in enumerate(b["places"]):
                if places:  # all other texts stay as they are and are not cut again
                    new, removed[i] = without((texts[i] or "").encode(), [(p["pos"], p["n"]) for p in places])
                    texts[i] = new.decode()
            yield {id_col: b[id_col], "text": texts, "n_removed": removed}

    fields = [
        *fields_of(docs, id_col), T.StructField("text", T.StringType()), T.StructField("n_removed", T.IntegerType()),
    ]
    return map_rows(joined.select(id_col, "text", "places"), fields, worker)


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """All columns of ``docs`` with repeated spans cut out of the text, and ``size_col`` counted anew where it changed."""
    names = docs.columns
    key = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    places = repeated_places(docs, id_col, text_col).withColumnsRenamed(
        {id_col: "_place_id", "text_key": "_place_key", "places": "_places"}
    )
    joined = docs.join(places, docs[id_col].eqNullSafe(F.col("_place_id")) & (key == F.col("_place_key")), "left")
    sizes = size_col if size_col in names else None

    def run(batches):
        for b in batches:
            columns = dict(zip(b.schema.names, b.columns))
            places = columns.pop("_places")
            texts, counts = columns[text_col].to_pylist(), columns[sizes].to_pylist() if sizes else None
            for i in np.flatnonzero(places.is_valid().to_numpy(zero_copy_only=False)):
                own = [(p["pos"], p["n"]) for p in places[i].as_py()]
                texts[i] = without((texts[i] or "").encode(), own)[0].decode()
                if sizes:
                    counts[i] = len(texts[i])
            columns[text_col] = pa.array(texts, columns[text_col].type)
            if sizes:
                columns[sizes] = pa.array(counts, columns[sizes].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return joined.select(*[docs[c] for c in names], "_places").mapInArrow(run, docs.schema)
