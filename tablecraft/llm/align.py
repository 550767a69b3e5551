"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Seeds are word n-grams of the test items: of three words, or the whole of a shorter
item.  First the corpus is counted: in how many documents each seed occurs.  An item
of at most ``KEEP_ALL`` seeds keeps all of them.  A longer one keeps those in at most
one of ``RARE`` documents and, of every ``STRETCH`` consecutive seeds, the rarest: so it
keeps seeds over its whole length however frequent its passages are.  Documents that hold
a kept seed give the passages around it, passages meet items by their seeds in a
join, and each pair is aligned word by word, unless so few of the item's words stand in
the passage that no alignment can reach the cut.  Items stand in a table of any size; what
tasks hold of them is a bitmap of seed hashes of a fixed number of bits, which only
lets too many n-grams through, and the join is exact.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.llm.text import LOWER, as_bytes, fields_of, map_rows
from tablecraft.plans.skew import join_keys
from tablecraft.plans.storage import written

NGRAM = 3
STRETCH = 3
KEEP_ALL = 256
RARE = 1000
#: Bits of the seed bitmap, as a power of two.
BITS = 24
#: Alignment: a word that agrees, one that differs, one that is missing on either side.
MATCH, MISMATCH, GAP = 2, -1, -1
#: Share of the best possible score of an item from which a passage counts as a copy of it.
CUT = 0.5

_STRIP = b".,;:!?\"'()[]"
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


class WordHashes:
    """64-bit hashes of words without case and outer punctuation, through a bounded cache."""

    def __init__(self, most: int = 400_000):
        self.most, self.known = most, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        try:
            return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            pass
        if len(self.known) > self.most:
            self.known = {}
        for w in set(words).difference(self.known):
            self.known[w] = xxhash.xxh64_intdigest(w.translate(LOWER).strip(_STRIP))
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))


def gram_hashes(words: np.ndarray, n: int = NGRAM) -> np.ndarray:
    """One hash per window of n words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    size = len(words) - n + 1
    out = np.zeros(size, np.uint64)
    for i in range(n):
        out = (out ^ words[i : i + size]) * _MULTIPLIERS[i % 3]
        out ^= out >> np.uint64(31)
    return out


def _seed_worker(item_col: str):
    def worker(batches):
        hashes = WordHashes()
        for b in batches:
            out = {n: [] for n in (item_col, "seed", "at", "n", "size")}
            for item, text in zip(b[item_col], b["_text"]):
                words = text.split()
                n = min(NGRAM, len(words))
                grams = gram_hashes(hashes(words), n) if words else ()
                for at, g in enumerate(np.asarray(grams, np.uint64).view(np.int64).tolist()):
                    for name, value in zip(out, (item, g, at, n, len(words))):
                        out[name].append(value)
            yield out

    return worker


def _bitmap(seeds: DataFrame, bits: int) -> np.ndarray:
    """The set bits of the seeds: never more than 2^bits, whatever the number of items."""
    mask = (1 << bits) - 1
    rows = seeds.select(F.col("seed").bitwiseAND(F.lit(mask)).alias("bit")).distinct().toArrow()
    held = np.zeros(1 << bits, bool)
    held[rows.column("bit").to_numpy()] = True
    return np.packbits(held, bitorder="little")


def _hits(packed: np.ndarray, grams: np.ndarray, bits: int) -> np.ndarray:
    low = (grams & np.uint64((1 << bits) - 1)).astype(np.int64)
    return np.flatnonzero(packed[low >> 3] >> (low & 7).astype(np.uint8) & 1)


def _lengths(seeds: DataFrame) -> list[int]:
    """The seed lengths that occur: at most ``NGRAM`` numbers."""
    return sorted(r[0] for r in seeds.select("n").distinct().collect())


def rare_seeds(
    docs: DataFrame, items: DataFrame, item_col: str, text_col: str, bits: int = BITS, keep_all: int = KEEP_ALL
) -> DataFrame:
    """``(item, seed, n, size)``: all seeds of items of at most ``keep_all``, the rare and spread ones of longer items."""
    fields = [
        *fields_of(items, item_col), T.StructField("seed", T.LongType()), T.StructField("at", T.IntegerType()),
        T.StructField("n", T.IntegerType()), T.StructField("size", T.IntegerType()),
    ]
    rows = items.select(item_col, as_bytes(text_col).alias("_text"))
    seeds = written(map_rows(rows, fields, _seed_worker(item_col)), "seeds")
    short = F.col("size") < keep_all + NGRAM
    long_ones = seeds.filter(~short)
    kept = seeds.filter(short)
    columns = [item_col, "seed", "n", "size"]
    # Only seeds that may be left out have to be counted.
    if long_ones.isEmpty():
        return kept.select(*columns).distinct()
    packed = _bitmap(long_ones, bits)

    def count(batches):
        hashes, tally = WordHashes(), Counter()
        for b in batches:
            for text in b["_text"]:
                grams = gram_hashes(hashes(text.split()))
                tally.update(np.unique(grams[_hits(packed, grams, bits)]).tolist())
            if len(tally) > 200_000:
                yield {"seed": np.array(list(tally), np.uint64).view(np.int64).tolist(), "docs": list(tally.values())}
                tally = Counter()
        yield {"seed": np.array(list(tally), np.uint64).view(np.int64).tolist(), "docs": list(tally.values())}

    counts = map_rows(
        docs.select(as_bytes("text").alias("_text")),
        [T.StructField("seed", T.LongType()), T.StructField("docs", T.LongType())], count,
    ).groupBy("seed").agg(F.sum("docs").alias("docs"))
    known = long_ones.join(counts, "seed", "left").withColumn("docs", F.coalesce("docs", F.lit(0)))
    rare = F.col("docs") * RARE <= docs.count()
    stretch = W.partitionBy(item_col, F.floor(F.col("at") / STRETCH)).orderBy("docs", "at")
    spread = known.withColumn("_k", F.row_number().over(stretch)).filter((F.col("_k") == 1) | rare)
    return written(kept.select(*columns).unionByName(spread.select(*columns)).distinct(), "rare-seeds")



def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int, int]:
    """Best local alignment: score as a share of the best possible, passage from, to, words that agree."""
    m, n = len(item), len(passage)
    if not m or not n:
        return 0.0, 0, 0, 0
    table = np.zeros((m + 1, n + 1), np.int32)
    step = -GAP * np.arange(n + 1, dtype=np.int32)
    for i in range(1, m + 1):
        row = np.zeros(n + 1, np.int32)
        row[1:] = np.maximum(table[i - 1, :-1] + np.where(passage == item[i - 1], MATCH, MISMATCH), table[i - 1, 1:] + GAP)
        np.maximum(row, 0, out=row)
        # A run of gaps costs its length, so the best start of a run is a running maximum.
        table[i] = np.maximum.accumulate(row + step) - step
    i, j = np.unravel_index(int(table.argmax()), table.shape)
    score, end, agree = int(table[i, j]), int(j), 0
    while i and j and table[i, j]:
        same = passage[j - 1] == item[i - 1]
        if table[i, j] == table[i - 1, j - 1] + (MATCH if same else MISMATCH):
            agree += int(same)
            i, j = i - 1, j - 1
        elif table[i, j] == table[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return score / (MATCH * m), int(j), end, agree


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", cut: float = CUT, bits: int = BITS, keep_all: int = KEEP_ALL,
) -> DataFrame:
    """One row per document and test item that it holds a copy of.

    Columns: id, item, score (0 to 1), n_matched (words that agree), first_word and
    end_word (of the best passage, in words of the document).  Null and empty texts
    hold nothing and are held by nothing; rows of one id count as one document.  An item
    of one or two words is a copy wherever its words stand in that order.
    """
    docs = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    items = items.select(F.col(item_col), F.col(item_text).alias("item_text"))
    seeds = rare_seeds(docs, items, item_col, "item_text", bits, keep_all)
    packed = _bitmap(seeds, bits)
    widest = seeds.agg(F.max("size")).first()[0] or 0
    lengths = _lengths(seeds)

    def passages(batches):
        hashes = WordHashes()
        reach = widest + widest // 2
        for b in batches:
            out = {n: [] for n in (id_col, "at", "words", "seeds")}
            for doc, text in zip(b[id_col], b["_text"]):
                words = text.split()
                own = hashes(words)
                found = []
                for n in lengths:
                    grams = gram_hashes(own, n)
                    found += [(int(i), int(g)) for i in _hits(packed, grams, bits) for g in grams[i : i + 1].view(np.int64)]
                found.sort()
                while found:
                    # Seeds whose surroundings touch are one passage.
                    k = 1
                    while k < len(found) and found[k][0] - found[k - 1][0] <= reach:
                        k += 1
                    at, end = max(0, found[0][0] - reach), found[k - 1][0] + reach
                    for name, value in zip(out, (doc, at, b" ".join(words[at:end]).decode(), sorted({g for _, g in found[:k]}))):
                        out[name].append(value)
                    found = found[k:]
            yield out

    fields = [
        *fields_of(docs, id_col), T.StructField("at", T.LongType()), T.StructField("words", T.StringType()),
        T.StructField("seeds", T.ArrayType(T.LongType())),
    ]
    around = written(map_rows(docs.select(id_col, as_bytes("text").alias("_text")), fields, passages), "passages")
    # Seeds that only share a bit with a kept seed find no partner here.
    met = (
        around.select(id_col, "at", F.explode("seeds").alias("seed")).join(seeds.select(item_col, "seed"), "seed")
        .select(id_col, "at", item_col).distinct()
    )
    pairs = join_keys(join_keys(met, around.drop("seeds"), [id_col, "at"], "inner"), items, [item_col], "inner")

    def score(batches):
        hashes = WordHashes()
        for b in batches:
            out = {n: [] for n in (id_col, item_col, "score", "n_matched", "first_word", "end_word")}
            for doc, item, at, words, text in zip(b[id_col], b[item_col], b["at"], b["words"], b["item_text"]):
                own, passage = hashes(text.encode().split()), hashes(words.encode().split())
                # Each word of the item that agrees counts once, so this bounds the score.
                if not len(own) or np.isin(own, passage).mean() < cut:
                    continue
                value, start, end, agree = align(own, passage)
                if value >= cut:
                    for name, v in zip(out, (doc, item, value, agree, at + start, at + end)):
                        out[name].append(v)
            yield out

    whole = T.LongType()
    result = [
        *fields_of(docs, id_col), *fields_of(items, item_col), T.StructField("score", T.DoubleType()),
        T.StructField("n_matched", whole), T.StructField("first_word", whole), T.StructField("end_word", whole),
    ]
    scored = map_rows(pairs.select(id_col, item_col, "at", "words", "item_text"), result, score)
    best = F.max(F.struct("score", "n_matched", (-F.col("first_word")).alias("_from"), (-F.col("end_word")).alias("_to"))).alias("_best")
    return scored.groupBy(id_col, item_col).agg(best).select(
        id_col, item_col, "_best.score", "_best.n_matched", (-F.col("_best._from")).alias("first_word"),
        (-F.col("_best._to")).alias("end_word"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of documents that hold no copy of a test item, all columns."""
    bad = contaminated(docs, items, id_col, text_col).select(id_col).distinct()
    return join_keys(docs, bad, [id_col], "left_anti")
