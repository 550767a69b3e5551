"""Near-duplicates by SimHash fingerprints, found by multi-index hashing.

Fingerprints of at most ``DISTANCE`` differing bits are linked.  Of two halves of
32 bits one differs in at most one bit, so each half is an index: a fingerprint
looks up its half and every value that clears one bit of it.  (If two halves differ
in one bit, exactly one of them has it set, so each pair is found from one side.)
What is fetched is verified on all 64 bits.

An index value that more than ``BUCKET`` fingerprints share is not searched that
way, since its pairs would grow with the square.  Its members are dealt with in full
by narrower buckets: 64 bits in 16 blocks of 4, and 3 differing bits lie in at most 3
blocks, so two linked fingerprints agree on 13 blocks.  Each member goes to the 560
choices of 3 blocks to leave out; a bucket then has at most 4096 distinct members,
and its components are found inside one task.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.llm.graph import components
from tablecraft.llm.text import as_bytes, fields_of, map_rows, words_of
from tablecraft.plans.skew import join_keys
from tablecraft.plans.storage import written

DISTANCE = 3
BUCKET = 256
SEED = 42
_HALF = 0xFFFFFFFF


def fingerprint(text: bytes, size: int = 3) -> int:
    """64-bit SimHash over word shingles, repeats included; no word gives zero."""
    words = words_of(text)
    if not words:
        return 0
    if len(words) < size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    set_bits = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        block = hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``(id, fp)``, fp as a signed long.  A null text counts as empty."""

    def worker(batches):
        for b in batches:
            fps = np.array([fingerprint(t, size) for t in b["_text"]], np.uint64).astype(np.int64)
            yield {id_col: b[id_col], "fp": fps.tolist()}

    rows = docs.select(id_col, as_bytes(text_col).alias("_text"))
    return map_rows(rows, [*fields_of(docs, id_col), T.StructField("fp", T.LongType())], worker)


def _half(i: int):
    return F.shiftrightunsigned(F.col("fp"), 32 * i).bitwiseAND(F.lit(_HALF))


def _ball():
    """The half itself and the half with each of its set bits cleared."""
    bits = F.sequence(F.lit(0), F.lit(31))
    cleared = F.transform(
        F.filter(bits, lambda i: F.call_function("getbit", F.col("half"), i) == 1),
        lambda i: F.col("half") - F.call_function("shiftleft", F.lit(1).cast("long"), i),
    )
    return F.concat(F.array("half"), cleared)


def _narrow_links(members: DataFrame) -> DataFrame:
    """Links that join all members that are linked: spanning stars inside buckets of 13 fixed blocks."""
    masks = [sum(0xF << (4 * i) for i in left) for left in combinations(range(16), DISTANCE)]
    signed = np.array(masks, np.uint64).astype(np.int64).tolist()
    keyed = members.select("fp", F.posexplode(F.array(*[F.lit(m) for m in signed])).alias("_choice", "_mask")).select(
        "_choice", F.col("fp").bitwiseAND(F.bitwise_not("_mask")).alias("_key"), "fp"
    )

    def stars(table):
        import pyarrow as pa

        fps = np.unique(table.column("fp").to_numpy())
        a, b, todo = [], [], fps
        while len(todo):
            front, todo = todo[:1], todo[1:]
            centre = front[0]
            while len(front) and len(todo):
                near = np.zeros(len(todo), bool)
                for f in front:
                    near |= np.bitwise_count((todo ^ f).view(np.uint64)) <= DISTANCE
                front, todo = todo[near], todo[~near]
                a += [centre] * len(front)
                b += front.tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return keyed.groupBy("_choice", "_key").applyInArrow(stars, "a long, b long")


def fingerprint_links(distinct: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links ``(a, b)`` among distinct fingerprints whose components are those of all pairs within the distance."""
    table = distinct.select("fp", F.posexplode(F.array(_half(0), _half(1))).alias("side", "half"))
    crowded = written(
        table.groupBy("side", "half").agg(F.count("*").alias("_n")).filter(F.col("_n") > bucket).drop("_n"), "crowded"
    )
    probes = table.select("fp", "side", F.explode(_ball()).alias("half"))
    held = table.select("side", "half", F.col("fp").alias("other")).join(crowded, ["side", "half"], "left_anti")
    pairs = (
        probes.join(held, ["side", "half"])
        .filter((F.col("fp") != F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= DISTANCE))
        .select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b"))
    )
    if crowded.isEmpty():
        return pairs
    # Every fingerprint that looks up a crowded value may be linked to its members.
    members = probes.join(crowded, ["side", "half"], "left_semi").select("fp").distinct()
    return pairs.unionByName(_narrow_links(members))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, bucket: int = BUCKET
) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id (least id reachable).

    Copies meet in their fingerprint before any link is looked for, so a group of
    copies of any size is one node.  Empty and null texts share fingerprint zero.
    Repeated rows stay repeated; a null id is never the least unless it is alone.
    """
    fps = written(fingerprints(docs, id_col, text_col, size), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min(id_col).alias("_least")), "nodes")
    roots = components(fingerprint_links(nodes.select("fp"), bucket))
    placed = nodes.join(roots.withColumnsRenamed({"node": "fp", "root": "_root"}), "fp", "left").select(
        "fp", "_least", F.coalesce("_root", "fp").alias("_root")
    )
    least = placed.groupBy("_root").agg(F.min("_least").alias("component_id"))
    of_fp = placed.join(least, "_root").select("fp", "component_id")
    return join_keys(fps, of_fp, ["fp"], "inner").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose id is the least of their group, all columns; rows that repeat a kept id stay."""
    groups = near_duplicates(docs.select(id_col, text_col), id_col, text_col)
    gone = groups.filter(~F.col(id_col).eqNullSafe(F.col("component_id"))).select(id_col).distinct()
    return join_keys(docs, gone, [id_col], "left_anti")
