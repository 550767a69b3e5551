import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tablecraft.llm import simhash
from common import empty_documents, odd_documents


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    ids = sorted(set(fps))
    root = {f: f for f in ids}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    return {f: find(f) for f in ids}


def expected(rows):
    fps = [(d, plain_fingerprint(t)) for d, t in rows]
    groups = plain_components([f for _, f in fps])
    least = {}
    for d, f in fps:
        if d is not None:
            least[groups[f]] = min(d, least.get(groups[f], d))
    return sorted(((d, f"{f:016x}", least.get(groups[f])) for d, f in fps), key=str)


def test_matches_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == expected(rows)


def test_odd_and_empty_tables(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str) == expected(rows)
    assert simhash.near_duplicates(empty_documents(spark)).count() == 0
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {1, 3, 6, 9} and 2 not in {r.doc_id for r in kept.collect()}


@pytest.mark.parametrize("bucket", [1, 4, 256])
def test_crowded_index_values_lose_no_link(spark, bucket):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = set(base)
    for b in base:
        for _ in range(25):
            f = rng.choice([x for x in fps if (x ^ b).bit_count() < 12])
            for bit in rng.sample(range(64), rng.randrange(1, 5)):
                f ^= 1 << bit
            fps.add(f)
    signed = np.array(sorted(fps), np.uint64).astype(np.int64).tolist()
    table = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = simhash.components(simhash.fingerprint_links(table, bucket)).collect()
    want = {}
    for f, r in plain_components(fps).items():
        want.setdefault(r, set()).add(f)
    groups = {}
    for r in got:
        groups.setdefault(r.root, set()).add(r.node % 2**64)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_long_chains_of_links(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    rows = simhash.components(links).collect()
    assert len(rows) == 301 and {r.root for r in rows} == {0}
