import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tablecraft.llm import divergence
from common import empty_documents, odd_documents, prose


def plain(rows, min_docs, top):
    """The contract in plain Python over (lang, source, text)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(lower))
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        sources = sorted(s for g, s in groups if g == lang)

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(found) if part == "pair" or k < top]
    return sorted(out)


def check(docs, min_docs, top=5):
    rows = [(r.lang, r.source, r.text) for r in docs.collect()]
    got = sorted(tuple(r) for r in divergence.audit(docs, min_docs, top).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == plain(rows, min_docs, top)
    return got


def test_given_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert {r[2] for r in check(docs, 30)} == {"pair", "term"}
    assert {r[2] for r in check(docs, 10_000)} == {"pair"}


def test_odd_tables(spark):
    docs = odd_documents(spark).withColumns({c: F.lit("x") for c in ("term", "n", "idx", "per", "docs")})
    check(docs, 1)
    check(docs.withColumn("text", F.lit(None).cast("string")), 1)
    assert divergence.audit(empty_documents(spark)).count() == 0


def test_words_at_edges_and_ties(spark):
    texts = ["a", "A", "Ab aB AB ab", "ab", "é", "É é", "x1y_z", "abcdefgh abcdefghi abcdefgh", "b" * 40 + " " + "b" * 41, "", "1 2", "日本 日本語"]
    rows = [(t, lang, source) for t in texts for lang in ("en", None) for source in ("s", "t", "", None)]
    docs = spark.createDataFrame([(t, a, b + str(i % 2) if b else b) for i, (t, a, b) in enumerate(rows)], "text string, lang string, source string")
    check(docs, 2, 50)


def test_small_slices_and_many_sources(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SLICE_BYTES", 300)
    monkeypatch.setattr(divergence, "HELD_SOURCES", 4)
    monkeypatch.setattr(divergence, "BLOCK", 20)
    docs = spark.createDataFrame([(prose(i % 9), "en", f"s{i % 7}") for i in range(40)], "text string, lang string, source string")
    check(docs, 2)


def test_runs_of_one_slice():
    flat = b"b a\nA" + b"a-b" + b"" + b"\xc3\xa9 B"
    group, terms, n, docs = divergence.term_runs(flat, np.array([5, 8, 8, 12]), np.array([0, 1, 1, 0]))
    assert sorted(zip(group.tolist(), terms.to_pylist(), n.tolist(), docs.tolist())) == [
        (0, "a", 2, 1), (0, "b", 2, 2), (0, "é", 1, 1), (1, "a", 1, 1), (1, "b", 1, 1),
    ]
    assert len(divergence.term_runs(b"", np.array([0, 0]), np.array([0, 0]))[2]) == 0
