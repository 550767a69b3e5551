"""Delta tables against a dictionary, what they write, compaction and clean-up."""

from __future__ import annotations

import os
import random

import pytest

from tablecraft.operators.deltas import DeltaTable

SCHEMA = "k string, born string, at int, v int"


def table(spark, path, buckets=4):
    return DeltaTable(spark, str(path), spark.createDataFrame([], SCHEMA).schema, ("k",), ("at", "v"), "at", buckets)


def plain(batches):
    """Later rows win unless the stored one is newer; ``born`` is the first row's."""
    held = {}
    low = lambda x: -1 if x is None else x
    for batch in batches:
        best = {}
        for k, born, at, v in batch:
            if k not in best or low(at) > low(best[k][1]):
                best[k] = (born, at, v)
        for k, (born, at, v) in best.items():
            if k not in held:
                held[k] = (born, at, v)
            elif low(at) >= low(held[k][1]):
                held[k] = (held[k][0], at, v)
    return sorted(((k, *r) for k, r in held.items()), key=str)


def rows(t):
    return sorted((tuple(r) for r in t.read().collect()), key=str)


def files(path):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def batches(n=5, seed=1):
    rng = random.Random(seed)
    times = iter(rng.sample(range(1000), 1000))
    out = [[(rng.choice([*"abcdefgh", None]), f"b{i}-{j}", next(times), j) for j in range(6)] for i in range(n)]
    out[2].append(("a", "none", None, 9))
    return out


def test_like_a_dictionary_at_every_step(spark, tmp_path):
    t, seen = table(spark, tmp_path / "t"), []
    assert rows(t) == []
    for i, batch in enumerate(batches()):
        t.upsert(spark.createDataFrame(batch, SCHEMA))
        seen.append(batch)
        assert rows(t) == plain(seen)
        if i in (1, 3):
            done = t.compact()
            assert done and rows(t) == plain(seen) and t.due() == []
        if i == 3:
            assert t.vacuum() and rows(t) == plain(seen)


def test_one_row_writes_one_row(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.upsert(spark.createDataFrame([(f"k{i}", "x" * 500, 1, i) for i in range(5000)], SCHEMA))
    t.compact()
    before = files(tmp_path / "t")
    t.upsert(spark.createDataFrame([("k7", "y", 2, -1)], SCHEMA))
    after = files(tmp_path / "t")
    new = {f: n for f, n in after.items() if f not in before}
    assert {f: after[f] for f in before} == before
    assert sum(new.values()) < 10_000 and sum(f"{os.sep}delta{os.sep}" in f for f in new) == 1
    assert t.due() == []  # one row of a full bucket is not worth a rewrite
    got = {r.k: (r.born, r.v) for r in t.read().collect()}
    assert len(got) == 5000 and got["k7"] == ("x" * 500, -1) and got["k8"][1] == 8


def test_compaction_leaves_other_buckets_alone(spark, tmp_path):
    t = table(spark, tmp_path / "t", 16)
    t.upsert(spark.createDataFrame([(f"k{i}", "x", 1, i) for i in range(200)], SCHEMA))
    t.compact()
    t.upsert(spark.createDataFrame([("k7", "y", 2, -1)], SCHEMA))
    base = {f for f in files(tmp_path / "t") if "base" in f}
    assert len(t.compact(share=0)) == 1
    assert len({f for f in files(tmp_path / "t") if "base" in f} - base) == 1


def test_repeated_and_empty_batches(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    batch = spark.createDataFrame([("a", "x", 1, 1)], SCHEMA)
    t.upsert(batch, "feed-1")
    t.upsert(spark.createDataFrame([("a", "x", 1, 2)], SCHEMA), "feed-1")
    t.upsert(spark.createDataFrame([], SCHEMA), "feed-2")
    assert rows(t) == [("a", "x", 1, 1)] and {r.name for r in t._log()} == {"feed-1", "feed-2"}
    t.compact(share=0)
    t.upsert(spark.createDataFrame([("a", "x", 3, 3)], SCHEMA), "feed-3")
    t.compact(share=0)
    t.vacuum(keep=0)
    t.upsert(batch, "feed-3")
    assert rows(t) == [("a", "x", 3, 3)]


def test_a_reader_from_before_a_compaction_still_reads(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    for i in range(3):
        t.upsert(spark.createDataFrame([("a", "x", i, i), (f"b{i}", "x", i, i)], SCHEMA))
        t.compact(share=0)
    t.upsert(spark.createDataFrame([("a", "x", 9, 9)], SCHEMA))
    old, want = t.read(), rows(t)
    t.compact(share=0)
    assert any(name.startswith("delta/") for name in t.vacuum())
    assert sorted((tuple(r) for r in old.collect()), key=str) == want == rows(t)


def test_newest_must_be_updated(spark, tmp_path):
    with pytest.raises(ValueError):
        DeltaTable(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema, ("k",), ("v",), "at")
