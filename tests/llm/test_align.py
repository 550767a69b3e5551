import random

import numpy as np

from tablecraft.llm import align
from common import empty_documents, odd_documents, prose


def plain_align(a, b):
    best = 0
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            same = align.MATCH if a[i] == b[j] else align.MISMATCH
            table[i + 1][j + 1] = max(0, table[i][j] + same, table[i][j + 1] + align.GAP, table[i + 1][j] + align.GAP)
            best = max(best, table[i + 1][j + 1])
    return best / (align.MATCH * len(a)) if a and b else 0.0


def test_alignment_score():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = (rng.integers(0, 6, rng.integers(0, 14)).astype(np.uint64) for _ in range(2))
        score, start, end, agree = align.align(a, b)
        assert score == plain_align(list(a), list(b))
        assert 0 <= start <= end <= len(b) and agree <= min(len(a), end - start)


def edited(text, rng, share):
    out = []
    for w in text.split():
        roll = rng.random()
        if roll < share / 3:
            continue
        out += [w + "x"] if roll < 2 * share / 3 else [w, "inserted"] if roll < share else [w]
    return " ".join(out)


def fixture(spark):
    rng = random.Random(8)
    items = [(i, prose(1000 + i, 1 + i % 3, 12)) for i in range(12)] + [(90, None), (91, ""), (92, "two words"), (None, prose(55))]
    rows, planted = [], set()
    for d in range(80):
        text = prose(d, 30)
        if d % 4 == 0:
            i = d % 12
            middle = text.split(". ")
            middle.insert(10, edited(items[i][1], rng, 0.25 if d % 8 else 0))
            text = ". ".join(middle)
            planted.add((d, i))
        rows.append((d, text))
    rows += [(200, "two words"), (201, "Two, words!")]
    schema = "doc_id long, text string"
    return spark.createDataFrame(rows, schema), spark.createDataFrame(items, "item_id long, text string"), planted, rows, items


def test_finds_what_all_pairs_find(spark):
    docs, items, planted, rows, tests = fixture(spark)
    got = {(r.doc_id, r.item_id): r for r in align.contaminated(docs, items).collect()}
    hashes = align.WordHashes()
    words = lambda t: list(hashes((t or "").encode().split()))
    want = {(d, i): s for d, t in rows for i, x in tests if (s := plain_align(words(x), words(t))) >= align.CUT}
    assert len(planted & set(want)) >= 15
    # Short heavily edited items may keep no seed; everything else has to be found.
    sizes = {i: len((x or "").split()) for i, x in tests}
    missed = set(want) - set(got)
    assert set(got) <= set(want) and len(missed) <= 1 and all(sizes[i] <= 12 and want[d, i] < 0.7 for d, i in missed)
    assert all(abs(r.score - want[k]) < 1e-9 for k, r in got.items())
    clean = align.drop_contaminated(docs, items)
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in rows} - {d for d, _ in got}


def test_frequent_passages_and_coarse_bitmaps_lose_nothing(spark):
    docs, items, _, rows, _ = fixture(spark)
    everywhere = spark.createDataFrame([(1000 + i, f"{prose(i + 300, 2)} {prose(1003, 1, 12)} tail {i}") for i in range(150)], docs.schema)
    both = docs.unionByName(everywhere)
    got = {(r.doc_id, r.item_id) for r in align.contaminated(both, items, bits=6).collect()}
    assert {(1000 + i, 3) for i in range(150)} <= got
    assert got == {(r.doc_id, r.item_id) for r in align.contaminated(both, items).collect()}


def test_items_of_one_or_two_words_inside_longer_documents(spark):
    items = spark.createDataFrame([(1, "Xylograph"), (2, "zebra crossing"), (3, prose(3, 2))], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, f"{prose(70, 4)} xylograph, {prose(71, 4)}"), (2, f"{prose(72, 3)} Zebra crossing! {prose(73)}"), (3, prose(74, 9))],
        "doc_id long, text string",
    )
    got = {(r.doc_id, r.item_id): r.score for r in align.contaminated(docs, items).collect()}
    assert got == {(1, 1): 1.0, (2, 2): 1.0}


def test_copies_that_keep_a_single_frequent_seed(spark):
    """Two words agree and one differs, but for one place of three words, which many documents hold."""
    words = [f"w{i}" for i in range(30)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    rows = []
    for at in range(0, 27, 3):
        copy = [w if at <= i < at + 3 or (i % 3 != 2 and i != at + 3) else "other" for i, w in enumerate(words)]
        rows.append((at, f"{prose(at)} {' '.join(copy)} {prose(at + 40)}"))
    rows += [(100 + i, f"{prose(i + 200)} {' '.join(words[i % 27 : i % 27 + 3])}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in align.contaminated(docs, items).collect()} == set(range(0, 27, 3))
    long_item = {r.doc_id for r in align.contaminated(docs, items, keep_all=5).collect()}
    assert long_item < set(range(0, 27, 3))


def test_odd_tables(spark):
    _, items, *_ = fixture(spark)
    docs = odd_documents(spark)
    assert {(r.doc_id, r.item_id) for r in align.contaminated(docs, items).collect()} == set()
    kept = align.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    own = docs.selectExpr("doc_id AS item_id", "text", "lang", "words" if "words" in docs.columns else "score")
    found = {(r.doc_id, r.item_id) for r in align.contaminated(docs, own).collect()}
    assert {(1, 1), (1, 2), (2, 1), (6, 6), (7, 7), (None, None), (9, 9)} <= found
    assert align.contaminated(empty_documents(spark), items).count() == 0
    assert align.contaminated(docs, items.filter("false")).count() == 0
