import random

from tablecraft.llm import spans
from common import empty_documents, odd_documents, prose


def plain(rows):
    """The same by strings: every span as its words, all places in a dictionary."""
    seen = {}
    cuts = []
    for doc, text in rows:
        starts, parts = spans.cut((text or "").encode())
        own = []
        for i in range(len(parts)):
            j = i
            while j < len(parts) and (j - i + 1 < spans.PARTS or sum(map(len, parts[i : j + 1])) < spans.WORDS):
                j += 1
            if j < len(parts):
                own.append((i, j - i + 1, tuple(map(tuple, parts[i : j + 1]))))
        cuts.append((doc, text, own))
        for _, _, span in own:
            seen[span] = min(seen.get(span, float("inf")), float("inf") if doc is None else doc)
    out = []
    for doc, text, own in cuts:
        here, places = set(), []
        for i, n, span in own:
            if span in here or seen[span] != (float("inf") if doc is None else doc):
                places.append((i, n))
            here.add(span)
        new, removed = spans.without((text or "").encode(), places)
        out.append((doc, new.decode() if removed else text, removed))
    return sorted(out, key=str)


def fixture():
    rng = random.Random(6)
    passage = prose(100, 6, 10)
    rows = []
    for i in range(40):
        own = prose(i, 5)
        if i % 4 == 0:
            own = f"{prose(500 + i, 2)}\n{passage}\n{own}"
        if i % 10 == 1:
            own = prose(i - 1, 5)
        if i % 7 == 3:
            own += " " + " ".join(own.split(". ")[0:4]) + ". Of. The. And. " + own
        rows.append((i, own))
    rng.shuffle(rows)
    return passage, rows


def test_matches_strings(spark, folder):
    passage, rows = fixture()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in spans.dedup_substrings(docs).collect()), key=str)
    assert got == plain(rows)
    assert [d for d, t, *_ in got if passage in t] == [0]
    table = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in table.collect()]
    assert sorted((tuple(r) for r in spans.dedup_substrings(table).collect()), key=str) == plain(rows)


def test_odd_tables(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in spans.dedup_substrings(docs).collect()), key=str) == plain(rows)
    out = spans.cut_repeats(docs)
    assert out.columns == docs.columns
    by = {r.doc_id: r for r in out.collect()}
    assert by[2].text == "" and by[2].n_chars == 0 and by[3].text is None and by[3].n_chars == 1
    assert by[1].text == prose(1) and by[1].source == "a"
    assert spans.dedup_substrings(empty_documents(spark)).count() == 0
    assert spans.cut_repeats(empty_documents(spark)).count() == 0


def test_cut_covers_the_text():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("ab. !\n?。") for _ in range(120)).encode()
        starts, parts = spans.cut(text)
        assert len(starts) == len(parts) and starts == sorted(starts)
        assert b"".join(w for p in parts for w in p) == b"".join(text.split())
        ends = [*starts[1:], len(text)]
        assert all(text[a:b].split() == p for a, b, p in zip(starts, ends, parts))
