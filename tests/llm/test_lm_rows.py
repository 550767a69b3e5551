from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tablecraft.llm import lm
from tablecraft.llm.text import as_bytes, remainder, words_of


def test_rounds_train_on_every_training_document(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    train = docs.filter(remainder("doc_id", 10) != 0).select(F.col("doc_id").alias("_row"), as_bytes("text").alias("_text"))
    v = lm.build_vocabulary(lm.count_words(train))
    seen, map_rows = [], lm.map_rows

    def watched(rows, fields, worker):
        seen.extend(bytes(r._text) for r in rows.collect())
        return map_rows(rows, fields, worker)

    monkeypatch.setattr(lm, "map_rows", watched)
    lm.train_network(train, v)
    assert sorted(seen) == sorted(bytes(r._text) for r in train.collect())


def test_texts_are_cut_and_looked_up_by_part(monkeypatch):
    """Words of many texts go through one kernel call, and come out as those of each text alone."""
    odd = [b"", b" ", b"  A b\x0b\x0cC\xc3\x89 \n", bytes(range(256)) * 2, b"\x1c\x1d x\x1fy\x85\xa0z", "É ß ñ one".encode(), b"one One two "]
    texts = odd + [b"one two " * 9, b"three"] * 50
    counts = Counter(w for t in texts for w in words_of(t)) + Counter({lm.END: len(texts)})
    ranks = {w: i for i, w in enumerate([lm.END, b"one", b"two", b"b"])}
    mass = np.array([3.0, 5.0])
    v = lm.Vocabulary(ranks, np.array([counts[w] for w in ranks], float), 2, {b"t": 0}, mass, mass, 0.5, sum(counts.values()), len(counts))
    calls, index_in = [], lm.pc.index_in
    monkeypatch.setattr(lm, "PART_BYTES", 600)
    monkeypatch.setattr(lm.pc, "index_in", lambda *a, **k: calls.append(1) or index_in(*a, **k))
    parts = list(lm.parts_of(texts))
    done = [lm.encode_words(*lm.words_in(texts[p]), v) for p in parts]
    assert len(calls) == len(parts) < len(texts) / 4 and [k for p in parts for k in range(p.start, p.stop)] == list(range(len(texts)))
    symbol = lambda w: ranks[w] if w in (lm.END, b"one") else v.head + v.tail_class(w)
    for text, numbers, rare in zip(texts, (s for d in done for s in d.symbols), (r for d in done for r in d.rare)):
        words = words_of(text)
        assert numbers.tolist() == [symbol(w) for w in [*words, lm.END]]
        assert rare == Counter(w for w in words if w not in ranks)
    known = [[w for t in texts[p] for w in words_of(t) if w in ranks] for p in parts]
    assert [d.ranks.tolist() for d in done] == [[ranks[w] for w in k] for k in known]


def _vocabulary(words=40, head=33):
    names = [lm.END, *(f"w{i}".encode() for i in range(words))]
    mass = np.array([30.0, 20.0, 10.0])
    counts = np.arange(len(names), 0, -1, dtype=float)
    return lm.Vocabulary(dict(zip(names, range(len(names)))), counts, head, {b"w": 0, "é".encode(): 1}, mass, mass, 0.5, int(counts.sum()) + 60, 90)


def test_unknown_words_get_their_classes_without_a_call_each(monkeypatch):
    v, asked, tail_class = _vocabulary(), [], lm.Vocabulary.tail_class
    texts = ["wx wx é1 zz w3".encode(), b"", "日本 é1 wx".encode(), b"w1 w2"] * 20
    want = [Counter(w for w in words_of(t) if w not in v.ranks) for t in texts]
    monkeypatch.setattr(lm.Vocabulary, "tail_class", lambda self, w: asked.append(w) or tail_class(self, w))
    done = lm.encode_words(*lm.words_in(texts), v)
    assert len(asked) == len({*asked}) == 2  # the two that do not begin with ASCII
    assert [done.symbols[0].tolist(), done.symbols[2].tolist()] == [[v.head, v.head, v.head + 1, v.head + 2, 4, 0], [v.head + 2, v.head + 1, v.head, 0]]
    kind = lm.pa.list_(lm.pa.struct([("word", lm.pa.binary()), ("k", lm.pa.int32()), ("tail", lm.pa.int32())]))
    lists = done.rare_lists(kind).to_pylist()
    assert [Counter({r["word"]: r["k"] for r in own or ()}) for own in lists] == done.rare == want
    assert [own is None for own in lists] == [not c for c in want]
    assert all(r["tail"] == tail_class(v, r["word"]) for own in lists for r in own or ())


def test_parts_are_scored_together(monkeypatch):
    """A long text in each of many parts is stepped through once for all of them, not once a part."""
    parts = [({"k": k}, [np.zeros(n, np.int32) for n in (90, 5, 5)]) for k in range(10)]
    monkeypatch.setattr(lm, "SCORED_TOKENS", 400)
    held = list(lm.held_together(iter(parts)))
    assert [len(h) for h in held] == [4, 4, 2] and [out["k"] for h in held for out, _ in h] == list(range(10))
    assert list(lm.held_together(iter([]))) == []
    net, steps, step = lm.Network(_vocabulary()), [], lm.Network.step
    monkeypatch.setattr(lm.Network, "step", lambda self, *a: steps.append(1) or step(self, *a))
    together = net.score([x for _, symbols in held[0] for x in symbols])
    once = len(steps)
    alone = np.concatenate([net.score(symbols) for _, symbols in held[0]])
    assert np.allclose(together, alone, rtol=1e-5) and len(steps) - once == 4 * once


def test_sums_by_key_and_far_logits():
    rng = np.random.default_rng(5)
    keys, rows = np.minimum(rng.geometric(0.05, 500), 60), rng.normal(0, 1, (900, 6))
    at = rng.permutation(900)[:500]
    found, sums = lm.sums_by(keys, rows, at)
    assert sorted(found.tolist()) == sorted({*keys.tolist()})
    assert all(np.allclose(s, rows[at[keys == k]].sum(axis=0)) for k, s in zip(found, sums))
    assert lm.sums_by(keys[:0], rows, at[:0])[1].shape == (0, 6)
    net = lm.Network(_vocabulary())
    net.w["classes"][:, 0], net.w["words"][3] = 300, 40
    assert net.layers()[1] and not lm.Network(net.v).layers()[1]
    hs = np.tanh(rng.normal(0, 2, (50, lm.HIDDEN))).astype(np.float32)
    symbols = np.arange(net.v.head + len(net.v.mass))
    chances = np.array([np.exp(net.outputs(np.repeat(h[None], len(symbols), 0), symbols).astype(float)).sum() for h in hs])
    assert np.allclose(chances, 1, atol=1e-4)
