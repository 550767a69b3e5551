import math
import re
from collections import Counter

import numpy as np
import pytest
import zlib
from pyspark.sql import functions as F

from tablecraft.llm import lm
from tablecraft.llm.text import remainder
from common import empty_documents, odd_documents, prose


def plain_words(text):
    return re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def plain_base(rows):
    counts = Counter()
    for d, t in rows:
        if not held(d):
            counts.update(plain_words(t) + [""])
    total, kinds = sum(counts.values()), len(counts)
    out = []
    for d, t in rows:
        words = plain_words(t) + [""]
        score = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in words)
        out.append((d, held(d), len(words), sum(counts[w] > 0 for w in words), total, score))
    return sorted(out, key=str)


def check_base(rows, scored):
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in scored), key=str)
    want = plain_base(rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want])


def test_base_and_gain(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    scored = lm.score_documents(docs, remainder("doc_id", 10) == 0).collect()
    check_base(rows, scored)
    out = [r for r in scored if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert all(r.score < 0 for r in scored)


def test_rare_words_through_the_join_change_nothing(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(80)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    monkeypatch.setattr(lm, "ROUNDS", 0)
    whole = {r.doc_id: r.score for r in lm.score_documents(docs, remainder("doc_id", 10) == 0).collect()}
    monkeypatch.setattr(lm.build_vocabulary, "__defaults__", (lm.HEAD, lm.HEAD + 50))
    scored = lm.score_documents(docs, remainder("doc_id", 10) == 0).collect()
    check_base(rows, scored)
    assert all(abs(r.score - whole[r.doc_id]) < 1e-2 for r in scored)


def test_odd_tables(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check_base(rows, lm.score_documents(docs, remainder("doc_id", 10) == 0).collect())
    assert lm.score_documents(empty_documents(spark), remainder("doc_id", 10) == 0).count() == 0
    none = lm.score_documents(docs, F.lit(True)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.score <= 0 for r in none)


@pytest.fixture(scope="module")
def vocabulary():
    words = Counter(w for i in range(60) for w in plain_words(prose(i)))
    names = [b"", *[w.encode() for w, _ in words.most_common()]]
    counts = np.array([60, *[n for _, n in words.most_common()]], float)
    head, letters = 70, {c: i for i, c in enumerate("abcdefg")}
    mass, kinds = np.zeros(8), np.zeros(8)
    for w, n in zip(names[head:], counts[head:]):
        k = letters.get(w.decode()[0], 7)
        mass[k] += n
        kinds[k] += 1
    return lm.Vocabulary({w: i for i, w in enumerate(names)}, counts, head, {k.encode(): i for k, i in letters.items()}, mass, kinds, 0.4, int(counts.sum()), len(names))


def test_chances_add_up_to_one(vocabulary):
    v, rng = vocabulary, np.random.default_rng(1)
    net = lm.Network(v)
    for k in net.w:
        net.w[k] = net.w[k] + rng.normal(0, 0.3, net.w[k].shape).astype(np.float32)
    net.w["word_bias"][v.head :] = -30
    h = rng.normal(0, 1, (1, lm.HIDDEN)).astype(np.float32)
    symbols = np.arange(v.head + len(v.mass))
    chance = np.exp(net.outputs(np.repeat(h, len(symbols), 0), symbols))
    assert abs(chance.sum() - 1) < 1e-4
    for k in range(len(v.mass)):
        own = [r for r in range(v.head, len(v.counts)) if v.symbol[r] == v.head + k]
        assert abs(sum(10 ** v.inner[r - 0] for r in own) + 10 ** v.unseen(k) - 1) < 1e-9


def test_gradient(vocabulary):
    v, rng = vocabulary, np.random.default_rng(2)
    docs = [rng.integers(0, v.head + len(v.mass), n) for n in (9, 4, 6)]
    ids, fresh, _ = lm.lay_out(docs, 2, v.inputs - 1)
    live = ~fresh
    net = lm.Network(v)
    net.w = {k: x.astype(np.float64) + rng.normal(0, 0.2, x.shape) for k, x in net.w.items()}

    def loss():
        return net.window(ids[:-1], fresh[:-1], np.zeros((2, lm.HIDDEN), np.float32), ids[1:], live[1:])

    _, grads, _, _ = loss()
    for name in net.w:
        flat = net.w[name].ravel()
        for at in np.argsort(-np.abs(grads[name].ravel()))[:4]:
            keep, step = flat[at], 1e-2
            flat[at] = keep + step
            up = loss()[2]
            flat[at] = keep - step
            down = loss()[2]
            flat[at] = keep
            assert abs((up - down) / (2 * step) - grads[name].ravel()[at]) < 2e-2 * max(1, abs(grads[name].ravel()[at])), name


def test_states_are_carried_and_documents_do_not_mix(vocabulary, monkeypatch):
    v, rng = vocabulary, np.random.default_rng(3)
    docs = [rng.integers(0, v.head + len(v.mass), n) for n in (1, 300, 7, 64, 33, 1, 120)]
    net = lm.Network(v)
    net.train(docs, passes=3)
    together = net.score(docs)
    assert np.allclose(together, [net.score([d])[0] for d in docs], rtol=1e-4)
    monkeypatch.setattr(lm, "WINDOW", 5)
    monkeypatch.setattr(lm, "LANES", 2)
    assert np.allclose(net.score(docs), together, rtol=1e-4)
    assert net.score(docs).sum() > lm.Network(v).score(docs).sum()


def test_one_long_document_among_short_ones_does_no_harm(vocabulary):
    """Windows that only the long document still fills do not draw the weights to it."""
    v = vocabulary
    some = [lm.encode([w.encode() for w in plain_words(prose(i))], v)[0] for i in range(200)]
    long = lm.encode([w.encode() for w in plain_words(prose(999, 2_223))], v)[0]
    net = lm.Network(v)
    net.train([*some, long])
    assert len(long) > 20_000 and net.score(some).sum() > 1.05 * lm.Network(v).score(some).sum()


def test_frequent_words_are_bounded_by_their_counts(spark):
    counts = spark.createDataFrame([(bytes([65 + i]), n) for i, n in enumerate((9000, 5000, 7, 7, 7, 2, 1, 1))], "word binary, n long")
    known = lambda head, known: sorted(r.n for r in lm.frequent_words(counts, head, known).collect())
    assert known(1, 8) == [1, 1, 2, 7, 7, 7, 5000, 9000]
    assert known(1, 6) == [2, 7, 7, 7, 5000, 9000]
    assert known(1, 4) == [5000, 9000]  # the three of the edge are left out together
    assert known(3, 4) == [7, 5000, 9000]
    assert lm.frequent_words(counts.filter("false")).count() == 0


def test_rounds_grow_with_replicas():
    assert lm.rounds_for(10) == lm.ROUNDS == lm.rounds_for(2 * lm.MANY * lm.REPLICA_TOKENS)
    assert lm.rounds_for(16 * lm.MANY * lm.REPLICA_TOKENS) == lm.ROUNDS + 1


def test_parts_of_a_replica_keep_their_moments(vocabulary):
    docs = [lm.encode([w.encode() for w in plain_words(prose(i))], vocabulary)[0] for i in range(40)]
    net = lm.Network(vocabulary)
    net.train(docs[:20])
    steps = net.steps
    net.train(docs[20:])
    assert net.steps > steps > 0
