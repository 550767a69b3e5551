import random
import re

import numpy as np

from tablecraft.llm import quality, trees
from common import empty_documents, odd_documents, prose

SPACE = "\x20\x09-\x0d"


def plain_counts(text):
    text = text or ""
    words = re.findall(f"[^{SPACE}]+", text)
    lines = [x for x in text.split("\n") if re.search(f"[^{SPACE}]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)]


def test_counts():
    rng = random.Random(4)
    texts = ["", "a", "a b c a b c", "x x x x", " \n \n", "é\u00a0ñ\u2003b #|#", "l\nl\n l\nl\n", prose(1), "#a\x85b\x1cc"]
    texts += ["".join(rng.choice("ab \n#") for _ in range(80)) for _ in range(60)]
    for t in texts:
        counts, features = quality.statistics(t.encode())
        assert counts == plain_counts(t), t
        assert len(features) == len(quality.FEATURES) and np.isfinite(features).all()


def labelled(spark, n=400):
    good = [(i, prose(i, 8), 1) for i in range(n)]
    shouted = [(n + i, " ".join(w.upper() + "!!" for w in prose(i, 8).split()), 0) for i in range(n // 2)]
    rows = good + shouted
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, q, 0) for i, _, q in rows], "doc_id long, quality int, toxic int")


def test_verdicts_on_unseen_documents(spark):
    docs, labels = labelled(spark)
    out = quality.judge(docs, labels.filter("doc_id % 3 <> 0")).collect()
    assert len(out) == docs.count()
    assert all(r.kept == (r.doc_id < 400) for r in out if not r.base_failed)
    assert all(r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words) for r in out)


def test_odd_tables(spark):
    docs, (_, labels) = odd_documents(spark), labelled(spark)
    none = labels.filter("false")
    nulls = spark.createDataFrame([(1, None, None), (None, 1, 0), (9, 0, 1), (9, 1, 1)], labels.schema)
    for own in (labels, none, nulls):
        rows = quality.judge(docs, own).collect()
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in docs.collect())
        kept = quality.keep_good(docs, own)
        assert kept.columns == docs.columns
    assert {r.doc_id for r in quality.keep_good(docs, none).collect()} == {1, 2, 6, 9, None}
    assert quality.judge(empty_documents(spark), labels).count() == 0


def test_trees_keep_constraints_and_match_a_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 3))
    y = (x[:, 0] + 0.5 * np.sin(3 * x[:, 1]) + rng.normal(size=3000) > 0).astype(float)
    forest = trees.fit(x, y, np.array([1, 0, -1]))
    line = np.zeros((200, 3))
    for j, sign in ((0, 1), (2, -1)):
        for other in rng.normal(size=(20, 3)):
            line[:] = other
            line[:, j] = np.linspace(-3, 3, 200)
            assert (sign * np.diff(forest.raw(line)) >= -1e-12).all()
    assert ((forest.chance(x) > 0.5) == y).mean() > 0.75

    def walk(row):
        out = forest.base
        for k in forest.roots:
            while forest.left[k] != k:
                k = forest.left[k] if row[forest.feature[k]] <= forest.threshold[k] else forest.right[k]
            out += forest.value[k]
        return out

    assert np.allclose(forest.raw(x[:50]), [walk(r) for r in x[:50]])
