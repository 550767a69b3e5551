import random

import numpy as np

from tablecraft.llm import toxicity
from common import empty_documents, odd_documents, prose

INSULTS = ["blockhead", "nincompoop", "dimwit", "scoundrel", "halfwit", "buffoon"]


def labelled(spark, n=500):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        words = prose(i, 4).split()
        toxic = int(i % 4 == 0)
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((i, " ".join(words), toxic))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, 1, x) for i, _, x in rows], "doc_id long, quality int, toxic int")


def plain_kernel(a, b):
    """Shared subsequences counted one by one, over the same norms."""
    def profile(u):
        letters = toxicity._ragged([u])[0][1][0]
        out, norm = {}, 0.0
        for places, weight in toxicity._subsequences(len(letters)):
            key = tuple(letters[list(places)])
            out[key] = out.get(key, 0.0) + weight
            norm += weight**2
        return out, norm**0.5

    (pa, na), (pb, nb) = profile(a), profile(b)
    return sum(v * pb.get(k, 0.0) for k, v in pa.items()) / (na * nb)


def test_kernel():
    units = ["idiot", "i-d.iot", "1d1ot", "banana", "çaña", "ab", "abcabcabc"]
    units = [u.encode() for u in units]
    table = toxicity.profiles(units)
    got = toxicity.project(units, table)
    want = [[plain_kernel(a, b) for b in units] for a in units]
    assert np.allclose(got, want, atol=1e-6)
    assert np.allclose(got[0], got[1]) and np.linalg.eigvalsh(got).min() > -1e-5
    assert np.isfinite(toxicity.project([b"", b"?", b"x" * 500, "日本".encode()], table)).all()


def test_unseen_texts(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs.filter("doc_id < 350"), labels)
    rows = {r.doc_id: r for r in toxicity.score_texts(docs, model).collect()}
    assert len(rows) == docs.count()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    wrong = [d for d, r in rows.items() if d >= 350 and r.predicted != truth[d]]
    assert len(wrong) <= 2
    bent = ["You block-head.", "you b l o c k h e a d", "a nincom.poop here", "dimxwit", "SCOUNDREL!!", "half wit amber3"]
    table = spark.createDataFrame(list(enumerate(bent)), "doc_id long, text string")
    assert [r.predicted for r in toxicity.score_texts(table, model).orderBy("doc_id").collect()][:5] == [1] * 5


def test_copies_are_no_evidence(spark):
    docs, labels = labelled(spark)
    copies = spark.createDataFrame([(1000 + i, "Harmless zebra passage of a copied text, nothing more. " + prose(1)) for i in range(80)], docs.schema)
    more = spark.createDataFrame([(1000 + i, 1, 1) for i in range(80)], labels.schema)
    model = toxicity.fit(docs.unionByName(copies), labels.unionByName(more))
    one = spark.createDataFrame([(1, "A zebra passage nothing")], docs.schema)
    assert toxicity.score_texts(one, model).first().predicted == 0


def test_odd_tables(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels)
    odd = odd_documents(spark)
    rows = toxicity.score_texts(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted == 0 for r in rows)
    assert toxicity.score_texts(empty_documents(spark), model).count() == 0
    for none in (labels.filter("toxic = 0"), labels.filter("false"), labels.selectExpr("doc_id", "quality", "CAST(NULL AS INT) AS toxic")):
        assert toxicity.fit(docs, none) is None
    assert {r.score for r in toxicity.score_texts(odd, None).collect()} == {0.0}
    assert toxicity.fit(odd, spark.createDataFrame([(1, 1, 1), (9, 1, 0), (3, 1, None), (None, 1, 1)], labels.schema)) is not None
