import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tablecraft.llm import merkle, queries
from common import empty_documents, odd_documents

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes, arity):
    """The root of a list of hashes and each one's siblings, per level as (left, right)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            a = i // arity * arity
            paths[k].append(("".join(nodes[a:i]), "".join(nodes[i + 1 : a + arity])))
            at[k] = i // arity
        nodes = [h(*nodes[i : i + arity]) for i in range(0, len(nodes), arity)]
    return nodes[0], paths


def fold(node, path):
    for left, right in path:
        node = h(left, node, right)
    return node


def plain(rows, arity, tamper):
    groups = {}
    for r in rows:
        values = [r.doc_id, r.source, r.lang, r.n_chars, r.text]
        now = list(values)
        if tamper(r) and now[3] is not None:
            now[3] += 1
        groups.setdefault(r.lang, []).append((r.doc_id, leaf(values), leaf(now)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    low = {g: tree([x[1] for x in groups[g]], arity) for g in order}
    root, high = tree([low[g][0] for g in order], arity) if order else (None, [])
    out = []
    for g, above in zip(order, high):
        for (i, own, now), path in zip(groups[g], low[g][1]):
            whole = path + above
            back = fold(now, whole)
            out.append((i, own, low[g][0], root, h(*[a + b for a, b in whole]), back, back == root))
    return sorted(out, key=str)


def sevenths(r):
    return r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0


def made(docs, arity=merkle.ARITY, depth=merkle.DEPTH):
    broken = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = {"n_chars": F.when(broken, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    out = merkle.manifest(docs, "lang", "doc_id", FIELDS, changed, arity, depth)
    return out.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof"), "folded_root", "verified")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("arity,depth", [(2, 8), (2, 1), (2, 2), (3, 2), (4, 1)])
def test_trees(spark, folder, arity, depth):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(90)
    assert rows_of(made(docs, arity, depth)) == plain(docs.collect(), arity, sevenths)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 8, 9])
def test_small_groups(spark, n):
    docs = spark.createDataFrame([(i, f"s{i}", "en", i, "t") for i in range(n)] + [(99, None, None, None, None)], "doc_id long, source string, lang string, n_chars long, text string")
    assert rows_of(made(docs, 2, 2)) == plain(docs.collect(), 2, sevenths)


def test_query_and_tampering(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = queries.QUERIES["op11_merkle_manifest"](spark, folder)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = rows_of(out)
    assert got == plain(docs.collect(), 2, sevenths)
    assert {r[0] for r in got if not r[6]} == {r.doc_id for r in docs.collect() if sevenths(r) and r.n_chars is not None}


def test_odd_tables(spark):
    docs = odd_documents(spark).withColumns({c: F.lit(1) for c in ("node", "path", "root", "_at", "leaf")})
    assert rows_of(made(docs, 2, 2)) == plain(docs.collect(), 2, sevenths)
    assert made(empty_documents(spark)).count() == 0
    some = spark.createDataFrame([(1, "a", "", 1, "t"), (1, "a", "", 1, "t"), (1, "b", "é", 1, "t"), (2, "a", "z", None, "t")], "doc_id long, source string, lang string, n_chars long, text string")
    assert rows_of(made(some, 2, 1)) == plain(some.collect(), 2, sevenths)
