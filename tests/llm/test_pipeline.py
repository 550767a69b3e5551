import os
import shutil
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablecraft.llm import align, quality, queries
from common import empty_documents, odd_documents
from test_simhash import expected as components_of
from test_spans import plain as plain_spans
from test_tokens import check_places

ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]
CONTRACT = {
    "op1_": ["doc_id", "fingerprint", "component_id"],
    "op2_": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op3_": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op4_": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op5_": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op6_": ["doc_id", "item_id", "score"],
    "op7_": ["doc_id", "held_out", "score", "predicted"],
    "op8_": ["doc_id", "text"],
    "op9_": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op10_": ["page_id", "host", "path", "rule", "verdict"],
    "op11_": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op12_": ["lang", "source", "part", "item", "value", "rank"],
    "op13_": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
}


@pytest.fixture(scope="module")
def stages(spark, folder):
    """Input and output rows of each stage, the last one's output as a table."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.written(stage(spark, docs, folder), "stage")
        out.append((docs.collect(), after.collect(), after.columns))
        docs = after
    return out


def test_quality_stage(spark, folder, stages):
    before, after, columns = stages[0]
    assert columns == DOCUMENTS
    verdict = quality.judge(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    kept = {r.doc_id for r in verdict.filter("kept").collect()}
    assert {r.doc_id for r in after} == kept
    good = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").filter("quality = 1").collect()}
    failed = {r.doc_id for r in verdict.filter("base_failed").collect()}
    assert len(good - failed - kept) <= 0.02 * len(good)


def test_simhash_stage(stages):
    before, after, columns = stages[1]
    assert columns == DOCUMENTS
    groups = components_of([(r.doc_id, r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted(d for d, _, c in groups if d == c)


def test_substring_stage(stages):
    before, after, columns = stages[2]
    assert columns == DOCUMENTS
    want = {d: t for d, t, *_ in plain_spans([(r.doc_id, r.text) for r in before])}
    assert {r.doc_id: r.text for r in after} == want
    changed = {r.doc_id for r in before if r.text != want[r.doc_id]}
    assert all(r.n_chars == len(r.text) for r in after if r.doc_id in changed)


def test_decontamination_stage(spark, folder, stages):
    before, after, columns = stages[3]
    assert columns == DOCUMENTS
    hashes = align.WordHashes()
    items = [hashes(r.text.encode().split()) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    for r in before:
        words = hashes(r.text.encode().split())
        shared = [i for i in items if np.isin(i, words).mean() >= align.CUT]
        assert (r.doc_id in gone) == any(align.align(i, words)[0] >= align.CUT for i in shared)


def test_packing_stage(stages):
    before, after, _ = stages[4]
    assert {r.doc_id for r in before} == {r.doc_id for r in after}
    assert check_places(after, 4096) <= 1 + -(-sum(r.length for r in after) // 4096) * 1.03


def test_odd_and_empty_documents(spark, folder):
    for docs in (odd_documents(spark), empty_documents(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, folder)
            if name != "best-fit packing":
                assert out.columns == docs.columns, name
            out.count()


def test_queries_have_the_contracts_columns(spark, folder):
    for start, columns in CONTRACT.items():
        name = next(n for n in queries.QUERIES if n.startswith(start))
        out = queries.QUERIES[name](spark, folder)
        assert out.columns[: len(columns)] == columns, name
    assert "pipeline" in queries.QUERIES and corpus_pipeline.ORACLE_SQL is None


def test_everything_else_works_without_this_package(tmp_path):
    copy = tmp_path / "repo"
    ignore = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "spark-warehouse")
    shutil.copytree(ROOT, copy, ignore=ignore)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 200 and not any(n.startswith('op1_') for n in q); e.oracle_sql()"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, check=True, timeout=120)
