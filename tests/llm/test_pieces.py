import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tablecraft.llm import multikey, pieces, queries
from common import empty_documents, odd_documents, prose

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def merges():
    return pieces.read_merges(PATH)


def check(texts, library, merges):
    flat, ends = pieces.WordMerger(merges).encode([t.encode() for t in texts])
    for text, a, b in zip(texts, [0, *ends[:-1].tolist()], ends.tolist()):
        want = library.encode(text)
        assert flat[a:b].tolist() == want, text[:100]
        assert pieces.text_of(flat[a:b], merges) == library.decode(want), text[:100]


def test_awkward_texts(library, merges):
    fixed = ["", " ", "  ", "   a", "a  ", "▁", "▁a▁▁ b", "\n\n", "\r\n\t", "<s></s><unk>", "<0x0A>", "\x00", "a\x00", "aaaa" * 50,
             " " * 100, "😀" * 9, "日本語のテキスト", "x" * 20_000, "abab" * 999, "é́", "word" + " " * 17 + "word", "�"]
    check(fixed, library, merges)


def test_random_texts(library, merges):
    rng = random.Random(3)
    letters = [" ", "▁", "\n", *"abething.x01-", "é", "日", "本", "\t", "\0", "😀", "ß", "안"]
    for _ in range(10):
        some = letters[: rng.randint(2, len(letters))]
        check(["".join(rng.choices(some, k=rng.randint(0, 70))) for _ in range(300)], library, merges)


def test_long_texts_without_a_blank(library, merges):
    rng = random.Random(4)
    check(["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=50_000)), "日本安的一" * 20_000, prose(1, 3000)], library, merges)


def test_any_ids_decode_as_the_library_does(library, merges):
    rng = random.Random(5)
    for _ in range(3000):
        ids = [rng.randrange(32_000) if rng.random() < 0.5 else rng.randrange(259) for _ in range(rng.randint(0, 12))]
        assert pieces.text_of(np.array(ids, int), merges) == library.decode(ids), ids
    with pytest.raises(ValueError):
        pieces.text_of(np.array([32_000]), merges)


def test_runs_of_pointers():
    rng = random.Random(6)
    words = [bytes(rng.choices(b"ab", k=rng.randint(1, 30))) for _ in range(3000)]
    group = np.sort(np.array([rng.randrange(4) for _ in words]))
    length = np.array([len(w) for w in words])
    order, new = multikey.sorted_runs(multikey.padded(b"".join(words)), np.cumsum(length) - length, length, group)
    got = [(group[i], words[i]) for i in order]
    assert got == sorted(zip(group.tolist(), words))
    assert new.tolist() == [i == 0 or got[i] != got[i - 1] for i in range(len(got))]
    none = np.zeros(0, int)
    assert multikey.sorted_runs(multikey.padded(b""), none, none, none)[0].size == 0


def test_query_against_the_library(spark, folder, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    out = queries.QUERIES["op13_sentencepiece"](spark, folder)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = out.collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_odd_tables(spark, library):
    docs = odd_documents(spark).withColumn("ids", F.lit("clash"))
    encoded = pieces.encode_texts(docs, PATH)
    assert encoded.columns == [c for c in docs.columns if c not in ("text", "ids")] + ["ids"]
    want = sorted(((r.doc_id, library.encode(r.text or "")) for r in docs.collect()), key=str)
    assert sorted(((r.doc_id, r.ids) for r in encoded.collect()), key=str) == want
    decoded = pieces.decode_ids(encoded, PATH).collect()
    assert sorted(((r.doc_id, r.text) for r in decoded), key=str) == sorted(((d, library.decode(i)) for d, i in want), key=str)
    assert pieces.decode_ids(pieces.encode_texts(empty_documents(spark), PATH), PATH).count() == 0
    none = pieces.decode_ids(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>"), PATH)
    assert [r.text for r in none.collect()] == ["", ""]


def test_slices_hold_whole_rows():
    assert list(pieces._slices([])) == []
    parts = list(pieces._slices([1, pieces.SLICE_BYTES, 5, 0, 7]))
    assert parts == [(0, 1), (1, 2), (2, 5)]
