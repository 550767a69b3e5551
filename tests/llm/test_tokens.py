import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tablecraft.llm import packing, token_counts
from tablecraft.llm.tokens import encoder
from common import empty_documents, odd_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_are_the_librarys(library, spark, folder):
    texts = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    texts += [r.text or "" for r in odd_documents(spark).collect()]
    texts += ["don't I'm can'T  x y ŉ İ ſ ÉCOLE é ́a ǅ ª٣ <|ENDOFTEXT|> a<|endoftext|>b --'s", "\x00\x1f\x85 tab\tx"]
    rng = random.Random(1)
    pool = "aB'é.,!<|>ß \n\tÎ9٣中́ ×÷ıſ"
    texts += ["".join(rng.choice(pool) for _ in range(60)) for _ in range(300)]
    encode = encoder(PATH)
    for text in texts:
        assert np.frombuffer(encode(text.encode()), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text[:80]


def test_counts(spark, library):
    docs = odd_documents(spark)
    got = sorted(map(tuple, token_counts.token_counts(docs, PATH).collect()), key=str)
    want = []
    for r in docs.collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 2048))
    assert got == sorted(want, key=str)
    assert token_counts.token_counts(empty_documents(spark), PATH).count() == 0


def test_cache_is_filled_once_and_used(spark, tmp_path):
    docs, cache = odd_documents(spark), str(tmp_path / "cache")
    first = sorted(map(tuple, token_counts.token_counts(docs, PATH, cache=cache).collect()), key=str)
    stored = spark.read.parquet(cache)
    size = stored.count()
    assert size == stored.select("digest").distinct().count() < docs.count()
    assert sorted(map(tuple, token_counts.token_counts(docs, PATH, cache=cache).collect()), key=str) == first
    assert spark.read.parquet(cache).count() == size


def test_piece_model(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = odd_documents(spark)
    got = sorted((r.doc_id or 0, r.n_tokens) for r in token_counts.token_counts(docs, path).collect())
    assert got == sorted((r.doc_id or 0, len(model.encode(r.text or ""))) for r in docs.collect())


def check_places(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
        assert sum(3 * n > capacity for _, n in places) <= 2
    return len(by)


def test_packing(spark, library, folder):
    for docs in (odd_documents(spark), spark.read.parquet(f"{folder}/documents.parquet")):
        rows = packing.pack_documents(docs, PATH).collect()
        used = check_places(rows, 4096)
        assert used <= 1 + -(-sum(r.length for r in rows) // 4096) * 1.03
        parts = {}
        for r in rows:
            parts.setdefault((r.doc_id, r.piece), []).append(r)
        for d in docs.collect():
            ids = np.array([*library.encode(d.text or "", add_special_tokens=False).ids, 1], "<u4")
            for piece, start in enumerate(range(0, len(ids), 4096)):
                own = parts[d.doc_id, piece]
                assert {(r.start, r.length, zlib.crc32(r.ids)) for r in own} == {
                    (start, len(ids[start : start + 4096]), zlib.crc32(ids[start : start + 4096].tobytes()))
                }
        whole = packing.sequences(packing.pack_documents(docs, PATH)).collect()
        assert sum(len(r.ids) for r in whole) == 4 * sum(r.length for r in rows)
    assert packing.pack_documents(empty_documents(spark), PATH).count() == 0


def test_any_lengths_and_a_hot_length(spark):
    rng = random.Random(3)
    for capacity, top in ((10, 10), (97, 97), (97, 30), (4096, 2000)):
        lengths = [rng.randrange(1, top + 1) for _ in range(400)] + [top // 3 + 1] * 300 + [1] * 50
        table = spark.createDataFrame(list(enumerate(lengths)), "k long, length long")
        rows = packing.pack(table, ["k"], capacity, rank_rows=40).collect()
        assert sorted((r.k, r.length) for r in rows) == list(enumerate(lengths))
        assert check_places(rows, capacity) <= 1.25 * sum(lengths) / capacity + 2
