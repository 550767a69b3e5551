"""Token counts of whole texts through a digest cache.

The cache is a Parquet table of ``(tokenizer, digest, n_tokens)``, appended to and
never rewritten.  A digest is the SHA-256 of the normalised content, where runs of
ASCII white space are one blank: the tokenizers served here give both the same
count.  Only distinct digests that the cache misses are encoded, once each, and a
run appends them before it reads its counts from the cache.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.llm.text import as_bytes, map_rows
from tablecraft.llm.tokens import encoder
from tablecraft.plans.skew import join_keys
from tablecraft.plans.storage import path_exists, shared_dir, written

#: Tokens beyond which a document is over the limit.
LIMIT = 2048

_CACHE = "tokenizer string, digest binary, n_tokens long"


def _digest_of_file(docs: DataFrame, path: str) -> str:
    """Version of a tokenizer: the digest of its file, read where the query starts."""
    import hashlib

    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def normalised(text_col: str, path: str):
    """Content up to what the tokenizer cannot tell apart; SentencePiece texts stay as they are."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", " ") if path.endswith(".json") else text


def token_counts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT,
    cache: str | None = None,
) -> DataFrame:
    """One row per document row: id, n_bytes, n_tokens, over_limit.

    ``cache`` is the folder of the cache table (a fresh one in the shared folder if
    none is given).  Null texts count as empty: 0 bytes, 0 tokens.  Repeated ids and
    texts stay separate rows.  Two runs at once may append a digest twice; readers
    take one of the equal rows.
    """
    spark = docs.sparkSession
    version = _digest_of_file(docs, path)
    cache = cache or shared_dir(spark, "token-cache")
    content = normalised(text_col, path)
    digest = F.unhex(F.sha2(content.cast("binary"), 256))
    keyed = written(
        docs.select(F.col(id_col), F.octet_length(as_bytes(text_col)).cast("long").alias("n_bytes"), digest.alias("digest")),
        "digests",
    )

    def stored() -> DataFrame:
        if not path_exists(spark, cache):
            return spark.createDataFrame([], _CACHE)
        rows = spark.read.schema(_CACHE).parquet(cache).filter(F.col("tokenizer") == version)
        return rows.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))

    misses = written(keyed.select("digest").distinct().join(stored(), "digest", "left_anti"), "misses")
    # A text per missing digest; copies meet on the map side before they are sent.
    texts = (
        docs.select(digest.alias("digest"), content.cast("binary").alias("_text"))
        .join(misses, "digest", "left_semi").groupBy("digest").agg(F.first("_text").alias("_text"))
    )

    def worker(batches):
        encode = encoder(path)
        for b in batches:
            yield {"digest": b["digest"], "n_tokens": [len(encode(t)) // 4 for t in b["_text"]]}

    fields = [T.StructField("digest", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
    map_rows(texts, fields, worker).select(F.lit(version).alias("tokenizer"), "digest", "n_tokens").write.mode(
        "append"
    ).parquet(cache)
    return join_keys(keyed, stored(), ["digest"], "inner").select(
        id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
