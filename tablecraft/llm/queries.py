"""The registered queries of this package: thin bindings to the given tables."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.llm import align, divergence, lm, merkle, packing, pieces, quality, simhash, spans, token_counts, toxicity, urls, warc
from tablecraft.llm.text import remainder
from tablecraft.plans.registry import Tables
from tablecraft.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Tables(tune(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return fn


def _vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@_query
def op1_simhash_dedup(t: Tables) -> DataFrame:
    return simhash.near_duplicates(t.documents)


@_query
def op2_best_fit_packing(t: Tables) -> DataFrame:
    parts = packing.pieces(t.documents, _vocabulary()).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(packing.written(parts, "pieces"), ["doc_id", "piece"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@_query
def op3_token_counts(t: Tables) -> DataFrame:
    return token_counts.token_counts(t.documents, _vocabulary())


@_query
def op5_warc(t: Tables) -> DataFrame:
    read = warc.archive_and_read(t.pages)
    return read.select(
        F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        F.col("refers_to").cast("long").alias("refers_to"),
    )


_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, g * 10 + 1, 10))::BIGINT >> (35 - 5 * d)) & 31)::INT, 1)"
ORACLE_SQL["op5_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS keep FROM p)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
  (SELECT string_agg({_DIGIT}, '' ORDER BY g, d) FROM range(4) a(g), range(8) b(d)) AS payload_digest,
  CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = keep THEN NULL ELSE keep END AS refers_to
FROM m
"""


@_query
def op9_quality_rules(t: Tables) -> DataFrame:
    return quality.judge(t.documents, t.labels)


#: Fixed rules of the contract.
URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]


@_query
def op10_url_filters(t: Tables) -> DataFrame:
    return urls.judge(t.pages, URL_RULES)


@_query
def op6_decontamination(t: Tables) -> DataFrame:
    return align.contaminated(t.documents, t.benchmark)


@_query
def op8_substring_dedup(t: Tables) -> DataFrame:
    return spans.dedup_substrings(t.documents)


@_query
def op7_toxicity(t: Tables) -> DataFrame:
    train = t.labels.filter(remainder("doc_id", 3) != 1)
    model = toxicity.fit(t.documents, train)
    return toxicity.score_texts(t.documents, model).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", "predicted"
    )


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL


@_query
def op4_language_model(t: Tables) -> DataFrame:
    return lm.score_documents(t.documents, remainder("doc_id", 10) == 0)


@_query
def op13_sentencepiece(t: Tables) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = pieces.encode_texts(t.documents.select("doc_id", "text"), path)
    return pieces.decode_ids(encoded, path).select("doc_id", *pieces.digests())


@_query
def op12_source_divergence(t: Tables) -> DataFrame:
    return divergence.audit(t.documents)


ORACLE_SQL["op12_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
grid AS (SELECT g.lang, g.source, k.term, lang_n, coalesce(n, 0) AS n, count(*) OVER (PARTITION BY g.lang, g.source) AS v,
    sum(coalesce(n, 0)) OVER (PARTITION BY g.lang, g.source) AS total, sum(lang_n) OVER (PARTITION BY g.lang, g.source) AS lang_total
  FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
s AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (total + 5 * v) AS p,
    1 + (1000000000::HUGEINT * (lang_n + 5)) // (lang_total + 5 * v) AS q FROM grid),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM s WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) u
QUALIFY part = 'pair' OR rank <= 50
"""


@_query
def op11_merkle_manifest(t: Tables) -> DataFrame:
    broken = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = {"n_chars": F.when(broken, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    made = merkle.manifest(t.documents, "lang", "doc_id", ["doc_id", "source", "lang", "n_chars", "text"], changed)
    return made.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), "folded_root", "verified")


def _merkle_sql() -> str:
    """Level by level by recursion; crc32 bit by bit over the decimal digits of an id."""
    part = lambda c: f"coalesce(strlen({c}) || ':' || {c}, '-')"
    leaf = lambda n: f"sha256({part('CAST(doc_id AS VARCHAR)')} || {part('source')} || {part('lang')} || {part(n)} || {part('text')})"
    bit = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    byte = f"list_reduce(list_prepend(xor(c, d), CAST(range(8) AS BIGINT[])), lambda c, k: {bit})"
    crc = f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, d: {byte}), 4294967295)"

    def tree(name: str, start: str) -> str:
        # n nodes on a level; every two make one above, up to a level of one.
        return f"""
{name} AS (
  SELECT g, 0 AS lvl, i, n, h FROM ({start})
  UNION ALL
  SELECT g, lvl + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM {name} WHERE n > 1 GROUP BY g, lvl, i // 2),
{name}_path AS (
  SELECT g, i AS leaf, i, 0 AS lvl, '' AS sib, h AS now FROM {name}_start
  UNION ALL
  SELECT p.g, p.leaf, p.i // 2, p.lvl + 1, p.sib || coalesce(s.h, ''),
    sha256(CASE WHEN p.i % 2 = 0 THEN p.now || coalesce(s.h, '') ELSE s.h || p.now END)
  FROM {name}_path p JOIN {name} m ON m.g = p.g AND m.lvl = p.lvl AND m.i = p.i AND m.n > 1
  LEFT JOIN {name} s ON s.g = p.g AND s.lvl = p.lvl AND s.i = xor(p.i, 1)),
{name}_end AS (SELECT g, leaf, sib, now FROM {name}_path QUALIFY row_number() OVER (PARTITION BY g, leaf ORDER BY lvl DESC) = 1)"""

    return f"""
WITH RECURSIVE d AS (
  SELECT *, coalesce(lang, '') || CASE WHEN lang IS NULL THEN '-' ELSE '+' END AS g, {leaf('CAST(n_chars AS VARCHAR)')} AS h,
    {leaf("CAST(n_chars + CASE WHEN doc_id IS NOT NULL AND " + crc + " % 7 = 0 THEN 1 ELSE 0 END AS VARCHAR)")} AS now
  FROM documents),
p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d),
low_start AS (SELECT g, i, now AS h FROM p),
{tree('low', 'SELECT g, i, n, h FROM p')},
sub AS MATERIALIZED (SELECT t.g, t.h, row_number() OVER (ORDER BY p.lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n
  FROM low t JOIN p ON p.g = t.g AND p.i = 0 WHERE t.n = 1),
high_start AS (SELECT 'all' AS g, i, h FROM sub),
{tree('high', "SELECT 'all' AS g, i, n, h FROM sub")},
fold AS (
  SELECT e.g, e.leaf, e.sib || t.sib AS sib, e.now, sub.i, sub.h AS subroot, 0 AS lvl, t.now AS root
  FROM low_end e JOIN sub ON sub.g = e.g JOIN high_end t ON t.leaf = sub.i
  UNION ALL
  SELECT f.g, f.leaf, f.sib, sha256(CASE WHEN f.i % 2 = 0 THEN f.now || coalesce(s.h, '') ELSE s.h || f.now END), f.i // 2, subroot, f.lvl + 1, root
  FROM fold f JOIN high m ON m.lvl = f.lvl AND m.i = f.i AND m.n > 1
  LEFT JOIN high s ON s.lvl = f.lvl AND s.i = xor(f.i, 1)),
last AS (SELECT * FROM fold QUALIFY row_number() OVER (PARTITION BY g, leaf ORDER BY lvl DESC) = 1)
SELECT p.doc_id, p.h AS leaf, subroot, root, sha256(sib) AS proof_sha256, last.now AS folded_root, last.now = root AS verified
FROM p JOIN last ON last.g = p.g AND last.leaf = p.i
"""


ORACLE_SQL["op11_merkle_manifest"] = _merkle_sql()
