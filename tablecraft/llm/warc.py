"""WARC archives written and read by Spark, with boundary-chain verification.

Writing: a record is one text value, and the two line ends that close a record are
the line separator of Spark's text writer, so its files are archives as they are.

Reading: files are split anywhere, at the magic line ``WARC/1.0``, also where a
payload holds it.  Each task parses the piece after each magic as if it were a
record and emits a candidate: its byte offset and that of its successor, which its
Content-Length gives.  Only candidates on the chain from the start of the file are
records.  The chain is followed by pointer jumping: in round k each candidate knows
the one 2^k links ahead, so a file of n records takes log2(n) equi-joins.  Chains
are first followed inside blocks of candidates, which leaves one pointer per block
entrance for the rounds.  A record whose payload holds the magic spans pieces and
is put together from them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablecraft.plans.skew import join_keys
from tablecraft.plans.storage import shared_dir, written

#: Fixed values of the format.
MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column: four groups of 40 bits, eight digits each."""
    hexed = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), _CONV_DIGITS, _BASE32)


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for null; control characters and '%' are percent-encoded."""
    text = value.cast("string")
    for c in "%\r\n\t\x00":
        text = F.replace(text, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), text, F.lit("\r\n")), F.lit(""))


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
    min_bytes: int = 0,
) -> None:
    """Write one record per row under ``path``.

    Of rows with equal payloads of at least ``min_bytes`` the one with the largest
    id is a response and the others are revisits of it, without a payload; rows that
    repeat that id with that payload are responses too.  Shorter payloads are all
    responses.  A null payload is empty; a null id or uri leaves its header out, and
    a null id is a response only where its group has no other.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("_id"), F.col(uri_col).alias("_uri"), payload.alias("_payload"),
        sha1_base32(payload.cast("binary")).alias("_digest"), F.octet_length(payload).cast("long").alias("_bytes"),
    )
    keyed = written(rows.drop("_payload"), "payload-digests")
    eligible = keyed.filter(F.col("_bytes") >= min_bytes)
    largest = eligible.groupBy("_digest").agg(F.max("_id").alias("_refers"))
    revisits = written(
        join_keys(eligible, largest, ["_digest"], "inner").filter(~F.col("_id").eqNullSafe(F.col("_refers"))), "revisits"
    )
    # A written table, so Spark knows its size when it chooses between broadcast and shuffle.
    responses = join_keys(rows, revisits.select("_id", "_digest").distinct(), ["_id", "_digest"], "left_anti")

    def record(kind: str, rows: DataFrame, body: Column, *more: Column) -> DataFrame:
        head = F.concat(
            F.lit(f"{MAGIC}WARC-Type: {kind}\r\n"),
            _header("WARC-Record-ID", F.concat(F.lit("<urn:sha1:"), "_digest", F.lit("/"), F.xxhash64("_id", "_uri"), F.lit(">"))),
            F.lit(f"WARC-Date: {DATE}\r\n"), _header("WARC-Target-URI", F.col("_uri")), _header("Page-ID", F.col("_id")),
            _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "_digest")), *more,
            F.lit("Content-Type: text/html; charset=utf-8\r\nContent-Length: "),
            F.octet_length(body).cast("string"), F.lit(END),
        )
        return rows.select(F.concat(head, body).alias("value"))

    both = record("response", responses, F.col("_payload")).unionByName(
        record(
            "revisit", revisits, F.lit(""),
            F.lit(f"WARC-Profile: {REVISIT}\r\n"), _header("Refers-To-Page-ID", F.col("_refers")),
            _header("Payload-Length", F.col("_bytes")),
        )
    )
    both.write.option("lineSep", END).text(path)


def _decoded(text: Column) -> Column:
    for c in "\r\n\t\x00%":
        text = F.replace(text, F.lit(f"%{ord(c):02X}"), F.lit(c))
    return text


def _value(head: Column, name: str) -> Column:
    found = F.regexp_extract(head, f"(?i)(?:^|\r\n){name}: ?([^\r]*)", 1)
    return F.when(found != "", found)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What follows each magic line, with its place; the first of a file is empty.

    ``seq`` numbers the pieces of a task in reading order, so (split, seq) is the
    order inside a file.
    """
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("seq"), F.col("value").cast("binary").alias("bytes"),
    )


def _candidates(spark: SparkSession, path: str) -> DataFrame:
    """One row per piece: header fields, payload digest where the payload is whole, byte offsets."""
    pieces = _pieces(spark, path)
    text = F.col("bytes").cast("string")
    head = F.when(F.contains(text, F.lit(END)), F.substring_index(text, END, 1))
    body_at = F.octet_length("head") + len(END)
    length = F.expr("try_cast(declared AS bigint)")
    parsed = (
        pieces.withColumn("head", head)
        .withColumn("declared", _value(F.col("head"), "Content-Length"))
        .withColumn("content", F.when(length >= 0, length))
        .withColumn("size", F.octet_length("bytes").cast("long"))
        .withColumn("whole", F.coalesce(body_at + F.col("content") <= F.col("size"), F.lit(False)))
        .withColumn("body", F.when(F.col("whole"), F.expr(f"substring(bytes, octet_length(head) + {len(END) + 1}, int(content))")))
    )
    fields = parsed.select(
        "file", "split", "seq", "size", "content", "whole", body_at.cast("long").alias("body_at"),
        sha1_base32(F.col("body")).alias("digest"),
        F.lower(_value(F.col("head"), "WARC-Type")).alias("type"), _decoded(_value(F.col("head"), "Page-ID")).alias("id"),
        _decoded(_value(F.col("head"), "WARC-Target-URI")).alias("uri"),
        _decoded(_value(F.col("head"), "Refers-To-Page-ID")).alias("refers_to"),
        _value(F.col("head"), "WARC-Payload-Digest").alias("declared_digest"),
        _value(F.col("head"), "Payload-Length").cast("long").alias("declared_bytes"),
    )
    found = written(fields, "warc-candidates")
    step = len(MAGIC)
    # Bytes before a split, then inside it: no window holds more than the pieces of one split.
    splits = found.groupBy("file", "split").agg(F.sum(F.col("size") + step).alias("_all"))
    before = splits.withColumn("_before", F.sum("_all").over(W.partitionBy("file").orderBy("split")) - F.col("_all"))
    inside = F.sum(F.col("size") + step).over(W.partitionBy("file", "split").orderBy("seq")) - F.col("size") - step
    placed = found.withColumn("_inside", inside).join(before.drop("_all"), ["file", "split"])
    start = F.col("_before") + F.col("_inside") - step
    return placed.select(
        *found.columns, start.alias("start"), (start + step + F.col("body_at") + F.col("content") + len(END)).alias("next")
    )


def _follow(start, to):
    """Index of each candidate's successor in its own split, or -1."""
    at = np.searchsorted(start, to)
    found = (at < len(start)) & (start[np.minimum(at, len(start) - 1)] == to)
    return np.where(found, at, -1)


def _exits(table: pa.Table) -> pa.Table:
    """Where the chain from each candidate of a split leaves the split: doubling inside the task."""
    table = table.sort_by("start")
    start, to = table.column("start").to_numpy(), table.column("next").to_numpy().copy()
    ahead = _follow(start, to)
    while (ahead >= 0).any():
        inside = ahead >= 0
        to[inside], ahead[inside] = to[ahead[inside]], ahead[ahead[inside]]
    return pa.table({"file": table.column("file"), "at": start, "to": to})


def _owners(table: pa.Table) -> pa.Table:
    """Marks what the reached entries of a split lead to, and gives each piece the last mark before it."""
    table = table.sort_by("start")
    start, to = table.column("start").to_numpy(), table.column("next").fill_null(-1).to_numpy()
    ahead, marked = _follow(start, to), table.column("entry").to_numpy(zero_copy_only=False).copy()
    for i in np.flatnonzero(marked):
        while (i := ahead[i]) >= 0 and not marked[i]:
            marked[i] = True
    last = np.maximum.accumulate(np.where(marked, np.arange(len(start)), -1))
    owner = np.where(last >= 0, start[last], -1)
    return pa.table({n: table.column(n) for n in ("file", "split", "seq", "start")} | {"owner": owner})


def _on_chain(candidates: DataFrame) -> DataFrame:
    """``(file, split, seq, start, owner)`` per piece; records are those that own themselves.

    Splits are first crossed inside tasks.  What is left is one pointer per way into
    a split, and the rounds of jumping double the reach of these.
    """
    known = candidates.filter("start >= 0 AND next IS NOT NULL")
    exits = written(
        known.select("file", "split", "start", "next").groupBy("file", "split").applyInArrow(
            _exits, "file string, at long, to long"
        ),
        "warc-exits",
    )
    entries = exits.select("file", F.col("to").alias("at")).distinct()
    pointers = written(
        exits.join(entries, ["file", "at"], "left_semi").unionByName(exits.filter("at = 0")), "warc-pointers"
    )
    reach = written(exits.filter("at = 0").select("file", "at"), "warc-reach")
    while not pointers.isEmpty():
        sent = reach.join(pointers, ["file", "at"]).select("file", F.col("to").alias("at"))
        reach = written(reach.unionByName(sent).distinct(), "warc-reach")
        ahead = pointers.select("file", F.col("at").alias("to"), F.col("to").alias("_far"))
        pointers = written(
            pointers.join(ahead, ["file", "to"]).select("file", "at", F.col("_far").alias("to")), "warc-pointers"
        )
    entry = reach.select("file", F.col("at").alias("start"), F.lit(True).alias("entry"))
    owned = written(
        candidates.filter("start >= 0").select("file", "split", "seq", "start", "next").join(entry, ["file", "start"], "left")
        .withColumn("entry", F.coalesce("entry", F.lit(False)))
        .groupBy("file", "split").applyInArrow(_owners, "file string, split long, seq long, start long, owner long"),
        "warc-owners",
    )
    # A record may begin splits earlier: one row per split carries the last owner along.
    last = owned.groupBy("file", "split").agg(F.max("owner").alias("_last")).withColumn(
        "_carried", F.max("_last").over(W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1))
    )
    return owned.join(last.drop("_last"), ["file", "split"]).select(
        "file", "split", "seq", "start",
        F.when(F.col("owner") >= 0, F.col("owner")).otherwise(F.coalesce("_carried", F.lit(-1))).alias("owner"),
    )


def _spanning_payloads(spark: SparkSession, path: str, records: DataFrame, chain: DataFrame) -> DataFrame:
    """``(file, start, payload)`` of records that cover several pieces, joined with the magic that parted them.

    The pieces of a record are at most as long as the record, so a group is one payload.
    """
    spans = records.filter("NOT whole").select("file", F.col("start").alias("owner"), "body_at", "content")
    places = written(chain.join(spans, ["file", "owner"]).withColumnRenamed("start", "piece"), "warc-spans")
    parts = (
        _pieces(spark, path).join(places, ["file", "split", "seq"])
        .groupBy("file", "owner", "body_at", "content")
        .agg(F.array_sort(F.collect_list(F.struct("piece", F.hex("bytes").alias("hexed")))).alias("parts"))
    )
    joined = F.array_join(F.transform("parts", lambda p: p["hexed"]), MAGIC.encode().hex())
    body = F.substring(joined, (2 * F.col("body_at") + 1).cast("int"), (2 * F.col("content")).cast("int"))
    return parts.select("file", F.col("owner").alias("start"), F.unhex(body).alias("payload"))


def read_records(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Records of all archives under ``path``, none of the look-alikes inside payloads.

    Columns: file, start, type, id, uri, refers_to, payload_bytes and payload_digest
    (of the full payload: counted and hashed for records that hold it, as declared
    for revisits), and on request payload (binary).  What follows a break of a
    file's chain is not reached and not returned.
    """
    candidates = written(_candidates(spark, path), "warc-offsets")
    chain = written(_on_chain(candidates), "warc-chain")
    records = candidates.join(chain.filter("start = owner").select("file", "split", "seq"), ["file", "split", "seq"])
    spanning = _spanning_payloads(spark, path, records, chain)
    spanning_digest = spanning.select("file", "start", sha1_base32(F.col("payload")).alias("_spanning"))
    revisit = F.col("type") == "revisit"
    out = records.join(spanning_digest, ["file", "start"], "left").select(
        "file", "split", "seq", "start", "type", "id", "uri", "refers_to",
        F.when(revisit, F.coalesce("declared_bytes", "content")).otherwise(F.col("content")).alias("payload_bytes"),
        F.when(revisit, F.regexp_replace("declared_digest", "^sha1:", ""))
        .otherwise(F.coalesce("digest", "_spanning")).alias("payload_digest"),
        "body_at", "content", "whole",
    )
    if with_payload:
        single = F.when(F.col("whole"), F.expr("substring(bytes, int(body_at) + 1, int(content))"))
        out = (
            out.join(_pieces(spark, path), ["file", "split", "seq"])
            .join(spanning.withColumnRenamed("payload", "_spanning"), ["file", "start"], "left")
            .withColumn("payload", F.coalesce(single, "_spanning"))
        )
    return out.drop("split", "seq", "body_at", "content", "whole", "bytes", "_spanning")


def archive_and_read(pages: DataFrame, path: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write all pages as archives and read the records back."""
    path = path or shared_dir(pages.sparkSession, "warc")
    write_archives(pages, path, min_bytes=min_bytes)
    return read_records(pages.sparkSession, path)
