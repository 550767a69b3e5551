"""A keyed table that takes small upserts: base files, delta files, merged when read.

An upsert writes only its own rows, one file set per batch, dealt into a fixed number
of buckets by key.  Reading groups base and delta rows by key and keeps the newest.
Compaction rewrites a bucket, and only one that holds enough delta rows.  What is
where stands in a log of one small entry per action; an entry is written last, so an
action that failed half way is not seen and may be repeated under the same name.  There
is one writer at a time, and any number of readers.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.operators.etl import latest_per_key
from tablecraft.plans.storage import child_names, path_exists, remove_path

BUCKETS = 64
#: A bucket is rewritten when its deltas hold this share of its base rows, or are this many.
SHARE, MANY = 0.25, 50

#: One row per bucket of an action; a base covers what was logged up to ``upto``.
_LOG = "seq long, kind string, name string, bucket int, rows long, upto long"
_BUCKET, _SEQ = "_bucket", "_seq"


@dataclass(frozen=True)
class DeltaTable:
    """Where a table lies and how its rows meet.

    A later row of a key replaces the ``update`` columns unless the stored row has a
    later ``newest`` value; a NULL there is earlier than any other.  Columns that are
    neither keys nor in ``update`` keep what the key's first row brought.  NULL keys
    are keys like others.
    """

    spark: SparkSession
    root: str
    schema: T.StructType
    keys: tuple[str, ...]
    update: tuple[str, ...]
    newest: str
    buckets: int = BUCKETS

    def __post_init__(self):
        if self.newest not in self.update:
            raise ValueError(f"{self.newest} must be one of the updated columns")

    # -- log ------------------------------------------------------------------

    def _log(self) -> list:
        """All entries, at most one row per bucket and living action; vacuum keeps them few."""
        path = f"{self.root}/log"
        if not path_exists(self.spark, path):
            return []
        return self.spark.read.schema(_LOG).option("basePath", path).option("recursiveFileLookup", "true").parquet(path).collect()

    def _enter(self, seq: int, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, _LOG).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/log/{seq:012d}")

    @staticmethod
    def _living(log: list) -> tuple[dict, dict]:
        """Base entry of each bucket, and its delta entries that the base does not cover."""
        base: dict[int, object] = {}
        for r in log:
            if r.kind == "base" and (r.bucket not in base or r.seq > base[r.bucket].seq):
                base[r.bucket] = r
        deltas: dict[int, list] = {}
        for r in sorted(log, key=lambda r: r.seq):
            if r.kind == "delta" and (r.bucket not in base or r.seq > base[r.bucket].upto):
                deltas.setdefault(r.bucket, []).append(r)
        return base, deltas

    # -- rows -----------------------------------------------------------------

    def _place(self, df: DataFrame) -> DataFrame:
        return df.withColumn(_BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(_SEQ, T.LongType()), T.StructField("_first", T.LongType())])

    def _files(self, entries: list) -> DataFrame:
        """The rows of log entries: only the folders of their buckets are read."""
        paths = [f"{self.root}/{r.kind}/{r.name}/{_BUCKET}={r.bucket}" for r in entries]
        if not paths:
            return self.spark.createDataFrame([], self._stored())
        return self.spark.read.schema(self._stored()).parquet(*paths)

    def _merged(self, rows: DataFrame) -> DataFrame:
        """One row per key; a mergeable aggregate. ``_seq`` is of the row that won, ``_first`` of the first one."""
        kept = [c for c in self.schema.names if c not in self.keys and c not in self.update]
        aggs = [F.max_by(F.struct(*self.update, _SEQ), F.struct(self.newest, _SEQ)).alias("_u"), F.min("_first").alias("_first")]
        if kept:
            aggs.append(F.min_by(F.struct(*kept), "_first").alias("_k"))
        best = rows.groupBy(*self.keys).agg(*aggs)
        at = lambda c: F.col(c) if c in self.keys else F.col(f"_u.{c}" if c in self.update else f"_k.{c}").alias(c)
        return best.select(*[at(c) for c in self.schema.names], F.col(f"_u.{_SEQ}").alias(_SEQ), "_first")

    def _write(self, rows: DataFrame, kind: str, name: str) -> dict[int, int]:
        """Write rows by bucket, one task per bucket; rows written per bucket."""
        path = f"{self.root}/{kind}/{name}"
        self._place(rows).repartition(_BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(path)
        if not any(n.startswith(_BUCKET) for n in child_names(self.spark, path)):
            return {}
        found = self.spark.read.schema(T.StructType([*self._stored().fields, T.StructField(_BUCKET, T.IntegerType())])).parquet(path)
        return {r[0]: r[1] for r in found.groupBy(_BUCKET).agg(F.count("*")).collect()}

    # -- actions --------------------------------------------------------------

    def upsert(self, batch: DataFrame, name: str | None = None) -> None:
        """Add a batch.  A ``name`` that is in the log already changes nothing, so a batch may be run again."""
        log = self._log()
        name = name or uuid.uuid4().hex[:12]
        if any(r.kind == "delta" and r.name == name for r in log):
            return
        seq = max((r.seq for r in log), default=0) + 1
        fresh = latest_per_key(batch.select(*self.schema.names), self.keys, [self.newest]).select(*self.schema.names)
        rows = self._write(fresh.withColumns({_SEQ: F.lit(seq).cast("long"), "_first": F.lit(seq).cast("long")}), "delta", name)
        # An empty batch is logged too: it has been seen.
        self._enter(seq, [(seq, "delta", name, b, n, None) for b, n in sorted(rows.items())] or [(seq, "delta", name, -1, 0, None)])

    def read(self) -> DataFrame:
        """The table as it is now; buckets without deltas are read as they lie."""
        base, deltas = self._living(self._log())
        deltas.pop(-1, None)
        whole = self._files([r for b, r in base.items() if b not in deltas])
        mixed = self._files([r for b, r in base.items() if b in deltas] + [r for rs in deltas.values() for r in rs])
        return whole.select(*self.schema.names).unionByName(self._merged(mixed).select(*self.schema.names))

    def due(self, share: float = SHARE, many: int = MANY) -> list[int]:
        """Buckets whose deltas are large or many beside their base."""
        base, deltas = self._living(self._log())
        return sorted(
            b for b, rs in deltas.items()
            if b >= 0 and (len(rs) >= many or sum(r.rows for r in rs) >= share * (base[b].rows if b in base else 0))
        )

    def compact(self, share: float = SHARE, many: int = MANY) -> list[int]:
        """Rewrite the buckets that are due, each into one base without deltas; gives their numbers."""
        buckets = self.due(share, many)
        if buckets:
            log = self._log()
            base, deltas = self._living(log)
            upto = max(r.seq for r in log)
            name = f"{upto + 1:012d}-{uuid.uuid4().hex[:8]}"
            rows = self._write(self._merged(self._files([r for b in buckets for r in [*([base[b]] if b in base else []), *deltas[b]]])), "base", name)
            self._enter(upto + 1, [(upto + 1, "base", name, b, rows[b], upto) for b in buckets])
        return buckets

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove what no reader needs who began after the last ``keep`` compactions; gives the removed folders.

        Log entries that only name removed files go as well, except the last entry of each
        feed (the part of a name before its last '-'), which tells a repeated batch from a new one.
        """
        log = self._log()
        starts = sorted({r.seq for r in log if r.kind == "base"})
        if len(starts) <= keep:
            return []
        # As a reader sees it who began just before the kept compactions, or at any time since.
        times = [starts[-keep] - 1, *starts[-keep:], max(r.seq for r in log)] if keep else [max(r.seq for r in log)]
        needed = set()
        for now in times:
            base, deltas = self._living([r for r in log if r.seq <= now])
            needed |= {(r.kind, r.name) for r in [*base.values(), *(r for rs in deltas.values() for r in rs)]}
        last: dict[str, object] = {}
        for r in sorted(log, key=lambda r: r.seq):
            if r.kind == "delta":
                last[r.name.rpartition("-")[0] or r.name] = r
        gone = []
        for seq, kind, name in sorted({(r.seq, r.kind, r.name) for r in log}):
            if (kind, name) in needed:
                continue
            if path_exists(self.spark, f"{self.root}/{kind}/{name}"):
                remove_path(self.spark, f"{self.root}/{kind}/{name}")
                gone.append(f"{kind}/{name}")
            if not any(r.seq == seq for r in last.values()):
                remove_path(self.spark, f"{self.root}/log/{seq:012d}")
        return gone
