"""Jobs on tables: gates, publishing, incremental load, upsert, quarantine, clean-up."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.plans.skew import MAX_ROWS, Limit, over_group, with_scalars
from tablecraft.plans.storage import child_names, modified_at, path_exists, remove_path, shared_dir
from tablecraft.sources.tables import MAX_RECORDS_PER_FILE, folder_values


# Messages of the quality gates.
EMPTY_TABLE = "CRITICAL: Staging table is empty. Aborting load."
TOO_MANY_NULLS = "QUALITY FAIL: Null {column} rate exceeds {rate:.0%}. Aborting."
ZERO_TOTAL = "LOGIC FAIL: Total {column} is 0. Suspicious data."


class GateFailed(RuntimeError):
    """A load was stopped before it reached production."""


# -- publish by pointer ------------------------------------------------------

_POINTER = "seq long, version string, published_at timestamp"


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _pointers(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/pointer"
    if not path_exists(spark, path):
        return spark.createDataFrame([], _POINTER)
    return spark.read.schema(_POINTER).parquet(path)


def _latest(pointers: DataFrame):
    """The last publication: one row, whatever the length of the history."""
    return pointers.agg(F.max("seq").alias("seq"), F.max_by("version", "seq").alias("version")).first()


def _point(spark: SparkSession, root: str, version: str) -> None:
    last = _latest(_pointers(spark, root)).seq
    row = [(0 if last is None else last + 1, version, _now())]
    spark.createDataFrame(row, _POINTER).coalesce(1).write.mode("append").parquet(f"{root}/pointer")


def publish(df: DataFrame, root: str, min_rows: int = 1, version: str | None = None) -> str:
    """Write a new version, check it, and only then make it the current one.

    Readers see the old version until the pointer moves; old versions stay for
    :func:`rollback` until :func:`clear_versions` removes them.  A named version may be written again, which makes a
    repeated job safe.
    """
    spark = df.sparkSession
    version = version or uuid.uuid4().hex[:12]
    path = f"{root}/versions/{version}"
    df.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(path)
    rows = spark.read.schema(df.schema).parquet(path).count()
    if rows < min_rows:
        raise GateFailed(f"{rows} rows staged, at least {min_rows} needed")
    _point(spark, root, version)
    return version


def current_version(spark: SparkSession, root: str) -> str | None:
    return _latest(_pointers(spark, root)).version


def current(spark: SparkSession, root: str, schema: T.StructType | None = None, view: str | None = None) -> DataFrame:
    """The published table, also as a view if a name is given."""
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing published under {root}")
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(f"{root}/versions/{version}")
    if view:
        df.createOrReplaceTempView(view)
    return df


def rollback(spark: SparkSession, root: str) -> str:
    """Point back to the version before the current one."""
    pointers = _pointers(spark, root)
    now = _latest(pointers).version
    earlier = _latest(pointers.filter(F.col("version") != F.lit(now))).version if now is not None else None
    if earlier is None:
        raise GateFailed("no earlier version to go back to")
    _point(spark, root, earlier)
    return earlier


def clear_versions(
    spark: SparkSession, root: str, keep: int = 2, grace: dt.timedelta = dt.timedelta(days=1), files: int = 16
) -> list[str]:
    """Remove versions that no one needs and merge the pointer log; gives the removed versions.

    Kept are the last ``keep`` different versions and every version that was current
    within ``grace``: a reader that resolved one just before it was replaced has that
    long to finish.  A folder that changed within ``grace`` stays too, since its
    publication may be under way; older ones that were never published are refused loads.
    Pointers that are still of use are written again as one file once there are more
    than ``files``; the files it stands for go when that file is older than ``grace``.
    """
    if keep < 2 and grace <= dt.timedelta(0):
        raise ValueError("keep two versions or some time, or nothing is left to go back to")
    limit = _now() - grace
    pointers = _pointers(spark, root)
    recent = pointers.filter(F.col("published_at") >= F.lit(limit))
    before = _latest(pointers.filter(F.col("published_at") < F.lit(limit))).seq
    last = pointers.groupBy("version").agg(F.max("seq").alias("seq")).orderBy(F.desc("seq")).limit(max(keep, 1))
    # bounded by ``keep`` and the publications of one ``grace``
    seqs = {r.seq for r in recent.select("seq").union(last.select("seq")).collect()} | ({before} - {None})
    living = pointers.filter(F.col("seq").isin(sorted(seqs))).distinct().collect() if seqs else []
    gone = []
    for version in set(child_names(spark, f"{root}/versions")) - {r.version for r in living}:
        if modified_at(spark, f"{root}/versions/{version}") <= limit.timestamp():
            remove_path(spark, f"{root}/versions/{version}")
            gone.append(version)
    if seqs:
        _merge_pointers(spark, root, living, limit, files)
    return sorted(gone)


def _merge_pointers(spark: SparkSession, root: str, living: list, limit: dt.datetime, files: int) -> None:
    held = _pointers(spark, root).groupBy(F.col("_metadata.file_name").alias("name")).agg(
        F.max("_metadata.file_modification_time").alias("at"), F.max("seq").alias("seq"), F.count(F.lit(1)).alias("n")
    ).withColumn("old", F.col("at") <= F.lit(limit)).collect()
    # A publication is a file of one row; a file of more stands for all up to its last.
    merged = [r for r in held if r.n > 1 and r.old]
    whole = max(merged, key=lambda r: (r.seq, r.at), default=None)
    left = len(held)
    for r in held:
        if whole and r.name != whole.name and r.seq <= whole.seq and r.at <= whole.at:
            remove_path(spark, f"{root}/pointer/{r.name}")
            left -= 1
    young = any(r.n > 1 and not r.old for r in held)
    if left > files and not young and len(living) > 1:
        spark.createDataFrame(living, _POINTER).coalesce(1).write.mode("append").parquet(f"{root}/pointer")


# -- job log -----------------------------------------------------------------

_HISTORY = (
    "run_id string, job_name string, status string, start_time timestamp, end_time timestamp, rows_affected long, step int"
)


def run_job(spark: SparkSession, name: str, build: Callable[[], DataFrame], target: str, history: str) -> str:
    """Run a load and log it; every row carries the id of the run that wrote it.

    The row count is observed while the rows are written, so nothing is read twice.
    """
    run_id, start = uuid.uuid4().hex, _now()

    def log(status: str, end=None, rows=None, step=0):
        spark.createDataFrame([(run_id, name, status, start, end, rows, step)], _HISTORY).coalesce(1).write.mode(
            "append"
        ).parquet(history)

    log("RUNNING")
    seen = Observation()
    try:
        stamped = build().withColumns({"etl_run_id": F.lit(run_id), "etl_loaded_at": F.lit(start)})
        stamped.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(target)
    except Exception:
        log("FAILED", _now(), None, 1)
        raise
    log("SUCCESS", _now(), seen.get["rows"], 1)
    return run_id


def job_history(spark: SparkSession, history: str) -> DataFrame:
    """Latest state of each run."""
    log = spark.read.schema(_HISTORY).parquet(history)
    last = log.groupBy("run_id").agg(F.max_by(F.struct("job_name", "status", "start_time", "end_time", "rows_affected"), "step").alias("s"))
    return last.select("run_id", "s.*")


# -- quality gates -----------------------------------------------------------


def quality_metrics(df: DataFrame, known: Sequence[str], totals: Sequence[str]) -> DataFrame:
    """Row count, NULL counts and totals in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in known],
        *[F.sum(c).alias(f"total_{c}") for c in totals],
    )


def quality_gate(df: DataFrame, known: Sequence[str] = (), totals: Sequence[str] = (), max_null_rate: float = 0.01) -> dict:
    """Raise on an empty table, too many NULLs, or a zero total; else the metrics."""
    found = quality_metrics(df, known, totals).first().asDict()
    if found["total_rows"] == 0:
        raise GateFailed(EMPTY_TABLE)
    for c in known:
        if found[f"null_{c}"] / found["total_rows"] > max_null_rate:
            raise GateFailed(TOO_MANY_NULLS.format(column=c, rate=max_null_rate))
    for c in totals:
        if found[f"total_{c}"] == 0:
            raise GateFailed(ZERO_TOTAL.format(column=c))
    return found


# -- dependencies and days ---------------------------------------------------


def has_rows(df: DataFrame, cond: Column) -> bool:
    return not df.filter(cond).limit(1).isEmpty()


def run_if_present(source: DataFrame, cond: Column, job: Callable[[], None]) -> bool:
    """Run a job only when its source has rows; says whether it ran."""
    if not has_rows(source, cond):
        return False
    job()
    return True


def replace_day(df: DataFrame, path: str, by: str) -> None:
    """Overwrite only the partitions the rows fall in; other days stay."""
    df.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "maxRecordsPerFile", MAX_RECORDS_PER_FILE
    ).partitionBy(by).parquet(path)


# -- incremental load and upsert ---------------------------------------------

_MARKS = "table_name string, last_loaded_at timestamp_ntz, seq long"


def load_mark(spark: SparkSession, path: str, table: str):
    """Last mark of a table, None before the first load."""
    if not path_exists(spark, path):
        return None
    marks = spark.read.schema(_MARKS).parquet(path).filter(F.col("table_name") == table)
    return marks.agg(F.max_by("last_loaded_at", "seq")).first()[0]


def save_mark(spark: SparkSession, path: str, table: str, mark) -> None:
    seq = 0
    if path_exists(spark, path):
        seq = (spark.read.schema(_MARKS).parquet(path).agg(F.max("seq")).first()[0] or 0) + 1
    spark.createDataFrame([(table, mark, seq)], _MARKS).coalesce(1).write.mode("append").parquet(path)


def incremental(source: DataFrame, ts: str, mark) -> tuple[DataFrame, object]:
    """Rows at or after the mark, and the mark to store once they are loaded.

    The new mark is the latest time seen, not the clock, so rows that were still
    under way are picked up by the next run.  Rows at the mark itself come again,
    since others of that time may have arrived later: load them with an upsert.
    """
    fresh = source if mark is None else source.filter(F.col(ts) >= F.lit(mark))
    latest = fresh.agg(F.max(ts)).first()[0]
    return fresh, latest if latest is not None else mark


def latest_per_key(source: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """One source row per key, the newest; a mergeable aggregate, not a sort."""
    rest = [c for c in source.columns if c not in keys]
    best = source.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in newest])).alias("_s")
    )
    return best.select(*keys, *[F.col(f"_s.{c}").alias(c) for c in rest])


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str], newest: Sequence[str] = (),
    if_newer: str | None = None,
) -> DataFrame:
    """Matched rows take the source's ``update`` columns, unmatched rows are added.

    A full outer join on the keys, in which NULL equals NULL; a repeated run gives
    the same table.  With ``newest``, only the newest source row of each key is used; with ``if_newer``,
    a matched row is left alone when its own value of that column is later.
    """
    if newest:
        source = latest_per_key(source, keys, newest)
    old = target.withColumn("_old", F.lit(True))
    new = source.withColumnsRenamed({c: f"_n_{c}" for c in source.columns}).withColumn("_new", F.lit(True))
    both = old.join(new, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_n_{k}")) for k in keys]), "full_outer")

    take = F.col("_new")
    if if_newer:
        take = take & ~F.coalesce(F.col(if_newer) > F.col(f"_n_{if_newer}"), F.lit(False))

    def value(c: str) -> Column:
        if c in keys:
            return F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_n_{c}")).alias(c)
        if c not in source.columns:
            return F.col(c)
        if c in update:
            return F.when(take, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c)
        return F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_n_{c}")).alias(c)

    return both.select(*[value(c) for c in target.columns])


def upsert_partitions(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], update: Sequence[str], by: str,
    newest: Sequence[str] = (),
) -> None:
    """Upsert into a partitioned table, rewriting only the partitions the source touches.

    ``by`` must be one of the keys, so a row never moves between partitions.  Rows
    without a partition value are in the NULL folder, which is touched like any other.
    """
    if by not in keys:
        raise ValueError(f"{by} must be a key column")
    # one value per touched folder
    touched = [r[0] for r in source.select(by).distinct().collect()]
    found = spark.read.parquet(path).schema
    # Read with the source's type of the folder value, so that the filter prunes folders.
    typed = T.StructType([T.StructField(f.name, source.schema[by].dataType if f.name == by else f.dataType) for f in found])
    known = [v for v in touched if v is not None]
    hit = F.col(by).isin(known) if known else F.lit(False)
    if len(known) < len(touched):
        hit = hit | F.col(by).isNull()
    part = spark.read.schema(typed).parquet(path).filter(hit)
    staged = shared_dir(spark, "upsert")
    merged = upsert(part, source, keys, update, newest)
    merged.write.parquet(staged)
    replace_day(spark.read.schema(merged.schema).parquet(staged), path, by)


# -- validation and quarantine -----------------------------------------------


def split_valid(
    df: DataFrame, checks: Sequence[tuple[str, Column]], typed: dict[str, Column], reason: str = "error_reason"
) -> tuple[DataFrame, DataFrame]:
    """Good rows with typed columns, and bad rows with their first failed check."""
    why = None
    for text, bad in checks:
        why = F.when(bad, text) if why is None else why.when(bad, text)
    marked = df.withColumn(reason, why)
    good = marked.filter(F.col(reason).isNull()).select(*[c.alias(n) for n, c in typed.items()])
    return good, marked.filter(F.col(reason).isNotNull())


# -- delete and update -------------------------------------------------------


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """Rows left after DELETE; an unknown condition keeps the row."""
    return df.filter(~F.coalesce(cond, F.lit(False)))


def purge_partitions(spark: SparkSession, path: str, by: str, before) -> int:
    """Drop the partition folders below a value one by one; how many went.

    Values are compared in the type that Spark reads the folders with, not as text.
    The NULL folder is below nothing and stays.
    """
    kind = spark.read.parquet(path).schema[by].dataType
    gone = 0
    values = folder_values(spark, path, by, kind)
    for folder, is_below in values.select("folder", (F.col("value") < F.lit(before).cast(kind)).alias("below")).collect():
        if is_below:
            remove_path(spark, f"{path}/{folder}")
            gone += 1
    return gone


def update_where(df: DataFrame, cond: Column, sets: dict[str, Column]) -> DataFrame:
    hit = F.coalesce(cond, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in sets.items()})


def cascade_delete(child: DataFrame, key: str, deleted: DataFrame, deleted_key: str) -> DataFrame:
    """Child rows left after their parents are deleted."""
    gone = deleted.select(F.col(deleted_key).alias(key)).distinct()
    return child.join(gone, key, "left_anti").select(*child.columns)


def cascade_set_null(child: DataFrame, key: str, deleted: DataFrame, deleted_key: str) -> DataFrame:
    """Child rows whose parent is deleted lose the key instead."""
    gone = deleted.select(F.col(deleted_key).alias(key)).distinct().withColumn("_gone", F.lit(True))
    marked = child.join(gone, key, "left")
    return marked.withColumn(key, F.when(F.col("_gone").isNull(), F.col(key))).select(*child.columns)


def stamp_modified(
    old: DataFrame, new: DataFrame, keys: Sequence[str], as_of: Column, stamp: str = "last_modified"
) -> DataFrame:
    """New rows with the time of change where any column differs from the old row."""
    cols = [c for c in new.columns if c not in keys and c != stamp]
    before = old.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in cols], F.col(stamp).alias("_b_stamp"), F.lit(True).alias("_there"))
    both = new.drop(stamp).join(before, list(keys), "left")
    same = F.coalesce(F.col("_there"), F.lit(False))
    for c in cols:
        same = same & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    return both.select(*keys, *cols, F.when(same, F.col("_b_stamp")).otherwise(as_of).alias(stamp))


# -- key checks --------------------------------------------------------------


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break a primary key: repeated, or with a NULL part."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    bad = F.col("copies") > 1
    for k in keys:
        bad = bad | F.col(k).isNull()
    return counts.filter(bad)


def orphan_rows(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows that point to no parent; a NULL key points nowhere and is allowed."""
    parents = parent.select(F.col(parent_key).alias(key))
    return child.filter(F.col(key).isNotNull()).join(parents, key, "left_anti").select(*child.columns)


# -- reuse, fills and reports ------------------------------------------------


def reusable(df: DataFrame, name: str, mode: str = "view") -> DataFrame:
    """A named result for several queries.

    ``view`` is recomputed per query, ``cached`` is kept by the executors,
    ``lazy_cached`` on first use, ``materialised`` is written to the shared folder.
    """
    spark = df.sparkSession
    if mode == "materialised":
        path = shared_dir(spark, name)
        df.write.parquet(path)
        df = spark.read.schema(df.schema).parquet(path)
    df.createOrReplaceTempView(name)
    if mode == "cached":
        spark.sql(f"CACHE TABLE {name}")
    elif mode == "lazy_cached":
        spark.sql(f"CACHE LAZY TABLE {name}")
    elif mode not in ("view", "materialised"):
        raise ValueError(f"unknown mode {mode}")
    return spark.table(name)


def release(spark: SparkSession, name: str) -> None:
    """Forget a cached result; the view itself stays."""
    spark.sql(f"UNCACHE TABLE IF EXISTS {name}")


def fill_from_group(
    df: DataFrame, key: str, col: str, keep_null_keys: bool = False, max_rows: Limit = MAX_ROWS
) -> DataFrame:
    """Give all rows of a key the largest known value of ``col``.

    Rows with a NULL key have no group; they are dropped as in an inner join, or
    kept with their own value.
    """
    known = over_group(df.filter(F.col(key).isNotNull()), [key], {"_known": F.max(col)}, max_rows)
    filled = known.withColumn(col, F.col("_known")).drop("_known")
    return filled.unionByName(df.filter(F.col(key).isNull())) if keep_null_keys else filled


def advisor_list(
    dept, students: DataFrame, student_dept: str, pairs: DataFrame, label: str = "Department"
) -> DataFrame:
    """Rows of one department, or one row that says why there are none.

    ``pairs`` has a ``dept`` column and the columns to list.
    """
    shown = [c for c in pairs.columns if c != "dept"]
    rows = pairs.filter(F.col("dept") == dept)
    there = students.filter(F.col(student_dept) == dept).limit(1).agg(F.count(F.lit(1)).alias("_people"))
    listed = with_scalars(rows, there).filter("_people > 0").select(*shown, F.lit(None).cast("string").alias("status"))
    spark = pairs.sparkSession
    notice = with_scalars(
        with_scalars(spark.range(1).select(F.lit(1).alias("_one")), there), rows.limit(1).agg(F.count(F.lit(1)).alias("_rows"))
    ).withColumn(
        "status",
        F.when(F.col("_people") == 0, f"{label} {dept} does not exist").when(F.col("_rows") == 0, f"{label} {dept} has no instructors"),
    )
    kinds = {f.name: f.dataType for f in pairs.schema.fields}
    empty = [F.lit(None).cast(kinds[c]).alias(c) for c in shown]
    return listed.unionByName(notice.filter("status IS NOT NULL").select(*empty, "status"))


