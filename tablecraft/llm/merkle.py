"""A Merkle manifest of a dataset: one hash for all rows, one proof for each.

Every row is a leaf, every group (a language) a tree over its leaves in order of their
ids, and the subroots of the groups are the leaves of one more tree.  Trees are built
block by block.  A block is a run of nodes at an aligned place whose size is a power of
the arity, so it is a whole subtree.  It keeps each of its levels as one hex string: the
children of a parent are a fixed-width substring, hashed to give the next level, and
the siblings of a node are the substrings on either side of it.  The roots of the
blocks are the nodes of the next, much smaller table, and so on up to one root.

No row carries more than its own digests, no string is longer than a block, and a
group is never in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablecraft.plans.skew import join_keys
from tablecraft.plans.storage import written

#: Children of a node, and levels of a block.
ARITY, DEPTH = 2, 8
#: Hex digits of a hash.
WIDTH = 64
#: Rows of a sorted slice that gets its places at once.
PART_ROWS = 1_000_000

_PATH = "array<struct<left:string,right:string>>"


def leaf_of(fields: Sequence[Column]) -> Column:
    """Hash of a row: each value as '-' for null, else its UTF-8 length, a colon and itself."""
    shown = []
    for c in fields:
        text = c.cast("string")
        shown.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*shown).cast("binary"), 256)


def _hash(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def positions(rows: DataFrame, by: str, order: Sequence[str]) -> DataFrame:
    """Adds ``_at``, the place of each row among those of its ``by`` from 0, and ``_all``, their number.

    The rows are sorted over all tasks once and numbered where they lie; what a task needs
    besides is how many rows of the group the tasks before it hold.
    """
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // PART_ROWS))
    keys = [F.col(by).asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order)]
    # The number of a sorted row: its task in the upper bits, its place in the task below.
    placed = written(
        rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("_number", F.monotonically_increasing_id()),
        "merkle-sorted",
    ).withColumn("_part", F.shiftright("_number", 33))
    # One row per task and group in it.
    found = placed.groupBy(by, "_part").agg(F.min("_number").alias("_first"), F.count("*").alias("_n"))
    group = W.partitionBy(by)
    found = found.select(
        by, "_part", (F.sum("_n").over(group.orderBy("_part")) - F.col("_n") - F.col("_first")).alias("_shift"),
        F.sum("_n").over(group).alias("_all"),
    )
    return join_keys(placed, found, [by, "_part"], "inner").select(
        *rows.columns, (F.col("_number") + F.col("_shift")).alias("_at"), "_all"
    )


def _levels(level: Column, height: Column, arity: int) -> Column:
    """All levels of a block from its nodes up, each one hex string."""
    wide = WIDTH * arity

    def above(levels, _):
        below = F.element_at(levels, -1)
        runs = F.sequence(F.lit(0), (F.ceil(F.length(below) / wide) - 1).cast("int"))
        parents = F.transform(runs, lambda i: _hash(F.substr(below, i * wide + 1, F.lit(wide))))
        return F.concat(levels, F.array(F.array_join(parents, "")))

    steps = F.when(height > 0, F.sequence(F.lit(1), height)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, F.array(level), above)


def _path(levels: Column, at: Column, arity: int) -> Column:
    """Siblings of the node ``at`` on each level but the last: what lies left of it in its run, and right of it."""

    def sides(level, k):
        place = F.floor(at / F.pow(F.lit(float(arity)), k)).cast("int")
        start = place - place % arity
        part = lambda a, b: F.substr(level, a * WIDTH + 1, (b - a) * WIDTH)
        return F.struct(part(start, place).alias("left"), part(place + 1, start + arity).alias("right"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), sides)


def climb(nodes: DataFrame, by: str, payload: Sequence[str] = (), arity: int = ARITY, depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """Trees over ``nodes(by, node, _at, _all, *payload)``.

    Gives ``(by, root)`` and, for every node, ``(by, _at, node, *payload, path)``: its
    siblings from its own level to the root.  Each round makes a table of one row per
    block; the number of rounds is the logarithm of the largest group to the block size.
    """
    size = arity**depth
    many = F.col("_all") > size
    packed = nodes.withColumn("_block", F.floor(F.col("_at") / size)).groupBy(by, "_block", "_all").agg(
        F.array_sort(F.collect_list(F.struct("_at", "node", *payload))).alias("_nodes")
    )
    # Blocks of a larger group reach their full height even where the last one holds fewer nodes.
    low = F.size(F.filter(F.sequence(F.lit(0), F.lit(depth)), lambda k: F.pow(F.lit(float(arity)), k) < F.col("_all")))
    level = F.array_join(F.col("_nodes.node"), "")
    blocks = written(packed.withColumn("_levels", _levels(level, F.when(many, depth).otherwise(low), arity)), "merkle-blocks")
    tops = blocks.select(by, "_block", F.element_at("_levels", -1).alias("node"), F.ceil(F.col("_all") / size).cast("long").alias("_all"))
    roots = tops.filter("_all = 1").select(by, F.col("node").alias("root"))
    higher = tops.filter("_all > 1").withColumnRenamed("_block", "_at")
    none = F.array().cast(_PATH)
    if higher.isEmpty():
        out = blocks.withColumn("_upper", none)
    else:
        above, paths = climb(higher, by, (), arity, depth)
        roots = roots.unionByName(above)
        upper = paths.select(by, F.col("_at").alias("_block"), F.col("path").alias("_upper"))
        out = join_keys(blocks, upper, [by, "_block"]).withColumn("_upper", F.coalesce("_upper", none))
    inner = F.transform("_nodes", lambda x: F.struct(
        x["_at"].alias("_at"), x["node"].alias("node"), *[x[c].alias(c) for c in payload],
        F.concat(_path(F.col("_levels"), (x["_at"] % size).cast("int"), arity), F.col("_upper")).alias("path"),
    ))
    return roots, out.select(by, F.inline(inner))


def folded(node: Column, path: Column) -> Column:
    """The root that a node and its siblings give."""
    return F.aggregate(path, node, lambda h, s: _hash(s["left"], h, s["right"]))


def manifest(
    rows: DataFrame, by: str, id_col: str, fields: Sequence[str], tampered: dict[str, Column] | None = None,
    arity: int = ARITY, depth: int = DEPTH,
) -> DataFrame:
    """``(id, by, leaf, subroot, root, path, folded_root, verified)``, one row per row.

    ``fields`` are hashed in their order.  ``tampered`` gives columns that replace fields
    before a row is verified against its own siblings, as a reader of changed rows would.
    A null group is a group, first among them; null ids are first in their group; rows
    of one id are ordered by their leaves.  An empty table has no rows.
    """
    value = {c: F.col(c) for c in fields}
    leaves = rows.select(
        F.col(by).alias("_group"), F.col(id_col).alias("_id"), leaf_of(list(value.values())).alias("node"),
        leaf_of(list((value | (tampered or {})).values())).alias("_now"),
    )
    subroots, paths = climb(positions(written(leaves, "merkle-leaves"), "_group", ["_id", "node"]), "_group", ["_id", "_now"], arity, depth)
    top = positions(written(subroots.select(F.lit(0).alias("_top"), "_group", F.col("root").alias("node")), "merkle-subroots"), "_top", ["_group"])
    roots, above = climb(top, "_top", ["_group"], arity, depth)
    above = join_keys(above, roots, ["_top"], "inner").select("_group", F.col("node").alias("subroot"), F.col("path").alias("_above"), "root")
    # One row per group.
    whole = join_keys(paths, written(above, "merkle-groups"), ["_group"], "inner").withColumn("_path", F.concat("path", "_above"))
    return whole.select(
        F.col("_id").alias(id_col), F.col("_group").alias(by), F.col("node").alias("leaf"), "subroot", "root",
        F.col("_path").alias("path"), folded(F.col("_now"), F.col("_path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def proof(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)
