"""Trees, combinations and paths by repeated joins.

Each round joins what the round before found and is written to the shared folder,
so the plan of a round never contains the rounds before and a lost executor costs
one round at most.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.plans.ordered import order_of, ranked
from tablecraft.plans.storage import checkpointed, shared_dir, written


class TooLarge(ValueError):
    """The result would pass the stated limit."""


def _rounds(frontier: DataFrame, step, max_rounds: int | None) -> DataFrame:
    """All rows of ``frontier`` and of the rounds that follow until one is empty.

    Every round is written to its own folder and read back, and the result is
    one scan over all of them.
    """
    spark, schema = frontier.sparkSession, frontier.schema
    root = shared_dir(spark, "rounds")
    for number in count() if max_rounds is None else range(max_rounds + 1):
        path = f"{root}/round={number}"
        frontier.write.parquet(path)
        done = spark.read.schema(schema).parquet(path)
        if done.isEmpty():
            return spark.read.schema(schema).option("basePath", root).parquet(root).select(*schema.names)
        frontier = step(done)
    raise TooLarge(f"more than {max_rounds} levels")


def _one_parent(rows: DataFrame, node: str) -> bool:
    """Whether each node has one row."""
    repeated = rows.filter(F.col(node).isNotNull()).groupBy(node).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return repeated.isEmpty()


def _climbed(links: DataFrame) -> DataFrame:
    """``(_node, _steps)`` of the nodes whose chain of parents ends at a top.

    ``links(_node, _up, _steps, _top)`` has one row per node: a top has no ``_up`` and
    ``_top`` set, an ``_up`` without a row ends a chain nowhere.  A round lets every node
    take over the pointer of the node it points to, so the reach doubles: a chain of n
    takes log2(n) rounds.  A pointer that outlives as many rounds as all nodes in one chain
    would take runs in a cycle.
    """
    links = written(links, "links")
    nodes = links.count()
    for _ in range(nodes.bit_length() + 1):
        # ends stay as they are; only the nodes still on their way are joined
        moving = links.filter("_up IS NOT NULL")
        if moving.isEmpty():
            break
        ahead = links.select(
            F.col("_node").alias("_at"), F.col("_up").alias("_far"), F.col("_steps").alias("_more"), F.col("_top").alias("_end")
        )
        jumped = moving.join(ahead, F.col("_up") == F.col("_at"), "left").select(
            "_node", F.col("_far").alias("_up"), (F.col("_steps") + F.coalesce("_more", F.lit(0))).alias("_steps"),
            F.coalesce("_end", F.lit(False)).alias("_top"),
        )
        links = written(links.filter("_up IS NULL").unionByName(jumped), "links")
    return links.filter("_top AND _up IS NULL").select("_node", "_steps")


def _paths(links: DataFrame, depth: int) -> DataFrame:
    """``(_node, _path)`` of ``links(_node, _up)`` whose chains all end at a row without ``_up``, at most ``depth`` links on.

    The path of 2^k nodes in round k: a round puts the stretch above in front.  Together
    the paths of a round are no longer than the result.
    """
    made = written(links.select("_node", "_up", F.array(F.col("_node").cast("string")).alias("_path")), "paths")
    for _ in range(depth.bit_length()):
        above = made.select(F.col("_node").alias("_at"), F.col("_up").alias("_far"), F.col("_path").alias("_front"))
        longer = made.filter("_up IS NOT NULL").join(above, F.col("_up") == F.col("_at")).select(
            "_node", F.col("_far").alias("_up"), F.concat("_front", "_path").alias("_path")
        )
        made = written(made.filter("_up IS NULL").unionByName(longer), "paths")
    return made.select("_node", "_path")


def descendants(
    edges: DataFrame, node: str, parent: str, root, sep: str = ">", max_levels: int | None = None
) -> DataFrame:
    """The root and everyone below it, with generation and path from the root.

    Where each node has one parent, pointers to ancestors are doubled: log2(levels)
    rounds, and a cycle is a pointer that never ends.  Where a node has several, each
    simple path from the root is a row, found level by level; a node that is already
    on the path is not entered again, so cycles end.
    """
    people = edges.select(node, parent)
    start = people.filter(F.col(node) == root)
    if not _one_parent(people, node):
        return _descendants_by_level(people, node, parent, start, sep, max_levels)
    named = people.filter(F.col(node).isNotNull())
    top = F.col(node) == root
    up = F.when(~top, F.col(parent))
    found = _climbed(named.filter(top | F.col(parent).isNotNull()).select(
        F.col(node).alias("_node"), up.alias("_up"), F.when(top, 0).otherwise(1).alias("_steps"), top.alias("_top")
    ))
    found = written(found, "found")
    deepest = found.agg(F.max("_steps")).first()[0] or 0
    if max_levels is not None and deepest + 1 > max_levels:
        raise TooLarge(f"more than {max_levels} levels")
    own = named.join(found, F.col(node) == F.col("_node")).select(node, parent, "_node", up.alias("_up"), "_steps")
    own = written(own, "descendants")
    placed = own.join(_paths(own, deepest).withColumnRenamed("_node", "_of"), F.col("_node") == F.col("_of"))
    return placed.select(node, parent, (F.col("_steps") + 1).alias("generation"), F.array_join("_path", sep).alias("path"))


def _descendants_by_level(
    people: DataFrame, node: str, parent: str, start: DataFrame, sep: str, max_levels: int | None
) -> DataFrame:
    first = start.select(node, parent, F.lit(1).alias("generation"), F.array(F.col(node).cast("string")).alias("path"))
    child = people.select(F.col(node).alias("_node"), F.col(parent).alias("_parent"))

    def step(frontier: DataFrame) -> DataFrame:
        below = frontier.join(child, F.col("_parent") == F.col(node))
        name = F.col("_node").cast("string")
        return below.filter(~F.array_contains("path", name)).select(
            F.col("_node").alias(node), F.col("_parent").alias(parent), (F.col("generation") + 1).alias("generation"),
            F.array_append("path", name).alias("path"),
        )

    # The path is a list until the end, since a name may hold the separator.
    return _rounds(first, step, max_levels).withColumn("path", F.array_join("path", sep))


def hierarchy_levels(rows: DataFrame, id_: str, parent: str, roots, max_levels: int | None = None) -> DataFrame:
    """Rows below the given roots (a condition) with their level, 1 for the roots.

    A row has one parent, so a cycle cannot be reached from a root without one.  Pointers
    to ancestors are doubled: log2(levels) rounds.  Where ids repeat, a row counts once
    for every row of its parent, level by level.
    """
    chosen = F.coalesce(roots, F.lit(False)) & F.col(parent).isNull()
    if not _one_parent(rows, id_):
        def step(frontier: DataFrame) -> DataFrame:
            above = frontier.select(F.col(id_).alias(parent), "level")
            below = rows.join(above, parent).withColumn("level", F.col("level") + 1)
            return below.select(*rows.columns, "level")

        return _rounds(rows.filter(chosen).withColumn("level", F.lit(1)), step, max_levels)
    named = rows.filter(F.col(id_).isNotNull())
    steps = F.when(F.col(parent).isNull(), 0).otherwise(1)
    links = named.select(F.col(id_).alias("_node"), F.col(parent).alias("_up"), steps.alias("_steps"), chosen.alias("_top"))
    found = written(_climbed(links), "found")
    # By the parent's level, so rows without an id have theirs too.
    above = found.select(F.col("_node").alias("_above"), (F.col("_steps") + 2).alias("level"))
    below = rows.join(above, F.col(parent) == F.col("_above")).select(*rows.columns, "level")
    out = rows.filter(chosen).withColumn("level", F.lit(1)).unionByName(below)
    if max_levels is not None and not out.filter(F.col("level") > max_levels).isEmpty():
        raise TooLarge(f"more than {max_levels} levels")
    return out


def combos(df: DataFrame, item_id: str, item_name: str, depth: int = 3, max_rows: int | None = None) -> DataFrame:
    """Item sequences of length 1 to ``depth``, repetition allowed.

    The rows of one depth are numbered 0 to n^d - 1 on the executors and each
    number is read as ``d`` digits that look up their items, so the work is
    spread by number.  The result has n + n^2 + ... rows by definition; with
    ``max_rows`` a larger one is refused before anything is made.
    """
    n = df.count()
    total = sum(n**d for d in range(1, depth + 1))
    if max_rows is not None and total > max_rows:
        raise TooLarge(f"{total} combinations, the limit is {max_rows}")
    spark = df.sparkSession
    single = df.select(
        F.col(item_id).alias("item_id"), F.col(item_name).alias("item_name"), F.lit(1).alias("depth"),
        F.col(item_name).alias("combo"),
    )
    if depth == 1 or n == 0:
        return single
    rows = df.select(F.col(item_id).alias("_id"), F.col(item_name).alias("_name"))
    numbered = ranked(rows, [], order_of("_id", "_name"), row_number="_rn")
    listed = numbered.select("_id", "_name", (F.col("_rn") - 1).cast("long").alias("_at"))
    out = [single]
    for d in range(2, depth + 1):
        rows = spark.range(n**d)
        for j in range(d):
            digit = F.floor(F.col("id") / F.lit(n ** (d - 1 - j))) % n
            rows = rows.withColumn("_at", digit.cast("long"))
            item = listed.select(F.col("_at"), F.col("_id").alias(f"_id{j}"), F.col("_name").alias(f"_name{j}"))
            # AQE broadcasts the items where their measured size allows
            rows = rows.join(item, "_at").drop("_at")
        out.append(
            rows.select(
                F.col("_id0").alias("item_id"), F.col(f"_name{d - 1}").alias("item_name"), F.lit(d).alias("depth"),
                F.concat_ws(", ", *[f"_name{j}" for j in range(d)]).alias("combo"),
            )
        )
    return reduce(DataFrame.unionByName, out)


def cheapest_paths(
    edges: DataFrame, start: str, end: str, cost: str, source, max_rounds: int | None = None
) -> DataFrame:
    """Cheapest path from the source to every hub it reaches.

    Costs must be positive, so a cheapest path never repeats a hub.  Each round
    follows the edges of the hubs improved last and keeps one best path per hub:
    the work is bounded by hubs and edges, not by the number of paths.  Equal
    costs go to the path that comes first in order.
    """
    if not edges.filter(F.col(cost) <= 0).limit(1).isEmpty():
        raise ValueError("costs must be positive")
    lanes = edges.groupBy(F.col(start).alias("_from"), F.col(end).alias("_to")).agg(F.min(cost).alias("_cost"))
    lanes = checkpointed(lanes.filter(F.col("_from") != F.col("_to")))
    begin = edges.filter(F.col(start) == source).limit(1).select(
        F.col(start).alias("hub"), F.lit(0).cast(edges.schema[cost].dataType).alias("total_cost"),
        F.array(F.col(start)).alias("path"),
    )
    best = checkpointed(begin)
    frontier = best
    for _ in count() if max_rounds is None else range(max_rounds):
        tried = frontier.join(lanes, F.col("hub") == F.col("_from")).select(
            F.col("_to").alias("hub"), (F.col("total_cost") + F.col("_cost")).alias("total_cost"),
            F.array_append("path", F.col("_to")).alias("path"),
        )
        both = best.withColumn("_new", F.lit(False)).unionByName(tried.withColumn("_new", F.lit(True)))
        picked = both.groupBy("hub").agg(F.min(F.struct("total_cost", "path", "_new")).alias("_b"))
        merged = checkpointed(picked.select("hub", "_b.total_cost", "_b.path", "_b._new"))
        best, frontier = merged.drop("_new"), merged.filter("_new").drop("_new")
        if frontier.isEmpty():
            return best
    raise TooLarge(f"more than {max_rounds} rounds")


def cheapest_path(edges: DataFrame, start: str, end: str, cost: str, source, target) -> DataFrame:
    """The cheapest path between two hubs: one row, or none if there is no path."""
    return cheapest_paths(edges, start, end, cost, source).filter(F.col("hub") == target)
