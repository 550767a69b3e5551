"""Trees, combinations and paths against brute force on small graphs."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tablecraft.operators import hierarchy as H


def test_cycles_end(spark):
    df = spark.createDataFrame(
        [("Alice", "Dora"), ("Bob", "Alice"), ("Carl", "Bob"), ("Dora", "Carl"), ("Bo", "Alice")], "name string, boss string"
    )
    got = {r.name: (r.generation, r.path) for r in H.descendants(df, "name", "boss", "Alice").collect()}
    assert got == {
        "Alice": (1, "Alice"), "Bob": (2, "Alice>Bob"), "Bo": (2, "Alice>Bo"),
        "Carl": (3, "Alice>Bob>Carl"), "Dora": (4, "Alice>Bob>Carl>Dora"),
    }
    assert H.descendants(df, "name", "boss", "Nobody").count() == 0


def test_levels_from_chosen_roots(spark):
    df = spark.createDataFrame([(1, None, 1), (2, 1, 1), (3, 2, 1), (4, None, 2), (5, 4, 2)], "id int, parent int, owner int")
    got = {r.id: r.level for r in H.hierarchy_levels(df, "id", "parent", F.col("owner") == 1).collect()}
    assert got == {1: 1, 2: 2, 3: 3}


def test_combos_are_all_sequences(spark):
    df = spark.createDataFrame([(10, "a"), (20, "b"), (30, "c")], "id int, name string")
    got = sorted(tuple(r) for r in H.combos(df, "id", "name", 3).collect())
    ids = dict(zip("abc", (10, 20, 30)))
    want = sorted(
        (ids[c[0]], c[-1], d, ", ".join(c)) for d in (1, 2, 3) for c in itertools.product("abc", repeat=d)
    )
    assert got == want
    with pytest.raises(H.TooLarge):
        H.combos(df, "id", "name", 3, max_rows=38)
    assert H.combos(df.filter("false"), "id", "name", 3).count() == 0


def test_cheapest_paths_against_all_simple_paths(spark):
    rng = random.Random(5)
    edges = [(a, b, rng.randint(1, 9)) for a in range(7) for b in range(7) if a != b and rng.random() < 0.4]
    edges += [(0, 1, 9), (0, 1, 3)]
    best: dict[int, int] = {0: 0}

    def walk(at, cost, seen):
        for a, b, c in edges:
            if a == at and b not in seen:
                best[b] = min(best.get(b, 10**9), cost + c)
                walk(b, cost + c, seen | {b})

    walk(0, 0, {0})
    df = spark.createDataFrame(edges, "a int, b int, c int")
    got = {r.hub: r for r in H.cheapest_paths(df, "a", "b", "c", 0).collect()}
    assert {h: r.total_cost for h, r in got.items()} == best
    for hub, row in got.items():
        legs = [min(c for a, b, c in edges if (a, b) == leg) for leg in zip(row.path, row.path[1:])]
        assert sum(legs) == row.total_cost and row.path[0] == 0 and row.path[-1] == hub
    target = max(best)
    assert H.cheapest_path(df, "a", "b", "c", 0, target).first().total_cost == best[target]
    with pytest.raises(ValueError):
        H.cheapest_paths(df.withColumn("c", F.col("c") - 3), "a", "b", "c", 0)


def plain_tree(rows, root):
    """(generation, path) of each node whose parents lead to the root."""
    up, out = dict(rows), {}
    for node in up:
        path, at = [node], node
        while at != root and up.get(at) is not None and len(path) <= len(up):
            at = up[at]
            path.append(at)
        if at == root and at in up and len(path) <= len(up):
            out[node] = (len(path), ">".join(map(str, reversed(path))))
    return out


def test_random_forests_with_cycles(spark):
    rng = random.Random(8)
    for n in (1, 2, 9, 60):
        rows = [(i, rng.choice([None, *range(n + 2)]) if rng.random() < 0.2 else max(0, i - rng.randint(1, 3))) for i in range(n)]
        df = spark.createDataFrame([*rows, (None, 0)], "id int, up int")
        got = {r.id: (r.generation, r.path) for r in H.descendants(df, "id", "up", 0).collect()}
        assert got == plain_tree(rows, 0)


def counted(monkeypatch):
    names, real = [], H.written
    monkeypatch.setattr(H, "written", lambda df, name: names.append(name) or real(df, name))
    return names


def test_a_deep_chain_takes_few_rounds(spark, monkeypatch):
    names = counted(monkeypatch)
    chain = spark.range(10_000).select(F.col("id"), F.expr("CASE WHEN id > 0 THEN id - 1 END").alias("up"))
    got = H.hierarchy_levels(chain, "id", "up", F.lit(True)).agg(F.max("level"), F.count("*"), F.sum("level")).first()
    assert tuple(got) == (10_000, 10_000, 50_005_000)
    assert names.count("links") - 1 <= 15


def test_a_deep_path_takes_few_rounds(spark, monkeypatch):
    names = counted(monkeypatch)
    chain = spark.range(700).select(F.col("id"), F.expr("CASE WHEN id > 0 THEN id - 1 ELSE 699 END").alias("up"))
    last = H.descendants(chain, "id", "up", 0).orderBy(F.desc("generation")).first()
    assert last.generation == 700 and last.path == ">".join(map(str, range(700)))
    assert names.count("links") - 1 <= 11 and names.count("paths") - 1 <= 10
    with pytest.raises(H.TooLarge):
        H.descendants(chain, "id", "up", 0, max_levels=699)


def test_several_parents_give_every_simple_path(spark):
    df = spark.createDataFrame([("r", None), ("a", "r"), ("b", "r"), ("c", "a"), ("c", "b"), ("a", "c")], "n string, p string")
    got = sorted(r.path for r in H.descendants(df, "n", "p", "r").collect())
    assert got == ["r", "r>a", "r>a>c", "r>b", "r>b>c", "r>b>c>a"]


def test_levels_skip_cycles_other_roots_and_missing_parents(spark):
    df = spark.createDataFrame([(1, None, "y"), (2, 1, "n"), (3, 4, "y"), (4, 3, "y"), (5, None, None), (6, 5, "y"), (7, 99, "y"), (None, 2, "y")], "id int, up int, ok string")
    got = sorted(((r.id, r.level) for r in H.hierarchy_levels(df, "id", "up", F.col("ok") == "y").collect()), key=str)
    assert got == [(1, 1), (2, 2), (None, 3)]
    with pytest.raises(H.TooLarge):
        H.hierarchy_levels(df, "id", "up", F.col("ok") == "y", 2)
    assert H.hierarchy_levels(df.filter("false"), "id", "up", F.col("ok") == "y").count() == 0
