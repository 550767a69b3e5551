"""Forms that must agree, forms that must not, and the rules for NULL."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablecraft.operators import aggregates as A
from tablecraft.operators import filters as P
from tablecraft.operators import joins as J
from tablecraft.operators import sets as Q
from tablecraft.operators import stats as M
from tablecraft.operators import windows as V


def values(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def left(spark):
    return spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")


@pytest.mark.parametrize(
    "listed,kept",
    [([2], [1, 3]), ([2, None], []), ([None], []), ([], [1, 2, 3, None]), ([9, 9], [1, 2, 3])],
)
def test_not_in(spark, left, listed, kept):
    sub = spark.createDataFrame([(v,) for v in listed], "v int")
    got = [r.k for r in J.not_in(left, "k", sub, "v").collect()]
    assert sorted(got, key=str) == sorted(kept, key=str)
    left.createOrReplaceTempView("l"), sub.createOrReplaceTempView("s")
    built_in = [r.k for r in spark.sql("SELECT k FROM l WHERE k NOT IN (SELECT v FROM s)").collect()]
    assert sorted(got, key=str) == sorted(built_in, key=str)


def test_latest_rows_match_the_self_anti_join(spark):
    df = spark.createDataFrame(
        [(1, 1), (1, 2), (1, 2), (2, None), (2, 5), (None, 1), (None, 2), (3, None)], "id int, ts int"
    )
    df.createOrReplaceTempView("e")
    late = spark.sql("SELECT a.* FROM e a LEFT ANTI JOIN e b ON a.id = b.id AND b.ts > a.ts")
    early = spark.sql("SELECT a.* FROM e a LEFT ANTI JOIN e b ON a.id = b.id AND b.ts < a.ts")
    assert values(J.latest_by_anti(df, ["id"], "ts")) == values(late)
    assert values(J.first_rows(df, ["id"], "ts")) == values(early)


def test_division_by_nothing_keeps_all(spark):
    keys = spark.createDataFrame([(1,), (2,)], "k int")
    facts = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (1, "a")], "k int, v string")
    both = spark.createDataFrame([("a",), ("b",)], "v string")
    assert values(J.divide(keys, facts, "k", "v", both)) == [(1,)]
    assert values(J.divide(keys, facts, "k", "v", both.filter("false"))) == [(1,), (2,)]


def test_some_is_strict_and_the_self_join_is_not(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "b int")
    sub = spark.createDataFrame([(2,), (3,)], "x int")
    assert values(J.gt_some(df, "b", sub, "x")) == [(3,)]
    assert values(J.gt_threshold(df, "b", sub, "x")) == [(2,), (3,)]
    assert values(J.gt_some(df, "b", sub.filter("false"), "x")) == []


def test_or_forms(spark):
    df = spark.createDataFrame([(1, None), (1, 18), (2, 18), (3, 7), (None, 18)], "id int, age int")
    p, q = F.col("id") == 1, F.col("age") == 18
    assert values(P.or_as_union(df, p, q)) == values(df.filter(p | q))
    assert P.or_as_union(df, p, q, literal=True).count() == df.filter(p | q).count() + 1


def test_not_equal_drops_null(spark):
    df = spark.createDataFrame([(17,), (18,), (19,), (None,)], "age int")
    below, above = P.ne_split(df, "age", 18)
    assert values(below.unionAll(above)) == values(P.not_equal(df, "age", 18)) == [(17,), (19,)]
    signed = spark.createDataFrame([(-1,), (0,), (2,), (None,)], "v int")
    assert P.positive_rows(signed, "v").count() == 1 and P.non_null_rows(signed, "v").count() == 3


def test_union_and_minus(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    b = spark.createDataFrame([(1,)], "v int")
    assert Q.union_all(a, b).count() == 4 and Q.union_distinct(a, b).count() == 2
    assert values(Q.minus(a, b)) == [(2,)] and values(Q.minus(a, b, keep_copies=True)) == [(1,), (2,)]


def test_average_ignores_null_and_sum_over_count_does_not(spark):
    df = spark.createDataFrame([(10.0,), (20.0,), (None,)], "v double")
    assert tuple(A.avg_null_aware(df, "v").first()) == (15.0, 10.0)


def test_multi_fact_keeps_three_valued_having(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, g string")
    one = spark.createDataFrame([(1, 5), (1, 5), (2, 0)], "k int, x int")
    two = spark.createDataFrame([(1, 2)], "k int, y int")
    # b sums to 0 and NULL, c to NULL and NULL
    assert values(J.multi_fact_rollup(base, "k", [one, two], ["g"])) == [("a", 10, 2)]


def test_rollup_tells_total_from_null(spark):
    df = spark.createDataFrame([("x", 1.0), (None, 3.0)], "k string, v double")
    got = {(r.k, r.level): r.m for r in A.rollup_agg(df, ["k"], m=F.avg("v")).collect()}
    assert got == {("x", 0): 1.0, (None, 0): 3.0, (None, 1): 2.0}


def test_node_types_with_null_parent(spark):
    tree = spark.createDataFrame([(1, 2), (3, 2), (6, 8), (9, 8), (2, 5), (8, 5), (5, None)], "n int, p int")
    got = {r.n: r.node_type for r in P.node_type(tree, "n", "p").collect()}
    assert got == {1: "Leaf", 3: "Leaf", 6: "Leaf", 9: "Leaf", 2: "Inner", 8: "Inner", 5: "Root"}


def test_streaks_count_only_unbroken_ids(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (DATE'2016-03-01', 1), (DATE'2016-03-01', 2), (DATE'2016-03-02', 1), (DATE'2016-03-02', 1), "
        "(DATE'2016-03-03', 1), (DATE'2016-03-03', 2), (DATE'2016-03-04', 3) AS t(day, id)"
    )
    assert [r.n_ids for r in J.streak_count(df, "day", "id").orderBy("day").collect()] == [2, 1, 1, 0]


def test_dynamic_pivot_refuses_too_many_values(spark):
    df = spark.range(50).selectExpr("id % 2 AS r", "id AS c")
    spark.conf.set("spark.sql.pivotMaxValues", "10")
    try:
        with pytest.raises(ValueError):
            A.dynamic_pivot(df, "r", "c", F.count(F.lit(1)))
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_regression_forms_agree(spark):
    df = spark.createDataFrame([(float(i), 3.0 * i + (i % 3)) for i in range(30)], "x double, y double")
    a, b = M.ols_manual(df, "x", "y").first(), M.ols_fit(df, "x", "y").first()
    assert a.slope == pytest.approx(b.slope) and a.intercept == pytest.approx(b.intercept)
    assert M.ols_manual(df.filter("x = 1"), "x", "y").first().slope is None


def test_empty_input(spark):
    none = spark.createDataFrame([], "k int, ts timestamp_ntz, v double")
    assert V.moving_avg(none, ["k"], ["ts"], "v", 2, 2).count() == 0
    assert V.median_over(none, ["k"], "v").count() == 0
    assert M.mad_score(none, "v").count() == 0
    assert J.overlap_flag(none.withColumn("e", F.col("ts")), "k", "ts", "e").count() == 0


def test_approximate_deciles_are_close(tables):
    out = V.decile_approx(tables.orders, "o_totalprice").groupBy("decile").count().collect()
    n = tables.orders.count()
    assert len(out) == 10 and all(abs(r["count"] - n / 10) < n * 0.02 for r in out)
