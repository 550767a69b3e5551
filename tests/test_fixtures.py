"""Small literal tables with results worked out by hand."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablecraft.functions import exprs as E
from tablecraft.functions import udfs as U
from tablecraft.operators import aggregates as A
from tablecraft.operators import filters as P
from tablecraft.operators import stats as M
from tablecraft.operators import timeseries as S
from tablecraft.operators import windows as V
from tablecraft.sources import tables as T


@pytest.fixture(scope="module")
def salaries(spark):
    return T.literal_rows(
        spark,
        [("ramesh", 20, "finance", 50000), ("deep", 24, "sales", 30000), ("suresh", 22, "finance", 50000),
         ("ram", 28, "finance", 20000), ("pradeep", 22, "sales", 20000)],
        "name string, age int, department string, salary int",
    )


@pytest.fixture(scope="module")
def purchases(spark):
    at = dt.datetime(2023, 1, 1, 0, 0, 1)
    return T.literal_rows(
        spark,
        [(1, 1, at, Decimal(10)), (2, 1, at, Decimal(20)), (3, 1, at + dt.timedelta(seconds=1), Decimal(30))],
        "id int, customer_id int, purchase_ts timestamp_ntz, amount decimal(18,2)",
    )


def column(df, name, order="id"):
    return [r[name] for r in df.orderBy(order).collect()]


def test_department_average(salaries):
    got = {r.name: r.average for r in V.avg_over(salaries, ["department"], "salary").collect()}
    assert got == {"ramesh": 40000, "suresh": 40000, "ram": 40000, "deep": 25000, "pradeep": 25000}
    assert {r.average for r in V.avg_over(salaries, [], "salary").collect()} == {34000}


def test_rows_and_range_totals_differ_on_ties(purchases):
    rows = V.running_total_rows(purchases, ["customer_id"], ["purchase_ts", "id"], "amount")
    peers = V.running_total_range(purchases, ["customer_id"], ["purchase_ts"], "amount")
    day = V.rolling_sum_time(purchases, ["customer_id"], "purchase_ts", "amount", 86_400)
    assert column(rows, "running_total") == [10, 30, 60]
    assert column(peers, "running_total") == [30, 30, 60]
    assert column(day, "rolling_time") == [30, 30, 60]


def test_repeated_order_keys(purchases):
    assert [tuple(r) for r in V.duplicate_order_keys(purchases, ["purchase_ts"]).collect()] == [
        (dt.datetime(2023, 1, 1, 0, 0, 1), 2)
    ]


def test_monthly_change(spark):
    revenue = [50500, 42500, 65000, 71000]
    df = T.literal_rows(spark, [(i + 1, float(v)) for i, v in enumerate(revenue)], "month_id int, revenue double")
    out = V.pct_change(df, ["month_id"], "revenue").orderBy("month_id").collect()
    assert out[0].previous is None and out[0].change_back is None
    assert out[1].change_back == pytest.approx(-8000 / 50500)
    assert out[0].change_ahead == pytest.approx(-8000 / 50500)
    assert out[3].following is None
    assert E.percent_text(F.lit(0.5))._jc is not None


def test_first_and_last_year(spark):
    df = T.literal_rows(spark, [(2009, 112.0), (2010, 117.0), (2023, 96773.0)], "year int, revenue double")
    assert {(r.first_revenue, r.last_revenue) for r in V.first_last_value(df, "year", "revenue").collect()} == {(112.0, 96773.0)}


def test_median_distance_marks_the_outlier(spark):
    kids = [("Lily", 15.0), ("Muhammad", 98.0), ("Daphne", 16.0), ("Max", 12.0), ("Chloe", 11.0), ("Jackie", 14.0), ("Albert", 17.0)]
    df = T.literal_rows(spark, kids, "name string, weight double")
    got = {r.name: r.score for r in M.mad_score(df, "weight").collect()}
    # median 15, distances 0 83 1 3 4 1 2, their median 2
    assert got["Muhammad"] == 41.5 and got["Lily"] == 0 and got["Chloe"] == 2
    flat = T.literal_rows(spark, [("a", 1.0), ("b", 1.0)], "name string, weight double")
    assert {r.score for r in M.mad_score(flat, "weight").collect()} == {None}


def test_add_two_numbers(spark):
    U.register_add_two_numbers(spark)
    assert spark.sql("SELECT add_two_numbers(5, 7)").first()[0] == 12


def test_nullif(spark):
    row = spark.sql("SELECT nullif('Red', 'Orange') a, nullif(0, NULL) b, nullif(0, 0) c").first()
    assert tuple(row) == ("Red", 0, None)
    df = T.literal_rows(spark, [(1.0, 0.0), (1.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(P.safe_divide("a", "b")).collect()] == [None, 0.5]


def test_digit_zero_error(spark):
    df = T.literal_rows(spark, [(1420,), (2006,), (2210,), (0,)], "salary int")
    gap = A.zero_key_error(df, "salary").first()
    # 1409 against (142 + 26 + 221) / 3: a lone 0 becomes NULL
    assert gap.gap == pytest.approx(1409 - 389 / 3) and gap.gap_up == 1280


def test_bands_at_the_edges(spark):
    df = T.literal_rows(spark, [(1001.0,), (1000.0,), (500.0,), (499.0,), (None,)], "v double")
    labels = [r[0] for r in df.select(P.band("v", [1000, 500], ["High", "Medium", "Low"])).collect()]
    assert labels == ["High", "Medium", "Medium", "Low", "Unknown"]


def test_month_and_padding(spark):
    df = T.literal_rows(spark, [("Jun", 7), ("Nope", 123456)], "m string, n int")
    got = df.select(E.month_number("m"), E.zero_padded("n", 5)).collect()
    assert [tuple(r) for r in got] == [(6, "00007"), (None, "123456")]


def test_email_domain(spark):
    df = T.literal_rows(spark, [("a@x.org",), ("broken",)], "email string")
    assert [r[0] for r in df.select(E.email_domain("email")).collect()] == ["x.org", ""]


def test_width_bucket_edges(spark):
    df = T.literal_rows(spark, [(29.9,), (30.0,), (109.9,), (110.0,)], "v double")
    assert [r[0] for r in df.select(E.width_bucket_col("v", 30, 110, 8)).collect()] == [0, 1, 8, 9]


def test_calendar_has_leap_days_and_weekends(spark):
    days = S.calendar_dim(spark, "2020-01-01", "2029-12-31")
    assert days.count() == 3653
    kinds = {str(r.dt): r.day_type for r in days.filter("year = 2020 AND quarter = 1").collect()}
    assert kinds["2020-02-29"] == "Weekend" and kinds["2020-03-02"] == "Weekday"
    assert S.number_spine(spark, 1, 1_000_000).count() == 1_000_000
    assert T.generate_rows(spark, 3).collect()[2].address == "Address 3"


def test_grid_fill(spark):
    at = dt.datetime(2024, 1, 1)
    step = dt.timedelta(minutes=5)
    df = T.literal_rows(
        spark, [("a", at, 1.0), ("a", at + 3 * step, 4.0), ("b", at + step, 9.0)], "k string, ts timestamp_ntz, v double"
    )
    out = S.grid_ffill(df, "k", "ts", "v", 300).orderBy("k", "bucket_ts").collect()
    assert [r.imputed_value for r in out] == [1, 1, 1, 4, None, 9, 9, 9]
    own = S.gap_fill_prev(df, "k", "ts", "v", 300).orderBy("k", "ts").collect()
    assert [(r.k, r.v) for r in own] == [("a", 1), ("a", 1), ("a", 1), ("a", 4), ("b", 9)]


def test_average_of_averages_differs(spark):
    people = T.literal_rows(spark, [("x", 1), ("x", 2)], "county string, id int")
    claims = T.literal_rows(spark, [(1, 10.0), (1, 10.0), (1, 10.0), (2, 50.0)], "id int, cost double")
    right = A.ratio_of_totals(people, "county", "id", claims, "id", "cost").first()
    assert (right.avg_visits, right.avg_cost) == (2, 40)
    assert A.average_of_averages(people, "county", "id", claims, "id", "cost").first().avg_of_avg == 30


def test_wilson_forms_differ(spark):
    df = T.literal_rows(spark, [("a", 1)] * 3 + [("a", 0)] * 7, "v string, hit int")
    good = M.wilson_ci(df, ["v"], "hit").first()
    odd = M.wilson_ci(df, ["v"], "hit", "as_written").first()
    assert good.conversion_rate == 0.3
    assert good.lower_bound == pytest.approx(0.10779, abs=1e-4) and good.upper_bound == pytest.approx(0.60322, abs=1e-4)
    assert odd.upper_bound - odd.lower_bound < good.upper_bound - good.lower_bound
    with pytest.raises(ValueError):
        M.wilson_ci(df, ["v"], "hit", "other")


def test_csv_keeps_bad_lines(spark, tmp_path):
    from pyspark.sql import types as K

    (tmp_path / "in.csv").write_text('1,"a, b"\nx,c\n3,d\n')
    schema = K.StructType([K.StructField("n", K.IntegerType()), K.StructField("t", K.StringType())])
    got = T.load_csv(spark, str(tmp_path / "in.csv"), schema, bad_rows="bad").cache().collect()
    assert [(r.n, r.t, r.bad) for r in got] == [(1, "a, b", None), (None, "c", "x,c"), (3, "d", None)]
