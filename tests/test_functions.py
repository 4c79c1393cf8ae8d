from datetime import datetime
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill import functions as fn


def column(spark, values, kind):
    return spark.createDataFrame([(value,) for value in values], f"x {kind}")


MONEY = [0.125, 0.375, -0.125, 1.005, 2.675, -2.675, 0.0, 1e12 + 0.35, 123456.785, None]


def test_money_cast_matches_sql_engine(spark):
    df = column(spark, MONEY, "double")
    ours = [r[0] for r in df.select(fn.to_money("x", T.DoubleType())).collect()]
    theirs = [
        duckdb.execute("SELECT CAST(?::DOUBLE AS DECIMAL(18, 2))", [value]).fetchone()[0]
        for value in MONEY
    ]
    assert ours == theirs


def test_money_cast_of_other_types(spark):
    assert column(spark, [7], "int").select(fn.to_money("x", T.IntegerType())).first()[0] == 7
    df = column(spark, [Decimal("1.255")], "decimal(10,3)")
    assert df.select(fn.to_money("x", df.schema["x"].dataType)).first()[0] == Decimal("1.26")


def test_rounding_matches_sql_engine(spark):
    df = spark.range(20_000).select((F.rand(7) * 2000 - 1000).alias("x"))
    rows = df.select("x", fn.round_half_away("x", 2)).collect()
    theirs = duckdb.execute(
        "SELECT list_transform(?::DOUBLE[], lambda v: round(v, 2))", [[r[0] for r in rows]]
    ).fetchone()[0]
    assert [r[1] for r in rows] == theirs


def test_half_away_edges(spark):
    values = [0.5, 1.5, 2.5, -0.5, -2.5, 0.49999999999999994, 4503599627370497.0]
    rows = column(spark, values, "double").select(fn.half_away("x")).collect()
    assert [r[0] for r in rows] == [1.0, 2.0, 3.0, -1.0, -3.0, 0.0, 4503599627370497.0]


def test_settled_removes_summation_noise(spark):
    values = [0.125 - 1e-15, 0.125, 0.125 + 1e-15]
    rows = column(spark, values, "double").select(fn.settled("x", 2)).collect()
    assert {r[0] for r in rows} == {0.13}


def test_integer_cast_rounds_to_even(spark):
    df = column(spark, [1.5, 2.5, -0.5, None], "double")
    rows = df.select(fn.to_integer("x", T.DoubleType())).collect()
    assert [r[0] for r in rows] == [2, 2, 0, None]


@pytest.mark.parametrize(
    ("wall", "instant"),
    [
        (datetime(2024, 1, 15, 12, 0), datetime(2024, 1, 15, 17, 0)),
        (datetime(2024, 7, 1, 12, 0), datetime(2024, 7, 1, 16, 0)),
        # The hour skipped in spring moves forward.
        (datetime(2024, 3, 10, 2, 30), datetime(2024, 3, 10, 7, 30)),
        # The hour repeated in autumn means the second one.
        (datetime(2024, 11, 3, 0, 59, 59), datetime(2024, 11, 3, 4, 59, 59)),
        (datetime(2024, 11, 3, 1, 0), datetime(2024, 11, 3, 6, 0)),
        (datetime(2024, 11, 3, 1, 30), datetime(2024, 11, 3, 6, 30)),
        (datetime(2024, 11, 3, 2, 0), datetime(2024, 11, 3, 7, 0)),
        (datetime(1999, 10, 31, 1, 30), datetime(1999, 10, 31, 6, 30)),
        (datetime(2024, 1, 31, 20, 0), datetime(2024, 2, 1, 1, 0)),
    ],
)
def test_local_to_instant(spark, wall, instant):
    df = column(spark, [wall], "timestamp_ntz")
    got = df.select(fn.local_to_instant("x").cast("timestamp_ntz")).first()[0]
    sql = "SELECT timezone('UTC', timezone('America/New_York', ?::TIMESTAMP))"
    assert got == instant == duckdb.execute(sql, [wall]).fetchone()[0]


def test_every_hour_of_two_change_days_matches_sql_engine(spark):
    start = datetime(2023, 11, 5)
    df = spark.range(0, 366 * 48).select(
        F.timestamp_add("MINUTE", F.col("id") * 30, F.lit(start).cast("timestamp_ntz")).alias("x")
    )
    ours = df.select(fn.local_to_instant("x").cast("string")).collect()
    theirs = duckdb.execute(
        """SELECT CAST(timezone('UTC', timezone('America/New_York', ?::TIMESTAMP + to_minutes(i * 30))) AS VARCHAR)
           FROM range(366 * 48) t(i) ORDER BY i""",
        [start],
    ).fetchall()
    assert [r[0] for r in ours] == [r[0] for r in theirs]


def test_seconds_count_boundaries(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00.9' AS a, TIMESTAMP '2024-01-01 00:00:01.1' AS b")
    assert df.select(fn.seconds_between("a", "b")).first()[0] == 1


def test_weekdays(spark):
    df = spark.sql("SELECT explode(sequence(DATE '2024-01-07', DATE '2024-01-13')) AS d")
    rows = df.select(fn.weekday_number("d"), fn.weekday_name("dayofweek(d) - 1"), F.date_format("d", "EEEE")).collect()
    assert [r[0] for r in rows] == list(range(7))
    assert all(r[1] == r[2] for r in rows)


def test_in_own_month(spark):
    df = spark.sql(
        "SELECT TIMESTAMP '2024-02-01 00:00:00' AS t, m FROM VALUES ('2024-01'), ('2024-02') AS v(m)"
    )
    rows = df.select(fn.in_own_month("t", "m")).collect()
    assert [r[0] for r in rows] == [False, True]


def test_exact_sums_do_not_depend_on_partitions(spark):
    rows = spark.range(200_000).selectExpr("CAST(id * 7919 % 1000003 AS DOUBLE) / 7 AS x")
    results = {
        tuple(rows.repartition(n).agg(fn.exact_sum("x", 2).alias("s"), fn.exact_mean("x", 2).alias("m")).first()) for n in (1, 3, 7)
    }
    assert len(results) == 1 and next(iter(results))[0] > 1e9


def test_decimals_round_to_integers(spark):
    df = spark.sql("SELECT CAST(x AS DECIMAL(6, 2)) AS x FROM VALUES (1.5), (2.49), (-1.5), (3.0) AS v(x)")
    assert [r[0] for r in df.select(fn.to_integer("x", T.DecimalType(6, 2))).collect()] == [2, 2, -2, 3]
