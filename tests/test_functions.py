import datetime as dt

from pyspark.sql import functions as F

from aeris.functions.geometry import point_in_ring
from aeris.functions.numeric import stable_round
from aeris.functions.time import day_text, local_timestamp, run_window


def test_local_timestamp_modes(spark):
    rows = ["2025-03-01T10:00:00+01:00", "2025-03-01T05:00:00-05:00", "2025-03-01T10:00:00Z",
            "2025-03-01T10:00:00", "bad", None]
    df = spark.createDataFrame([(r,) for r in rows], "s string")
    got = df.select(local_timestamp(F.col("s"), "reference").alias("r"),
                    local_timestamp(F.col("s"), "wall_clock").alias("w")).collect()
    h = lambda x: dt.datetime(2025, 3, 1, x)
    assert [g.r for g in got] == [h(9), h(5), h(10), h(10), None, None]
    assert [g.w for g in got] == [h(10), h(5), h(10), h(10), None, None]


def test_local_timestamp_ignores_session_zone(spark):
    df = spark.createDataFrame([("2025-03-01T10:00:00+01:00",)], "s string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = df.select(local_timestamp(F.col("s")).alias("r")).collect()[0].r
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == dt.datetime(2025, 3, 1, 9)


def test_day_text(spark):
    df = spark.createDataFrame([("2025-03-01T10",), ("x",), ("",), (None,)], "s string")
    assert [r.d for r in df.select(day_text(F.col("s")).alias("d")).collect()] == ["2025-03-01", "x", "", None]


def test_run_window():
    assert run_window("2025-03-02") == ("2025-03-01", "2025-03-02")


def test_stable_round_ties(spark):
    df = spark.createDataFrame([(23.385,), (0.125,), (2.675,), (None,)], "x double")
    got = [r.r for r in df.select(stable_round(F.col("x"), 2).alias("r")).collect()]
    assert got == [23.39, 0.13, 2.68, None]


def test_point_in_ring_half_open_square(spark):
    ring = "array(named_struct('x', 0d, 'y', 0d), named_struct('x', 1d, 'y', 0d), " \
           "named_struct('x', 1d, 'y', 1d), named_struct('x', 0d, 'y', 1d))"
    pts = [(0.5, 0.5, True), (0.0, 0.5, True), (1.0, 0.5, False), (0.5, 0.0, True), (0.5, 1.0, False),
           (2.0, 2.0, False), (-0.1, 0.5, False)]
    df = spark.createDataFrame(pts, "x double, y double, want boolean")
    got = df.select(point_in_ring(F.expr(ring), F.col("x"), F.col("y")).alias("g"), "want").collect()
    assert all(r.g == r.want for r in got)


def test_point_in_ring_degenerate(spark):
    df = spark.createDataFrame([(0.5, 0.5)], "x double, y double")
    empty = F.expr("cast(array() as array<struct<x:double,y:double>>)")
    two = F.expr("array(named_struct('x', 0d, 'y', 0d), named_struct('x', 1d, 'y', 1d))")
    r = df.select(point_in_ring(empty, F.col("x"), F.col("y")).alias("a"),
                  point_in_ring(two, F.col("x"), F.col("y")).alias("b")).collect()[0]
    assert (r.a, r.b) == (False, False)
