import math

from pyspark.sql import functions as F

from aeris import operators as op
from aeris import schemas


def _m(sensor, value, local, observed, pid=2):
    return {"sensor_id": sensor, "value": value, "parameter": {"id": pid, "name": "pm25", "units": "µg/m³"},
            "period": {"datetimeFrom": {"local": local}}, "coverage": {"expectedCount": 1, "observedCount": observed}}


def test_daily_stats_edge_rows(spark):
    rows = [
        _m(1, 0.1, "2025-03-01T10:00:00+01:00", 1),
        _m(1, 0.25, "2025-03-01T11:00:00+01:00", None),
        _m(2, 5.0, "2025-03-01T10:00:00Z", 3),
        _m(3, None, "2025-03-01T10:00:00Z", None),
    ]
    df = spark.createDataFrame(rows, schemas.MEASUREMENT)
    got = {r.sensor_id: r for r in op.daily_sensor_stats(df).collect()}
    a = got[1]
    assert a.day == "2025-03-01" and a.value == 0.18 and a.max_value == 0.25 and a.median_value == 0.18
    assert math.isclose(a.min_value, 0.1, rel_tol=1e-6)
    assert math.isclose(a.stddev_value, 0.10606601612431092, rel_tol=1e-9)
    assert (a.observed_count, a.expected_count) == (1, 24)
    assert got[2].stddev_value is None and got[2].value == 5.0
    c = got[3]
    assert (c.value, c.min_value, c.max_value, c.stddev_value, c.median_value, c.observed_count) == (None,) * 6
    assert op.daily_sensor_stats(df).columns == [
        "day", "sensor_id", "parameter_id", "value", "min_value", "max_value", "stddev_value", "median_value",
        "observed_count", "expected_count"]


def test_daily_stats_totals_and_order_property(spark):
    from aeris import adapters as A
    from tests.conftest import SF001

    raw = A.raw_measurements(spark, SF001)
    daily = op.daily_sensor_stats(raw)
    tot = daily.agg(F.sum("observed_count")).collect()[0][0]
    assert tot == raw.agg(F.sum("coverage.observedCount")).collect()[0][0]
    bad = daily.where(~((F.col("min_value") <= F.col("median_value") + 0.01)
                        & (F.col("median_value") <= F.col("max_value") + 0.01))).count()
    assert bad == 0


def test_raw_measurements_reference_time(spark):
    df = spark.createDataFrame([_m(1, 1.0, "2025-03-01T10:00:00+01:00", 1)], schemas.MEASUREMENT)
    r = op.raw_measurements(df).collect()[0]
    assert str(r.period_datetime_local) == "2025-03-01 09:00:00"
    assert op.raw_measurements(df).columns == [
        "sensor_id", "value", "period_datetime_local", "parameter_id", "parameter_name", "parameter_units",
        "coverage_expectedCount", "coverage_observedCount"]


def test_measurements_between_half_open(spark):
    df = spark.createDataFrame([("2025-03-01",), ("2025-03-02",), ("2025-02-28",)], "day string")
    got = sorted(r.day for r in op.measurements_between(df, "2025-03-01", "2025-03-02", column="day").collect())
    assert got == ["2025-03-01"]


def test_semi_join_does_not_repeat(spark):
    m = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "sensor_id int, value double")
    s = spark.createDataFrame([(1,), (1,), (3,), (None,)], "sensor_id int")
    got = sorted(r.sensor_id for r in op.measurements_of_sensors(m, s).collect())
    assert got == [1, 3]
