"""Hot keys: one group holding a third of all rows, and the non-broadcast paths."""

import contextlib
import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from pyspark.sql import functions as F

from aeris import operators as op
from aeris import schemas


@contextlib.contextmanager
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def half_up(x: float) -> float:
    """Spark's round(x, 2): HALF_UP on the shortest decimal text of the double."""
    return float(Decimal(repr(float(x))).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def test_hot_sensor_day_statistics(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(6000):
        hot = i % 3 == 0  # a third of all rows: sensor 1, one day
        sensor, day = (1, 1) if hot else (2 + i % 50, 1 + i % 5)
        rows.append({"sensor_id": sensor, "value": float(rnd.randint(0, 400)) / 4,
                     "parameter": {"id": 7}, "period": {"datetimeFrom": {"local": f"2025-03-{day:02d}T10:00:00Z"}},
                     "coverage": {"observedCount": 1}})
    df = spark.createDataFrame(rows, schemas.MEASUREMENT).repartition(16)
    got = {(r.day, r.sensor_id): r for r in op.daily_sensor_stats(df).collect()}
    pdf = pd.DataFrame([(r["period"]["datetimeFrom"]["local"][:10], r["sensor_id"], r["value"]) for r in rows],
                       columns=["day", "sensor_id", "value"])
    want = pdf.groupby(["day", "sensor_id"])["value"].agg(["mean", "min", "max", "std", "median", "count"])
    assert len(got) == len(want)
    for (day, sensor), w in want.iterrows():
        g = got[(day, sensor)]
        assert g.observed_count == w["count"]
        assert g.median_value == half_up(w["median"])
        assert math.isclose(g.value, half_up(w["mean"]), abs_tol=0.0101)  # sums may differ in the last bit
        assert math.isclose(g.stddev_value, w["std"], rel_tol=1e-9)
        assert (g.min_value, g.max_value) == (w["min"], w["max"])
    assert got[("2025-03-01", 1)].observed_count == 2000


def test_hot_cell_shuffle_join_equals_broadcast(spark):
    from tests.test_geo import _communes

    rnd = random.Random(11)
    pts = [(i, 4.2 + rnd.random() * 0.05, 4.2 + rnd.random() * 0.05) if i % 3 == 0
           else (i, rnd.uniform(-1, 11), rnd.uniform(-1, 11)) for i in range(3000)]
    points = spark.createDataFrame(pts, "location_id int, city_longitude double, city_latitude double")
    communes = _communes(spark)
    broadcast = op.assign_communes(points, communes, cell_size=0.5)
    with no_broadcast(spark):
        shuffled = op.assign_communes(points, communes, cell_size=0.5).checkpoint()
    assert shuffled.count() == broadcast.count() == 3000
    assert shuffled.select("location_id", "code").exceptAll(broadcast.select("location_id", "code")).count() == 0


def test_semi_join_without_broadcast(spark):
    m = spark.range(0, 30000).select((F.col("id") % 100).cast("int").alias("sensor_id"), F.col("id").alias("v"))
    s = spark.createDataFrame([(i,) for i in range(0, 100, 3)], "sensor_id int")
    a = op.measurements_of_sensors(m, s)
    with no_broadcast(spark):
        b = op.measurements_of_sensors(m, s)
        assert "SortMergeJoin" in b._jdf.queryExecution().executedPlan().toString()
        b = b.checkpoint()
    assert a.count() == b.count() == 30000 * 34 // 100
    assert a.exceptAll(b).count() == 0
