import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from aeris.operators import layout as L
from aeris.session import local_fs_path


def row_groups(path):
    """Minima and maxima of each row group, from the footers."""
    out = []
    for file in glob.glob(f"{local_fs_path(path)}/*.parquet"):
        meta = pq.read_metadata(file)
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(meta.num_columns)}
            out.append({n: (s.min, s.max) for n, s in columns.items() if s is not None and s.has_min_max})
    return out


def share(groups, column, value):
    return sum(g[column][0] <= value <= g[column][1] for g in groups) / len(groups)


@pytest.fixture(scope="module")
def fact(spark):
    """A third of all rows are one sensor's, ids are far apart, days are texts."""
    i = F.col("id")
    sensor = F.when(i % 3 == 0, F.lit(7)).otherwise((F.pmod(F.xxhash64("id"), F.lit(2000)) ** 2).cast("int"))
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)).cast("int")).cast("string")
    return spark.range(0, 60_000, 1, 4).select(day.alias("day"), sensor.alias("sensor_id"), i.alias("n")).persist()


def test_a_day_and_a_sensor_touch_few_row_groups(spark, scratch, fact):
    curve, plain = scratch("curve"), scratch("plain")
    L.along_curve(fact, L.day_and_sensor(), files=64).write.parquet(curve)
    fact.repartitionByRange(64, "day", "sensor_id").sortWithinPartitions("day", "sensor_id").write.parquet(plain)
    laid, by_day = row_groups(curve), row_groups(plain)
    assert len(laid) >= 60
    days = ["2024-01-01", "2024-02-10", "2024-04-09"]
    sensors = [r.sensor_id for r in fact.where("sensor_id <> 7").select("sensor_id").distinct().orderBy("sensor_id").limit(2000).collect()][::400]
    assert max(share(laid, "day", d) for d in days) <= 0.25
    assert max(share(laid, "sensor_id", s) for s in sensors) <= 0.25
    assert min(share(by_day, "sensor_id", s) for s in sensors[1:-1]) > 0.9  # what a sort by day leaves
    counts = [r["count"] for r in spark.read.parquet(curve).groupBy(F.col("_metadata.file_path")).count().collect()]
    assert max(counts) < 4 * 60_000 / 64  # a hot sensor is split
    assert spark.read.parquet(curve).exceptAll(fact).isEmpty() and spark.read.parquet(curve).count() == 60_000


def test_ranks_keep_the_order_and_stay_in_range(spark):
    values = [None, -5.0, 0.0, 0.5, 1.0, 1.0, 3.0, 1e9, 1e12]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r.r for r in df.select(L.rank(F.col("x"), [0.0, 1.0, 2.0, 1e9], 8).alias("r"), "x").orderBy(F.asc_nulls_first("x")).collect()]
    assert got == sorted(got) and got[0] == 0 and got[-1] == 255
    assert {r.r for r in df.select(L.rank(F.col("x"), [3.0], 8).alias("r")).collect()} == {0}


def test_bits_are_interleaved(spark):
    row = spark.sql("SELECT 5L AS a, 3L AS b").select(L.interleaved([F.col("a"), F.col("b")], 4).alias("z")).first()
    assert row.z == 0b011011  # a = 101, b = 011; b's bit stands before a's
    with pytest.raises(ValueError):
        L.interleaved([F.col("a")] * 4, 16)


def test_edge_tables(spark):
    empty = spark.createDataFrame([], "day string, sensor_id int")
    assert L.along_curve(empty, L.day_and_sensor()).count() == 0
    rows = [(None, None), ("2024-01-01", None), (None, 3), ("no day", 3), ("2024-01-01", 3), ("2024-01-01", 3)]
    df = spark.createDataFrame(rows, "day string, sensor_id int").select("*", F.lit("x").alias("__rank"), F.lit(1).alias("rank"))
    assert sorted(map(repr, L.along_curve(df, L.day_and_sensor()).collect())) == sorted(map(repr, df.collect()))
