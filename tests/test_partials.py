import random

import pytest
from pyspark.sql import functions as F

from aeris import adapters as A
from aeris import operators as op
from aeris.operators import partials as P
from aeris.plans.load import Warehouse
from tests.conftest import SF001

FACT = "day string, sensor_id int, parameter_id int, value float, coverage_observedCount int"


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.select("day", "sensor_id", "parameter_id", "value", "min_value", "max_value", "stddev_value",
                                                        "median_value", "observed_count", "expected_count").collect())))


def flat(spark, n=400, seed=1):
    rnd = random.Random(seed)
    value = lambda: rnd.choice([None, 0.1, 0.1, 23.385, -5.5, float("nan") if seed == 9 else 7.0, rnd.uniform(-50, 50), 3e7, 3e7 + 2])
    data = [(f"2025-03-0{rnd.randint(1, 4)}", rnd.randint(1, 5), rnd.choice([2, None]), value(), rnd.choice([None, 1, 5])) for _ in range(n)]
    data += [("2025-03-01", 9, 2, 12345.678, 1)] * 50 + [("2025-03-01", 10, 2, None, None)] * 3 + [("2025-03-02", 11, 2, 4.25, 0)]
    return spark.createDataFrame(data, FACT)


def test_partials_of_any_split_equal_the_statistics(spark):
    fact = flat(spark).withColumn("part", F.floor(F.rand(4) * 5))
    fact = spark.createDataFrame(fact.collect(), fact.schema)
    whole = rows(op.daily_stats_of_raw_fact(fact, exact=True))
    parts = None
    for i in range(5):
        p = P.partials_of_raw_fact(fact.where(F.col("part") == i))
        parts = p if parts is None else parts.union(p)
    assert rows(P.daily_stats_of_partials(parts, exact=True)) == whole
    assert rows(P.daily_stats_of_partials(P.merge_partials(parts), exact=True)) == whole
    assert P.merge_partials(parts).count() == P.partials_of_raw_fact(fact).count()
    assert rows(P.daily_stats_of_partials(P.partials_of_raw_fact(fact.where("false")))) == []


def test_equal_values_have_no_spread(spark):
    got = P.daily_stats_of_partials(P.partials_of_raw_fact(flat(spark).where("sensor_id = 9"))).first()
    assert got.stddev_value == 0.0 and got.min_value == got.max_value == pytest.approx(got.median_value, rel=1e-6)


def test_late_batches_renew_only_their_days(spark, scratch):
    wh, fact = Warehouse(spark, "path", root=scratch("partials")), flat(spark)
    cut = fact.withColumn("part", F.pmod(F.xxhash64("day", "sensor_id", "value", F.monotonically_increasing_id()), F.lit(3)))
    cut = spark.createDataFrame(cut.collect(), cut.schema)
    for batch in (0, 1, 1, 2):  # a batch that is given again replaces itself
        P.add_batch(wh, cut.where(F.col("part") == batch).drop("part"), batch, exact=True)
    assert rows(wh.read("agg_measurements")) == rows(op.daily_stats_of_raw_fact(fact, exact=True))
    late = spark.createDataFrame([("2025-03-03", 1, 2, 99.0, 1), (None, 1, 2, 1.0, 1)], FACT)
    assert P.add_batch(wh, late, 3, exact=True) == ["2025-03-03"]
    after = rows(op.daily_stats_of_raw_fact(fact.union(late.where("day is not null")), exact=True))
    assert rows(wh.read("agg_measurements")) == after
    assert P.add_batch(wh, late.where("false"), 4) == []
    assert rows(wh.read("agg_measurements")) == after


def test_compacted_days_read_the_same(spark, scratch):
    wh, fact = Warehouse(spark, "path", root=scratch("partials")), flat(spark)
    for batch in range(3):
        P.add_batch(wh, fact.where(F.col("sensor_id") % 3 == batch), batch, stats=None)
    before = rows(P.daily_stats_of_partials(P.live_rows(wh), exact=True))
    folders = wh.read("partial_measurements")
    P.compact_days(wh, ["2025-03-01", "2025-03-02"])
    assert rows(P.daily_stats_of_partials(P.live_rows(wh), exact=True)) == before
    assert {r.day for r in wh.read("partial_measurements").select("day").distinct().collect()} == {"2025-03-03", "2025-03-04"}
    # a job that died after the merged days were written and before the folders went: nothing counts twice
    wh.write(P.partials_of_raw_fact(fact.where("day = '2025-03-01'")).withColumn("batch", F.lit(7).cast("long")), "partial_measurements",
             mode="replace_partitions", partition_by=["day", "batch"])
    assert rows(P.daily_stats_of_partials(P.live_rows(wh), exact=True)) == before
    assert folders.columns[-2:] == ["day", "batch"]


def test_hot_group_sends_its_values_not_its_rows(spark):
    plan = P.partials_of_raw_fact(flat(spark))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan[plan.rindex("Exchange hashpartitioning"):]  # values are counted below the first shuffle


@pytest.mark.parametrize("exact", [True])
def test_stand_in_table(spark, exact):
    fact = op.raw_measurements(A.raw_measurements(spark, SF001).withColumn("day", F.substring_index("period.datetimeFrom.local", "T", 1)), keep=["day"])
    parts = P.partials_of_raw_fact(fact.where("sensor_id % 2 = 0")).union(P.partials_of_raw_fact(fact.where("sensor_id % 2 = 1")))
    assert rows(P.daily_stats_of_partials(parts, exact=exact)) == rows(op.daily_sensor_stats(A.raw_measurements(spark, SF001), exact=exact))
