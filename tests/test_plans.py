"""Physical-plan properties the engine relies on at scale."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from aeris import adapters as A
from aeris import operators as op
from aeris.plans.load import Warehouse
from tests.conftest import SF001


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def operators(p: str, name: str) -> int:
    """Number of ``name`` operators in the formatted plan's detail section."""
    return len(re.findall(rf"^\(\d+\) {name}\b", p, flags=re.M))


def test_daily_stats_single_exchange_no_sort(spark):
    p = plan(op.daily_sensor_stats(A.raw_measurements(spark, SF001)))
    assert operators(p, "Exchange") == 1  # the one aggregation shuffle (the stand-in input is materialized)
    assert "hashpartitioning(day" in p and "rangepartitioning" not in p and "Sort " not in p
    assert "partial_percentile" in p and "partial_avg" in p  # map-side combine


def test_filter_pushdown_and_partition_pruning(spark, scratch):
    wh = Warehouse(spark, "path", root=scratch("wh"))
    wh.write(op.locations_dim(A.raw_locations(spark, SF001)), "world_locations")
    p = plan(op.active_locations(wh.read("world_locations"), 22, "2001-01-01"))
    assert "PushedFilters: [IsNotNull(location_country_id), IsNotNull(location_datetime_last_local), " \
           "EqualTo(location_country_id,22), GreaterThanOrEqual(location_datetime_last_local," in p
    wh.write(op.daily_sensor_stats(A.raw_measurements(spark, SF001)), "agg", partition_by=["day"])
    p = plan(op.measurements_between(wh.read("agg"), "2024-01-10", "2024-01-12", column="day"))
    assert "PartitionFilters: [isnotnull(day" in p and "(day#" in p and ">= 2024-01-10" in p


def test_nested_column_pruning_through_explode(spark, scratch):
    wh = Warehouse(spark, "path", root=scratch("wh"))
    wh.write(A.raw_locations(spark, SF001), "raw_locations")
    p = plan(op.sensors_dim(wh.read("raw_locations")))
    read = [line for line in p.splitlines() if line.startswith("ReadSchema")][0]
    assert "struct<id:int,sensors:array<struct<id:int,name:string,parameter:struct<id:int,displayName:string>>>>" in read
    assert "coordinates" not in read and "units" not in read


def test_dimension_joins_leave_the_choice_to_the_planner(spark):
    """No hint, no check that runs a job while the plan is built, and the small side broadcast from its known size."""
    raw = A.raw_locations(spark, SF001)
    locations = op.active_locations(op.locations_dim(raw), 22, "2001-01-01")
    for stand_in in (A.raw_measurements, A.communes):  # inputs are built by jobs of their own
        stand_in(spark, SF001)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-building", "")
    try:
        joined = [op.country_sensors(op.sensors_dim(raw), locations),
                  op.measurements_of_sensors(A.raw_measurements(spark, SF001), op.sensors_dim(raw)),
                  op.assign_communes(op.location_points(op.locations_dim(raw)), A.communes(spark, SF001), cell_size=0.5)]
        assert len(tracker.getJobIdsForGroup("plan-building")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for df in joined:
        assert "strategy=" not in df._jdf.queryExecution().analyzed().toString()
        assert "SinglePartition" not in plan(df)
    assert "BroadcastHashJoin" in plan(joined[0])


def test_reports_scan_stored_inputs_with_pushed_filters(spark):
    import __spark_entry__ as E

    p = plan(E.queries()["sensors_dim"](spark, SF001))
    read = next(line for line in p.splitlines() if line.startswith("ReadSchema"))
    assert "sensors" in read and "coordinates" not in read and "ExistingRDD" not in p
    p = plan(E.queries()["measurements_of_run"](spark, SF001))
    assert "Scan parquet" in p and "units" not in p.split("ReadSchema")[1].split("coverage")[0].split("parameter")[0]


def test_no_python_in_any_report(spark):
    from aeris.plans.reports import REPORTS

    skip = {"etl_agg_measurements", "etl_france_sensors", "load_create_skip_append", "stream_daily_stats", "stream_closed_days",
            "merge_late_rows", "landing_reconciliation", "folder_keyed_measurements", "incremental_daily_stats", "stream_ledger_days",
            "stream_late_rows", "stream_sessions", "paged_source_stream"}
    for name, fn in REPORTS.items():
        if name in skip:
            continue
        p = plan(fn(spark, SF001))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p, name


def test_limits_one_shuffle_by_table(spark):
    from aeris.operators.limits import limit_rows

    p = plan(limit_rows(A.limit_cells(spark, SF001)))
    assert "hashpartitioning(table_no" in p


def test_fact_files_are_clustered_for_row_group_skipping(spark, scratch):
    wh = Warehouse(spark, "path", root=scratch("wh"))
    daily = op.daily_sensor_stats(A.raw_measurements(spark, SF001))
    wh.write(daily, "agg", partition_by=["day"], cluster_by=["sensor_id"])
    p = plan(wh.read("agg").where(F.col("sensor_id") == 42))
    assert "PushedFilters: [IsNotNull(sensor_id), EqualTo(sensor_id,42)]" in p
    assert wh.read("agg").count() == daily.count()
