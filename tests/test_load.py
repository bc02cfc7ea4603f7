import pytest
from pyspark.sql import functions as F

from aeris.plans.load import Warehouse, job_group, load_step


def _facts(spark, days, v=1.0):
    return spark.createDataFrame([(d, s, v) for d in days for s in (1, 2)], "day string, sensor_id int, value double")


def test_dimension_create_then_skip(spark, scratch):
    wh = Warehouse(spark, "path", root=scratch("wh"))
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([(1, "a")], "k int, v string")

    r1 = load_step(wh, "dim", build)
    r2 = load_step(wh, "dim", build)
    r3 = load_step(wh, "dim", build, refresh=True)
    assert (r1.action, r2.action, r3.action) == ("created", "skipped", "refreshed")
    assert len(calls) == 2 and r2.rows == 1


def test_fact_replace_is_idempotent(spark, scratch):
    wh = Warehouse(spark, "path", root=scratch("wh"))
    kw = {"kind": "fact", "partition_by": ["day"]}
    load_step(wh, "f", lambda: _facts(spark, ["2025-03-01", "2025-03-02"]), **kw)
    r = load_step(wh, "f", lambda: _facts(spark, ["2025-03-02"], v=2.0), **kw)
    assert r.action == "replaced" and r.rows == 4
    got = {(x.day, x.sensor_id): x.value for x in wh.read("f").collect()}
    assert got[("2025-03-01", 1)] == 1.0 and got[("2025-03-02", 1)] == 2.0
    assert dict(wh.read("f").dtypes)["day"] == "string"


def test_fact_plain_append_duplicates(spark, scratch):
    wh = Warehouse(spark, "path", root=scratch("wh"))
    kw = {"kind": "fact", "partition_by": ["day"], "fact_mode": "append"}
    load_step(wh, "f", lambda: _facts(spark, ["2025-03-01"]), **kw)
    r = load_step(wh, "f", lambda: _facts(spark, ["2025-03-01"]), **kw)
    assert r.action == "appended" and r.rows == 4


def test_fact_merge_keeps_old_rows_of_the_day(spark, scratch):
    wh = Warehouse(spark, "path", root=scratch("wh"))
    kw = {"kind": "fact", "partition_by": ["day"], "fact_mode": "merge", "merge_keys": ["day", "sensor_id"]}
    load_step(wh, "f", lambda: _facts(spark, ["2025-03-01"]), **kw)
    late = spark.createDataFrame([("2025-03-01", 2, 9.0), ("2025-03-01", 3, 9.0)], "day string, sensor_id int, value double")
    r = load_step(wh, "f", lambda: late, **kw)
    got = {x.sensor_id: x.value for x in wh.read("f").collect()}
    assert r.action == "merged" and got == {1: 1.0, 2: 9.0, 3: 9.0}


def test_empty_partitioned_batch_keeps_schema(spark, scratch):
    wh = Warehouse(spark, "path", root=scratch("wh"))
    empty = spark.createDataFrame([], "day string, x int")
    r = load_step(wh, "q", lambda: empty, kind="fact", partition_by=["day"])
    assert r.rows == 0 and sorted(wh.read("q").columns) == ["day", "x"]
    assert wh.exists("q")


def test_existence_errors_propagate(spark, scratch):
    class Broken(Warehouse):
        def exists(self, name):
            raise RuntimeError("catalog unreachable")

    wh = Broken(spark, "path", root=scratch("wh"))
    with pytest.raises(RuntimeError):
        load_step(wh, "dim", lambda: spark.range(1))
    assert not Warehouse(spark, "path", root=wh.root).exists("dim")


def test_catalog_backend(spark, scratch):
    db = "aeris_test_db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch('db')}'")
    wh = Warehouse(spark, "catalog", database=db)
    spark.sql(f"DROP TABLE IF EXISTS {db}.f")
    kw = {"kind": "fact", "partition_by": ["day"]}
    load_step(wh, "f", lambda: _facts(spark, ["2025-03-01", "2025-03-02"]), **kw)
    r = load_step(wh, "f", lambda: _facts(spark, ["2025-03-02"], v=5.0), **kw)
    assert r.action == "replaced" and r.rows == 4
    assert wh.read("f").where(F.col("value") == 5.0).count() == 2


def test_export_csv(spark, scratch):
    wh = Warehouse(spark, "path", root=scratch("wh"))
    wh.write(_facts(spark, ["2025-03-01"]), "f")
    out = scratch("csv")
    wh.export("f", out)
    back = spark.read.option("header", True).schema(wh.read("f").schema).csv(out)
    assert back.exceptAll(wh.read("f")).count() == 0 and back.count() == 2


def test_merge_keeps_the_rows_of_a_null_day(spark, scratch):
    wh = Warehouse(spark, "path", root=scratch("wh"))
    kw = {"kind": "fact", "partition_by": ["day"], "fact_mode": "merge", "merge_keys": ["day", "sensor_id"]}
    rows = lambda *r: (lambda: spark.createDataFrame(list(r), "day string, sensor_id int, value double"))
    load_step(wh, "f", rows((None, 1, 1.0), ("2025-03-01", 1, 1.0), ("2025-03-02", 1, 1.0)), **kw)
    load_step(wh, "f", rows((None, 2, 2.0), ("2025-03-01", 1, 3.0)), **kw)
    got = sorted(((r.day or "", r.sensor_id, r.value) for r in wh.read("f").collect()))
    assert got == [("", 1, 1.0), ("", 2, 2.0), ("2025-03-01", 1, 3.0), ("2025-03-02", 1, 1.0)]


def test_merge_window_prunes_the_stored_partitions(spark, scratch):
    from aeris.plans.load import _merge_with_stored, _within
    from tests.test_plans import plan

    wh = Warehouse(spark, "path", root=scratch("wh"))
    wh.write(_facts(spark, ["2025-03-01", "2025-03-02", "2025-03-03"]), "f", partition_by=["day"])
    p = plan(_within(wh.read("f"), "day", ("2025-03-02", "2025-03-03")))
    scan = next(line for line in p.splitlines() if line.startswith("PartitionFilters"))
    assert ">= 2025-03-02" in scan and "< 2025-03-03" in scan
    merged = _merge_with_stored(wh, "f", _facts(spark, ["2025-03-02"], 5.0), ["day"], ["day", "sensor_id"], ("2025-03-02", "2025-03-03"))
    assert sorted((r.day, r.value) for r in merged.collect()) == [("2025-03-02", 5.0)] * 2
    with pytest.raises(ValueError, match="outside"):
        _merge_with_stored(wh, "f", _facts(spark, ["2025-03-01"]), ["day"], ["day", "sensor_id"], ("2025-03-02", "2025-03-03"))


def test_replacing_a_window_removes_its_emptied_days(spark, scratch):
    wh = Warehouse(spark, "path", root=scratch("wh"))
    kw = {"kind": "fact", "partition_by": ["day"], "window": ("2025-03-01", "2025-03-03")}
    load_step(wh, "f", lambda: _facts(spark, ["2025-03-01", "2025-03-02", "2025-03-03"]), kind="fact", partition_by=["day"])
    load_step(wh, "f", lambda: _facts(spark, ["2025-03-02"], 2.0), **kw)
    assert sorted({(r.day, r.value) for r in wh.read("f").collect()}) == [("2025-03-02", 2.0), ("2025-03-03", 1.0)]
    load_step(wh, "f", lambda: _facts(spark, []), **kw)
    assert {r.day for r in wh.read("f").collect()} == {"2025-03-03"}


def test_catalog_window_and_session_setting(spark, scratch):
    db = "aeris_window_db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch('db')}'")
    wh = Warehouse(spark, "catalog", database=db)
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "static")
    try:
        load_step(wh, "w", lambda: _facts(spark, ["2025-03-01", "2025-03-02", "2025-03-03"]), kind="fact", partition_by=["day"])
        load_step(wh, "w", lambda: _facts(spark, ["2025-03-02"], 2.0), kind="fact", partition_by=["day"],
                  window=("2025-03-01", "2025-03-03"))
        assert spark.conf.get(key) == "static"
        assert sorted({(r.day, r.value) for r in wh.read("w").collect()}) == [("2025-03-02", 2.0), ("2025-03-03", 1.0)]
    finally:
        spark.conf.set(key, before)
        spark.sql(f"DROP TABLE IF EXISTS {db}.w")


def test_a_batch_with_other_columns(spark, scratch):
    wh = Warehouse(spark, "path", root=scratch("wh"))
    kw = {"kind": "fact", "partition_by": ["day"]}
    load_step(wh, "f", lambda: _facts(spark, ["2025-03-01"]), **kw)
    load_step(wh, "f", lambda: _facts(spark, ["2025-03-02"]).withColumn("extra", F.lit("new")), **kw)
    got = {r.day: r.extra for r in wh.read("f").collect()}
    assert got == {"2025-03-01": None, "2025-03-02": "new"}
    with pytest.raises(ValueError, match="value"):
        load_step(wh, "f", lambda: _facts(spark, ["2025-03-03"]).withColumn("value", F.lit("text")), **kw)


def test_files_of_a_day_follow_its_size(spark, scratch):
    import os

    from aeris.session import local_fs_path

    wh = Warehouse(spark, "path", root=scratch("wh"))
    days = [f"2025-03-{d:02d}" for d in range(1, 32)]
    wh.write(_facts(spark, days).repartition(8), "f", partition_by=["day"], cluster_by=["sensor_id"])
    files = [f for d, _, names in os.walk(local_fs_path(wh.location("f"))) for f in names if f.endswith(".parquet")]
    assert len(files) <= 2 * len(days)  # not tasks x days


def test_custom_writer(spark, scratch):
    seen = []
    wh = Warehouse(spark, "path", root=scratch("wh"))

    def writer(df, name):
        seen.append(name)
        wh.write(df, name)

    assert load_step(wh, "d", lambda: spark.range(3).toDF("k"), writer=writer).rows == 3 and seen == ["d"]


def test_jobs_of_a_step_carry_its_label(spark, scratch):
    from aeris.plans.load import Warehouse, job_group, load_step

    wh, tracker = Warehouse(spark, "path", root=scratch("wh")), spark.sparkContext.statusTracker()
    load_step(wh, "labelled_step", lambda: spark.range(10).toDF("k"))
    assert len(tracker.getJobIdsForGroup("labelled_step")) >= 1
    before = list(tracker.getJobIdsForGroup("labelled_step"))
    spark.range(5).count()  # after the step, jobs have no label
    assert list(tracker.getJobIdsForGroup("labelled_step")) == before


def test_job_group_labels_the_jobs_of_a_step_and_no_others(spark):
    sc = spark.sparkContext
    tracker = sc.statusTracker()
    with pytest.raises(ValueError), job_group(spark, "aeris-step", "one step"):
        assert sc.getLocalProperty("spark.jobGroup.id") == "aeris-step"
        assert sc.getLocalProperty("spark.job.description") == "one step"
        spark.range(3).collect()
        raise ValueError  # a step that fails gives its label back as well
    labelled = len(tracker.getJobIdsForGroup("aeris-step"))
    assert labelled >= 1 and sc.getLocalProperty("spark.jobGroup.id") is None
    spark.range(3).collect()
    assert len(tracker.getJobIdsForGroup("aeris-step")) == labelled
