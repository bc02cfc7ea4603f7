from pyspark.sql import functions as F

from aeris import adapters as A
from aeris import operators as op
from aeris.streaming.daily import run_daily_stats_stream
from tests.conftest import SF001


def test_closed_windows_equal_batch(spark, scratch):
    src, sink, ckpt = scratch("src"), scratch("sink"), scratch("ckpt")
    A.land_measurements(spark, SF001, src)
    q = run_daily_stats_stream(spark, src, sink, ckpt, exact=True)
    q.awaitTermination()
    streamed = spark.read.parquet(sink)
    batch = op.daily_sensor_stats(A.raw_measurements(spark, SF001), exact=True)
    last = batch.agg(F.max("day")).collect()[0][0]
    n = streamed.count()
    assert 0 < n < batch.count()
    cols = [c for c in batch.columns]
    closed = batch.join(streamed.select("day").distinct(), "day", "left_semi")
    assert streamed.select(*cols).exceptAll(closed.select(*cols)).count() == 0
    assert closed.count() == n
    assert streamed.where(F.col("day") == last).count() == 0  # the open window is not written


def test_restart_is_exactly_once(spark, scratch):
    src, sink, ckpt = scratch("src"), scratch("sink"), scratch("ckpt")
    A.land_measurements(spark, SF001, src)
    run_daily_stats_stream(spark, src, sink, ckpt).awaitTermination()
    n = spark.read.parquet(sink).count()
    run_daily_stats_stream(spark, src, sink, ckpt).awaitTermination()  # nothing new: nothing rewritten
    assert spark.read.parquet(sink).count() == n


def test_late_rows_after_the_watermark_are_dropped(spark, scratch):
    import json
    import os

    from aeris.session import local_fs_path

    src, sink, ckpt = scratch("src"), scratch("sink"), scratch("ckpt")

    def doc(day, hour, value):
        return {"sensor_id": 1, "value": value, "parameter": {"id": 2},
                "period": {"datetimeFrom": {"local": f"2025-03-{day:02d}T{hour:02d}:00:00+01:00"}},
                "coverage": {"observedCount": 1}}

    def land(name, docs):
        os.makedirs(local_fs_path(src), exist_ok=True)
        with open(os.path.join(local_fs_path(src), name), "w") as f:
            f.write(json.dumps({"results": docs}))

    land("a.json", [doc(1, 10, 1.0), doc(1, 11, 3.0), doc(5, 10, 7.0)])  # watermark → 03-04T10
    run_daily_stats_stream(spark, src, sink, ckpt).awaitTermination()
    land("b.json", [doc(1, 12, 100.0), doc(6, 10, 8.0)])  # day 1 is late now; day 6 advances the clock
    run_daily_stats_stream(spark, src, sink, ckpt).awaitTermination()
    got = {str(r.day): r for r in spark.read.parquet(sink).collect()}
    assert got["2025-03-01"].value == 2.0 and got["2025-03-01"].observed_count == 2  # the late 100.0 was dropped, day 1 written once
    assert "2025-03-06" not in got  # still open


def _land(src, name, docs):
    import json
    import os

    from aeris.session import local_fs_path

    path = os.path.join(local_fs_path(src), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(docs if isinstance(docs, str) else json.dumps({"results": docs}))


def _doc(local, value, **more):
    return {"value": value, "parameter": {"id": 2}, "period": {"datetimeFrom": {"local": local}}, "coverage": {"observedCount": 1}, **more}


def test_fact_stream_in_bounded_batches(spark, scratch):
    """Whatever the order and number of batches, the fact stream has every row; the watermarked one takes no bound."""
    import inspect

    from aeris.plans.load import Warehouse
    from aeris.streaming import run_daily_fact_stream

    assert "max_files_per_trigger" not in inspect.signature(run_daily_stats_stream).parameters
    src = scratch("src")
    for day in (9, 3, 1, 2):
        _land(src, f"d{day}.json", [_doc(f"2025-03-0{day}T10:00:00Z", float(day), sensor_id=1), _doc("2025-03-05T10:00:00Z", float(day), sensor_id=1)])
    for cap, n in ((None, 1), (1, 4)):
        wh, ckpt = Warehouse(spark, "path", root=scratch("wh")), scratch("ckpt")
        q = run_daily_fact_stream(spark, src, wh, ckpt, max_files_per_trigger=cap)
        q.awaitTermination()
        assert len([p for p in q.recentProgress if p.numInputRows]) == n
        assert sorted((r.day, r.value) for r in wh.read("stream_agg_measurements").collect()) == [
            ("2025-03-01", 1.0), ("2025-03-02", 2.0), ("2025-03-03", 3.0), ("2025-03-05", 3.75), ("2025-03-09", 9.0)]


def test_event_times_of_any_precision(spark, scratch):
    src, sink, ckpt = scratch("src"), scratch("sink"), scratch("ckpt")
    docs = [_doc(t, 1.0, sensor_id=i) for i, t in enumerate(("2025-03-01T10:00:00+01:00", "2025-03-01T10:00", "2025-03-01", "2025-03-01T10:00:00.123Z"))]
    _land(src, "a.json", docs + [_doc("2025-03-09T00:00:00Z", 1.0, sensor_id=9)])
    run_daily_stats_stream(spark, src, sink, ckpt).awaitTermination()
    assert sorted((str(r.day), r.sensor_id) for r in spark.read.parquet(sink).collect()) == [("2025-03-01", i) for i in range(4)]


def test_fact_stream_keeps_sensors_late_rows_and_bad_pages(spark, scratch):
    from aeris.plans.load import Warehouse
    from aeris.streaming import run_daily_fact_stream

    src, ckpt = scratch("src"), scratch("ckpt")
    wh = Warehouse(spark, "path", root=scratch("wh"))
    run = lambda: run_daily_fact_stream(spark, src, wh, ckpt).awaitTermination()
    _land(src, "sensor_id=7/a.json", [_doc("2025-03-01T10:00:00Z", 5.0), _doc(None, 1.0)])
    _land(src, "sensor_id=8/a.json", [_doc("2025-03-01T10:00:00Z", 9.0), _doc("2025-03-09T10:00", 1.0, sensor_id=70), "junk"])
    run()
    _land(src, "sensor_id=7/b.json", [_doc("2025-03-01T11:00:00Z", 7.0)])  # far behind the latest day
    _land(src, "sensor_id=7/c.json", '{"results": [{"val')
    run()
    run()  # nothing new
    got = {(r.day, r.sensor_id): r.value for r in wh.read("stream_agg_measurements").collect()}
    assert got == {("2025-03-01", 7): 6.0, ("2025-03-01", 8): 9.0, ("2025-03-09", 70): 1.0}
    assert sorted(r.reason for r in wh.read("stream_quarantine_pages").collect()) == ["bad_element", "malformed", "no_day"]
