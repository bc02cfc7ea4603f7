import itertools
import json
import os

import pytest
from pyspark.sql import functions as F

from aeris import adapters as A
from aeris import operators as op
from aeris.operators.partials import live_rows
from aeris.plans.load import Warehouse
from aeris.session import local_fs_path
from aeris.streaming import ledger as L
from tests.conftest import SF001


def land(src, name, days, at, sensor=1):
    path = os.path.join(local_fs_path(src), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    docs = [{"sensor_id": sensor, "value": v, "parameter": {"id": 2}, "period": {"datetimeFrom": {"local": f"{d}T10:00:00Z"}},
             "coverage": {"observedCount": 1}} for d, v in days]
    with open(path, "w") as f:
        f.write(json.dumps({"results": docs}))
    os.utime(path, (at, at))  # the file source reads by time


def run(spark, src, wh, ckpt, manifest, cap=None, **kw):
    q = L.run_ledger_stream(spark, src, wh, ckpt, manifest, max_files_per_trigger=cap, **kw)
    q.awaitTermination()
    return len([p for p in q.recentProgress if p.numInputRows])


def stats(wh):
    return sorted((r.day, r.sensor_id, r.value, r.observed_count) for r in wh.read(L.STATS).collect())


FILES = {"d1": [("2025-03-01", 1.0)], "d13": [("2025-03-01", 3.0), ("2025-03-03", 4.0)], "d2": [("2025-03-02", 2.0)], "d9": [("2025-03-09", 9.0)]}


@pytest.mark.parametrize("cap, order", [(None, ("d9", "d13", "d2", "d1")), (1, ("d9", "d13", "d2", "d1")), (1, ("d1", "d2", "d13", "d9")),
                                        (3, ("d2", "d9", "d1", "d13"))])
def test_any_order_and_batch_size_gives_the_same_days(spark, scratch, order, cap):
    src, wh = scratch("src"), Warehouse(spark, "path", root=scratch("wh"))
    for at, name in enumerate(order):
        land(src, f"{name}.json", FILES[name], 1_700_000_000 + 100 * at)
    n = run(spark, src, wh, scratch("ckpt"), scratch("manifest"), cap)
    assert n == {None: 1, 1: 4, 3: 2}[cap]
    assert stats(wh) == [("2025-03-01", 1, 2.0, 2), ("2025-03-02", 1, 2.0, 1), ("2025-03-03", 1, 4.0, 1)]
    assert L.late_counts(wh).count() == 0


def test_late_rows_are_counted_and_change_nothing(spark, scratch):
    src, ckpt, manifest = scratch("src"), scratch("ckpt"), scratch("manifest")
    wh = Warehouse(spark, "path", root=scratch("wh"))
    for at, name in enumerate(("d9", "d1", "d2")):
        land(src, f"{name}.json", FILES[name], 1_700_000_000 + at)
    run(spark, src, wh, ckpt, manifest, 1)
    before = stats(wh)
    assert [r[0] for r in before] == ["2025-03-01", "2025-03-02"]
    # the 3rd never closed: it had no row; the 1st and 2nd are late now, the 8th and 9th are open
    land(src, "late.json", [("2025-03-01", 100.0), ("2025-03-01", 200.0), ("2025-03-02", 5.0), ("2025-03-03", 6.0), ("2025-03-08", 7.0)], 1_700_000_100)
    run(spark, src, wh, ckpt, manifest, 1)
    assert stats(wh) == before + [("2025-03-03", 1, 6.0, 1)]
    assert sorted((r.day, r.n) for r in L.late_counts(wh).collect()) == [("2025-03-01", 2), ("2025-03-02", 1)]
    land(src, "next.json", [("2025-03-08", 9.0), ("2025-03-12", 1.0)], 1_700_000_200)
    assert run(spark, src, wh, ckpt, manifest, 1) == 1 and run(spark, src, wh, ckpt, manifest, 1) == 0
    assert stats(wh) == before + [("2025-03-03", 1, 6.0, 1), ("2025-03-08", 1, 8.0, 2), ("2025-03-09", 1, 9.0, 1)]
    # days that closed earlier lie in one folder, whatever number of batches brought them; no row is lost or doubled
    assert {r.day for r in wh.read(f"{L.RAW}_merged").select("day").distinct().collect()} == {"2025-03-01", "2025-03-02", "2025-03-03"}
    assert not {r.day for r in wh.read(L.RAW).select("day").distinct().collect()} & {"2025-03-01", "2025-03-02", "2025-03-03"}
    assert sorted(r.value for r in live_rows(wh, L.RAW).collect()) == [1.0, 1.0, 2.0, 6.0, 7.0, 9.0, 9.0]


def test_bad_pages_and_empty_files_hold_nothing_up(spark, scratch):
    src, wh = scratch("src"), Warehouse(spark, "path", root=scratch("wh"))
    land(src, "empty.json", [], 1_700_000_000)
    for name, text in (("broken.json", '{"results": [{"val'), ("odd.json", json.dumps({"results": ["junk", {"value": 1.0}]}))):
        with open(os.path.join(local_fs_path(src), name), "w") as f:
            f.write(text)
        os.utime(os.path.join(local_fs_path(src), name), (1_700_000_001,) * 2)
    land(src, "d.json", [("2025-03-01", 1.0), ("2025-03-05", 1.0)], 1_700_000_002)
    run(spark, src, wh, scratch("ckpt"), scratch("manifest"), 1)
    assert [r[0] for r in stats(wh)] == ["2025-03-01"]
    assert sorted(r.reason for r in wh.read(L.QUARANTINE).collect()) == ["bad_element", "malformed", "no_day"]


def test_a_batch_that_runs_again_replaces_itself(spark, scratch):
    """The stream dies after a batch's tables were written and before it is committed."""
    src, ckpt, manifest = scratch("src"), scratch("ckpt"), scratch("manifest")
    wh = Warehouse(spark, "path", root=scratch("wh"))
    for at, name in enumerate(("d13", "d9", "d1", "d2")):
        land(src, f"{name}.json", FILES[name], 1_700_000_000 + at)
    run(spark, src, wh, ckpt, manifest, 1)
    expected, commits = stats(wh), os.path.join(local_fs_path(ckpt), "commits")
    for last in sorted((f for f in os.listdir(commits) if f.isdigit()), key=int)[-1:]:
        for name in (last, f".{last}.crc"):
            if os.path.exists(os.path.join(commits, name)):
                os.unlink(os.path.join(commits, name))
    assert run(spark, src, wh, ckpt, manifest, 1) == 1
    assert stats(wh) == expected and L.late_counts(wh).count() == 0
    assert live_rows(wh, L.RAW).count() == sum(map(len, FILES.values()))


def test_closable_days(spark):
    files = spark.createDataFrame([("a", "2025-03-01", "2025-03-02"), ("b", "2025-03-02", "2025-03-04"), ("c", None, None), ("d", "2025-03-07", "2025-03-07")],
                                  "file string, min_day string, max_day string")
    stored = spark.createDataFrame([(f"2025-03-0{d}",) for d in (1, 1, 2, 3, 4, 5, 6)], "day string")
    for loaded, lateness in itertools.product(([], ["a"], ["b"], ["a", "b"], ["a", "b", "d"]), (0, 1, 3)):
        got = L.closable_days(files, spark.createDataFrame([(f,) for f in loaded], "file string"), stored, lateness)
        held = {"a": {1, 2}, "b": {2, 3, 4}, "d": {7}}
        expected = {d for d in range(1, 7) if d + 1 + lateness <= 7 and not any(d in held[f] for f in held if f not in loaded)}
        assert {int(r.day[-1]) for r in got.collect()} == expected


def test_closed_days_equal_batch_statistics(spark, scratch):
    src, wh = scratch("src"), Warehouse(spark, "path", root=scratch("wh"))
    A.land_measurements(spark, SF001, src, one_page_per_file=False)
    run(spark, src, wh, scratch("ckpt"), scratch("manifest"), 2, exact=True, layout="lines")
    batch = op.daily_sensor_stats(A.raw_measurements(spark, SF001), exact=True)
    last = batch.agg(F.max("day")).first()[0]
    closed = batch.where(F.date_add(F.col("day").cast("date"), 2) <= F.lit(last).cast("date"))
    got = wh.read(L.STATS).select(*batch.columns)
    assert got.count() == closed.count() > 0 and got.exceptAll(closed).count() == 0
