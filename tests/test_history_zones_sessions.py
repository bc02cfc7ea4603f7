import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from aeris import adapters as A
from aeris import operators as op
from aeris.operators import history as H
from aeris.operators import sessions as S
from aeris.operators import sketches as K
from aeris.operators import zones as Z
from aeris.plans.load import Warehouse
from tests.conftest import SF001

# ---- history


def brute_as_of(loads, key, day):
    """Attributes of a key on a day, from the loads in order: (day, {key: attributes})."""
    held = None
    for since, batch in loads:
        if since <= day and key in batch:
            held = batch[key]
    return held


def test_history_of_random_loads_against_brute_force(spark, scratch):
    rnd = random.Random(7)
    days = [f"2025-03-{d:02d}" for d in (1, 4, 5, 9, 20)]
    loads = [(d, {k: (rnd.choice(["a", "b", None]), rnd.choice([None, "a", "b"])) for k in range(40) if rnd.random() < 0.8}) for d in days]
    wh, hist = Warehouse(spark, "path", root=scratch("h")), None
    for i, (day, batch) in enumerate(loads):
        rows = spark.createDataFrame([(k, *v) for k, v in batch.items()], "k int, name string, note string")
        for again in range(2):  # a load that is run again changes nothing
            out = H.open_history(rows, "k", day) if hist is None else H.merge_history(hist, rows, "k", day)
            wh.write(out, f"h{i}_{again}")
            if i or again:
                hist = wh.read(f"h{i}_{again}")
            else:
                hist = wh.read("h0_0")
    facts = [(k, f"2025-03-{d:02d}", n) for n, (k, d) in enumerate((k, d) for k in range(42) for d in (1, 3, 4, 5, 8, 9, 19, 20, 28))]
    facts += [(None, "2025-03-05", -1), (3, None, -2), (3, "no day", -3)]
    got = H.as_of_join(spark.createDataFrame(facts, "k int, day string, n int"), hist, "k").collect()
    assert len(got) == len(facts)
    for r in got:
        want = brute_as_of(loads, r.k, r.day) if r.n >= 0 else None
        assert (r.name, r.note) == (want or (None, None)), r
    spans = hist.groupBy("k").agg(F.count_if(F.col("valid_to").isNull()).alias("open")).collect()
    assert all(r.open == 1 for r in spans)
    plan = H.as_of_join(spark.createDataFrame(facts, "k int, day string, n int"), hist, "k")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_history_edges(spark):
    first = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (None, "y")], "k int, name string")
    h = H.open_history(first, "k")
    assert sorted((r.k, r.name, r.valid_from) for r in h.collect()) == [(1, "x", None), (2, None, None)]
    assert H.merge_history(h, first.where("false"), "k", "2025-01-01").count() == 2
    closed = H.merge_history(h, spark.createDataFrame([(1, "z")], "k int, name string"), "k", "2025-01-01", absent="close")
    assert sorted((r.k, r.name, str(r.valid_from), str(r.valid_to)) for r in closed.collect()) == [
        (1, "x", "None", "2025-01-01"), (1, "z", "2025-01-01", "None"), (2, None, "None", "2025-01-01")]
    older = H.merge_history(closed, spark.createDataFrame([(1, "old")], "k int, name string"), "k", "2024-06-01")
    assert sorted(map(str, older.collect())) == sorted(map(str, closed.collect()))  # an old load changes nothing that is known since
    # a value that moves to another column is a change
    a, b = (spark.createDataFrame([(1, *v)], "k int, p string, q string") for v in ((None, "v"), ("v", None)))
    assert H.merge_history(H.open_history(a, "k"), b, "k", "2025-01-01").count() == 2
    with pytest.raises(ValueError):
        H.merge_history(h, first, "k", "2025-01-01", absent="drop")


# ---- zones

def test_local_time_against_zoneinfo(spark):
    import zoneinfo

    zones = ["Europe/Paris", "America/New_York", "Australia/Lord_Howe", "Asia/Kathmandu", "America/St_Johns", "UTC", "Africa/Casablanca"]
    rnd = random.Random(3)
    start = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    at = [start + dt.timedelta(seconds=rnd.randrange(366 * 86400), microseconds=rnd.choice([0, 999_999, 123_456])) for _ in range(800)]
    for day in (dt.datetime(2024, 3, 31, tzinfo=dt.UTC), dt.datetime(2024, 10, 27, tzinfo=dt.UTC), dt.datetime(2024, 11, 3, tzinfo=dt.UTC)):
        at += [day + dt.timedelta(minutes=m, seconds=s) for m in range(-180, 1800, 15) for s in (-1, 0, 1)]
    rows = [(i, z, int(t.timestamp()), t.microsecond) for i, t in enumerate(at) for z in zones]
    df = spark.createDataFrame(rows, "i int, zone string, s long, us int").withColumn("t", F.timestamp_micros(F.col("s") * 1_000_000 + F.col("us")))
    table = Z.zone_transitions(df, dt.date(2023, 12, 30), dt.date(2025, 1, 3))
    got = Z.with_local_time(df, table, "t").select("i", "zone", F.col("local_time").cast("string").alias("l"), "local_day").collect()
    assert len(got) == len(rows)
    for r in got:
        want = at[r.i].astimezone(zoneinfo.ZoneInfo(r.zone)).replace(tzinfo=None)
        assert dt.datetime.fromisoformat(r.l) == want and r.local_day == want.date().isoformat(), (r, want)
    spans = table.orderBy("zone", "from_s").collect()
    assert all(a.until_s == b.from_s for a, b in zip(spans, spans[1:]) if a.zone == b.zone)


def test_zones_out_of_the_table(spark):
    rows = spark.createDataFrame([(1, "Nowhere/City"), (2, None), (3, "UTC"), (4, "Europe/Paris")], "i int, zone string")
    rows = rows.withColumn("t", F.timestamp_seconds(F.when(F.col("i") == 3, 0).otherwise(1_710_000_000)))
    table = Z.zone_transitions(rows, dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    got = {r.i: r.local_day for r in Z.with_local_time(rows, table, "t").collect()}
    assert got == {1: None, 2: None, 3: None, 4: "2024-03-09"}
    assert Z.zone_transitions(rows.where("false"), dt.date(2024, 1, 1), dt.date(2024, 12, 31)).count() == 0


# ---- sessions

def test_sessions_and_outages_against_brute_force(spark):
    rnd = random.Random(5)
    start = dt.datetime(2025, 1, 1)
    rows = [(rnd.choice([1, 2, 3, None]), start + dt.timedelta(minutes=rnd.randrange(20_000))) for _ in range(300)]
    rows += [(9, start), (9, start + dt.timedelta(hours=5)), (9, start + dt.timedelta(hours=9)), (9, start + dt.timedelta(hours=9))] + [(7, start)]
    events = spark.createDataFrame(rows, "sensor_id int, event_time timestamp_ntz").withColumn("event_time", F.concat(
        F.col("event_time").cast("string"), F.lit("Z")).cast("timestamp"))
    want = []
    for sensor in {s for s, _ in rows}:
        times, run = sorted(t for s, t in rows if s == sensor), []
        for t in times:
            if run and t - run[-1] > dt.timedelta(hours=5):
                want.append((sensor, run[0], run[-1], len(run)))
                run = []
            run.append(t)
        want.append((sensor, run[0], run[-1], len(run)))
    found = S.sensor_sessions(events, "5 hours")
    flat = found.select("sensor_id", F.col("first_seen").cast("string").alias("a"), F.col("last_seen").cast("string").alias("b"), "measurements")
    assert sorted(map(str, (tuple(r) for r in flat.collect()))) == sorted(str((s, str(a), str(b), n)) for s, a, b, n in want)
    silent = S.outages(found).collect()
    assert len(silent) == len(want) - len({s for s, _ in rows}) and all(r.seconds > 5 * 3600 for r in silent)


# ---- sketches

def test_profile_of_sketches(spark, scratch):
    daily = op.daily_sensor_stats(A.raw_measurements(spark, SF001), exact=True)
    sensors = op.sensors_dim(A.raw_locations(spark, SF001))
    wh = Warehouse(spark, "path", root=scratch("k"))
    for part in ("day < '2024-01-10'", "day >= '2024-01-10'", "day < '2024-01-10'"):  # days that are added again replace themselves
        K.add_days(wh, daily.where(part), sensors)
    want = {r.sensor_parameter_displayName: r for r in op.parameter_profile(daily, sensors, exact=True).collect()}
    got = K.profile_of_sketches(wh.read("profile_sketches"), exact=True).collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r.sensor_parameter_displayName]
        assert (r.avg_completeness_ratio, r.capteurs_inactifs, r.capteurs_sous_80_pct) == (w.avg_completeness_ratio, w.capteurs_inactifs, w.capteurs_sous_80_pct)
        assert abs(r.nb_capteurs - w.nb_capteurs) <= max(1, K.ERROR * w.nb_capteurs)


def test_sketch_error_over_many_sensors(spark):
    """Sixty thousand sensors, a third of all rows one of them, merged over ten days."""
    n = 60_000
    daily = spark.range(3 * n).select(F.concat(F.lit("2025-03-"), F.lpad((F.col("id") % 10 + 1).cast("string"), 2, "0")).alias("day"),
                                      F.when(F.col("id") < n, 0).otherwise(F.col("id") % n).cast("int").alias("sensor_id"),
                                      F.lit(20).cast("long").alias("observed_count"), F.lit(24).alias("expected_count"))
    sensors = spark.range(n).select(F.col("id").cast("int").alias("sensor_id"), F.lit("PM").alias("sensor_parameter_displayName"))
    sketches = K.profile_sketches(daily, sensors)
    row = K.profile_of_sketches(sketches, exact=True).first()
    assert abs(row.nb_capteurs - n) <= K.ERROR * n and row.avg_completeness_ratio == 0.833
    assert sketches.agg(F.max(F.length("sensors_sketch"))).first()[0] < 8192
    assert K.profile_of_sketches(sketches.where("false")).count() == 0
