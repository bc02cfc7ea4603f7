"""Property tests: many random inputs per Spark job, checked against plain Python."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aeris.functions import text as X
from aeris.functions.time import day_text, local_timestamp

SETTINGS = settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))

stamps = st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2040, 12, 31)).map(
    lambda d: d.replace(microsecond=0))
offsets = st.one_of(
    st.just(""), st.just("Z"),
    st.tuples(st.sampled_from("+-"), st.integers(0, 14), st.sampled_from([0, 30, 45])).map(
        lambda t: f"{t[0]}{t[1]:02d}:{t[2]:02d}"),
)


@SETTINGS
@given(st.lists(st.tuples(stamps, offsets), min_size=30, max_size=80))
def test_local_timestamp_matches_python(spark, cases):
    texts = [d.strftime("%Y-%m-%dT%H:%M:%S") + o for d, o in cases]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = df.select("i", local_timestamp(F.col("s"), "reference").alias("r"),
                    local_timestamp(F.col("s"), "wall_clock").alias("w"), day_text(F.col("s")).alias("d")).collect()
    for row in got:
        wall, off = cases[row.i]
        assert row.w == wall
        assert row.d == wall.date().isoformat()
        if off.startswith("+"):
            h, m = int(off[1:3]), int(off[4:6])
            assert row.r == wall - dt.timedelta(hours=h, minutes=m)
        else:
            assert row.r == wall


alphabet = st.sampled_from(list("ABCHÈ (),.25 6\n \t") + ["CH66", "ch₆₆", "PM2,5", "µg/m³", "(FR)", "(UE)"])
texts = st.lists(alphabet, max_size=14).map("".join)


@SETTINGS
@given(st.lists(texts, min_size=30, max_size=60))
def test_text_functions_invariants(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    once = df.select("i", X.component_name(F.col("s")).alias("c"), X.measurement_values(F.col("s")).alias("v"),
                     X.measurement_origins(F.col("s")).alias("o"), X.clean_field(F.col("s")).alias("f"))
    twice = once.select("i", "c", X.component_name(F.col("c")).alias("cc"))
    for r in once.collect():
        assert "\n" not in r.v and r.v == r.v.strip(" ")  # values are whitespace-normalised
        assert set(r.o.replace(" ; ", "")) <= set("FRUE") and len(r.o) % 5 in (0, 2)  # FR / UE joined by " ; "
        assert "\n" not in r.f and r.f == r.f.strip()
    for r in twice.collect():
        assert r.c == r.cc  # normalising a normalised name changes nothing


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 60), st.one_of(st.none(), st.sampled_from("abc"))),
                min_size=1, max_size=80, unique_by=lambda t: (t[0], t[1])),
       st.integers(1, 9))
def test_fill_forward_matches_running_last(spark, rows, bucket):
    from aeris.operators.limits import fill_forward

    df = spark.createDataFrame(rows, "k int, pos int, v string")
    got = {(r.k, r.pos): r.f for r in fill_forward(df, "k", "pos", F.col("v"), "f", bucket_rows=bucket).collect()}
    want, last = {}, {}
    for k, pos, v in sorted(rows):
        if v is not None:
            last[k] = v
        want[(k, pos)] = last.get(k)
    assert got == want


def _inside(ring, x, y):
    """Plain crossing-number test (left/bottom edges inside, right/top outside)."""
    inside = False
    n = len(ring)
    for i in range(n):
        ax, ay = ring[i]
        bx, by = ring[i - 1]
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            inside = not inside
    return inside if n >= 3 else False


coords = st.integers(-20, 20).map(lambda v: v / 4)


@SETTINGS
@given(st.lists(st.tuples(st.lists(st.tuples(coords, coords), min_size=0, max_size=7), coords, coords),
                min_size=20, max_size=60))
def test_point_in_ring_matches_python(spark, cases):
    from aeris.functions.geometry import point_in_ring

    rows = [(i, [{"x": a, "y": b} for a, b in ring], x, y) for i, (ring, x, y) in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, ring array<struct<x:double,y:double>>, x double, y double")
    got = {r.i: r.inside for r in df.select("i", point_in_ring(F.col("ring"), F.col("x"), F.col("y")).alias("inside"))
           .collect()}
    for i, (ring, x, y) in enumerate(cases):
        assert got[i] == _inside(ring, x, y), (ring, x, y)
