import duckdb

import __spark_entry__ as E
from tests.conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["day", "sensor_id", "parameter_id", "value", "min_value", "max_value", "stddev_value",
                          "median_value", "observed_count", "expected_count"]


def test_every_report_has_an_oracle():
    from aeris.plans.reports import REPORTS

    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(REPORTS) <= set(o)


def plain(v):
    """A value as both engines give it: doubles to 9 digits, timestamps without a zone."""
    if isinstance(v, float):
        return "nan" if v != v else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def test_oracles_match_at_smallest_scale(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    fast = ["daily_sensor_stats", "parameter_profile", "enriched_measurements", "cities_of_locations", "limits_rows", "limits_document",
            "as_of_locations", "local_days_by_zone", "sensor_outages", "profile_from_sketches", "manifest_files",
            "space_filling_reads", "paged_source_locations", "paged_source_stream"]
    for name in fast:
        df = E.queries()[name](spark, SF001)
        got = sorted(repr([plain(r[c]) for c in sorted(df.columns)]) for r in df.collect())
        rel = con.sql(E.oracle_sql()[name])
        cols = rel.columns
        idx = sorted(range(len(cols)), key=lambda i: cols[i])
        want = sorted(repr([plain(r[i]) for i in idx]) for r in rel.fetchall())
        assert sorted(df.columns) == sorted(cols), name
        assert got == want and (got or name == "cities_of_locations"), name


def test_reports_do_not_depend_on_session_zone(spark):
    names = ["raw_measurements", "locations_dim", "daily_sensor_stats"]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        results = {}
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            results[zone] = {n: sorted(map(repr, E.queries()[n](spark, SF001).collect())) for n in names}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert results["UTC"] == results["America/New_York"] == results["Asia/Kolkata"]
