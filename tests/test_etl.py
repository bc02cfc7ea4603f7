from pyspark.sql import functions as F

from aeris import adapters as A
from aeris import operators as op
from aeris.plans.etl import run_daily_etl
from aeris.plans.load import Warehouse
from tests.conftest import SF001, SF01


def _run(spark, landing, wh):
    return run_daily_etl(spark, landing, wh, run_date="2024-02-01", window=("2024-01-01", "2024-02-01"),
                         country_id=22, since="2001-01-01", cell_size=0.5, exact=True)


def test_etl_twice_is_idempotent(spark, scratch):
    sf = SF01  # country 22 has stations with measurements from sf0.01 on
    landing = A.land_all(spark, sf, scratch("landing"))
    A.land_broken_location_pages(spark, sf, landing.locations, every=7)
    wh = Warehouse(spark, "path", root=scratch("wh"))
    first = _run(spark, landing, wh)
    assert {r.action for r in first.values()} == {"created"}
    second = _run(spark, landing, wh)
    for name, r in second.items():
        # a location page is quarantined, so what is built from locations is built again
        again = ("world_locations", "world_sensors", "france_locations", "france_sensors", "france_cities_sensors")
        want = "replaced" if name in ("raw_measurements", "agg_measurements", "quarantine_pages") else \
            "refreshed" if name in again else "skipped"
        assert r.action == want, name
        assert r.rows == first[name].rows, name
    # facts equal the operators applied directly to the stand-in documents
    raw = A.raw_measurements(spark, sf)
    sensors = wh.read("france_sensors")
    direct = op.daily_sensor_stats(op.measurements_of_sensors(raw, sensors), exact=True)
    stored = wh.read("agg_measurements").select(*direct.columns)
    assert stored.count() == direct.count() > 0
    assert stored.exceptAll(direct).count() == 0
    q = wh.read("quarantine_pages")
    assert q.where(F.col("source") == "locations").count() == 1  # page 0 of pages 0-1
    assert q.where(F.col("reason") != "malformed").count() == 0
    # stations geocoded: every active location has exactly one city row
    assert wh.read("france_cities_sensors").count() == wh.read("france_locations").count()


def test_etl_small_input_runs(spark, scratch):
    landing = A.land_all(spark, SF001, scratch("landing"))
    res = _run(spark, landing, Warehouse(spark, "path", root=scratch("wh")))
    assert res["world_locations"].rows == 150 and res["agg_measurements"].rows == 0


def test_command_line_entry(spark, scratch, capsys):
    from aeris.__main__ import main

    root = scratch("landing")
    A.land_all(spark, SF001, root)
    wh = scratch("wh")
    args = ["--landing", root, "--warehouse", wh, "--run-date", "2024-02-01", "--start", "2024-01-01",
            "--end", "2024-02-01", "--since", "2001-01-01", "--cell-size", "0.5"]
    assert main(args, spark=spark) == 0
    out = capsys.readouterr().out
    assert "agg_measurements" in out and "created" in out
    assert main(args, spark=spark) == 0
    assert "skipped" in capsys.readouterr().out
    assert Warehouse(spark, "path", root=wh).read("world_locations").count() == 150


def test_etl_over_json_lines_landing(spark, scratch):
    a = A.land_all(spark, SF01, scratch("pages"))
    b = A.land_all(spark, SF01, scratch("lines"), one_page_per_file=False)
    assert (a.layout, b.layout) == ("page", "lines")
    wa, wb = Warehouse(spark, "path", root=scratch("wa")), Warehouse(spark, "path", root=scratch("wb"))
    ra, rb = _run(spark, a, wa), _run(spark, b, wb)
    for name in ("world_locations", "world_sensors", "france_sensors", "agg_measurements"):
        ta, tb = ra[name].table, rb[name].table
        assert ta.count() == tb.count() > 0, name
        assert ta.exceptAll(tb.select(*ta.columns)).count() == 0, name


def _page(spark, path, docs, name="p.json"):
    import json
    import os

    from aeris.session import local_fs_path

    os.makedirs(local_fs_path(path), exist_ok=True)
    with open(os.path.join(local_fs_path(path), name), "w", encoding="utf-8") as f:
        f.write(docs if isinstance(docs, str) else json.dumps({"results": docs}))


def _small_landing(spark, root, **measurements):
    """One station with sensors 7 and 8, and measurement pages {folder under measurements: documents}."""
    from aeris.plans.etl import Landing

    for name in ("parameters", "countries", "providers"):
        _page(spark, f"{root}/{name}", [{"id": 1, "name": name}])
    _page(spark, f"{root}/locations", [{"id": 1, "name": "a", "country": {"id": 22}, "datetimeLast": {"local": "2025-03-01T00:00:00Z"},
                                        "sensors": [{"id": 7, "name": "s7"}, {"id": 8, "name": "s8"}]}])
    for folder, docs in measurements.items():
        _page(spark, f"{root}/measurements/{folder.replace('__', '/').replace('_eq_', '=').replace('_d_', '-')}", docs)
    return Landing(*[f"{root}/{x}" for x in ("parameters", "countries", "providers", "locations", "measurements")])


def _doc(local, value=1.0, **more):
    return {"value": value, "parameter": {"id": 2}, "period": {"datetimeFrom": {"local": local}}, **more}


def test_only_the_needed_folders_are_parsed(spark, scratch):
    root = scratch("landing")
    landing = _small_landing(spark, root, **{
        "fetch_date_eq_2025_d_03_d_02__sensor_id_eq_7": [_doc("2025-03-01T10:00:00Z")],
        "fetch_date_eq_2025_d_03_d_02__sensor_id_eq_9": [_doc("2025-03-01T10:00:00Z", 9.0)],  # not selected
        "fetch_date_eq_2025_d_03_d_05__sensor_id_eq_7": [_doc("2025-03-04T10:00:00Z", 5.0)],  # landed after the run
        "fetch_date_eq_2024_d_03_d_02__sensor_id_eq_7": "broken page of another year"})
    wh = Warehouse(spark, "path", root=scratch("wh"))
    run_daily_etl(spark, landing, wh, run_date="2025-03-02", since="2025-01-01")
    staged = wh.read("staged_measurements")
    assert [(r.sensor_id__key, str(r.fetch_date)) for r in staged.collect()] == [(7, "2025-03-02")]
    assert wh.read("quarantine_pages").count() == 0 and wh.read("raw_measurements").count() == 1
    # a second run over the grown landing reads only its own folders, and its scan prunes them
    res = run_daily_etl(spark, landing, wh, run_date="2025-03-05", window=("2025-03-04", "2025-03-05"), since="2025-01-01")
    assert [str(r.fetch_date) for r in wh.read("staged_measurements").collect()] == ["2025-03-05"]
    assert sorted(r.day for r in res["agg_measurements"].table.collect()) == ["2025-03-01", "2025-03-04"]
    from aeris import schemas
    from aeris.plans.etl import _needed
    from aeris.sources import landed
    from tests.test_plans import plan

    p = plan(landed.parse_pages(spark, landing.measurements, schemas.MEASUREMENT, "page",
                                _needed("2025-03-04", "2025-03-05", wh.read("france_sensors"))))
    scan = next(line for line in p.splitlines() if line.startswith("PartitionFilters") and "fetch_date" in line)
    assert ">= 2025-03-04" in scan and "<= 2025-03-05" in scan


def test_documents_with_a_key_of_their_own_are_not_lost_with_their_folder(spark, scratch):
    root = scratch("landing")
    escaped = '{"results": [' + '{"sensor\\u005fid": 8, "value": 4.0, "parameter": {"id": 2}, "period": {"datetimeFrom": {"local": "2025-03-01T13:00:00Z"}}}]}'
    landing = _small_landing(spark, root, **{
        "fetch_date_eq_2025_d_03_d_02__sensor_id_eq_9": [_doc("2025-03-01T10:00:00Z", 1.0, sensor_id=7), _doc("2025-03-01T10:00:00Z", 9.0)],
        "fetch_date_eq_2025_d_03_d_02__sensor_id_eq_10": [_doc("2025-03-01T10:00:00Z", 9.0)],
        "fetch_date_eq_2025_d_03_d_02__sensor_id_eq_11": escaped,
        "fetch_date_eq_2025_d_03_d_02__sensor_id_eq_x": [_doc("2025-03-01T11:00:00Z", 2.0, sensor_id=8), _doc("2025-03-01T11:00:00Z", 9.0)]})
    _page(spark, f"{landing.measurements}/fetch_date=__HIVE_DEFAULT_PARTITION__/sensor_id=7", [_doc("2025-03-01T12:00:00Z", 3.0)])
    wh = Warehouse(spark, "path", root=scratch("wh"))
    run_daily_etl(spark, landing, wh, run_date="2025-03-02", since="2025-01-01")
    assert sorted((r.sensor_id, r.value) for r in wh.read("raw_measurements").collect()) == [(7, 1.0), (7, 3.0), (8, 2.0), (8, 4.0)]
    assert [(r.source, r.reason) for r in wh.read("quarantine_pages").collect()] == [("measurements", "no_sensor")]
    assert 10 not in {int(r.sensor_id__key) for r in wh.read("staged_measurements").where("sensor_id__key <> 'x'").collect()}


def test_days_without_a_date_are_quarantined_and_emptied_days_removed(spark, scratch):
    root = scratch("landing")
    landing = _small_landing(spark, root, sensor_id_eq_7=[
        _doc("2025-03-01T10:00"), _doc(None), _doc("soon"), _doc("2025-02-27T10:00:00Z"), "junk"])
    wh = Warehouse(spark, "path", root=scratch("wh"))
    run = lambda: run_daily_etl(spark, landing, wh, run_date="2025-03-02", window=("2025-03-01", "2025-03-03"), since="2025-01-01")
    run()
    assert sorted(r.reason for r in wh.read("quarantine_pages").collect()) == ["bad_element", "no_day", "no_day"]
    assert [r.day for r in wh.read("agg_measurements").collect()] == ["2025-03-01"]
    _page(spark, f"{root}/measurements/sensor_id=7", [_doc("2025-03-02T09:00:00Z")])
    run()  # the corrected page has no row of the first day
    assert [r.day for r in wh.read("raw_measurements").collect()] == ["2025-03-02"]
    assert [r.day for r in wh.read("agg_measurements").collect()] == ["2025-03-02"]
    assert wh.read("quarantine_pages").count() == 0


def test_dimension_of_an_incomplete_landing_is_completed(spark, scratch):
    root = scratch("landing")
    landing = _small_landing(spark, root, sensor_id_eq_7=[_doc("2025-03-01T10:00:00Z")])
    _page(spark, landing.countries, '{"results": [{"id": 5, "na', "second.json")
    wh = Warehouse(spark, "path", root=scratch("wh"))
    run = lambda: run_daily_etl(spark, landing, wh, run_date="2025-03-02", since="2025-01-01")
    assert run()["countries"].rows == 1
    assert [r.source for r in wh.read("incomplete_sources").collect()] == ["countries"]
    _page(spark, landing.countries, [{"id": 5, "name": "late"}], "second.json")
    second = run()
    assert second["countries"].action == "refreshed" and second["countries"].rows == 2
    assert second["providers"].action == "skipped"
    assert wh.read("incomplete_sources").count() == 0 and run()["countries"].action == "skipped"


def test_command_line_wants_both_ends_of_a_window(spark, scratch, capsys):
    import pytest

    from aeris.__main__ import main

    with pytest.raises(SystemExit):
        main(["--landing", "x", "--warehouse", "y", "--run-date", "2024-02-01", "--start", "2024-01-01"], spark=spark)
    assert "--start and --end" in capsys.readouterr().err


def test_cluster_without_a_shared_folder_is_an_error():
    import pytest

    from aeris.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
