import datetime as dt

from aeris import operators as op


def _locs(spark):
    rows = [(1, 22, None), (2, 22, dt.datetime(2024, 12, 31, 23, 59, 59)), (3, 22, dt.datetime(2025, 1, 1)),
            (4, 21, dt.datetime(2025, 6, 1)), (5, 22, dt.datetime(2025, 6, 1))]
    return spark.createDataFrame(rows, "location_id int, location_country_id int, "
                                       "location_datetime_last_local timestamp_ntz")


def test_active_locations_edges(spark):
    got = sorted(r.location_id for r in op.active_locations(_locs(spark)).collect())
    assert got == [3, 5]


def test_country_sensors_join(spark):
    sensors = spark.createDataFrame([(3, 31), (3, 32), (9, 91), (None, 0)], "location_id int, sensor_id int")
    locs = op.active_locations(_locs(spark))
    j = op.country_sensors(sensors, locs)
    assert j.columns[:2] == ["location_id", "sensor_id"]
    assert sorted(r.sensor_id for r in j.collect()) == [31, 32]


def test_orphans_and_duplicates(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,)], "k int")
    assert sorted((r.k is None, r.k) for r in op.orphans(child, parent, "k").collect()) == [(False, 2), (True, None)]
    assert [tuple(r) for r in op.duplicate_keys(parent, "k").collect()] == [(1, 2)]


def test_profile_completeness(spark):
    daily = spark.createDataFrame(
        [(1, 0, 0), (1, None, 24), (2, 12, 24), (2, 0, 24), (3, 24, 24)],
        "sensor_id int, observed_count bigint, expected_count int")
    sensors = spark.createDataFrame([(1, "PM10"), (2, "PM10"), (3, "O3")],
                                    "sensor_id int, sensor_parameter_displayName string")
    got = {r.sensor_parameter_displayName: r for r in op.parameter_profile(daily, sensors).collect()}
    pm = got["PM10"]
    # ratios: NULL (expected 0), NULL (observed NULL), 0.5, 0.0 → avg 0.25
    assert (pm.nb_capteurs, pm.avg_completeness_ratio, pm.capteurs_inactifs, pm.capteurs_sous_80_pct) == (2, 0.25, 2, 2)
    assert (got["O3"].avg_completeness_ratio, got["O3"].capteurs_sous_80_pct) == (1.0, 0)
    order = [r.sensor_parameter_displayName for r in op.parameter_profile(daily, sensors).collect()]
    assert order == ["PM10", "O3"]
