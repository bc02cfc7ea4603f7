"""Registered reports over the driver's test tables, with DuckDB oracle SQL.

Each report takes ``(spark, sf_dir)``, builds the stand-in documents with
``aeris.adapters`` and runs the library operators on them over the whole
tables. ``ORACLE_SQL`` holds, per report, ANSI SQL over the same Parquet
tables that computes the same result independently (adapter mapping
included). Reports compared bit for bit use ``exact=True`` rounding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeris import adapters as A
from aeris import operators as op

# Parameters of the stand-in data (FIXTURES.md §4): country 22, cut-off 2001-01-01.
COUNTRY = 22
SINCE = "2001-01-01"
WINDOW = ("2024-01-10", "2024-01-17")


# ---------------------------------------------------------------- reports

def daily_sensor_stats(spark: SparkSession, d: str) -> DataFrame:
    return op.daily_sensor_stats(A.raw_measurements(spark, d), exact=True)


def raw_measurements(spark: SparkSession, d: str) -> DataFrame:
    return op.raw_measurements(A.raw_measurements(spark, d))


def local_timestamp_modes(spark: SparkSession, d: str) -> DataFrame:
    from aeris.functions.time import local_timestamp

    local = F.col("period.datetimeFrom.local")
    return A.raw_measurements(spark, d).select(
        local.alias("local_text"),
        local_timestamp(local, "reference").alias("reference_ts"),
        local_timestamp(local, "wall_clock").alias("wall_clock_ts"),
    )


def measurements_between(spark: SparkSession, d: str) -> DataFrame:
    return op.measurements_between(raw_measurements(spark, d), *WINDOW)


def parameters_dim(spark: SparkSession, d: str) -> DataFrame:
    return op.parameters_dim(A.raw_parameters(spark, d))


def countries_dim(spark: SparkSession, d: str) -> DataFrame:
    return op.countries_dim(A.raw_countries(spark, d))


def country_parameters(spark: SparkSession, d: str) -> DataFrame:
    return op.country_parameters(A.raw_countries(spark, d))


def providers_dim(spark: SparkSession, d: str) -> DataFrame:
    return op.providers_dim(A.raw_providers(spark, d))


def provider_parameters(spark: SparkSession, d: str) -> DataFrame:
    return op.provider_parameters(A.raw_providers(spark, d))


def locations_dim(spark: SparkSession, d: str) -> DataFrame:
    return op.locations_dim(A.raw_locations(spark, d))


def sensors_dim(spark: SparkSession, d: str) -> DataFrame:
    return op.sensors_dim(A.raw_locations(spark, d))


def active_locations(spark: SparkSession, d: str) -> DataFrame:
    return op.active_locations(locations_dim(spark, d), COUNTRY, SINCE)


def country_sensors(spark: SparkSession, d: str) -> DataFrame:
    raw = A.raw_locations(spark, d)
    locations = op.active_locations(op.locations_dim(raw), COUNTRY, SINCE)
    return op.country_sensors(op.sensors_dim(raw), locations)


def measurements_of_country(spark: SparkSession, d: str) -> DataFrame:
    return op.measurements_of_sensors(raw_measurements(spark, d), country_sensors(spark, d))


def parameter_profile(spark: SparkSession, d: str) -> DataFrame:
    return op.parameter_profile(daily_sensor_stats(spark, d), sensors_dim(spark, d), exact=True)


def location_points(spark: SparkSession, d: str) -> DataFrame:
    return op.location_points(locations_dim(spark, d))


def enriched_measurements(spark: SparkSession, d: str) -> DataFrame:
    raw_loc = A.raw_locations(spark, d)
    out = op.enrich_measurements(
        daily_sensor_stats(spark, d),
        op.sensors_dim(raw_loc),
        locations=op.locations_dim(raw_loc),
        parameters=parameters_dim(spark, d),
        providers=providers_dim(spark, d),
        countries=countries_dim(spark, d),
    )
    return out.select(
        "day", "sensor_id", "parameter_id", "value", "sensor_name", "param_name", "location_id",
        "location_name", "provider_id", "provider_source_name", "country_code", "country_name",
    )


def orphan_sensors(spark: SparkSession, d: str) -> DataFrame:
    return op.orphans(sensors_dim(spark, d), active_locations(spark, d), "location_id")


def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return op.duplicate_keys(country_parameters(spark, d), "parameter_id")


REPORTS = {
    "daily_sensor_stats": daily_sensor_stats,
    "raw_measurements": raw_measurements,
    "local_timestamp_modes": local_timestamp_modes,
    "measurements_between": measurements_between,
    "parameters_dim": parameters_dim,
    "countries_dim": countries_dim,
    "country_parameters": country_parameters,
    "providers_dim": providers_dim,
    "provider_parameters": provider_parameters,
    "locations_dim": locations_dim,
    "sensors_dim": sensors_dim,
    "active_locations": active_locations,
    "country_sensors": country_sensors,
    "measurements_of_country": measurements_of_country,
    "parameter_profile": parameter_profile,
    "location_points": location_points,
    "enriched_measurements": enriched_measurements,
    "orphan_sensors": orphan_sensors,
    "duplicate_keys": duplicate_keys,
}


# ---------------------------------------------------------------- oracle SQL
# Building blocks re-state the adapter mapping in SQL.

PID = ("(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3 "
       "WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END)")


def _r(expr: str, digits: int) -> str:
    return f"CAST(round(CAST(CAST({expr} AS DOUBLE) AS DECIMAL(38,6)), {digits}) AS DOUBLE)"


M = f"""m AS (
  SELECT CAST(user_id * 10 + {PID} AS INTEGER) AS sensor_id,
         CAST(value AS FLOAT) AS value,
         strftime(ts, '%Y-%m-%d') AS day,
         date_trunc('second', ts) - CASE WHEN event_id % 3 = 0 THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END
           AS period_datetime_local,
         date_trunc('second', ts) AS wall_clock_ts,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE event_id % 3 WHEN 0 THEN '+01:00' WHEN 1 THEN '-05:00' ELSE 'Z' END
           AS local_text,
         {PID} AS parameter_id,
         event_type AS parameter_name,
         'u' || {PID} AS parameter_units,
         1 AS coverage_expectedCount,
         CAST(json_extract_string(props, '$.k') AS INTEGER) % 25 AS coverage_observedCount
  FROM events)"""

RAW = ("SELECT sensor_id, value, period_datetime_local, parameter_id, parameter_name, parameter_units, "
       "coverage_expectedCount, coverage_observedCount FROM m")

DAILY = f"""daily AS (
  SELECT day, sensor_id, parameter_id,
         {_r('avg(value)', 2)} AS value,
         {_r('min(value)', 2)} AS min_value,
         {_r('max(value)', 2)} AS max_value,
         {_r('stddev_samp(value)', 6)} AS stddev_value,
         {_r('median(CAST(value AS DOUBLE))', 2)} AS median_value,
         CAST(sum(coverage_observedCount) AS BIGINT) AS observed_count,
         24 AS expected_count
  FROM m GROUP BY day, sensor_id, parameter_id)"""

LOC = """loc AS (
  SELECT CAST(c.c_custkey AS INTEGER) AS location_id, c.c_name AS location_name,
         c.c_acctbal >= 0 AS location_monitor,
         date_trunc('day', lo.last_order) + INTERVAL 12 HOUR AS location_datetime_last_local,
         CAST(c.c_custkey % 10 AS INTEGER) AS provider_id,
         'provider-' || CAST(c.c_custkey % 10 AS VARCHAR) AS provider_name,
         CAST(CAST((c.c_custkey * 91) % 1000 AS DOUBLE) / 100.0 AS FLOAT) AS latitude,
         CAST(CAST((c.c_custkey * 37) % 1000 AS DOUBLE) / 100.0 AS FLOAT) AS longitude,
         c.c_nationkey AS location_country_id, n.n_name AS location_country_name
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey) lo
    ON lo.o_custkey = c.c_custkey)"""

SENS = f"""sens AS (
  SELECT CAST(c.c_custkey AS INTEGER) AS location_id,
         CAST(e.user_id * 10 + {PID} AS INTEGER) AS sensor_id,
         e.event_type || '-' || CAST(e.user_id AS VARCHAR) AS sensor_name,
         {PID} AS sensor_parameter_id,
         upper(e.event_type) AS sensor_parameter_displayName
  FROM (SELECT DISTINCT user_id, event_type FROM events) e
  JOIN customer c ON c.c_custkey = e.user_id)"""

ACTIVE = f"""active AS (
  SELECT * FROM loc WHERE location_country_id = {COUNTRY}
    AND location_datetime_last_local >= TIMESTAMP '{SINCE} 00:00:00')"""

CP = f"""cp AS (
  SELECT DISTINCT c.c_nationkey AS country_id, {PID} AS parameter_id
  FROM customer c JOIN (SELECT DISTINCT user_id, event_type FROM events) e ON c.c_custkey = e.user_id)"""

ORACLE_SQL = {
    "daily_sensor_stats": f"WITH {M}, {DAILY} SELECT * FROM daily",
    "raw_measurements": f"WITH {M} {RAW}",
    "local_timestamp_modes": f"WITH {M} SELECT local_text, period_datetime_local AS reference_ts, wall_clock_ts FROM m",
    "measurements_between": f"WITH {M} {RAW} WHERE period_datetime_local >= TIMESTAMP '{WINDOW[0]} 00:00:00' "
                            f"AND period_datetime_local < TIMESTAMP '{WINDOW[1]} 00:00:00'",
    "parameters_dim": f"SELECT DISTINCT {PID} AS param_id, event_type AS param_name, 'u' || {PID} AS param_units, "
                      "upper(event_type) AS param_displayName, CAST(NULL AS VARCHAR) AS param_description FROM events",
    "countries_dim": "SELECT c.c_nationkey AS country_id, 'N' || CAST(c.c_nationkey AS VARCHAR) AS country_code, "
                     "CAST(NULL AS VARCHAR) AS date_first_measure, CAST(NULL AS VARCHAR) AS date_last_measure, "
                     "n.n_name AS country_name "
                     "FROM (SELECT DISTINCT c_nationkey FROM customer) c "
                     "LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey",
    "country_parameters": f"WITH {CP} SELECT * FROM cp",
    "providers_dim": "SELECT CAST(s_suppkey AS INTEGER) AS provider_id, s_name AS provider_name, "
                     "lower(s_name) AS provider_source_name, CAST(NULL AS VARCHAR) AS provider_datetime_added, "
                     "CAST(NULL AS VARCHAR) AS provider_datetime_last FROM supplier",
    "provider_parameters": "SELECT CAST(s_suppkey AS INTEGER) AS provider_id, p AS parameter_id "
                           "FROM supplier, (VALUES (1), (2), (3), (4), (5)) t(p) "
                           "WHERE s_suppkey % 7 <> 0 AND (s_suppkey + p) % 2 = 0",
    "locations_dim": f"WITH {LOC} SELECT * FROM loc",
    "sensors_dim": f"WITH {SENS} SELECT * FROM sens",
    "active_locations": f"WITH {LOC}, {ACTIVE} SELECT * FROM active",
    "country_sensors": f"WITH {LOC}, {ACTIVE}, {SENS} SELECT * FROM sens JOIN active USING (location_id)",
    "measurements_of_country": f"WITH {M}, {LOC}, {ACTIVE}, {SENS} {RAW} WHERE sensor_id IN "
                               "(SELECT sensor_id FROM sens JOIN active USING (location_id))",
    "parameter_profile": f"""WITH {M}, {DAILY}, {SENS},
  j AS (SELECT d.sensor_id, d.observed_count, s.sensor_parameter_displayName,
               CASE WHEN d.expected_count <> 0 THEN d.observed_count / d.expected_count END AS ratio
        FROM daily d JOIN sens s ON d.sensor_id = s.sensor_id)
  SELECT sensor_parameter_displayName,
         count(DISTINCT sensor_id) AS nb_capteurs,
         {_r('avg(ratio)', 3)} AS avg_completeness_ratio,
         CAST(sum(CASE WHEN observed_count = 0 THEN 1 ELSE 0 END) AS BIGINT) AS capteurs_inactifs,
         CAST(sum(CASE WHEN ratio < 0.8 THEN 1 ELSE 0 END) AS BIGINT) AS capteurs_sous_80_pct
  FROM j GROUP BY sensor_parameter_displayName""",
    "location_points": f"WITH {LOC} SELECT location_id, longitude AS city_longitude, latitude AS city_latitude FROM loc",
    "enriched_measurements": f"""WITH {M}, {DAILY}, {LOC}, {SENS}
  SELECT d.day, d.sensor_id, d.parameter_id, d.value, s.sensor_name,
         p.param_name, s.location_id, l.location_name, l.provider_id,
         lower(su.s_name) AS provider_source_name,
         'N' || CAST(n.n_nationkey AS VARCHAR) AS country_code, n.n_name AS country_name
  FROM daily d
  LEFT JOIN sens s ON d.sensor_id = s.sensor_id
  LEFT JOIN (SELECT DISTINCT {PID} AS param_id, event_type AS param_name FROM events) p ON d.parameter_id = p.param_id
  LEFT JOIN loc l ON s.location_id = l.location_id
  LEFT JOIN supplier su ON l.provider_id = su.s_suppkey
  LEFT JOIN nation n ON l.location_country_id = n.n_nationkey""",
    "orphan_sensors": f"WITH {LOC}, {ACTIVE}, {SENS} SELECT * FROM sens "
                      "WHERE location_id IS NULL OR location_id NOT IN (SELECT location_id FROM active)",
    "duplicate_keys": f"WITH {CP} SELECT parameter_id, count(*) AS n FROM cp GROUP BY parameter_id HAVING count(*) > 1",
}


# ---------------------------------------------------------------- sources, loads, ETL, geo
# These reports land the stand-in documents as files under the shared
# checkpoint folder (a fresh sub-folder per call) and read them back.

def paged_ingest(spark: SparkSession, d: str) -> DataFrame:
    from aeris.session import scratch_path
    from aeris.sources import landed

    path = scratch_path(spark, "pages")
    A.land_locations(spark, d, path)
    return op.locations_dim(landed.read_locations(spark, path))


def paged_measurements(spark: SparkSession, d: str) -> DataFrame:
    from aeris.session import scratch_path
    from aeris.sources import landed

    path = scratch_path(spark, "measurements")
    A.land_measurements(spark, d, path)
    return op.raw_measurements(landed.read_measurements(spark, path))


def quarantined_pages(spark: SparkSession, d: str) -> DataFrame:
    from aeris import schemas
    from aeris.session import scratch_path
    from aeris.sources import landed

    path = scratch_path(spark, "bad-pages")
    A.land_locations(spark, d, path, page_size=100)  # small pages: many pages to quarantine from
    A.land_broken_location_pages(spark, d, path, every=5, page_size=100)
    _, quarantine = landed.split_pages(spark, path, schemas.LOCATION, layout="page")
    return quarantine.select("page", "reason")


def _warehouse(spark: SparkSession, label: str):
    from aeris.plans.load import Warehouse
    from aeris.session import scratch_path

    return Warehouse(spark, "path", root=scratch_path(spark, label))


def load_create_skip_append(spark: SparkSession, d: str) -> DataFrame:
    """Dimension created then skipped; fact days loaded, re-loaded and extended.

    The final fact must hold every (day, sensor, parameter) exactly once.
    """
    from aeris.plans.load import load_step

    wh = _warehouse(spark, "load")
    params = lambda: parameters_dim(spark, d)
    first = load_step(wh, "parameters", params)
    again = load_step(wh, "parameters", lambda: (_ for _ in ()).throw(AssertionError("dimension rebuilt")))
    assert (first.action, again.action) == ("created", "skipped"), (first.action, again.action)
    daily = daily_sensor_stats(spark, d)
    early = lambda: daily.where(F.col("day") < "2024-01-16")
    late = lambda: daily.where(F.col("day") >= "2024-01-16")
    actions = [
        load_step(wh, "agg_measurements", early, kind="fact", partition_by=["day"]).action,
        load_step(wh, "agg_measurements", early, kind="fact", partition_by=["day"]).action,
        load_step(wh, "agg_measurements", late, kind="fact", partition_by=["day"]).action,
        load_step(wh, "agg_measurements", early, kind="fact", partition_by=["day"]).action,
    ]
    assert actions == ["created", "replaced", "replaced", "replaced"], actions
    return wh.read("agg_measurements")


def export_round_trip(spark: SparkSession, d: str) -> DataFrame:
    from aeris.session import scratch_path

    wh = _warehouse(spark, "export")
    wh.write(daily_sensor_stats(spark, d), "agg_measurements", partition_by=["day"])
    stored = wh.read("agg_measurements")
    path = scratch_path(spark, "csv")
    wh.export("agg_measurements", path)
    return spark.read.schema(stored.schema).option("header", True).csv(path)


_ETL_RUNS: dict = {}


def _etl(spark: SparkSession, d: str):
    """Land every stand-in source and run the daily ETL once per session and input."""
    from aeris.plans.etl import run_daily_etl
    from aeris.session import scratch_path

    key = (spark.sparkContext.applicationId, id(spark), d)
    if key not in _ETL_RUNS:
        landing = A.land_all(spark, d, scratch_path(spark, "landing"), one_page_per_file=False)  # JSON lines
        wh = _warehouse(spark, "etl")
        _ETL_RUNS[key] = run_daily_etl(
            spark, landing, wh, run_date="2024-02-01", window=("2024-01-01", "2024-02-01"),
            country_id=COUNTRY, since=SINCE, cell_size=0.5, exact=True)
    return _ETL_RUNS[key]


def etl_agg_measurements(spark: SparkSession, d: str) -> DataFrame:
    return _etl(spark, d)["agg_measurements"].table


def etl_france_sensors(spark: SparkSession, d: str) -> DataFrame:
    return _etl(spark, d)["france_sensors"].table


def assign_communes(spark: SparkSession, d: str) -> DataFrame:
    points = op.location_points(locations_dim(spark, d))
    return op.assign_communes(points, A.communes(spark, d), cell_size=0.5)


def cities_of_locations(spark: SparkSession, d: str) -> DataFrame:
    return op.city_points(assign_communes(spark, d))


REPORTS.update({
    "paged_ingest": paged_ingest,
    "paged_measurements": paged_measurements,
    "quarantined_pages": quarantined_pages,
    "load_create_skip_append": load_create_skip_append,
    "export_round_trip": export_round_trip,
    "etl_agg_measurements": etl_agg_measurements,
    "etl_france_sensors": etl_france_sensors,
    "assign_communes": assign_communes,
    "cities_of_locations": cities_of_locations,
})

COM = f"""com AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS nom,
         CASE WHEN n_nationkey % 4 = 0 THEN CAST([] AS VARCHAR[]) ELSE [CAST(n_nationkey AS VARCHAR)] END AS codesPostaux,
         CAST((n_nationkey + 1) * 1000 AS INTEGER) AS population,
         CAST((n_nationkey % 5) * 2 AS DOUBLE) AS x0, CAST((n_nationkey // 5) * 2 AS DOUBLE) AS y0
  FROM nation)"""

ASSIGN = f"""assigned AS (
  SELECT p.location_id, p.longitude, p.latitude, c.nom, c.code, c.codesPostaux, c.population,
         row_number() OVER (PARTITION BY p.location_id ORDER BY c.code) AS rn
  FROM loc p LEFT JOIN com c
    ON CAST(p.longitude AS DOUBLE) >= c.x0 AND CAST(p.longitude AS DOUBLE) < c.x0 + CAST(1.8 AS DOUBLE)
   AND CAST(p.latitude AS DOUBLE) >= c.y0 AND CAST(p.latitude AS DOUBLE) < c.y0 + CAST(1.8 AS DOUBLE))"""

ORACLE_SQL.update({
    "paged_ingest": ORACLE_SQL["locations_dim"],
    "paged_measurements": ORACLE_SQL["raw_measurements"],
    "quarantined_pages": "SELECT DISTINCT CAST(c_custkey // 100 AS INTEGER) AS page, 'malformed' AS reason "
                         "FROM customer WHERE (c_custkey // 100) % 5 = 0",
    "load_create_skip_append": ORACLE_SQL["daily_sensor_stats"],
    "export_round_trip": ORACLE_SQL["daily_sensor_stats"],
    "etl_agg_measurements": f"""WITH {M}, {DAILY}, {LOC}, {ACTIVE}, {SENS}
  SELECT * FROM daily WHERE sensor_id IN (SELECT sensor_id FROM sens JOIN active USING (location_id))""",
    "etl_france_sensors": ORACLE_SQL["country_sensors"],
    "assign_communes": f"WITH {LOC}, {COM}, {ASSIGN} SELECT location_id, longitude, latitude, nom, code, "
                       "codesPostaux, population FROM assigned WHERE rn = 1",
    "cities_of_locations": f"WITH {LOC}, {COM}, {ASSIGN} SELECT location_id, latitude, longitude, nom AS city_name, "
                           "code AS city_insee_code, codesPostaux[1] AS city_postcode, population AS city_population "
                           "FROM assigned WHERE rn = 1",
})


# ---------------------------------------------------------------- limits

def limits_rows(spark: SparkSession, d: str) -> DataFrame:
    from aeris.operators.limits import limit_rows

    return limit_rows(A.limit_cells(spark, d))


def limits_document(spark: SparkSession, d: str) -> DataFrame:
    from aeris.operators.limits import limits_document as doc

    out = doc(A.limit_cells(spark, d))
    return out.select(
        "table_no",
        "nom",
        F.size("informations").alias("n_informations"),
        F.array_join(F.transform("informations", lambda i: i["indicateur"]), " | ").alias("indicateurs"),
        F.array_join(F.transform("informations", lambda i: i["valeurs"]), " | ").alias("valeurs"),
    )


def limits_document_json(spark: SparkSession, d: str) -> DataFrame:
    """Write the document as JSON lines and read it back (nested schema kept)."""
    from aeris.operators.limits import limits_document as doc
    from aeris.operators.limits import write_limits_document
    from aeris.session import scratch_path

    built = doc(A.limit_cells(spark, d))
    path = scratch_path(spark, "limits-json")
    write_limits_document(built, path)
    back = spark.read.schema(built.schema).json(path)
    return back.select(
        "table_no",
        "nom",
        F.size("informations").alias("n_informations"),
        F.array_join(F.transform("informations", lambda i: i["indicateur"]), " | ").alias("indicateurs"),
        F.array_join(F.transform("informations", lambda i: i["valeurs"]), " | ").alias("valeurs"),
    )


REPORTS.update({
    "limits_rows": limits_rows,
    "limits_document": limits_document,
    "limits_document_json": limits_document_json,
})

# Python's whitespace set for RE2 (whose \s is ASCII only).
DWS = (r"[\t\n\x{0b}\f\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
       r"\x{202f}\x{205f}\x{3000}]")


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{DWS}+|{DWS}+$', '', 'g')"


def _clean(x: str) -> str:
    return _strip(f"replace({x}, chr(10), ' ')")


_MEASURE = r"([0-9,.]+" + DWS + r"*(?:µg/m³|µg/m3|mg/m³|mg/m3|ng/m³|ng/m3))" + DWS + r"*\((FR|UE)\)"
_FIX = ("'(' || translate(regexp_replace(regexp_replace(regexp_replace(substring(t, 2, length(t) - 2), "
        f"'{DWS}+', '', 'g'), 'CH66', 'C6H6', 'gi'), 'CH₆₆', 'C6H6', 'gi'), '0123456789', '₀₁₂₃₄₅₆₇₈₉') || ')'")

CELLS = """cells AS (
  SELECT CAST(p_partkey // 8 AS INTEGER) AS table_no, CAST(p_partkey % 8 AS INTEGER) AS row_no,
    CASE WHEN p_partkey % 8 = 0 THEN
      CASE p_size % 6
        WHEN 0 THEN p_type || ' (CH)' || chr(10) || '6 6'
        WHEN 1 THEN NULL
        WHEN 2 THEN upper(p_name)
        WHEN 3 THEN p_type || chr(10) || CAST(p_size % 10 AS VARCHAR)
        WHEN 4 THEN p_type || ' ( ' || p_brand || ' ' || CAST(p_size % 10 AS VARCHAR) || ' )' || chr(10) || ' '
                    || CAST(p_size % 7 AS VARCHAR) || ' ' || CAST(p_size % 5 AS VARCHAR) || ' ' || chr(10) || 'extra'
        ELSE p_type || ' (PM' || CAST(p_size % 10 AS VARCHAR) || ',' || CAST(p_size % 3 AS VARCHAR) || ')'
      END
    ELSE
      CASE p_size % 5
        WHEN 0 THEN '' WHEN 1 THEN NULL
        WHEN 2 THEN 'Valeur limite' || chr(10) || p_name
        WHEN 3 THEN ' '
        ELSE 'Moyenne ' || p_type
      END
    END AS c0,
    CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE
      CASE p_size % 7
        WHEN 0 THEN 'aucune valeur' WHEN 1 THEN '' WHEN 2 THEN NULL
        WHEN 3 THEN CAST(p_size AS VARCHAR) || chr(160) || 'mg/m3 (UE)'
        WHEN 4 THEN CAST(p_size AS VARCHAR) || ' µg/m³ (FR)' || chr(10) || ' ' || CAST(p_partkey % 50 AS VARCHAR) || ','
                    || CAST(p_size % 10 AS VARCHAR) || '  µg/m3 (UE)'
        WHEN 5 THEN 'Seuil: ' || CAST(p_size AS VARCHAR) || ' ng/m³ (FR) et ' || CAST(p_partkey % 9 AS VARCHAR)
                    || '.5 mg/m³(UE)'
        ELSE '  ' || p_name || chr(10) || chr(10) || p_brand || '  '
      END
    END AS c1,
    CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE
      CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Critère' || chr(10) || p_brand WHEN 2 THEN ''
        ELSE ' Année civile ' END
    END AS c2
  FROM part)"""

LIMITS = f"""{CELLS},
  t0 AS (SELECT table_no, c0, string_split(c0, chr(10)) AS parts FROM cells WHERE row_no = 0),
  t1 AS (SELECT table_no, c0, {_strip('parts[1]')} AS main, parts[2] AS second FROM t0),
  t2 AS (SELECT table_no, c0, main, second, replace({_strip('second')}, ' ', '') AS idx,
                length(main) - strpos(reverse(main), ')') + 1 AS lp FROM t1),
  t3 AS (SELECT table_no,
           CASE WHEN c0 IS NULL OR c0 = '' THEN 'Inconnu'
                WHEN second IS NULL THEN main
                WHEN strpos(main, ')') = 0 THEN main || idx
                ELSE substring(main, 1, lp - 1) || idx || substring(main, lp) END AS named FROM t2),
  t4 AS (SELECT table_no,
           regexp_replace(regexp_replace(named, '\\({DWS}+', '(', 'g'), '{DWS}+\\)', ')', 'g') AS s FROM t3),
  titles AS (SELECT table_no, array_to_string(list_transform(regexp_extract_all(s, '\\(.*?\\)|[^(]+|\\(', 0),
             lambda t: CASE WHEN starts_with(t, '(') AND length(t) >= 2 THEN {_FIX} ELSE t END), '') AS nom
             FROM t4),
  b AS (SELECT table_no, row_no, c2,
          coalesce(last_value(CASE WHEN coalesce(c0, '') <> '' THEN c0 END IGNORE NULLS) OVER (
            PARTITION BY table_no ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS filled,
          trim(regexp_replace(coalesce(c1, ''), '{DWS}+', ' ', 'g')) AS n
        FROM cells WHERE row_no > 0),
  v AS (SELECT *, regexp_extract_all(n, '{_MEASURE}', 1) AS vals, regexp_extract_all(n, '{_MEASURE}', 2) AS origs
        FROM b),
  r AS (SELECT table_no, row_no,
          {_clean('filled')} AS indicateur,
          {_clean("CASE WHEN len(vals) > 0 THEN array_to_string(vals, ' ; ') ELSE n END")} AS valeurs,
          {_clean("CASE WHEN len(vals) > 0 THEN array_to_string(origs, ' ; ') ELSE '' END")} AS origine,
          {_clean("coalesce(c2, '')")} AS critere
        FROM v)"""

ORACLE_SQL.update({
    "limits_rows": f"""WITH {LIMITS}
  SELECT r.table_no, r.row_no, coalesce(t.nom, 'Inconnu') AS nom, indicateur, valeurs, origine, critere
  FROM r LEFT JOIN titles t USING (table_no) WHERE valeurs <> ''""",
    "limits_document": f"""WITH {LIMITS},
  g AS (SELECT table_no, CAST(count(*) AS INTEGER) AS n_informations,
          string_agg(indicateur, ' | ' ORDER BY row_no) AS indicateurs,
          string_agg(valeurs, ' | ' ORDER BY row_no) AS valeurs
        FROM r WHERE valeurs <> '' GROUP BY table_no),
  tabs AS (SELECT DISTINCT table_no FROM cells)
  SELECT tabs.table_no, coalesce(t.nom, 'Inconnu') AS nom, coalesce(g.n_informations, 0) AS n_informations,
         coalesce(g.indicateurs, '') AS indicateurs, coalesce(g.valeurs, '') AS valeurs
  FROM tabs LEFT JOIN titles t USING (table_no) LEFT JOIN g USING (table_no)""",
})
ORACLE_SQL["limits_document_json"] = ORACLE_SQL["limits_document"]


# ---------------------------------------------------------------- streaming

def _landed_by_sensor(spark: SparkSession, d: str) -> str:
    """The measurements as ``sensor_id=<id>`` folders, landed once per application and input."""
    from aeris.session import scratch_path

    key = (spark.sparkContext.applicationId, id(spark), d, "by sensor")
    if key not in _ETL_RUNS:
        path = scratch_path(spark, "by-sensor")
        A.land_measurements_by_sensor(spark, d, path)
        _ETL_RUNS[key] = path
    return _ETL_RUNS[key]


def _landed_pages(spark: SparkSession, d: str) -> str:
    """The measurements as JSON lines whose documents carry their sensor, landed once per application and input."""
    from aeris.session import scratch_path

    key = (spark.sparkContext.applicationId, id(spark), d, "pages")
    if key not in _ETL_RUNS:
        path = scratch_path(spark, "stream-src")
        A.land_measurements(spark, d, path, one_page_per_file=False)
        _ETL_RUNS[key] = path
    return _ETL_RUNS[key]


def stream_daily_stats(spark: SparkSession, d: str) -> DataFrame:
    """Stream landed pages into the facts: every group, open days and late rows included."""
    from aeris.session import scratch_path
    from aeris.streaming.daily import run_daily_fact_stream

    wh = _warehouse(spark, "stream")
    run_daily_fact_stream(spark, _landed_pages(spark, d), wh, scratch_path(spark, "stream-ckpt"), exact=True,
                          layout="lines").awaitTermination()
    return wh.read("stream_agg_measurements")


def stream_closed_days(spark: SparkSession, d: str) -> DataFrame:
    """The watermarked form on the same pages: the days whose window closed under a 1-day watermark."""
    from aeris.session import scratch_path
    from aeris.streaming.daily import run_daily_stats_stream

    sink, ckpt = scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-ckpt")
    run_daily_stats_stream(spark, _landed_pages(spark, d), sink, ckpt, lateness="1 day", exact=True,
                           layout="lines").awaitTermination()
    schema = "day string, sensor_id int, parameter_id int, value double, min_value double, max_value double, " \
             "stddev_value double, median_value double, observed_count bigint, expected_count int"
    return spark.read.schema(schema).parquet(sink)


REPORTS["stream_daily_stats"] = stream_daily_stats
ORACLE_SQL["stream_daily_stats"] = f"WITH {M}, {DAILY} SELECT * FROM daily"
REPORTS["stream_closed_days"] = stream_closed_days
ORACLE_SQL["stream_closed_days"] = (
    f"WITH {M}, {DAILY} SELECT * FROM daily WHERE CAST(day AS TIMESTAMP) + INTERVAL 2 DAY "
    "<= (SELECT max(wall_clock_ts) FROM m)"
)


# ---------------------------------------------------------------- pages, folders and odd landings

def paged_parameters(spark: SparkSession, d: str) -> DataFrame:
    from aeris.session import scratch_path
    from aeris.sources import landed

    path = scratch_path(spark, "parameters")
    landed.write_pages(A.raw_parameters(spark, d), path, F.lit(0))
    return op.parameters_dim(landed.read_parameters(spark, path))


def paged_countries(spark: SparkSession, d: str) -> DataFrame:
    from aeris.session import scratch_path
    from aeris.sources import landed

    path = scratch_path(spark, "countries")
    landed.write_pages(A.raw_countries(spark, d), path, F.floor(F.col("id") / 10).cast("int"))
    return op.countries_dim(landed.read_countries(spark, path))


def paged_providers(spark: SparkSession, d: str) -> DataFrame:
    from aeris.session import scratch_path
    from aeris.sources import landed

    path = scratch_path(spark, "providers")
    landed.write_pages(A.raw_providers(spark, d), path, F.floor(F.col("id") / 100).cast("int"), one_page_per_file=False)
    return op.providers_dim(landed.read_providers(spark, path, layout="lines"))


def folder_keyed_measurements(spark: SparkSession, d: str) -> DataFrame:
    """Measurements whose sensor is the folder's, but for documents with a sensor of their own, which wins."""
    from aeris.sources import landed

    return op.raw_measurements(landed.read_measurements(spark, _landed_by_sensor(spark, d), layout="lines"))


def limits_from_cell_file(spark: SparkSession, d: str) -> DataFrame:
    from aeris.operators.limits import limit_rows
    from aeris.session import scratch_path
    from aeris.sources.cells import read_limit_cells

    path = scratch_path(spark, "cells")
    A.limit_cells(spark, d).write.json(path)
    return limit_rows(read_limit_cells(spark, path))


def measurements_of_run(spark: SparkSession, d: str) -> DataFrame:
    """The raw measurements of a run date's default window, by local day."""
    from aeris.functions.time import day_text, run_window

    raw = A.raw_measurements(spark, d).withColumn("day", day_text(F.col("period.datetimeFrom.local")))
    return op.raw_measurements(op.measurements_between(raw, *run_window(RUN_DATE), column="day"))


def enriched_with_cities(spark: SparkSession, d: str) -> DataFrame:
    raw_loc = A.raw_locations(spark, d)
    out = op.enrich_measurements(daily_sensor_stats(spark, d), op.sensors_dim(raw_loc),
                                 locations=op.locations_dim(raw_loc), cities=cities_of_locations(spark, d))
    return out.select("day", "sensor_id", "parameter_id", "value", "location_id", "location_name", "city_name",
                      "city_insee_code")


def assign_communes_parts(spark: SparkSession, d: str) -> DataFrame:
    """Communes of two parts or with a hole, overlapping ones, and one that only fits the coarse grid."""
    points = op.location_points(locations_dim(spark, d))
    return op.assign_communes(points, A.communes_with_parts(spark, d), cell_size=0.25, max_cells=100)


def merge_late_rows(spark: SparkSession, d: str) -> DataFrame:
    """Three overlapping batches of daily statistics merged into one fact, rows of a NULL day among them; each later
    batch corrects rows that are stored."""
    from aeris.plans.load import load_step

    wh = _warehouse(spark, "merge")
    daily = daily_sensor_stats(spark, d).withColumn("day", F.when(F.col("parameter_id") != 3, F.col("day")))
    keyed = (daily.groupBy("day", "sensor_id", "parameter_id")
             .agg(F.sum("observed_count").alias("observed_count"), F.count(F.lit(1)).alias("n")))
    wrong = keyed.withColumn("n", F.lit(-1).cast("long"))
    even = F.col("sensor_id") % 2 == 0
    for batch in (wrong.where(even), keyed.where("sensor_id % 3 = 0"), keyed.where("sensor_id % 3 <> 0")):
        load_step(wh, "f", lambda b=batch: b, kind="fact", partition_by=["day"], fact_mode="merge",
                  merge_keys=["day", "sensor_id", "parameter_id"])
    return wh.read("f")


def landing_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    """What became of every landed measurement document and page: loaded, out of window, unselected, or quarantined with its
    reason. The landing holds pages with a NULL, a minute-precision and a broken datetime, bad elements, several JSON
    values in one file, text after a page, a truncated page and an empty one."""
    from aeris.plans.etl import Landing, run_daily_etl
    from aeris.session import scratch_path

    key = (spark.sparkContext.applicationId, id(spark), d, "odd")
    if key not in _ETL_RUNS:
        root = scratch_path(spark, "odd-landing")
        A.land_all(spark, d, root, one_page_per_file=False, measurements=False)
        A.land_odd_measurements(spark, d, f"{root}/measurements")
        landing = Landing(*[f"{root}/{x}" for x in ("parameters", "countries", "providers", "locations", "measurements")])
        wh = _warehouse(spark, "odd")
        run_daily_etl(spark, landing, wh, run_date=ODD_WINDOW[1], window=ODD_WINDOW, country_id=COUNTRY, since=SINCE, exact=True)
        _ETL_RUNS[key] = wh
    wh = _ETL_RUNS[key]
    from aeris.functions.time import a_day, day_text
    from aeris.sources import landed

    rows = landed.measurement_rows(landed.page_rows(wh.read("staged_measurements"))).select(
        day_text(F.col("period.datetimeFrom.local")).alias("day"), "sensor_id").where(a_day(F.col("day")) & F.col("sensor_id").isNotNull())
    inside = (F.col("day") >= ODD_WINDOW[0]) & (F.col("day") < ODD_WINDOW[1])
    known = wh.read("france_sensors").select("sensor_id").distinct().withColumn("selected", F.lit(True))
    fate = rows.join(known, "sensor_id", "left").select(
        F.when(~inside, "out_of_window").when(F.col("selected").isNull(), "unselected").alias("fate"))
    parts = [
        fate.where("fate is not null"),
        wh.read("raw_measurements").select(F.lit("loaded").alias("fate")),
        wh.read("quarantine_pages").select(F.concat(F.lit("quarantined_"), "reason").alias("fate")),
    ]
    return parts[0].union(parts[1]).union(parts[2]).groupBy("fate").agg(F.count(F.lit(1)).alias("n"))


#: Run date of ``measurements_of_run`` and window of ``landing_reconciliation``.
RUN_DATE = "2024-01-17"
ODD_WINDOW = ("2024-01-05", "2024-01-25")

REPORTS.update({
    "paged_parameters": paged_parameters,
    "paged_countries": paged_countries,
    "paged_providers": paged_providers,
    "folder_keyed_measurements": folder_keyed_measurements,
    "limits_from_cell_file": limits_from_cell_file,
    "measurements_of_run": measurements_of_run,
    "enriched_with_cities": enriched_with_cities,
    "assign_communes_parts": assign_communes_parts,
    "merge_late_rows": merge_late_rows,
    "landing_reconciliation": landing_reconciliation,
})

# rectangles of ``adapters.communes_with_parts``: n % 3 = 0 has a hole, n % 3 = 1 a second part, code 'zz' covers all
PARTS = """parts AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS nom, CAST((n_nationkey % 5) * 2 AS DOUBLE) AS x0,
         CAST((n_nationkey // 5) * 2 AS DOUBLE) AS y0, n_nationkey % 3 AS kind FROM nation
  UNION ALL SELECT 'zz', 'ALL', CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), 9),
hit AS (
  SELECT p.location_id, p.longitude, p.latitude, c.nom, c.code FROM loc p JOIN parts c ON
    (c.kind < 9 AND CAST(p.longitude AS DOUBLE) >= c.x0 AND CAST(p.longitude AS DOUBLE) < c.x0 + CAST(1.8 AS DOUBLE)
       AND CAST(p.latitude AS DOUBLE) >= c.y0 AND CAST(p.latitude AS DOUBLE) < c.y0 + CAST(1.8 AS DOUBLE)
       AND NOT (c.kind = 0 AND CAST(p.longitude AS DOUBLE) >= c.x0 + 0.5 AND CAST(p.longitude AS DOUBLE) < c.x0 + 1.0
                AND CAST(p.latitude AS DOUBLE) >= c.y0 + 0.5 AND CAST(p.latitude AS DOUBLE) < c.y0 + 1.0))
    OR (c.kind = 1 AND CAST(p.longitude AS DOUBLE) >= c.x0 + 2.25 AND CAST(p.longitude AS DOUBLE) < c.x0 + 2.75
        AND CAST(p.latitude AS DOUBLE) >= c.y0 AND CAST(p.latitude AS DOUBLE) < c.y0 + 1.0)
    OR (c.kind = 9 AND CAST(p.longitude AS DOUBLE) < 9.5 AND CAST(p.latitude AS DOUBLE) < 9.5)),
best AS (SELECT * FROM hit QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY code) = 1)"""

ORACLE_SQL.update({
    "paged_parameters": ORACLE_SQL["parameters_dim"],
    "paged_countries": ORACLE_SQL["countries_dim"],
    "paged_providers": ORACLE_SQL["providers_dim"],
    "folder_keyed_measurements": ORACLE_SQL["raw_measurements"],
    "limits_from_cell_file": ORACLE_SQL["limits_rows"],
    "measurements_of_run": f"WITH {M} {RAW} WHERE day = '2024-01-16'",
    "enriched_with_cities": f"""WITH {M}, {DAILY}, {LOC}, {SENS}, {COM}, {ASSIGN}
  SELECT d.day, d.sensor_id, d.parameter_id, d.value, s.location_id, l.location_name, a.nom AS city_name,
         a.code AS city_insee_code
  FROM daily d LEFT JOIN sens s ON d.sensor_id = s.sensor_id LEFT JOIN loc l ON s.location_id = l.location_id
  LEFT JOIN (SELECT * FROM assigned WHERE rn = 1) a ON s.location_id = a.location_id""",
    "assign_communes_parts": f"""WITH {LOC}, {PARTS}
  SELECT l.location_id, l.longitude, l.latitude, b.nom, b.code,
         CASE WHEN b.code IS NOT NULL THEN CAST([] AS VARCHAR[]) END AS codesPostaux,
         CASE WHEN b.code IS NOT NULL THEN 1 END AS population
  FROM loc l LEFT JOIN best b ON l.location_id = b.location_id""",
    "merge_late_rows": f"""WITH {M}, {DAILY}
  SELECT CASE WHEN parameter_id <> 3 THEN day END AS day, sensor_id, parameter_id,
         CAST(sum(observed_count) AS BIGINT) AS observed_count, count(*) AS n
  FROM daily GROUP BY 1, 2, 3""",
    "landing_reconciliation": f"""WITH {M}, {LOC}, {ACTIVE}, {SENS},
  e AS (SELECT e.event_id, e.event_id // 1000 AS page, m2.day, m2.sensor_id
        FROM (SELECT event_id, ts, user_id, event_type FROM events) e,
             LATERAL (SELECT strftime(e.ts, '%Y-%m-%d') AS day, CAST(e.user_id * 10 + {PID} AS INTEGER) AS sensor_id) m2),
  read AS (SELECT * FROM e WHERE page % 10 NOT IN (3, 4)),
  fate AS (
    SELECT CASE WHEN event_id % 11 IN (0, 1) THEN 'quarantined_no_day'
                WHEN day < '{ODD_WINDOW[0]}' OR day >= '{ODD_WINDOW[1]}' THEN 'out_of_window'
                WHEN sensor_id IN (SELECT sensor_id FROM sens JOIN active USING (location_id)) THEN 'loaded'
                ELSE 'unselected' END AS fate FROM read
    UNION ALL SELECT 'quarantined_malformed' FROM (SELECT DISTINCT page FROM e WHERE page % 10 IN (3, 4))
    UNION ALL SELECT 'quarantined_bad_element' FROM (SELECT DISTINCT page FROM e WHERE page % 10 = 1))
  SELECT fate, count(*) AS n FROM fate GROUP BY fate""",
})


# ---------------------------------------------------------------- manifest, partials, ledger

def _manifest(spark: SparkSession, d: str):
    """The manifest of the landing by sensor folder, brought up to date."""
    from aeris.session import scratch_path
    from aeris.sources.manifest import LandingManifest

    key = (spark.sparkContext.applicationId, id(spark), d, "manifest")
    if key not in _ETL_RUNS:
        _ETL_RUNS[key] = scratch_path(spark, "manifest")
    listed = LandingManifest(spark, _landed_by_sensor(spark, d), _ETL_RUNS[key])
    listed.refresh()
    return listed


def manifest_files(spark: SparkSession, d: str) -> DataFrame:
    """What the manifest knows of each landed folder (one file each)."""
    folder = F.regexp_extract("file", "/sensor_id=([0-9]+)/", 1).cast("int").alias("folder")
    return _manifest(spark, d).read().select(folder, "rows", "undated", "unkeyed", "faults", "min_day", "max_day", "sensors")


def manifest_pruned_measurements(spark: SparkSession, d: str) -> DataFrame:
    """The raw measurements of a window and of every hundredth station's sensors, from the files that the manifest names."""
    from aeris import schemas
    from aeris.functions.time import day_text
    from aeris.sources import landed

    listed = _manifest(spark, d)
    sensors = sensors_dim(spark, d).where(F.col("location_id") % 100 == 7)
    files = listed.files(listed.needed(*ODD_WINDOW, sensors))
    rows = landed.measurement_rows(landed.page_rows(landed.parse_pages(spark, listed.landing, schemas.MEASUREMENT, files=files)))
    rows = rows.withColumn("day", day_text(F.col("period.datetimeFrom.local")))
    return op.raw_measurements(op.measurements_of_sensors(op.measurements_between(rows, *ODD_WINDOW, column="day"), sensors))


def incremental_daily_stats(spark: SparkSession, d: str) -> DataFrame:
    """Four batches of measurements, all of which hold every day, merged as partials; the first is given twice."""
    from aeris.functions.time import day_text
    from aeris.operators.partials import add_batch

    wh = _warehouse(spark, "partials")
    raw = A.raw_measurements(spark, d, with_event_id=True).withColumn("day", day_text(F.col("period.datetimeFrom.local")))
    fact = op.raw_measurements(raw, keep=["day", "event_id"])
    for batch in (0, 1, 0, 2, 3):
        add_batch(wh, fact.where(F.col("event_id") % 4 == batch), batch, exact=True)
    return wh.read("agg_measurements")


def _ledger(spark: SparkSession, d: str, waves: list) -> object:
    """The ledger's warehouse after one run for each wave of measurements that lands."""
    from aeris.session import scratch_path
    from aeris.sources.landed import write_pages
    from aeris.streaming.ledger import run_ledger_stream

    root, ckpt, manifest = (scratch_path(spark, x) for x in ("waves", "ledger-ckpt", "ledger-manifest"))
    wh = _warehouse(spark, "ledger")
    for i, wave in enumerate(waves):
        docs = A.raw_measurements(spark, d, with_event_id=True).where(wave)
        write_pages(docs, f"{root}/wave{i}", F.floor(F.col("event_id") / 1000).cast("int"), drop=["event_id"], one_page_per_file=False)
        run_ledger_stream(spark, root, wh, ckpt, manifest, exact=True, layout="lines", max_files_per_trigger=4).awaitTermination()
    return wh


def stream_ledger_days(spark: SparkSession, d: str) -> DataFrame:
    """Closed days of a backlog that is read in small batches, in whatever order its files come."""
    from aeris.streaming.ledger import STATS

    return _ledger(spark, d, [F.lit(True)]).read(STATS)


def stream_late_rows(spark: SparkSession, d: str) -> DataFrame:
    """A tenth of the measurements lands after the days of the others were closed: late rows by day."""
    from aeris.streaming.ledger import late_counts

    return late_counts(_ledger(spark, d, [F.col("event_id") % 10 != 0, F.col("event_id") % 10 == 0]))


REPORTS.update({
    "manifest_files": manifest_files,
    "manifest_pruned_measurements": manifest_pruned_measurements,
    "incremental_daily_stats": incremental_daily_stats,
    "stream_ledger_days": stream_ledger_days,
    "stream_late_rows": stream_late_rows,
})
ORACLE_SQL.update({
    "manifest_files": f"""WITH {M}
  SELECT sensor_id - sensor_id % 500 + 1 AS folder, count(*) AS rows, CAST(0 AS BIGINT) AS undated, CAST(0 AS BIGINT) AS unkeyed,
         CAST(0 AS BIGINT) AS faults, min(day) AS min_day, max(day) AS max_day, count(DISTINCT sensor_id) AS sensors
  FROM m GROUP BY 1""",
    "manifest_pruned_measurements": f"""WITH {M}, {SENS} {RAW} WHERE day >= '{ODD_WINDOW[0]}' AND day < '{ODD_WINDOW[1]}'
    AND sensor_id IN (SELECT sensor_id FROM sens WHERE location_id % 100 = 7)""",
    "incremental_daily_stats": f"WITH {M}, {DAILY} SELECT * FROM daily",
    "stream_ledger_days": ORACLE_SQL["stream_closed_days"],
    "stream_late_rows": """WITH m AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events),
  first AS (SELECT DISTINCT day FROM m WHERE event_id % 10 <> 0)
  SELECT day, count(*) AS n FROM m WHERE event_id % 10 = 0 AND day IN (
    SELECT day FROM first WHERE CAST(day AS DATE) + 2 <= (SELECT CAST(max(day) AS DATE) FROM first)) GROUP BY day""",
})


# ---------------------------------------------------------------- sketches, history, zones, sessions

def profile_from_sketches(spark: SparkSession, d: str) -> DataFrame:
    """The completeness profile from sketches that were added in two parts of the days, and whether its sensor counts lie
    within the sketches' error of the exact ones."""
    from aeris.operators.sketches import add_days, profile_of_sketches, within_error

    wh, sensors = _warehouse(spark, "sketches"), sensors_dim(spark, d)
    daily = daily_sensor_stats(spark, d)
    for part in (F.col("day") >= CHANGED, F.col("day") < CHANGED):
        add_days(wh, daily.where(part), sensors)
    exact = op.parameter_profile(daily, sensors, exact=True, sort=False).select("sensor_parameter_displayName", F.col("nb_capteurs").alias("n"))
    merged = profile_of_sketches(wh.read("profile_sketches"), exact=True).join(exact, "sensor_parameter_displayName")
    return merged.select("sensor_parameter_displayName", "avg_completeness_ratio", "capteurs_inactifs", "capteurs_sous_80_pct",
                         within_error(F.col("nb_capteurs"), F.col("n")).alias("nb_capteurs_close"))


def as_of_locations(spark: SparkSession, d: str) -> DataFrame:
    """Daily statistics with the name that their station had on the day: every third station is renamed between two loads, the third load
    brings nothing new and lacks some stations."""
    from aeris.operators.history import as_of_join, merge_history, open_history

    locations = locations_dim(spark, d).select("location_id", "location_name", "provider_id")
    renamed = locations.withColumn("location_name", F.when(F.col("location_id") % 3 == 0, F.concat("location_name", F.lit(" (moved)")))
                                   .otherwise(F.col("location_name")))
    wh = _warehouse(spark, "history")
    wh.write(open_history(locations, "location_id", "2024-01-03"), "locations_0")
    for i, (day, batch) in enumerate(((CHANGED, renamed), ("2024-01-20", renamed.where("location_id % 2 = 0")))):
        wh.write(merge_history(wh.read(f"locations_{i}"), batch, "location_id", day), f"locations_{i + 1}")
    daily = daily_sensor_stats(spark, d).select("day", "sensor_id", "parameter_id", "value")
    facts = daily.join(sensors_dim(spark, d).select("sensor_id", "location_id"), "sensor_id")
    return as_of_join(facts, wh.read("locations_2"), "location_id", fields=["location_name"])


def local_days_by_zone(spark: SparkSession, d: str) -> DataFrame:
    """Events of a whole year at an instant in one of five zones: the local day, clock-change days included."""
    import datetime as dt

    from aeris.operators.zones import with_local_time, zone_transitions

    zone = F.get(F.array(*map(F.lit, ZONES)), F.col("event_id") % len(ZONES))
    seconds = F.unix_seconds(F.concat(A.ntz_text(F.col("ts")), F.lit("Z")).cast("timestamp")) + (F.col("event_id") % 366) * 86400
    rows = A.table(spark, d, "events").select("event_id", zone.alias("zone"), F.timestamp_seconds(seconds).alias("instant"))
    transitions = zone_transitions(rows, dt.date(2023, 12, 1), dt.date(2025, 12, 31))
    return with_local_time(rows, transitions, "instant").select("event_id", "zone", "local_day", F.hour("local_time").alias("local_hour"))


def sensor_outages(spark: SparkSession, d: str) -> DataFrame:
    from aeris.operators.sessions import outages, sensor_sessions, with_event_time

    found = outages(sensor_sessions(with_event_time(A.raw_measurements(spark, d)), "2 days"))
    return found.select("sensor_id", F.unix_seconds("silent_from").alias("silent_from"), F.unix_seconds("silent_until").alias("silent_until"), "seconds")


def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions that the stream of landed pages has closed."""
    from aeris.operators.sessions import run_session_stream
    from aeris.session import scratch_path

    sink, ckpt = scratch_path(spark, "sessions"), scratch_path(spark, "sessions-ckpt")
    run_session_stream(spark, _landed_pages(spark, d), sink, ckpt, gap="2 days", lateness="1 day", layout="lines").awaitTermination()
    rows = spark.read.schema("sensor_id int, first_seen timestamp, last_seen timestamp, measurements long").parquet(sink)
    return rows.select("sensor_id", F.unix_seconds("first_seen").alias("first_seen"), F.unix_seconds("last_seen").alias("last_seen"), "measurements")


#: Day on which stations are renamed, and zones of ``local_days_by_zone`` (half and quarter hours, a half-hour clock change, none).
CHANGED = "2024-01-15"
ZONES = ("Europe/Paris", "America/New_York", "Asia/Kathmandu", "Australia/Lord_Howe", "America/St_Johns")

REPORTS.update({
    "profile_from_sketches": profile_from_sketches,
    "as_of_locations": as_of_locations,
    "local_days_by_zone": local_days_by_zone,
    "sensor_outages": sensor_outages,
    "stream_sessions": stream_sessions,
})

SESSIONS = f"""{M},
  steps AS (SELECT sensor_id, wall_clock_ts AS ts, CASE WHEN wall_clock_ts - lag(wall_clock_ts) OVER w <= INTERVAL 2 DAY THEN 0 ELSE 1 END AS new
            FROM m WINDOW w AS (PARTITION BY sensor_id ORDER BY wall_clock_ts)),
  islands AS (SELECT sensor_id, ts, sum(new) OVER (PARTITION BY sensor_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS island FROM steps),
  sessions AS (SELECT sensor_id, epoch(min(ts))::BIGINT AS first_seen, epoch(max(ts))::BIGINT AS last_seen, count(*) AS measurements
               FROM islands GROUP BY sensor_id, island)"""
ORACLE_SQL.update({
    "profile_from_sketches": ORACLE_SQL["parameter_profile"].replace("count(DISTINCT sensor_id) AS nb_capteurs", "true AS nb_capteurs_close"),
    "as_of_locations": f"""WITH {M}, {DAILY}, {SENS}
  SELECT d.day, d.sensor_id, d.parameter_id, d.value, s.location_id,
         CASE WHEN d.day < '2024-01-03' THEN NULL WHEN d.day >= '{CHANGED}' AND s.location_id % 3 = 0 THEN c.c_name || ' (moved)' ELSE c.c_name END AS location_name
  FROM daily d JOIN sens s ON d.sensor_id = s.sensor_id JOIN customer c ON c.c_custkey = s.location_id""",
    "local_days_by_zone": f"""WITH e AS (
    SELECT event_id, [{", ".join(f"'{z}'" for z in ZONES)}][1 + event_id % {len(ZONES)}] AS zone,
           date_trunc('second', ts) + to_days(CAST(event_id % 366 AS INTEGER)) AS utc FROM events),
  l AS (SELECT event_id, zone, timezone(zone, timezone('UTC', utc)) AS t FROM e)
  SELECT event_id, zone, strftime(t, '%Y-%m-%d') AS local_day, CAST(hour(t) AS INTEGER) AS local_hour FROM l""",
    "sensor_outages": f"""WITH {SESSIONS},
  x AS (SELECT sensor_id, first_seen, lag(last_seen) OVER (PARTITION BY sensor_id ORDER BY first_seen) AS silent_from FROM sessions)
  SELECT sensor_id, silent_from, first_seen AS silent_until, first_seen - silent_from AS seconds FROM x WHERE silent_from IS NOT NULL""",
    "stream_sessions": f"""WITH {SESSIONS}
  SELECT * FROM sessions WHERE last_seen + 2 * 86400 <= (SELECT epoch(max(wall_clock_ts))::BIGINT FROM m) - 86400""",
})


# ---------------------------------------------------------------- file layout, paged source

def space_filling_reads(spark: SparkSession, d: str) -> DataFrame:
    """One day of all sensors and all days of some sensors, from a fact whose files lie along a curve over both."""
    from aeris.functions.time import day_text
    from aeris.operators.layout import along_curve, day_and_sensor

    wh = _warehouse(spark, "curve")
    raw = A.raw_measurements(spark, d).withColumn("day", day_text(F.col("period.datetimeFrom.local")))
    wh.write(along_curve(op.raw_measurements(raw, keep=["day"]), day_and_sensor()), "raw_measurements")
    fact = wh.read("raw_measurements")
    return fact.where((F.col("day") == WINDOW[0]) | F.col("sensor_id").between(*SENSORS)).drop("day")


def paged_source_locations(spark: SparkSession, d: str) -> DataFrame:
    """Locations through the paged source: the first pages and the others, read as two ranges of page numbers."""
    from aeris import schemas
    from aeris.session import scratch_path
    from aeris.sources import landed
    from aeris.sources.paged import page_texts

    path = scratch_path(spark, "paged-source")
    A.land_locations(spark, d, path, page_size=100)
    parts = [page_texts(spark, path, where=[("page", test, 3)]) for test in ("<", ">=")]
    return op.locations_dim(landed.page_rows(landed.parse_text(parts[0].unionByName(parts[1]), schemas.LOCATION)))


def paged_source_stream(spark: SparkSession, d: str) -> DataFrame:
    """The same as a stream of page numbers, started anew after it has stopped."""
    from aeris import schemas
    from aeris.session import scratch_path
    from aeris.sources.paged import run_page_stream

    path, sink, ckpt = (scratch_path(spark, x) for x in ("paged-source", "paged-sink", "paged-ckpt"))
    A.land_locations(spark, d, path, page_size=100)
    for _ in range(2):
        run_page_stream(spark, path, schemas.LOCATION, sink, ckpt).awaitTermination()
    return op.locations_dim(spark.read.schema(schemas.LOCATION).parquet(sink))


#: Sensors whose whole history ``space_filling_reads`` asks for.
SENSORS = (100, 199)

REPORTS.update({
    "space_filling_reads": space_filling_reads,
    "paged_source_locations": paged_source_locations,
    "paged_source_stream": paged_source_stream,
})
ORACLE_SQL.update({
    "space_filling_reads": f"WITH {M} {RAW} WHERE day = '{WINDOW[0]}' OR sensor_id BETWEEN {SENSORS[0]} AND {SENSORS[1]}",
    "paged_source_locations": ORACLE_SQL["locations_dim"],
    "paged_source_stream": ORACLE_SQL["locations_dim"],
})
