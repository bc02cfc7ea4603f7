"""The daily air-quality ETL as one function.

Same twelve steps and tables as the original job, re-planned for Spark:

====  ========================  =========  =============================================
step  table                     kind       built from
====  ========================  =========  =============================================
1     parameters                dimension  landed parameter pages
2     countries                 dimension  landed country pages
3     parameters_per_country    dimension  countries → explode parameters
4     providers                 dimension  landed provider pages
5     param_per_providers       dimension  providers → explode parameters
6     world_locations           dimension  landed location pages (read in parallel)
7     world_sensors             dimension  locations → explode sensors
8     france_locations          dimension  active locations of ``country_id`` since ``since``
9     france_sensors            dimension  world_sensors ⋈ france_locations
10    france_cities_sensors     dimension  spatial join of station points with communes
11    raw_measurements          fact       landed measurements ⋉ france_sensors, in window
12    agg_measurements          fact       daily statistics of the window's raw fact
====  ========================  =========  =============================================

Each landed source is parsed at most once per run, into a Parquet staging
table (``staged_<source>``) that the steps and the quarantine read; steps read
the *stored* upstream tables, so a failure never re-runs finished steps. Of the
measurements only what the run needs is parsed: pages in ``fetch_date=<day>``
folders from the window's first day to the run date, and of these what is in
``sensor_id=<id>`` folders of the selected sensors or has a key of its own. Facts are partitioned by
``day`` and replace the days of the run's window, so re-running a day is
idempotent and a day that became empty is removed. Pages, elements and
measurements without a day or sensor that cannot be loaded land in ``quarantine_pages``
with a reason; a dimension whose pages were quarantined is built again by the
next run.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeris import operators as op
from aeris import schemas
from aeris.functions.time import a_day, day_text
from aeris.plans.load import StepResult, Warehouse, load_step
from aeris.sources import landed
from aeris.sources.manifest import LandingManifest


@dataclass
class Landing:
    """Folders of landed API pages (see ``sources.landed`` for ``layout``) and the commune table."""

    parameters: str
    countries: str
    providers: str
    locations: str
    measurements: str  # <root>/[fetch_date=<day>/]sensor_id=<id>/... pages
    communes: str | None = None  # Parquet table of schemas.COMMUNE
    layout: str = "auto"


SOURCES = {
    "parameters": schemas.PARAMETER,
    "countries": schemas.COUNTRY,
    "providers": schemas.PROVIDER,
    "locations": schemas.LOCATION,
    "measurements": schemas.MEASUREMENT,
}
QUARANTINE = "source string, source_file string, element int, raw_text string, reason string, run_date string"


class _Staging:
    """Parse each landed source at most once per run, into ``staged_<source>``.

    Only sources whose steps actually build are parsed (a skipped dimension's
    pages are not read). Rows and the quarantine both come from the staged
    Parquet, so a page is parsed once although several steps use it. The
    staging tables are Parquet folders under ``root`` whatever the warehouse
    is, as a database can't take their nested columns.
    """

    def __init__(self, spark: SparkSession, landing: Landing, root: str):
        self.spark, self.landing = spark, landing
        self.tables = Warehouse(spark, "path", root=root)
        self.done: list[str] = []
        self.restrict = {}
        self.files: dict[str, list[str]] = {}

    def pages(self, source: str) -> DataFrame:
        name = f"staged_{source}"
        if source not in self.done:
            parsed = landed.parse_pages(self.spark, getattr(self.landing, source), SOURCES[source],
                                        self.landing.layout, self.restrict.get(source), self.files.get(source))
            self.tables.write(parsed, name, mode="overwrite")
            self.done.append(source)
        return self.tables.read(name)

    def rows(self, source: str) -> DataFrame:
        rows = landed.page_rows(self.pages(source))
        return landed.measurement_rows(rows) if source == "measurements" else rows

    def measurements(self) -> DataFrame:
        return self.rows("measurements").withColumn("day", day_text(F.col("period.datetimeFrom.local")))

    def quarantine(self, run_date: str) -> DataFrame:
        """What this run could not load: pages, elements, and measurements without a day."""
        out = self.spark.createDataFrame([], QUARANTINE)
        for src in self.done:
            bad = landed.page_quarantine(self.pages(src)).select(
                F.lit(src).alias("source"), "source_file", "element", "raw_text", "reason")
            if src == "measurements":
                fault = F.when(~a_day(F.col("day")), "no_day").when(F.col("sensor_id").isNull(), "no_sensor")
                rows = self.measurements().withColumn("__reason", fault)
                bad = bad.unionByName(rows.where("__reason is not null").select(
                    F.lit(src).alias("source"), F.lit(None).cast("string").alias("source_file"),
                    F.lit(None).cast("int").alias("element"),
                    F.to_json(F.struct(*schemas.MEASUREMENT.fieldNames())).alias("raw_text"), F.col("__reason").alias("reason")))
            out = out.unionByName(bad.withColumn("run_date", F.lit(run_date)))
        return out

    def incomplete(self) -> list[str]:
        """Sources of this run with a quarantined page or element."""
        return [src for src in self.done if src != "measurements" and not landed.page_quarantine(self.pages(src)).isEmpty()]


#: A text that may hold a document with a key of its own: JSON may also spell the key's characters as escapes.
OWN_KEY = r"sensor_id|\\u00(?:5[fF]|6[0-9a-fA-F]|7[0-9])"


def _needed(start: str, run_date: str, sensors: DataFrame):
    """Restriction of landed measurement texts, before they are parsed, to what a run needs: folders of its days and selected
    sensors, folders without a key that can be read, and any text that may hold a document with a sensor key of its own."""

    def restrict(text: DataFrame) -> DataFrame:
        if "fetch_date" in text.columns:
            day, kind = F.col("fetch_date"), text.schema["fetch_date"].dataType
            undated = (day.try_cast("date") if kind.typeName() == "string" else day).isNull()
            text = text.where(undated | ((day >= F.lit(start).cast(kind)) & (day <= F.lit(run_date).cast(kind))))
        if "sensor_id" in text.columns:
            chosen = sensors.select(F.col("sensor_id").alias("__sensor")).where("__sensor is not null").distinct()
            folder = F.col("sensor_id").try_cast("int")
            text = (text.join(chosen, folder == F.col("__sensor"), "left")
                    .where(F.col("__sensor").isNotNull() | folder.isNull() | F.col("value").rlike(OWN_KEY)).drop("__sensor"))
        return text

    return restrict


def run_daily_etl(
    spark: SparkSession,
    landing: Landing,
    warehouse: Warehouse,
    run_date: str,
    window: tuple[str, str] | None = None,
    country_id: int = 22,
    since: str = "2025-01-01",
    expected_per_day: int = 24,
    cell_size: float = 0.05,
    refresh_dimensions: bool = False,
    exact: bool = False,
    fact_mode: str = "replace",
    staging_root: str | None = None,
    manifest: str | None = None,
) -> dict[str, StepResult]:
    """Run the twelve steps; return each step's result (action, row count, table).

    ``window`` is the half-open range of local days to load (default: the day
    before ``run_date``, like the original's yesterday→today pull).
    ``exact`` selects the decimal-stable rounding of the daily statistics.
    ``fact_mode`` is ``load_step``'s (a JDBC warehouse needs ``append``);
    ``staging_root`` is the folder of the staging tables (default: in a path
    warehouse its root, else a new folder under the shared checkpoint folder).
    ``manifest`` is the folder of the measurements' ``LandingManifest``: it is
    brought up to date, and the run opens only the files that may hold
    something for it, with the same facts and quarantine.
    """
    from aeris.functions.time import run_window

    start, end = window or run_window(run_date)
    if staging_root is None:
        from aeris.session import scratch_path

        staging_root = warehouse.root if warehouse.backend == "path" else scratch_path(spark, "staging")
    stage = _Staging(spark, landing, staging_root)
    # sources whose last build lacked quarantined pages: their dimensions are built again
    again = set()
    if stage.tables.exists("incomplete_sources"):
        again = {r.source for r in stage.tables.read("incomplete_sources").collect()}  # at most one row per source
    res: dict[str, StepResult] = {}

    def step(name: str, build, source: str | None = None, **extra) -> DataFrame:
        dim = {"kind": "dimension", "refresh": refresh_dimensions or source in again}
        res[name] = load_step(warehouse, name, build, **{**dim, **extra})
        return res[name].table

    step("parameters", lambda: op.parameters_dim(stage.rows("parameters")), "parameters")
    step("countries", lambda: op.countries_dim(stage.rows("countries")), "countries")
    step("parameters_per_country", lambda: op.country_parameters(stage.rows("countries")), "countries")
    step("providers", lambda: op.providers_dim(stage.rows("providers")), "providers")
    step("param_per_providers", lambda: op.provider_parameters(stage.rows("providers")), "providers")
    step("world_locations", lambda: op.locations_dim(stage.rows("locations")), "locations")
    step("world_sensors", lambda: op.sensors_dim(stage.rows("locations")), "locations")
    locations = step("france_locations",
                     lambda: op.active_locations(warehouse.read("world_locations"), country_id, since), "locations")
    sensors = step("france_sensors",
                   lambda: op.country_sensors(warehouse.read("world_sensors"), warehouse.read("france_locations")), "locations")
    if landing.communes:
        step("france_cities_sensors", lambda: op.city_points(op.assign_communes(
            op.location_points(locations), spark.read.parquet(landing.communes), cell_size=cell_size)), "locations")

    if manifest:
        listed = LandingManifest(spark, landing.measurements, manifest, landing.layout)
        listed.refresh()
        stage.files["measurements"] = listed.files(listed.needed(start, end, sensors, fetched=(start, run_date)))
    stage.restrict["measurements"] = _needed(start, run_date, sensors)

    def selected() -> DataFrame:
        m = stage.measurements().where(a_day(F.col("day")))
        return op.measurements_of_sensors(op.measurements_between(m, start, end, column="day"), sensors)

    fact = {"kind": "fact", "partition_by": ["day"], "cluster_by": ["sensor_id"], "refresh": False}
    keyed = {"fact_mode": fact_mode, "window": (start, end)}
    step("raw_measurements", lambda: op.raw_measurements(selected(), keep=["day"]), **fact, **keyed,
         merge_keys=["day", "sensor_id", "parameter_id", "period_datetime_local"])
    # The aggregate reads the raw fact just written for this window (pruned to
    # its days, five flat columns) instead of parsing and joining again.
    step("agg_measurements", lambda: op.daily_stats_of_raw_fact(
        op.measurements_between(warehouse.read("raw_measurements"), start, end, column="day"),
        expected_per_day=expected_per_day, exact=exact), **fact, **keyed,
        merge_keys=["day", "sensor_id", "parameter_id"])
    after = (date.fromisoformat(run_date) + timedelta(days=1)).isoformat()
    res["quarantine_pages"] = load_step(
        warehouse, "quarantine_pages", lambda: stage.quarantine(run_date), kind="fact", partition_by=["run_date"],
        fact_mode="append" if fact_mode == "append" else "replace", window=(run_date, after))
    lacking = stage.incomplete()
    unread = [src for src in SOURCES if src in lacking or (src in again and src not in stage.done)]
    stage.tables.write(spark.createDataFrame([(src,) for src in unread], "source string"), "incomplete_sources")
    return res
