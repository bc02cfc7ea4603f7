"""Station selection, sensor/location joins, star-schema enrichment, key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def active_locations(
    locations: DataFrame,
    country_id: int = 22,
    since: str = "2025-01-01",
    column: str = "location_datetime_last_local",
) -> DataFrame:
    """Locations of one country whose last measurement is on or after ``since``.

    ``to_date(ts) >= d`` is written as ``ts >= timestamp d`` so the predicate
    is sargable and reaches the Parquet scan; a NULL datetime is dropped.
    """
    cut = F.lit(since).cast(locations.schema[column].dataType)
    return locations.filter((F.col("location_country_id") == F.lit(country_id)) & (F.col(column) >= cut))


def country_sensors(sensors: DataFrame, locations: DataFrame) -> DataFrame:
    """Sensors of the given locations: inner join USING ``location_id``.

    Columns: location_id, the sensor columns, then the location columns.
    """
    return sensors.join(locations, "location_id", "inner")


def enrich_measurements(
    facts: DataFrame,
    sensors: DataFrame,
    locations: DataFrame | None = None,
    parameters: DataFrame | None = None,
    providers: DataFrame | None = None,
    countries: DataFrame | None = None,
    cities: DataFrame | None = None,
) -> DataFrame:
    """The star-schema read path: fact → sensors → locations → cities /
    providers / countries, and fact → parameters, all left joins on the drawn
    keys. No side is hinted: from the sizes that Spark knows or measures at
    run time, small dimensions are broadcast and the fact isn't shuffled."""
    out = facts.join(sensors, "sensor_id", "left")
    if parameters is not None:
        out = out.join(parameters, out["parameter_id"] == parameters["param_id"], "left")
    if locations is not None:
        loc = locations.drop(*[c for c in locations.columns if c in out.columns and c != "location_id"])
        out = out.join(loc, "location_id", "left")
    if providers is not None and "provider_id" in out.columns:
        prov = providers.drop(*[c for c in providers.columns if c in out.columns and c != "provider_id"])
        out = out.join(prov, "provider_id", "left")
    if countries is not None and "location_country_id" in out.columns:
        out = out.join(countries, out["location_country_id"] == countries["country_id"], "left")
    if cities is not None:
        cit = cities.drop(*[c for c in cities.columns if c in out.columns and c != "location_id"])
        out = out.join(cit, "location_id", "left")
    return out


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows of ``child`` whose ``key`` has no match in ``parent`` (left anti).

    A NULL key never matches, so rows with a NULL key are orphans too.
    """
    parent_key = parent_key or key
    keys = parent.select(F.col(parent_key).alias("__k")).where(F.col("__k").isNotNull())
    return child.join(keys, child[key] == keys["__k"], "left_anti")


def duplicate_keys(dim: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once: (key, n)."""
    return dim.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
