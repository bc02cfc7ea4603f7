"""Dimension and bridge tables from the raw API documents.

Projections are plain ``select``s of struct paths and bridges are
``explode``s; both are narrow (no shuffle) and let Parquet scans prune nested
columns (``ReadSchema`` keeps only the fields used).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeris.functions.time import local_timestamp


def parameters_dim(raw: DataFrame) -> DataFrame:
    """Parameters: id, name, units, displayName, description → ``param_*``."""
    return raw.select(
        F.col("id").alias("param_id"),
        F.col("name").alias("param_name"),
        F.col("units").alias("param_units"),
        F.col("displayName").alias("param_displayName"),
        F.col("description").alias("param_description"),
    )


def countries_dim(raw: DataFrame) -> DataFrame:
    """Countries; the first/last measure datetimes stay text as in the source."""
    return raw.select(
        F.col("id").alias("country_id"),
        F.col("code").alias("country_code"),
        F.col("datetimeFirst").alias("date_first_measure"),
        F.col("datetimeLast").alias("date_last_measure"),
        F.col("name").alias("country_name"),
    )


def explode_fields(owner: F.Column, array: str, fields: dict[str, str]) -> list:
    """``explode`` of selected fields of an array of structs.

    Same rows as exploding the array (NULL or empty array → no row, duplicates
    kept, a NULL element → a row of NULLs), but written as ``arrays_zip`` of the
    field arrays so Parquet reads only those nested fields.
    """
    zipped = F.arrays_zip(*[F.col(f"{array}.{path}").alias(name) for name, path in fields.items()])
    return [owner, F.explode(zipped).alias("__e")]


def _owner_parameters(raw: DataFrame, owner: str) -> DataFrame:
    return raw.select(*explode_fields(F.col("id").alias(owner), "parameters", {"parameter_id": "id"})).select(
        owner, "__e.parameter_id"
    )


def country_parameters(raw: DataFrame) -> DataFrame:
    """Bridge (country_id, parameter_id): one row per element of ``parameters``."""
    return _owner_parameters(raw, "country_id")


def providers_dim(raw: DataFrame) -> DataFrame:
    """Providers (``sourceName`` → ``provider_source_name``)."""
    return raw.select(
        F.col("id").alias("provider_id"),
        F.col("name").alias("provider_name"),
        F.col("sourceName").alias("provider_source_name"),
        F.col("datetimeAdded").alias("provider_datetime_added"),
        F.col("datetimeLast").alias("provider_datetime_last"),
    )


def provider_parameters(raw: DataFrame) -> DataFrame:
    """Bridge (provider_id, parameter_id)."""
    return _owner_parameters(raw, "provider_id")


def locations_dim(raw: DataFrame, time_mode: str = "wall_clock") -> DataFrame:
    """Locations with provider, country and coordinates flattened.

    ``location_datetime_last_local`` is the local wall clock of
    ``datetimeLast.local`` as ``timestamp_ntz`` (the original call passed a zone
    name as a datetime pattern, which current Spark rejects; the wall clock is
    its evident intent). Malformed text gives NULL.
    """
    return raw.select(
        F.col("id").alias("location_id"),
        F.col("name").alias("location_name"),
        F.col("isMonitor").alias("location_monitor"),
        local_timestamp(F.col("datetimeLast.local"), time_mode).alias("location_datetime_last_local"),
        F.col("provider.id").alias("provider_id"),
        F.col("provider.name").alias("provider_name"),
        F.col("coordinates.latitude").alias("latitude"),
        F.col("coordinates.longitude").alias("longitude"),
        F.col("country.id").alias("location_country_id"),
        F.col("country.name").alias("location_country_name"),
    )


def sensors_dim(raw: DataFrame) -> DataFrame:
    """Sensors of each location (explode ``sensors``)."""
    fields = {
        "sensor_id": "id",
        "sensor_name": "name",
        "sensor_parameter_id": "parameter.id",
        "sensor_parameter_displayName": "parameter.displayName",
    }
    return raw.select(*explode_fields(F.col("id").alias("location_id"), "sensors", fields)).select(
        "location_id", *[f"__e.{k}" for k in fields]
    )


def location_points(locations: DataFrame) -> DataFrame:
    """Points to geocode: location_id, city_longitude, city_latitude."""
    return locations.select(
        "location_id",
        F.col("longitude").alias("city_longitude"),
        F.col("latitude").alias("city_latitude"),
    )


def city_points(cities: DataFrame) -> DataFrame:
    """Cities of the stations; the first postcode, NULL when the list is empty."""
    return cities.select(
        "location_id",
        "latitude",
        "longitude",
        F.col("nom").alias("city_name"),
        F.col("code").alias("city_insee_code"),
        F.get(F.col("codesPostaux"), F.lit(0)).alias("city_postcode"),
        F.col("population").alias("city_population"),
    )
