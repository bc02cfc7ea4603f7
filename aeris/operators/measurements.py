"""Measurement facts: raw projection, pull window, sensor restriction, daily stats."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeris.functions.numeric import rounder
from aeris.functions.time import day_text, local_timestamp


def raw_measurements(raw: DataFrame, time_mode: str = "reference", keep: list[str] | tuple = ()) -> DataFrame:
    """Flatten measurement documents into the raw fact.

    ``period_datetime_local`` follows the original job by default (negative
    offsets stripped, others converted to UTC, see ``local_timestamp``).
    ``keep`` names extra input columns to carry along (e.g. a partition column).
    """
    return raw.select(
        "sensor_id",
        "value",
        local_timestamp(F.col("period.datetimeFrom.local"), time_mode).alias("period_datetime_local"),
        F.col("parameter.id").alias("parameter_id"),
        F.col("parameter.name").alias("parameter_name"),
        F.col("parameter.units").alias("parameter_units"),
        F.col("coverage.expectedCount").alias("coverage_expectedCount"),
        F.col("coverage.observedCount").alias("coverage_observedCount"),
        *keep,
    )


def measurements_between(df: DataFrame, start, end, column: str = "period_datetime_local") -> DataFrame:
    """Half-open window ``start <= column < end`` with typed literals.

    On the day-partitioned fact (``column="day"``) this is partition pruning;
    on Parquet it is a pushed filter.
    """
    dtype = df.schema[column].dataType
    lo = F.lit(start.isoformat() if isinstance(start, (_dt.date, _dt.datetime)) else start).cast(dtype)
    hi = F.lit(end.isoformat() if isinstance(end, (_dt.date, _dt.datetime)) else end).cast(dtype)
    return df.filter((F.col(column) >= lo) & (F.col(column) < hi))


def measurements_of_sensors(measurements: DataFrame, sensors: DataFrame) -> DataFrame:
    """Keep the measurements of the selected sensors (left semi join).

    Replaces the driver-side ``collect`` of sensor ids; a repeated sensor id
    does not repeat its measurements.
    """
    keys = sensors.select("sensor_id").where(F.col("sensor_id").isNotNull())
    return measurements.join(keys, "sensor_id", "left_semi")


def daily_sensor_stats(raw: DataFrame, expected_per_day: int = 24, exact: bool = False) -> DataFrame:
    """Daily statistics per (day, sensor_id, parameter_id) of measurement documents.

    value = round(avg, 2), min/max rounded to 2, stddev_value = sample standard
    deviation (unrounded), median rounded to 2, observed_count = sum of
    ``coverage.observedCount``, expected_count = ``expected_per_day``. ``day``
    is the text before ``T`` of the local period start. NULL values are
    ignored; a one-value group has a NULL stddev.

    ``exact=True`` rounds through ``decimal(38,6)`` (and stddev to 6 digits) so
    results can be compared with another engine bit for bit.

    Plan: partial aggregation on the map side (the median keeps a value→count
    map, bounded by the distinct values of a group, not its rows), one shuffle
    on the group key, final aggregation. No global sort: order belongs to the
    reader's query, and the writer clusters by day.
    """
    flat = raw.select(
        day_text(F.col("period.datetimeFrom.local")).alias("day"),
        "sensor_id",
        F.col("parameter.id").alias("parameter_id"),
        "value",
        F.col("coverage.observedCount").alias("observed"),
    )
    return _daily(flat, expected_per_day, exact)


def daily_stats_of_raw_fact(fact: DataFrame, expected_per_day: int = 24, exact: bool = False) -> DataFrame:
    """The same statistics from the stored raw fact (flat columns, ``day``
    partition column), so a day-window filter prunes partitions and only five
    narrow columns are read."""
    flat = fact.select("day", "sensor_id", "parameter_id", "value", F.col("coverage_observedCount").alias("observed"))
    return _daily(flat, expected_per_day, exact)


def _daily(flat: DataFrame, expected_per_day: int, exact: bool) -> DataFrame:
    rnd = rounder(exact)
    v = F.col("value")
    return (
        flat.groupBy("day", "sensor_id", "parameter_id")
        .agg(
            rnd(F.avg(v), 2).alias("value"),
            rnd(F.min(v), 2).alias("min_value"),
            rnd(F.max(v), 2).alias("max_value"),
            (rnd(F.stddev_samp(v), 6) if exact else F.stddev_samp(v)).alias("stddev_value"),
            rnd(F.median(v), 2).alias("median_value"),
            F.sum("observed").alias("observed_count"),
        )
        .withColumn("expected_count", F.lit(expected_per_day))
    )
