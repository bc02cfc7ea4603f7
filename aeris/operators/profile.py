"""Completeness profile of the sensor network per pollutant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeris.functions.numeric import rounder


def completeness_ratio(observed, expected):
    """observed / expected as double; NULL when expected is 0 or NULL."""
    return F.when(expected != 0, observed / expected).otherwise(F.lit(None))


def parameter_profile(
    daily: DataFrame,
    sensors: DataFrame,
    exact: bool = False,
    sort: bool = True,
) -> DataFrame:
    """Per ``sensor_parameter_displayName`` of the joined sensors:

    nb_capteurs = distinct sensors, avg_completeness_ratio = round(avg ratio, 3),
    capteurs_inactifs = sensor-days with observed_count = 0,
    capteurs_sous_80_pct = sensor-days with ratio < 0.8 (NULL ratio counts 0).

    The grain is the sensor-day of the daily fact (inner join on sensor_id: a
    sensor listed twice multiplies its days, as in the original). Ordered by
    the average ratio ascending, NULLs first, then by name.
    """
    rnd = rounder(exact)
    joined = daily.select("sensor_id", "observed_count", "expected_count").join(
        sensors.select("sensor_id", "sensor_parameter_displayName"), "sensor_id")
    ratio = completeness_ratio(F.col("observed_count"), F.col("expected_count"))
    out = (
        joined.withColumn("completeness_ratio", ratio)
        .groupBy("sensor_parameter_displayName")
        .agg(
            F.count_distinct("sensor_id").alias("nb_capteurs"),
            rnd(F.avg("completeness_ratio"), 3).alias("avg_completeness_ratio"),
            F.sum(F.when(F.col("observed_count") == 0, 1).otherwise(0)).alias("capteurs_inactifs"),
            F.sum(F.when(F.col("completeness_ratio") < 0.8, 1).otherwise(0)).alias("capteurs_sous_80_pct"),
        )
    )
    if sort:
        out = out.orderBy(F.asc_nulls_first("avg_completeness_ratio"), F.asc("sensor_parameter_displayName"))
    return out
