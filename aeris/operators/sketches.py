"""Completeness profile from daily sketches.

A profile row counts distinct sensors, which can't be added up over days. Kept instead is one row per day and pollutant: an HLL sketch
of its sensors and sums of all else. Rows of any days merge into ``parameter_profile``'s columns without reading the daily
statistics again; the sensor count is an estimate with a relative standard error of about 1.04 / sqrt(2^LG_K), the rest is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeris.functions.numeric import rounder
from aeris.operators.profile import completeness_ratio

#: Logarithm of a sketch's registers (4,096, some 2.5 KB), and three standard errors of its estimates.
LG_K = 12
ERROR = 3 * 1.04 / 2 ** (LG_K / 2)


def profile_sketches(daily: DataFrame, sensors: DataFrame) -> DataFrame:
    """(day, sensor_parameter_displayName, sensors_sketch, ratio_sum, ratio_n, inactive, below_80) of daily statistics joined
    with their sensors as in ``parameter_profile``. Sketches are filled before the shuffle."""
    joined = daily.select("day", "sensor_id", "observed_count", "expected_count").join(
        sensors.select("sensor_id", "sensor_parameter_displayName"), "sensor_id")
    ratio = completeness_ratio(F.col("observed_count"), F.col("expected_count"))
    return joined.withColumn("ratio", ratio).groupBy("day", "sensor_parameter_displayName").agg(
        F.hll_sketch_agg("sensor_id", F.lit(LG_K)).alias("sensors_sketch"),
        F.sum("ratio").alias("ratio_sum"),
        F.count("ratio").alias("ratio_n"),
        F.count_if(F.col("observed_count") == 0).alias("inactive"),
        F.count_if(F.col("ratio") < 0.8).alias("below_80"),
    )


def profile_of_sketches(sketches: DataFrame, exact: bool = False) -> DataFrame:
    """``parameter_profile``'s columns over all days of ``sketches``; ``nb_capteurs`` is estimated."""
    rnd = rounder(exact)
    return sketches.groupBy("sensor_parameter_displayName").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sensors_sketch")).alias("nb_capteurs"),
        rnd(F.sum("ratio_sum") / F.sum("ratio_n"), 3).alias("avg_completeness_ratio"),
        F.sum("inactive").alias("capteurs_inactifs"),
        F.sum("below_80").alias("capteurs_sous_80_pct"),
    )


def within_error(estimate: Column, count: Column) -> Column:
    """Whether an estimate lies within three standard errors of the count (and at least one of it)."""
    return F.abs(estimate - count) <= F.greatest(F.lit(1.0), count * ERROR)


def add_days(warehouse, daily: DataFrame, sensors: DataFrame, name: str = "profile_sketches") -> None:
    """Renew the sketches of the days of ``daily`` in table ``name``, a folder per day; other days stay as they are. The day's statistics
    must be whole, as a sketch can't forget."""
    warehouse.write(profile_sketches(daily, sensors), name, mode="replace_partitions", partition_by=["day"])
