"""Daily statistics from mergeable partials.

A partial is one row per (day, sensor_id, parameter_id) and batch: how often each value occurred, and the sum of the observed
counts. Partials of any split of the measurements merge into the same statistics as ``daily_sensor_stats`` of all of them, so
rows that arrive late are added without reading a day's measurements again. The histogram holds the distinct values of a group (some
24 of an hourly sensor and day), which is what the median's buffer holds as well; count, sum, extremes, the spread
around the exact mean, and the median all come from it, so nothing depends on the order of the merges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeris.functions.numeric import rounder

KEYS = ("day", "sensor_id", "parameter_id")


def partials_of_raw_fact(fact: DataFrame, keep: list[str] | tuple = ()) -> DataFrame:
    """Partials of flat measurement rows (``day``, ``sensor_id``, ``parameter_id``, ``value``, ``coverage_observedCount``): the keys,
    ``keep`` (columns that part the batches), ``values`` (array of value and its count, NULL values left out), ``rows`` and ``observed``.

    Values are counted before the first shuffle, so a hot group sends its distinct values and not its rows; the second gathers these."""
    by = [*KEYS, *keep]
    counted = fact.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n"), F.sum("coverage_observedCount").alias("observed"))
    entry = F.when(F.col("value").isNotNull(), F.struct(F.col("value").cast("double").alias("value"), "n"))
    return counted.groupBy(*by).agg(F.collect_list(entry).alias("values"), F.sum("n").alias("rows"), F.sum("observed").alias("observed"))


def _merged_values(partials: DataFrame, by: list[str]) -> DataFrame:
    return partials.groupBy(*by).agg(F.flatten(F.collect_list("values")).alias("values"), F.sum("rows").alias("rows"),
                                     F.sum("observed").alias("observed"))


def merge_partials(partials: DataFrame) -> DataFrame:
    """One partial per group in place of several, for compaction. A group has one row per batch, which bounds what is merged in a task."""
    merged = _merged_values(partials, list(KEYS))
    grown = F.map_from_entries(F.transform(F.array_distinct(F.transform("values", lambda e: e["value"])), lambda v: F.struct(
        v, F.aggregate(F.filter("values", lambda e: e["value"] == v), F.lit(0).cast("long"), lambda n, e: n + e["n"]))))
    return merged.select(*KEYS, F.transform(F.map_entries(grown), lambda e: F.struct(e["key"].alias("value"), e["value"].alias("n")))
                         .alias("values"), "rows", "observed")


def _at(values: Column, rank: Column) -> Column:
    """The value of that rank (from 0) in sorted (value, n) entries."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("value"))
    return F.aggregate(values, start, lambda acc, e: F.struct(
        (acc["n"] + e["n"]).alias("n"), F.when(acc["value"].isNull() & (acc["n"] + e["n"] > rank), e["value"]).otherwise(acc["value"]).alias("value"))
    )["value"]


def daily_stats_of_partials(partials: DataFrame, expected_per_day: int = 24, exact: bool = False) -> DataFrame:
    """The rows of ``daily_sensor_stats`` over all measurements that the partials stand for. One shuffle of partials, none of measurements."""
    rnd = rounder(exact)
    zero = F.lit(0.0)
    merged = _merged_values(partials, list(KEYS)).withColumn("values", F.array_sort("values"))
    merged = merged.withColumn("n", F.aggregate("values", F.lit(0).cast("long"), lambda n, e: n + e["n"]))
    merged = merged.withColumn("mean", F.when(F.col("n") > 0, F.aggregate("values", zero, lambda s, e: s + e["value"] * e["n"]) / F.col("n")))
    spread = F.aggregate("values", zero, lambda s, e: s + e["n"] * (e["value"] - F.col("mean")) * (e["value"] - F.col("mean")))
    low = _at(F.col("values"), F.floor((F.col("n") - 1) / 2))
    high = _at(F.col("values"), F.floor(F.col("n") / 2))
    deviation = F.when(F.col("n") > 1, F.sqrt(spread / (F.col("n") - 1)))
    # the extremes come back as the source's float, which is what the statistics of the measurements round
    least, most = (F.element_at("values", i)["value"].cast("float") for i in (1, -1))
    some = F.col("n") > 0
    return merged.select(
        *KEYS,
        rnd(F.col("mean"), 2).alias("value"),
        F.when(some, rnd(least, 2)).alias("min_value"),
        F.when(some, rnd(most, 2)).alias("max_value"),
        (rnd(deviation, 6) if exact else deviation).alias("stddev_value"),
        rnd((low + high) / 2, 2).alias("median_value"),
        F.col("observed").alias("observed_count"),
        F.lit(expected_per_day).alias("expected_count"),
    )


def add_batch(warehouse, fact: DataFrame, batch: int, partials: str = "partial_measurements", stats: str | None = "agg_measurements",
              expected_per_day: int = 24, exact: bool = False) -> list[str]:
    """Merge a batch of flat measurement rows into stored partials and, with ``stats``, renew the statistics of the days it touches.

    Partials lie by (day, batch): a batch that is given again replaces itself. Statistics of the touched days come from their partials
    alone, however many measurements those days have. A batch without rows leaves all as it is. Returns the days."""
    # every day but a NULL one is a folder of its own, so rows without a day are none of a day's statistics
    rows = partials_of_raw_fact(fact.where(F.col("day").isNotNull())).withColumn("batch", F.lit(batch).cast("long"))
    warehouse.write(rows, partials, mode="replace_partitions", partition_by=["day", "batch"], cluster_by=["sensor_id"])
    stored = warehouse.read(partials)
    days = [r.day for r in stored.where(F.col("batch") == batch).select("day").distinct().collect()]  # folders of one batch
    if days and stats:
        touched = live_rows(warehouse, partials).where(F.col("day").isin(days))
        warehouse.write(daily_stats_of_partials(touched, expected_per_day, exact), stats, mode="replace_partitions",
                        partition_by=["day"], cluster_by=["sensor_id"])
    return days


def compact_days(warehouse, days: list[str], table: str = "partial_measurements", merge=merge_partials) -> None:
    """Rewrite ``days`` of a table that lies by (day, batch) into ``<table>_merged``, by day alone, and drop their folders by batch.

    Readers take a day from the merged table once it is there (see ``live_rows``), and a merged day is never merged again, so a job that
    dies between the two writes, or is run again, loses and doubles nothing. Only days that get no more batches may be compacted."""
    if not days:
        return
    done = set()
    if warehouse.exists(f"{table}_merged"):
        done = {r.day for r in warehouse.read(f"{table}_merged").where(F.col("day").isin(days)).select("day").distinct().collect()}
    todo = [d for d in days if d not in done]
    if todo:
        rows = merge(warehouse.read(table).where(F.col("day").isin(todo)).drop("batch"))
        warehouse.write(rows, f"{table}_merged", mode="replace_partitions", partition_by=["day"], cluster_by=["sensor_id"])
    warehouse.drop_partitions(table, "day", days)


def live_rows(warehouse, table: str = "partial_measurements") -> DataFrame:
    """Every row once: a compacted day's merged ones, any other day's by batch."""
    by_batch = warehouse.read(table).drop("batch")
    if not warehouse.exists(f"{table}_merged"):
        return by_batch
    merged = warehouse.read(f"{table}_merged")
    return by_batch.join(merged.select("day").distinct(), "day", "left_anti").unionByName(merged)
