"""Daily statistics from a stream whose files come in any order, in batches of any size.

A watermark that follows the batches read so far closes a day too early if a backlog is read in another order than its events, and drops
what comes after. Here days are closed by a ledger. The landing's manifest tells, before anything is loaded, the first and
last day of every file that has landed; the ledger holds the files that were loaded. A day is closed once the latest landed day is
``lateness_days`` past its end and every landed file that may hold it is in the ledger. So what a run closes, and with which rows, depends on
what had landed and not on the order or number of its batches.

A closed day is written once. Rows of a file that lands after its day was closed are late: they go to a side table, by batch and day,
where they are counted, and change nothing.

Tables (prefix ``ledger_``): ``raw`` and ``partials`` by (day, batch), compacted to one folder per day (``…_merged``) after the day was
closed; ``stats`` by day, closed days only; ``closed`` (day) and ``files`` (file) by batch; ``late`` by batch, raw rows;
``quarantine`` by batch. A batch that is run again replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeris.operators.partials import compact_days, daily_stats_of_partials, live_rows, partials_of_raw_fact
from aeris.sources.manifest import LandingManifest
from aeris.streaming.daily import _triggered, page_stream, split_batch

RAW, PARTIALS, STATS, CLOSED, FILES, LATE, QUARANTINE = (
    f"ledger_{x}" for x in ("raw", "partials", "stats", "closed", "files", "late", "quarantine"))


def _closed(warehouse, before: int) -> list[str]:
    """Days that batches before this one have closed; one row per day."""
    if not warehouse.exists(CLOSED):
        return []
    return sorted(r.day for r in warehouse.read(CLOSED).where(F.col("batch") < before).select("day").distinct().collect())


def closable_days(manifest: DataFrame, loaded: DataFrame, stored: DataFrame, lateness_days: int) -> DataFrame:
    """(day) of ``stored`` that may be closed, given the manifest's files and the ``loaded`` ones (column file)."""
    latest = manifest.agg(F.max("max_day").alias("latest"))
    past = stored.select("day").distinct().join(F.broadcast(latest)).where(  # one row
        F.date_add(F.col("day").cast("date"), 1 + lateness_days) <= F.col("latest").cast("date")).select("day")
    # days between the first and last of a file that is still to be loaded
    waiting = manifest.where("min_day is not null").join(loaded.select("file"), "file", "left_anti")
    span = F.sequence(F.col("min_day").cast("date"), F.col("max_day").cast("date"))
    # a span is as long as the days it covers; the same span is taken once
    held = waiting.select("min_day", "max_day").distinct().select(F.explode(span).alias("day"))
    held = held.select(F.col("day").cast("string").alias("day")).distinct()
    return past.join(held, "day", "left_anti")


def run_ledger_stream(
    spark: SparkSession,
    source: str,
    warehouse,
    checkpoint: str,
    manifest: str,
    lateness_days: int = 1,
    exact: bool = False,
    expected_per_day: int = 24,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    layout: str = "page",
):
    """Start the stream of landed pages under ``source`` into the ledger's tables of ``warehouse``. ``manifest`` is the folder of the
    landing's manifest, which every batch brings up to date. Returns the ``StreamingQuery``."""
    listed = LandingManifest(spark, source, manifest, layout)

    def load(pages: DataFrame, batch_id: int) -> None:
        listed.refresh()
        pages = pages.persist()
        try:
            closed = _closed(warehouse, batch_id)
            compact_days(warehouse, _not_compacted(warehouse, closed, RAW), RAW, merge=lambda rows: rows)
            compact_days(warehouse, _not_compacted(warehouse, closed, PARTIALS), PARTIALS)
            rows, bad = split_batch(pages, batch_id)
            is_late = F.col("day").isin(closed) if closed else F.lit(False)
            by_day, by_batch = ["day", "batch"], ["batch"]
            warehouse.write(bad, QUARANTINE, mode="replace_partitions", partition_by=by_batch)
            warehouse.write(rows.where(is_late), LATE, mode="replace_partitions", partition_by=by_batch)
            rows = rows.where(~is_late)
            warehouse.write(rows, RAW, mode="replace_partitions", partition_by=by_day, cluster_by=["sensor_id"])
            warehouse.write(partials_of_raw_fact(rows, keep=["batch"]), PARTIALS, mode="replace_partitions", partition_by=by_day,
                            cluster_by=["sensor_id"])
            seen = pages.select(F.col("source_file").alias("file")).distinct().withColumn("batch", F.lit(batch_id).cast("long"))
            warehouse.write(seen, FILES, mode="replace_partitions", partition_by=by_batch)
        finally:
            pages.unpersist()
        loaded = warehouse.read(FILES).where(F.col("batch") <= batch_id)
        stored = live_rows(warehouse, PARTIALS)
        days = closable_days(listed.read(), loaded, stored.where(~is_late), lateness_days)
        now = sorted(r.day for r in days.collect())  # one row per day
        stats = daily_stats_of_partials(stored.where(F.col("day").isin(now)), expected_per_day, exact)
        warehouse.write(stats, STATS, mode="replace_partitions", partition_by=["day"], cluster_by=["sensor_id"])
        warehouse.write(spark.createDataFrame([(d, batch_id) for d in now], "day string, batch long"), CLOSED, mode="replace_partitions",
                        partition_by=["batch"])

    pages = page_stream(spark, source, layout, max_files_per_trigger)
    writer = pages.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return _triggered(writer, available_now, processing_time).start()


def _not_compacted(warehouse, closed: list[str], table: str) -> list[str]:
    """Closed days that still have folders by batch."""
    if not closed or not warehouse.exists(table):
        return []
    return sorted(r.day for r in warehouse.read(table).where(F.col("day").isin(closed)).select("day").distinct().collect())


def late_counts(warehouse) -> DataFrame:
    """(day, n): rows that came after their day was closed."""
    return warehouse.read(LATE).groupBy("day").agg(F.count(F.lit(1)).alias("n"))
