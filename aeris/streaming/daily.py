"""Daily statistics per sensor and pollutant from a stream of landed pages.

Two forms over the same file stream, which reads pages like the batch source
(the sensor comes from the ``sensor_id=<id>`` folder unless the document has
its own):

* ``run_daily_fact_stream``: each micro-batch puts its rows into the raw fact,
  under its own batch number so that a repeated batch replaces itself, and
  recomputes the statistics of the days it touched. Open days and rows of any
  lateness are in the result; unreadable pages, bad elements and rows without
  a day go to a quarantine table.
* ``run_daily_stats_stream``: a windowed aggregation with a watermark, whose
  state is bounded by the open days. In append mode a day is written once its
  window has closed (watermark = latest event time seen minus ``lateness``);
  later rows are dropped, which is the watermark's contract. It takes all that
  has landed as one batch; ``ledger.run_ledger_stream`` closes days whatever the
  size and order of batches, and counts late rows.

Both are exactly-once across restarts and lost executors. Same statistics as
``operators.daily_sensor_stats``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeris import operators as op
from aeris import schemas
from aeris.functions.numeric import rounder
from aeris.functions.time import a_day, day_text, local_timestamp
from aeris.operators.partials import add_batch, partials_of_raw_fact
from aeris.sources import landed

_SENSOR_FOLDER = r"/sensor_id=([0-9]+)/"


def page_stream(spark: SparkSession, path: str, layout: str = "page", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``parse_pages`` output of landed measurement pages (``layout``: ``page`` or ``lines``).

    ``max_files_per_trigger`` bounds a micro-batch, so a backlog is worked off
    in batches of bounded size instead of one giant batch.
    """
    if layout not in ("page", "lines"):
        raise ValueError(f"a stream reads pages or lines, not {layout!r}")
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    text = reader.text(path, wholetext=layout == "page")
    file = F.col("_metadata.file_path")
    text = text.select("value", file.alias("source_file"),
                       F.regexp_extract(file, _SENSOR_FOLDER, 1).try_cast("int").alias("sensor_id"))
    return landed.parse_text(text if layout == "page" else text.where(F.trim("value") != ""), schemas.MEASUREMENT)


def measurement_stream(spark: SparkSession, path: str, layout: str = "page",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming rows of landed measurement pages, with their sensor."""
    return landed.measurement_rows(landed.page_rows(page_stream(spark, path, layout, max_files_per_trigger)))


def daily_stats_stream(rows: DataFrame, lateness: str = "1 day", expected_per_day: int = 24,
                       exact: bool = False) -> DataFrame:
    """Windowed daily statistics of a (streaming or batch) measurement frame.

    The event time is the local wall clock of ``period.datetimeFrom.local`` (to
    the minute, or a date alone, as they come) read as UTC, so the 1-day
    windows are the local calendar days whatever the session time zone; ``day``
    is the window's date as text. Rows without such a time have no window.
    """
    rnd = rounder(exact)
    wall = local_timestamp(F.col("period.datetimeFrom.local"), "wall_clock")
    event_time = F.concat(wall.cast("string"), F.lit("Z")).try_cast("timestamp")
    v = F.col("value")
    stats = (
        rows.select(
            event_time.alias("event_time"),
            "sensor_id",
            F.col("parameter.id").alias("parameter_id"),
            "value",
            F.col("coverage.observedCount").alias("observed"),
        )
        .withWatermark("event_time", lateness)
        .groupBy(F.window("event_time", "1 day").alias("w"), "sensor_id", "parameter_id")
        .agg(
            rnd(F.avg(v), 2).alias("value"),
            rnd(F.min(v), 2).alias("min_value"),
            rnd(F.max(v), 2).alias("max_value"),
            (rnd(F.stddev_samp(v), 6) if exact else F.stddev_samp(v)).alias("stddev_value"),
            rnd(F.median(v), 2).alias("median_value"),
            F.sum("observed").alias("observed_count"),
        )
    )
    # Window bounds are epoch-aligned instants: their date is zone-independent
    # when taken from the epoch day number.
    day = F.date_from_unix_date(F.floor(F.unix_seconds(F.col("w.start")) / 86400).cast("int")).cast("string")
    return stats.select(
        day.alias("day"), "sensor_id", "parameter_id", "value", "min_value", "max_value", "stddev_value",
        "median_value", "observed_count", F.lit(expected_per_day).alias("expected_count"),
    )


def split_batch(pages: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame]:
    """(raw fact rows with their day, quarantine rows) of a micro-batch of parsed pages, both with the batch's number: unreadable
    pages, bad elements and rows without a day can't be loaded."""
    rows = landed.measurement_rows(landed.page_rows(pages)).withColumn("day", day_text(F.col("period.datetimeFrom.local")))
    bad = landed.page_quarantine(pages).select("source_file", "element", "raw_text", "reason")
    undated = rows.where(~a_day(F.col("day"))).select(
        F.lit(None).cast("string").alias("source_file"), F.lit(None).cast("int").alias("element"),
        F.to_json(F.struct(*[c for c in rows.columns if c != "day"])).alias("raw_text"), F.lit("no_day").alias("reason"))
    number = F.lit(batch_id).cast("long")
    dated = op.raw_measurements(rows.where(a_day(F.col("day"))), keep=["day"])
    return dated.withColumn("batch", number), bad.unionByName(undated).withColumn("batch", number)


def _triggered(writer, available_now: bool, processing_time: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=processing_time) if processing_time else writer


def run_daily_stats_stream(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    lateness: str = "1 day",
    exact: bool = False,
    available_now: bool = True,
    processing_time: str | None = None,
    layout: str = "page",
):
    """Start the watermarked stream from ``source`` into a ``day``-partitioned Parquet sink.

    ``available_now=True`` processes what has landed and stops (a scheduled
    daily run); otherwise it runs every ``processing_time``. Returns the
    ``StreamingQuery``. A batch is all that has landed: files come in no order of their
    events, and between batches of a bounded backlog the watermark would pass rows not yet
    read. For bounded batches in any order see ``run_ledger_stream``.
    """
    rows = measurement_stream(spark, source, layout)
    out = daily_stats_stream(rows, lateness=lateness, exact=exact)
    writer = (out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
              .partitionBy("day"))
    return _triggered(writer, available_now, processing_time).start(sink)


def run_daily_fact_stream(
    spark: SparkSession,
    source: str,
    warehouse,
    checkpoint: str,
    exact: bool = False,
    expected_per_day: int = 24,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    layout: str = "page",
):
    """Start the stream into four tables of ``warehouse``: ``stream_raw_measurements`` and ``stream_partial_measurements`` (by day and
    batch number), ``stream_agg_measurements`` (by day, from the partials of the days that a batch touches) and
    ``stream_quarantine_pages`` (by batch number). Returns the ``StreamingQuery``."""
    raw, partials = "stream_raw_measurements", "stream_partial_measurements"

    def load(pages: DataFrame, batch_id: int) -> None:
        pages = pages.persist()
        try:
            dated, bad = split_batch(pages, batch_id)
            if warehouse.exists(raw) and not warehouse.exists(partials):  # a fact that was stored before there were partials
                warehouse.write(partials_of_raw_fact(warehouse.read(raw).where(F.col("batch") < batch_id), keep=["batch"]), partials,
                                partition_by=["day", "batch"], cluster_by=["sensor_id"])
            warehouse.write(bad, "stream_quarantine_pages", mode="replace_partitions", partition_by=["batch"])
            warehouse.write(dated, raw, mode="replace_partitions", partition_by=["day", "batch"])
            add_batch(warehouse, dated, batch_id, partials, "stream_agg_measurements", expected_per_day, exact)
        finally:
            pages.unpersist()

    pages = page_stream(spark, source, layout, max_files_per_trigger)
    writer = pages.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return _triggered(writer, available_now, processing_time).start()
