"""Reporting sessions of sensors and the outages between them.

A sensor's session is a run of measurements of which each comes at most ``gap`` after the one before; what lies between two
sessions is an outage. The same session windows run on a table and, with a watermark, on a stream, whose state per sensor is its open session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeris.functions.time import local_timestamp


def with_event_time(rows: DataFrame) -> DataFrame:
    """Measurement documents as (sensor_id, parameter_id, event_time): the local wall clock read as UTC, so that nothing depends on the session
    time zone. Rows without a time that can be read have no session and are left out."""
    wall = local_timestamp(F.col("period.datetimeFrom.local"), "wall_clock")
    at = F.concat(wall.cast("string"), F.lit("Z")).try_cast("timestamp")
    return rows.select("sensor_id", F.col("parameter.id").alias("parameter_id"), at.alias("event_time")).where(F.col("event_time").isNotNull())


def sensor_sessions(events: DataFrame, gap: str = "1 day") -> DataFrame:
    """(sensor_id, first_seen, last_seen, measurements) per session of ``events`` (sensor_id, event_time), a table or a stream with a
    watermark. Sessions are merged before the shuffle, so a hot sensor sends its sessions and not its rows."""
    w = F.session_window("event_time", gap)
    return events.groupBy("sensor_id", w.alias("w")).agg(
        F.min("event_time").alias("first_seen"), F.max("event_time").alias("last_seen"), F.count(F.lit(1)).alias("measurements")).drop("w")


def outages(sessions: DataFrame) -> DataFrame:
    """(sensor_id, silent_from, silent_until, seconds) between following sessions of a sensor."""
    order = Window.partitionBy("sensor_id").orderBy("first_seen")  # a sensor's sessions, not its measurements
    silent = sessions.withColumn("silent_from", F.lag("last_seen").over(order)).where("silent_from is not null")
    return silent.select("sensor_id", "silent_from", F.col("first_seen").alias("silent_until"),
                         (F.unix_seconds("first_seen") - F.unix_seconds("silent_from")).alias("seconds"))


def run_session_stream(spark, source: str, sink: str, checkpoint: str, gap: str = "1 day", lateness: str = "1 day",
                       layout: str = "page", available_now: bool = True, processing_time: str | None = None):
    """Start the stream of landed pages into a Parquet table of closed sessions: those that the watermark (latest event time less
    ``lateness``) has left behind by ``gap``. A batch is all that has landed (see ``streaming.daily``). Returns the ``StreamingQuery``."""
    from aeris.streaming.daily import _triggered, measurement_stream

    events = with_event_time(measurement_stream(spark, source, layout)).withWatermark("event_time", lateness)
    writer = (sensor_sessions(events, gap).writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint))
    return _triggered(writer, available_now, processing_time).start(sink)
