"""Local time by zone: a table of offset intervals and an as-of lookup.

The documents carry local times as text with an offset; where only an instant and a zone name are known, the local day depends on
the zone's clock changes. The table has one row per zone and interval of equal offset, found by looking where the offset of two
following days differs and then to the minute inside those days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

_MINUTE, _DAY = 60, 86400


def _offset(seconds: Column, zone: Column) -> Column:
    """Seconds that the zone's wall clock is ahead of UTC at an instant; does not depend on the session time zone."""
    at = F.timestamp_seconds(seconds)
    return F.unix_seconds(F.from_utc_timestamp(at, zone)) - seconds


def zone_transitions(zones: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """(zone, from_s, until_s, offset_s): the offset of each distinct ``zone`` of ``zones`` over [start, end), as intervals of UTC seconds since
    1970 that follow each other without a gap. Names that the JVM's zone rules don't know have no row."""
    spark = zones.sparkSession
    known = list(spark.sparkContext._jvm.java.time.ZoneId.getAvailableZoneIds())  # some 600 names
    names = zones.select("zone").distinct().where(F.col("zone").isin(known))
    lo, hi = (int(dt.datetime(d.year, d.month, d.day, tzinfo=dt.UTC).timestamp()) for d in (start, end))
    zone, s = F.col("zone"), F.col("s")
    days = names.select("zone", F.explode(F.sequence(F.lit(lo), F.lit(hi - _DAY), F.lit(_DAY))).alias("s"))
    changed = days.where(_offset(s, zone) != _offset(s + _DAY, zone))
    minutes = changed.select("zone", F.explode(F.sequence(s, s + _DAY - _MINUTE, F.lit(_MINUTE))).alias("s"))
    moved = minutes.where(_offset(s, zone) != _offset(s + _MINUTE, zone)).select("zone", (s + _MINUTE).alias("from_s"))
    starts = names.select("zone", F.lit(lo).cast("long").alias("from_s")).union(moved.where(F.col("from_s") < hi)).distinct()
    after = F.lead("from_s", 1, hi).over(Window.partitionBy("zone").orderBy("from_s"))  # a few rows per zone and year
    return starts.select("zone", F.col("from_s").cast("long").alias("from_s"), after.cast("long").alias("until_s"),
                         _offset(F.col("from_s"), zone).alias("offset_s"))


def with_local_time(df: DataFrame, transitions: DataFrame, instant: str, zone: str = "zone") -> DataFrame:
    """``df`` with ``local_time`` (wall clock, ``timestamp_ntz``) and ``local_day`` (text) of its UTC ``instant`` (a ``timestamp``) in its
    ``zone``. An equality join on the zone with intervals that don't overlap: no row is multiplied. NULL where the zone is not known, or the
    instant lies outside of the table's days."""
    t = transitions.select(F.col("zone").alias("__zone"), "from_s", "until_s", "offset_s")
    s = F.unix_seconds(df[instant])
    joined = df.join(t, (df[zone] == t["__zone"]) & (s >= t["from_s"]) & (s < t["until_s"]), "left")
    micros = F.unix_micros(F.col(instant)) + F.col("offset_s") * 1_000_000
    # an instant shifted by its offset, read as UTC, is the wall clock
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    wall = epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (micros / F.lit(1_000_000)).cast("decimal(18,6)"))
    return joined.withColumn("local_time", wall).withColumn("local_day", F.date_format("local_time", "yyyy-MM-dd")).drop(
        "__zone", "from_s", "until_s", "offset_s")
