"""Dimensions with history: one row per key and interval of days in which its attributes were the same.

Each load compares the batch with the open rows by a hash of the tracked attributes. A key whose hash changed gets its open
row closed and a new one opened on the load's day; facts then find the attributes that held on their day through an equality join
whose intervals don't overlap, so no fact is multiplied.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(columns: list[str]) -> Column:
    """Hash of the columns' JSON; NULLs are written out, so a value can't move from one column to another unseen."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def _day(day: str | dt.date) -> Column:
    return F.lit(day.isoformat() if isinstance(day, dt.date) else day).cast("date")


def open_history(batch: DataFrame, key: str, since: str | dt.date | None = None) -> DataFrame:
    """History of a first load: every key's row is valid from ``since`` (None: ever). Of rows that repeat a key the one of least hash
    counts; rows with a NULL key are left out, as no fact finds them."""
    fields = [c for c in batch.columns if c != key]
    rows = batch.where(F.col(key).isNotNull()).withColumn("row_hash", row_hash(fields))
    one = rows.groupBy(key).agg(F.min(F.struct("row_hash", *fields)).alias("r"))
    since = F.lit(None).cast("date") if since is None else _day(since)
    return one.select(key, *[F.col("r")[c].alias(c) for c in fields], F.col("r.row_hash").alias("row_hash"),
                      since.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))


def merge_history(history: DataFrame, batch: DataFrame, key: str, day: str | dt.date, absent: str = "keep") -> DataFrame:
    """``history`` after the load of ``batch`` on ``day``.

    New keys open on that day. A changed key's open row ends there and a new one begins; if it only began that day (the load is
    run again), it is replaced. Keys that the batch lacks stay open, or end that day with ``absent="close"``. A key whose open row
    began later than ``day`` stays as it is: an old load can't change what is known since. One shuffle on the key."""
    if absent not in ("keep", "close"):
        raise ValueError(f"absent is 'keep' or 'close', not {absent!r}")
    day = _day(day)
    fields = [c for c in history.columns if c not in (key, "row_hash", "valid_from", "valid_to")]
    new = open_history(batch.select(key, *fields), key).select(F.col(key).alias("k"), F.struct(*fields, "row_hash").alias("new"))
    is_open = F.col("valid_to").isNull()
    old = history.where(is_open).select(F.col(key).alias("k"), F.struct(*fields, "row_hash", "valid_from").alias("old"))
    both = old.join(new, "k", "full")

    def row(side: str, since: Column, until: Column) -> Column:
        return F.struct(*[F.col(side)[c].alias(c) for c in (*fields, "row_hash")], since.alias("valid_from"), until.alias("valid_to"))

    none, began = F.lit(None).cast("date"), F.col("old.valid_from")
    kept, ended, opened = row("old", began, none), row("old", began, day), row("new", day, none)
    replaced = row("new", began, none)
    rows = (F.when(F.col("old").isNull(), F.array(opened))
            .when(F.coalesce(began > day, F.lit(False)), F.array(kept))
            .when(F.col("new").isNull(), F.array(ended if absent == "close" else kept))
            .when(F.col("old.row_hash") == F.col("new.row_hash"), F.array(kept))
            .when(F.coalesce(began == day, F.lit(False)), F.array(replaced))
            .otherwise(F.array(ended, opened)))
    merged = both.select(F.col("k").alias(key), F.explode(rows).alias("r")).select(key, "r.*")
    # an interval that would end where it began never held
    merged = merged.where(F.col("valid_from").isNull() | F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to")))
    return history.where(~is_open).unionByName(merged.select(*history.columns))


def as_of_join(facts: DataFrame, history: DataFrame, key: str, day: str = "day", fields: list[str] | None = None) -> DataFrame:
    """``facts`` with the ``fields`` (default: all attributes) that held for their ``key`` on their ``day``; NULL where none did."""
    fields = fields or [c for c in history.columns if c not in (key, "row_hash", "valid_from", "valid_to")]
    known = history.select(F.col(key).alias("__key"), F.col("valid_from").alias("__from"), F.col("valid_to").alias("__to"), *fields)
    at = facts[day].try_cast("date")
    held = (F.col("__from").isNull() | (at >= F.col("__from"))) & (F.col("__to").isNull() | (at < F.col("__to")))
    return facts.join(known, (facts[key] == known["__key"]) & held & at.isNotNull(), "left").drop("__key", "__from", "__to")
