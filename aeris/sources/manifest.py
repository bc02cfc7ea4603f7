"""Manifest of a measurement landing: what every file holds, so that files are skipped before they are read.

One row per landed file: its size and time, the first and last local day of its documents, how many documents, documents without
a day or a sensor, and unreadable pages or elements it has, and a Bloom filter of its sensors. A refresh lists the landing and
reads only files that are new or have changed. A run then opens the files whose days meet its window and whose filter holds one of its sensors, and any
file with something to report; a filter errs towards opening (under 1 %), never towards skipping.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeris.functions.time import a_day, day_text
from aeris.sources import landed

SCHEMA = ("file string, bytes long, modified timestamp, fetch_date string, rows long, undated long, unkeyed long, faults long, "
          "min_day string, max_day string, sensors long, bloom binary")
#: Of a document only its sensor and day are read.
DESCRIBED = T.StructType([
    T.StructField("sensor_id", T.IntegerType()),
    T.StructField("period", T.StructType([T.StructField("datetimeFrom", T.StructType([T.StructField("local", T.StringType())]))])),
])
#: Bits per sensor and bits set for each in a filter.
BLOOM_BITS, BLOOM_HASHES = 10, 7
#: Selected sensors that travel to the tasks at once, and files whose names the driver hands to one reading.
SENSOR_BLOCK, FILE_BLOCK = 1 << 20, 1 << 14


# ---- Bloom filter ----

def _hashes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two mixed hashes of 32 bits of each key; the second is odd."""
    x = keys.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x = x ^ (x >> np.uint64(31))
    return x & np.uint64(0xFFFFFFFF), x >> np.uint64(32) | np.uint64(1)


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    a, b = _hashes(keys)
    return (a[:, None] + b[:, None] * np.arange(BLOOM_HASHES, dtype=np.uint64)) & np.uint64(bits - 1)


def bloom(keys: np.ndarray) -> bytes:
    """Filter of integer keys; a power of two of bits, at least ``BLOOM_BITS`` for each."""
    bits = max(64, 1 << (max(len(keys) * BLOOM_BITS, 1) - 1).bit_length())
    held = np.zeros(bits, dtype=bool)
    held[_places(keys, bits)] = True
    return np.packbits(held, bitorder="little").tobytes()


def holds(filtered: bytes, keys: np.ndarray) -> np.ndarray:
    """Whether the filter holds each key: always where it was put in, seldom where not."""
    held = np.frombuffer(filtered, dtype=np.uint8)
    at = _places(keys, 8 * len(held))
    return (held[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).all(axis=1)


# ---- manifest ----

class LandingManifest:
    """The manifest of ``landing`` as a Parquet table at ``path``, a folder that driver and executors share.

    Folder keys are the landing's: ``fetch_date=<day>`` and ``sensor_id=<id>`` (a document's own sensor wins)."""

    def __init__(self, spark: SparkSession, landing: str, path: str, layout: str = "auto"):
        self.spark, self.landing, self.path, self.layout = spark, landing.rstrip("/"), path.rstrip("/"), layout

    def listing(self) -> DataFrame:
        """(file, bytes, modified) of every landed file; no file is opened."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.landing)
        meta = F.col("_metadata")
        return files.select(meta["file_path"].alias("file"), meta["file_size"].alias("bytes"), meta["file_modification_time"].alias("modified"))

    def _batches(self) -> DataFrame:
        from pyspark.errors import AnalysisException

        schema = T.StructType.fromDDL(SCHEMA)
        try:
            self.spark.read.parquet(self.path).schema  # noqa: B018 - whether anything is stored
        except AnalysisException as e:
            if (e.getCondition() or "") not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def read(self) -> DataFrame:
        """One row per file that still lies in the landing as it was read (``SCHEMA``)."""
        rows = self._batches().groupBy("file", "bytes", "modified").agg(F.first(F.struct("*")).alias("r")).select("r.*")
        return rows.join(self.listing(), ["file", "bytes", "modified"], "left_semi")

    def _describe(self, new: DataFrame, files: list[str]) -> DataFrame:
        # a document without a folder key is the same with one; ``source_file`` is the file's name throughout
        pages = landed.parse_pages(self.spark, self.landing, DESCRIBED, self.layout, files=files)
        # one aggregation tells rows and faults: a filter of either would parse the pages again
        a_row = F.col("reason").isNull() | (F.col("reason") == landed.PARTLY)
        sensor = F.col("doc.sensor_id")
        if "sensor_id__key" in pages.columns:
            sensor = F.coalesce(sensor, F.col("sensor_id__key").try_cast("int"))
        day = day_text(F.col("doc.period.datetimeFrom.local"))
        rows = pages.select(F.col("source_file").alias("file"), a_row.alias("ok"), F.when(a_row & a_day(day), day).alias("day"),
                            F.when(a_row, sensor).alias("sensor"))
        held = rows.groupBy("file").agg(
            F.count_if("ok").alias("rows"), F.count_if(F.col("ok") & F.col("day").isNull()).alias("undated"),
            F.count_if(F.col("ok") & F.col("sensor").isNull()).alias("unkeyed"), F.count_if(~F.col("ok")).alias("faults"),
            F.min("day").alias("min_day"), F.max("day").alias("max_day"), F.collect_set("sensor").alias("keys"))

        @F.pandas_udf("binary")
        def filtered(keys: pd.Series) -> pd.Series:
            return keys.map(lambda k: bloom(np.asarray([] if k is None else k, dtype=np.int64)))

        zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
        # no join repeats a file, and files without a row or a fault are in the listing alone
        names = self.spark.createDataFrame([(f,) for f in files], "file string")
        return (new.join(names, "file", "left_semi").join(held, "file", "left").select(
            "file", "bytes", "modified", F.regexp_extract("file", "/fetch_date=([^/]*)/", 1).alias("fetch_date"), zero("rows"), zero("undated"),
            zero("unkeyed"), zero("faults"), "min_day", "max_day", F.coalesce(F.size("keys"), F.lit(0)).cast("long").alias("sensors"),
            filtered("keys").alias("bloom")))

    def refresh(self, file_block: int = FILE_BLOCK) -> int:
        """Read the files that are new or have changed since the last refresh; how many there were.

        Files are read ``file_block`` at a time, and what a block tells is stored before the next: a refresh that dies goes on where it was."""
        known = self._batches().select("file", "bytes", "modified")
        new = self.listing().join(known, ["file", "bytes", "modified"], "left_anti")
        done, block = 0, []

        def store() -> None:
            self._describe(new, block).write.mode("append").parquet(self.path)

        for row in new.select("file").toLocalIterator():  # names, as Spark's own file index holds them
            block.append(row.file)
            done += 1
            if len(block) >= file_block:
                store()
                block = []
        if block:
            store()
        return done

    def needed(self, start: str, end: str, sensors: DataFrame | None = None, fetched: tuple[str, str] | None = None) -> DataFrame:
        """Manifest rows of the files that a run over days [start, end) and ``sensors`` (column sensor_id; None: all) has to open: those that may hold
        such a document, and those with an undated or unkeyed document, an unreadable page or element. ``fetched`` keeps files fetched on
        days from the first to the last of both, or on none."""
        files = self.read()
        if fetched:
            day = F.col("fetch_date")
            files = files.where(day.try_cast("date").isNull() | ((day >= fetched[0]) & (day <= fetched[1])))
        odd = (F.col("undated") > 0) | (F.col("unkeyed") > 0) | (F.col("faults") > 0)
        inside = F.coalesce((F.col("min_day") < end) & (F.col("max_day") >= start), F.lit(False))
        if sensors is None:
            return files.where(odd | inside)
        hit = None
        for keys in _blocks(sensors):
            sent = self.spark.sparkContext.broadcast(keys)

            @F.pandas_udf("boolean")
            def any_held(filters: pd.Series) -> pd.Series:
                return filters.map(lambda f, sent=sent: bool(holds(f, sent.value).any()))

            hit = any_held("bloom") if hit is None else hit | any_held("bloom")
        return files.where(odd | (inside & hit))

    def files(self, needed: DataFrame) -> list[str]:
        """Names of the needed files, for ``parse_pages``."""
        return [r.file for r in needed.select("file").orderBy("file").toLocalIterator()]


def _blocks(sensors: DataFrame, size: int = SENSOR_BLOCK) -> Iterator[np.ndarray]:
    """Distinct sensor ids in arrays of bounded size; one empty array if there are none."""
    block, some = [], False
    for row in sensors.select("sensor_id").where("sensor_id is not null").distinct().toLocalIterator():
        block.append(row.sensor_id)
        if len(block) >= size:
            yield np.array(block, dtype=np.int64)
            block, some = [], True
    if block or not some:
        yield np.array(block, dtype=np.int64)
