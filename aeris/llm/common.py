"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeris.session import scratch_path

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps now: it does so when the driver's garbage is
    collected, which may otherwise come long after the executors' disks are full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new folder under the cluster's shared checkpoint folder and read it back: the lineage
    ends there, so a lost executor costs no recomputation of what came before."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


#: What parts words, as bytes of UTF-8 after A-Z are lower-cased: all of ASCII but 0-9 and a-z (fixed value).
_WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Maximal runs of 0-9, a-z and code points from U+0080 (as UTF-8) after A-Z, and nothing else, are lower-cased."""
    return text.encode().lower().translate(_WORD_BYTES).split()


def row_key() -> list[Column]:
    """k1 and k2, 128 bits that name a row by doc_id and text wherever and however often it is read. Rows that repeat
    both share the name; nothing depends on which of them is meant."""
    return [F.xxhash64("doc_id", "text", F.lit(1)).alias("k1"), F.xxhash64("text", F.lit(2), "doc_id").alias("k2")]


def pick_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """One row of ``docs``, with all its columns, for each (k1, k2) of ``keys`` that it has. Rows that repeat a key are
    reduced in the task that reads them, so that however many there are, few are shuffled."""
    whole = docs.select(*row_key(), F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    return (whole.groupBy("k1", "k2").agg(F.first("doc").alias("doc")).join(keys.select("k1", "k2"), ["k1", "k2"], "left_semi")
            .select("doc.*"))


def map_rows(df: DataFrame, fn: Callable[[list[dict]], dict[str, list]], schema: str, slice_rows: int = 512) -> DataFrame:
    """``fn`` over slices of each Arrow batch. ``fn`` gets {column: values} and returns {column: values} of any
    length in the order of ``schema``. A slice bounds what Python holds besides the batch itself."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                cut = batch.slice(at, slice_rows)
                got = fn({n: c.to_pylist() for n, c in zip(cut.schema.names, cut.columns)})
                yield pa.RecordBatch.from_arrays([pa.array(got[f.name], type=f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)
