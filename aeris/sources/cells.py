"""Cells of regulatory-limit tables, and unions of landed batches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeris import schemas


def read_limit_cells(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Read a cell table ``(table_no, row_no, c0, c1, c2)`` written by a
    document-table extractor, as JSON lines, Parquet or CSV with a header.
    Extra columns are dropped, missing ones are NULL."""
    reader = spark.read.schema(schemas.LIMIT_CELLS)
    if fmt == "csv":
        df = reader.option("header", True).option("multiLine", True).csv(path)
    else:
        df = reader.format(fmt).load(path)
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.LIMIT_CELLS.fields])


def union_batches(batches: list[DataFrame]) -> DataFrame:
    """Union-all of batches whose columns may differ (by name; a column missing
    from a batch is NULL there). Batches read from one folder need none: a
    multi-file read already is the union."""
    if not batches:
        raise ValueError("no batch to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)
