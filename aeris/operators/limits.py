"""Regulatory-limit tables: cells → clean rows → one nested record per pollutant.

Input: cells ``(table_no, row_no, c0, c1, c2)`` of the tables of a limits
document (``schemas.LIMIT_CELLS``); row 0 of a table holds the pollutant title
in ``c0``, later rows hold indicator, measurement text and criterion.

The fill-forward of empty indicators is a running ``last(..., ignorenulls)``
window inside bounded buckets of rows, with the value carried across buckets
from per-bucket summaries, so a huge table is spread over many tasks. The
nested document holds, by definition, one record per table with all its kept
rows (a printed table of a document).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeris.functions import text as X

INFO_FIELDS = ("indicateur", "valeurs", "origine", "critere")


def fill_forward(df: DataFrame, key: str, order: str, value: Column, name: str,
                 bucket_rows: int = 100_000) -> DataFrame:
    """Add ``name`` = the last non-NULL ``value`` at or before each row, per ``key``
    in ``order`` (an integer position).

    Skew-proof: rows are cut into buckets of ``bucket_rows`` positions; the
    running ``last`` runs inside each bucket (a task holds at most one
    bucket), each bucket's last value is pre-aggregated, and the value carried
    into a bucket comes from a window over those per-bucket summaries (one row
    per bucket). So one huge ``key`` never lands in a single task.
    """
    bucket = F.floor(F.col(order) / F.lit(bucket_rows))
    d = df.withColumn("__b", bucket).withColumn("__v", value)
    inside = Window.partitionBy(key, "__b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("__in", F.last("__v", ignorenulls=True).over(inside))
    # The running value at a bucket's last row is the bucket's last value. The
    # window output is already partitioned by (key, bucket): no new shuffle.
    summary = d.groupBy(key, "__b").agg(F.max_by("__in", F.col(order)).alias("__last"))
    before = Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(key, "__b", F.last("__last", ignorenulls=True).over(before).alias("__carry"))
    return (
        d.join(carry, [key, "__b"], "left")
        .withColumn(name, F.coalesce(F.col("__in"), F.col("__carry")))
        .drop("__b", "__v", "__in", "__carry")
    )


def limit_rows(cells: DataFrame, keep_dropped: bool = False, bucket_rows: int = 100_000) -> DataFrame:
    """Clean body rows: table_no, row_no, nom, indicateur, valeurs, origine, critere.

    Empty indicators take the last non-empty indicator above them (raw text, so
    ``" "`` counts as non-empty); rows whose cleaned value is empty are dropped
    (``keep_dropped=True`` keeps them with ``kept = false``). The fill-forward
    is bucketed (``fill_forward``) and the title is joined from the title rows
    (one per table), so no step holds a whole table in one task.
    """
    titles = cells.where(F.col("row_no") == 0).select(
        "table_no", X.pollutant_title(F.col("c0")).alias("__title"))
    body = cells.where(F.col("row_no") > 0)
    raw_ind = F.coalesce(F.col("c0"), F.lit(""))
    body = fill_forward(body, "table_no", "row_no", F.when(raw_ind != "", raw_ind), "__filled", bucket_rows)
    rows = body.join(titles, "table_no", "left").select(
        "table_no",
        "row_no",
        F.coalesce(F.col("__title"), F.lit(X.UNKNOWN_POLLUTANT)).alias("nom"),
        X.clean_field(F.coalesce(F.col("__filled"), F.lit(""))).alias("indicateur"),
        X.clean_field(X.measurement_values(F.col("c1"))).alias("valeurs"),
        X.clean_field(X.measurement_origins(F.col("c1"))).alias("origine"),
        X.clean_field(F.coalesce(F.col("c2"), F.lit(""))).alias("critere"),
    )
    rows = rows.withColumn("kept", F.col("valeurs") != "")
    return rows if keep_dropped else rows.where("kept").drop("kept")


def limits_document(cells: DataFrame) -> DataFrame:
    """One row per table: table_no, nom, informations (array of structs
    indicateur, valeurs, origine, critere in row order). A pollutant whose rows
    were all dropped keeps ``informations = []``."""
    rows = limit_rows(cells, keep_dropped=True)
    info = F.struct("row_no", *INFO_FIELDS)
    titles = cells.where(F.col("row_no") == 0).select(
        "table_no", X.pollutant_title(F.col("c0")).alias("title")
    )
    grouped = rows.groupBy("table_no").agg(
        F.array_sort(F.collect_list(F.when(F.col("kept"), info))).alias("__infos")
    )
    doc = titles.join(grouped, "table_no", "full")
    return doc.select(
        "table_no",
        F.coalesce(F.col("title"), F.lit(X.UNKNOWN_POLLUTANT)).alias("nom"),
        F.transform(
            F.coalesce(F.col("__infos"), F.array().cast(grouped.schema["__infos"].dataType)),
            lambda i: F.struct(*[i[f].alias(f) for f in INFO_FIELDS]),
        ).alias("informations"),
    )


def write_limits_document(doc: DataFrame, path: str) -> None:
    """Write the document as JSON lines, one pollutant per line
    (``{"table_no", "nom", "informations": [...]}``), ordered by table within
    each file. Not one single JSON object: that would route every pollutant
    through one task."""
    doc.sortWithinPartitions("table_no").write.mode("overwrite").json(path)
