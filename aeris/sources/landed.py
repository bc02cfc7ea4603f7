"""Landed API pages → typed rows.

The original job fetched pages over HTTP and parsed them one by one on the
driver. Here a fetcher (outside this package) lands each response body as a
file; Spark reads all page files in parallel and parses them with an explicit
schema, first the envelope, then each element of ``results`` by itself. What
cannot be read is not lost: a bad page goes to the quarantine whole, a bad
element alone with its place in the page, while its neighbours are read.

Layouts (``layout``):

* ``"auto"``: a file with a line that is a page of its own is JSON lines; any
  other file is one page (pretty-printed), read whole
* ``"page"``: one page per file; a file that holds anything after its page is
  quarantined
* ``"lines"``: JSON lines, one page envelope per line
* folders: partition columns of the path, e.g. measurements landed as
  ``<root>/fetch_date=<day>/sensor_id=<id>/…``; the request key comes from the
  folder name, like the key the original attached to each row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from aeris import schemas

CORRUPT = "_corrupt_record"
#: Columns of ``parse_pages`` besides the folder keys.
PAGE_COLUMNS = ("source_file", "element", "doc", "reason", "raw_text")
#: Reason of an element whose readable fields are rows all the same.
PARTLY = "partly_corrupt"
LAYOUTS = ("auto", "page", "lines")
#: Column of a text's envelopes where they are parsed already.
PAGES = "__pages"


def parse_documents(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """JSON held in a column → typed struct columns (PERMISSIVE: bad fields NULL)."""
    return df.withColumn("__doc", F.from_json(F.col(column), schema)).select("*", "__doc.*").drop("__doc")


def _envelopes(value: Column) -> Column:
    """The pages of a text as an array of envelopes, NULL when it isn't JSON of that shape. Read as the one element of a
    JSON array, a text with anything after its first value is malformed, which a plain parse would overlook."""
    return F.from_json(F.concat(F.lit("["), value, F.lit("]")), "array<struct<results:array<string>>>")


#: Files up to this size are read whole to tell their layout, in the task that reads them (fixed bound in bytes).
WHOLE_FILE = 32 << 20
#: Compressed text files by their names, and how many times larger their text is taken to be.
COMPRESSED, PACKED = r"\.(gz|bz2|zst|lz4|snappy|deflate)$", 32


def _glob_safe(uri: str) -> str:
    """A ``_metadata.file_path`` as a path to read: without URI escapes, and with none of its characters a wildcard."""
    from urllib.parse import unquote

    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(uri))


def _files(spark: SparkSession, path: str, whole: bool, restrict: Callable[[DataFrame], DataFrame] | None,
           files: list[str] | None = None) -> DataFrame:
    if files:  # folder keys are those below ``path``
        text = spark.read.option("basePath", path).text([_glob_safe(f) for f in files], wholetext=whole)
    else:
        text = spark.read.text(path, wholetext=whole)
    text = text.withColumn("source_file", F.col("_metadata.file_path"))
    if files is not None and not files:
        text = text.where(F.lit(False))
    return restrict(text) if restrict else text


def _texts(spark: SparkSession, path: str, layout: str, restrict, files: list[str] | None = None) -> DataFrame:
    """Page texts with their file and folder keys."""
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}")
    if layout == "page":
        return _files(spark, path, True, restrict, files)
    if layout == "lines":
        return _files(spark, path, False, restrict, files).where(F.trim("value") != "")
    # a file is read whole if none of its lines is a page. Usual files are told apart in the task that reads them, and their
    # pages are parsed there once; of larger files one row per file is compared
    size = F.col("_metadata.file_size")
    a_page = lambda pages: F.coalesce(F.exists(pages, lambda p: p["results"].isNotNull()), F.lit(False))
    # a compressed file's text is larger than the file
    size = F.when(F.col("_metadata.file_path").rlike(COMPRESSED), size * PACKED).otherwise(size)
    small = _files(spark, path, True, None, files).where(size <= WHOLE_FILE)
    small = restrict(small) if restrict else small
    line = F.filter(F.split("value", r"\r\n|[\r\n]"), lambda x: F.trim(x) != "")
    small = small.withColumn("__lines", F.transform(line, lambda x: F.struct(x.alias("value"), _envelopes(x).alias("pages"))))
    whole = F.array(F.struct(F.col("value"), _envelopes(F.col("value")).alias("pages")))
    text = F.when(F.exists("__lines", lambda x: a_page(x["pages"])), F.col("__lines")).otherwise(whole)
    # the outer form, as Spark would check the array of a plain one beforehand, and so parse the envelopes again
    small = small.withColumn("__text", F.explode_outer(text)).select(
        "__text.value", *[c for c in small.columns if c not in ("value", "__lines")], F.col("__text.pages").alias(PAGES))

    lines = _files(spark, path, False, None, files).where((size > WHOLE_FILE) & (F.trim("value") != ""))
    lines = (restrict(lines) if restrict else lines).withColumn(PAGES, _envelopes(F.col("value")))
    plain = lines.groupBy("source_file").agg(F.max(a_page(F.col(PAGES))).alias("ok")).where("not ok").select(F.col("source_file").alias("__file"))
    hit = F.col("source_file") == F.col("__file")
    pages = _files(spark, path, True, None, files).where(size > WHOLE_FILE)
    pages = (restrict(pages) if restrict else pages).join(plain, hit, "left_semi").withColumn(PAGES, _envelopes(F.col("value")))
    return small.unionByName(lines.join(plain, hit, "left_anti")).unionByName(pages)


def parse_text(text: DataFrame, entity: T.StructType) -> DataFrame:
    """Pages (columns ``value``, ``source_file`` and folder keys) → one row per element of their ``results`` and one per
    unreadable page; see ``parse_pages``. Works on batches and streams."""
    names = set(entity.fieldNames())
    keys = [F.col(c).alias(f"{c}__key" if c in names else c) for c in text.columns if c not in ("value", "source_file", PAGES)]
    item = "array<struct<element:int,raw:string,reason:string>>"
    none = F.lit(None)

    def fault(reason: str) -> Column:
        return F.array(F.struct(none.cast("int").alias("element"), F.col("value").alias("raw"),
                                F.lit(reason).alias("reason"))).cast(item)

    pages = F.col(PAGES)
    elements = F.flatten(F.transform(pages, lambda p: F.transform(p["results"], lambda x, i: F.struct(
        i.cast("int").alias("element"), x.alias("raw"), none.cast("string").alias("reason"))))).cast(item)
    items = (F.when(pages.isNull() | (F.size(pages) < 1), fault("malformed"))
             .when(F.exists(pages, lambda p: p["results"].isNull()), fault("no_results")).otherwise(elements))
    if PAGES not in text.columns:
        text = text.withColumn(PAGES, _envelopes(F.col("value")))
    # the outer form, as Spark would check the array of a plain one beforehand, and so parse the envelopes again
    rows = (text.select(*keys, "source_file", F.explode_outer(items).alias("__item")).where("__item is not null")
            .select("*", "__item.*").drop("__item"))
    wide = T.StructType(entity.fields + [T.StructField(CORRUPT, T.StringType())])
    doc = F.from_json(F.col("raw"), wide, {"columnNameOfCorruptRecord": CORRUPT})
    rows = rows.withColumn("__doc", F.when(F.col("reason").isNull(), doc))
    an_object = F.coalesce(F.ltrim("raw").startswith("{"), F.lit(False))
    reason = (F.when(F.col("reason").isNotNull(), F.col("reason")).when(~an_object, F.lit("bad_element"))
              .when(F.col(f"__doc.{CORRUPT}").isNotNull(), F.lit(PARTLY)))
    return rows.select(
        *[c for c in rows.columns if c not in ("raw", "reason", "__doc", "element", "source_file")], "source_file", "element",
        F.struct(*[F.col("__doc")[f].alias(f) for f in entity.fieldNames()]).alias("doc"), reason.alias("reason"),
        F.when(reason.isNotNull(), F.col("raw")).alias("raw_text"))


def parse_pages(spark: SparkSession, path: str, entity: T.StructType, layout: str = "auto",
                restrict: Callable[[DataFrame], DataFrame] | None = None, files: list[str] | None = None) -> DataFrame:
    """Parse every page under ``path``, or in its ``files`` alone, once.

    One row per element of every page's ``results``, and one per page that
    cannot be read. Columns: the layout's folder keys (renamed ``<c>__key``
    when they collide with an entity field), ``source_file``, ``element``
    (place in the page; NULL for a page), ``doc`` (the typed document),
    ``reason`` and ``raw_text`` (kept where there is a reason). Reasons:
    ``malformed`` (no JSON of the envelope, or text after it), ``no_results``
    (no ``results`` array), ``bad_element`` (no object) and ``partly_corrupt``
    (a field of the wrong type, read as NULL; the document is kept). An empty
    ``results`` array gives no row. ``restrict`` filters the page texts by
    their folder keys before anything is parsed. Written as Parquet, it is the
    staging table that rows and quarantine are read from.
    """
    return parse_text(_texts(spark, path, layout, restrict, files), entity)


def _page_keys(pages: DataFrame) -> list[str]:
    return [c for c in pages.columns if c not in PAGE_COLUMNS]


def page_rows(pages: DataFrame) -> DataFrame:
    """Documents of ``parse_pages`` output, with the folder keys."""
    return pages.where(F.col("reason").isNull() | (F.col("reason") == PARTLY)).select(*_page_keys(pages), "doc.*")


def page_quarantine(pages: DataFrame) -> DataFrame:
    """What is no row: keys, source_file, element, raw_text, reason."""
    return pages.where(F.col("reason").isNotNull() & (F.col("reason") != PARTLY)).select(
        *_page_keys(pages), "source_file", "element", "raw_text", "reason")


def page_warnings(pages: DataFrame) -> DataFrame:
    """(source_file, n): documents per page file that were read with a field of the wrong type as NULL."""
    return pages.where(F.col("reason") == PARTLY).groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))


def split_pages(spark: SparkSession, path: str, entity: T.StructType, layout: str = "auto") -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of the pages under ``path`` (see ``parse_pages``)."""
    pages = parse_pages(spark, path, entity, layout)
    return page_rows(pages), page_quarantine(pages)


def read_pages(spark: SparkSession, path: str, entity: T.StructType, layout: str = "auto") -> DataFrame:
    """Rows of all pages under ``path`` (see ``split_pages``)."""
    return split_pages(spark, path, entity, layout)[0]


def read_parameters(spark: SparkSession, path: str, **kw) -> DataFrame:
    return read_pages(spark, path, schemas.PARAMETER, **kw)


def read_countries(spark: SparkSession, path: str, **kw) -> DataFrame:
    """Countries; every landed page is read (no 200-row cap)."""
    return read_pages(spark, path, schemas.COUNTRY, **kw)


def read_providers(spark: SparkSession, path: str, **kw) -> DataFrame:
    return read_pages(spark, path, schemas.PROVIDER, **kw)


def read_locations(spark: SparkSession, path: str, **kw) -> DataFrame:
    return read_pages(spark, path, schemas.LOCATION, **kw)


def read_measurements(spark: SparkSession, path: str, **kw) -> DataFrame:
    """Measurements landed as ``<path>/sensor_id=<id>/…`` pages (or pages whose
    documents carry ``sensor_id``). See ``measurement_rows``."""
    return measurement_rows(read_pages(spark, path, schemas.MEASUREMENT, **kw))


def measurement_rows(rows: DataFrame) -> DataFrame:
    """Attach the request key: ``sensor_id`` from the folder name, unless the
    document carries its own (the document wins, as in the original dict
    merge). Other layout columns follow the document columns."""
    doc_cols = [c for c in schemas.MEASUREMENT.fieldNames() if c != "sensor_id"]
    others = [c for c in rows.columns if c not in schemas.MEASUREMENT.fieldNames() and c != "sensor_id__key"]
    key = F.col("sensor_id")
    if "sensor_id__key" in rows.columns:
        key = F.coalesce(F.col("sensor_id"), F.col("sensor_id__key").try_cast("int"))
    return rows.select(key.alias("sensor_id"), *doc_cols, *others)


def page_texts(docs: DataFrame, keys: list[str], doc: str) -> DataFrame:
    """``keys`` and value: the JSON documents (column ``doc``) of each page as one envelope. ``docs`` has to come dealt by some
    of ``keys``: it is sorted where it lies, and a task holds one page and one batch of documents at a time."""
    kinds = [docs.schema[k] for k in keys]
    schema = T.StructType([*kinds, T.StructField("value", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page, held = None, []

        def texts(done: list) -> pa.RecordBatch:
            columns = [pa.array([p[i] for p, _ in done], arrow.field(i).type) for i in range(len(keys))]
            value = pa.array(['{"results":[' + ",".join(d) + "]}" for _, d in done], arrow.field(len(keys)).type)
            return pa.RecordBatch.from_arrays([*columns, value], schema=arrow)

        for batch in batches:
            done = []
            for *at, text in zip(*[batch.column(c).to_pylist() for c in (*keys, doc)]):
                if at != page:
                    if held:
                        done.append((page, held))
                    page, held = at, []
                held.append(text)
            if done:
                yield texts(done)
        if held:
            yield texts([(page, held)])

    arrow = to_arrow_schema(schema)
    return docs.select(*keys, doc).sortWithinPartitions(*keys).mapInArrow(run, schema)


def write_pages(docs: DataFrame, path: str, page: Column, partition_by: list[str] | None = None,
                mode: str = "overwrite", drop: list[str] | None = None, one_page_per_file: bool = True,
                compression: str | None = None) -> None:
    """Land documents as API pages: one ``{"results": [...]}`` file per page.

    ``page`` assigns each document to a page of bounded size (e.g. id div
    1000); the page number and the ``partition_by`` columns become folder
    names (``sensor_id=…/page=…``) and are not repeated inside the documents.
    Used to build landing zones from tables (tests, stand-in inputs, backfill).
    ``drop`` names helper columns used by ``page`` that are not document fields.
    ``one_page_per_file=False`` writes JSON lines (one page per line), with
    ``compression`` (e.g. ``gzip``) in files that a reader can't split.
    """
    partition_by = list(partition_by or [])
    body = [c for c in docs.columns if c not in partition_by and c not in (drop or [])]
    doc = F.to_json(F.struct(*body))
    keys = [*partition_by, "page"]
    pages = page_texts(docs.withColumn("page", page).select(*keys, doc.alias("__doc")).repartition(*keys), keys, "__doc")
    if one_page_per_file:
        pages.write.mode(mode).partitionBy(*partition_by, "page").text(path)
    else:  # JSON lines: one page envelope per line, many pages per file
        lines = pages.select(*partition_by, "value").write.mode(mode).partitionBy(*partition_by)
        lines.text(path, compression=compression)
