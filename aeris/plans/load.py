"""Warehouse tables and the load policy of the daily ETL.

``Warehouse`` hides where tables live:

* ``"path"``    – Parquet folders under ``root`` (``root/<name>``)
* ``"catalog"`` – tables of a Spark catalog database (``saveAsTable``)
* ``"jdbc"``    – a relational database over JDBC (``database.<name>``)

``load_step`` is the policy: a missing table is built and created; an existing
dimension is skipped (unless ``refresh``); an existing fact gets the new
batch. Unlike the original (which appended blindly, so a re-run duplicated a
day, and which treated a failed existence check as "absent" and overwrote),
facts *replace* the days present in the batch (dynamic partition overwrite),
and with a window also the days of it that the batch no longer has, and
existence-check errors propagate. Every step returns the stored table,
read back, so downstream steps start from written data (lineage is cut and a
lost executor never re-runs upstream steps).
"""

from __future__ import annotations

import time
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        backend: str = "path",
        root: str | None = None,
        database: str | None = None,
        jdbc_url: str | None = None,
        jdbc_properties: dict | None = None,
        jdbc_batchsize: int = 10_000,
        jdbc_write_partitions: int | None = None,
    ):
        """``jdbc_properties`` carry driver, user and password. Writes send
        ``jdbc_batchsize`` rows per round trip, an overwrite truncates instead
        of dropping the table (keeps its DDL and grants), and
        ``jdbc_write_partitions`` caps concurrent connections."""
        if backend not in ("path", "catalog", "jdbc"):
            raise ValueError(f"unknown backend {backend!r}")
        if backend == "path" and not root:
            raise ValueError("path backend needs a root folder")
        if backend == "jdbc" and not jdbc_url:
            raise ValueError("jdbc backend needs jdbc_url")
        self.spark = spark
        self.backend = backend
        self.root = (root or "").rstrip("/")
        self.database = database
        self.jdbc_url = jdbc_url
        self.jdbc_properties = dict(jdbc_properties or {})
        self.jdbc_write_properties = {**self.jdbc_properties, "batchsize": str(jdbc_batchsize), "truncate": "true"}
        if jdbc_write_partitions:
            self.jdbc_write_properties["numPartitions"] = str(jdbc_write_partitions)

    # ------------------------------------------------------------ naming
    def location(self, name: str) -> str:
        if self.backend == "path":
            return f"{self.root}/{name}"
        return f"{self.database}.{name}" if self.database else name

    # ------------------------------------------------------------ SRC8
    def exists(self, name: str) -> bool:
        """Whether table ``name`` exists. Errors other than "not found" propagate."""
        if self.backend == "catalog":
            return self.spark.catalog.tableExists(self.location(name))
        if self.backend == "jdbc":
            tables = self.spark.read.jdbc(self.jdbc_url, "information_schema.tables", properties=self.jdbc_properties)
            # plain equality on stored names, which the database filters itself
            cond = F.col("table_name") == name
            if self.database:
                cond = cond & (F.col("table_schema") == self.database)
            return not tables.where(cond).limit(1).isEmpty()
        return self._stored_schema(name) is not None

    # ------------------------------------------------------------ SRC7
    def read(self, name: str, **jdbc_partitioning) -> DataFrame:
        """The stored table. For JDBC, ``column/lowerBound/upperBound/numPartitions``
        split a large fact into parallel range scans."""
        if self.backend == "catalog":
            return self.spark.read.table(self.location(name))
        if self.backend == "jdbc":
            return self.spark.read.jdbc(
                self.jdbc_url, self.location(name), properties=self.jdbc_properties, **jdbc_partitioning
            )
        # Read with the schema the table was written with: partition folder
        # values (day=2024-01-01) come back as the strings they were, and a
        # table whose last batch was empty still has its columns.
        schema = self._stored_schema(name)
        if schema is None:
            return self.spark.read.parquet(self.location(name))
        return self.spark.read.schema(schema).parquet(self.location(name))

    def _schema_marker(self, name: str) -> str:
        return f"{self.root}/_schemas/{name}"

    def _marker_schema(self, name: str):
        try:
            return self.spark.read.parquet(self._schema_marker(name)).schema
        except AnalysisException as e:
            if (e.getCondition() or "") != "PATH_NOT_FOUND":
                raise
        return None

    def _stored_schema(self, name: str):
        """Schema of a path-backend table, or None when the table is absent."""
        marker = self._marker_schema(name)
        if marker is not None:
            return marker
        try:  # unpartitioned tables (and tables written elsewhere) carry their own
            return self.spark.read.parquet(self.location(name)).schema
        except AnalysisException as e:
            if (e.getCondition() or "") == "PATH_NOT_FOUND":
                return None
            raise

    # ------------------------------------------------------------ SNK1
    def write(self, df: DataFrame, name: str, mode: str = "overwrite", partition_by: list[str] | None = None,
              cluster_by: list[str] | None = None) -> None:
        """Write ``df`` as table ``name``.

        ``mode="replace_partitions"`` overwrites only the partitions present in
        ``df`` (dynamic partition overwrite); other modes are Spark's.
        A partitioned table is rebalanced by ``partition_by`` first: a
        partition's rows meet in as few tasks as their size allows (a large one
        is split), so the number of files follows the data and not tasks x
        partitions. Rows are sorted inside each task by ``partition_by`` then
        ``cluster_by``, and Parquet min/max statistics on ``cluster_by`` let
        readers skip row groups (e.g. one sensor's history).
        A batch may bring new columns (NULL in the rows stored before); a
        column of another type is an error.
        """
        partition_by = list(partition_by or [])
        order = partition_by + [c for c in (cluster_by or []) if c not in partition_by]
        if self.backend == "jdbc":
            if mode == "replace_partitions":
                raise NotImplementedError("JDBC tables cannot replace partitions; use fact_mode='append'")
            df.write.jdbc(self.jdbc_url, self.location(name), mode=mode, properties=self.jdbc_write_properties)
            return
        if partition_by:
            df = df.hint("rebalance", *partition_by)
        if order:
            df = df.sortWithinPartitions(*order)
        if self.backend == "catalog":
            self._write_catalog(df, name, mode, partition_by)
            return
        schema = df.schema
        if mode != "overwrite":
            stored = self._stored_schema(name)
            if stored is not None:
                schema = _evolved(stored, df.schema, name)
        writer = df.write
        if mode == "replace_partitions":
            writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        else:
            writer = writer.mode(mode)
        if mode == "overwrite":
            # a table is replaced as a whole, whatever the session's overwrite mode is
            writer = writer.option("partitionOverwriteMode", "static")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.location(name))
        if mode == "overwrite" or self._marker_schema(name) != schema:
            # A partitioned table whose batch was empty has no file to carry its
            # schema, and one that grew a column has files without it; an empty,
            # unpartitioned Parquet file next to the table keeps the whole schema.
            empty = self.spark.createDataFrame([], schema)
            empty.coalesce(1).write.mode("overwrite").parquet(self._schema_marker(name))

    def _write_catalog(self, df: DataFrame, name: str, mode: str, partition_by: list[str]) -> None:
        table = self.location(name)
        if mode == "replace_partitions" and self.exists(name):
            # The partitions are overwritten in the table's folder, as a write of
            # one table can name its overwrite mode there (``insertInto`` would
            # need the session's), and then made known to the catalog.
            target = self.spark.read.table(table)
            if _evolved(target.schema, df.schema, name) != target.schema:
                raise ValueError(f"{name}: a catalog table's columns are altered in the catalog, not by a batch")
            where = {r.col_name: r.data_type for r in self.spark.sql(f"DESCRIBE EXTENDED {table}").collect()}["Location"]
            (df.select(*target.columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*partition_by).parquet(where))
            self.spark.catalog.recoverPartitions(table)
            self.spark.catalog.refreshTable(table)
            return
        writer = df.write.mode("overwrite" if mode == "replace_partitions" else mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.format("parquet").saveAsTable(table)

    def drop_partitions(self, name: str, column: str, values: list[str]) -> None:
        """Remove whole partitions ``column = value`` of a Parquet table."""
        for value in values:
            if self.backend == "catalog":
                literal = str(value).replace("'", "\\'")
                self.spark.sql(f"ALTER TABLE {self.location(name)} DROP IF EXISTS PARTITION ({column} = '{literal}')")
            else:
                jvm = self.spark.sparkContext._jvm
                folder = jvm.org.apache.hadoop.fs.Path(f"{self.location(name)}/{column}={value}")
                folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

    # ------------------------------------------------------------ SNK5
    def export(self, name: str, path: str, fmt: str = "csv") -> None:
        """Read-only export of a table to files (CSV with a header by default)."""
        writer = self.read(name).write.mode("overwrite")
        if fmt == "csv":
            writer.option("header", True).csv(path)
        else:
            writer.format(fmt).save(path)


def _evolved(stored: T.StructType, batch: T.StructType, name: str) -> T.StructType:
    """The stored schema with the batch's new columns; another type of a stored column is an error."""
    # types are told apart without their nullability, which files don't keep
    known = {f.name: f.dataType.simpleString() for f in stored.fields}
    for f in batch.fields:
        if f.name in known and known[f.name] != f.dataType.simpleString():
            raise ValueError(f"{name}: column {f.name} is stored as {known[f.name]}, the batch has {f.dataType.simpleString()}")
    return T.StructType(stored.fields + [T.StructField(f.name, f.dataType) for f in batch.fields if f.name not in known])


@dataclass
class StepResult:
    """Outcome of one load step.

    ``table`` reads the stored table (fresh on each access, so it stays valid
    after later loads rewrite files); ``rows`` counts it on first access, not
    during the run — on a large fact that is a scan of every file.
    """

    name: str
    action: str  # created | skipped | replaced | appended | merged | refreshed
    seconds: float
    warehouse: Warehouse = field(repr=False)
    _rows: int | None = field(default=None, repr=False)

    @property
    def table(self) -> DataFrame:
        return self.warehouse.read(self.name)

    @property
    def rows(self) -> int:
        if self._rows is None:
            self._rows = self.table.count()
        return self._rows


@contextmanager
def job_group(spark: SparkSession, group_id: str, description: str):
    """Label the Spark jobs of a step (shown in logs and the event log)."""
    sc = spark.sparkContext
    sc.setJobGroup(group_id, description)
    try:
        yield
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)


def load_step(
    warehouse: Warehouse,
    name: str,
    build: Callable[[], DataFrame],
    kind: str = "dimension",
    partition_by: list[str] | None = None,
    fact_mode: str = "replace",
    merge_keys: list[str] | None = None,
    refresh: bool = False,
    writer: Callable[[DataFrame, str], None] | None = None,
    count: bool = False,
    description: str | None = None,
    cluster_by: list[str] | None = None,
    window: tuple[str, str] | None = None,
) -> StepResult:
    """Create / skip / load one table.

    * table absent → ``build()`` and create it (``overwrite``);
    * dimension present → skip and return the stored table (``refresh=True``
      rebuilds it);
    * fact present → ``build()`` and, by ``fact_mode``:
      ``"replace"`` (default) overwrite the partitions (days) of the batch, so a
      re-run of a day is idempotent; ``"merge"`` union the batch with the stored
      rows of its partitions and keep one row per ``merge_keys`` (late data for
      an old day); ``"append"`` the original plain append.

    ``window`` is the half-open range of the first partition column's values
    that the batch stands for. A replacing load also removes the stored
    partitions of the window that the batch no longer has; a merging load
    reads only the window's stored partitions.

    ``build`` runs only when needed. ``writer(df, name)`` replaces the default
    writer; ``cluster_by`` orders rows inside each written file. The step's
    jobs are labelled with ``name``; ``count=True`` counts the stored table
    inside the step (otherwise ``StepResult.rows`` counts on first access).
    """
    if kind not in ("dimension", "fact"):
        raise ValueError(f"unknown kind {kind!r}")
    spark = warehouse.spark
    partition_by = list(partition_by or [])
    started = time.perf_counter()
    with job_group(spark, name, description or f"load {name}"):
        present = warehouse.exists(name)
        if present and kind == "dimension" and not refresh:
            action = "skipped"
        else:
            df = build()
            if not present:
                action, mode = "created", "overwrite"
            elif kind == "dimension":
                action, mode = "refreshed", "overwrite"
            elif fact_mode == "append":
                action, mode = "appended", "append"
            elif fact_mode == "replace":
                if not partition_by:
                    raise ValueError("replacing facts needs partition_by")
                action, mode = "replaced", "replace_partitions"
            elif fact_mode == "merge":
                if not (partition_by and merge_keys):
                    raise ValueError("merging facts needs partition_by and merge_keys")
                df = _merge_with_stored(warehouse, name, df, partition_by, merge_keys, window)
                action, mode = "merged", "replace_partitions"
            else:
                raise ValueError(f"unknown fact_mode {fact_mode!r}")
            if writer is not None:
                writer(df, name)
            else:
                before = []
                if action == "replaced" and window:
                    before, df = _emptied_days(warehouse, name, df, partition_by[0], window)
                warehouse.write(df, name, mode=mode, partition_by=partition_by if kind == "fact" else None,
                                cluster_by=cluster_by)
                if before:
                    warehouse.drop_partitions(name, partition_by[0], before)
    result = StepResult(name, action, round(time.perf_counter() - started, 3), warehouse)
    if count:
        result.rows  # noqa: B018 - count now, on request
    return result


def _inside(df: DataFrame, column: str, window: tuple[str, str]):
    lo, hi = (F.lit(x).cast(df.schema[column].dataType) for x in window)
    return (F.col(column) >= lo) & (F.col(column) < hi)


def _within(df: DataFrame, column: str, window: tuple[str, str]) -> DataFrame:
    return df.where(_inside(df, column, window))


def _emptied_days(warehouse: Warehouse, name: str, df: DataFrame, column: str,
                  window: tuple[str, str]) -> tuple[list[str], DataFrame]:
    """(stored partition values of the window that the batch doesn't have, the batch). The values are one per partition of
    the window. The batch is written to the shared folder once, as it is read for its days and for the load."""
    from aeris.session import scratch_path

    path = scratch_path(warehouse.spark, f"batch-{name}")
    df.write.parquet(path)
    df = warehouse.spark.read.schema(df.schema).parquet(path)
    held = _within(warehouse.read(name), column, window).select(column).distinct()
    gone = held.join(df.select(column).distinct(), column, "left_anti")
    return [r[0] for r in gone.collect()], df


def _merge_with_stored(warehouse: Warehouse, name: str, batch: DataFrame, partition_by: list[str],
                       keys: list[str], window: tuple[str, str] | None = None) -> DataFrame:
    """Batch ∪ stored rows of the batch's partitions, one row per key (batch wins).

    Partitions are matched null-safe, so the rows of a NULL partition are kept
    too. ``window`` prunes the stored partitions by a literal filter; rows of
    the batch outside of it (or with a NULL day) are an error, as their stored
    neighbours would not be read. The result is checkpointed to the shared
    checkpoint folder before it is written, because it reads the very
    partitions it will overwrite.
    """
    from pyspark.sql import Window

    stored = warehouse.read(name)
    if window:
        stored = _within(stored, partition_by[0], window)
        if not batch.where(~F.coalesce(_inside(batch, partition_by[0], window), F.lit(False))).isEmpty():
            raise ValueError(f"{name}: the batch has rows outside of the window {window}")
    touched = batch.select(*[F.col(c).alias(f"__{c}") for c in partition_by]).distinct()
    same = F.lit(True)
    for c in partition_by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    old = stored.join(touched, same, "left_semi")
    both = batch.withColumn("__batch", F.lit(1)).unionByName(old.withColumn("__batch", F.lit(0)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(F.desc("__batch"))
    merged = both.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn", "__batch")
    return merged.checkpoint(eager=True)
