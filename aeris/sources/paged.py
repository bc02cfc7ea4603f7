"""Landed pages as a data source of their own.

``spark.read.format("landed_pages")`` gives the texts of pages that lie in ``page=<n>`` folders, below folders of
other keys if there are such. A partition holds a range of pages; conditions on the page number and on folder keys
choose the folders before a file is opened. As a stream its offset is a page number: it moves
on over pages that have landed without a gap, so a page that lands after its successor is read in its turn and none is
missed. Texts go on to ``landed.parse_text``, as those of files do.

The conditions are an option of the reader, and not filters that Spark pushes: Spark 4.1.2 keeps a Python reader with the
filters of the first query that a frame is used in, and gives their rows to every later query on that frame.

Options: ``path``; ``keys`` (folder keys beside the page, comma-separated); ``conditions`` (JSON list of [key, comparison,
value]); ``pages_per_partition``; ``lines`` (a page on each line of a file instead of one in a file); ``first_page`` (of a
stream). A page must land at once, by a rename of its file.
"""

from __future__ import annotations

import json
import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import types as T

FORMAT = "landed_pages"
#: Folder name of a NULL key (fixed value).
NULL_KEY = "__HIVE_DEFAULT_PARTITION__"
_FOLDER = re.compile(r"([^/=]+)=([^/]*)")
#: Comparisons of a condition; as in SQL, NULL meets none but "is null".
_TESTS = {"=": operator.eq, ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le,
          "in": lambda a, b: a in b, "is null": lambda a, b: a is None}


def _file_system(path: str):
    """(file system, path in it) of a path or URI."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path)


def _visible(path: str) -> bool:
    return not path.rsplit("/", 1)[-1].startswith(("_", "."))


def _files(file_system, folder: str) -> list[str]:
    from pyarrow import fs

    found = file_system.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
    return [f.path for f in found if f.type == fs.FileType.File and _visible(f.path)]


@dataclass
class PageRange(D.InputPartition):
    """Files of consecutive pages: (key values, page, path in the file system)."""

    files: list


@dataclass
class PageNumbers(D.InputPartition):
    """Pages from ``first`` up to but without ``end``."""

    first: int
    end: int


class _Texts:
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.keys = [k for k in options.get("keys", "").split(",") if k]
        self.per_partition = int(options.get("pages_per_partition", 64))
        self.lines = options.get("lines", "false").lower() == "true"

    def listed(self, below: str = "") -> list[tuple]:
        file_system, root = _file_system(self.path)
        out = []
        for path in _files(file_system, root.rstrip("/") + below):
            held = {k: None if v == NULL_KEY else unquote(v) for k, v in _FOLDER.findall(path[len(root):])}
            page = held.get("page")
            out.append((tuple(held.get(k) for k in self.keys), int(page) if page and page.isdecimal() else None, path))
        return sorted(out, key=lambda f: (f[1] is not None, f[1] or 0, f[2]))

    def texts(self, files: list[tuple]) -> Iterator[tuple]:
        file_system, _ = _file_system(self.path)
        for keys, page, path in files:
            with file_system.open_input_stream(path) as stream:
                text = stream.read().decode("utf-8", "replace")
            for value in text.split("\n") if self.lines else [text]:
                if not self.lines or value.strip():
                    yield (*keys, page, path, value)


class PageReader(_Texts, D.DataSourceReader):
    """Pages of a landing, read once."""

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        names = [*self.keys, "page"]
        self.tests = []
        for name, test, value in json.loads(options.get("conditions", "[]")):
            if name not in names or test not in _TESTS:
                raise ValueError(f"no condition on {name!r} by {test!r}")
            self.tests.append((names.index(name), test, value))

    def _meets(self, keys: tuple, page: int | None) -> bool:
        held = (*keys, page)
        return all((held[at] is None) == (test == "is null") and _TESTS[test](held[at], value) for at, test, value in self.tests)

    def partitions(self) -> list[PageRange]:
        out, pages = [], set()
        for f in self.listed():
            if not self._meets(*f[:2]):
                continue
            if not out or (f[1] not in pages and len(pages) == self.per_partition):
                out.append(PageRange([]))
                pages = set()
            pages.add(f[1])
            out[-1].files.append(f)
        return out or [PageRange([])]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        return self.texts(partition.files)


class PageStreamReader(_Texts, D.DataSourceStreamReader):
    """Pages as they land in ``<path>/page=<n>``."""

    #: Folders that are looked up at once.
    AHEAD = 256

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        if self.keys or "conditions" in options:
            raise ValueError("a stream of pages takes no folder keys and no conditions")
        self.first = self.known = int(options.get("first_page", 0))

    def initialOffset(self) -> dict:  # noqa: N802
        return {"page": self.first}

    def latestOffset(self) -> dict:  # noqa: N802
        """The first page that hasn't landed. Only pages after the last known one are looked up."""
        from pyarrow import fs

        file_system, root = _file_system(self.path)
        while True:
            ahead = range(self.known, self.known + self.AHEAD)
            there = file_system.get_file_info([f"{root.rstrip('/')}/page={n}" for n in ahead])
            for n, info in zip(ahead, there):
                if info.type != fs.FileType.Directory or not _files(file_system, info.path):
                    return {"page": n}
                self.known = n + 1

    def partitions(self, start: dict, end: dict) -> list[PageNumbers]:
        step = self.per_partition
        return [PageNumbers(n, min(n + step, end["page"])) for n in range(start["page"], end["page"], step)]

    def read(self, partition: PageNumbers) -> Iterator[tuple]:
        for n in range(partition.first, partition.end):
            yield from self.texts(self.listed(f"/page={n}"))


class LandedPages(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        keys = [k for k in self.options.get("keys", "").split(",") if k]
        return T.StructType([*[T.StructField(k, T.StringType()) for k in keys], T.StructField("page", T.LongType()),
                             T.StructField("source_file", T.StringType()), T.StructField("value", T.StringType())])

    def reader(self, schema: T.StructType) -> PageReader:
        return PageReader(dict(self.options))

    def streamReader(self, schema: T.StructType) -> PageStreamReader:  # noqa: N802
        return PageStreamReader(dict(self.options))


def page_texts(spark: SparkSession, path: str, where: list[tuple] | None = None, stream: bool = False, **options) -> DataFrame:
    """Texts of landed pages (folder keys, page, source_file, value) for ``landed.parse_text``; as a stream or at once.
    ``where`` holds (key, comparison, value): only pages in folders that meet all of them are opened. Folder keys are
    compared as texts, page numbers as numbers."""
    spark.dataSource.register(LandedPages)
    reader = (spark.readStream if stream else spark.read).format(FORMAT).options(**options)
    if where:
        reader = reader.option("conditions", json.dumps([list(w) for w in where]))
    return reader.load(path)


def run_page_stream(spark: SparkSession, path: str, entity: T.StructType, sink: str, checkpoint: str, **options):
    """Append the documents of all pages that have landed since the last run to the Parquet folder ``sink``, with their page."""
    from aeris.sources.landed import page_rows, parse_text

    rows = page_rows(parse_text(page_texts(spark, path, stream=True, **options), entity))
    return rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink)
