import json
import os

import pytest

from aeris import adapters as A
from aeris import schemas
from aeris.session import local_fs_path
from aeris.sources import landed
from aeris.sources.paged import page_texts, run_page_stream
from tests.conftest import SF001


def land(root, folder, ids, name="part-0.txt"):
    """One page file; it lands by a rename."""
    where = os.path.join(local_fs_path(root), folder)
    os.makedirs(where, exist_ok=True)
    with open(os.path.join(where, "." + name), "w") as f:
        f.write(json.dumps({"results": [{"id": i, "name": f"n{i}"} for i in ids]}))
    os.rename(os.path.join(where, "." + name), os.path.join(where, name))


def ids(texts):
    return landed.page_rows(landed.parse_text(texts, schemas.PARAMETER)).select("id")


def test_same_rows_as_the_files(spark, scratch):
    path = scratch("pages")
    A.land_locations(spark, SF001, path, page_size=10)
    want = landed.read_locations(spark, path, layout="page")
    texts = page_texts(spark, path, pages_per_partition=3)
    got = landed.page_rows(landed.parse_text(texts, schemas.LOCATION)).select(*want.columns)
    assert texts.rdd.getNumPartitions() == -(-want.select("page").distinct().count() // 3)
    assert sorted(map(repr, got.drop("page").collect())) == sorted(map(repr, want.drop("page").collect())) and got.count() > 0


def test_conditions_choose_folders_before_files_are_opened(spark, scratch):
    path = scratch("keyed")
    for day in ("2025-03-01", "2025-03-02", None):
        for page in range(6):
            land(path, f"fetch_date={day or '__HIVE_DEFAULT_PARTITION__'}/page={page}", [page + (100 if day else 200)])
    def read(*where):
        return page_texts(spark, path, where=list(where), keys="fetch_date", pages_per_partition=2)

    cut = read(("fetch_date", "=", "2025-03-02"), ("page", ">=", 2), ("page", "<", 5))
    assert [r.id for r in ids(cut).orderBy("id").collect()] == [102, 103, 104]
    assert cut.rdd.getNumPartitions() == 2
    assert {r.id for r in ids(read(("fetch_date", "is null", None))).collect()} == set(range(200, 206))
    assert {r.id for r in ids(read(("page", "in", [1, 3]), ("fetch_date", ">", "2025-03-01"))).collect()} == {101, 103}
    assert ids(read(("page", ">", 50))).count() == 0
    with pytest.raises(Exception, match="no condition"):
        read(("sensor", "=", 1)).count()


def test_a_frame_gives_every_query_its_rows(spark, scratch):
    """Also where filters of Python sources are on, a query's filter stays its own."""
    path = scratch("reused")
    for page in range(6):
        land(path, f"page={page}", [page, page + 10])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        texts = page_texts(spark, path)
        assert {r.id for r in ids(texts.where("page = 2")).collect()} == {2, 12}
        assert texts.count() == 6 and texts.where("page < 2").union(texts.where("page = 5")).count() == 3
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_lines_and_files_without_a_number(spark, scratch):
    path = scratch("lines")
    page = json.dumps({"results": [{"id": 5}]})
    os.makedirs(local_fs_path(path))
    with open(os.path.join(local_fs_path(path), "loose.json"), "w") as f:
        f.write(f"{page}\n\n{page}\n")
    texts = page_texts(spark, path, lines=True)
    assert [r.page for r in texts.collect()] == [None, None]
    assert [r.id for r in ids(texts).collect()] == [5, 5]
    assert page_texts(spark, scratch("nothing-here")).count() == 0


def test_stream_moves_on_without_a_gap(spark, scratch):
    """A page that lands after its successor is read in its turn; a restart goes on where the query was stopped."""
    path, sink, ckpt = scratch("stream"), scratch("sink"), scratch("ckpt")

    def run():
        query = run_page_stream(spark, path, schemas.PARAMETER, sink, ckpt, pages_per_partition=2)
        query.awaitTermination()
        return sorted(r.id for r in spark.read.schema("id int").parquet(sink).collect())

    for page in (0, 1, 2, 4, 5):
        land(path, f"page={page}", [page])
    assert run() == [0, 1, 2]
    land(path, "page=3", [3, 33])
    assert run() == [0, 1, 2, 3, 4, 5, 33]
    assert run() == [0, 1, 2, 3, 4, 5, 33]
    land(path, "page=6", [6])
    assert run() == [0, 1, 2, 3, 4, 5, 6, 33]


def test_keys_are_refused_for_a_stream(spark, scratch):
    with pytest.raises(Exception, match="no folder keys"):
        page_texts(spark, scratch("x"), stream=True, keys="fetch_date").writeStream.format("noop").option(
            "checkpointLocation", scratch("c")).start().processAllAvailable()
