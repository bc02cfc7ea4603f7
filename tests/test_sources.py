import json
import os

from pyspark.sql import functions as F

from aeris import schemas
from aeris.session import local_fs_path
from aeris.sources import landed


def _write(path, name, text):
    p = local_fs_path(path)
    os.makedirs(os.path.dirname(os.path.join(p, name)), exist_ok=True)
    with open(os.path.join(p, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_pages_good_empty_and_quarantine(spark, scratch):
    root = scratch("pages")
    page1 = {"results": [{"id": 1, "name": "pm25", "units": "µg/m³"}, {"id": 2, "name": "o3"}]}
    _write(root, "p1.json", json.dumps(page1, indent=2, ensure_ascii=False))  # pretty-printed
    _write(root, "p2.json", json.dumps({"results": []}))
    _write(root, "p3.json", "<html>502 Bad Gateway</html>")
    _write(root, "p4.json", json.dumps({"error": 1}))
    _write(root, "p5.json", json.dumps({"results": [{"id": "12", "name": "x"}, {"id": 12.5, "name": "y"}]}))
    rows, quarantine = landed.split_pages(spark, root, schemas.PARAMETER)
    got = sorted((r.id, r.name) for r in rows.collect() if r.id is not None)
    assert got == [(1, "pm25"), (2, "o3")]
    # wrong-typed ids become NULL, the rows are kept
    assert sorted(r.name for r in rows.collect() if r.id is None) == ["x", "y"]
    q = sorted((os.path.basename(r.source_file), r.reason) for r in quarantine.collect())
    assert q == [("p3.json", "malformed"), ("p4.json", "no_results")]


def test_json_lines_pages(spark, scratch):
    root = scratch("jsonl")
    lines = "\n".join(json.dumps({"results": [{"id": i}]}) for i in range(5))
    _write(root, "all.jsonl", lines + "\n")
    rows = landed.read_parameters(spark, root, layout="lines")
    assert sorted(r.id for r in rows.collect()) == [0, 1, 2, 3, 4]


def test_measurements_key_from_folder_and_document_wins(spark, scratch):
    root = scratch("meas")
    doc = {"value": 1.5, "parameter": {"id": 2}, "period": {"datetimeFrom": {"local": "2025-03-01T10:00:00Z"}}}
    _write(root, "sensor_id=11/p.json", json.dumps({"results": [doc, doc]}))
    _write(root, "sensor_id=12/p.json", json.dumps({"results": [dict(doc, sensor_id=99)]}))
    got = sorted(r.sensor_id for r in landed.read_measurements(spark, root).collect())
    assert got == [11, 11, 99]
    assert landed.read_measurements(spark, root).columns[:2] == ["sensor_id", "value"]


def test_write_pages_round_trip(spark, scratch):
    from aeris import adapters as A
    from tests.conftest import SF001

    root = scratch("rt")
    A.land_measurements(spark, SF001, root, sensor_folders=True)
    back = landed.read_measurements(spark, root).drop("page")
    direct = A.raw_measurements(spark, SF001)
    assert back.count() == direct.count()
    assert back.select(*direct.columns).exceptAll(direct).count() == 0


def test_parse_documents(spark):
    df = spark.createDataFrame([('{"id": 3, "name": "no2"}',), ("nope",)], "j string")
    got = landed.parse_documents(df, "j", schemas.PARAMETER).collect()
    assert (got[0].id, got[0].name) == (3, "no2") and got[1].id is None


def test_read_limit_cells_and_union(spark, scratch):
    from aeris.sources import read_limit_cells, union_batches

    root = scratch("cells")
    _write(root, "c.json", "\n".join(json.dumps(r) for r in [
        {"table_no": 1, "row_no": 0, "c0": "OZONE\n3"}, {"table_no": 1, "row_no": 1, "c0": "a", "c1": "5 µg/m3 (UE)",
                                                          "c2": "x", "extra": 1}]) + "\n")
    cells = read_limit_cells(spark, root)
    assert cells.columns == ["table_no", "row_no", "c0", "c1", "c2"] and cells.count() == 2
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 3.0)], "k int, b double")
    u = union_batches([a, b])
    assert sorted(u.columns) == ["a", "b", "k"] and u.count() == 2


def test_page_files_equal_one_json_lines_file(spark, scratch):
    from aeris import adapters as A
    from tests.conftest import SF001

    pages = scratch("pages")
    A.land_locations(spark, SF001, pages, page_size=10)
    lines = scratch("lines")
    spark.read.text(pages, wholetext=True).select("value").coalesce(1).write.text(lines)
    a = landed.read_locations(spark, pages).drop("page")
    b = landed.read_locations(spark, lines, layout="lines")
    assert a.count() == b.count() == 150
    assert a.exceptAll(b).count() == 0


def _reasons(spark, root, layout="auto"):
    pages = landed.parse_pages(spark, root, schemas.PARAMETER, layout)
    bad = sorted((os.path.basename(r.source_file), r.element, r.reason) for r in landed.page_quarantine(pages).collect())
    warned = {os.path.basename(r.source_file): r.n for r in landed.page_warnings(pages).collect()}
    return sorted(str(r.id) for r in landed.page_rows(pages).collect()), bad, warned


def test_one_bad_element_costs_only_itself(spark, scratch):
    root = scratch("elements")
    _write(root, "a.json", '{"results": [{"id": 1}, "junk", null, 7, [1], {"id": "x", "name": "n"}, {"id": 2}]}')
    rows, bad, warned = _reasons(spark, root)
    assert rows == ["1", "2", "None"] and warned == {"a.json": 1}
    assert bad == [("a.json", i, "bad_element") for i in (1, 2, 3, 4)]


def test_layout_follows_the_content(spark, scratch):
    root = scratch("mixed")
    _write(root, "lines.json", '{"results": [{"id": 1}]}\n\n{"results": []}\n{"results": [{"id": 2}]}\n{"results": [{"id"\n')
    _write(root, "pretty.json", json.dumps({"results": [{"id": 3}]}, indent=1))
    _write(root, "one.json", '{"results": [{"id": 4}]}')
    _write(root, "trailing.json", json.dumps({"results": [{"id": 9}]}, indent=1) + "\nand more")
    rows, bad, _ = _reasons(spark, root)
    assert rows == ["1", "2", "3", "4"]
    assert bad == [("lines.json", None, "malformed"), ("trailing.json", None, "malformed")]
    # a file said to be one page loses nothing silently either
    rows, bad, _ = _reasons(spark, root, "page")
    assert rows == ["3", "4"] and [b[0] for b in bad] == ["lines.json", "trailing.json"]


def test_envelopes_are_parsed_once(spark, scratch):
    """One parse of the envelopes and one of the documents: Spark adds no check of the exploded array that parses them again."""
    path = scratch("once")
    _write(path, "a.json", '{"results":[{"id":1},3]}\n{"results":[]}\n{"bad"')
    for layout, most in (("lines", 2), ("page", 2)):
        pages = landed.parse_pages(spark, path, schemas.PARAMETER, layout)
        assert pages._jdf.queryExecution().optimizedPlan().toString().count("from_json(") <= most
    rows = landed.parse_pages(spark, path, schemas.PARAMETER, "lines").select("element", "reason", "doc.id").collect()
    assert sorted(map(tuple, rows), key=str) == [(0, None, 1), (1, "bad_element", None), (None, "malformed", None)]


def test_pages_are_dealt_once_and_compressed(spark, scratch):
    """One shuffle of documents, every one in its page, and lines that read the same from compressed files in any layout."""
    docs = spark.createDataFrame([(i % 7 if i % 5 else None, i, f"é\"{i}" if i % 3 else None) for i in range(500)], "page int, id int, name string")
    texts = landed.page_texts(docs.select("page", F.to_json(F.struct("id", "name")).alias("doc")).repartition("page"), ["page"], "doc")
    assert texts._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 1
    assert "Aggregate" not in texts._jdf.queryExecution().optimizedPlan().toString()
    got = {r.page: sorted(d["id"] for d in json.loads(r.value)["results"]) for r in texts.collect()}
    assert got == {p: [i for i in range(500) if (i % 7 if i % 5 else None) == p] for p in (None, *range(7))} and texts.count() == 8
    path = scratch("packed")
    landed.write_pages(docs.drop("page"), path, F.col("id") % 7, one_page_per_file=False, compression="gzip")
    assert all(f.endswith(".gz") for f in [r.f for r in spark.read.text(path).select(F.col("_metadata.file_name").alias("f")).distinct().collect()])
    for layout in ("auto", "lines"):
        rows = landed.read_pages(spark, path, schemas.PARAMETER, layout)
        assert sorted((r.id, r.name) for r in rows.collect()) == [(i, f"é\"{i}" if i % 3 else None) for i in range(500)]
