from pyspark.sql import functions as F

from aeris.functions import text as X
from aeris.operators.limits import limit_rows, limits_document, write_limits_document


def _map(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r.o for r in df.select(fn(F.col("s")).alias("o")).collect()]


def test_component_names(spark):
    got = _map(spark, X.component_name, ["BENZÈNE ( CH66 )", "PARTICULES (PM2,5)", "PM10 seul", "A (b 1) C2 (d3)",
                                         "x (ch₆₆ 2) (", "A (b (c) d)"])
    assert got == ["BENZÈNE (C₆H₆)", "PARTICULES (PM₂,₅)", "PM10 seul", "A (b₁) C2 (d₃)", "x (C₆H₆₂) (",
                   "A (b(c) d)"]


def test_titles(spark):
    got = _map(spark, X.pollutant_title, ["BENZÈNE (CH)\n6 6", "OZONE\n3", "A (x) (y) \n 1 2 \nz", "", None, "PLOMB"])
    assert got == ["BENZÈNE (C₆H₆)", "OZONE3", "A (x) (y₁₂)", "Inconnu", "Inconnu", "PLOMB"]


def test_measurement_values(spark):
    vals = ["40 µg/m³ (FR)\n 25,5  µg/m3 (UE)", "aucune valeur", "1 µg/m³ (FR)", None, " x\x1c"]
    assert _map(spark, X.measurement_values, vals) == ["40 µg/m³ ; 25,5 µg/m3", "aucune valeur", "1 µg/m³", "", "x"]
    assert _map(spark, X.measurement_origins, vals) == ["FR ; UE", "", "FR", "", ""]


def _cells(spark):
    return spark.createDataFrame([
        (1, 0, "BENZÈNE (CH)\n6 6", None, None),
        (1, 1, "a", "40 µg/m³ (FR)", "c\n1"), (1, 2, None, "5 µg/m3 (UE)", None), (1, 3, "", "", None),
        (1, 4, " ", "x", None), (1, 5, "", "7 ng/m3 (FR)", None),
        (2, 0, "OZONE\n3", None, None), (2, 1, "i", "", None),
    ], "table_no int, row_no int, c0 string, c1 string, c2 string")


def test_fill_forward_and_drop(spark):
    got = [tuple(r) for r in limit_rows(_cells(spark)).orderBy("table_no", "row_no").collect()]
    assert got == [
        (1, 1, "BENZÈNE (C₆H₆)", "a", "40 µg/m³", "FR", "c 1"),
        (1, 2, "BENZÈNE (C₆H₆)", "a", "5 µg/m3", "UE", ""),
        (1, 4, "BENZÈNE (C₆H₆)", "", "x", "", ""),
        (1, 5, "BENZÈNE (C₆H₆)", "", "7 ng/m3", "FR", ""),
    ]


def test_document_keeps_empty_pollutant(spark, scratch):
    doc = limits_document(_cells(spark))
    got = {r.table_no: r for r in doc.collect()}
    assert got[2].nom == "OZONE3" and got[2].informations == []
    assert [i.valeurs for i in got[1].informations] == ["40 µg/m³", "5 µg/m3", "x", "7 ng/m3"]
    path = scratch("limits")
    write_limits_document(doc, path)
    back = spark.read.schema(doc.schema).json(path)
    assert back.exceptAll(doc).count() == 0


def test_bucketed_fill_forward_equals_single_bucket(spark):
    from aeris import adapters as A
    from tests.conftest import SF001

    cells = A.limit_cells(spark, SF001).unionByName(_cells(spark).withColumn("table_no", F.col("table_no") + 10_000))
    whole = limit_rows(cells, bucket_rows=1_000_000)
    for b in (2, 3):
        small = limit_rows(cells, bucket_rows=b)
        assert small.count() == whole.count()
        assert small.exceptAll(whole).count() == 0


def test_fill_forward_across_empty_buckets(spark):
    from aeris.operators.limits import fill_forward

    df = spark.createDataFrame([(1, 0, "a"), (1, 5, None), (1, 9, None), (1, 12, "b"), (1, 13, None), (2, 3, None)],
                               "k int, pos int, v string")
    got = {(r.k, r.pos): r.f for r in fill_forward(df, "k", "pos", F.col("v"), "f", bucket_rows=2).collect()}
    assert got == {(1, 0): "a", (1, 5): "a", (1, 9): "a", (1, 12): "b", (1, 13): "b", (2, 3): None}
