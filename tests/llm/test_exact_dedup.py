import hashlib
import re

import duckdb

from aeris.llm.exact_dedup import OP2_SQL, DigestIndex, exact_dedup, op2_exact_dedup, row_keys, without_copies

SF = "/root/testdata/sf0.001"


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i))
    out = []
    for i, t in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        out.append((i, min(groups[key])[2], len(groups[key]), hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    rows = df.collect()
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str), rows


def test_groups_against_brute_force(docs):
    rows = [(1, "a b"), (2, "ab"), (3, "a  b"), (4, None), (5, " \t"), (6, ""), (7, "é x"), (8, "éx"),
            (9, "x" * 200_000), (10, "x" * 199_999 + " x"), (11, "ab ")] + [(100 + i, "hot\ntext") for i in range(50)]
    got, full = result(exact_dedup(docs(rows, extra=["keep_id", "text_sha256", "row_id"])))
    assert got == brute(rows)
    assert sum(r.kept for r in full) == len({r.text_sha256 for r in full})
    assert all(r.kept == (r.doc_id == r.keep_id) for r in full)


def test_repeated_rows_keep_one(docs):
    full = exact_dedup(docs([(1, "a"), (1, "a"), (1, "a"), (None, "b"), (None, "b")])).collect()
    assert len(full) == 5 and sum(r.kept for r in full if r.doc_id == 1) == 1 and sum(r.kept for r in full) == 2


def test_empty_table(docs):
    assert exact_dedup(docs([])).count() == 0


def test_later_batches_are_held_against_the_index(spark, docs):
    index = DigestIndex(spark)
    exact_dedup(docs([(1, "a"), (2, "b b"), (3, "b b ")]), index).collect()
    second = {r.doc_id: r for r in exact_dedup(docs([(10, "bb"), (11, "c"), (12, "c ")]), index).collect()}
    assert (second[10].keep_id, second[10].kept) == (3, False)
    assert second[12].kept and not second[11].kept
    assert index.read().count() == 3


def test_the_same_table_again_keeps_no_row(spark, docs):
    index, given = DigestIndex(spark), docs([(1, "a"), (2, "b b"), (3, "b b "), (None, "c")])
    assert without_copies(given, index).count() == 3
    again = exact_dedup(given, index).collect()
    assert len(again) == 4 and not any(r.kept for r in again) and {r.keep_id for r in again} == {1, 3, None}
    assert without_copies(given.union(docs([(9, "new")])), index).collect()[0].doc_id == 9
    assert without_copies(given, index).count() == 0 and index.read().count() == 4


def test_anti_join_reads_the_index_without_shuffle(spark, docs):
    index = DigestIndex(spark)
    exact_dedup(docs(["a", "b"]), index).collect()
    keys = row_keys(docs(["c"])).groupBy("text_sha256").count()
    plan = keys.join(index.read().select("text_sha256").hint("merge"), "text_sha256", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    scan = text[text.index("SortMergeJoin"):]
    assert "Bucketed: true" in scan and scan.count("Exchange hashpartitioning") == 1


def test_index_at_a_path_outlives_its_name(spark, docs, scratch):
    """Opened under another name, as another application with a catalog of its own does: nothing is lost, nothing kept twice."""
    path, given = scratch("digests"), docs([(1, "a"), (2, "b b"), (3, "b b ")])
    assert without_copies(given, DigestIndex(spark, path, "first_name", buckets=3)).count() == 2
    spark.sql("DROP TABLE first_name")  # an external table: its files stay
    again = DigestIndex(spark, path, "second_name")
    assert again.exists() and again.read().count() == 2
    assert without_copies(given, again).count() == 0
    assert [r.doc_id for r in without_copies(docs([(5, "bb"), (6, "new")]), DigestIndex(spark, path)).collect()] == [6]
    assert again.read().count() == DigestIndex(spark, path).read().count() == 3
    plan = DigestIndex(spark, path).read().groupBy("text_sha256").count()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "out of 3" in plan and "Exchange" not in plan  # buckets come from the index


def test_buckets_follow_the_expected_rows(spark, docs, scratch):
    from aeris.llm.exact_dedup import BUCKET_ROWS

    for expected, buckets in ((None, 16), (BUCKET_ROWS * 40, 40), (10**13, 50_000)):
        index = DigestIndex(spark, scratch("digests"), expected=expected)
        index.create(spark.createDataFrame([], "text_sha256 string").schema, 3)
        assert index._stored()[0] == buckets


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.sql(OP2_SQL).fetchall())
    got = sorted(tuple(r) for r in op2_exact_dedup(spark, SF).collect())
    assert got == want
