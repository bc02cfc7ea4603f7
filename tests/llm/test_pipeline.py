import math
import re

import corpus_pipeline as C
from tests.llm.test_exact_dedup import brute as brute_exact
from tests.llm.test_packing import brute_pieces, check
from tests.llm.test_simhash import brute_fp, brute_groups

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def brute_cut(texts, threshold=200):
    """Texts without the characters that lie wholly in repeated strings of ``threshold`` bytes."""
    raws = [t.encode() for t in texts]
    seen = {}
    for raw in raws:
        for i in range(len(raw) - threshold + 1):
            seen[raw[i:i + threshold]] = seen.get(raw[i:i + threshold], 0) + 1
    out = []
    for text, raw in zip(texts, raws):
        gone, until = [], 0
        for i in range(len(raw)):
            if i + threshold <= len(raw) and seen[raw[i:i + threshold]] > 1:
                until = i + threshold
            gone.append(i < until)
        kept, at = [], 0
        for c in text:
            n = len(c.encode())
            if not all(gone[at:at + n]):
                kept.append(c)
            at += n
        out.append("".join(kept))
    return out


def test_every_stage_against_brute_force(spark):
    docs = C.table(spark, SF, "documents")
    given = docs.collect()
    results = []
    for name, stage in C.STAGES:
        docs = C.stored(stage(spark, docs, SF), name)
        results.append(docs)
    told, exact, near, cut, packed = results
    assert all(r.columns == COLUMNS and r.schema == C.table(spark, SF, "documents").schema for r in (told, exact, near, cut))

    rows = told.collect()
    letters = [r for r in given if re.search(r"[^\W\d_]", r.text or "")]
    assert {r.doc_id for r in rows} <= {r.doc_id for r in letters} and len(rows) >= 0.99 * len(letters)
    want = {keep for _, keep, _, _ in brute_exact([(r.doc_id, r.text) for r in rows])}
    rows = exact.collect()
    assert sorted(r.doc_id for r in rows) == sorted(want)
    fps = [brute_fp(r.text) for r in rows]
    want = set(brute_groups([r.doc_id for r in rows], fps))
    rows = sorted(near.collect())
    assert sorted(r.doc_id for r in rows) == sorted(want)
    after = sorted(cut.collect())
    texts = brute_cut([r.text for r in rows])
    assert [(r.doc_id, r.text, r.lang, r.source) for r in after] == [(r.doc_id, t, r.lang, r.source) for r, t in zip(rows, texts)]
    assert all(r.n_chars == len(r.text) for r in after)
    pieces = packed.collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in pieces), key=str) == brute_pieces([(r.doc_id, r.text) for r in after])
    assert check(pieces) <= 1.01 * math.ceil(sum(r.length for r in pieces) / 2048) + 1


def test_stages_take_odd_rows(spark, docs):
    long = "the same long passage of words " * 20
    rows = [(1, None), (2, ""), (3, "!!! 123"), (4, "the cat sat on the mat"), (4, "the cat sat on the mat"), (5, "the  cat sat on the mat "),
            (None, "a null id has words too"), (6, long + "one end"), (7, long + "quite another ending of it"), (8, "x y " * 50_000)]
    given = docs(rows, extra=["doc", "k1", "row_id", "p"])
    now = given
    counts = []
    for name, stage in C.STAGES:
        now = C.stored(stage(spark, now, SF), name)
        counts.append(now.count())
        if name != "best_fit_packing":
            assert now.schema == given.schema
    assert counts[0] == 7 and counts[1] == 5 and counts[2] <= 5 and counts[3] == counts[2]


def test_stages_take_empty_tables(spark, docs):
    now = docs([])
    for name, stage in C.STAGES:
        now = C.stored(stage(spark, now, SF), name)
        assert now.count() == 0


def test_run_is_registered(spark):
    import __spark_entry__ as E

    assert E.queries()["pipeline"] is C.run and "pipeline" not in E.oracle_sql()
    assert [n for n, _ in C.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in E.queries() if re.match(r"op\d+_", q)}
