import hashlib
import random

import numpy as np
import pytest

from aeris.llm import suffix_dedup as S

SF = "/root/testdata/sf0.001"


def brute(texts, threshold):
    """{index: (n_bytes, n_removed, n_spans, sha of the rest)}"""
    raws = [(t or "").encode() for t in texts]
    seen = {}
    for raw in raws:
        for i in range(len(raw) - threshold + 1):
            w = raw[i:i + threshold]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for raw in raws:
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for i in range(len(raw) - threshold + 1):
            if seen[raw[i:i + threshold]] > 1:
                gone[i:i + threshold] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def compare(docs, texts, threshold):
    df = docs(list(enumerate(texts)), extra=["place", "core", "k1", "doc"])
    got = sorted((r.doc.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.remove_repeats(df, threshold).collect())
    assert got == [(i, *w) for i, w in enumerate(brute(texts, threshold))]


def passages(rnd, n, letters="abcdefgh é"):
    return "".join(rnd.choice(letters) for _ in range(n))


@pytest.mark.parametrize("threshold", [24, 100, 200])
def test_against_brute_force(docs, threshold):
    rnd = random.Random(threshold)
    common = [passages(rnd, rnd.randrange(threshold - 3, 3 * threshold)) for _ in range(6)]
    texts = [None, "", "x", "a" * (3 * threshold), "ab" * threshold + "b" * threshold]
    for _ in range(40):
        parts = []
        for _ in range(rnd.randrange(1, 6)):
            c = rnd.choice(common)
            lo = rnd.randrange(0, 40)
            parts.append(rnd.choice([c, c[lo:], c[:len(c) - lo], passages(rnd, 150), passages(rnd, 5)]))
        texts.append("".join(parts))
    texts += [texts[-1], texts[-1], texts[-2] + "!", "?" + texts[-3], common[0][:threshold - 12], common[1]]
    compare(docs, texts, threshold)


def test_long_texts_over_several_blocks(docs, monkeypatch):
    monkeypatch.setattr(S, "_BLOCK", 1 << 9)
    monkeypatch.setattr(S, "_PLACE_BITS", 9)
    rnd = random.Random(3)
    a, b = passages(rnd, 3000), passages(rnd, 700)
    texts = [a + b, b[100:] + passages(rnd, 900) + a[1000:1900], passages(rnd, 2500)]
    want = brute(texts, 200)
    raws = [t.encode() for t in texts]
    df = docs(texts)
    assert want[0][1] > 900 and want[2][1] == 0
    # the executors don't see the patched blocks, so names are settled here
    rows = [(i, *map(int, x)) for i, raw in enumerate(raws) for x in zip(*S.first_names(S.Ranks(raw, 200)))]
    for cut in (*S.CUTS, None):
        cores, unions = {}, {}
        for i, c, u, p in rows:
            cores.setdefault(c, set()).add(u)
            unions.setdefault((c, u), []).append((i, p))
        settled = [(i, p) for k, v in unions.items() if len(v) > 1 for i, p in v]
        if cut == S.CUTS[0]:
            done = []
        done += settled
        open_ = [v[0] for (c, u), v in unions.items() if len(cores[c]) > 1]
        if cut is None:
            break
        rows = []
        for i in range(3):
            places = np.array(sorted(p for j, p in open_ if j == i), dtype=np.int64)
            if len(places):
                rows += [(i, *map(int, x)) for x in zip(*S.next_names(S.Ranks(raws[i], 200), places, cut))]
    for i, raw in enumerate(raws):
        places = np.array([p for j, p in done if j == i], dtype=np.int64)
        removed = sum((e - s).sum() for s, e in [S._spans(places, 200)]) if len(places) else 0
        assert removed == want[i][1]
    compare(docs, texts, 200)


def test_kept_text_has_whole_characters(docs):
    shared = "é" * 150
    got = {r.doc.doc_id: r.kept_text for r in S.remove_repeats(docs(["a" + shared + "xyz", "bc" + shared[1:] + "q", "none", None])).collect()}
    assert got[0].startswith("a") and got[0].endswith("xyz") and got[1].startswith("bc") and got[1].endswith("q")
    assert set(got[0]) <= set("aéxyz") and got[2] == "none" and got[3] is None


def test_repeated_rows_and_null_ids(docs):
    long = "".join(chr(97 + i * i % 23) for i in range(300)) + "x"
    rows = [(1, long), (1, long), (None, long + "tail"), (None, "other " * 5), (2, None)]
    got = sorted((str(r.doc.doc_id), r.n_removed, r.kept_text) for r in S.remove_repeats(docs(rows)).collect())
    assert got == [("1", 301, ""), ("1", 301, ""), ("2", 0, None), ("None", 0, "other " * 5), ("None", 301, "tail")]


def test_empty_tables(docs):
    assert S.remove_repeats(docs([])).count() == 0
    assert [r.n_removed for r in S.remove_repeats(docs([None, "", "short"])).collect()] == [0, 0, 0]


def test_threshold_that_doubling_cannot_reach():
    with pytest.raises(ValueError):
        S.gram_length(130)


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    want = sorted((r.doc_id, *b) for r, b in zip(rows, brute([r.text for r in rows], 200)))
    assert sorted(tuple(r) for r in S.op9_suffix_dedup(spark, SF).collect()) == want
