import hashlib
import random

import pytest

from aeris.llm import fingerprint as P

SF = "/root/testdata/sf0.001"


def brute_ends(raw):
    """The chunk rule, byte by byte."""
    ends, h, hashes = [], 0, []
    for b in raw:
        h = ((h << 1) + int(P._GEAR[b])) & 0xFFFFFFFF
        hashes.append(h)
    at = 0
    for i, h in enumerate(hashes):
        size = i + 1 - at
        bits = P.STRICT_BITS if size < P.NORMAL_CHUNK else P.LOOSE_BITS
        if size >= P.MIN_CHUNK and (h >> (32 - bits) == 0 or size == P.MAX_CHUNK):
            at = i + 1
            ends.append(at)
    return ends + ([len(raw)] if raw and (not ends or ends[-1] < len(raw)) else [])


def test_chunks_against_the_rule(monkeypatch):
    rnd = random.Random(1)
    texts = [b"", b"a", b"a" * 5000, bytes(rnd.randrange(256) for _ in range(20_000)), b"the cat sat on the mat. " * 400]
    want = [brute_ends(t) for t in texts]
    assert [P.chunk_ends(t) for t in texts] == want
    monkeypatch.setattr(P, "_BLOCK", 100)
    assert [P.chunk_ends(t) for t in texts] == want
    sizes = [b - a for e in want for a, b in zip([0, *e], e[:-1])]
    assert min(sizes) >= P.MIN_CHUNK and max(sizes) <= P.MAX_CHUNK


def test_boundaries_move_with_the_text():
    rnd = random.Random(2)
    body = bytes(rnd.randrange(97, 123) for _ in range(20_000))
    one, two = P.fingerprint(body), P.fingerprint(b"something new in front. " + body)
    assert P.containment(one, two) > 0.97
    assert P.containment(P.fingerprint(body[:5000]), one) > 0.95  # a part is contained in the whole
    assert P.containment(one, P.fingerprint(bytes(reversed(body)))) == 0


def test_containment_is_weighted_by_length():
    assert P.containment({1: 30, 2: 10}, {1: 30, 3: 70}) == 0.75
    assert P.containment({}, {}) == 1 and P.containment({}, {1: 5}) == 0
    assert P.containment({1: 60}, {1: 30, 2: 90}) == 0.5
    found = P.fingerprint(b"the quick brown fox " * 50)
    assert P.from_text(P.as_text(found)) == found


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        e = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        a, b, c = (P.fingerprint(x.encode()) for x in (t, e, after))
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), P.as_text(a), P.as_text(b), P.containment(a, b), P.containment(a, c)))
    return sorted(out, key=str)


@pytest.mark.parametrize("slots", [1, 3, 40])
def test_next_document_over_slots(docs, monkeypatch, slots):
    rnd = random.Random(slots)
    rows = [(rnd.randrange(30), "".join(rnd.choice("abc dé") for _ in range(rnd.randrange(300)))) for _ in range(60)]
    rows += [(None, "null id"), (None, None), (7, None), (7, ""), (7, "x" * 100_000), (7, "x" * 100_000), (-5, "neg")]
    plain = P.with_next
    monkeypatch.setattr(P, "with_next", lambda d: plain(d, slots))
    got = P.compare_with_next(docs(rows, extra=["slot", "ahead", "fingerprint"])).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_few_rows(docs):
    assert P.compare_with_next(docs([])).count() == 0
    assert [tuple(r) for r in P.compare_with_next(docs([(3, "one text")])).collect()] == brute([(3, "one text")])
    same = {r.fingerprint for r in P.fingerprints(docs(["a b", "a b", None, ""])).collect()}
    assert len(same) == 2


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in P.op3_fingerprints(spark, SF).collect()), key=str) == brute(rows)
