import random
import re

import xxhash

from aeris.llm import simhash as S

SF = "/root/testdata/sf0.001"


def brute_fp(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(ids, fps, bits=2):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                parent[find(i)] = find(j)
    first = {}
    for i, d in enumerate(ids):
        first[find(i)] = min(first.get(find(i), d), d)
    return [first[find(i)] for i in range(len(ids))]


def test_fingerprint_against_brute_force():
    texts = [None, "", " \t\n", "one", "One two", "a b c", "É a B c d a b c", "a b c d", "x\x1cy z w", "w " * 70_000,
             "ẞ K K", "q" * 100_000]
    assert [S.simhash(t) for t in texts] == [brute_fp(t) for t in texts]


def links_as_groups(spark, fps, bits, paired):
    rows = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    df = S.fingerprint_links(spark.createDataFrame(rows, "fp long").repartition(3), bits, paired)
    pairs = [(a % (1 << 64), b % (1 << 64)) for a, b in df.collect()]
    assert all(bin(a ^ b).count("1") <= bits for a, b in pairs)
    label = {x: x for x in fps}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(label[a], label[b])
            changed |= (label[a], label[b]) != (m, m)
            label[a] = label[b] = m
    return [label[x] for x in fps]


def test_links_small_and_large_buckets(spark):
    rnd = random.Random(5)
    fps = {rnd.getrandbits(64) for _ in range(60)}
    for base in list(fps)[:10]:
        for _ in range(14):
            base ^= (1 << rnd.randrange(64)) | (1 << rnd.randrange(64))
            fps.add(base)
    fps |= {(1 << b) - 1 for b in range(0, 64, 3)} | {0, 1, 2, (1 << 64) - 1}
    fps = sorted(fps)
    for bits in (1, 2):
        want = brute_groups(fps, fps, bits)
        for paired in (1, 4, 1000):
            assert links_as_groups(spark, fps, bits, paired) == want, (bits, paired)


def test_groups_edge_rows(spark, docs):
    rows = [(5, None), (3, ""), (9, " "), (1, "alpha beta gamma"), (2, "ALPHA beta  gamma"), (2, "ALPHA beta  gamma"),
            (None, "alpha beta gamma"), (8, "lone")]
    got = {(r.doc_id, r.component_id) for r in S.simhash_groups(docs(rows, extra=["fp", "component_id"])).collect()}
    assert got == {(5, 3), (3, 3), (9, 3), (1, 1), (2, 1), (None, 1), (8, 8)}
    assert S.simhash_groups(docs([])).count() == 0


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    fps = [brute_fp(r.text) for r in rows]
    want = sorted((r.doc_id, f"{f:016x}", c) for r, f, c in zip(rows, fps, brute_groups([r.doc_id for r in rows], fps)))
    assert sorted(tuple(r) for r in S.op7_simhash(spark, SF).collect()) == want
