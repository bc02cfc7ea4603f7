import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aeris.llm import decontamination as D

SF = "/root/testdata/sf0.001"


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(texts, items, window=10):
    """(n_words, n_hit, sorted items, longest) per text."""
    out = []
    split = [(str("" if i is None else i), words(t)) for i, t in items]
    for text in texts:
        doc = words(text)
        hit, names, longest = set(), set(), 0
        for name, item in split:
            wide = min(window, len(item))
            starts = {}
            for j in range(len(item) - wide + 1 if item else 0):
                starts.setdefault(tuple(item[j:j + wide]), []).append(j)
            for p in range(len(doc) - wide + 1 if item else 0):
                for j in starts.get(tuple(doc[p:p + wide]), ()):
                    names.add(name)
                    hit.update(range(p, p + wide))
                    n = wide
                    while j + n < len(item) and p + n < len(doc) and item[j + n] == doc[p + n]:
                        n += 1
                    longest = max(longest, n)
        out.append((len(doc), len(hit), sorted(names), longest))
    return out


def frames(spark, docs, texts, items):
    tests = spark.createDataFrame(items, "item_id long, text string") if items else spark.createDataFrame([], "item_id long, text string")
    return docs([(i, t) for i, t in enumerate(texts)], extra=["found", "doc", "n_hit", "item_id"]), tests


def run(spark, docs, texts, items, **kw):
    table, tests = frames(spark, docs, texts, items)
    got = {r.doc.doc_id: r for r in D.contamination(table, tests, **kw).collect()}
    assert len(got) == len(texts) and all(r.doc.n_hit == "x" and r.doc.text == texts[i] for i, r in got.items())
    assert all(sum(b - a for a, b in zip(r.runs[::2], r.runs[1::2])) == r.n_hit and r.contaminated == (r.n_hit > 0) for r in got.values())
    return [(got[i].n_words, got[i].n_hit, got[i]["items"], got[i].longest) for i in range(len(texts))]


def random_case(seed, letters=4, many=60):
    rnd = random.Random(seed)
    vocabulary = ["a", "B", "c9", "É", "日本", "x" * 40][:letters]

    def text(n):
        return "".join(rnd.choice(vocabulary) + rnd.choice([" ", "\n", "--", "_", "\x00"]) for _ in range(n))

    texts = [text(rnd.randint(0, 90)) for _ in range(many)]
    items = [(i, text(rnd.choice([0, 1, 4, 9, 10, 11, 25, 60]))) for i in range(12)]
    items += [(50 + i, " ".join(words(t)[3:30])) for i, t in enumerate(texts[:8])] + [(None, None), (3, items[4][1]), (None, items[5][1])]
    return texts + [None, "", " .. ", texts[0], texts[0]], items


@pytest.mark.parametrize("letters", [2, 3, 6])
def test_against_brute_force(spark, docs, letters):
    texts, items = random_case(letters, letters)
    assert run(spark, docs, texts, items) == brute(texts, items)
    assert run(spark, docs, texts, items, window=3) == brute(texts, items, 3)


def test_blocks_shards_and_parts_give_the_same(spark, docs):
    texts, items = random_case(9, 6)
    texts.append(" ".join(texts[:60]))
    expected = [x[:3] for x in brute(texts, items)]
    assert [x[:3] for x in run(spark, docs, texts, items, block_words=70, shard_words=64)] == expected
    assert run(spark, docs, texts, items, shard_words=1) == brute(texts, items)


def test_texts_without_tests_tables_without_rows(spark, docs):
    assert run(spark, docs, ["a b", None], []) == [(2, 0, [], 0), (0, 0, [], 0)]
    assert run(spark, docs, ["a b"], [(1, None), (2, "!!")]) == [(2, 0, [], 0)]
    assert run(spark, docs, [], [(1, "a b")]) == []


def test_very_long_text_and_frequent_word(spark, docs):
    long = "the " * 1_500_000 + "one two three " + "the " * 10
    texts = [long, "the", "x" * 2_000_000, "One, two; THREE the"]
    items = [(1, "the"), (2, "one two three the the the the the the the the the"), (3, "two three"), (4, "x" * 2_000_000)]
    got = run(spark, docs, texts, items)
    assert got == [(1_500_013, 1_500_013, ["1", "2", "3"], 12), (1, 1, ["1"], 1), (1, 1, ["4"], 1), (4, 3, ["1", "3"], 2)]


def test_affected_documents_go(spark, docs):
    texts, items = random_case(4, 6)
    table, tests = frames(spark, docs, texts, items)
    kept = D.decontaminated(table, tests)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, x in enumerate(brute(texts, items)) if not x[1]]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.integers(1, 20), st.integers(1, 4), st.sampled_from([3, 2**20, 2**40]))
def test_suffix_array_is_sorted(ids, depth, shortest, n_words):
    ids = np.array([*ids, 0])
    sa = D.suffix_array(ids, depth, shortest, n_words).tolist()

    def suffix(p):
        end = p + ids[p:].tolist().index(0)
        return ids[p:min(end, p + depth)].tolist()

    assert sorted(sa) == [p for p in range(len(ids)) if 0 not in ids[p:p + shortest]]
    assert [suffix(p) for p in sa] == sorted(suffix(p) for p in sa)


def test_query_over_whole_tables_against_brute_force(spark):
    read = {n: spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "benchmark")}
    texts = [tuple(r) for r in read["documents"].select("doc_id", "text").collect()]
    expected = brute([t for _, t in texts], [tuple(r) for r in read["benchmark"].select("item_id", "text").collect()])
    got = D.op12_decontaminate(spark, SF)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(
        (d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for (d, _), (n, h, i, _) in zip(texts, expected))
