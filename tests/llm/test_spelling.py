import random
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from aeris.llm import spelling as S

SF = "/root/testdata/sf0.001"


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_variants(vocabulary, ratio=10):
    near = {w: [] for w in vocabulary}
    by_length = {}
    for w in vocabulary:
        by_length.setdefault(len(w), []).append(w)
    for w in vocabulary:
        for x in by_length[len(w)] + by_length.get(len(w) + 1, []):
            if one_apart(w, x):
                near[w].append(x)
                if len(w) != len(x):
                    near[x].append(w)
    form = {}
    for w, n in vocabulary.items():
        best = min(near[w], key=lambda x: (-vocabulary[x], x), default=None)
        form[w] = best if best is not None and vocabulary[best] >= ratio * n else None
    rows = set()
    for w, n in vocabulary.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n, len(near[w]), None if form[w] is None else vocabulary[form[w]]))
    return rows


def run(spark, vocabulary, **kw):
    df = S.variants(spark.createDataFrame(list(vocabulary.items()), "word string, n long").repartition(3), **kw)
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows)) == len(vocabulary)
    return set(rows)


def brute_counts(docs, noise):
    total = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if noise and h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 7:
                total[run] += 1
    return dict(total)


def test_word_counts(spark, docs):
    texts = [None, "", "123 ... \n", "Straße STRASSE straßen ÉCOLES Écoles écoles", "naïveté×facteur÷diviseur", "日本語abcdefgh日本語 ĀbcdefghĀ",
             "x" * 300_000, "a b c " * 50_000, "Abcdefg abcdefg ABCDEFG\x00abcdefg", "écoutez", "\U0001F600abcdefgh\U0001F600"]
    rows = [(i % 7, t) for i, t in enumerate(texts * 5)] + [(None, "abcdefghij nullified")]
    for noise in (None, 1, 3):
        got = {r.word: r.n for r in S.word_counts(docs(rows, extra=["word", "n", "noise"]), 7, noise).collect()}
        assert got == brute_counts(rows, noise)


def test_variants_of_short_alphabets(spark):
    rnd = random.Random(11)
    for letters, longest, many, group in (("ab", 9, 400, 1024), ("ab", 7, 250, 4), ("abc", 6, 500, 30), ("é×z", 12, 300, 8)):
        words = {"".join(rnd.choice(letters) for _ in range(rnd.randint(1, longest))) for _ in range(many)}
        vocabulary = {w: rnd.choice([1, 2, 5, 20, 300, 5000]) for w in words}
        assert run(spark, vocabulary, group=group) == brute_variants(vocabulary)


def test_hot_half_is_halved_until_small(spark):
    """A third of all words share their first half, and one word has very many near words."""
    rnd = random.Random(5)
    words = {"interna" + "".join(rnd.choice("abcdefgh") for _ in range(7)) for _ in range(900)}
    words |= {"hotword" + c + d for c in "abcdefghij" for d in "abcdefghijklmnopqrst"}
    words |= {"".join(rnd.choice("abcdefgh") for _ in range(8)) for _ in range(1500)}
    vocabulary = {w: rnd.choice([2, 3, 40, 600]) for w in words}
    assert run(spark, vocabulary, group=16) == run(spark, vocabulary) == brute_variants(vocabulary)


def test_chain_of_forms_ends_at_its_root(spark):
    word, vocabulary = "a" * 7, {}
    for step in range(9):
        vocabulary[word] = 10 ** step
        word += "bcdefghij"[step]
    rows = run(spark, vocabulary)
    assert {r[2] for r in rows} == {"aaaaaaabcdefghi"} and rows == brute_variants(vocabulary)


def test_ties_long_words_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(S, "LETTERS", 1 << 12)  # windows of long words are halved
    base = "".join(random.Random(3).choice("abcdxyz") for _ in range(20_000))
    vocabulary = {base: 100, base[:5] + base[6:]: 2, base[:-1] + "!": 2, "q" + base: 3, "zeta" * 3: 50, "zetb" + "zeta" * 2: 5,
                  "zeta" * 2 + "zetc": 500, "zeta" * 2 + "zetd": 500, "aaaaaaa": 2, "aaaaaaaa": 20, "aaaaaaaaa": 200}
    assert run(spark, vocabulary) == brute_variants(vocabulary)
    assert run(spark, {}) == set()
    odd = spark.createDataFrame([(None, 3, "x"), ("", 4, "y"), ("abc", 1, "z")], "word string, n long, form string")
    assert [tuple(r) for r in S.variants(odd).collect()] == [("abc", None, "abc", 1, 0, None)]


WORD = st.text("abé", min_size=1, max_size=7)


@settings(max_examples=300, deadline=None)
@given(st.sets(WORD, min_size=1, max_size=12).map(sorted), st.data())
def test_block_finds_each_link_in_one_window(words, data):
    """Over any cut of [0, m) into windows every link is found exactly once."""
    m = data.draw(st.sampled_from(sorted({len(w) for w in words})))
    longer, shorter = [w for w in words if len(w) == m], [w for w in words if len(w) == m - 1]
    ends = sorted({0, m} | set(data.draw(st.lists(st.integers(0, m), max_size=4))))
    got = Counter()
    for a, b in zip(ends, ends[1:]):
        index = [(hash((w[:a], w[b:])), w, 1) for w in longer]
        got.update((q, x) for q, x, _ in S.block_links(a, b, index, [(hash((w[:a], w[b - 1:])), w, 1) for w in shorter]))
    expected = {(q, x) for q in words for x in words if one_apart(q, x) and max(len(q), len(x)) == m}
    assert got == Counter(dict.fromkeys(expected, 1))


def test_query_over_whole_tables_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    vocabulary = {w: n for w, n in brute_counts(docs, 31).items() if n >= 2}
    got = S.op11_spelling(spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == brute_variants(vocabulary)
