import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from aeris.llm import sentencepiece_codec as C
from aeris.llm import token_count as T
from aeris.llm import unigram as U

SF = "/root/testdata/sf0.001"
PATH = U.default_file()
V = U.vocabulary(PATH)
PIECES, KEPT = C.automaton(V), C.segment_ids(V)


@pytest.fixture(scope="module")
def library():
    """The tokenizers library's own unigram model over the same pieces."""
    p = V.processor
    vocab = [(p.id_to_piece(i), p.get_score(i)) for i in range(p.get_piece_size())]
    return Tokenizer(models.Unigram(vocab, unk_id=p.unk_id(), byte_fallback=True))


def brute(normal):
    """Full Viterbi over the whole normal form, node by node."""
    n = len(normal)
    nodes = [(0.0, 0, None)] + [None] * n
    for i in range(n):
        single = False
        for j in range(i + 1, min(n, i + V.longest) + 1):
            e = V.scores.get(normal[i:j])
            if e:
                single |= j == i + 1
                if nodes[j] is None or nodes[i][0] + e[1] > nodes[j][0]:
                    nodes[j] = (nodes[i][0] + e[1], i, e[0])
        if not single and (nodes[i + 1] is None or nodes[i][0] + V.unknown_score > nodes[i + 1][0]):
            nodes[i + 1] = (nodes[i][0] + V.unknown_score, i, None)
    out = []
    while n:
        _, i, e = nodes[n]
        out += [e] if e is not None else V.unknown_ids(normal[i])[::-1]
        n = i
    return out[::-1]


WORDS = "the cat thethe entation Über großé été  \n\t x1999 'tis naïve 你好 مرحبا 🙂 ▁ <s> -- ... internationalization".split(" ")
texts = st.lists(st.sampled_from(WORDS) | st.text("abenstrioul \nñ", max_size=12), max_size=12).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_ids_and_counts_against_brute_force(text):
    want = brute(V.normalize(text))
    assert C.encode(text, V, KEPT).tolist() == want
    assert T.count_tokens(text, PATH) == len(want)
    assert C.decode(want, V) == text.replace("▁", " ")
    normal = V.normalize(text)
    for look in (1, 2, 7):
        assert [i for ids in C.stream_ids(normal, V, PIECES, look) for i in ids] == want


def test_ids_against_the_library(library):
    rnd = random.Random(4)
    for _ in range(300):
        text = " ".join(rnd.choice([x for x in WORDS if x not in ("<s>", "▁")] + ["".join(rnd.choice("abcdeinrst") for _ in range(9))]) for _ in range(20))
        assert C.encode(text, V, KEPT).tolist() == library.encode(V.normalize(text), add_special_tokens=False).ids


def test_long_text_without_spaces_is_committed_as_it_is_read():
    rnd = random.Random(5)
    text = "".join(rnd.choice(["the", "ent", "ing", "x", "q", "ation"]) for _ in range(20_000))
    want = brute(text)
    parts = list(C.stream_ids(text, V, PIECES))
    assert [i for p in parts for i in p] == want and len(parts) > 500 and max(map(len, parts)) < 500
    assert T.count_pieces(text, V, T.automaton(V)) == len(want)


def test_segments_do_not_cut_pieces():
    for piece in V.scores:
        assert "".join(V.segments(piece)) == piece and len(V.segments("▁x" + piece)) <= 1 + len(V.segments(piece))
        assert len(piece) == 1 or len(V.segments(piece)) == 1


def test_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(U, "KEPT_SEGMENTS", 2)
    kept = U.Kept(len)
    assert [kept["a" * k] for k in (1, 2, 3, 50, 1)] == [1, 2, 3, 50, 1] and len(kept) <= 2


def test_edge_rows(spark, docs):
    rows = [(1, None), (2, ""), (3, "same text"), (3, "same text"), (None, "x"), (4, "a" * 100_000), (5, "word " * 30_000), (6, "\n")]
    df = docs(rows, extra=["ids", "n_tokens"])
    got = C.decode_ids(C.encode_texts(df)).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    counts = sorted(((r.doc_id, r.n_tokens) for r in T.token_counts(df).collect()), key=str)
    assert counts == sorted(((r.doc_id, len(r.ids)) for r in got), key=str)
    assert C.decode_ids(C.encode_texts(docs([]))).count() == 0 and T.token_counts(docs([])).count() == 0


def test_queries_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    short = {r.doc_id: brute(V.normalize(r.text)) for r in rows if len(r.text) < 3000}
    got = {r.doc_id: r for r in C.op5_sentencepiece(spark, SF).collect()}
    assert all(got[i].ids == ids for i, ids in short.items())
    assert all(got[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest() for r in rows)
    assert {r.doc_id: r.n_tokens for r in T.op8_token_count(spark, SF).collect()} == {i: r.n_ids for i, r in got.items()}


def test_id_lists_are_those_of_arrow():
    """Nulls, empty lists, and a slice of a batch; ids beyond the slice are not converted."""
    import pyarrow as pa

    whole = pa.array([[1], [2, 3], None, [], [4, 5, 6], None, [7]], pa.list_(pa.int32()))
    for at in range(8):
        for n in range(8 - at):
            assert list(C.id_lists(whole.slice(at, n))) == whole.slice(at, n).to_pylist()
