import math
import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aeris.llm import packing as P
from aeris.llm.tokens import byte_bpe, default_files

SF = "/root/testdata/sf0.001"
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("abcthe \n\t'\"0123.,!éßñ<|>#  　你К")) , max_size=60) | st.sampled_from(["a<|endoftext|>b", "  \n x"]))
def test_ids_are_those_of_the_json_file(text):
    assert byte_bpe(*default_files()).encode(text).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_ids_of_long_runs():
    """Runs on which the faster library's pattern gives up, and others of that length."""
    for text in ("a" + " " * 3_000_000 + "b", "a" + "\n" * 1_000_000 + "b", "a" + " \n\t\r" * 300_000 + "b", "a" + "\t" * 999 + "b",
                 "x" * 300_000, "7" * 300_000, "!" * 300_000, ("w" + " " * 1200) * 50):
        assert (byte_bpe(*default_files()).encode(text) == np.array(TOKENIZER.encode(text, add_special_tokens=False).ids)).all()


def test_a_failure_of_the_faster_library_is_made_good(monkeypatch):
    b = byte_bpe(*default_files())

    class Fails:
        def encode_to_numpy(self, *a, **kw):
            raise ValueError("Regex error")

    monkeypatch.setattr(b, "latin", Fails())
    assert b.encode("a plain text").tolist() == TOKENIZER.encode("a plain text", add_special_tokens=False).ids


def test_packing_takes_long_runs(spark, docs):
    rows = [(1, "a" + " " * 1_000_000 + "b"), (2, "a" + "\n" * 500_000 + "b"), (3, "short")]
    got = P.pack_documents(docs(rows)).collect()
    for i, text in rows:
        assert sum(r.length for r in got if r.doc_id == i) == len(TOKENIZER.encode(text, add_special_tokens=False).ids) + 1


def check(rows, capacity=P.CAPACITY):
    """Gapless sequences within the capacity; returns the number of sequences."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by)


def brute_pieces(rows):
    out = []
    for i, t in rows:
        ids = np.array([*TOKENIZER.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        out += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    return sorted(out, key=str)


def test_pieces_and_sequences(docs):
    rows = [(1, None), (2, ""), (3, "hello world"), (3, "hello world"), (None, "x"), (4, "word " * 2047), (5, "word " * 2048),
            (6, "word é 你 " * 9000), (7, "a" * 50_000)]
    got = P.pack_documents(docs(rows, extra=["piece", "length", "offset", "sequence_id"])).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == brute_pieces(rows)
    assert check(got) >= math.ceil(sum(r.length for r in got) / 2048)


def test_empty_table(docs):
    assert P.pack_documents(docs([])).count() == 0


def test_several_blocks_and_rounds(spark):
    rnd = random.Random(2)
    lengths = [rnd.choice([rnd.randrange(1, 2049), rnd.randrange(1, 300), 700]) for _ in range(10_000)]
    got = P.pack(spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "id long, length long").repartition(3)).collect()
    assert sorted((r.id, r.length) for r in got) == list(enumerate(lengths))
    bins, fills = [], []
    P.best_fit(bins, fills, sorted(range(len(lengths)), key=lambda i: -lengths[i]), lengths, 2048)
    assert check(got) <= 1.003 * len(fills) + 1


def test_crossover_keeps_every_piece_once():
    rnd = np.random.default_rng(4)
    lengths = rnd.integers(1, 100, 300).tolist()
    parents = []
    for _ in range(2):
        bins, fills = [], []
        P.best_fit(bins, fills, rnd.permutation(300).tolist(), lengths, 100)
        parents.append(bins)
    for _ in range(10):
        child, fills = P.crossover(*parents, lengths, 100, rnd)
        assert sorted(i for b in child for i in b) == list(range(300))
        assert [sum(lengths[i] for i in b) for b in child] == fills and max(fills) <= 100
    best = max(P.fitness([sum(lengths[i] for i in b) for b in p], 100) for p in parents)
    elites = []
    for bins in parents:
        of = [0] * 300
        for b, members in enumerate(bins):
            for i in members:
                of[i] = b
        elites.append(of)
    assert P.evolve(lengths, elites, 7, 100)[1] >= best  # elites are never lost


def test_best_fit_takes_the_fullest_bin_that_has_room():
    bins, fills = [[0], [1], [2]], [50, 80, 70]
    P.best_fit(bins, fills, [3, 4], [50, 80, 70, 20, 25], 100)
    assert bins == [[0], [1, 3], [2, 4]] and fills == [50, 100, 95]


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = P.op6_packing(spark, SF).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == brute_pieces(rows)
    assert check(got) <= 1.01 * math.ceil(sum(r.length for r in got) / 2048) + 1


def test_fullest_sum_against_all_sums():
    rnd = random.Random(8)
    for _ in range(50):
        lengths = [rnd.randrange(1, 60) for _ in range(10)]
        got = P.fullest(list(range(10)), lengths, 100)
        sums = [sum(n for k, n in enumerate(lengths) if m >> k & 1) for m in range(1 << 10)]
        assert len(set(got)) == len(got) and sum(lengths[i] for i in got) == max(s for s in sums if s <= 100)


def test_search_packs_better_than_best_fit():
    """Lengths of which about three make a bin, where best fit leaves a tenth more bins than the search."""
    rnd = random.Random(3)
    lengths = [rnd.randrange(520, 840) for _ in range(1200)]
    bins, fills = [], []
    P.best_fit(bins, fills, sorted(range(len(lengths)), key=lambda i: -lengths[i]), lengths, 2048)
    got, _ = P.evolve(lengths, [], 1)
    held = {}
    for i, b in enumerate(got):
        held[b] = held.get(b, 0) + lengths[i]
    assert len(got) == len(lengths) and max(held.values()) <= 2048
    assert -(-sum(lengths) // 2048) <= len(held) < 0.95 * len(fills)


def test_epochs_and_rounds_go_on_while_they_gain(spark):
    rnd = random.Random(5)
    lengths = [rnd.randrange(520, 840) for _ in range(5000)]
    got = P.pack(spark.createDataFrame(list(enumerate(lengths)), "id long, length long")).collect()
    bins, fills = [], []
    P.best_fit(bins, fills, sorted(range(len(lengths)), key=lambda i: -lengths[i]), lengths, 2048)
    assert sorted((r.id, r.length) for r in got) == list(enumerate(lengths)) and check(got) < 0.95 * len(fills)
