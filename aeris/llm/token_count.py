"""Token counts without tokens: a Viterbi search that carries the best score and the number of its pieces.

An Aho-Corasick automaton over the vocabulary enumerates every piece that ends at a place, longest first; of the paths
into the place only the best score and its count are kept, in the tokenizer's order of ties.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from aeris.llm.common import map_rows, table
from aeris.llm.unigram import Kept, Vocabulary, default_file, vocabulary


def automaton(v: Vocabulary):
    import ahocorasick

    found = ahocorasick.Automaton()
    for piece, (_, score) in v.scores.items():
        found.add_word(piece, (len(piece), score))
    found.make_automaton()
    return found


def count_pieces(text: str, v: Vocabulary, pieces) -> int:
    """Pieces of the best segmentation of a normal form. Scores and counts are kept for as many places as the longest
    piece spans."""
    size = v.longest + 1
    scores, counts = [0.0] * size, [0] * size  # of the place k at k % size
    unknown, n_bytes = v.unknown_score, len(v.byte_ids)

    def close(place: int, best: float | None, count: int, single: bool) -> None:
        """All pieces that end at the place are known; a character without a piece comes last, as it starts last."""
        if not single:
            score = scores[(place - 1) % size] + unknown
            if best is None or score > best:
                best = score
                count = counts[(place - 1) % size] + (len(text[place - 1].encode()) if n_bytes else 1)
        scores[place % size], counts[place % size] = best, count

    place, best, count, single = 1, None, 0, False
    for end, (length, score) in pieces.iter(text):
        end += 1
        while place < end:
            close(place, best, count, single)
            place, best, count, single = place + 1, None, 0, False
        start = (end - length) % size
        score += scores[start]
        if best is None or score > best:
            best, count = score, counts[start] + 1
        single = single or length == 1
    while place <= len(text):
        close(place, best, count, single)
        place, best, count, single = place + 1, None, 0, False
    return counts[len(text) % size]


@lru_cache(maxsize=4)
def _kept(path: str) -> Kept:
    v = vocabulary(path)
    pieces = automaton(v)
    return Kept(lambda s: count_pieces(s, v, pieces))


def count_tokens(text: str | None, path: str) -> int:
    """Tokens of a text; its segments between places that no piece spans are counted by themselves."""
    v, kept = vocabulary(path), _kept(path)
    return sum(map(kept.__getitem__, v.segments(v.normalize(text))))


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) of every row of ``docs`` (doc_id, text; other columns are ignored). Null and empty texts have
    none; texts are read whole. An empty table gives an empty table."""
    path = path or default_file()
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs.select("doc_id", "text"), lambda c: {
        "doc_id": c["doc_id"], "n_tokens": [count_tokens(t, path) for t in c["text"]]}, f"doc_id {kind}, n_tokens long")


def op8_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
