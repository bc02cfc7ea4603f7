"""SentencePiece encoding as a streaming Viterbi search, and decoding.

The search reads a text once; an automaton over the vocabulary names the pieces that end at each place. It holds the nodes that
a piece to come can start from, a window of the longest piece, and behind them the backpointers since the last commit. Whenever
the paths of all surviving nodes run through one boundary, the ids up to it are final and handed out, and what lies before it
is forgotten.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeris.llm.common import table
from aeris.llm.unigram import SPACE, Kept, Vocabulary, default_file, vocabulary

#: Places between two looks for a common boundary.
LOOK = 64


def automaton(v: Vocabulary):
    """Automaton that finds the pieces of the vocabulary: (length, score, id) each, at a place the longest first."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for piece, (i, score) in v.scores.items():
        found.add_word(piece, (len(piece), score, i))
    found.make_automaton()
    return found


def stream_ids(text: str, v: Vocabulary, pieces, look: int = LOOK) -> Iterator[list[int]]:
    """Final ids of a normal form, in the order and at the time that they are certain."""
    n, longest, unknown = len(text), v.longest, v.unknown_score
    base = 0  # all before it is committed; the lists start there
    best, back, ids = [0.0], [0], [-1]  # of every closed place: score, start of its last piece (from base), its id or -1

    def committed(upto: int) -> list[int]:
        out: list[int] = []
        at = upto
        while at > 0:
            if ids[at] >= 0:
                out.append(ids[at])
            else:
                out += reversed(v.unknown_ids(text[base + at - 1]))
            at = back[at]
        out.reverse()
        return out

    found = pieces.iter(text)
    end, (length, score, piece) = next(found, (n, (0, 0.0, -1)))
    for place in range(1, n + 1):
        top, start, last, single = None, 0, -1, False
        while end < place:  # the automaton counts from the last character, so these end here; an earlier start comes first and stays
            total = best[place - length - base] + score
            if top is None or total > top:
                top, start, last = total, place - length - base, piece
            single = single or length == 1
            end, (length, score, piece) = next(found, (n, (0, 0.0, -1)))
        if not single:  # a character without a piece starts last
            total = best[-1] + unknown
            if top is None or total > top:
                top, start, last = total, place - 1 - base, -1
        best.append(top)
        back.append(start)
        ids.append(last)
        if place - base > look and place % look == 0:
            # a path of the whole text runs through one of the places that a piece to come can start from
            nodes = set(range(max(0, place - longest + 1 - base), place + 1 - base))
            while len(nodes) > 1:
                late = max(nodes)
                nodes.remove(late)
                nodes.add(back[late])
            upto = nodes.pop()
            if upto > 0:
                yield committed(upto)
                # scores from here on count from the boundary, which changes no comparison
                zero = best[upto]
                best = [s - zero for s in best[upto:]]
                back = [b - upto for b in back[upto:]]
                ids = ids[upto:]
                base += upto
    if n > base:
        yield committed(n - base)


def window_ids(text: str, pieces) -> list[int]:
    """Ids of a normal form that is one window of the search, and whose characters all are pieces: the same search, with nothing to commit
    before the end and no place that only an unknown character reaches."""
    n = len(text)
    best = [0.0] + [float("-inf")] * n
    last: list = [None] * (n + 1)  # length and id of the last piece into a place
    for end, entry in pieces.iter(text):
        end += 1
        total = best[end - entry[0]] + entry[1]
        if total > best[end]:
            best[end], last[end] = total, entry
    out = []
    while n:
        out.append(last[n][2])
        n -= last[n][0]
    out.reverse()
    return out


def segment_ids(v: Vocabulary) -> Kept:
    """Ids by segment, as the bytes of 32-bit numbers."""
    pieces = automaton(v)

    def compute(segment: str) -> bytes:
        if len(segment) <= LOOK and v.singles.issuperset(segment):
            return array("i", window_ids(segment, pieces)).tobytes()
        return array("i", [i for ids in stream_ids(segment, v, pieces) for i in ids]).tobytes()

    return Kept(compute)


def encode(text: str | None, v: Vocabulary, kept: Kept | None = None) -> array:
    """Ids of a text. Segments between places that no piece spans are encoded by themselves, as every path meets
    there."""
    kept = segment_ids(v) if kept is None else kept
    return array("i", b"".join(map(kept.__getitem__, v.segments(v.normalize(text)))))


def decode(ids: list[int], v: Vocabulary) -> str:
    """Text of ids: byte pieces are joined to characters, invalid bytes are replaced, space marks are spaces, and the
    mark before the text is dropped."""
    text = b"".join(map(v.raw.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
    return text[1:] if text[:1] == " " else text


@lru_cache(maxsize=4)
def _kept(path: str) -> Kept:
    return segment_ids(vocabulary(path))


def encode_texts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text; other columns are ignored). Null and empty texts have no
    id; texts are read whole. An empty table gives an empty table."""
    path = path or default_file()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, kept = vocabulary(path), _kept(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                batch = whole.slice(at, 128)
                rows = [encode(text.as_py(), v, kept) for text in batch.column(1)]
                ends = np.cumsum([0, *map(len, rows)])
                flat = np.frombuffer(b"".join(rows), dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def id_lists(column: pa.ListArray) -> Iterator[list[int] | None]:
    """Each row's ids, NULL as None. Arrow's own lists make an object of every id on the way, which costs more than decoding."""
    flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for start, end, some in zip(ends, ends[1:], column.is_valid().to_pylist()):
        yield flat[start:end].tolist() if some else None


def decode_ids(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``rows`` (doc_id, ids) with their text. Null ids give a null text."""
    path = path or default_file()
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                batch = whole.slice(at, 128)
                texts = [None if x is None else decode(x, v) for x in id_lists(batch.column(1))]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the digest of the text that they decode to."""
    read = decode_ids(encode_texts(table(spark, sf_dir, "documents")))
    return read.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
