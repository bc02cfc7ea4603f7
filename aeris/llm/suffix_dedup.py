"""Removal of long byte strings that occur more than once, by prefix doubling over a sparse set of positions.

Plain prefix doubling sorts a row per byte in every round. Here a position is a range of window starts that share an
anchor (the window's gram of least hash, which depends on the window's bytes alone, so equal windows have their anchor
at the same place). A round names every range twice from the ranks of half as long strings at growing offsets:

* ``core``, the bytes that all its windows share: a range whose core is unique has no repeated window and is dropped;
* ``union``, the bytes its windows cover: ranges of equal union, which is past the threshold, are repeated as a whole.

Spark groups and ranks the names; a core with several unions stays open, and only one range for each (core, union)
goes on to the next round, where it is cut into ranges of fewer starts, so that the core grows (64, 193, 200 bytes for
the threshold of 200) until it is the window itself. Every name is built by doubling: rank(2g) of a position is
the pair of rank(g) there and g further on, and rank(length) is the pair of rank(2g) at the two ends.

Texts are read in every round beside the open ranges of their row; what is grouped are names of 64 bits each, held
equal only if both names agree. Groups are reduced with counts, minima and maxima before the shuffle, so a passage that
a third of all rows share is a few rows per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeris.llm.common import row_key, stored, table

THRESHOLD = 200
#: Window starts of a range in the rounds after the first; the last must be 1.
CUTS = (8, 1)
_U = np.uint64
_BYTE = np.random.default_rng(0x5EED).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
_BASE = 0x9E3779B97F4A7C15
_M64 = (1 << 64) - 1
#: Positions of a text that are anchored at once; the low bits of a gram's hash hold the place in it.
_PLACE_BITS = 18
_BLOCK = 1 << _PLACE_BITS
#: Texts (by bytes) whose rows are handed on together.
_FLUSH = 1 << 23


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _pair(a: np.ndarray, b: np.ndarray, salt: int = 0) -> np.ndarray:
    return _mix(_mix(a + _U(salt & _M64)) * _U(_BASE) + b)


def gram_length(threshold: int) -> int:
    """The power of two g with 2g at most the core of the second round and 4g at least the threshold."""
    g = 1
    while 4 * g < threshold:
        g *= 2
    if 2 * g > threshold - CUTS[0] + 1:
        raise ValueError(f"threshold {threshold} lies between the lengths that doubling reaches")
    return g


class Ranks:
    """Names of the strings of one text, by doubling."""

    def __init__(self, raw: bytes, threshold: int):
        self.threshold, self.gram = threshold, gram_length(threshold)
        h = _BYTE[np.frombuffer(raw, dtype=np.uint8)]
        n, power = 1, _BASE
        while n < self.gram:
            h = h[:-n] * _U(power) + h[n:]
            power = power * power & _M64
            n *= 2
        self.g = _mix(h)

    def double(self, at: np.ndarray) -> np.ndarray:
        return _pair(self.g[at], self.g[at + self.gram], 1)

    def string(self, at: np.ndarray, length: int) -> np.ndarray:
        """Rank of the ``length`` (2g to 4g) bytes from ``at``."""
        return _pair(self.double(at), self.double(at + (length - 2 * self.gram)), length)


def anchors(ranks: Ranks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first, last): the window starts from first to last have that anchor. Of equal hashes the leftmost is
    taken. A range also ends where a block of the text ends; ranges cut differently are settled in later rounds."""
    wide = ranks.threshold - ranks.gram + 1
    starts = len(ranks.g) - wide + 1
    out = []
    step = _BLOCK - wide
    for lo in range(0, starts, step):
        hi = min(lo + step, starts)
        v = ranks.g[lo:hi + wide - 1]
        v = (v >> _U(_PLACE_BITS) << _U(_PLACE_BITS)) | np.arange(len(v), dtype=np.uint64)
        n = 1
        while 2 * n <= wide:
            v = np.minimum(v[:-n], v[n:])
            n *= 2
        if wide > n:
            v = np.minimum(v[:hi - lo], v[wide - n:wide - n + hi - lo])
        place = (v & _U(_BLOCK - 1)).astype(np.int64)
        cut = np.flatnonzero(np.diff(place))
        first = np.concatenate([[0], cut + 1])
        last = np.concatenate([cut, [hi - lo - 1]])
        out.append((place[first] + lo, first + lo, last + lo))
    return tuple(np.concatenate(x) for x in zip(*out))


# ``place`` of a range in one long: first start, number of starts less one, bytes from the first start to the anchor.
def _packed(anchor: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return first << 20 | (last - first) << 10 | (anchor - first)


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first = place >> 20
    return first + (place & 1023), first, first + (place >> 10 & 1023)


def first_names(ranks: Ranks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(core, union, place) of every range of a text: its core is named by the anchor's gram."""
    anchor, first, last = anchors(ranks)
    union = _pair(ranks.string(first, ranks.threshold), ranks.string(last, ranks.threshold))
    union = _pair(union, (((anchor - first) << 10) | (last - first)).astype(np.uint64), 2)
    return ranks.g[anchor], union, _packed(anchor, first, last)


def next_names(ranks: Ranks, places: np.ndarray, cut: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for open ranges cut at multiples of ``cut`` starts from their anchor."""
    anchor, first, last = _unpacked(places)
    a, b = (anchor - last) // cut, (anchor - first) // cut
    many = (b - a + 1)
    row = np.repeat(np.arange(len(places)), many)
    step = a[row] + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    anchor = anchor[row]
    whole_first, whole_last = anchor - step * cut - (cut - 1), anchor - step * cut
    lo, hi = np.maximum(first[row], whole_first), np.minimum(last[row], whole_last)
    core = _pair(ranks.string(whole_last, ranks.threshold - cut + 1), ranks.g[anchor], cut)
    core = _pair(core, step.astype(np.uint64), 3)
    union = _pair(ranks.string(lo, ranks.threshold), ranks.string(hi, ranks.threshold))
    union = _pair(union, (((anchor - lo) << 10) | (hi - lo)).astype(np.uint64), 4)
    return core, union, _packed(anchor, lo, hi)


_NAMES = "core long, `union` long, k1 long, k2 long, place long"


def _emit(rows: Iterator[tuple[tuple[int, int], int, tuple]]) -> Iterator[pa.RecordBatch]:
    """Batches of the names of several texts: (row key, bytes of text, (core, union, place))."""
    held, size = [], 0

    def batch():
        keys = np.repeat(np.array([k for k, _ in held], dtype=np.int64), [len(n[0]) for _, n in held], axis=0)
        core, union, place = (np.concatenate(c) for c in zip(*(n for _, n in held)))
        return pa.RecordBatch.from_arrays([pa.array(core.view(np.int64)), pa.array(union.view(np.int64)),
                                           pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(place)],
                                          ["core", "union", "k1", "k2", "place"])

    for key, size_of, names in rows:
        held.append((key, names))
        size += size_of
        if size >= _FLUSH:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _raw(text) -> bytes:
    return text.as_buffer().to_pybytes() if text.is_valid else b""


def settle(names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(settled, open) ranges (k1, k2, place): those repeated as a whole, and one of each union under a shared core
    that has several."""
    # stored, so that both sides of the join are shuffled for it alone and a core that very many rows share is split
    kinds = stored(names.groupBy("core").agg(F.count(F.lit(1)).alias("n"), F.min("union").alias("lo"), F.max("union").alias("hi"))
                   .where("n > 1").select(F.col("core").alias("k"), (F.col("lo") == F.col("hi")).alias("alike")), "cores")
    shared = stored(names.join(kinds, F.col("core") == F.col("k")).select("core", "union", "k1", "k2", "place", "alike"), "shared")
    mixed = shared.where("not alike")
    classes = stored(mixed.groupBy("core", "union").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "place")).alias("one")),
                     "unions")
    twice = classes.where("n > 1").select(F.col("core").alias("c"), F.col("union").alias("u"))
    again = mixed.join(twice, (F.col("core") == F.col("c")) & (F.col("union") == F.col("u")))
    return (shared.where("alike").select("k1", "k2", "place").union(again.select("k1", "k2", "place")),
            classes.select("one.k1", "one.k2", "one.place"))


def _by_row(ranges: DataFrame) -> DataFrame:
    """The ranges of a row as a list, which the row's text bounds however often the row is repeated."""
    return ranges.groupBy("k1", "k2").agg(F.collect_set("place").alias("places")).hint("shuffle_hash")


def repeated_starts(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(k1, k2, place) of ranges of window starts whose string of ``threshold`` bytes occurs more than once."""
    rows = docs.select("text", *row_key())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def named():
            for batch in batches:
                for text, *key in zip(batch.column(0), *(c.to_pylist() for c in batch.columns[1:])):
                    raw = _raw(text)
                    if len(raw) >= threshold:
                        yield key, len(raw), first_names(Ranks(raw, threshold))
        return _emit(named())

    def cutting(cut: int):
        def scan_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def named():
                for batch in batches:
                    for text, places, *key in zip(batch.column(0), batch.column(1), *(c.to_pylist() for c in batch.columns[2:])):
                        raw = _raw(text)
                        yield key, len(raw), next_names(Ranks(raw, threshold), np.sort(places.values.to_numpy()), cut)
            return _emit(named())
        return scan_open

    found, still_open = settle(stored(rows.mapInArrow(scan, _NAMES), "names"))
    for cut in CUTS:
        texts = rows.join(_by_row(still_open), ["k1", "k2"]).select("text", "places", "k1", "k2")
        settled, still_open = settle(stored(texts.mapInArrow(cutting(cut), _NAMES), "names"))
        found = found.union(settled)
    return found


def _spans(places: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [start, end) of bytes that the windows cover."""
    _, first, last = _unpacked(np.sort(places))
    end = np.maximum.accumulate(last + threshold)
    new = np.concatenate([[True], first[1:] > end[:-1]])
    return first[new], end[np.concatenate([new[1:], [True]])]


def _whole_characters(raw: bytes, start: int, end: int) -> tuple[int, int]:
    """The span without a character that it covers only in part."""
    while start < end and start < len(raw) and raw[start] & 0xC0 == 0x80:
        start += 1
    while end > start and end < len(raw) and raw[end] & 0xC0 == 0x80:
        end -= 1
    return start, end


def cut_text(raw: bytes, places: np.ndarray, threshold: int) -> tuple[int, int, str, str]:
    """(bytes removed, spans, digest of the remaining bytes, text without the characters that a span covers wholly)"""
    starts, ends = _spans(places, threshold)
    digest, kept, at, at_text = hashlib.sha256(), [], 0, 0
    for a, b in zip(starts.tolist(), ends.tolist()):
        digest.update(raw[at:a])
        at = b
        a, b = _whole_characters(raw, a, b)
        kept.append(raw[at_text:a])
        at_text = b
    digest.update(raw[at:])
    kept.append(raw[at_text:])
    return int((ends - starts).sum()), len(starts), digest.hexdigest(), b"".join(kept).decode("utf-8")


def remove_repeats(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` as a struct ``doc`` of all their columns, with n_bytes, n_removed, n_spans, kept_sha256
    (digest of the remaining bytes) and kept_text (the text without the characters that lie wholly in a removed span).

    A byte of the UTF-8 text goes if a string of ``threshold`` bytes that covers it also starts anywhere else, in the same
    text or another; both places lose it. Null texts count as empty; texts below the threshold keep all. Rows
    that repeat a text lose all of it. An empty table gives an empty table."""
    info = _by_row(stored(repeated_starts(docs, threshold), "repeats"))
    schema = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"

    @F.arrow_udf(schema)
    def cut(text: pa.Array, places: pa.Array) -> pa.Array:
        out = []
        for t, p in zip(text, places):
            raw = _raw(t)
            if p.is_valid:
                gone, spans, digest, kept = cut_text(raw, p.values.to_numpy(), threshold)
            else:
                gone, spans, digest, kept = 0, 0, hashlib.sha256(raw).hexdigest(), None
            out.append({"n_bytes": len(raw), "n_removed": gone, "n_spans": spans, "kept_sha256": digest, "kept_text": kept})
        return pa.array(out, pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                                        ("kept_sha256", pa.string()), ("kept_text", pa.string())]))

    whole = docs.select(*row_key(), F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    got = whole.join(info, ["k1", "k2"], "left").select("doc", cut("doc.text", "places").alias("cut"))
    return got.select("doc", "cut.n_bytes", "cut.n_removed", "cut.n_spans", "cut.kept_sha256",
                      F.coalesce("cut.kept_text", "doc.text").alias("kept_text"))


def without_repeats(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Every row of ``docs``, with all its columns: text is what remains of it and n_chars (if there is one) its length."""
    cut = remove_repeats(docs, threshold).select("doc", "n_removed", "kept_text")
    new = {"text": F.col("kept_text"),
           "n_chars": F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("doc.n_chars"))
           if "n_chars" in docs.columns else None}
    return cut.select(*[(new[c] if c in new else F.col("doc")[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
