"""Document fingerprints by content-defined chunking.

A gear hash rolls over the UTF-8 bytes; a chunk ends where the hash's top bits are zero, more bits below the normal chunk
size and fewer above it (normalised chunking), so an edit moves only the boundaries beside it. A fingerprint is the set of
chunk digests with the bytes that each accounts for; likeness is the containment of one such set in the other,
weighted by length.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from aeris.llm.common import table

MIN_CHUNK, NORMAL_CHUNK, MAX_CHUNK = 16, 48, 256
STRICT_BITS, LOOSE_BITS = 7, 4
_GEAR = np.random.default_rng(0x6EA2).integers(0, 1 << 32, 256, dtype=np.uint32)
#: Bytes that are hashed at once.
_BLOCK = 1 << 20


def _cut_points(raw: bytes) -> tuple[list[int], list[int]]:
    """Ends (exclusive) at which the strict and the loose mask hold. The hash of a place covers the 32 bytes up to it,
    and is found by doubling the bytes it covers."""
    strict, loose = [], []
    for lo in range(0, len(raw), _BLOCK):
        start = max(0, lo - 31)
        h = _GEAR[np.frombuffer(raw, dtype=np.uint8, count=min(len(raw), lo + _BLOCK) - start, offset=start)]
        for n in (1, 2, 4, 8, 16):
            if len(h) > n:
                h[n:] = h[n:] + (h[:-n] << np.uint32(n))
        h = h[lo - start:]
        near = np.flatnonzero(h < np.uint32(1 << (32 - LOOSE_BITS)))
        loose.append(near + (lo + 1))
        strict.append(near[h[near] < np.uint32(1 << (32 - STRICT_BITS))] + (lo + 1))
    return tuple(np.concatenate(x).tolist() if x else [] for x in (strict, loose))


def chunk_ends(raw: bytes) -> list[int]:
    """End of every chunk."""
    strict, loose = _cut_points(raw)
    ends, at, n = [], 0, len(raw)
    i = j = 0
    while at < n:
        i = bisect_left(strict, at + MIN_CHUNK, i)
        if i < len(strict) and strict[i] < at + NORMAL_CHUNK:
            at = strict[i]
        else:
            j = bisect_left(loose, at + NORMAL_CHUNK, j)
            at = min(loose[j] if j < len(loose) else n, at + MAX_CHUNK, n)
        ends.append(at)
    return ends


def fingerprint(raw: bytes) -> dict[int, int]:
    """{chunk digest: bytes in chunks of that digest}"""
    import xxhash

    digest, found, at = xxhash.xxh3_64_intdigest, {}, 0
    for end in chunk_ends(raw):
        key = digest(raw[at:end])
        found[key] = found.get(key, 0) + end - at
        at = end
    return found


def containment(one: dict[int, int], other: dict[int, int]) -> float:
    """Share of the bytes of the smaller set that the other set holds too; two empty sets are alike."""
    total = min(sum(one.values()), sum(other.values()))
    if not total:
        return float(not one and not other)
    small, large = (one, other) if len(one) <= len(other) else (other, one)
    return sum(min(n, large.get(key, 0)) for key, n in small.items()) / total


def as_text(found: dict[int, int]) -> str:
    """``digest:bytes`` in the order of digests; the empty text's is the empty string."""
    return " ".join(f"{key:016x}:{found[key]}" for key in sorted(found))


def from_text(text: str) -> dict[int, int]:
    return {int(k, 16): int(n) for k, _, n in (x.partition(":") for x in text.split())}


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row of ``docs`` (doc_id, text; other columns are ignored). Null texts count as
    empty; texts are read whole; equal texts have equal fingerprints. An empty table gives an empty table."""
    from aeris.llm.common import map_rows

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs.select("doc_id", "text"), lambda c: {
        "doc_id": c["doc_id"], "fingerprint": [as_text(fingerprint((t or "").encode())) for t in c["text"]]},
        f"doc_id {kind}, fingerprint string")


#: Slots of consecutive ids at most, and sampled ids for each.
MOST_SLOTS, SAMPLED = 100_000, 20


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _slot_of(ids: pa.Array, cuts: np.ndarray) -> np.ndarray:
    """Number of cuts at or below the id; null ids are in the first slot."""
    low = np.iinfo(np.int64).min
    return np.searchsorted(cuts, ids.cast(pa.int64()).fill_null(low).to_numpy(zero_copy_only=False), side="right")


def with_next(docs: DataFrame, slots: int | None = None) -> DataFrame:
    """Rows (doc_id, text, slot, ahead): slots of consecutive doc_ids, each with the first row of the following slot
    (``ahead``; the last slot has the table's first row) after its own, in tasks sorted by slot and place. doc_id is an
    integer; rows of one doc_id are ordered by text, null doc_ids come first.

    There are four slots per shuffle partition of the session, ``MOST_SLOTS`` at most, unless ``slots`` is given. Slots are cut
    at quantiles of a random sample of ``SAMPLED`` ids for each (all ids if there are fewer), which only decides how even they are: every row
    is dealt by the cuts. Sample, cuts and the slots' first ids are all that reaches the driver. Every text is shuffled once (first
    rows twice)."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slots = slots or min(4 * parts, MOST_SLOTS)
    ids = docs.select("doc_id")
    cuts = np.array([], dtype=np.int64)
    if slots > 1:
        known = ids.where("doc_id is not null").select(F.col("doc_id").cast("long"))
        # a random sample is near its expected size; half as many again is never exceeded by chance
        share = min(1.0, slots * SAMPLED / max(1, known.count()))
        sample = np.sort(known.sample(share, seed=3).limit(slots * SAMPLED * 3 // 2).toPandas()["doc_id"].to_numpy(dtype=np.int64))
        if len(sample):
            cuts = np.unique(sample[np.arange(1, slots) * len(sample) // slots])

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            at = _slot_of(column, cuts)
            for slot in np.unique(at):
                mine = column.filter(pa.array(at == slot))
                real = mine.drop_null().cast(pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int64()), pa.array([min(real.to_pylist(), default=None)], pa.int64()),
                                                  pa.array([mine.null_count > 0])], ["slot", "id", "null_id"])

    firsts = sorted((r.slot, None if r.null_id else r.id) for r in
                    ids.mapInArrow(least, "slot long, id long, null_id boolean").groupBy("slot")
                    .agg(F.min("id").alias("id"), F.max("null_id").alias("null_id")).collect())
    ahead = {first: firsts[k - 1][0] for k, (_, first) in enumerate(firsts)}  # the slot that looks ahead to this id
    kind = docs.schema["doc_id"].dataType.simpleString()

    names = ["doc_id", "text", "slot", "ahead"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = pa.array(_slot_of(batch.column(0), cuts), pa.int32())
            looked_at = pa.array([ahead.get(x) for x in batch.column(0).to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, slot, pa.repeat(False, batch.num_rows)], names)
            first = looked_at.is_valid()
            kept = [c.filter(first) for c in (*batch.columns, looked_at)]
            yield pa.RecordBatch.from_arrays([*kept, pa.repeat(True, len(kept[0]))], names)

    dealt = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        deal, f"doc_id {kind}, text string, slot int, ahead boolean")
    return dealt.repartition(parts, "slot").sortWithinPartitions("slot", "ahead", "doc_id", "text")


def compare_with_next(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next (containment of its fingerprint and the edited text's, the
    following document's). A table of one row is followed by itself; an empty table gives an empty table."""
    kind = docs.schema["doc_id"].dataType
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [to_arrow_type(kind), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def compared(one: tuple, two: tuple) -> tuple:
        (doc_id, text, found), (_, following, found_next) = one, two
        changed = edited(text, following)
        raw = changed.encode()
        found_edited = fingerprint(raw)
        return (doc_id, len(text), hashlib.sha256(raw).hexdigest(), as_text(found), as_text(found_edited),
                containment(found, found_edited), containment(found, found_next))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_slot, closed = None, None, False
        for batch in batches:
            out = []
            for doc_id, text, slot, ahead in zip(*(batch.column(c) for c in ("doc_id", "text", "slot", "ahead"))):
                slot, ahead = slot.as_py(), ahead.as_py()
                if slot != held_slot:
                    held, held_slot, closed = None, slot, False
                if closed:
                    continue  # other rows of the id that the next slot starts with
                text = text.as_py()
                now = (doc_id.as_py(), text, fingerprint(text.encode()))
                if held is not None:
                    out.append(compared(held, now))
                held, closed = now, ahead
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, types)], names)

    return with_next(docs).mapInArrow(
        run, f"doc_id {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents"))
