"""SimHash near-duplicates with pigeonring filtering.

1. Fingerprints: 64 majority bits over the XXH64 hashes of word shingles, computed where the text is read; only
   (doc_id, fingerprint) leaves the scan, and equal fingerprints become one row before anything is compared.
2. Pigeonring: with budget t and m = 2t + 1 segments on a ring, any two fingerprints that differ in at most t bits
   have a segment from which every chain of l consecutive segments differs in at most l*t/m bits. The first two
   segments of such a chain must be equal, which is the bucket key; the longer chains prune the pairs of a bucket
   before the full Hamming check.
3. A bucket of more than ``PAIRED`` fingerprints is not paired: its members are grouped by every fingerprint that is
   at most one bit away (for t = 2 two members share such a neighbour if and only if they differ in at most two bits),
   and each group links to its smallest member. That costs rows per member, not per pair, and loses no link.
4. Links go through connected components.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeris.llm.common import pick_rows, row_key, stored, table
from aeris.llm.components import connected_components

BITS = 64
#: Fingerprints of a bucket that are compared pair by pair; larger buckets take the exact way of neighbours.
PAIRED = 32
#: Shingles whose bits are unpacked at once.
_BLOCK = 1 << 16


def simhash(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned fingerprint: ASCII lower case, words between ASCII white space, shingles of ``shingle`` words with
    repeats (fewer words: all of them; none: zero), bit set where over half of the hashes set it."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    n = max(1, len(words) - shingle + 1)
    starts = [0, *ends[: n - 1]]
    stops = ends[len(words) - n:]
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, _BLOCK):
        hashes = np.array([digest(joined[a:b - 1], seed) for a, b in
                           zip(starts[at:at + _BLOCK], stops[at:at + _BLOCK])], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, k1, k2, fp) with the fingerprint as a signed long; every row and whole text. k1 and k2 name the row."""

    @F.arrow_udf("long")
    def marked(text: pa.Array) -> pa.Array:
        return pa.array(np.array([simhash(t.as_py(), shingle, seed) for t in text], dtype=np.uint64).view(np.int64))

    return docs.select("doc_id", *row_key(), marked("text").alias("fp"))


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _segments(t: int) -> list[int]:
    """Masks of the 2t + 1 segments."""
    m = 2 * t + 1
    cuts = [BITS * i // m for i in range(m + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]


def _chain(difference: Column, start: int, masks: list[int], t: int) -> Column:
    """Whether every chain from ``start`` stays within its share of the budget."""
    m, mask, ok = len(masks), 0, F.lit(True)
    for length in range(1, m + 1):
        mask |= masks[(start + length - 1) % m]
        ok = ok & (F.bit_count(difference.bitwiseAND(F.lit(_signed(mask)))) <= length * t // m)
    return ok


def fingerprint_links(fps: DataFrame, max_bits: int = 2, paired: int = PAIRED) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp, one row each) that join all that differ in at most
    ``max_bits`` (1 or 2) bits. Pairs of small buckets are all linked; members of a large bucket are linked
    through the smallest member of each shared neighbourhood, which spans the same components."""
    if max_bits not in (1, 2):
        raise ValueError("max_bits must be 1 or 2")
    masks = _segments(max_bits)
    m = len(masks)
    keyed = fps.select("fp", F.explode(F.array([
        F.struct(F.lit(i).alias("start"),
                 F.col("fp").bitwiseAND(F.lit(_signed(masks[i] | masks[(i + 1) % m]))).alias("key"))
        for i in range(m)])).alias("k")).select("fp", "k.start", "k.key")
    sizes = keyed.groupBy("start", "key").count().where("count > 1")
    keyed = stored(keyed.join(sizes, ["start", "key"]), "buckets")

    small = keyed.where(F.col("count") <= paired)
    other = small.select("start", "key", F.col("fp").alias("b"))
    difference = F.col("fp").bitwiseXOR(F.col("b"))
    kept = F.lit(False)
    for i in range(m):
        kept = kept | ((F.col("start") == i) & _chain(difference, i, masks, max_bits))
    pairs = (small.join(other, ["start", "key"]).where(F.col("fp") < F.col("b")).where(kept)
             .where(F.bit_count(difference) <= max_bits).select(F.col("fp").alias("a"), "b"))

    def neighbours(i: int) -> Column:
        held = masks[i] | masks[(i + 1) % m]
        flips = [0, *(1 << k for k in range(BITS) if not held >> k & 1)]
        return F.array([F.col("fp").bitwiseXOR(F.lit(_signed(f))) for f in flips])

    large = keyed.where(F.col("count") > paired)
    spread = None
    for i in range(m):
        one = large.where(F.col("start") == i).select("start", "fp", F.explode(neighbours(i)).alias("near"))
        spread = one if spread is None else spread.union(one)
    # for one bit a member and its neighbour are linked only if the neighbour is itself a fingerprint
    least = spread.groupBy("start", "near").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n"),
                                                F.max(F.col("fp") == F.col("near")).alias("own"))
    least = least.where("n > 1" if max_bits == 2 else "n > 1 and own")
    stars = (spread.join(least, ["start", "near"])
             .select((F.col("a") if max_bits == 2 else F.col("near")).alias("a"), F.col("fp").alias("b")))
    return pairs.union(stars.where("a <> b")).distinct()


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 2, seed: int = 42) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, fp, component_id (smallest
    doc_id of the group), k1, k2 and component, which names the group also where ids are null. Documents with no word share fingerprint zero and are linked like any other. A null doc_id
    stands in a group but never names one unless the group has no other. An empty table gives an empty table."""
    marked = stored(fingerprints(docs, shingle, seed), "simhash")
    classes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    parts = connected_components(fingerprint_links(classes.select("fp"), max_bits))
    named = classes.join(parts, classes["fp"] == parts["node"], "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component"))
    names = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_fp = named.join(names, "component").select(F.col("fp").alias("k"), "component", "component_id")
    return marked.join(by_fp, F.col("fp") == F.col("k"), "left").select(
        "doc_id", "fp", "component_id", "component", "k1", "k2")


def without_near_copies(docs: DataFrame, shingle: int = 3, max_bits: int = 2, seed: int = 42) -> DataFrame:
    """One row of each group, with all its columns: that of the smallest doc_id (nulls last; ties by row name)."""
    groups = simhash_groups(docs, shingle, max_bits, seed)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")).alias("b")
    return pick_rows(docs, stored(groups.groupBy("component").agg(first).select("b.k1", "b.k2"), "kept"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=2, seed=42)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
