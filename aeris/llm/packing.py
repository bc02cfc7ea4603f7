"""Best-fit packing of documents into token sequences with a grouping genetic algorithm.

Documents become pieces of at most ``capacity`` tokens; a full piece is a sequence by itself. The others are dealt to
blocks of about ``BLOCK`` pieces by a hash of their row. In each block ``ISLANDS`` islands evolve packings of the same
pieces: crossover injects whole well-filled bins of one parent into the other, removes the bins that hold duplicates of
the injected pieces, and puts displaced pieces back by best fit, longest first; mutation opens the least filled bins and
as many others, and fills them anew, each as full as a sum of its pieces can be. An island evolves until ``PATIENCE``
generations bring no gain or no packing can have fewer bins. After each epoch an island's elite moves on to its
neighbour; a block's epochs end with the first that brings it no gain. A block's best packing keeps its well-filled bins; the pieces of
all other bins are dealt anew with those of the other blocks, until they fit one block or a round keeps too few of them
(``SHRINK``), where every bin is kept.

Tasks hold one block at a time, whatever the input; only counts reach the driver.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aeris.llm.common import stored, table
from aeris.llm.tokens import byte_bpe, default_files

CAPACITY = 2048
END = 0
BLOCK = 4096
ISLANDS = 2
POPULATION = 4
#: Generations in a row without a gain after which an island's epoch ends.
PATIENCE = 4
#: Pieces among which a bin's best sum is looked for.
SUMMED = 48
#: A round is the last if more than this share of the pieces of the round before are still open.
SHRINK = 0.75
#: A bin that is at least so full is kept as it is in any round.
WELL_FILLED = 0.999


def pieces(docs: DataFrame, capacity: int = CAPACITY, files: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, row_id) of every document: its ids and id 0; one longer than
    ``capacity`` is cut so that all pieces but the first are full."""
    json_file, rank_file = files or default_files()
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row_id"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = byte_bpe(json_file, rank_file)
        for batch in batches:
            at, out = [], {k: [] for k in ("piece", "start", "length", "ids_crc32")}
            for i, text in enumerate(batch.column("text")):
                ids = np.append(tokenizer.encode(text.as_py() or ""), END).astype("<u4")
                start, stop = 0, len(ids) % capacity or capacity
                while start < len(ids):
                    at.append(i)
                    out["piece"].append(0 if start == 0 else out["piece"][-1] + 1)
                    out["start"].append(start)
                    out["length"].append(stop - start)
                    out["ids_crc32"].append(zlib.crc32(ids[start:stop].tobytes()))
                    start, stop = stop, stop + capacity
            picked = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(picked), *(pa.array(v, pa.int32() if k == "piece" else pa.int64()) for k, v in out.items()),
                 batch.column("row_id").take(picked)], ["doc_id", *out, "row_id"])

    return rows.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, row_id long")


class Room:
    """Open bins by the room they have left; the least that suffices is found on a bit mask."""

    def __init__(self):
        self.mask, self.bins = 0, {}

    def add(self, room: int, bin_: int) -> None:
        self.bins.setdefault(room, []).append(bin_)
        self.mask |= 1 << room

    def take(self, size: int) -> tuple[int, int] | None:
        """(room, bin) of the fullest bin that has ``size`` left, which is taken out."""
        fits = self.mask >> size
        if not fits:
            return None
        room = size + (fits & -fits).bit_length() - 1
        held = self.bins[room]
        bin_ = held.pop()
        if not held:
            self.mask &= ~(1 << room)
        return room, bin_


def best_fit(bins: list[list[int]], fills: list[int], order: list[int], lengths: list[int], capacity: int) -> None:
    """Put the pieces of ``order`` into ``bins``, each where it leaves the least room; new bins as needed."""
    room = Room()
    for b, fill in enumerate(fills):
        if fill < capacity:
            room.add(capacity - fill, b)
    for i in order:
        found = room.take(lengths[i])
        if found:
            left, b = found
            bins[b].append(i)
            fills[b] += lengths[i]
        else:
            left, b = capacity, len(bins)
            bins.append([i])
            fills.append(lengths[i])
        if left > lengths[i]:
            room.add(left - lengths[i], b)


def fitness(fills: list[int], capacity: int) -> float:
    """Mean squared fill of the bins; the more the packing is made of full bins, the higher."""
    return sum((f / capacity) ** 2 for f in fills) / max(1, len(fills))


def crossover(one: list[list[int]], other: list[list[int]], lengths: list[int], capacity: int,
              rnd: np.random.Generator) -> tuple[list[list[int]], list[int]]:
    """Bins and fills of a child: well-filled bins of ``one``, the bins of ``other`` without a duplicate, and best fit."""
    fills = [sum(lengths[i] for i in b) for b in one]
    ranked = sorted(range(len(one)), key=lambda b: -fills[b])
    share = len(ranked) * rnd.uniform(0.3, 0.9)
    chosen = ranked[: max(1, int(share))]
    child = [list(one[b]) for b in chosen]
    placed = {i for b in child for i in b}
    displaced = []
    for b in other:
        if placed.isdisjoint(b):
            child.append(list(b))
        else:
            displaced += [i for i in b if i not in placed]
    # the least filled bins are opened again, so that their pieces can move
    child_fills = [sum(lengths[i] for i in b) for b in child]
    worst = sorted(range(len(child)), key=lambda b: child_fills[b])[: max(1, len(child) // 50)]
    for b in worst:
        if child_fills[b] < capacity:
            displaced += child[b]
            child[b], child_fills[b] = [], 0
    child = [b for b in child if b]
    child_fills = [f for f in child_fills if f]
    displaced.sort(key=lambda i: (-lengths[i], i))
    best_fit(child, child_fills, displaced, lengths, capacity)
    return child, child_fills


def fullest(pieces_: list[int], lengths: list[int], room: int) -> list[int]:
    """The pieces whose lengths make the largest sum within ``room``; sums are bits of a number."""
    reached, limit = [1], (1 << (room + 1)) - 1
    for i in pieces_:
        reached.append((reached[-1] | reached[-1] << lengths[i]) & limit)
    left, out = reached[-1].bit_length() - 1, []
    for k in range(len(pieces_), 0, -1):
        if not reached[k - 1] >> left & 1:
            out.append(pieces_[k - 1])
            left -= lengths[pieces_[k - 1]]
    return out


def mutate(bins: list[list[int]], fills: list[int], lengths: list[int], capacity: int,
           rnd: np.random.Generator) -> tuple[list[list[int]], list[int]]:
    """Bins and fills with the least filled bins and as many others opened: each new bin takes the longest piece left and,
    of ``SUMMED`` others, those that fill it best."""
    ranked = sorted(range(len(bins)), key=lambda b: fills[b])
    opened = set(ranked[: max(2, len(bins) // 50)])
    opened.update(rnd.integers(0, len(bins), len(opened)).tolist())
    out, out_fills = [b for k, b in enumerate(bins) if k not in opened], [f for k, f in enumerate(fills) if k not in opened]
    loose = [i for k in opened for i in bins[k]]
    loose = sorted((loose[k] for k in rnd.permutation(len(loose)).tolist()), key=lambda i: -lengths[i])
    while loose:
        first, rest = loose[0], loose[1:]
        if len(rest) > SUMMED:
            looked = {rest[k] for k in rnd.choice(len(rest), SUMMED, replace=False).tolist()}
            tried = [i for i in rest if i in looked]
        else:
            tried = rest
        members = [first, *fullest(tried, lengths, capacity - lengths[first])]
        out.append(members)
        out_fills.append(sum(lengths[i] for i in members))
        placed = set(members)
        loose = [i for i in rest if i not in placed]
    return out, out_fills


def evolve(lengths: list[int], elites: list[list[int]], seed: int, capacity: int = CAPACITY) -> tuple[list[int], float]:
    """(bin of each piece, fitness) of an island's best packing once ``PATIENCE`` generations have brought no gain, or it
    has as few bins as the sum of lengths allows. ``elites`` are the packings (bin of each piece) that it starts from; the
    rest of the population is best fit over a disturbed order of length. The first member of an island without elites is
    best fit decreasing itself, and a child only replaces a worse member."""
    rnd = np.random.default_rng(seed)
    size = np.array(lengths, dtype=np.float64)
    least = -(-sum(lengths) // capacity)
    people = []
    for bins_of in elites:
        bins: dict[int, list[int]] = {}
        for i, b in enumerate(bins_of):
            bins.setdefault(b, []).append(i)
        packed = list(bins.values())
        people.append((fitness([sum(lengths[i] for i in b) for b in packed], capacity), packed))
    while len(people) < POPULATION:
        noise = 1 + (0.08 * rnd.standard_normal(len(lengths)) if people else 0)
        bins, fills = [], []
        best_fit(bins, fills, np.argsort(-size * noise, kind="stable").tolist(), lengths, capacity)
        people.append((fitness(fills, capacity), bins))
    people.sort(key=lambda p: -p[0])
    stale = 0
    while stale < PATIENCE and all(len(bins) > least for _, bins in people):
        before = people[0][0]
        for k in range(1, len(people)):
            child, fills = mutate(*crossover(people[0][1], people[k][1], lengths, capacity, rnd), lengths, capacity, rnd)
            score = fitness(fills, capacity)
            if score > people[-1][0]:
                people[-1] = (score, child)
                people.sort(key=lambda p: -p[0])
        stale = 0 if people[0][0] > before else stale + 1
    score, best = max(people, key=lambda p: p[0])
    out = [0] * len(lengths)
    for b, members in enumerate(best):
        for i in members:
            out[i] = b
    return out, score


def _islands(states: DataFrame, round_: int, epoch: int, capacity: int) -> DataFrame:
    """One epoch on every island: (block, island, lengths, elites) to (block, island, bins, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                seed = zlib.crc32(f"{row['block']} {row['island']} {round_} {epoch}".encode())
                bins, score = evolve(row["lengths"], row["elites"] or [], seed, capacity)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]], pa.int64()), pa.array([row["island"]], pa.int32()),
                     pa.array([bins], pa.list_(pa.int32())), pa.array([score], pa.float64())],
                    ["block", "island", "bins", "score"])

    return states.mapInArrow(run, "block long, island int, bins array<int>, score double")


def _pack_blocks(dealt: DataFrame, round_: int, capacity: int, blocks: int) -> DataFrame:
    """(block, bins) of the best packing of each block of ``dealt`` (block, idx, length)."""
    # a task for every island, as a block's work is bounded but not small
    tasks = min(blocks * ISLANDS, 4 * dealt.sparkSession.sparkContext.defaultParallelism + blocks * ISLANDS // 16)
    lengths = stored(dealt.groupBy("block").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "length"))),
                                                            lambda x: x["length"]).alias("lengths")), "lengths")
    island = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island")
    homes = lengths.select("block", "lengths", island)
    found, before = None, None
    states = homes.withColumn("elites", F.lit(None).cast("array<array<int>>"))
    for epoch in itertools.count():
        elites = stored(_islands(states.repartition(tasks, "block", "island"), round_, epoch, capacity), "elites")
        found = elites if found is None else found.union(elites)
        best = elites.groupBy("block").agg(F.max("score").alias("score"))
        if before is not None:  # blocks without a gain are done; the others' elites move on
            best = stored(best.join(before, "block").where(F.col("score") > F.col("before")).select("block", "score"), "gained")
            if best.isEmpty():
                break
        before = best.withColumnRenamed("score", "before")
        moved = elites.withColumn("island", (F.col("island") + 1) % ISLANDS)
        near = elites.union(moved).groupBy("block", "island").agg(F.sort_array(F.collect_set("bins")).alias("elites"))
        states = homes.join(near, ["block", "island"]).join(best.select("block"), "block", "left_semi")
    return found.groupBy("block").agg(F.max_by("bins", F.struct("score", -F.col("island"), F.hash("bins"))).alias("bins"))


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (length, at most ``capacity``, and any columns but those added) with sequence_id and offset: the pieces of
    a sequence lie gapless from 0. An empty table gives an empty table."""
    names = parts.columns
    held = stored(parts.withColumn("_row", F.monotonically_increasing_id()), "parts")
    full = held.where(F.col("length") >= capacity).withColumn("sequence_id", F.col("_row"))
    open_ = held.where(F.col("length") < capacity)
    done = full.select(*names, "_row", "sequence_id")
    before = None
    for round_ in itertools.count(1):
        n = open_.count()
        if n == 0:
            break
        blocks = math.ceil(n / BLOCK)
        last = blocks == 1 or (before is not None and n > SHRINK * before)
        before = n
        block = F.pmod(F.xxhash64(F.col("_row"), F.lit(round_)), F.lit(blocks))
        dealt = stored(open_.withColumn("block", block).withColumn(
            "idx", F.row_number().over(Window.partitionBy("block").orderBy(F.desc("length"), "_row"))), "dealt")
        best = _pack_blocks(dealt, round_, capacity, blocks).select("block", F.posexplode("bins").alias("pos", "bin"))
        packed = dealt.join(best.withColumn("idx", F.col("pos") + 1).drop("pos"), ["block", "idx"])
        fill = F.sum("length").over(Window.partitionBy("block", "bin"))
        packed = stored(packed.withColumn("keep", F.lit(last) | (fill >= WELL_FILLED * capacity)), "packed")
        sequence = F.shiftleft(F.lit(round_).cast("long"), 56) + F.shiftleft("block", 16) + F.col("bin")
        done = done.union(packed.where("keep").withColumn("sequence_id", sequence).select(*names, "_row", "sequence_id"))
        open_ = packed.where("not keep").select(*names, "_row")
        if last:
            break
    ahead = Window.partitionBy("sequence_id").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    return done.withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0)).cast("long")).drop("_row")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, files: tuple[str, str] | None = None) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text; other columns are ignored): doc_id, piece, start, length, ids_crc32,
    sequence_id, offset. Null and empty texts are one id; rows that repeat are packed each; whole texts are cut."""
    return pack(pieces(docs, capacity, files).drop("row_id"), capacity)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
