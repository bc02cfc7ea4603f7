"""Documents that hold passages of test items, found with suffix arrays over the training texts.

Every task cuts its documents into shards and sorts the suffixes of a shard's word sequence (a training suffix array). Every
suffix of the test items is then looked up by binary search, word by word for all of them at once: its interval after as many
words as a window has are the places where that window occurs, and the interval is followed further until it is empty, which
gives the longest verbatim match and its length at every place. Affected documents go.

The test items travel to the tasks in blocks of at most ``BLOCK_WORDS`` words and ``BLOCK_BYTES`` bytes, which bounds what is broadcast and what
the driver holds; each block is one pass over the documents, whose texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeris.llm.common import stored, table, words_of

#: Bounds of a block of test items.
BLOCK_WORDS, BLOCK_BYTES = 1 << 20, 1 << 24
#: Words of a shard.
SHARD_WORDS = 1 << 20


# ---- test items ----

@dataclass
class Block:
    """Test texts: ``ids`` are their words, each text ended by 0; ``names`` are the items of each different text."""

    words: dict[bytes, int]
    ids: np.ndarray
    start: np.ndarray
    length: np.ndarray
    names: list[list[str]]
    window: int

    @staticmethod
    def of(texts: dict[tuple[bytes, ...], list[str]], window: int) -> Block:
        words = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}), 1)}
        ids = np.array([i for t in texts for i in (*(words[w] for w in t), 0)], dtype=np.int64)
        length = np.array([len(t) for t in texts], dtype=np.int64)
        return Block(words, ids, np.cumsum(length + 1) - length - 1, length, list(texts.values()), window)

    def suffixes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, text, words of its window) of every suffix that starts with a window."""
        many = np.maximum(self.length - self.window, 0) + 1
        text = np.repeat(np.arange(len(many)), many)
        place = self.start[text] + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return place, text, np.minimum(self.length, self.window)[text]


def blocks(tests: DataFrame, window: int, block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The items of ``tests`` (item_id, text) in blocks, read one by one. Null texts and texts without a word have no window. Items
    that repeat a text share it; a null item_id is the empty string. A text longer than a block goes on in the next, with the words of a
    window less one again."""
    texts: dict[tuple[bytes, ...], list[str]] = {}
    n_words = n_bytes = 0
    for row in tests.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").toLocalIterator():
        words = words_of(row.text or "")
        at = 0
        while at < len(words):
            piece, size = tuple(words[at:at + max(block_words, 2 * window)]), 0
            if piece not in texts:
                size = sum(map(len, piece))
                if texts and (n_words + len(piece) > block_words or n_bytes + size > BLOCK_BYTES):
                    yield Block.of(texts, window)
                    texts, n_words, n_bytes = {}, 0, 0
                n_words, n_bytes = n_words + len(piece), n_bytes + size
            texts.setdefault(piece, []).append(row.item)
            at = at + len(piece) - window + 1 if at + len(piece) < len(words) else len(words)
    if texts:
        yield Block.of(texts, window)


# ---- a shard's suffix array ----

def suffix_array(ids: np.ndarray, depth: int, shortest: int, n_words: int) -> np.ndarray:
    """Places of ``ids`` with at least ``shortest`` words before the next 0, sorted by the words that follow, up to ``depth``.

    As many words as fit are packed into one number; suffixes that agree in one are sorted by the next, so each
    round sorts only what is still tied."""
    zeros = np.flatnonzero(ids == 0)
    places = np.arange(len(ids))
    run = np.append(zeros, len(ids))[np.searchsorted(zeros, places)] - places
    sa = np.flatnonzero(run >= shortest)
    bits = int(n_words).bit_length()
    step = max(1, 63 // bits)
    key, padded = np.zeros(len(ids), dtype=np.int64), np.append(ids, np.zeros(step, dtype=np.int64))
    for j in range(step):
        key = key << bits | padded[j:j + len(ids)]
    # words past a 0 belong to the next document: they only order what the search never tells apart
    sa = sa[np.argsort(key[sa], kind="stable")]
    new = np.ones(len(sa), dtype=bool)
    new[1:] = key[sa[1:]] != key[sa[:-1]]
    for done in range(step, depth, step):
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))
        tied = tied[run[sa[tied]] >= done]  # where a 0 came earlier the whole group has it at the same place
        if not len(tied):
            break
        following, member = key[sa[tied] + done], np.cumsum(new)[tied]
        order = np.lexsort((following, member))
        sa[tied], following, member = sa[tied][order], following[order], member[order]
        new[tied] = np.append(True, (following[1:] != following[:-1]) | (member[1:] != member[:-1]))
    return sa


class Shard:
    """Word sequences of documents (or of parts of one), each ended by 0, with their suffix array."""

    def __init__(self, parts: list[np.ndarray], block: Block):
        self.ids = np.concatenate([x for p in parts for x in (p, np.zeros(1, dtype=np.int64))])
        self.sa = suffix_array(self.ids, int(block.length.max()), int(min(block.window, block.length.min())), len(block.words))

    def _bound(self, lo: np.ndarray, hi: np.ndarray, depth: int, word: np.ndarray, after: bool) -> np.ndarray:
        """First place in [lo, hi) of the array whose word at ``depth`` is not below (``after``: is above) the given one."""
        lo, hi = lo.copy(), hi.copy()
        going = np.flatnonzero(lo < hi)
        while len(going):
            mid = (lo[going] + hi[going]) >> 1
            here = self.ids[self.sa[mid] + depth]
            below = here <= word[going] if after else here < word[going]
            lo[going[below]] = mid[below] + 1
            hi[going[~below]] = mid[~below]
            going = going[lo[going] < hi[going]]
        return lo

    def longer(self, lo: np.ndarray, hi: np.ndarray, depth: int, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The parts of intervals that agree in one more word; none if the word is 0."""
        first = self._bound(lo, hi, depth, word, False)
        return first, np.where(word > 0, self._bound(first, hi, depth, word, True), first)

    def search(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(suffix, text, window, interval) of every test suffix whose window occurs here, as arrays."""
        place, text, window = block.suffixes()
        lo, hi = np.zeros(len(place), dtype=np.int64), np.full(len(place), len(self.sa), dtype=np.int64)
        live = np.arange(len(place))
        for depth in range(block.window):
            still = live[depth < window[live]]
            lo[still], hi[still] = self.longer(lo[still], hi[still], depth, block.ids[place[still] + depth])
            live = live[lo[live] < hi[live]]
        return live, text[live], window[live], np.stack([lo[live], hi[live]], axis=1)

    def longest(self, block: Block, live: np.ndarray, window: np.ndarray, spans: np.ndarray) -> np.ndarray:
        """For every place of the array the words of its longest match with a test suffix whose window it holds (0: none)."""
        place = block.suffixes()[0][live]
        lo, hi, depth = spans[:, 0], spans[:, 1], int(window.min())
        best = np.zeros(len(self.sa), dtype=np.int64)
        while len(place):
            # suffixes with a longer window wait until the search has come as far
            word = block.ids[place + depth]
            wait = window > depth
            first, last = self.longer(lo, hi, depth, word)
            first, last = np.where(wait, lo, first), np.where(wait, hi, last)
            for a, b in ((lo, np.where(first < last, first, hi)), (np.where(first < last, last, hi), hi)):
                ends = ranges(a, b)
                best[ends] = np.maximum(best[ends], depth)
            go = first < last
            place, window, lo, hi, depth = place[go], window[go], first[go], last[go], depth + 1
        return best


def ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All numbers of the intervals [lo, hi), one after the other."""
    many = hi - lo
    return np.arange(many.sum()) + np.repeat(lo - (np.cumsum(many) - many), many)


# ---- documents ----

@dataclass
class Found:
    """What is known of a document: which of its words are hit, the items, the longest match."""

    hit: np.ndarray
    texts: set[int]
    longest: int = 0


def search_shard(parts: list[tuple[int, int, np.ndarray]], n_words: dict[int, int], block: Block, found: dict[int, Found]) -> None:
    """Add what ``block`` finds in ``parts``, (document, first word, word ids) each, to ``found``."""
    shard = Shard([ids for _, _, ids in parts], block)
    live, text, window, spans = shard.search(block)
    if not len(live):
        return
    best = shard.longest(block, live, window, spans)
    part_start = np.cumsum([0, *(len(ids) + 1 for _, _, ids in parts)])
    cover = np.zeros(len(shard.ids) + 1, dtype=np.int64)
    # windows of the same words and length share an interval, whose places are looked at once
    kinds, kind = np.unique(np.column_stack([spans, window]), axis=0, return_inverse=True)
    kind = kind.reshape(-1)
    texts = [np.unique(t) for t in np.split(text[np.argsort(kind, kind="stable")], np.cumsum(np.bincount(kind))[:-1])]
    for (lo, hi, words), of_kind in zip(kinds.tolist(), texts):
        at = shard.sa[lo:hi]
        cover[at] += 1
        cover[at + words] -= 1
        part, first = np.unique(np.searchsorted(part_start, at, side="right") - 1, return_inverse=True)
        top = np.zeros(len(part), dtype=np.int64)
        np.maximum.at(top, first.reshape(-1), best[lo:hi])
        for p, longest in zip(part.tolist(), top.tolist()):
            doc = parts[p][0]
            f = found.setdefault(doc, Found(np.zeros(n_words[doc], dtype=bool), set()))
            f.texts.update(of_kind.tolist())
            f.longest = max(f.longest, longest)
    hit = np.cumsum(cover[:-1]) > 0
    for p in np.unique(np.searchsorted(part_start, np.flatnonzero(hit), side="right") - 1).tolist():
        doc, first, ids = parts[p]
        found[doc].hit[first:first + len(ids)] |= hit[part_start[p]:part_start[p] + len(ids)]


def search_texts(texts: list[str | None], block: Block, shard_words: int = SHARD_WORDS) -> tuple[list[int], dict[int, Found]]:
    """Number of words of each text, and what is found in those that hold a window. A text of more words than a shard is
    read in parts that overlap by the longest test text, so that no match is cut."""
    overlap = int(block.length.max()) - 1
    step = max(shard_words, 2 * overlap + 1)
    n_words: dict[int, int] = {}
    found: dict[int, Found] = {}
    parts, size = [], 0
    for doc, text in enumerate(texts):
        words = words_of(text or "")
        n_words[doc] = len(words)
        ids = np.fromiter(map(block.words.get, words, repeat(0)), dtype=np.int64, count=len(words))
        for at in range(0, max(1, len(ids) - overlap), step):
            if parts and size + len(ids) - at > step:
                search_shard(parts, n_words, block, found)
                parts, size = [], 0
            parts.append((doc, at, ids[at:at + step + overlap]))
            size += len(parts[-1][2])
    if parts:
        search_shard(parts, n_words, block, found)
    return list(n_words.values()), found


_FOUND = "struct<n_words: long, n_hit: long, runs: array<long>, items: array<string>, longest: long>"


def _runs(hit: np.ndarray) -> np.ndarray:
    """Start and end of every run of hit words, flat."""
    return np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))


def contamination(docs: DataFrame, tests: DataFrame, window: int = 10, keep: list[str] | None = None,
                  block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per row of ``docs`` (text; others as they are) with its columns ``keep`` (default all) as a struct ``doc``, and n_words, n_hit,
    runs (start and end of each run of hit words, flat), items (the item_ids, sorted as strings), longest (words of the
    longest verbatim match with an item) and contaminated.

    Words are runs of 0-9, a-z and code points from U+0080 after A-Z are lower-cased. A window is ``window`` consecutive words of an item, or a
    shorter item as a whole; a word of a document inside any occurrence of a window is hit. Null and empty texts have
    no words. Rows that repeat are judged alike, each by itself. Without test items nothing is hit; no documents give an empty table."""
    spark = docs.sparkSession
    keep = docs.columns if keep is None else keep
    none = F.lit(None).cast(_FOUND)
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("doc"), "text", none.alias("found"))
    schema = rows.schema
    known = schema["found"].dataType
    out = T.StructType([schema["doc"], schema["text"], schema["found"]])

    def passes(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_type

            kind = to_arrow_type(known)
            for batch in batches:
                n_words, found = search_texts(batch.column(1).to_pylist(), block.value, shard_words)
                result = []
                for doc, before in enumerate(batch.column(2)):
                    f, old = found.get(doc), before.as_py()
                    if f is None:
                        result.append(old or {"n_words": n_words[doc], "n_hit": 0, "runs": [], "items": [], "longest": 0})
                        continue
                    items = {name for t in f.texts for name in block.value.names[t]}
                    if old:
                        for a, b in zip(old["runs"][::2], old["runs"][1::2]):
                            f.hit[a:b] = True
                        items.update(old["items"])
                        f.longest = max(f.longest, old["longest"])
                    result.append({"n_words": n_words[doc], "n_hit": int(f.hit.sum()), "runs": _runs(f.hit).tolist(),
                                   "items": sorted(items, key=str.encode), "longest": f.longest})
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(result, kind)], ["doc", "text", "found"])
        return run

    block, sent = None, None
    for block in blocks(tests, window, block_words):
        if sent is not None:  # one block at a time is held by the tasks
            rows = stored(rows, "contaminated")
            sent.unpersist()
        sent = spark.sparkContext.broadcast(block)
        rows = rows.mapInArrow(passes(sent), out)
    if block is None:
        sent = spark.sparkContext.broadcast(Block.of({(b"",): []}, window))  # no word is empty: words are counted, none is hit
        rows = rows.mapInArrow(passes(sent), out)
    return rows.select("doc", *(f"found.{c}" for c in known.names), (F.col("found.n_hit") > 0).alias("contaminated"))


def decontaminated(docs: DataFrame, tests: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no window of a test item."""
    return contamination(docs, tests, window).where("not contaminated").select("doc.*")


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10, keep=["doc_id"])
    return got.select("doc.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), "contaminated")


OP12_SQL = r"""
WITH dw AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT item_id, least(len(w), 10) AS l, array_to_string(w[i + 1:i + 10], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS i FROM iw WHERE len(w) > 0)),
lengths AS (
  SELECT DISTINCT l FROM windows),
places AS (
  SELECT doc_id, l, i, array_to_string(w[i + 1:i + l], ' ') AS s
  FROM (SELECT doc_id, w, l, unnest(range(len(w) - l + 1)) AS i FROM dw, lengths WHERE len(w) >= l)),
hits AS (
  SELECT doc_id, p.l, i, item_id FROM places p JOIN windows USING (l, s)),
words AS (
  SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + l)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
