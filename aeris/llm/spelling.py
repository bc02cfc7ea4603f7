"""Spelling variants: words one code point apart, and the frequent form that each of them stands for.

The vocabulary is searched through a bit-sliced position index: for a position and a letter, one bitset over a block of
words, bit i set if word i has that letter there. A query word runs through the positions and updates, with a few word-wide
operations for all words of the block at once, the set without an error and the sets with one: *replaced* (same
position) and *inserted* (the block's word is one longer, so its letters are read one position further on).

The index is dealt out by windows. If two words are one code point apart, the first place where they differ lies in
exactly one window [a, b) of the longer word, and they agree before a and after b: that text is the key of a group, and
the index of a group covers the window's positions alone. At first a word has two windows, its halves. A group of more
rows than ``GROUP`` (a prefix that very many words share) is not split at random but dealt by halves of its window, until
it is small or its window is one letter, where only words that differ in that letter meet. So no group is larger
than a bound or the alphabet, nothing is compared with everything, and every link is found in exactly one group.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeris.llm.common import stored, table

#: Rows (words) of a group, and letters in the windows of all its rows, above which its window is halved.
GROUP, LETTERS = 1024, 1 << 22
#: Index words that a block gathers from small groups before it is searched, and rows held for it at most besides one group.
BLOCK, HELD = 512, 4096
#: Distinct words that a task holds while it counts.
COUNTED = 1 << 18
#: Letters after Latin-1 encoding and lower-casing of A-Z: a-z and C0-FF (fixed value); every other byte parts words.
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


# ---- vocabulary ----

def noised(run: bytes, seed: int, noise: int) -> bytes:
    """The run (Latin-1), or the run without its code point h % length if ``noise`` divides h, its hash."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % noise:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, min_length: int = 7, noise: int | None = None) -> DataFrame:
    """(word, n) over all texts of ``docs`` (doc_id, text): maximal runs of A-Z, a-z and U+00C0-U+00FF, A-Z lower-cased, of
    at least ``min_length`` code points. With ``noise`` one of so many (document, run) pairs loses a letter, chosen by the crc32 of
    "<doc_id>:<run>" (a null doc_id is the empty string), before the length is judged. Null texts have no words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def batch() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(total.values(), pa.int64())], ["word", "n"])

        for rows in batches:
            for doc_id, text in zip(rows.column(0), rows.column(1)):
                if not text.is_valid:
                    continue
                # every code point beyond Latin-1 becomes one separator, so a byte is a code point
                runs = Counter(text.as_py().encode("latin-1", "replace").lower().translate(_LETTERS).split())
                seed = zlib.crc32(f"{doc_id.as_py() if doc_id.is_valid else ''}:".encode())
                for run, k in runs.items():
                    if len(run) >= min_length:
                        if noise:
                            run = noised(run, seed, noise)
                            if len(run) < min_length:
                                continue
                        total[run] += k
                if len(total) >= COUNTED:
                    yield batch()
                    total.clear()
        if total:
            yield batch()

    return docs.select("doc_id", "text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# ---- index and search of a block ----

class Slice:
    """The index at one position: a bitset over the block's words for each letter that stands there."""

    def __init__(self, column: np.ndarray):
        self.letters, kind = np.unique(column, return_inverse=True)
        words = np.zeros((len(self.letters) + 1, -(-len(column) // 64) * 64), dtype=bool)
        words[kind, np.arange(len(column))] = True
        self.bits = np.packbits(words, axis=1, bitorder="little").view(np.uint64)

    def of(self, letters: np.ndarray) -> np.ndarray:
        """One bitset per letter; the last row, which is empty, for a letter that no word has here."""
        at = np.minimum(np.searchsorted(self.letters, letters), len(self.letters) - 1)
        return self.bits[np.where(self.letters[at] == letters, at, len(self.letters))]


def replaced(slices: list[Slice], start: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Bitsets of the words that differ from each query in exactly one letter of the window. ``start`` holds the words of the
    query's group, ``queries`` the letters of its window."""
    none, one = start, np.zeros_like(start)
    for p, s in enumerate(slices):
        has = s.of(queries[:, p])
        one = (one & has) | (none & ~has)
        none = none & has
    return one


def inserted(slices: list[Slice], start: np.ndarray, queries: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Bitsets of the words that have one letter more than the query, the first letter that differs being in the window.
    ``queries`` are the letters of the window but one, ``after`` the query's next letter (-1: none). Where that letter too
    is the word's, the two differ first beyond the window, and the next window has the link."""
    none, one = start, np.zeros_like(start)
    for p in range(len(slices) - 1):
        letter = queries[:, p]
        one = (one | none) & slices[p + 1].of(letter)
        none = none & slices[p].of(letter)
    return (one | none) & ~(none & slices[-1].of(after))


def _pairs(bits: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    return np.nonzero(np.unpackbits(bits.view(np.uint8), axis=1, bitorder="little", count=words))


def _points(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row for each."""
    return np.array(words, dtype=np.str_).view(np.uint32).reshape(len(words), -1).astype(np.int64)


def block_links(a: int, b: int, index: list[tuple], shorter: list[tuple]) -> Iterator[tuple[str, str, int]]:
    """(word, near word, its n) of the groups of a block in both directions. ``index`` and ``shorter`` are (key, word, n) of the words of
    one length and of those one shorter, all with the window [a, b)."""
    words = _points([w for _, w, _ in index])
    slices = [Slice(words[:, p]) for p in range(a, b)]
    groups = Slice(np.array([k for k, _, _ in index]))

    def same(q: str, x: str) -> bool:  # a key is a hash: what lies outside the window is compared
        return q[:a] == x[:a] and q[len(q) - (len(x) - b):] == x[b:]

    found = replaced(slices, groups.of(np.array([k for k, _, _ in index])), words[:, a:b])
    for q, x in zip(*_pairs(found, len(index))):
        if same(index[q][1], index[x][1]):
            yield index[q][1], index[x][1], index[x][2]
    if shorter:
        points = _points([w for _, w, _ in shorter])
        after = points[:, b - 1] if b - 1 < points.shape[1] else np.full(len(shorter), -1)
        found = inserted(slices, groups.of(np.array([k for k, _, _ in shorter])), points[:, a:b - 1], after)
        for q, x in zip(*_pairs(found, len(index))):
            if same(shorter[q][1], index[x][1]):
                yield shorter[q][1], index[x][1], index[x][2]
                yield index[x][1], shorter[q][1], shorter[q][2]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of rows (m, a, b, key, short, word, n) that come sorted by the first five."""
    window, key, index, shorter, links = None, None, [], [], []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.string()), pa.array([x[1] for x in links], pa.string()),
                                           pa.array([x[2] for x in links], pa.int64())], ["word", "near", "near_n"])

    def search() -> None:
        if index:
            links.extend(block_links(*window[1:], index, shorter))
        index.clear()
        shorter.clear()

    for rows in batches:
        for m, a, b, k, short, word, n in zip(*(c.to_pylist() for c in rows.columns)):
            if (m, a, b) != window or k != key and (len(index) >= BLOCK or len(index) + len(shorter) >= HELD
                                                    or (len(index) + len(shorter)) * (b - a) >= LETTERS):
                search()
                window = (m, a, b)
            key = k
            (shorter if short else index).append((k, word, n))
        if len(links) >= HELD:
            yield batch()
            links.clear()
    search()
    if links:
        yield batch()


# ---- groups ----

def _key() -> Column:
    """Hash of the window and of the text outside it; a word one shorter than m lacks a letter of the window."""
    tail = F.col("b") + F.when(F.col("short"), 0).otherwise(1)
    return F.xxhash64("m", "a", "b", F.substr("word", F.lit(1), F.col("a")), F.substr("word", tail))


def _windows(first: DataFrame) -> DataFrame:
    """Rows of every word as one of the index (m is its length) and as one a letter short (m is one more), in two windows each."""
    m, half = F.length("word"), lambda x: F.floor(x / 2).cast("int")

    def rows(m: Column, short: bool) -> list[Column]:
        return [F.struct(m.alias("m"), F.lit(0).alias("a"), half(m).alias("b"), F.lit(short).alias("short")),
                F.struct(m.alias("m"), half(m).alias("a"), m.alias("b"), F.lit(short).alias("short"))]

    return (first.select("word", "n", F.explode(F.array(*rows(m, False), *rows(m + 1, True))).alias("at"))
            .select("at.m", "at.a", "at.b", "at.short", "word", "n").where("a < b"))


def _halves(rows: DataFrame) -> DataFrame:
    mid = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    at = F.explode(F.array(F.struct(F.col("a"), mid.alias("b")), F.struct(mid.alias("a"), F.col("b"))))
    return rows.select("m", at.alias("at"), "short", "word", "n").select("m", "at.a", "at.b", "short", "word", "n")


def links(vocabulary: DataFrame, group: int = GROUP) -> DataFrame:
    """(word, near, near_n): every two words of ``vocabulary`` (word, n; words are distinct and not empty) one code point
    apart, in both directions, once each."""
    rows, out = _windows(vocabulary), None
    while True:
        rows = rows.withColumn("key", _key())
        sizes = rows.groupBy("key").agg(F.count_if(~F.col("short")).alias("long_words"), F.count(F.lit(1)).alias("rows"),
                                        F.max(F.col("b") - F.col("a")).alias("wide"))
        large = (F.col("wide") > 1) & ((F.col("rows") > group) | (F.col("rows") * F.col("wide") > LETTERS))
        # a group without a word of the index, or of one word alone, has no link
        sizes = stored(sizes.where("long_words >= 1 and rows >= 2").select("key", large.alias("large")), "groups")
        few = rows.join(sizes.where("not large").select("key"), "key")
        order = ["m", "a", "b", "key", "short"]
        found = (few.select(*order, "word", "n").repartition("key").sortWithinPartitions(*order)
                 .mapInArrow(_search, "word string, near string, near_n long"))
        out = found if out is None else out.union(found)
        if sizes.where("large").isEmpty():
            return out
        rows = stored(_halves(rows.join(sizes.where("large").select("key"), "key")), "halves")


# ---- forms ----

def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last word that forms lead to. A form is more frequent than its word, so paths end."""
    paths = forms.select("word", F.col("form").alias("root"))
    while True:
        paths = stored(paths, "paths")
        longer = paths.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if paths.join(longer, "root", "left_semi").isEmpty():
            return paths
        paths = paths.join(longer, "root", "left").select("word", F.coalesce("further", "root").alias("root"))


def variants(vocabulary: DataFrame, ratio: int = 10, group: int = GROUP) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of ``vocabulary`` (word, n; other columns are ignored).

    Words are near if they differ by exactly one inserted, deleted or replaced code point; n_near counts a word's near
    words. Its form is the near word of largest n (ties: the smallest in code-point order) if that n is at least ``ratio`` times its
    own, else null; root is where forms lead, the word itself if there is none. A word must not be listed twice; null
    and empty words are dropped. An empty vocabulary gives an empty table."""
    vocabulary = vocabulary.select("word", F.col("n").cast("long").alias("n")).where("length(word) > 0")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    near = links(vocabulary, group).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    counted = stored(vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.n") >= ratio * F.col("n"), F.struct(F.col("best.word").alias("form"), (-F.col("best.n")).alias("form_n"))).alias("f")),
        "variants")
    ends = roots(counted.where("f is not null").select("word", "f.form"))
    return counted.join(ends, "word", "left").select("word", "f.form", F.coalesce("root", "word").alias("root"), "n", "n_near", "f.form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = word_counts(table(spark, sf_dir, "documents"), min_length=7, noise=31)
    return variants(stored(counts.where("n >= 2"), "vocabulary"))


#: crc32 over UTF-8 bytes by its table of 256 values; words are compared through patterns with one letter left out.
OP11_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS r FROM documents),
lowered AS (
  SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS k
  FROM runs WHERE length(r) >= 7 GROUP BY ALL),
hashed AS (
  SELECT r, k, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(concat(doc_id, ':', r), ''),
    lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [192 | (unicode(ch) >> 6), (128 | (unicode(ch) & 63))::BIGINT] END))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM lowered, crc),
words AS (
  SELECT CASE WHEN h % 31 = 0 THEN r[:(h % length(r))] || r[(h % length(r)) + 2:] ELSE r END AS word, k FROM hashed),
v AS (
  SELECT word, sum(k)::BIGINT AS n FROM words WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
places AS (
  SELECT word, n, unnest(range(length(word))) AS i FROM v),
cut AS (
  SELECT DISTINCT word, n, word[:i] || word[i + 2:] AS shorter FROM places),
masked AS (
  SELECT word, n, word[:i] || '*' || word[i + 2:] AS mask FROM places),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM masked a JOIN masked b ON a.mask = b.mask AND a.word <> b.word
  UNION ALL SELECT cut.word, v.word, v.n FROM cut JOIN v ON cut.shorter = v.word
  UNION ALL SELECT v.word, cut.word, cut.n FROM cut JOIN v ON cut.shorter = v.word),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM near GROUP BY word),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * v.n THEN near END AS form,
         CASE WHEN near_n >= 10 * v.n THEN near_n END AS form_n
  FROM v LEFT JOIN best ON v.word = best.word),
path AS (
  SELECT word, word AS stop, 0 AS step FROM f
  UNION ALL SELECT path.word, f.form, step + 1 FROM path JOIN f ON path.stop = f.word WHERE f.form IS NOT NULL),
ends AS (
  SELECT word, arg_max(stop, step) AS root FROM path GROUP BY word)
SELECT f.word, f.form, ends.root, f.n, f.n_near, f.form_n FROM f JOIN ends ON f.word = ends.word
"""
