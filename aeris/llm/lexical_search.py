"""Ranked lexical search: the documents of largest inner product with a query, by branch and bound over sparse ball trees.

A document is a sparse vector of integer term scores, a query one of integer weights, and a document's score their exact integer
product. Each task builds ball trees over its documents: a node keeps the centroid of its documents, the radius around it, and
the largest coordinate of each term. No document of a node can score above

    query . centroid + |query| * radius          (Cauchy-Schwarz, in doubles, rounded up beyond any error of theirs)

nor above the product of the query and the largest coordinates (exact integers). The smaller of both is the node's bound. A
query opens the node of highest bound first, scores the documents of a leaf exactly, and ends when no bound reaches the score
of the last document it would return; that score is carried from tree to tree. The best of all tasks are ranked at the end.

Queries come in blocks of bounded size, which is all that is broadcast or held by the driver, and vectors hold the terms of the block
alone. Two passes: the first counts terms and the corpus statistics over all documents and stores the vectors, the second searches.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeris.llm.common import stored, table, words_of

#: Bounds of a block of queries: different terms a query, summed, their bytes, and queries.
BLOCK_TERMS, BLOCK_BYTES, BLOCK_QUERIES = 1 << 18, 1 << 24, 1 << 12
#: Documents of a leaf, and documents or entries of a tree.
LEAF, TREE_DOCS, TREE_ENTRIES = 32, 4096, 1 << 21
#: Relative error granted to sums of doubles, far above what sums of TREE_ENTRIES products can have.
SLACK = 1e-9


# ---- scores (fixed by the formula) ----

def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norm(n: int, n_docs: int, n_terms: int) -> int:
    return 100 - 75 + (75 * n * n_docs) // n_terms


def term_score(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


# ---- queries ----

@dataclass
class Queries:
    """A block of queries: (item, {term number: occurrences}) each, and the numbers of the terms."""

    terms: dict[bytes, int]
    items: list[Any]
    counts: list[dict[int, int]]


def blocks(items: DataFrame, block_terms: int = BLOCK_TERMS) -> Iterator[Queries]:
    """The rows of ``items`` (item_id, text) in blocks, read one by one; rows without a term are left out. A query larger than the bounds is
    a block of its own."""
    block, size, n_bytes = Queries({}, [], []), 0, 0
    for row in items.select("item_id", "text").toLocalIterator():
        counts = Counter(words_of(row.text or ""))
        more = sum(len(t) for t in counts if t not in block.terms)
        if block.items and (size + len(counts) > block_terms or n_bytes + more > BLOCK_BYTES or len(block.items) >= BLOCK_QUERIES):
            yield block
            block, size, n_bytes = Queries({}, [], []), 0, 0
            more = sum(map(len, counts))
        if counts:
            block.items.append(row.item_id)
            block.counts.append({block.terms.setdefault(t, len(block.terms)): k for t, k in counts.items()})
            size, n_bytes = size + len(counts), n_bytes + more
    if block.items:
        yield block


# ---- term counts ----

def term_counts(docs: DataFrame, terms) -> DataFrame:
    """For each row of ``docs`` that has a term of the broadcast ``terms``: doc_id, n (its terms, with repeats), ids and tfs of those it has. And
    per task one row with ``total``: n is 0, ids are all terms and tfs the documents that hold them, n_docs and n_terms are
    the documents with at least one term and all their terms."""
    spec = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(
        "total boolean, n long, ids array<int>, tfs array<long>, n_docs long, n_terms long").fields])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        known, schema = terms.value, to_arrow_schema(spec)
        df, n_docs, n_terms = np.zeros(len(known), dtype=np.int64), 0, 0
        for batch in batches:
            rows, ids, tfs, lengths = [], [], [], []
            for row, text in enumerate(batch.column(1)):
                words = words_of(text.as_py() or "")
                if not words:
                    continue
                n_docs, n_terms = n_docs + 1, n_terms + len(words)
                found = np.fromiter(map(known.get, words, repeat(-1)), dtype=np.int32, count=len(words))
                found, tf = np.unique(found[found >= 0], return_counts=True)
                if len(found):
                    df[found] += 1
                    rows.append(row)
                    lengths.append(len(words))
                    ids.append(found)
                    tfs.append(tf)
            if rows:
                yield _batch(schema, batch.column(0).take(pa.array(rows, pa.int64())), False, lengths, ids, tfs, 0, 0)
        if n_docs:
            yield _batch(schema, pa.nulls(1, schema.field("doc_id").type), True, [0], [np.arange(len(known))], [df], n_docs, n_terms)

    return docs.select("doc_id", "text").mapInArrow(count, spec)


def _lists(parts: list[np.ndarray], item: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts)).cast(item))


def _batch(schema: pa.Schema, doc_ids: pa.Array, total: bool, n, ids, tfs, n_docs: int, n_terms: int) -> pa.RecordBatch:
    k = len(doc_ids)
    columns = [doc_ids, pa.array([total] * k), pa.array(n, pa.int64()), _lists(ids, pa.int32()), _lists(tfs, pa.int64()),
               pa.array([n_docs] * k, pa.int64()), pa.array([n_terms] * k, pa.int64())]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)


# ---- ball tree ----

@dataclass
class Rows:
    """Sparse integer vectors, one after the other."""

    start: np.ndarray
    ids: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.start) - 1

    def take(self, rows: np.ndarray) -> Rows:
        size = self.start[rows + 1] - self.start[rows]
        start = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(start[-1]) + np.repeat(self.start[rows] - start[:-1], size)
        return Rows(start, self.ids[at], self.values[at])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        """Product of every row (none is empty) with a vector, exact if both are integers."""
        return np.add.reduceat(self.values * dense[self.ids], self.start[:-1])


class Node:
    """Summary of a set of rows: the terms they hold, centroid and largest coordinate of each, radius; then its children or its rows."""

    __slots__ = ("terms", "centroid", "largest", "radius", "children", "rows", "docs")

    def __init__(self, rows: Rows, docs: np.ndarray, n_terms: int, leaf: int):
        summed = np.bincount(rows.ids, weights=rows.values, minlength=n_terms)
        self.terms = np.flatnonzero(summed)
        centroid = summed / len(rows)
        self.centroid = centroid[self.terms]
        largest = np.zeros(n_terms, dtype=np.int64)
        np.maximum.at(largest, rows.ids, rows.values)
        self.largest = largest[self.terms]
        own = np.add.reduceat(np.square(rows.values, dtype=np.float64), rows.start[:-1])
        middle = float(self.centroid @ self.centroid)
        far = own - 2 * rows.dot(centroid) + middle
        self.radius = math.sqrt(max(0.0, float(np.max(far + SLACK * (own + middle)))))
        self.children, self.rows, self.docs = (), None, None
        if len(rows) <= leaf:
            self.rows, self.docs = rows, docs
            return
        one = _dense(rows, int(np.argmax(far)), n_terms)
        other = _dense(rows, int(np.argmax(own - 2 * rows.dot(one))), n_terms)
        lean = rows.dot(one - other)
        # rows go to the nearer of two far ones, but at least an eighth to each, so that the depth is bounded whatever they are
        least = -(-len(rows) // 8)
        cut = min(max(int(np.count_nonzero(2 * lean < one @ one - other @ other)), least), len(rows) - least)
        order = np.argsort(lean, kind="stable")
        self.children = tuple(Node(rows.take(h), docs[h], n_terms, leaf) for h in (np.sort(order[:cut]), np.sort(order[cut:])))

    def bound(self, query: np.ndarray, doubles: np.ndarray, norm: float) -> int:
        """At least the score of every row: the smaller of the ball's bound and the exact one of the largest coordinates."""
        ball = (float(doubles[self.terms] @ self.centroid) + norm * self.radius) * (1 + SLACK)
        return min(math.ceil(ball) + 1, int(query[self.terms] @ self.largest))


def _dense(rows: Rows, row: int, n_terms: int) -> np.ndarray:
    out = np.zeros(n_terms)
    at = slice(rows.start[row], rows.start[row + 1])
    out[rows.ids[at]] = rows.values[at]
    return out


class Best:
    """The k rows of highest score so far, equal scores by ascending document, nulls last. Scores of 0 don't count."""

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, [], 1

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        good = np.flatnonzero(scores >= self.least)
        if len(good):
            self.rows = heapq.nsmallest(self.k, self.rows + [(-s, d is None, d) for s, d in zip(scores[good].tolist(), docs[good].tolist())],
                                        key=lambda r: r[:2] if r[1] else r)
            if len(self.rows) == self.k:
                self.least = -self.rows[-1][0]


def search(root: Node, query: np.ndarray, best: Best) -> int:
    """Put the rows of the tree into ``best``; the number of rows that were scored."""
    doubles = query.astype(np.float64)
    norm = math.sqrt(float(doubles @ doubles)) * (1 + SLACK)
    heap, n, scored = [(-root.bound(query, doubles, norm), 0, root)], 1, 0
    while heap:
        bound, _, node = heapq.heappop(heap)
        if -bound < best.least:  # a row of equal score may come first by its document
            break
        if node.rows is not None:
            best.add(node.rows.dot(query), node.docs)
            scored += len(node.rows)
        for child in node.children:
            bound = child.bound(query, doubles, norm)
            if bound >= best.least:
                heapq.heappush(heap, (-bound, n, child))
                n += 1
    return scored


# ---- search of a table ----

def _search_block(docs: DataFrame, queries: Queries, item_type: T.StructField, k: int, tree_docs: int, number: int) -> DataFrame:
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(queries.terms)
    counted = stored(term_counts(docs, sent), "terms")
    sent.unpersist()
    totals = counted.where("total")
    n_docs, n_terms = (x or 0 for x in totals.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    df = {r.id: r.df for r in totals.select(F.explode(F.arrays_zip("ids", "tfs")).alias("t")).groupBy(F.col("t.ids").alias("id"))
          .agg(F.sum("t.tfs").alias("df")).collect()}  # one row per term of the block
    weight = {t: term_weight(n_docs, df.get(t, 0)) for t in queries.terms.values()}
    vectors = [(list(c), [weight[t] * times for t, times in c.items()]) for c in queries.counts]
    info = spark.sparkContext.broadcast((vectors, queries.items, len(queries.terms), n_docs, n_terms))
    spec = T.StructType([T.StructField("block", T.LongType()), T.StructField("query", T.LongType()), item_type,
                         docs.schema["doc_id"], T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        vectors, items, n_known, n_docs, n_terms = info.value
        best = [Best(k) for _ in vectors]
        for rows, doc_ids in _trees(batches, n_docs, n_terms, tree_docs):
            root = Node(rows, doc_ids, n_known, LEAF)
            query = np.zeros(n_known, dtype=np.int64)
            for (terms, weights), b in zip(vectors, best):
                query[terms] = weights
                search(root, query, b)
                query[terms] = 0
        found = [(number, q, items[q], d, -s) for q, b in enumerate(best) for s, _, d in b.rows]
        if found:
            schema = to_arrow_schema(spec)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    return counted.where("not total").select("doc_id", "n", "ids", "tfs").mapInArrow(run, spec)


def _trees(batches: Iterator[pa.RecordBatch], n_docs: int, n_terms: int, tree_docs: int) -> Iterator[tuple[Rows, np.ndarray]]:
    """Vectors and ids of the documents of one tree after the other."""
    held, docs, size = [], [], 0

    def tree() -> tuple[Rows, np.ndarray]:
        n = np.array([d[0] for d in held], dtype=object)
        start = np.cumsum([0, *(len(d[1]) for d in held)])
        norms = np.array([length_norm(int(x), n_docs, n_terms) for x in n], dtype=np.int64)
        values = term_score(np.concatenate([d[2] for d in held]), np.repeat(norms, np.diff(start)))
        return Rows(start, np.concatenate([d[1] for d in held]), values), np.array([*docs, None], dtype=object)[:-1]

    for batch in batches:
        n, ids, tfs = batch.column(1).to_numpy(), batch.column(2), batch.column(3)
        ends = ids.offsets.to_numpy()
        ids, tfs = ids.values.to_numpy(), tfs.values.to_numpy()
        for i, doc in enumerate(batch.column(0).to_pylist()):
            part = slice(ends[i], ends[i + 1])
            held.append((n[i], ids[part], tfs[part]))
            docs.append(doc)
            size += ends[i + 1] - ends[i]
            if len(held) >= tree_docs or size >= TREE_ENTRIES:
                yield tree()
                held, docs, size = [], [], 0
    if held:
        yield tree()


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS, tree_docs: int = TREE_DOCS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` documents of highest score for each row of ``items`` (item_id, text), equal scores by
    ascending doc_id, nulls last; fewer where fewer score above 0. Other columns are ignored.

    Terms are runs of 0-9, a-z and code points from U+0080 after A-Z are lower-cased. N documents hold a term, L terms in all; df of
    them hold a given one. A query term weighs floor(1000 ln((2N+2)/(2df+1))) for each time it stands in the item; in a document of n terms it scores
    (10^9 tf) div (1000 tf + 8m), m = 25 + 75 n N div L. Null and empty texts have no terms; such an item has no rows. Rows that repeat
    count, and are ranked, each by itself. Without documents or items the table is empty."""
    out, item_type = None, items.schema["item_id"]
    for number, block in enumerate(blocks(items, block_terms)):
        found = _search_block(docs, block, item_type, k, tree_docs, number)
        out = found if out is None else out.union(found)
    spec = T.StructType([item_type, T.StructField("rank", T.IntegerType()), docs.schema["doc_id"], T.StructField("score", T.LongType())])
    if out is None:
        return docs.sparkSession.createDataFrame([], spec)
    order = Window.partitionBy("block", "query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(*spec.names)


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


OP13_SQL = r"""
WITH dt AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
it AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
q AS (
  SELECT item_id, t, count(*) AS k FROM it GROUP BY ALL),
len AS (
  SELECT doc_id, count(*) AS n FROM dt GROUP BY doc_id),
s AS (
  SELECT count(*) AS big_n, sum(n)::BIGINT AS l FROM len),
tf AS (
  SELECT doc_id, t, count(*) AS tf FROM dt WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (
  SELECT t, floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY t),
x AS (
  SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // l))) AS x
  FROM tf JOIN len USING (doc_id) JOIN w USING (t), s),
scored AS (
  SELECT item_id, doc_id, sum(k * x)::BIGINT AS score FROM q JOIN x USING (t) GROUP BY item_id, doc_id)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""
