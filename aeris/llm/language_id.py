"""Language identification with error-correcting output codes.

Each language has a codeword; for every bit of the code a binary classifier over hashed character n-grams
(log-odds of the languages whose bit is one against the others, every language weighing the same) predicts that bit.
Decoding sums a logistic loss over the bits, weighted by how well each bit's two sides can be told apart, and takes
the codeword of least loss. A text is ambiguous when its hard bits lie outside the code's correcting radius of the
chosen codeword, or when the second codeword is almost as near.

Training counts n-grams over all labelled rows: each task sends one sum per language and hash bucket, so what is
gathered is bounded by languages x ``buckets`` and not by the rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeris.llm.common import table

UNKNOWN = "und"
ORDERS = (1, 2, 3)
BUCKETS = 1 << 14
#: Languages up to which the exhaustive code (every split of the languages in two) is used.
EXHAUSTIVE = 6
#: A second codeword whose probability is above this makes a text ambiguous.
SECOND = 0.35
#: A text whose margin per n-gram is below this share of what the labelled rows of its language have is in none.
LEAST_FIT = 0.4
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_CHUNK = 1 << 20


def letters(text: str | None) -> str:
    """Lower-case letters with one space between runs; empty if there is no letter."""
    plain = _NOT_LETTERS.sub(" ", (text or "").lower())
    return plain if any(c.isalpha() for c in plain) else ""


def ngram_counts(plain: str, buckets: int = BUCKETS) -> np.ndarray:
    """Counts of hashed code point n-grams. Long texts are read in chunks that overlap by the longest n-gram."""
    total = np.zeros(buckets, dtype=np.int64)
    over = max(ORDERS) - 1
    shift = np.uint32(32 - int(math.log2(buckets)))
    for at in range(0, max(len(plain), 1), _CHUNK):
        x = np.frombuffer(plain[at:at + _CHUNK + over].encode("utf-32-le", "replace"), dtype=np.uint32)
        h = np.zeros(len(x), dtype=np.uint32)
        for n in range(1, max(ORDERS) + 1):
            if len(x) < n:
                break
            h = h[: len(x) - n + 1] * np.uint32(0x01000193) + x[n - 1:]
            if n in ORDERS:
                starts = min(len(h), _CHUNK)
                ids = ((h[:starts] + np.uint32(n)) * np.uint32(0x9E3779B1)) >> shift
                total += np.bincount(ids, minlength=buckets)
    return total


def codewords(n: int) -> np.ndarray:
    """n codewords of +1 and -1 (rows). Up to ``EXHAUSTIVE`` languages: every split in two. Above: of 200 seeded
    random codes with 10 log2 n bits the one whose nearest two codewords are farthest apart."""
    if n <= 1:
        return np.ones((n, 0), dtype=np.int8)
    if n <= EXHAUSTIVE:
        columns = [(1, *rest) for rest in product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(columns, dtype=np.int8).T
    best, far = None, -1
    for seed in range(200):
        code = np.random.default_rng(seed).choice(np.array([1, -1], dtype=np.int8), (n, math.ceil(10 * math.log2(n))))
        if (np.abs(code.sum(0)) == n).any():
            continue
        apart = min_distance(code)
        if apart > far:
            best, far = code, apart
    return best


def min_distance(code: np.ndarray) -> int:
    wide = code.astype(np.int32)
    apart = (wide.shape[1] - wide @ wide.T) // 2
    return int(apart[~np.eye(len(code), dtype=bool)].min()) if len(code) > 1 else 0


@dataclass
class LanguageModel:
    """languages by codeword row; weights (buckets x bits); reliability per bit; radius in hard bits; usual margin towards
    its codeword that an n-gram of the language's labelled rows has."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    reliability: np.ndarray
    radius: int
    usual: np.ndarray

    @classmethod
    def from_counts(cls, counts: dict[str, np.ndarray], alpha: float = 0.5) -> LanguageModel:
        languages = sorted(counts)
        code = codewords(len(languages))
        if not languages:
            return cls([], code, np.zeros((BUCKETS, 0)), np.zeros(0), 0, np.zeros(0))
        c = np.array([counts[x] for x in languages], dtype=np.float64) + alpha
        p = c / c.sum(1, keepdims=True)
        weights = np.zeros((c.shape[1], code.shape[1]), dtype=np.float32)
        reliability = np.zeros(code.shape[1])
        for b in range(code.shape[1]):
            one, zero = p[code[:, b] > 0].mean(0), p[code[:, b] < 0].mean(0)
            weights[:, b] = np.log(one) - np.log(zero)
            reliability[b] = ((one - zero) * weights[:, b]).sum()
        if code.shape[1]:
            reliability /= max(reliability.mean(), 1e-12)
        usual = ((p @ weights) * code * reliability).sum(1) / max(reliability.sum(), 1e-12)
        return cls(languages, code, weights, reliability, max(0, min_distance(code) - 1) // 2, usual)

    def predict(self, text: str | None) -> tuple[str, float, bool, int, float]:
        """(language, score 0 to 1, ambiguous, hard bits that differ from the codeword, fit). The score tells which
        language is nearest and grows with the text; fit, the margin per n-gram as a share of the language's usual one, tells
        whether the text is in it at all. With a single language fit is 1."""
        plain = letters(text)
        if not plain or not self.languages:
            return UNKNOWN, 0.0, True, 0, 0.0
        counts = ngram_counts(plain, len(self.weights))
        n = max(1, counts.sum())
        margins = (counts.astype(np.float32) @ self.weights) / math.sqrt(n)
        loss = (np.logaddexp(0.0, -self.code * margins) * self.reliability).sum(1)
        best = int(loss.argmin())
        odds = np.exp(loss[best] - loss)
        odds /= odds.sum()
        wrong = int((np.where(margins >= 0, 1, -1) != self.code[best]).sum())
        second = float(np.delete(odds, best).max(initial=0.0))
        fit = 1.0
        if self.usual[best] > 0:
            fit = float((margins * self.code[best] * self.reliability).sum() / self.reliability.sum() / math.sqrt(n) / self.usual[best])
        return self.languages[best], float(odds[best]), wrong > self.radius or second > SECOND, wrong, fit


def fit(docs: DataFrame, buckets: int = BUCKETS) -> LanguageModel:
    """Fit on every row of ``docs`` (text, lang) whose lang isn't null. Without such rows the model knows no
    language and predicts ``und``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                plain = letters(text.as_py())
                held = sums.setdefault(lang.as_py(), np.zeros(buckets, dtype=np.int64))
                if plain:
                    held += ngram_counts(plain, buckets)
        for lang, held in sums.items():
            at = np.concatenate([held.nonzero()[0], [-1]])  # -1: the language was seen
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(held[at], pa.int64())],
                ["lang", "bucket", "n"])

    rows = (docs.where("lang is not null").select("text", "lang").mapInArrow(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect())
    counts: dict[str, np.ndarray] = {}
    for lang, bucket, n in rows:
        held = counts.setdefault(lang, np.zeros(buckets, dtype=np.int64))
        if bucket >= 0:
            held[bucket] = n
    return LanguageModel.from_counts(counts)


def prediction(docs: DataFrame, model: LanguageModel) -> Column:
    """Struct of lang_pred, score, ambiguous, wrong_bits and fit, predicted from the column ``text`` of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x buckets, whatever the rows
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_()), ("wrong_bits", pa.int32()),
                      ("fit", pa.float64())])

    @F.arrow_udf("lang_pred string, score double, ambiguous boolean, wrong_bits int, fit double")
    def predicted(text: pa.Array) -> pa.Array:
        names = [f.name for f in kind]
        return pa.array([dict(zip(names, shared.value.predict(t.as_py()))) for t in text], kind)

    return predicted("text")


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, lang_pred, score, ambiguous,
    wrong_bits, fit. Null texts and texts without a letter are ``und`` with score and fit 0; very long texts are read whole."""
    return docs.select("doc_id", prediction(docs, model).alias("p")).select("doc_id", "p.*")


def accepted(docs: DataFrame, model: LanguageModel, least: float = 0.5, least_fit: float = LEAST_FIT) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text has a language. Rejected are ``und``, texts whose fit is below ``least_fit``
    (random letters, scripts and languages that were not learned), and ambiguous texts whose best language has a score below ``least``;
    a text that is ambiguous but mostly in one language stays."""
    names = docs.columns
    told = docs.select(F.struct(*[docs[c] for c in names]).alias("doc"), prediction(docs, model).alias("p"))
    unsure = F.col("p.ambiguous") & (F.col("p.score") < least)
    return told.where((F.col("p.lang_pred") != UNKNOWN) & (F.col("p.fit") >= least_fit) & ~unsure).select("doc.*")


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 4, is 2. A null id is neither held out nor learned from."""
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    return identify(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred",
                                        "score", "ambiguous", "wrong_bits", "fit")
