"""Quality rules: hashed n-gram log-likelihood ratio of two multinomials.

Byte 4-grams, hashed to a fixed number of buckets, are counted over all texts
(raw corpus) and over all trusted texts (target). A text's score is the mean
of log(target / raw) over its n-grams. The threshold is a low quantile of all
trusted texts' own scores, so trusted-like text passes;
each document is then kept or not by that number alone. Word, symbol and
repetition counts are taken in the same pass over the bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm import _text
from lakeloom.llm._io import BROADCAST_ROWS, staged, text_batches

GRAM = 4
WHITE = " \t\n\x0b\x0c\r"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Settings:
    """``quantile`` and ``margin``: the threshold lies ``margin`` below that
    quantile of the trusted scores. ``accuracy``: the quantile's rank is off by
    at most one in so many trusted rows (exact up to that many)."""

    buckets: int = 1 << 16
    accuracy: int = 100_000
    quantile: float = 0.001
    margin: float = 0.3
    smooth: float = 0.5


def _grams(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n-gram at each byte (all rows), and whether it lies
    within one row."""
    k = len(data) - GRAM + 1
    if k <= 0:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    h = np.zeros(k, np.uint32)
    for j in range(GRAM):
        h = (h ^ data[j:j + k]) * np.uint32(0x01000193)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1)
    inside = np.ones(k, bool)
    for o in offsets[1:-1]:
        inside[max(0, o - GRAM + 1):o] = False
    return ((h >> np.uint32(8)) % np.uint32(buckets)).astype(np.int64), inside


def counts(docs: DataFrame, buckets: int, text: str = "text") -> DataFrame:
    """(bucket, n) over all texts; a task sends one row a bucket at most."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, data, offsets in _text.slices(batch.column(0)):
                bucket, inside = _grams(data, offsets, buckets)
                total += np.bincount(bucket[inside], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["bucket", "n"])

    return docs.select(text).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _distribution(rows: DataFrame, s: Settings) -> np.ndarray:
    n = np.full(s.buckets, s.smooth)
    for row in rows.toLocalIterator():  # one row a bucket
        n[row.bucket] += row.n
    return np.log(n / n.sum())


def _mean_ratio(table: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean log ratio of each row; rows without n-grams get 0."""
    bucket, inside = _grams(data, offsets, len(table))
    value = np.zeros(len(data) + 1)
    value[:len(bucket)] = np.where(inside, table[bucket], 0.0)
    total = np.add.reduceat(value, offsets[:-1]) * (np.diff(offsets) > 0)
    return total / np.maximum(np.diff(offsets) - GRAM + 1, 1)


@dataclass(frozen=True)
class Model:
    table: np.ndarray
    threshold: float


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> Model:
    """Counts over all ``docs``; trusted are all of them with a row of
    ``labels`` (doc_id, quality) of quality 1. Without any, every score and the threshold are
    such that all texts pass."""
    text_batches(docs.sparkSession)
    trusted = labels.where("quality = 1").select(F.col(doc_id).cast("long").alias("__id")).where("__id is not null").distinct()
    trusted = staged(trusted, "trusted")
    n = trusted.count()
    if not n:
        return Model(np.zeros(s.buckets), -1.0)
    target = docs.select(F.col(doc_id).cast("long").alias("__doc"), F.col(text).alias("text")).join(
        F.broadcast(trusted) if n <= BROADCAST_ROWS else trusted, F.col("__doc") == F.col("__id"), "left_semi").select("text")
    if n > BROADCAST_ROWS:  # read twice: its texts are shuffled once
        target = staged(target, "target")
    table = _distribution(counts(target, s.buckets), s) - _distribution(counts(docs, s.buckets, text), s)

    def score(batches):
        for batch in batches:
            for _, data, offsets in _text.slices(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(_mean_ratio(table, data, offsets))], ["score"])

    low = target.mapInArrow(score, "score double").agg(F.percentile_approx("score", s.quantile, s.accuracy)).first()[0]
    return Model(table, (0.0 if low is None else low) - s.margin)


def _repeat_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Words of each row in 3-word windows that the row has twice or more."""
    n_rows, n = len(row) - 1, len(starts)
    if n < 3:
        return np.zeros(n_rows, np.int64)
    h = _text.window_hashes(_text.word_hashes(data, starts, ends, folded=False), 3)
    doc = np.repeat(np.arange(n_rows), np.diff(row))
    inside = np.flatnonzero(doc[:-2] == doc[2:])
    key = _text.mix(h[inside] + doc[inside].astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    order = np.argsort(key)
    sorted_key = key[order]
    same = sorted_key[1:] == sorted_key[:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[inside[twice] + k] = True
    return np.bincount(doc[hit], minlength=n_rows)


def _dup_lines(text: str | None) -> int:
    if not text or "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return len(lines) - len(set(lines))


def judge(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, score, kept of every row.

    Null and empty texts have no words, score 0 and fail. ``kept`` is false if
    a base rule fails, else whether the score reaches the threshold (equal
    counts as reached). Repeated rows and null ids keep a row each; an empty
    table gives an empty table; other columns are ignored.
    """
    text_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]

    def run(batches):
        m = sent.value
        for batch in batches:
            texts = batch.column(1)
            for first, data, offsets in _text.slices(texts):
                n = len(offsets) - 1
                starts, ends, row = _text.words(data, offsets, _text.NON_SPACE)
                n_words = np.diff(row)
                solid = (offsets[1:] > offsets[:-1])
                per_row = lambda flags: np.add.reduceat(np.r_[flags, False].astype(np.int64), offsets[:-1]) * solid  # noqa: B023, E731
                chars = per_row(_text.NON_SPACE[data] & ((data & 0xC0) != 0x80))
                repeat = _repeat_words(data, starts, ends, row)
                dup = np.array([_dup_lines(t.as_py()) for t in texts.slice(first, n)], np.int64)
                failed = (n_words < 50) | (100 * repeat > 50 * n_words)
                score = _mean_ratio(m.table, data, offsets)
                columns = [n_words, chars, per_row(_SYMBOL[data]), dup, repeat]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), *(pa.array(c.astype(np.int64)) for c in columns), pa.array(failed),
                     pa.array(score), pa.array(~failed & (score >= m.threshold))], names)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "base_failed boolean, score double, kept boolean")
