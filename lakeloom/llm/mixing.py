"""Mixing to target weights with soft domain membership.

A classifier fitted on a bounded sample of the labelled rows gives every
document posteriors over the domains. Then nonnegative document rates r are
fitted so that the expected tokens of each domain, sum of r * tokens *
posterior, are the wanted shares of the token budget: least squares by
accelerated projected gradient. The gradient needs only one total for each
domain, a partial sum in each task; the rate of a document after any number of
steps follows from its posteriors and the totals so far, so each pass replays
it from the stored (tokens, posteriors) table and no state lives on executors.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm import _text
from lakeloom.llm._io import fitted, sample_cut, staged, text_batches

DOMAINS = ("high", "low", "toxic")
#: wanted shares of the expected tokens
TARGETS = {"high": 0.85, "low": 0.13, "toxic": 0.02}


@dataclass(frozen=True)
class Settings:
    """``sample``: most labelled rows that are learned from."""

    buckets: int = 1 << 15
    sample: int = 8000
    epochs: int = 8
    rate: float = 0.3
    steps: int = 60
    tolerance: float = 1e-4
    seed: int = 11


@dataclass(frozen=True)
class Classifier:
    domains: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray


def domain_of(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, domain) of the labelled rows: toxic, else by quality. Rows with
    a null or unknown mark are left out; of repeated ids the first domain in
    text order counts."""
    domain = (F.when(F.col("toxic") == 1, "toxic").when((F.col("toxic") == 0) & (F.col("quality") == 1), "high")
              .when((F.col("toxic") == 0) & (F.col("quality") == 0), "low"))
    return (labels.select(F.col(doc_id).cast("long").alias("doc_id"), domain.alias("domain"))
            .where("doc_id is not null and domain is not null").groupBy("doc_id").agg(F.min("domain").alias("domain")))


def _buckets(data: np.ndarray, offsets: np.ndarray, buckets: int):
    """(row, bucket) of each text's distinct words and word starts, and the
    number of words of each row."""
    starts, ends, row = _text.words(data, offsets, _text.NON_SPACE)
    n = np.diff(row)
    doc = np.repeat(np.arange(len(n)), n)
    head = np.minimum(ends, starts + 6)
    edge = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    tail = edge.astype(np.uint64) + np.uint64(7)  # its last byte, apart from the word
    keys = [_text.word_hashes(data, starts, ends, True), _text.word_hashes(data, starts, head, True) + np.uint64(1), _text.mix(tail)]
    key = np.concatenate([doc * buckets + (k % np.uint64(buckets)).astype(np.int64) for k in keys])
    key, count = np.unique(key, return_counts=True)
    return key // buckets, key % buckets, count, n


def _weights(count: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    """Damped counts with unit length for each row."""
    w = np.log1p(count)
    norm = np.sqrt(np.bincount(row, w * w, minlength=n_rows))
    return w / np.maximum(norm, 1e-9)[row]


def train(data: list[tuple[np.ndarray, np.ndarray, int]], domains: tuple[str, ...], s: Settings) -> Classifier | None:
    """Softmax by stochastic gradient descent on (buckets, weights, domain
    number) rows, in an order that follows from the rows alone."""
    if not data:
        return None
    data = sorted(data, key=lambda x: (crc32(x[0].tobytes() + x[1].tobytes()), x[2]))
    rng = np.random.default_rng(s.seed)
    share = np.bincount([y for *_, y in data], minlength=len(domains)) + 0.5
    table, bias = np.zeros((s.buckets, len(domains))), np.log(share / share.sum())
    squares = np.full_like(table, 1e-6)
    for _ in range(s.epochs):
        for k in rng.permutation(len(data)):
            bucket, w, y = data[k]
            z = w @ table[bucket] + bias
            g = np.exp(z - z.max())
            g /= g.sum()
            g[y] -= 1
            step = w[:, None] * g
            squares[bucket] += step * step
            table[bucket] -= s.rate * step / np.sqrt(squares[bucket] + 0.01)
    return Classifier(domains, table.astype(np.float32), bias)


def fit_classifier(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), domains: tuple[str, ...] = DOMAINS,
                   doc_id: str = "doc_id", text: str = "text") -> Classifier | None:
    """Softmax over hashed words, by stochastic gradient descent in numpy, on
    at most ``s.sample`` labelled documents, chosen by a hash of the id (of
    rows that repeat an id the first text in order). Texts are hashed where
    they are; one task learns from the bounded sample and returns the weights.
    None if there is nothing to learn from."""
    marked = domain_of(labels) if "domain" not in labels.columns else labels
    cut = sample_cut(marked, "doc_id", s.sample)
    if cut is None:
        return None
    picked = F.broadcast(marked.where(F.xxhash64("doc_id") <= cut).limit(s.sample).withColumnRenamed("doc_id", "__id"))
    rows = docs.select(F.col(doc_id).cast("long").alias("__doc"), F.col(text).alias("text")).where("text is not null").join(
        picked, F.col("__doc") == F.col("__id")).groupBy("__doc").agg(F.min("domain").alias("domain"), F.min("text").alias("text"))

    def features(batches):
        for batch in batches:
            for first, data, offsets in _text.slices(batch.column(1)):
                n = len(offsets) - 1
                row, bucket, count, _ = _buckets(data, offsets, s.buckets)
                per_row = np.bincount(row, minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), _text.lists(bucket.astype(np.int32), per_row),
                     _text.lists(_weights(count, row, n).astype(np.float32), per_row)], ["domain", "bucket", "w"])

    def learn(batches):
        return train([(np.asarray(b.values), np.asarray(w.values), domains.index(d)) for batch in batches
                      for d, b, w in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)) if d in domains], domains, s)

    return fitted(rows.select("domain", "text").mapInArrow(features, "domain string, bucket array<int>, w array<float>"), learn)


def _posterior(m: Classifier, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of words and posteriors of each row of a slice."""
    buckets, k = m.table.shape
    n = len(offsets) - 1
    row, bucket, count, words = _buckets(data, offsets, buckets)
    w = _weights(count, row, n)
    z = np.stack([np.bincount(row, w * m.table[bucket, i], minlength=n) for i in range(k)], axis=1) + m.bias
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return words.astype(np.int64), p / p.sum(axis=1, keepdims=True)


def posteriors(docs: DataFrame, model: Classifier, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, tokens, p array<double>): tokens are words between white space."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for first, data, offsets in _text.slices(batch.column(1)):
                tokens, p = _posterior(sent.value, data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(p)), pa.array(tokens), _text.lists(p.ravel(), np.full(*p.shape))], ["doc_id", "tokens", "p"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, tokens long, p array<double>")


def _rates(p: np.ndarray, pulls: list[np.ndarray], momenta: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the steps taken so far, and the point of the next gradient."""
    r = np.ones(len(p))
    ahead = r
    for pull, beta in zip(pulls, momenta):
        new = np.maximum(0.0, ahead - p @ pull)
        ahead = new + beta * (new - r)
        r = new
    return r, ahead


def fit_rates(table: DataFrame, targets: np.ndarray, steps: int, tolerance: float) -> tuple[list[np.ndarray], list[float], np.ndarray]:
    """Steps (pull for each domain, momentum) that make the expected domain
    tokens of ``table`` (tokens, p) the shares ``targets`` of all its tokens.
    Each pass sends back one row of sums a task. Also the last shares."""
    k = len(targets)

    def pass_over(pulls, momenta):
        def run(batches):
            here, there, total = np.zeros(k), np.zeros(k), 0.0
            curve = np.zeros((k, k))
            for batch in batches:
                t = np.asarray(batch.column(0)).astype(float)
                p = np.asarray(batch.column(1).flatten()).reshape(-1, k)
                r, ahead = _rates(p, pulls, momenta)
                here += (r * t) @ p
                there += (ahead * t) @ p
                total += t.sum()
                if not pulls:
                    curve += p.T @ (p * t[:, None])
            yield pa.RecordBatch.from_arrays([_text.lists(np.r_[total, here, there, curve.ravel()], np.array([1 + 2 * k + k * k]))], ["s"])

        sums = table.select("tokens", "p").mapInArrow(run, "s array<double>").select(F.posexplode("s").alias("i", "v"))
        out = np.zeros(1 + 2 * k + k * k)
        for row in sums.groupBy("i").agg(F.sum("v").alias("v")).collect():  # one row a position
            out[row.i] = row.v
        return out[0], out[1:1 + k], out[1 + k:1 + 2 * k], out[1 + 2 * k:].reshape(k, k)

    pulls, momenta = [], []
    total, here, ahead, curve = pass_over(pulls, momenta)
    if total <= 0:
        return pulls, momenta, np.zeros(k)
    # Gradients are scaled by the inverse curvature (with a floor), so rare
    # domains move as fast as common ones.
    curve = curve / total
    scale = np.linalg.inv(curve + 1e-4 * np.trace(curve) / k * np.eye(k))
    for step in range(steps):
        if np.abs(here / total - targets).max() <= tolerance:
            break
        pulls.append(0.9 * scale @ (ahead / total - targets))
        momenta.append(step / (step + 3))
        _, here, ahead, _ = pass_over(pulls, momenta)
    return pulls, momenta, here / total


@dataclass(frozen=True)
class Mix:
    """What ``fit`` finds: domains, their classifier and the steps of the fit."""

    domains: tuple[str, ...]
    model: Classifier
    pulls: list[np.ndarray]
    momenta: list[float]

    def rates(self, p: np.ndarray) -> np.ndarray:
        return _rates(p, self.pulls, self.momenta)[0]


def fit(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, settings: Settings = Settings(),
        doc_id: str = "doc_id", text: str = "text") -> tuple[Mix, DataFrame]:
    """The mix, and the stored table (doc_id, tokens, p) it was fitted on."""
    text_batches(docs.sparkSession)
    domains = tuple(sorted(targets))
    wanted = np.array([targets[d] for d in domains], float)
    wanted = wanted / wanted.sum()
    model = fit_classifier(docs, labels, settings, domains, doc_id, text)
    learned = model is not None
    model = model or Classifier(domains, np.zeros((1, len(domains)), np.float32), np.zeros(len(domains)))
    table = staged(posteriors(docs, model, doc_id, text), "posteriors")
    pulls, momenta, _ = fit_rates(table, wanted, settings.steps, settings.tolerance) if learned else ([], [], None)
    return Mix(domains, model, pulls, momenta), table


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, settings: Settings = Settings(),
        doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, tokens, p_<domain>..., rate, copies) for every row.

    ``rate`` is how often the document is drawn in expectation; ``copies`` is
    it rounded up or down by a hash of the id and its tokens, so that the
    expected totals hold. Null and empty texts have no tokens; they get the
    posteriors of an empty text and a rate like all others. Null ids and
    repeated rows keep a row each. Without any usable label all posteriors are
    equal and all rates 1. Targets are scaled to sum 1. An empty table gives
    an empty table; other columns are ignored.
    """
    found, table = fit(docs, labels, targets, settings, doc_id, text)

    def run(batches):
        for batch in batches:
            p = np.asarray(batch.column(2).flatten()).reshape(-1, len(found.domains))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.rates(p))], ["doc_id", "tokens", "p", "rate"])

    kind = docs.schema[doc_id].dataType.simpleString()
    out = table.mapInArrow(run, f"doc_id {kind}, tokens long, p array<double>, rate double")
    part = F.pmod(F.xxhash64("doc_id", "tokens"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return out.select("doc_id", "tokens", *(F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(found.domains)), "rate",
                      F.floor(F.col("rate") + part).cast("long").alias("copies"))


def weighted(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, settings: Settings = Settings(),
             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``mix_rate`` (replacing a column of that name); documents
    with rate 0 go. The rate follows from the text, so nothing is joined: null and
    empty texts get the rate of an empty text, equal texts and repeated rows
    the same rate each, null ids a rate like all others. Without any usable
    label all rates are 1. An empty table gives an empty table."""
    docs = docs.drop("mix_rate")
    found, _ = fit(docs, labels, targets, settings, doc_id, text)
    at, names = docs.columns.index(text), docs.columns

    def run(batches):
        for batch in batches:
            rate = [found.rates(_posterior(found.model, data, offsets)[1]) for _, data, offsets in _text.slices(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(rate) if rate else np.zeros(0))], [*names, "mix_rate"])

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, mix_rate double").where("mix_rate > 0")
