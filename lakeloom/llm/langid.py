"""Language identification: averaged hashed subword embeddings, linear softmax.

Every 2-, 3- and 4-byte window of the lower-cased text, with all that is no
letter as a border byte, is hashed to a bucket; a text's vector is the mean of
its buckets' embeddings and a linear softmax predicts the language. Trained by
stochastic gradient descent in numpy on a bounded sample of labelled rows, with
a temperature and rejection thresholds fitted on a part kept out of training.

Both layers are linear up to the softmax, so scoring multiplies them once into
one table (bucket -> logits) that is sent to the tasks (its size is fixed) and
averages table rows over each whole text.

A softmax always names some language, so a second number tells whether the text
looks like it at all: its windows' mean log probability in the learned texts of
the predicted language. Both have a threshold that the right kept-out
predictions reach but for a low quantile.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm import _text
from lakeloom.llm._io import fitted, sample_cut, text_batches

UNKNOWN = "und"
SIZES = (2, 3, 4)
_BORDER = np.full(256, 0x20, np.uint8)
_BORDER[0x61:0x7B] = np.arange(0x61, 0x7B)
_BORDER[0x41:0x5B] = np.arange(0x61, 0x7B)
_BORDER[0x80:] = np.arange(0x80, 0x100)


@dataclass(frozen=True)
class Settings:
    """``sample``: most labelled rows that are learned from, besides up to
    about ``each`` rows of every language (fewer if there are more than
    ``sample / each`` languages). ``precision``:
    predictions below the confidence that reaches it are rejected. ``quantile``
    and ``margin``: so are those less confident than that quantile of the right
    kept-out predictions (and than ``precision``), and texts whose windows are, by ``margin`` nats plus
    ``spread`` nats over the root of their number, rarer in the predicted
    language than that quantile."""

    buckets: int = 1 << 15
    dimensions: int = 16
    sample: int = 4000
    each: int = 50
    epochs: int = 12
    rate: float = 0.5
    precision: float = 0.98
    quantile: float = 0.002
    margin: float = 0.3
    spread: float = 3.0
    seed: int = 7


@dataclass(frozen=True)
class Model:
    languages: list[str]
    table: np.ndarray  # bucket -> logits, temperature applied
    bias: np.ndarray
    threshold: float
    familiar: np.ndarray  # bucket -> log probability in each language's texts
    floor: float
    spread: float

    def accepts(self, best, known, windows):
        return (best >= self.threshold) & (known >= self.floor - self.spread / np.sqrt(np.maximum(windows, 1)))


def grams(data: np.ndarray, offsets: np.ndarray, buckets: int):
    """(row, bucket) arrays of all windows with a letter, per window size."""
    c = _BORDER[data].astype(np.uint32)
    row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    letter = c != 0x20
    h = np.zeros(len(c), np.uint32)
    seen = np.zeros(len(c), bool)
    for n in range(1, max(SIZES) + 1):
        k = len(c) - n + 1
        if k <= 0:
            return
        h = h[:k] * np.uint32(0x01000193) ^ c[n - 1:]
        seen = seen[:k] | letter[n - 1:]
        if n in SIZES:
            keep = seen & (row_of[:k] == row_of[n - 1:])
            x = (h[keep] + np.uint32(n)) * np.uint32(0x9E3779B1)
            yield row_of[:k][keep], ((x ^ (x >> np.uint32(15))) % np.uint32(buckets)).astype(np.int64)


def _features(docs: DataFrame, label: str, text: str, buckets: int) -> DataFrame:
    """(label, bucket array, count array) of each text."""
    def run(batches):
        for batch in batches:
            for first, data, offsets in _text.slices(batch.column(1)):
                n = len(offsets) - 1
                keys = [row * buckets + bucket for row, bucket in grams(data, offsets, buckets)]
                key, count = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_counts=True)
                per_row = np.bincount(key // buckets, minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), _text.lists((key % buckets).astype(np.int32), per_row),
                     _text.lists(count.astype(np.int32), per_row)], ["label", "bucket", "n"])

    return docs.select(F.col(label).alias("label"), F.col(text).alias("text")).mapInArrow(
        run, "label string, bucket array<int>, n array<int>")


def _dense(rows: list, at: np.ndarray, buckets: int) -> np.ndarray:
    x = np.zeros((len(at), buckets), np.float32)
    for i, k in enumerate(at):
        bucket, n = rows[k]
        x[i, bucket] = n / max(n.sum(), 1)
    return x


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _known(familiar: np.ndarray, bucket: np.ndarray, n: np.ndarray) -> float:
    return float((familiar[bucket] * n).sum() / max(n.sum(), 1))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[str], s: Settings) -> Model:
    """Fit on (buckets, counts) rows. Every fifth row (in a seeded order) is
    kept for calibration."""
    languages = sorted(set(labels))
    y = np.array([languages.index(x) for x in labels])
    rng = np.random.default_rng(s.seed)
    order = rng.permutation(len(rows))
    held, fit = order[::5], order if len(rows) < 20 else np.delete(order, np.s_[::5])
    embed = rng.normal(0, 0.1, (s.buckets, s.dimensions)).astype(np.float32)
    out = rng.normal(0, 0.3, (s.dimensions, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    squares = [np.full_like(p, 1e-8) for p in (embed, out, bias)]
    for _ in range(s.epochs):
        rng.shuffle(fit)
        for k in range(0, len(fit), 32):
            at = fit[k:k + 32]
            x = _dense(rows, at, s.buckets)
            mean = x @ embed
            g = (_softmax(mean @ out + bias) - np.eye(len(languages), dtype=np.float32)[y[at]]) / len(at)
            used = np.flatnonzero(x.any(axis=0))
            steps = (x[:, used].T @ (g @ out.T), mean.T @ g, g.sum(axis=0))
            for p, q, step, where in zip((embed, out, bias), squares, steps, (used, slice(None), slice(None))):
                q[where] += step * step  # steps shrink where gradients were large
                p[where] -= s.rate * step / np.sqrt(q[where])
    table = embed @ out
    seen = np.zeros((len(languages), s.buckets))
    for k in fit:
        seen[y[k], rows[k][0]] += rows[k][1]
    seen = (seen + 0.5) / (seen.sum(axis=1, keepdims=True) + 0.5 * s.buckets)
    familiar = np.ascontiguousarray(np.log(seen).T.astype(np.float32))
    logits = np.concatenate([_dense(rows, held[k:k + 64], s.buckets) @ table + bias for k in range(0, len(held), 64)])
    scales = np.geomspace(0.05, 5, 60)
    loss = [-np.log(np.maximum(_softmax(logits * t)[np.arange(len(held)), y[held]], 1e-12)).mean() for t in scales]
    t = scales[int(np.argmin(loss))]
    p = _softmax(logits * t)
    best, right = p.max(axis=1), p.argmax(axis=1) == y[held]
    rank = np.argsort(-best, kind="stable")
    precise = np.cumsum(right[rank]) / np.arange(1, len(rank) + 1) >= s.precision
    threshold = 0.0 if precise[-1] else float(best[rank][np.flatnonzero(precise)[-1]]) if precise.any() else 1.0
    guess = p.argmax(axis=1)
    known = np.array([_known(familiar[:, guess[i]], *rows[k]) for i, k in enumerate(held)])
    windows = np.array([rows[k][1].sum() for k in held])
    floor = -np.inf
    good = right & (windows > 0)
    if good.any():
        # Where precision holds for all, texts of no learned language still have to go.
        threshold = max(threshold, min(float(np.quantile(best[good], s.quantile, method="lower")), s.precision))
        floor = float(np.quantile((known + s.spread / np.sqrt(np.maximum(windows, 1)))[good], s.quantile, method="lower")) - s.margin
    return Model(languages, (table * t).astype(np.float32), (bias * t).astype(np.float32), threshold, familiar, floor, s.spread)


def fit(docs: DataFrame, learn: Column, settings: Settings = Settings(), doc_id: str = "doc_id",
        text: str = "text", lang: str = "lang") -> Model | None:
    """Learn from about ``settings.sample`` of the rows where ``learn`` holds
    and text and lang are not null, and about ``settings.each`` of each
    language at least (all of a language with fewer), chosen by a hash of the
    id. Texts are hashed where they are; one task learns from the bounded
    sample and returns the model. None if there is no such row."""
    text_batches(docs.sparkSession)
    rows = docs.where(learn & F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(doc_id).isNotNull())
    cut = sample_cut(rows, doc_id, settings.sample)
    if cut is None:
        return None
    h, per_language = F.xxhash64(doc_id), rows.groupBy(F.col(lang).alias("lang")).agg(F.count(F.lit(1)).alias("n"))
    sizes = per_language.orderBy("n", "lang").limit(settings.sample).collect()
    each = max(1, min(settings.each, settings.sample // max(len(sizes), 1)))
    wanted = h <= cut
    rare = [r.lang for r in sizes if r.n <= each]
    if rare:
        wanted |= F.col(lang).isin(rare)
    for r in sizes:
        # A cut that leaves about ``each`` rows; a frequent language has more by the first cut.
        own = int(each / r.n * 2 ** 64) - 2 ** 63 if r.n > each else cut
        if own > cut:
            wanted |= (F.col(lang) == r.lang) & (h <= own)
    # Of rows that repeat an id the first text in order counts.
    picked = rows.where(wanted).groupBy(F.col(doc_id).alias("id")).agg(F.min(F.struct(F.col(text).alias("text"), F.col(lang).alias("lang"))).alias("r"))

    def learn(batches):
        pairs = [(np.asarray(b.values), np.asarray(n.values), label) for batch in batches
                 for label, b, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2))]
        # The order in which rows come must not matter.
        pairs.sort(key=lambda x: (crc32(x[0].tobytes() + x[1].tobytes()), x[2]))
        return train([x[:2] for x in pairs], [x[2] for x in pairs], settings) if pairs else None

    return fitted(_features(picked.select("r.*"), "lang", "text", settings.buckets), learn)


def _judge(m: Model | None, texts: pa.Array, first: int, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Prediction and confidence of each row of a slice, and whether it is accepted."""
    n = len(offsets) - 1
    if m is None:
        names, best, ok = ["?"] * n, np.zeros(n), np.ones(n, bool)
    else:
        total, count = np.zeros((n, len(m.languages))), np.zeros(n)
        found = list(grams(data, offsets, len(m.table)))
        for row, bucket in found:
            count += np.bincount(row, minlength=n)
            for k in range(len(m.languages)):
                total[:, k] += np.bincount(row, m.table[bucket, k], minlength=n)
        p = _softmax(total / np.maximum(count, 1)[:, None] + m.bias)
        best, guess = p.max(axis=1), p.argmax(axis=1)
        names = [m.languages[k] for k in guess]
        known = np.zeros(n)
        for row, bucket in found:
            known += np.bincount(row, m.familiar[bucket, guess[row]], minlength=n)
        ok = m.accepts(best, known / np.maximum(count, 1), count)
    ascii_letter = (data < 0x80) & (_BORDER[data] != 0x20)
    letters = np.add.reduceat(np.r_[ascii_letter, False].astype(np.int64), offsets[:-1]) * (np.diff(offsets) > 0)
    for i in np.flatnonzero(letters == 0):  # few: only these are looked at as code points
        if not any(c.isalpha() for c in texts[first + int(i)].as_py() or ""):
            names[i], best[i], ok[i] = UNKNOWN, 0.0, False
    return names, best, ok


def predict(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for every row.

    ``score`` is the calibrated probability of the prediction. Null texts and
    texts without any letter get ``und``, score 0 and are rejected; so are
    predictions below the threshold and texts unlike those learned of the
    predicted language. If there was nothing to learn from
    (``model`` None) all get ``und``. Ties go to the first language in sort
    order. Repeated rows and ids give a row each; an empty table an empty
    table; other columns are ignored.
    """
    text_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        for batch in batches:
            for first, data, offsets in _text.slices(batch.column(1)):
                names, best, ok = _judge(m, batch.column(1), first, data, offsets)
                names = [UNKNOWN if m is None else x for x in names]
                rejected = [x == UNKNOWN or not k for x, k in zip(names, ok)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(names)), pa.array(names, pa.string()), pa.array(best, pa.float64()),
                     pa.array(rejected, pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns as they were.

    The decision needs only the row's own text, so nothing is joined: null and
    empty texts go, as do all without a letter; long texts are judged whole;
    repeated rows stay or go together; ids and other columns do not matter.
    Without a model (nothing to learn from) only texts without a letter go. An
    empty table gives an empty table."""
    text_batches(docs.sparkSession)
    at, names = docs.columns.index(text), docs.columns
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            found = [_judge(sent.value, batch.column(at), first, data, offsets) for first, data, offsets in _text.slices(batch.column(at))]
            keep = [bool(k) for _, _, ok in found for k in ok]
            yield pa.RecordBatch.from_arrays(batch.columns, names).filter(pa.array(keep, pa.bool_()))

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, fields)
