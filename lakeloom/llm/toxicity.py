"""Toxicity by noisy-channel deobfuscation.

1. A character trigram model is counted over all texts.
2. A stretch of text that may be obfuscated (digits or symbols among letters or
   instead of all of them, letters written twice or more, letters spaced out by
   any white space, a word parted by a blank) becomes a lattice: every character
   may stand for itself, for the letter it looks like, or for nothing, a blank
   for a border or for nothing, at a channel cost. The Viterbi path under the
   trigram model gives the restored words. Plain words have one path and are
   taken as they are.
3. Restored words and their beginnings are looked up in a lexicon of log odds
   learned from labelled rows; a logistic model on a document's hits gives the
   score. Both are fitted on separate halves of a bounded labelled sample.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm import _text
from lakeloom.llm._io import sample_cut, staged, text_batches

# What a character may stand for, besides itself.
LOOKALIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
             "@": "a", "$": "s", "!": "i", "#": "h", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "¥": "y"}
#: costs in nats: a look-alike, a separator or symbol that is noise, a digit
#: kept as it is, a letter that repeats the one before it, a blank that is noise
SWAP, NOISE, DIGIT, REPEAT, BLANK = 1.0, 1.5, 3.0, 0.5, 0.5
OTHER = 27  # letters beyond a-z; 0 is the border
STATES = 28
_PLAIN = re.compile(r"[^\W\d_]+\Z")
_STRETCHED = re.compile(r"(.)\1\1|(.)\2.*(.)\3")  # a letter three times, or two doubled ones
_REPEATED = re.compile(r"(.)\1+")
_EDGE = re.compile(r"(?:([^\w\s])\1+|[.,;:?!\"'`)\]}>%&#*^~_=-])+\Z|\A(?:([^\w\s])\2+|[.,;:?\"'`(\[{<%&#*^~_=-])+")
_SPACED = re.compile(r"(?<!\S)(?:\S\s+){2,}\S(?!\S)")
_LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Settings:
    """``sample``: most labelled rows that are learned from."""

    sample: int = 8000
    least_docs: int = 4
    least_odds: float = 2.0
    heads: tuple[int, ...] = (3, 4, 5, 6, 7)
    lexicon: int = 5000


@dataclass(frozen=True)
class Model:
    cost: np.ndarray  # trigram model: -log p(third | first two)
    lexicon: dict[str, float]
    weights: np.ndarray  # logistic, on features()


# -- the character model ----------------------------------------------------

def _letter_class(c: str) -> int:
    """1 to 26 for a to z and their accented forms, OTHER for other letters,
    else 0; the same for counting and for decoding."""
    if "a" <= c <= "z":
        return ord(c) - 96
    base = unicodedata.normalize("NFKD", c)[0] if c.isalpha() else ""
    return (ord(base) - 96 if "a" <= base <= "z" else OTHER) if c.isalpha() else 0


@cache
def class_table() -> np.ndarray:
    """The class of every code point below U+10000, lower-cased; there are few
    letters beyond, they count as borders."""
    return np.array([_letter_class(chr(k).lower()[:1]) for k in range(1 << 16)], np.int64)


def _classes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of every code point of UTF-8 bytes, and each row's first one."""
    if not len(data) or data.max() < 0x80:
        return class_table()[data], offsets
    starts = np.flatnonzero(data & 0xC0 != 0x80)
    wide = np.r_[data, np.zeros(3, np.uint8)].astype(np.int64)
    b, c, d = (wide[starts + k] for k in range(3))
    point = np.select([b < 0x80, b < 0xE0, b < 0xF0], [b, (b & 31) << 6 | c & 63, (b & 15) << 12 | (c & 63) << 6 | d & 63], 0)
    return class_table()[point], np.searchsorted(starts, offsets)


def char_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(gram, n): trigrams of letter classes within words and their borders
    over all texts; a task sends one row a trigram at most."""
    def run(batches):
        total = np.zeros(STATES ** 3, np.int64)
        for batch in batches:
            for _, data, offsets in _text.slices(batch.column(0)):
                found, first = _classes(data, offsets)
                c = np.zeros(len(found) + len(first) + 1, np.int64)  # a border between texts
                c[np.arange(len(found)) + np.repeat(np.arange(len(first) - 1), np.diff(first)) + 1] = found
                c = np.r_[0, c[np.r_[True, (c[1:] != 0) | (c[:-1] != 0)]]]  # one border between words
                # A word begins after two borders, whatever stood before it.
                gram = (np.where(c[1:-1] == 0, 0, c[:-2]) * STATES + c[1:-1]) * STATES + c[2:]
                total += np.bincount(gram, minlength=STATES ** 3)
        total[0] = 0
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["gram", "n"])

    return docs.select(text).mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def char_model(counts: DataFrame) -> np.ndarray:
    """-log p(c | a, b), interpolated with p(c | b); at most STATES**3 rows."""
    n = np.zeros(STATES ** 3)
    for row in counts.toLocalIterator():
        n[row.gram] = row.n
    n = n.reshape(STATES, STATES, STATES)
    two = n.sum(axis=0) + 0.1
    two /= two.sum(axis=1, keepdims=True)
    three = (n + 5 * two[None]) / (n.sum(axis=2, keepdims=True) + 5)
    return -np.log(three)


# -- the decoder ------------------------------------------------------------

def _arcs(token: str) -> list[list[tuple[str, int, float]]]:
    """For each character, (emitted, class, channel cost)."""
    out = []
    for i, c in enumerate(token):
        if c.isalpha():
            arcs = [(c, _letter_class(c), 0.0)]
            run = 1
            while i - run >= 0 and token[i - run] == c:
                run += 1
            if run > 1:  # a repeated letter: any but the first may go, the second may stay
                arcs = [("", 0, REPEAT)] + ([(c, _letter_class(c), 0.0)] if run == 2 else [])
        elif c.isspace():
            arcs = [(" ", 0, 0.0), ("", 0, BLANK)]
        else:
            arcs = [(x, ord(x) - 96, SWAP) for x in LOOKALIKE.get(c, "")]
            arcs.append((c, 0, DIGIT) if c.isdigit() else ("", 0, NOISE))
        out.append(arcs)
    return out


def decode(token: str, cost: np.ndarray) -> str:
    """The cheapest reading of a lower-cased stretch: channel plus trigrams,
    borders included. A blank that is a border ends a word. Linear in the
    length; ties go to the first arc."""
    best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for arcs in _arcs(token):
        new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (total, path) in best.items():
            for emitted, c, extra in arcs:
                if emitted == " ":
                    key, value, way = (0, 0), total + extra + (cost[a, b, 0] if (a, b) != (0, 0) else 0.0), (emitted, path)
                elif emitted:
                    key, value, way = (b, c), total + extra + cost[a, b, c], (emitted, path)
                else:
                    key, value, way = (a, b), total + extra, path
                if key not in new or value < new[key][0]:
                    new[key] = (value, way)
        best = new
    _, path = min(((t + (cost[a, b, 0] if (a, b) != (0, 0) else 0.0), p) for (a, b), (t, p) in best.items()), key=lambda x: x[0])
    out = []
    while path is not None:
        out.append(path[0])
        path = path[1]
    return "".join(reversed(out))


def readings(token: str, cost: np.ndarray, doubled: bool = False) -> list[str]:
    """Words that a lower-cased token may hold: one if it is plain, else also
    its restored form and its pieces between symbols. Doubled letters are
    common in plain words: one alone is looked at with ``doubled`` only. A token
    of symbols and digits is read if each looks like a letter and some are no
    digits, so numbers stay numbers."""
    core = token if _PLAIN.match(token) else _EDGE.sub("", token)
    if _PLAIN.match(core):
        stretched = _STRETCHED.search(core) or doubled and _REPEATED.search(core)
        return list(dict.fromkeys([core, decode(core, cost)])) if stretched else [core]
    if not any(map(str.isalpha, core)):
        core = token.strip(".,;:?")
        if len(core) < 3 or core.isdigit() or not all(c in LOOKALIKE for c in core):
            return []
    pieces = _LETTERS.findall(core)
    restored = _LETTERS.findall(decode(core, cost))
    return list(dict.fromkeys(pieces + restored))


# -- words of a document ----------------------------------------------------

def tokens(text: str) -> tuple[list[str], str, list[str]]:
    """Lower-cased tokens in order, the lower-cased text, and its stretches of
    single characters with white space between them, three letters at least."""
    low = text.lower()
    spaced = [" ".join(run.split()) for run in _SPACED.findall(low)]
    return low.split(), low, [run for run in spaced if sum(map(str.isalpha, run)) >= 3]


def spaced_words(run: str, cost: np.ndarray) -> list[str]:
    """Words of a stretch of single characters."""
    return [w for w in _LETTERS.findall(decode(run, cost)) if len(w) > 1]


def features(word: str, heads: tuple[int, ...]) -> list[str]:
    """A word and its beginnings."""
    return [word, *(word[:k] + "^" for k in heads if len(word) > k)]


class Scorer:
    """Weights of tokens. Most tokens are plain words whose first letters begin
    no lexicon entry: they weigh nothing and are not looked at again. Weights
    of the others are kept for tokens that come again (bounded)."""

    KEPT = 200_000
    PAIRS = [c * 2 for c in "abcdefghijklmnopqrstuvwxyz"]
    RIGHT, LEFT = ".,;:?!\"'`)]}>%&#*^~_=-", ".,;:?\"'`([{<%&#*^~_=-"

    def __init__(self, model: Model, heads: tuple[int, ...]):
        self.model, self.heads, self.known = model, heads, {}
        short = min(heads)
        self.begin = {f.rstrip("^")[:short] for f in model.lexicon}
        self.begin_once = {_REPEATED.sub(r"\1", f.rstrip("^"))[:short] for f in model.lexicon}
        self.whole = {f for f in model.lexicon if not f.endswith("^")}

    def _of_words(self, words: list[str]) -> float:
        return max((self.model.lexicon.get(f, 0.0) for w in words for f in features(w, self.heads)), default=0.0)

    def weight(self, token: str) -> float:
        found = self.known.get(token)
        if found is None:
            found = self._of_words(readings(token, self.model.cost, doubled=True))
            if len(self.known) >= self.KEPT:
                self.known.clear()
            self.known[token] = found
        return found

    def parted(self, a: str, b: str) -> float:
        """Weight of a word of the lexicon that a blank parts, if the lattice
        takes the blank for noise."""
        word = a + b
        return self._of_words([word]) if word in self.whole and decode(f"{a} {b}", self.model.cost) == word else 0.0

    def document(self, text: str | None) -> tuple[float, float, float, float]:
        """(1, log of hits, highest weight, hits per hundred words)."""
        hits, top = 0, 0.0
        words, low, spaced = tokens(text or "")
        found = Counter(words)
        repeated = any(t in low for t in self.PAIRS)
        begin, once, k, right, left = self.begin, self.begin_once, min(self.heads), self.RIGHT, self.LEFT
        weights = []
        for token, count in found.items():
            core = token.rstrip(right).lstrip(left)
            if core[:k] not in begin and (core.isalpha() or not core):
                if not repeated or not core or not _REPEATED.search(core) or _REPEATED.sub(r"\1", core)[:k] not in once:
                    continue
            weights.append((self.weight(token), count))
        for a, b in zip(words, words[1:]):
            if len(a) <= k and (a + b)[:k] in begin and len(a) + len(b) > k:
                weights.append((self.parted(a.lstrip(left), b.rstrip(right)), 1))
        weights.extend((self._of_words([w]), 1) for run in spaced for w in spaced_words(run, self.model.cost))
        for w, count in weights:
            if w:
                hits += count
                top = max(top, w)
        return 1.0, float(np.log1p(hits)), top, min(10.0, 100 * hits / max(len(words), 50))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-3, *[0.1] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _sample(docs: DataFrame, labels: DataFrame, learn: Column, s: Settings, doc_id: str, text: str) -> DataFrame | None:
    """(toxic, half, text) of at most ``s.sample`` labelled rows."""
    marked = (labels.where(learn & F.col(doc_id).isNotNull() & F.col("toxic").isin(0, 1))
              .select(F.col(doc_id).cast("long").alias("__id"), F.col("toxic").cast("int").alias("toxic")))
    cut = sample_cut(marked, "__id", s.sample)
    if cut is None:
        return None
    picked = marked.where(F.xxhash64("__id") <= cut).groupBy("__id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select(F.col(doc_id).cast("long").alias("__doc"), F.col(text).alias("text")).where("text is not null")
    # read three times from here on, so that the documents are not
    return staged(rows.join(F.broadcast(picked), F.col("__doc") == F.col("__id")).select(
        "toxic", F.pmod(F.xxhash64("__id", F.lit(1)), F.lit(4)).alias("part"), "text"), "toxic-sample")


def fit(docs: DataFrame, labels: DataFrame, learn: Column, s: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> Model:
    """Character model over all ``docs``; lexicon and logistic from the rows
    of ``labels`` (doc_id, toxic) where ``learn`` holds. Of repeated labels of
    an id, toxic counts. Without any label all scores are the prior 0.5."""
    text_batches(docs.sparkSession)
    cost = char_model(char_counts(docs, text))
    empty = Model(cost, {}, np.zeros(4))
    sample = _sample(docs, labels, learn, s, doc_id, text)
    if sample is None:
        return empty

    def words(batches):
        for batch in batches:
            total: dict[str, list[int]] = {}
            toxic = batch.column(0).to_pylist()
            for y, t in zip(toxic, batch.column(1)):
                single, _, spaced = tokens(t.as_py())
                restored = [w for token in set(single) for w in readings(token, cost)] + [w for run in spaced for w in spaced_words(run, cost)]
                for f in {f for w in restored for f in features(w, s.heads)}:
                    total.setdefault(f, [0, 0])[y] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), *(pa.array([v[i] for v in total.values()], pa.int64()) for i in (0, 1))], ["f", "n0", "n1"])

    size = {r.toxic: r.n for r in sample.where("part != 0").groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not size.get(0) or not size.get(1):
        return empty
    each = sample.where("part != 0").select("toxic", "text").mapInArrow(words, "f string, n0 long, n1 long")
    odds = F.log((F.col("n1") + 0.5) / (size[1] + 1)) - F.log((F.col("n0") + 0.5) / (size[0] + 1))
    sure = odds / F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
    picked = (each.groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where(F.col("n1") >= s.least_docs)
              .select("f", odds.alias("odds"), sure.alias("sure")).where((F.col("odds") >= s.least_odds) & (F.col("sure") >= 3))
              .orderBy(F.desc("sure"), "f").limit(s.lexicon).collect())  # bounded by the lexicon
    model = Model(cost, {r.f: float(r.odds) for r in picked}, np.zeros(4))

    def profile(batches):
        scorer = Scorer(model, s.heads)
        for batch in batches:
            x = [scorer.document(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["y", "x"])

    got = sample.where("part = 0").select("toxic", "text").mapInArrow(profile, "y int, x array<double>").toArrow()  # bounded by the sample
    if not got.num_rows:
        return empty
    x = np.array(got["x"].to_pylist())
    order = np.lexsort(x.T)
    return Model(cost, model.lexicon, _logistic(x[order], np.array(got["y"].to_pylist(), float)[order]))


def score(docs: DataFrame, model: Model, s: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row; texts are scored whole.

    Null and empty texts have no words and get the score of a text without
    hits. Repeated rows and null ids keep a row each; an empty table gives an
    empty table; other columns are ignored.
    """
    text_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        scorer = Scorer(m, s.heads)
        for batch in batches:
            x = np.array([scorer.document(t.as_py()) for t in batch.column(1)]).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(x @ m.weights, -30, 30))))], ["doc_id", "score"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, score double")
