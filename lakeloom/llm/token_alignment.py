"""Alignment of the tokens of two tokenizers over the same bytes.

Tokenizer A is byte-level BPE, tokenizer B a sentence-piece model. Both split
blank + text into tokens with known bytes. The cumulative ends of each list go
into a dictionary end -> index; the ends that are keys of both, sorted, slice
the two id lists into groups, and every slice gives its links: the pairs of an
A and a B token that end together.

Neither tokenizer has a token across a single blank between non-blank
characters, so both lists end there and the alignment of a text is that of its
chunks one after the other: a chunk is aligned once and remembered. A text with
a chunk whose bytes do not come back is encoded and aligned as a whole.

How often an id pair is linked in the whole corpus decides which links are
best. The links of each text are stored as (pair, times); pairs are summed over
all texts. The most frequent pairs (a bounded table) are sent to the tasks;
links of all rarer pairs, of which each has few by definition, are joined by
shuffle. Both ways together see every link.
"""

from __future__ import annotations

import hashlib
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm import _text, _vocab
from lakeloom.llm._io import staged, text_batches

#: most id pairs that are sent to the tasks (12 bytes each, and a mark)
SENT_PAIRS = 1_000_000
#: values of pair arrays that a task holds at once
BLOCK_VALUES = 1 << 20
#: columns of a text's own row
OWN = ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
OWN_KINDS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def byte_level_table(made) -> list[bytes | None]:
    """Bytes of every A token: byte-level vocabularies write each byte as a
    printable character, the printable bytes as themselves and the others, in
    order, from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}
    table: list[bytes | None] = [None] * made.get_vocab_size(with_added_tokens=True)
    for token, k in made.get_vocab(with_added_tokens=True).items():
        if all(c in byte_of for c in token):
            table[k] = bytes(byte_of[c] for c in token)
    return table


def piece_table(made) -> list[bytes]:
    """Bytes of every B piece: U+2581 is a blank, <0xHH> the byte HH."""
    pieces = [made.id_to_piece(k) for k in range(made.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if made.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]


class Part(NamedTuple):
    """The alignment of a chunk: groups as ``a1,a2|b1;a3|b2`` and packed links
    (a << 32 | b)."""

    n_a: int
    n_b: int
    n_groups: int
    text: str
    links: bytes


#: chunks whose token bytes are not those of the text
DIFFERENT = Part(-1, -1, -1, "", b"")
NOTHING = Part(0, 0, 0, "", b"")


def common_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends that both lists have, sorted, and the number of A and B tokens up
    to each: a hash-set intersection over end -> index dictionaries."""
    a_at, b_at = dict(zip(a_ends.tolist(), count(1))), dict(zip(b_ends.tolist(), count(1)))
    common = sorted(a_at.keys() & b_at.keys())
    after = lambda table: np.fromiter(map(table.__getitem__, common), np.int64, len(common))
    return np.array(common, np.int64), after(a_at), after(b_at)


class Aligner:
    """Both tokenizers in a task."""

    def __init__(self, a_raw: bytes, b_raw: bytes):
        self.a, self.b = _vocab.tokenizer(a_raw, plain_specials=True), _vocab.pieces(b_raw)
        self.a_table, self.b_table = byte_level_table(self.a), piece_table(self.b)
        self.a_size, self.b_size = (np.array([len(t or b"") for t in table], np.int64) for table in (self.a_table, self.b_table))
        # each id as text before a comma and before the sign that ends its side of a group
        self.a_text, self.b_text = (np.array([[f"{k}," for k in range(len(t))], [f"{k}{end}" for k in range(len(t))]], object)
                                    for t, end in ((self.a_table, "|"), (self.b_table, ";")))
        self.known = _vocab.Memory(self.several)

    def align(self, text: str, ends: np.ndarray) -> list[Part] | None:
        """Parts of a text that is cut after the bytes ``ends`` of blank +
        text. None where the bytes of a token list are not blank + text, or
        tokens do not end at all cuts."""
        a_ids = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        b_ids, whole = self.b.encode(text, num_threads=1), b" " + text.encode()
        a_bytes, b_bytes = list(map(self.a_table.__getitem__, a_ids)), list(map(self.b_table.__getitem__, b_ids))
        if not all(a_bytes) or not all(b_bytes) or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            return None
        a, b = np.array(a_ids, np.int64), np.array(b_ids, np.int64)
        common, p, q = common_ends(np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]))
        cut = np.searchsorted(common, ends, "right")  # groups up to each cut
        if not len(common) or not np.array_equal(common[np.maximum(cut, 1) - 1], ends):
            return None
        # Every token has bytes, so of a slice only the last A and the last B token end together.
        links = a[p - 1] << 32 | b[q - 1]
        n_a, n_b = np.diff(p, prepend=0), np.diff(q, prepend=0)
        group_a, group_b = np.repeat(np.arange(len(p)), n_a), np.repeat(np.arange(len(q)), n_b)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[p - 1] = last_b[q - 1] = 1
        written = np.empty(len(a) + len(b), object)  # group by group, A before B
        written[np.arange(len(a)) + (q - n_b)[group_a]] = self.a_text[last_a, a]
        written[np.arange(len(b)) + p[group_b]] = self.b_text[last_b, b]
        p, q = np.r_[0, p][np.r_[0, cut]].tolist(), np.r_[0, q][np.r_[0, cut]].tolist()
        cut, links, written = [0, *cut.tolist()], links.tobytes(), written.tolist()
        return [Part(p[k + 1] - p[k], q[k + 1] - q[k], cut[k + 1] - cut[k], "".join(written[p[k] + q[k]:p[k + 1] + q[k + 1]])[:-1],
                     links[8 * cut[k]:8 * cut[k + 1]]) for k in range(len(ends))]

    def part(self, text: str) -> Part:
        found = self.align(text, np.array([1 + len(text.encode())])) if text else [NOTHING]
        return found[0] if found else DIFFERENT

    def several(self, chunks: list[str]) -> list[Part]:
        """The parts of chunks: as one text, chunk by blank by chunk, if all
        their bytes come back; else halves of them."""
        whole = [c for c in chunks if c and not c[0].isspace() and not c[-1].isspace()]
        if len(chunks) == 1 or len(whole) < len(chunks):
            joined = dict(zip(whole, self.several(whole))) if whole and len(chunks) > 1 else {}
            return [joined[c] if c in joined else self.part(c) for c in chunks]
        found = self.align(" ".join(chunks), np.cumsum([1 + len(c.encode()) for c in chunks]))
        half = len(chunks) // 2
        return found or [*self.several(chunks[:half]), *self.several(chunks[half:])]

    def __call__(self, texts: pa.Array) -> tuple[list[Part], np.ndarray, np.ndarray]:
        """Parts, the number of the part of each chunk, and each text's first
        chunk. Texts without tokens have one part without anything."""
        texts = texts.fill_null("")
        chunks, at, row = _vocab.numbered(_vocab.inner_chunks(texts))
        parts = self.known.values(chunks.to_pylist())
        odd = np.array([p is DIFFERENT for p in parts], bool)
        if not odd.any():
            return parts, at, row
        parts, lists = list(parts), []
        for k in range(len(texts)):
            here = at[row[k]:row[k + 1]]
            if odd[here].any():  # such a text is looked at as a whole
                whole = self.part(texts[k].as_py())
                parts.append(NOTHING if whole is DIFFERENT else whole)
                here = np.array([len(parts) - 1])
            lists.append(here)
        return parts, np.concatenate(lists), np.cumsum([0, *map(len, lists)])


def _aligner(a_raw, b_raw) -> Aligner:
    return _vocab.kept("alignment", [a_raw.value, b_raw.value], lambda: Aligner(a_raw.value, b_raw.value))


def _slices(batch: pa.RecordBatch):
    for first in range(0, len(batch), 256):
        yield batch.slice(first, 256)


def alignments(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs array<long>,
    times array<int>) of every text."""
    text_batches(docs.sparkSession)
    a_raw, b_raw = _vocab.vocabulary(docs.sparkSession, a_path), _vocab.vocabulary(docs.sparkSession, b_path)

    def run(batches):
        aligner = _aligner(a_raw, b_raw)
        for batch in (s for b in batches for s in _slices(b)):
            parts, at, row = aligner(batch.column(1))
            numbers = np.array([p[:3] for p in parts], np.int64).reshape(-1, 3)[at]
            sums = np.add.reduceat(numbers, row[:-1], axis=0) if len(batch) else numbers
            written = np.array([p.text for p in parts], object)[at]
            offsets = np.cumsum([0, *(len(p.links) // 8 for p in parts)])
            links = _vocab.gathered(np.frombuffer(b"".join(p.links for p in parts), np.int64), offsets, at)
            ends = np.r_[0, np.cumsum(np.diff(offsets)[at])][row]
            hashes, pairs, times = [], [], []
            for k in range(len(batch)):
                hashes.append(hashlib.sha256(";".join(written[row[k]:row[k + 1]].tolist()).encode()).hexdigest() if sums[k, 0] else "")
                pair, n = np.unique(links[ends[k]:ends[k + 1]], return_counts=True)
                pairs.append(pair)
                times.append(n.astype(np.int32))
            size = np.array([len(p) for p in pairs], np.int64)
            flat = (np.concatenate(pairs), np.concatenate(times)) if pairs else (np.zeros(0, np.int64), np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(sums[:, k]) for k in range(3)), pa.array(np.diff(ends)), pa.array(hashes, pa.string()),
                 _text.lists(flat[0], size), _text.lists(flat[1], size)],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>")


def groups(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, groups array<string>): the groups themselves, in order, each
    ``a1,a2|b1`` in decimal ids."""
    text_batches(docs.sparkSession)
    a_raw, b_raw = _vocab.vocabulary(docs.sparkSession, a_path), _vocab.vocabulary(docs.sparkSession, b_path)

    def run(batches):
        aligner = _aligner(a_raw, b_raw)
        for batch in (s for b in batches for s in _slices(b)):
            parts, at, row = aligner(batch.column(1))
            found = [[g for k in at[x:y] if parts[k].text for g in parts[k].text.split(";")] for x, y in zip(row[:-1], row[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], ["doc_id", "groups"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, groups array<string>")


def _blocks(batch: pa.RecordBatch, pairs: int):
    """Slices of a batch with about BLOCK_VALUES pairs: (first row, number of
    rows, row of each value, pairs, times)."""
    offsets = np.asarray(batch.column(pairs).offsets).astype(np.int64)
    first, n = 0, len(batch)
    while first < n:
        last = min(n, max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK_VALUES, "right")) - 1))
        cut = slice(offsets[first], offsets[last])
        row = np.repeat(np.arange(last - first), np.diff(offsets[first:last + 1]))
        yield first, last - first, row, np.asarray(batch.column(pairs).values)[cut], np.asarray(batch.column(pairs + 1).values)[cut]
        first = last


def pair_counts(table: DataFrame) -> DataFrame:
    """(pair, n, best): links of each id pair in the whole corpus, and whether
    no other pair of its B id has more. Tasks sum their blocks first."""
    def run(batches):
        for batch in batches:
            for _, _, _, pairs, times in _blocks(batch, 0):
                pair, at = np.unique(pairs, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(np.bincount(at, times, len(pair)).astype(np.int64))], ["pair", "n"])

    counts = table.select("pairs", "times").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    # The rows of a B id are its different partners: at most A's vocabulary.
    of_b = Window.partitionBy(F.col("pair").bitwiseAND((1 << 32) - 1))
    return counts.withColumn("best", F.col("n") == F.max("n").over(of_b))


def align_corpus(docs: DataFrame, a_path: str, b_path: str, sent: int = SENT_PAIRS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256.

    Texts that are null or empty, or whose token bytes are not blank + text,
    have no tokens: zeros and ''. Null ids and repeated rows keep a row each
    and count each. An empty table gives an empty table; other columns are
    ignored. ``sent``: most id pairs that go to the tasks; the result does not
    depend on it.
    """
    spark = docs.sparkSession
    table = staged(alignments(docs, a_path, b_path, doc_id, text).withColumn("row", F.monotonically_increasing_id()), "alignments")
    counts = staged(pair_counts(table), "pairs")
    # The smallest count of which all pairs fit; of ``sent`` + 1 different counts one is too many.
    over = counts.groupBy("n").agg(F.count(F.lit(1)).alias("pairs")).orderBy(F.desc("n")).limit(sent + 1).toArrow()
    fits = np.cumsum(np.asarray(over["pairs"])) <= sent if len(over) else np.zeros(0, bool)
    rare = not fits.all()
    least = int(np.asarray(over["n"])[fits].min()) if fits.any() else None
    top = counts.where(F.lit(False) if least is None else F.col("n") >= least).toArrow()
    order = np.argsort(np.asarray(top["pair"]))
    shared = spark.sparkContext.broadcast(tuple(np.asarray(top[c].combine_chunks() if c != "best" else top[c].cast(pa.int8()).combine_chunks())[order]
                                                for c in ("pair", "n", "best")))

    def run(batches):
        pair, n, best = shared.value
        for batch in batches:
            for first, rows, row, pairs, times in _blocks(batch, batch.num_columns - 2):
                at = np.minimum(np.searchsorted(pair, pairs), max(len(pair) - 1, 0))
                hit = pair[at] == pairs if len(pair) else np.zeros(len(pairs), bool)
                at, t, r = at[hit], times[hit].astype(np.int64), row[hit]
                total, good = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
                np.add.at(total, r, n[at] * t)
                np.add.at(good, r, best[at] * t)
                left = np.bincount(row[~hit], minlength=rows)
                kept = [c.slice(first, rows) for c in batch.columns[:-2]]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(good), pa.array(total), _text.lists(pairs[~hit], left), _text.lists(times[~hit], left)],
                                                 [*OWN, "n_best", "count_sum", "pairs", "times"])

    out = table.select(*OWN, "pairs", "times").mapInArrow(run, f"{OWN_KINDS}, n_best long, count_sum long, pairs array<long>, times array<int>")
    if rare:
        out = staged(out, "link-sums")
        each = out.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("t"))
        few = each.join(counts.where(F.lit(True) if least is None else F.col("n") < least), "pair")
        more = few.groupBy(F.col("row").alias("of")).agg(F.sum(F.col("n") * F.col("t")).alias("more_sum"),
                                                         F.sum(F.when(F.col("best"), F.col("t")).otherwise(0)).alias("more_best"))
        out = out.join(more, F.col("row") == F.col("of"), "left")
        for c, plus in (("n_best", "more_best"), ("count_sum", "more_sum")):
            out = out.withColumn(c, (F.col(c) + F.coalesce(plus, F.lit(0))).cast("long"))
    return out.select(*OWN[1:6], "n_best", "count_sum", "groups_sha256")
