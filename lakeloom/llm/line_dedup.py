"""Line dedup with two Bloom filters.

Pass 1 builds, on the executors, two Bloom filters over line hashes: one of
hashes seen in some document, one of hashes seen again in another. Partial
filters merge associatively (``again = again_a | again_b | (once_a &
once_b)``), so they are built per task and merged per filter shard. Pass 2
shuffles only the lines that hit the second filter; they are counted exactly
by a 128-bit digest and the keeper is chosen. Pass 3 removes the lines.

The filters have about ``BITS_PER_LINE`` bits a line up to ``MAX_FILTER_MB``
together, which bounds what is sent to the tasks. Beyond that they fill up and
let more once-seen lines pass to the exact count: more rows shuffle, the
result is the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm._io import join_by_weight, staged, text_batches, unused

WHITE = " \t\n\x0b\x0c\r"
BITS_PER_LINE = 16
MAX_FILTER_MB = 64
SHARD_BITS = 20  # a shard has 2**20 bits (128 KB)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def line_key(line: str, min_chars: int) -> bytes | None:
    """The line without ASCII white space at both ends, A-Z lower-cased, as
    UTF-8 (where a byte table folds case); None if it is too short."""
    line = line.strip(WHITE)
    return line.encode("utf-8", "surrogatepass").translate(_LOWER) if len(line) >= min_chars else None


def _parts(batch: pa.RecordBatch, rows: int = 500):
    """A batch in pieces, so that few texts are Python strings at once."""
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)


def _digests(text: str | None, min_chars: int) -> set[bytes]:
    """128-bit digests of a text's distinct keys of ``min_chars`` or more."""
    if not text or len(text) < min_chars:
        return set()
    return {xxhash.xxh3_128_digest(k) for line in text.split("\n") if (k := line_key(line, min_chars))}


def _flat(texts: pa.Array, min_chars: int) -> tuple[list[bytes], list[int]]:
    """The digests of several texts in a row, and how many each text has."""
    each = [_digests(t, min_chars) for t in texts.to_pylist()]
    return [x for d in each for x in d], [len(d) for d in each]


def _bits(low: np.ndarray, high: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit places (as one global index each) in the same shard."""
    mask, shards = np.uint64((1 << SHARD_BITS) - 1), np.uint64(max(1, bits >> SHARD_BITS))
    base = (high % shards) << np.uint64(SHARD_BITS)
    return base | (low & mask), base | ((low >> np.uint64(24)) & mask)


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _hit(table: np.ndarray, *places: np.ndarray) -> np.ndarray:
    """Whether all given bits of each key are set."""
    out = np.ones(len(places[0]), bool)
    for x in places:
        out &= ((table[(x >> np.uint64(3)).astype(np.int64)] >> (x & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
    return out


def _set(table: np.ndarray, *places: np.ndarray) -> None:
    for x in places:
        np.bitwise_or.at(table, (x >> np.uint64(3)).astype(np.int64),
                         np.left_shift(np.uint8(1), (x & np.uint64(7)).astype(np.uint8)))


def filter_bits(lines: int) -> int:
    """Bits of each filter for so many lines: a power of two, bounded."""
    want = max(1 << SHARD_BITS, lines * BITS_PER_LINE)
    return min(1 << (want - 1).bit_length(), MAX_FILTER_MB << 22)  # two filters share the bound


def build_filter(docs: DataFrame, min_chars: int, text: str = "text") -> tuple[np.ndarray, int]:
    """The twice-seen filter as bytes, and its bits."""
    text_batches(docs.sparkSession)
    upper = docs.agg(F.sum(F.length(text))).first()[0] or 0
    bits = filter_bits(int(upper) // (4 * min_chars))
    shard_bytes = 1 << (SHARD_BITS - 3)

    def partial(batches):
        once, again = np.zeros(bits >> 3, np.uint8), np.zeros(bits >> 3, np.uint8)
        for batch in batches:
            for part in _parts(batch):
                found, _ = _flat(part.column(0), min_chars)
                if found:
                    low, high = _halves(found)
                    order = np.lexsort((low, high))
                    low, high = low[order], high[order]
                    new = np.r_[True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])]
                    repeated = np.add.reduceat(np.ones(len(low), np.int64), np.flatnonzero(new)) > 1
                    a, b = _bits(low[new], high[new], bits)
                    seen = repeated | _hit(once, a, b)
                    _set(again, a[seen], b[seen])
                    _set(once, a, b)
        for k in range(bits >> SHARD_BITS):
            o, a = (x[k * shard_bytes:(k + 1) * shard_bytes] for x in (once, again))
            at = np.flatnonzero(o)  # only the bytes in use travel
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), *(pa.array([x.tobytes()]) for x in (at.astype(np.int32), o[at], a[at]))],
                    ["shard", "place", "once", "again"])

    def merge(batches):
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for k, at, o, a in zip(*(c.to_pylist() for c in batch.columns)):
                at, o, a = np.frombuffer(at, np.int32), np.frombuffer(o, np.uint8), np.frombuffer(a, np.uint8)
                once, again = kept.setdefault(k, (np.zeros(shard_bytes, np.uint8), np.zeros(shard_bytes, np.uint8)))
                again[at] |= a | (once[at] & o)
                once[at] |= o
        for k, (_, a) in kept.items():
            if a.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([a.tobytes()])], ["shard", "again"])

    shards = (docs.select(F.col(text)).mapInArrow(partial, "shard int, place binary, once binary, again binary")
              .repartition("shard").mapInArrow(merge, "shard int, again binary"))
    out = np.zeros(bits >> 3, np.uint8)
    for row in shards.toLocalIterator():  # bounded by MAX_FILTER_MB
        out[row.shard * shard_bytes:(row.shard + 1) * shard_bytes] = np.frombuffer(row.again, np.uint8)
    return out, bits


def repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(digest binary, keeper id) of keys of ``min_chars`` code points or more
    found in ``min_docs`` or more different ids; the keeper is the largest."""
    suspects = suspected(docs, min_chars, doc_id, text)
    return _confirmed(suspects, min_docs)


def suspected(docs: DataFrame, min_chars: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest) of the lines that hit the twice-seen filter."""
    table, bits = build_filter(docs, min_chars, text)
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def scan(batches):
        again = sent.value
        for batch in batches:
            for part in _parts(batch.filter(batch.column(0).is_valid())):
                found, n = _flat(part.column(1), min_chars)
                hit = _hit(again, *_bits(*_halves(found), bits)) if found else np.zeros(0, bool)
                ids = np.repeat(np.asarray(part.column(0)), n)
                yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array([x for x, h in zip(found, hit) if h], pa.binary())],
                                                 ["doc_id", "digest"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        scan, "doc_id long, digest binary")


def _confirmed(suspects: DataFrame, min_docs: int) -> DataFrame:
    # Ids are made distinct first, so that a line which a third of all
    # documents hold is reduced in each task before and after the shuffle.
    return (suspects.select("digest", "doc_id").distinct()
            .groupBy("digest").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
            .where(F.col("n_docs") >= min_docs))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5,
                doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated lines removed, plus ``n_lines`` (before) and
    ``n_dropped``.

    Lines are split at ``\\n`` only. A null or empty text is one empty line
    and comes back as an empty text. A null id never counts as a document and
    keeps its lines. Repeated ids count as one document; the keeper keeps all
    its copies of the line. An empty table gives an empty table. Other
    columns pass through; input columns named like the two new ones are replaced.
    """
    docs = docs.drop(*(c for c in ("n_lines", "n_dropped") if c not in (doc_id, text)))
    suspects = staged(suspected(docs, min_chars, doc_id, text), "lines")
    confirmed = staged(_confirmed(suspects, min_docs), "repeated-lines")
    drop_id, drop = unused("drop_id", docs), unused("drop", docs)
    n_lines, n_dropped = unused("n_lines", docs), unused("n_dropped", docs)
    drops = (join_by_weight(suspects, confirmed, "digest", "n_docs").where(F.col("doc_id") < F.col("keeper"))
             .groupBy(F.col("doc_id").alias(drop_id)).agg(F.collect_set("digest").alias(drop)))
    joined = docs.join(drops, F.col(doc_id).cast("long") == F.col(drop_id), "left").drop(drop_id)
    names = docs.columns
    at, plan = names.index(text), joined.select(*names, drop)

    def strip(batches):
        for batch in (part for whole in batches for part in _parts(whole)):
            kept, before, gone = [], [], []
            for t, drop in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()):
                t = t or ""
                before.append(t.count("\n") + 1)
                if drop:
                    bad, lines = set(drop), t.split("\n")
                    left = [x for x in lines if not (k := line_key(x, min_chars)) or xxhash.xxh3_128_digest(k) not in bad]
                    gone.append(len(lines) - len(left))
                    t = "\n".join(left)
                else:
                    gone.append(0)
                kept.append(t)
            columns = [pa.array(kept, batch.column(i).type) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(before, pa.int64()), pa.array(gone, pa.int64())],
                                             [*names, n_lines, n_dropped])

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema)
    return plan.mapInArrow(strip, f"{fields}, {n_lines} long, {n_dropped} long")


def line_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_lines, n_dropped and the digest of the text that is left."""
    out = dedup_lines(docs.select("doc_id", "text"), **options)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))

