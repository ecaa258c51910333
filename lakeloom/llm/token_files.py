"""Token ids as flat binary files.

A store is a folder of shards. ``<file>.bin`` holds the ids of the shard's
documents one after the other as little-endian unsigned integers (16 bits if
every id fits, else 32); ``<file>.off`` 64-bit offsets in ids, one more than
documents, from 0; ``<file>.doc`` the 64-bit document ids. ``manifest`` is a
Parquet table with one row a shard: its file, counts, and the number of
documents and ids in the shards before it (prefix sums of the counts), which
turn a shard's offsets into places in the whole corpus.

Documents stand in ascending order of their id. Shard borders are quantiles of
the ids; an id that spans several borders is spread over the shards between
them by a hash of its text. Tasks stream their sorted rows into the files. Each
attempt of a task writes files of its own and the manifest, committed by
Spark's writer, names those that count, so lost or repeated attempts leave
unused files but never wrong ones.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm import _vocab
from lakeloom.llm._io import text_batches
from lakeloom.session import checkpoint_dir

MANIFEST = "shard int, file string, width int, docs long, nulls long, tokens long"
#: about so many documents a shard; small corpora have one shard a shuffle partition
SHARD_DOCS = 250_000
#: chunks whose ids are gathered at once
BLOCK = 1 << 20
_LOWEST = -1 << 63


def _place(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in folder and not folder.startswith("file:"):
        return pafs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    return pafs.FileSystem.from_uri(folder)


class Packer:
    """A tokenizer that writes ids as packed integers, and the chunks it has
    met: their ids stand in one array, and the ones used last are kept."""

    def __init__(self, raw: bytes, width: int, plain_specials: bool):
        self.made, self.kind = _vocab.tokenizer(raw, plain_specials), np.dtype(f"<u{width}")
        # bytes that a token stands for: one for each character of a byte-level token, but for the mark of a word's end
        self.bytes = np.zeros(self.made.get_vocab_size(with_added_tokens=True), np.int64)
        for token, k in self.made.get_vocab(with_added_tokens=True).items():
            self.bytes[k] = len(token.removesuffix("</w>"))
        self.forget()

    def forget(self) -> None:
        self.chunks, self.ids, self.ends = pa.array([], pa.string()), np.zeros(0, self.kind), np.zeros(1, np.int64)
        self.used, self.now = np.zeros(0, np.int64), 0

    def encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.made.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and their number for chunks of visible ASCII, encoded as one
        text and cut where the bytes of each end; None if no token ends there."""
        ids = np.array(self.encoded([" ".join(chunks)])[0], self.kind)
        ends, wanted = np.cumsum(self.bytes[ids]), np.cumsum(list(map(len, chunks)))
        cut = np.searchsorted(ends, wanted, "right")
        if not len(ids) or cut[-1] != len(ids) or not np.array_equal(ends[np.maximum(cut, 1) - 1], wanted):
            return None
        return ids, np.diff(cut, prepend=0)

    def _learn(self, chunks: pa.Array) -> None:
        if not len(chunks):
            return
        texts = chunks.to_pylist()
        found = self._together(texts) if pc.all(pc.match_substring_regex(chunks, "^[!-~]+$")).as_py() else None
        if found is None:
            lists = self.encoded(texts)
            found = np.array([k for ids in lists for k in ids], self.kind), np.array([len(ids) for ids in lists], np.int64)
        self.chunks = pa.concat_arrays([self.chunks, chunks])
        self.ends = np.r_[self.ends, self.ends[-1] + np.cumsum(found[1])]
        self.ids = np.r_[self.ids, found[0]]
        self.used = np.r_[self.used, np.full(len(chunks), self.now)]

    def _places(self, chunks: pa.Array) -> np.ndarray:
        """Where the ids of each chunk stand, after learning the new ones."""
        self.now += 1
        if len(self.chunks) > _vocab.REMEMBERED * 2 or self.chunks.nbytes > 64 << 20:
            short = np.flatnonzero(np.asarray(pc.less_equal(pc.binary_length(self.chunks), _vocab.LONGEST)))
            keep = np.sort(short[np.argsort(-self.used[short], kind="stable")[:_vocab.REMEMBERED]])
            ids, sizes = _vocab.gathered(self.ids, self.ends, keep), np.diff(self.ends)[keep]
            self.chunks, self.ids, self.ends, self.used = self.chunks.take(pa.array(keep)), ids, np.r_[0, np.cumsum(sizes)], self.used[keep]
        found = pc.index_in(chunks, value_set=self.chunks)
        new, at = np.flatnonzero(np.asarray(found.is_null())), np.array(found.fill_null(0), np.int64)
        visible = np.asarray(pc.match_substring_regex(chunks.take(pa.array(new)), "^[!-~]+$"))
        for part in (new[visible], new[~visible]):
            at[part] = len(self.chunks) + np.arange(len(part))
            self._learn(chunks.take(pa.array(part)))
        self.used[at] = self.now
        return at

    def __call__(self, texts: pa.Array, end_id: int | None, chunked: bool) -> pa.Array:
        """Packed ids of each text, closed by ``end_id``."""
        texts = texts.fill_null("")
        end = np.array([] if end_id is None else [end_id], self.kind)
        if not chunked:
            return pa.array([np.r_[np.array(ids, self.kind), end].tobytes() for ids in self.encoded(texts.to_pylist())], pa.binary())
        chunks, at, row = _vocab.numbered(_vocab.blank_chunks(texts))
        place = self._places(chunks)
        flat, ends = np.r_[self.ids, end], np.r_[self.ends, len(self.ids) + len(end)]
        at = np.insert(place[at], row[1:], len(ends) - 2)  # the end after each text
        row = row + np.arange(len(row))  # with the ends
        out = [_vocab.gathered(flat, ends, at[k:k + BLOCK]).tobytes() for k in range(0, len(at), BLOCK)]
        starts = np.r_[0, np.cumsum(np.diff(ends)[at])][row] * self.kind.itemsize
        return pa.BinaryArray.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(b"".join(out))])


def encode(docs: DataFrame, vocabulary: str, end_id: int | None, width: int, chunked: bool = True, plain_specials: bool = False,
           doc_id: str = "doc_id", text: str = "text", borders: np.ndarray | None = None) -> DataFrame:
    """(shard, doc_id, tie, ids binary): the packed ids of every text, closed
    by ``end_id``. ``chunked``: the vocabulary drops white space, so texts are
    encoded chunk by chunk."""
    text_batches(docs.sparkSession)
    raw = _vocab.vocabulary(docs.sparkSession, vocabulary)
    borders = np.zeros(0, np.int64) if borders is None else borders

    def run(batches):
        packer = _vocab.kept(f"ids-{width}-{plain_specials}", [raw.value], lambda: Packer(raw.value, width, plain_specials))
        for batch in _vocab.larger(batches, 2):
            ids = np.asarray(batch.column(0).fill_null(_LOWEST))
            tie = np.asarray(batch.column(1))
            low, high = np.searchsorted(borders, ids, "left"), np.searchsorted(borders, ids, "right")
            part = (tie >> 32) + (1 << 31)  # 0 to 2^32 - 1, in the order of tie
            shard = low + (part * (high - low + 1) >> 32)
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), batch.column(0), batch.column(1),
                                              packer(batch.column(2), end_id, chunked)], ["shard", "doc_id", "tie", "ids"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text")).mapInArrow(
        run, "shard int, doc_id long, tie long, ids binary")


def borders(docs: DataFrame, shards: int, doc_id: str = "doc_id") -> np.ndarray:
    """``shards - 1`` quantiles of the ids (a null counts as the lowest)."""
    if shards < 2:
        return np.zeros(0, np.int64)
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(_LOWEST))
    cuts = docs.agg(F.percentile_approx(key, [k / shards for k in range(1, shards)], max(10_000, 20 * shards)).alias("q")).first().q
    return np.sort(np.array(cuts or [], np.int64))


class _Shard:
    """The files of one shard while they are written."""

    def __init__(self, folder: str, shard: int, width: int):
        self.files, self.path = _place(folder)
        self.shard, self.width, self.name = shard, width, f"shard-{shard:06d}-{uuid.uuid4().hex}"
        self.out = {e: self.files.open_output_stream(f"{self.path}/{self.name}.{e}") for e in ("bin", "off", "doc")}
        self.out["off"].write(np.zeros(1, "<i8").tobytes())
        self.docs = self.nulls = self.tokens = 0

    def add(self, ids: pa.Array, packed: pa.Array) -> None:
        offsets = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset:packed.offset + len(packed) + 1].astype(np.int64)
        data = packed.buffers()[2]
        if data is not None:
            self.out["bin"].write(memoryview(data)[offsets[0]:offsets[-1]])
        self.out["off"].write((self.tokens + (offsets[1:] - offsets[0]) // self.width).astype("<i8").tobytes())
        self.out["doc"].write(np.asarray(ids.fill_null(_LOWEST)).astype("<i8").tobytes())
        self.docs += len(packed)
        self.nulls += ids.null_count
        self.tokens += int(offsets[-1] - offsets[0]) // self.width

    def close(self) -> pa.RecordBatch:
        for f in self.out.values():
            f.close()
        row = [self.shard, self.name, self.width, self.docs, self.nulls, self.tokens]
        kinds = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], ["shard", "file", "width", "docs", "nulls", "tokens"])


def write(docs: DataFrame, vocabulary: str, end_id: int | None, folder: str | None = None, width: int | None = None, chunked: bool = True,
          plain_specials: bool = False, doc_id: str = "doc_id", text: str = "text") -> str:
    """Write a store of all texts below the shared folder; returns its folder.

    Null and empty texts have ``end_id`` alone (nothing if that is None). Null
    ids come first. Rows that repeat an id keep a document each, in the order
    of a hash of their text. An empty table gives a store without shards.
    Other columns are ignored. ``folder`` must be new; any file system that
    pyarrow opens on the executors will do.
    """
    spark = docs.sparkSession
    folder = (folder or f"{checkpoint_dir(spark).rstrip('/')}/llm-tokens-{uuid.uuid4().hex}").rstrip("/")
    with open(vocabulary, "rb") as f:
        most = _vocab.tokenizer(f.read(), plain_specials).get_vocab_size(with_added_tokens=True)
    most = max(most, (end_id or 0) + 1)
    width = width or (2 if most <= 1 << 16 else 4)
    if width not in (2, 4) or most > 1 << 8 * width:
        raise ValueError(f"ids up to {most - 1} do not fit in {width} bytes")
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // SHARD_DOCS))
    cuts = borders(docs, shards, doc_id)
    rows = encode(docs, vocabulary, end_id, width, chunked, plain_specials, doc_id, text, cuts)
    rows = rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), "tie")
    files, path = _place(folder)
    files.create_dir(path, recursive=True)

    def save(batches):
        now = None
        for batch in batches:
            shard = np.asarray(batch.column(0))
            edges = np.r_[0, np.flatnonzero(np.diff(shard)) + 1, len(shard)] if len(shard) else []
            for a, b in zip(edges[:-1], edges[1:]):
                if now is not None and now.shard != shard[a]:
                    yield now.close()
                    now = None
                now = now or _Shard(folder, int(shard[a]), width)
                now.add(batch.column(1).slice(a, b - a), batch.column(2).slice(a, b - a))
        if now is not None:
            yield now.close()

    rows.select("shard", "doc_id", "ids").mapInArrow(save, MANIFEST).write.parquet(f"{folder}/written")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    listed = spark.read.schema(MANIFEST).parquet(f"{folder}/written")
    listed.select("*", *(F.coalesce(F.sum(c).over(before), F.lit(0)).cast("long").alias(f"{c}_before") for c in ("docs", "tokens"))).write.parquet(
        f"{folder}/manifest")
    return folder


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST + ", docs_before long, tokens_before long").parquet(f"{folder}/manifest")


def _mapped(folder: str, name: str, kind: str) -> np.ndarray:
    """A file as an array, memory-mapped where it is on a mounted path."""
    files, path = _place(folder)
    path = f"{path}/{name}"
    if not files.get_file_info(path).size:
        return np.zeros(0, kind)
    if isinstance(files, pafs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with files.open_input_file(path) as f:
        return np.frombuffer(f.read(), kind)


def open_shard(folder: str, name: str, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, offsets, document ids) of a shard; document k has the ids
    ``ids[offsets[k]:offsets[k + 1]]``."""
    return _mapped(folder, f"{name}.bin", f"<u{width}"), _mapped(folder, f"{name}.off", "<i8"), _mapped(folder, f"{name}.doc", "<i8")


def documents(spark: SparkSession, folder: str, with_ids: bool = False, block: int = 1024) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the
    files; ``with_ids`` adds ids array<long>. ``start`` counts the ids of all
    documents before it; ``ids_crc32`` is taken over 32-bit ids."""
    def run(batches):
        for batch in batches:
            for s in batch.to_pylist():
                ids, offsets, doc = open_shard(folder, s["file"], s["width"])
                for a in range(0, s["docs"], block):
                    b = min(a + block, s["docs"])
                    off = offsets[a:b + 1]
                    here = np.asarray(ids[off[0]:off[-1]]).astype("<u4")
                    view, cut = memoryview(here).cast("B") if len(here) else b"", 4 * (off - off[0])
                    crc = [zlib.crc32(view[x:y]) for x, y in zip(cut[:-1].tolist(), cut[1:].tolist())]
                    out = [pa.array(np.asarray(doc[a:b]), mask=np.arange(a, b) < s["nulls"]), pa.array(s["tokens_before"] + np.asarray(off[:-1])),
                           pa.array(np.diff(off)), pa.array(crc, pa.int64())]
                    if with_ids:
                        out.append(pa.ListArray.from_arrays(pa.array((off - off[0]).astype(np.int32)), pa.array(here.astype(np.int64))))
                    yield pa.RecordBatch.from_arrays(out, names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    kinds = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    shards = manifest(spark, folder)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return shards.repartitionById(n, F.col("shard")).mapInArrow(run, kinds)
