"""Public tokenizers inside tasks.

The vocabulary is read once on the driver and broadcast (a few MB, never grows
with the data), so executors need no file. Texts are cut into chunks at blanks
where both sides have their own tokens: a text's tokens are then those of its
chunks, one after the other. Each different chunk of a batch is encoded once,
all new ones of a batch together, and a bounded number is remembered.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import SparkSession

#: chunks that a task remembers (at most twice as many), and the longest of them
REMEMBERED, LONGEST = 300_000, 64
TOGETHER = 10 << 20
#: a single blank between characters that are no white space
INNER_BLANK = re.compile(r"(?<=\S) (?=\S)")
_WHITE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_OTHER_BLANKS = f"^{_WHITE}|{_WHITE}$| {_WHITE}|{_WHITE} "


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The bytes of a vocabulary file that the driver can open."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def tokenizer(raw: bytes, plain_specials: bool):
    """A tokenizer of the ``tokenizers`` library; ``plain_specials``: strings
    of special tokens inside texts are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer
    made = Tokenizer.from_str(raw.decode("utf-8"))
    made.encode_special_tokens = plain_specials
    return made


def pieces(raw: bytes):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_proto=raw)


def blank_chunks(texts: pa.Array) -> pa.ListArray:
    """Chunks between blanks and line ends, for vocabularies that drop white space."""
    return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")


def inner_chunks(texts: pa.Array) -> pa.ListArray:
    """Chunks between single blanks that have no white space beside them."""
    other = np.asarray(pc.match_substring_regex(texts, _OTHER_BLANKS))
    found = pc.split_pattern(texts.filter(pa.array(~other)), " ")
    if not other.any():
        return found
    rest = pa.array([INNER_BLANK.split(t) for t in texts.filter(pa.array(other)).to_pylist()], found.type)
    order = np.argsort(np.r_[np.flatnonzero(~other), np.flatnonzero(other)])
    return pa.concat_arrays([found, rest]).take(pa.array(order))


def numbered(chunks: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different chunks, the number of each occurrence among them, and
    each row's first occurrence (one more entry than rows)."""
    offsets = np.asarray(chunks.offsets).astype(np.int64)
    coded = chunks.flatten().dictionary_encode()
    return coded.dictionary, np.asarray(coded.indices), offsets - offsets[0]


def gathered(values: np.ndarray, offsets: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The lists ``values[offsets[k]:offsets[k + 1]]`` for k in ``wanted``, joined."""
    size = offsets[wanted + 1] - offsets[wanted]
    ends = np.cumsum(size)
    if not len(ends):
        return values[:0]
    return values[np.repeat(offsets[wanted] - (ends - size), size) + np.arange(ends[-1])]


def larger(batches, text: int):
    """Batches put together up to about TOGETHER bytes of texts (column
    ``text``): chunks that repeat are looked up once for all of them."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(text).nbytes
        if size >= TOGETHER:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


class Memory:
    """Chunk -> value, in two generations: when the younger one is full the
    older one is forgotten. ``make`` gives the values of a list of new chunks."""

    def __init__(self, make):
        self.make, self.young, self.old = make, {}, {}

    def values(self, chunks: list[str]) -> list:
        young = self.young
        out = list(map(young.get, chunks))
        missing = [k for k, v in enumerate(out) if v is None]
        new = []
        for k, v in zip(missing, list(map(self.old.get, [chunks[k] for k in missing]))):
            if v is None:
                new.append(k)
            else:
                out[k] = young[chunks[k]] = v
        for k, v in zip(new, self.make([chunks[k] for k in new]) if new else ()):
            out[k] = v
            if len(chunks[k]) <= LONGEST:
                young[chunks[k]] = v
        if len(young) > REMEMBERED:
            self.young, self.old = {}, young
        return out


_KEPT: dict = {}


def kept(what: str, raws: list[bytes], build):
    """``build()``, once for a Python worker and these vocabularies: the next
    tasks of the worker find the chunks that the ones before have learned."""
    key = (what, *(hashlib.sha256(r).digest() for r in raws))
    if key not in _KEPT:
        _KEPT[key] = build()
    return _KEPT[key]
