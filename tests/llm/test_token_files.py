import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakeloom.llm import token_files
from lakeloom.llm.queries import op13_token_files

WORDS = public_tokenizers.path("word_bpe_49k.json")
NASTY = st.text(st.sampled_from(list("aAbé́ñ'st 1<|>\n\t  İΣς▁中🙂.") + [" ", " "]), max_size=40)


MADE = Tokenizer.from_file(WORDS)


def whole(text):
    return MADE.encode(text or "", add_special_tokens=False).ids + [2]


def expected(rows):
    out, start = [], 0
    for i, t in rows:
        ids = whole(t)
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def got(spark, folder):
    return [tuple(r) for r in token_files.documents(spark, folder, with_ids=True).orderBy("start").collect()]


@pytest.fixture(scope="module")
def packer():
    with open(WORDS, "rb") as f:
        return token_files.Packer(f.read(), 2, False)


@settings(max_examples=400, deadline=None)
@given(NASTY)
def test_chunks_give_the_tokens_of_the_whole_text(packer, text):
    packer.forget()
    want = [whole(t) for t in (text, None, "x " + text + " 1st", text)]
    for _ in range(2):  # learned, then remembered
        got = packer(pa.array([text, None, "x " + text + " 1st", text], pa.string()), 2, True)
        assert [np.frombuffer(b, "<u2").tolist() for b in got.to_pylist()] == want


def test_forgetting_keeps_the_ids_right(packer, monkeypatch):
    monkeypatch.setattr(token_files._vocab, "REMEMBERED", 5)
    packer.forget()
    for k in range(30):
        texts = [f"w{k} café w{k + 1} the {'x' * 100}{k}", f"the w{k // 2}"]
        assert [np.frombuffer(b, "<u2").tolist() for b in packer(pa.array(texts), 2, True).to_pylist()] == [whole(t) for t in texts]
    assert len(packer.chunks) < 20


def test_files_hold_every_document_in_order(spark, docs):
    rows = [(9, "the cat sat on the mat"), (-3, None), (4, ""), (7, "ÀÉ  <|endoftext|> x"), (2, "long " * 30000), (11, "\n")]
    folder = token_files.write(docs(rows), WORDS, 2)
    assert got(spark, folder) == expected(sorted(rows))
    table = token_files.manifest(spark, folder).orderBy("shard").collect()
    assert [r.tokens_before for r in table] == np.cumsum([0] + [r.tokens for r in table])[:-1].tolist()
    assert sum(r.docs for r in table) == 6 and {r.width for r in table} == {2}
    ids, offsets, doc = token_files.open_shard(folder, table[0].file, 2)
    assert isinstance(ids, np.memmap) and ids.dtype == np.uint16 and offsets.dtype == doc.dtype == np.int64
    assert offsets[-1] == len(ids) == table[0].tokens


def test_null_and_repeated_ids(spark, docs):
    rows = [(None, "b b"), (None, "a"), (5, "one"), (5, "two words"), (5, "one"), (-(1 << 63), "low")] + [(8, f"copy {k}") for k in range(300)]
    found = got(spark, token_files.write(docs(rows), WORDS, 2))
    assert [r[0] for r in found] == [None, None, -(1 << 63)] + [5] * 3 + [8] * 300
    assert sorted((str(i), tuple(whole(t))) for i, t in rows) == sorted((str(r[0]), tuple(r[4])) for r in found)
    assert [r[1] for r in found] == np.cumsum([0] + [r[2] for r in found])[:-1].tolist()


def test_a_hot_id_is_spread_over_shards(spark, docs):
    folder = token_files.write(docs([(8, f"copy {k}") for k in range(300)] + [(k + 10, "x") for k in range(100)]), WORDS, 2)
    sizes = [r.docs for r in token_files.manifest(spark, folder).collect()]
    assert len(sizes) >= 6 and max(sizes) <= 120
    ids = [r.doc_id for r in token_files.documents(spark, folder).orderBy("start").collect()]
    assert ids == sorted(ids)


def test_empty_table_and_widths(spark, docs):
    assert got(spark, token_files.write(docs([]), WORDS, 2)) == []
    wide = token_files.write(docs([(1, "a b")]), WORDS, 70000, width=None)
    assert [r.width for r in token_files.manifest(spark, wide).collect()] == [4]
    assert got(spark, wide)[0][4] == whole("a b")[:-1] + [70000]
    open_end = token_files.write(docs([(1, None), (2, "a b")]), WORDS, None)
    assert [r[4] for r in got(spark, open_end)] == [[], whole("a b")[:-1]]
    with pytest.raises(ValueError):
        token_files.write(docs([(1, "a")]), WORDS, 70000, width=2)


def test_lost_attempts_leave_no_trace(spark, docs):
    folder = token_files.write(docs([(1, "a b"), (2, "c")]), WORDS, 2)
    again = token_files._Shard(folder, 0, 2)  # as of an attempt that broke off
    again.out["bin"].write(b"123456")
    again.close()
    assert got(spark, folder) == expected([(1, "a b"), (2, "c")])


def test_query_against_whole_texts(spark):
    small = "/root/testdata/sf0.001"
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect())
    found = [tuple(r) for r in op13_token_files(spark, small).orderBy("start").collect()]
    assert found == [r[:4] for r in expected(rows)]
