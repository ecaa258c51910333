import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakeloom.llm import token_alignment as ta
from lakeloom.llm.queries import op11_token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NASTY = st.text(st.sampled_from(list("aAbé́ñ'st 1<|>\n\t  İ▁中🙂.\x00") + [" ", " "]), max_size=40)


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    decode = {c: b for b, c in zip([*range(33, 127), *range(161, 173), *range(174, 256)], map(chr, [*range(33, 127), *range(161, 173), *range(174, 256)]))}
    for k, b in enumerate(sorted(set(range(256)) - set(decode.values()))):
        decode[chr(256 + k)] = b
    a_bytes = {k: bytes(decode[c] for c in t) for t, k in a.get_vocab().items() if set(t) <= set(decode)}
    return a, a_bytes, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(both, text):
    """Token lists of the whole text, its groups and links, by comparing all ends."""
    a, a_bytes, b = both
    if not text:
        return None
    ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    ba = [a_bytes.get(k, b"?") for k in ia]
    bb = [bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in ib]
    if b"".join(ba) != b"".join(bb) or b"".join(ba) != b" " + text.encode():
        return None
    ea, eb = [len(b"".join(ba[:k + 1])) for k in range(len(ba))], [len(b"".join(bb[:k + 1])) for k in range(len(bb))]
    groups, i, j = [], 0, 0
    for e in range(1, len(text.encode()) + 2):
        if e in ea and e in eb:
            p, q = ea.index(e) + 1, eb.index(e) + 1
            groups.append(",".join(map(str, ia[i:p])) + "|" + ",".join(map(str, ib[j:q])))
            i, j = p, q
    links = [(x, y) for x, s in zip(ia, ea) for y, t in zip(ib, eb) if s == t]
    return len(ia), len(ib), groups, links


def brute_table(both, texts):
    found = [brute(both, t) for t in texts]
    count = Counter(x for f in found if f for x in f[3])
    best = {}
    for (x, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_best = sum(count[x] == best[x[1]] for x in f[3])
            out.append((f[0], f[1], len(f[2]), len(f[3]), n_best, sum(count[x] for x in f[3]), hashlib.sha256(";".join(f[2]).encode()).hexdigest()))
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def aligner():
    with open(A, "rb") as a, open(B, "rb") as b:
        return ta.Aligner(a.read(), b.read())


@settings(max_examples=400, deadline=None)
@given(NASTY)
def test_chunks_align_like_the_whole_text(both, aligner, text):
    aligner.known.young, aligner.known.old = {}, {}
    want = brute(both, text) or (0, 0, [], [])
    for _ in range(2):  # learned, then remembered
        parts, at, row = aligner(pa.array([text, None, text + " 1st", text], pa.string()))
        got = [parts[k] for k in at[row[3]:row[4]]]
        assert sum(f.n_a for f in got) == want[0] and sum(f.n_b for f in got) == want[1] and sum(f.n_groups for f in got) == len(want[2])
        assert ";".join(f.text for f in got) == ";".join(want[2])
        assert sorted(x for f in got for x in np.frombuffer(f.links, np.int64)) == sorted(x << 32 | y for x, y in want[3])
        assert [parts[k] for k in at[row[1]:row[2]]] == [ta.NOTHING]


TEXTS = ["the cat sat on the mat", None, "", "Schöne Grüße, naïve café", "a▁b", "x <|endoftext|> <s> y", "  two  blanks \n\n", "the cat",
         "the cat", "a" * 3000, "unbelievable antidisestablishmentarianism " * 300, "\n"]


@pytest.mark.parametrize("sent", [1_000_000, 20, 1, 0])
def test_corpus_counts_by_brute_force(spark, docs, both, sent):
    ids = [*range(len(TEXTS) - 2), None, 3]  # a null id, a repeated id
    want = sorted([(i, *r) for i, r in zip(ids, brute_table(both, TEXTS))], key=repr)
    assert rows(ta.align_corpus(docs(list(zip(ids, TEXTS))), A, B, sent=sent)) == want


def test_common_ends():
    common, p, q = ta.common_ends(np.array([2, 3, 5, 9]), np.array([1, 3, 4, 5, 9]))
    assert (common.tolist(), p.tolist(), q.tolist()) == ([3, 5, 9], [2, 3, 4], [2, 4, 5])


def test_groups_and_empty_table(spark, docs, both):
    assert [r.groups for r in ta.groups(docs([(1, "the cat")]), A, B).collect()] == [brute(both, "the cat")[2]]
    assert rows(ta.align_corpus(docs([]), A, B)) == []


def test_query_by_brute_force(spark, both):
    small = "/root/testdata/sf0.001"
    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect() if r.text is None or len(r.text) < 4000]
    ids, texts = zip(*table)
    frame = spark.createDataFrame(table, "doc_id long, text string")
    want = sorted([(i, *r) for i, r in zip(ids, brute_table(both, texts))], key=repr)
    assert rows(ta.align_corpus(frame, A, B)) == want
    out = op11_token_alignment(spark, small)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert out.count() == spark.read.parquet(f"{small}/documents.parquet").count()
