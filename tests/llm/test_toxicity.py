import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import toxicity
from tests.llm.conftest import SMALL

BAD = ["zorblat", "quimpy", "vexnar"]
GOOD = ["the", "river", "stone", "walks", "under", "bright", "morning", "letters", "garden", "window", "people"]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(2)
    rows, marks = [], []
    for i in range(300):
        w = [rng.choice(GOOD) for _ in range(60)]
        if i % 3 == 0:
            w[rng.randrange(60)] = rng.choice(BAD)
            w[rng.randrange(60)] = rng.choice(BAD)
        rows.append((i, " ".join(w)))
        marks.append((i, int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (0, 1), (None, 1), (5000, None), (5001, 0)], "doc_id long, toxic int")
    return docs, labels, toxicity.fit(docs, labels, F.lit(True))


def test_model_finds_the_words(corpus):
    assert {"zorblat", "quimpy", "vexnar"} <= set(corpus[2].lexicon)
    assert not set(GOOD) & set(corpus[2].lexicon)


@pytest.mark.parametrize("text", ["a zorblat here", "a z0rbl@t here", "zooooorblat", "Z O R B L A T", "z.o.r.b.l.a.t", "qu!mpy", "v3xn4r!!", "*quimpy*",
                                  "z  o  r  b  l  a  t", "t h e z o r b l a t", "zzoorrbbllaatt", "zo rblat", "q\nu\ni\nm\np\ny", "vvexnaar"])
def test_obfuscated_words_are_scored(corpus, text):
    scorer = toxicity.Scorer(corpus[2], toxicity.Settings().heads)
    assert scorer.document(text)[1] > 0 and scorer.document("a river stone walks")[1] == 0


def test_symbols_alone_are_read_and_numbers_are_not():
    cost = np.full((28, 28, 28), 2.0)
    for w in (" sh", "shi", "hit", "it "):
        cost[:, toxicity._letter_class(w[1]) if w[1] != " " else 0, toxicity._letter_class(w[2]) if w[2] != " " else 0] = 0.5
    assert "shit" in toxicity.readings("5#17", cost) and "shit" in toxicity.readings("$#!7", cost)
    assert toxicity.readings("5417", cost) == [] and toxicity.readings("---", cost) == []


def test_blanks_are_borders_or_noise():
    cost = np.full((28, 28, 28), 4.0)
    for w in ("you", "idiot"):
        c = [0, 0, *(ord(x) - 96 for x in w), 0]
        for a, b, d in zip(c, c[1:], c[2:]):
            cost[a, b, d] = 0.2
    assert toxicity.decode("y o u i d i o t", cost) == "you idiot" and toxicity.decode("id iot", cost) == "idiot"
    assert toxicity.decode("iidioott", cost) == "idiot" and toxicity.spaced_words("y o u i d i o t", cost) == ["you", "idiot"]


def test_decoder_against_all_readings():
    rng = np.random.default_rng(1)
    cost = rng.random((28, 28, 28)) * 6
    for token in ["m0r0n", "1d!ot", "aaab", "x$1", "c(l", "é4b", "5-5a", "a b", "a 1 c", "ab b a", "oo o"]:
        readings = [((), 0.0)]
        for arcs in toxicity._arcs(token):
            readings = [(r + ((e, c),) if e else r, t + x) for r, t in readings for e, c, x in arcs]

        def total(r, t):
            out, word = t, []
            for e, c in [*r, (" ", 0)]:  # word by word, each with its borders
                if e != " ":
                    word.append(c)
                elif word:
                    classes = [0, 0, *word, 0]
                    out += sum(cost[a, b, c] for a, b, c in zip(classes, classes[1:], classes[2:]))
                    word = []
            return out

        best = min(total(r, t) for r, t in readings)
        got = toxicity.decode(token, cost)
        assert any(abs(total(r, t) - best) < 1e-9 and "".join(e for e, _ in r) == got for r, t in readings)


def test_char_counts(spark):
    docs = spark.createDataFrame([("ab c",), (None,), ("",), ("B",)], "text string")
    got = {r.gram: r.n for r in toxicity.char_counts(docs).collect()}
    gram = lambda s: sum(toxicity._letter_class(c) * 28 ** (2 - k) if c != " " else 0 for k, c in enumerate(s))
    assert got == {gram("  a"): 1, gram(" ab"): 1, gram("ab "): 1, gram("  c"): 1, gram(" c "): 1, gram("  b"): 1, gram(" b "): 1}


def test_counting_and_decoding_share_the_letters(spark):
    docs = spark.createDataFrame([("Éa ñ中 x🙂y", ), ("plain",), ("ß–ø",)], "text string")
    got = {r.gram: r.n for r in toxicity.char_counts(docs).collect()}
    want = {}
    for t in ("éa ñ中 x🙂y", "plain", "ß–ø"):
        for w in "".join(c if toxicity._letter_class(c) else " " for c in t).split():
            c = [0, 0, *map(toxicity._letter_class, w), 0]
            for a, b, d in zip(c, c[1:], c[2:]):
                want[(a * 28 + b) * 28 + d] = want.get((a * 28 + b) * 28 + d, 0) + 1
    assert got == want


def test_scores_of_odd_rows(spark, corpus):
    rows = [(1, None, "x"), (2, "", "x"), (None, "zorblat quimpy", "x"), (3, "zorblat quimpy", "x"), (3, "zorblat quimpy", "x"), (4, "river " * 50_000 + "vexnar zorblat", "x")]
    got = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string, score string"), corpus[2]).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r.score)
    assert len(got) == 6 and by[1] == by[2] and by[3][0] == by[3][1] == by[None][0] > 0.7 > by[1][0]
    assert toxicity.score(spark.createDataFrame([], "doc_id long, text string"), corpus[2]).count() == 0


def test_without_labels(spark, corpus):
    model = toxicity.fit(corpus[0], corpus[1].where("false"), F.lit(True))
    assert {r.score for r in toxicity.score(corpus[0], model).collect()} == {0.5}


def test_held_out_accuracy(spark):
    from lakeloom.llm.queries import op1_toxicity
    large = SMALL.replace("0.001", "0.1")
    out = op1_toxicity(spark, large).join(spark.read.parquet(f"{large}/labels.parquet"), "doc_id").where("held_out")
    r = out.agg(F.sum(F.col("predicted") * (1 - F.col("toxic"))).alias("fp"), F.sum(F.col("predicted") * F.col("toxic")).alias("tp"),
                F.sum("toxic").alias("n"), F.count(F.lit(1)).alias("rows")).first()
    print(r)
    assert r.fp <= 0.003 * r.rows and r.tp >= 0.9 * r.n
