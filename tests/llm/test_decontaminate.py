import random

from pyspark.sql import functions as F

from lakeloom.llm import decontaminate
from tests.llm.conftest import words

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute(rows, items, window=13):
    wins = {}
    for k, t in items:
        w = words(t, PATTERN)
        if k is not None and w:
            for s in range(max(1, len(w) - window + 1)):
                wins.setdefault(tuple(w[s:s + window]), set()).add(k)
    out = []
    for i, t in rows:
        w, hit, found = words(t, PATTERN), set(), set()
        for size in {len(x) for x in wins} if i is not None else ():
            for s in range(len(w) - size + 1):
                if got := wins.get(tuple(w[s:s + size])):
                    hit |= set(range(s, s + size))
                    found |= got
        out.append((i, len(w), len(hit), sorted(map(str, found)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def result(docs, items):
    out = decontaminate.contamination(docs, items)
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.items, r.contaminated) for r in out.collect()), key=repr)


def make_items(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_matches_brute_force(spark, docs):
    rng = random.Random(3)
    vocabulary = ["the", "of", "é", "x1", "naïve", "tree", "42"] + [f"w{k}" for k in range(60)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.choice([1, 5, 12, 13, 14, 40]))) for k in range(2, 14)] + [(30, None), (31, ""), (32, "..."), (None, text(20)), (33, "the the the the")]
    rows = []
    for i in range(80):
        base = text(rng.choice([0, 3, 30, 200, 600]))
        if i % 3 == 0:
            w = words(rng.choice(items[:12])[1], PATTERN)
            base = f"{base} {'; '.join(w[rng.randrange(2):]).upper()} {text(5)}"
        rows.append((i, base))
    rows += [(200, None), (201, ""), (None, items[0][1]), (202, rows[0][1]), (202, rows[0][1]), (203, text(60_000))]
    assert result(docs(rows), make_items(spark, items)) == brute(rows, items)


def test_blocks_of_one_and_the_lowest_id(spark, docs, monkeypatch):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(["the", "of", "tree", "w1", "w2", "w3"]) for _ in range(n))
    items = [(k, text(rng.choice([2, 13, 15]))) for k in range(4)]
    rows = [(i, f"{text(8)} {items[i % 4][1]} {text(4)}") for i in range(12)] + [(-(1 << 63), items[1][1]), (None, items[1][1])]
    monkeypatch.setattr(decontaminate, "TERM_BLOCK", 3)
    monkeypatch.setattr(decontaminate, "PHRASE_BLOCK", 4)
    assert result(docs(rows), make_items(spark, items)) == brute(rows, items)


def test_five_percent_is_contaminated(spark, docs):
    phrase = " ".join(f"p{k}" for k in range(13))
    rows = [(1, phrase + " z" * 247), (2, phrase + " z" * 248)]  # 13 of 260 and of 261
    got = result(docs(rows), make_items(spark, [(1, phrase)]))
    assert [r[4] for r in got] == [True, False]


def test_no_items_and_no_documents(spark, docs):
    rows = [(1, "a b c"), (2, None)]
    assert result(docs(rows), make_items(spark, [])) == [(1, 3, 0, [], False), (2, 0, 0, [], False)]
    assert result(docs([]), make_items(spark, [(1, "a b")])) == []


def test_filter_keeps_columns(spark, docs):
    df = docs([(1, "a b c"), (2, "q r s"), (None, "a b c")])
    out = decontaminate.remove_contaminated(df, make_items(spark, [(1, "b c")]))
    assert out.columns == df.columns and sorted((r.doc_id for r in out.collect()), key=repr) == [2, None]


def test_filter_with_clashing_columns(spark, docs):
    df = docs([(1, "a b c"), (2, "q r s")]).withColumnsRenamed({"n": "bad", "tokens": "wanted"}).withColumn("__bad", F.lit(1))
    out = decontaminate.remove_contaminated(df, make_items(spark, [(1, "b c")]))
    assert out.columns == df.columns and [r.doc_id for r in out.collect()] == [2]


def test_proximity(spark, docs):
    df = docs([(1, "alpha x beta"), (2, "alpha x x x x beta x alpha"), (3, "alpha"), (4, None)])
    terms = decontaminate.terms_of(spark.createDataFrame([(7, "alpha beta")], "q long, text string"), "q").withColumnRenamed("id", "query")
    near = lambda slop: sorted(map(tuple, decontaminate.proximity_matches(df, terms, slop).collect()))
    assert near(1) == [(1, 7, 0, 3), (2, 7, 5, 8)]
    assert near(0) == []
