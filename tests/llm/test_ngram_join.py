import random

import pytest

from lakeloom.llm import ngram_join
from tests.llm.conftest import words


def brute(rows, size=4, percent=85):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    up = {i: i for i in sets}

    def root(x):
        return x if up[x] == x else root(up[x])

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(a), root(b)
                    up[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), root(i)) for i in ids)


def corpus(seed, groups=12, copies=14):
    rng = random.Random(seed)
    text = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    shared, rows = text(30), []
    for _ in range(groups):
        base = text(rng.choice([3, 5, 9, 12, 40, 80, 200]))
        if rng.random() < 0.4:
            base = shared + base
        for _ in range(rng.randrange(1, copies)):
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(30)}"
            rows.append((len(rows) * 3, rng.choice([" ", "  ", "\n"]).join(w)))
    return rows


@pytest.mark.parametrize("seed,large,block", [(1, 24, 128), (2, 3, 4), (3, 2, 2)])
def test_matches_brute_force(docs, seed, large, block):
    rows = corpus(seed) + [(5000, None), (5001, ""), (5002, " \t"), (5003, "one"), (5004, "ONE"), (5005, "one two three"), (5006, "a b c d"), (5007, "A b C d")]
    got = sorted(map(tuple, ngram_join.near_duplicates(docs(rows), large=large, block=block).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == brute(rows)


def test_one_large_group_of_near_copies(docs):
    rng = random.Random(9)
    base, rows = [f"b{k}" for k in range(120)], []
    for i in range(150):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    got = sorted(map(tuple, ngram_join.near_duplicates(docs(rows), block=16).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == brute(rows)


def test_repeated_rows_null_ids_and_long_text(docs):
    long = " ".join(f"t{k}" for k in range(30_000))
    rows = [(1, long), (1, long), (2, long + " end"), (None, long), (None, None)]
    got = sorted(map(tuple, ngram_join.near_duplicates(docs(rows)).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == [(1, 29_997, 1), (2, 29_998, 1)]
    left = ngram_join.drop_near_duplicates(docs(rows))
    assert sorted((r.doc_id for r in left.collect()), key=repr) == [1, 1, None, None]


def test_empty_table_and_bounds(docs):
    assert ngram_join.near_duplicates(docs([])).count() == 0
    with pytest.raises(ValueError):
        ngram_join.near_duplicates(docs([]), percent=60)


def test_drop_with_clashing_columns(spark, docs):
    text = " ".join(f"w{k}" for k in range(60))
    df = docs([(1, text), (2, text + " x"), (3, "other"), (None, text)]).withColumnsRenamed({"n": "copy", "tokens": "wanted"}).selectExpr("*", "1 as __gone", "2 as __id")
    out = ngram_join.drop_near_duplicates(df)
    assert out.columns == df.columns and sorted((r.doc_id for r in out.collect()), key=repr) == [1, 3, None]
