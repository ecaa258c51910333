import re
from collections import Counter

import numpy as np

from lakeloom.llm import quality


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    times, hit = Counter(zip(w, w[1:], w[2:])), set()
    for k in range(len(w) - 2):
        if times[tuple(w[k:k + 3])] > 1:
            hit |= {k, k + 1, k + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed


def judged(spark, rows, marks):
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    return quality.judge(docs, quality.fit(docs, labels)).collect()


def test_base_and_verdict(spark):
    rng = np.random.default_rng(0)
    vocabulary = ["stone", "río", "walks", "under", "bright", "日本", "letter", "garden"]
    text = lambda n, end="": " ".join(rng.choice(vocabulary) + rng.choice(["", "x", "y"]) + end for _ in range(n))
    good = [(i, text(80)) for i in range(40)]
    junk = [(100 + i, text(80, "%%$")) for i in range(10)]
    odd = [(200, None), (201, ""), (202, "a b c " * 40), (203, "same line\nsame line\n\n \n \n" + text(60)), (204, text(49)), (205, text(50)), (None, text(70)),
           (206, good[0][1]), (206, good[0][1]), (207, text(30_000)), (208, "a\x0bb\x0cc\x1cd \x85e"), (209, "x")]
    rows = good + junk + odd
    got = judged(spark, rows, [(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(10)] + [(None, 1), (300, None)])
    want = sorted(((i, *base(t)) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=repr) == want
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[i] for i in range(40) if not base(good[i][1])[-1]) and not any(kept[i] for i in range(100, 110))
    assert not any(r.kept for r in got if r.base_failed)


def test_ratio_against_counts():
    table = np.arange(1 << 16, dtype=float)
    data = np.frombuffer("abcdexyzabcd".encode(), np.uint8)
    whole = quality._mean_ratio(table, data, np.array([0, 5, 8, 12]))
    alone = [quality._mean_ratio(table, data[a:b], np.array([0, b - a]))[0] for a, b in ((0, 5), (5, 8), (8, 12))]
    assert whole.tolist() == alone and alone[1] == 0 and alone[0] != alone[2]


def test_nothing_trusted_and_empty_table(spark):
    got = judged(spark, [(1, "word " * 3 + " ".join(f"w{k}" for k in range(60)))], [(1, 0)])
    assert got[0].kept
    assert judged(spark, [], [(1, 1)]) == []


def test_all_trusted_rows_count(spark):
    """More trusted rows than the former sample: all are counted, so a target of
    all rows equals the raw corpus."""
    rng = np.random.default_rng(1)
    text = lambda v, n: " ".join(rng.choice(v) + rng.choice(["", "x", "y"]) for _ in range(n))
    common, rare = ["stone", "walks", "under", "bright", "letter", "garden"], ["жёлтый", "город", "снег", "ветер"]
    rows = [(i, text(common, 8)) for i in range(10_500)] + [(20_000 + i, text(rare, 60)) for i in range(15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i, _ in rows], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    # everything is trusted: target and raw are the same counts, and so all scores 0
    assert np.allclose(model.table, 0) and abs(model.threshold + quality.Settings().margin) < 1e-6
