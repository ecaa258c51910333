import random

import numpy as np
from pyspark.sql import functions as F

from lakeloom.llm import mixing

WORDS = {"high": ["river", "stone", "garden"], "low": ["%%%", "|||", "zz"], "toxic": ["zorblat", "quimpy"]}


def corpus(spark, n=240):
    rng = random.Random(1)
    rows, marks = [], []
    for i in range(n):
        d = ["high", "high", "high", "high", "low", "toxic"][i % 6]
        rows.append((i, " ".join(rng.choice(WORDS[d] + ["the", "of"]) for _ in range(rng.randrange(5, 60))), 9.0))
        marks.append((i, int(d != "low"), int(d == "toxic")))
    return (spark.createDataFrame(rows, "doc_id long, text string, rate double"),
            spark.createDataFrame([*marks, (None, 1, 0), (900, None, None), (0, 1, 0)], "doc_id long, quality int, toxic int"))


def shares(out):
    total = out.agg(F.sum("tokens")).first()[0]
    return [out.agg(F.sum(F.col("rate") * F.col("tokens") * F.col(f"p_{d}"))).first()[0] / total for d in ("high", "low", "toxic")]


def test_expected_totals_match_targets(spark):
    docs, labels = corpus(spark)
    out = mixing.mix(docs, labels, {"high": 60, "low": 30, "toxic": 10}).cache()
    assert np.allclose(shares(out), [0.6, 0.3, 0.1], atol=5e-4)
    assert out.agg(F.min("rate")).first()[0] >= 0
    r = out.agg((F.sum(F.col("copies") * F.col("tokens")) / F.sum("tokens")).alias("x"), F.max(F.abs(F.col("copies") - F.col("rate"))).alias("gap")).first()
    assert abs(r.x - 1) < 0.15 and r.gap < 1


def test_fit_against_direct_projected_gradient(spark):
    rng = np.random.default_rng(0)
    p = rng.dirichlet([0.4, 0.4, 0.4], 200)
    t = rng.integers(0, 500, 200)
    table = spark.createDataFrame([(int(n), [float(v) for v in q]) for n, q in zip(t, p)], "tokens long, p array<double>").repartition(3)
    targets = np.array([0.7, 0.25, 0.05])
    pulls, momenta, reached = mixing.fit_rates(table, targets, 80, 1e-6)
    r = mixing._rates(p, pulls, momenta)[0]
    assert (r >= 0).all() and np.allclose((r * t) @ p / t.sum(), reached) and np.allclose(reached, targets, atol=1e-5)


def test_odd_rows(spark):
    docs, labels = corpus(spark)
    more = spark.createDataFrame([(1000, None, 1.0), (1001, "", 1.0), (None, "river stone", 1.0), (5, "river", 1.0), (5, "river", 1.0), (1002, "garden " * 40_000, 1.0)], docs.schema)
    out = mixing.mix(docs.unionByName(more), labels).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == 246 and by[1000].tokens == by[1001].tokens == 0 and by[1000].rate == by[1001].rate and by[1002].tokens == 40_000
    kept = mixing.weighted(docs.unionByName(more), labels)
    assert kept.columns == [*docs.columns, "mix_rate"] and kept.where("mix_rate <= 0 or mix_rate is null").count() == 0


def test_without_labels_and_empty(spark):
    docs, labels = corpus(spark, 12)
    assert {r.rate for r in mixing.mix(docs, labels.where("false")).collect()} == {1.0}
    assert mixing.mix(docs.where("false"), labels).count() == 0
    assert mixing.weighted(docs.where("false"), labels).count() == 0
