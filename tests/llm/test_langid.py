import numpy as np
from pyspark.sql import functions as F

from lakeloom.llm import langid
from tests.llm.conftest import SMALL

SMALL_MODEL = langid.Settings(buckets=1 << 12, epochs=6)


def rows(n=60):
    return [(i, " ".join(("abba" if i % 2 else "ñolo") + str(k % 7) + ("kon" if i % 2 else "tir") for k in range(20)), "aa" if i % 2 else "nn") for i in range(n)]


def frame(spark, r):
    return spark.createDataFrame([(*x, 0.5) for x in r], "doc_id long, text string, lang string, score double")


def test_predictions_and_odd_rows(spark):
    df = frame(spark, rows())
    model = langid.fit(df, F.lit(True), SMALL_MODEL)
    assert model.languages == ["aa", "nn"]
    more = frame(spark, [(100, None, "aa"), (101, "", "aa"), (102, "123 ... 456", "aa"), (103, "abba kon abba", None), (None, "ñolo tir", "nn"),
                         (104, "日", "aa"), (105, "abba " * 60_000, "aa"), (106, "ñolo", "nn"), (106, "ñolo", "nn"), (107, "a", "aa")])
    got = langid.predict(df.unionByName(more), model).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 70 and all(by[i].lang_pred == ("aa" if i % 2 else "nn") for i in range(60))
    assert [by[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and all(by[i].rejected and by[i].score == 0 for i in (100, 101, 102))
    assert by[103].lang_pred == by[105].lang_pred == "aa" and by[None].lang_pred == "nn" and by[104].lang_pred in ("aa", "nn")
    assert all(0 <= r.score <= 1 for r in got)
    kept = langid.accepted(df.unionByName(more), model)
    assert kept.columns == df.columns and {100, 101, 102}.isdisjoint({r.doc_id for r in kept.collect()})


def test_fit_is_repeatable_and_ignores_rows_outside(spark):
    df = frame(spark, rows())
    a = langid.fit(df, F.col("doc_id") < 40, SMALL_MODEL)
    b = langid.fit(df.repartition(5).withColumn("lang", F.when(F.col("doc_id") < 40, F.col("lang")).otherwise("zz")), F.col("doc_id") < 40, SMALL_MODEL)
    assert a.languages == b.languages and np.allclose(a.table, b.table) and a.threshold == b.threshold


def test_nothing_to_learn_and_empty_table(spark):
    df = frame(spark, rows(4))
    assert langid.fit(df, F.lit(False), SMALL_MODEL) is None
    assert {r.lang_pred for r in langid.predict(df, None).collect()} == {"und"}
    assert langid.accepted(df, None).count() == 4
    assert langid.predict(frame(spark, []), langid.fit(df, F.lit(True), SMALL_MODEL)).count() == 0


def test_grams_do_not_cross_rows():
    data = np.frombuffer(b"abcdefgh", np.uint8)
    whole = [(r, b) for rs, bs in langid.grams(data, np.array([0, 3, 8]), 997) for r, b in zip(rs, bs)]
    parts = [(k, b) for k, part in enumerate((data[:3], data[3:])) for _, bs in langid.grams(part, np.array([0, len(part)]), 997) for b in bs]
    assert sorted(whole) == sorted(parts)


def test_held_out_accuracy(spark):
    from lakeloom.llm.queries import op7_language_id
    out = op7_language_id(spark, SMALL).join(spark.read.parquet(SMALL + "/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    assert out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.95


def test_foreign_script_and_gibberish_go_though_all_kept_out_rows_are_right(spark):
    rng = np.random.default_rng(3)
    docs = spark.read.parquet(SMALL + "/documents.parquet")
    model = langid.fit(docs, F.lit(True))
    assert 0 < model.threshold < 1
    consonants = " ".join("".join(rng.choice(list("bcdfghjklmnpqrstvwxz"), rng.integers(3, 9))) for _ in range(80))
    odd = [consonants, "Это длинный русский текст о том, как люди живут в большом городе. " * 4, "今日は天気がいいので、公園へ行きました。" * 5,
           "for (int i = 0; i < n; ++i) { buf[i] ^= key[i % klen]; if (!ptr->next) return -EINVAL; }\n" * 6]
    more = spark.createDataFrame([(i, t, "en", 0.5) for i, t in enumerate(odd)], "doc_id long, text string, lang string, score double")
    assert all(r.rejected for r in langid.predict(more, model).collect()) and langid.accepted(more, model).count() == 0
    clean = docs.where(F.size(F.split("text", r"\s+")) >= 20)
    assert langid.accepted(clean, model).count() >= 0.99 * clean.count()


def test_a_rare_language_is_learned(spark):
    rng = np.random.default_rng(5)
    text = lambda v: " ".join(rng.choice(v, 25))
    v = {"aa": ["abba", "kon", "mala", "abko"], "nn": ["ñolo", "tir", "ñati", "rilo"], "zz": ["żyć", "szept", "włos", "chrzą"]}
    langs = ["zz" if i % 500 == 7 else "aa" if i % 2 else "nn" for i in range(6000)]
    df = frame(spark, [(i, text(v[x]), x) for i, x in enumerate(langs)])
    settings = langid.Settings(buckets=1 << 12, epochs=2, sample=100)
    model = langid.fit(df, F.lit(True), settings)  # the 100 rows alone hold none or one of the 12 zz rows
    assert model.languages == ["aa", "nn", "zz"]
    new = frame(spark, [(i, text(v["zz"]), "zz") for i in range(20)])
    assert {r.lang_pred for r in langid.predict(new, model).collect()} == {"zz"}


def test_bounds():
    from lakeloom.llm import mixing
    assert langid.Settings().sample >= 4000 and langid.Settings().buckets >= 1 << 15 and mixing.Settings().sample >= 8000
