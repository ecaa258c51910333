import corpus_pipeline
from lakeloom.llm import queries
from tests.llm.conftest import SMALL, words
from tests.llm.test_line_dedup import brute as line_brute
from tests.llm.test_ngram_join import brute as near_brute
from tests.llm.test_decontaminate import brute as hit_brute


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()))


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    stage = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights"]
    first = stage["language ID"](spark, docs, SMALL)
    before, after = texts(docs), texts(first)
    assert first.columns == docs.columns and set(after) <= set(before) and len(after) >= 0.99 * len([t for _, t in before if words(t)])
    second = stage["line dedup"](spark, first, SMALL)
    assert second.columns == docs.columns
    n_dropped = {i: n for i, _, n, _ in line_brute(after)}
    rows = {r.doc_id: r for r in second.collect()}
    assert all(r.n_chars == len(r.text) for r in rows.values()) and {i for i, t in after if rows[i].text != t} == {i for i, n in n_dropped.items() if n}
    third = stage["n-gram Jaccard join"](spark, second, SMALL)
    group = {i: c for i, _, c in near_brute(texts(second))}
    assert texts(third) == [x for x in texts(second) if group[x[0]] == x[0]]
    fourth = stage["benchmark decontamination"](spark, third, SMALL)
    bad = {r[0] for r in hit_brute(texts(third), items) if r[4]}
    assert texts(fourth) == [x for x in texts(third) if x[0] not in bad] and fourth.columns == docs.columns
    last = stage["mixing sources to target weights"](spark, fourth, SMALL)
    assert last.columns == [*docs.columns, "mix_rate"] and set(texts(last)) <= set(texts(fourth)) and last.where("mix_rate <= 0").count() == 0


def test_registered():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_near_copies_by_five_words_and_80_percent(spark):
    base = [f"w{k}" for k in range(1000)]
    changed = [f"x{k}" if k % 47 == 20 else w for k, w in enumerate(base)]  # 21 words
    other = [f"v{k}" for k in range(1000)]
    far = [f"y{k}" if k % 31 == 20 else w for k, w in enumerate(other)]  # 32 words: 0.72
    rows = [(1, base), (2, changed), (3, base + [f"z{k}" for k in range(200)]), (4, other), (5, far)]
    rows = [(i, " ".join(w)) for i, w in rows]
    got = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"](spark, spark.createDataFrame(rows, "doc_id long, text string"), SMALL)
    assert sorted(r.doc_id for r in got.collect()) == [i for i, _, c in near_brute(rows, 5, 80) if c == i] == [1, 4, 5]
