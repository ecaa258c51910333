"""Algebraic properties checked on generated inputs (few examples each:
every example runs Spark jobs)."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeloom.functions import privacy as X
from lakeloom.operators import setops as U

ints = st.lists(st.integers(min_value=-5, max_value=15), max_size=30)


@settings(max_examples=8, deadline=None)
@given(ints, ints)
def test_set_size_laws(spark, a, b):
    A = spark.createDataFrame([(x,) for x in a], "x int")
    B = spark.createDataFrame([(x,) for x in b], "x int")
    union = U.distinct_union(A, B).count()
    inter = U.intersection(A, B).count()
    assert union == len(set(a) | set(b)) and inter == len(set(a) & set(b))
    assert union == len(set(a)) + len(set(b)) - inter
    assert U.symmetric_difference(A.distinct(), B.distinct()).count() == union - inter
    assert U.difference(A, B).count() == len(set(a) - set(b))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=1000), min_size=1, max_size=60),
       st.lists(st.floats(min_value=0.1, max_value=5), min_size=2, max_size=4))
def test_union_of_splits_is_input(spark, vals, weights):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v int")
    parts = df.randomSplit(weights, seed=3)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    assert sorted(tuple(r) for r in out.collect()) == sorted(tuple(r) for r in df.collect())


@settings(max_examples=8, deadline=None)
@given(st.text(alphabet="0123456789", min_size=8, max_size=20))
def test_mask_span_hides_exactly_the_span(spark, s):
    r = spark.createDataFrame([(s,)], "s string").select(X.mask_span("s", 4, 8).alias("m")).first().m
    assert r[:4] == s[:4] and r[4:8] == "xxxx" and r[8:] == s[8:]
