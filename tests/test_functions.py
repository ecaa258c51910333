"""Column functions on small hand-worked fixtures (FIXTURES.md)."""

import datetime as dt

from pyspark.sql import functions as F

from lakeloom.functions import collections as C
from lakeloom.functions import conditional as K
from lakeloom.functions import dates as D
from lakeloom.functions import math as M
from lakeloom.functions import nulls as N
from lakeloom.functions import privacy as X
from lakeloom.functions import strings as S


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("x")).collect()]


def test_case_and_title(spark):
    data = [("data-science",), ("hello world",), (None,)]
    assert one(spark, S.initcap("s"), data, "s string") == ["Data-science", "Hello World", None]
    assert one(spark, S.title_case("s"), data, "s string") == ["Data-Science", "Hello World", None]
    assert one(spark, S.capitalize("s"), [("hELLO wORLD",)], "s string") == ["Hello world"]


def test_strip_split_replace(spark):
    assert one(spark, S.strip("s", "#x"), [("##xabcx#",)], "s string") == ["abc"]
    assert one(spark, S.split_words("s"), [("  a  b\tc ",), ("",)], "s string") == [["a", "b", "c"], []]
    assert one(spark, S.replace_first("s", "a", "X", 2), [("banana",)], "s string") == ["bXnXna"]
    assert one(spark, S.split_part("s", ",", -1), [("a,b,c",)], "s string") == ["c"]
    assert one(spark, S.split_part("s", ",", 5), [("a,b,c",)], "s string") == [None]


def test_find_count_slice(spark):
    d = [("hello world hello",)]
    assert one(spark, S.find("s", "world"), d, "s string") == [6]
    assert one(spark, S.find("s", "xyz"), d, "s string") == [-1]
    assert one(spark, S.all_positions("s", "hello"), d, "s string") == [[0, 12]]
    assert one(spark, S.count_substring("s", "l"), d, "s string") == [5]
    assert one(spark, S.py_slice("s", -5), d, "s string") == ["hello"]
    assert one(spark, S.py_slice("s", 0, 5), d, "s string") == ["hello"]


def test_word_stats_and_classes(spark):
    d = [("The quick brown fox jumps over the lazy dog 42",)]
    assert one(spark, S.word_count("s"), d, "s string") == [10]
    assert one(spark, S.longest_word("s"), d, "s string") == ["quick"]
    assert one(spark, S.shortest_word("s"), d, "s string") == ["42"]
    assert one(spark, S.count_vowels("s"), d, "s string") == [11]
    assert one(spark, S.count_digits("s"), d, "s string") == [2]
    assert one(spark, S.reverse_words("s"), [("a b c",)], "s string") == ["c b a"]
    assert one(spark, S.is_palindrome("s", True), [("A man, a plan, a canal: Panama",)], "s string") == [True]
    assert one(spark, S.digits_only("s"), [("abc123def456ghi789",)], "s string") == ["123456789"]
    assert one(spark, S.alternating_case("s"), [("hello world",)], "s string") == ["hElLo wOrLd"]
    assert one(spark, S.common_chars("a", "b"), [("hello", "world")], "a string, b string") == [["l", "o"]]
    assert one(spark, S.is_upper("s"), [("ABC 1",), ("AbC",)], "s string") == [True, False]


def test_email_rule(spark):
    d = [("a.b@example.com",), ("a,b@example.com",), ("nobody",), (None,)]
    assert one(spark, S.is_valid_email("s"), d, "s string") == [True, False, False, False]


def test_dates(spark):
    df = spark.createDataFrame([(dt.date(2026, 1, 15),)], "d date")
    r = df.select(D.day_of_week("d"), D.last_day("d"), D.next_day("d", "Mon"), D.add_months("d", -2),
                  D.days_between(F.lit(dt.date(2026, 2, 1)), "d"), D.format_date("d", "dd-MM-yyyy"),
                  D.week_end_sunday("d"), D.date_key("d")).first()
    assert list(r) == [5, dt.date(2026, 1, 31), dt.date(2026, 1, 19), dt.date(2025, 11, 15), 17, "15-01-2026",
                       dt.date(2026, 1, 18), 20260115]
    bad = spark.createDataFrame([("2026-13-45",)], "s string").select(D.to_date("s")).first()[0]
    assert bad is None


def test_in_year_pushes_down(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").where(D.in_year("o_orderdate", 1998))
    from lakeloom.sources.catalog import explain_plan
    plan = explain_plan(df)
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_math(spark):
    df = spark.createDataFrame([(-7, 2), (7, -3)], "a long, b long")
    assert [tuple(r) for r in df.select(M.floor_div("a", "b"), M.py_mod("a", "b"), M.trunc_div("a", "b")).collect()] \
        == [(-4, 1, -3), (-3, -2, -2)]
    vals = spark.createDataFrame([(0.0,), (-4.0,), (4.0,), (None,)], "x double")
    got = [tuple(r) for r in vals.select(*[M.feature_transform("x", k) for k in ("log", "reciprocal", "square_root", "power")]).collect()]
    assert got[0][:3] == (None, None, 0.0) and got[1][:3] == (None, -0.25, None) and got[2][2] == 2.0
    assert got[2][3] == 256.0 and got[3] == (None, None, None, None)
    assert one(spark, M.round_half_even("x", 1), [(0.25,)], "x double") == [0.2]
    assert one(spark, M.safe_divide("x", 0), [(1.0,)], "x double") == [None]


def test_banding_and_binning(spark):
    d = [(25.0,), (30.0,), (0.0,), (None,), (101.0,)]
    assert one(spark, K.bucketize("x", [0, 25, 30, 100], ["young", "mid", "old"]), d, "x double") == \
        ["young", "mid", None, None, None]
    b = K.band("x", [(26, "low")], "high", null_label="unknown")
    assert one(spark, b, d, "x double") == ["low", "high", "low", "unknown", "high"]
    assert one(spark, K.map_values("k", {1: "Low", 2: "High"}), [(1,), (3,)], "k int") == ["Low", None]


def test_collections(spark):
    df = spark.createDataFrame([([3, 1, 2, 1],)], "a array<int>")
    r = df.select(C.index_of("a", 2), C.count_value("a", 1), C.rotate_left("a", 1), C.insert_at("a", -1, 9),
                  C.remove_first("a", 1), C.pop("a", 0), C.safe_item("a", 10), C.safe_item("a", -1)).first()
    assert list(r) == [2, 2, [1, 2, 1, 3], [3, 1, 2, 9, 1], [3, 2, 1], [1, 2, 1], None, 1]
    m = spark.createDataFrame([({"a": 1, "b": None}, {"a": 2, "c": 3})], "x map<string,int>, y map<string,int>")
    r = m.select(C.map_merge_sum("x", "y"), C.map_nulls_to_zero("x"), C.map_get("x", "zz"),
                 C.map_sorted_by_value("y", True)).first()
    assert r[0] == {"a": 3, "b": 0, "c": 3} and r[1] == {"a": 1, "b": 0} and r[2] is None
    assert [tuple(e) for e in r[3]] == [("c", 3), ("a", 2)]
    z = spark.createDataFrame([(["a", "b", "c", "d"], [1, 2, 3])], "s array<string>, r array<int>")
    zipped = z.select(C.zip_arrays("s", "r")).first()[0]
    assert tuple(zipped[-1]) == ("d", None)


def test_nulls(spark):
    df = spark.createDataFrame([(None, "x"), (1, None), (2, "y")], "a int, b string")
    got = [tuple(r) for r in df.select(N.any_null(["a", "b"]), N.no_null(["a", "b"]), N.null_indicator("a"),
                                       N.nvl2("a", "has", "none")).collect()]
    assert got == [(True, False, 1, "none"), (True, False, 0, "has"), (False, True, 0, "has")]


def test_privacy(spark):
    df = spark.createDataFrame([("177236474698698",), ("182736405847",), (None,)], "s string")
    r = df.select(X.mask_keep_last("s", 4, "*******"), X.mask_keep_middle("s", 4), X.mask_span("s", 4, 8),
                  X.hash_col("s")).collect()
    assert r[0][0] == "*******8698" and r[1][1] == "XXXX3640XXXX" and r[1][2] == "1827xxxx5847"
    assert r[2][0] == "unknown" and r[2][3] == "unknown" and len(r[0][3]) == 64
    key = "0123456789abcdef"
    back = df.select(X.decrypt_col(X.encrypt_col("s", key), key).alias("t")).collect()
    assert [x.t for x in back] == ["177236474698698", "182736405847", None]


def test_udf_surface_matches_builtins(spark):
    from lakeloom.functions import udfs as Uf
    df = spark.createDataFrame([(1500.0, "data-science"), (300.0, "ab"), (10.0, None), (None, "x"), (299.99, "y")], "a double, s string")
    edges = [(100.0, "small"), (300.0, "middle")]
    r = df.select(Uf.bands("a", edges, "large").alias("b1"), Uf.bands_udf(edges, "large")("a").alias("b2"),
                  Uf.times("a", 0.9).alias("d1"), Uf.times_pandas(0.9)("a").alias("d2"), Uf.times_udf(0.9)("a").alias("d3"),
                  Uf.upper_udf("s").alias("u"), Uf.title_udf("s").alias("t")).collect()
    assert [(x.b1, x.d1) for x in r] == [(x.b2, x.d2) for x in r] == [(x.b2, x.d3) for x in r]
    assert [x.b1 for x in r] == ["large", "large", "small", None, "middle"]
    assert r[0].t == "Data-Science" and r[2].u is None


def test_more_string_helpers(spark):
    d = [("xxhixx",)]
    assert one(spark, S.lstrip("s", "x"), d, "s string") == ["hixx"]
    assert one(spark, S.rstrip("s", "x"), d, "s string") == ["xxhi"]
    assert one(spark, S.lstrip("s"), [("  a ",)], "s string") == ["a "]
    assert one(spark, S.pad_left_no_truncate("s", 3, "0"), [("7",), ("12345",)], "s string") == ["007", "12345"]
    assert one(spark, S.lpad("s", 3, "0"), [("12345",)], "s string") == ["123"]
    freq = one(spark, S.char_frequency("s"), [("hello",)], "s string")[0]
    assert freq == {"h": 1, "e": 1, "l": 2, "o": 1}
    assert one(spark, S.words_starting_with("s", "p"), [("pen apple pear",)], "s string") == [["pen", "pear"]]
    assert one(spark, S.remove_punctuation("s"), [("a,b! c",)], "s string") == ["ab c"]


def test_more_math_helpers(spark):
    r = spark.createDataFrame([(3.0, 4.0, 98.6)], "a double, b double, f double").select(
        M.hypotenuse("a", "b"), M.fahrenheit_to_celsius("f"), M.compound_amount(F.lit(1000.0), F.lit(5.5), F.lit(3)),
        M.vector_add(F.array(F.lit(1), F.lit(2)), F.array(F.lit(10), F.lit(20), F.lit(30)))).first()
    assert r[0] == 5.0 and abs(r[1] - 37.0) < 1e-9 and abs(r[2] - 1000 * 1.055 ** 3) < 1e-6
    assert list(r[3]) == [11, 22, None]
    m = spark.createDataFrame([([[1, 2], [3, None]],)], "m array<array<int>>").select(M.row_sums("m"), M.row_maxes("m")).first()
    assert list(m[0]) == [3.0, 3.0] and list(m[1]) == [2, 3]


def test_map_invert_keeps_the_last_key(spark):
    got = one(spark, C.map_invert("m"), [({"a": 1, "b": 2, "c": 1, "d": None},), ({},), (None,)], "m map<string,int>")
    assert got == [{1: "c", 2: "b"}, {}, None]


def test_char_frequency_of_odd_texts(spark):
    assert one(spark, S.char_frequency("s"), [("",), (None,), ("é.é*",)], "s string") == [{}, None, {"é": 2, ".": 1, "*": 1}]
