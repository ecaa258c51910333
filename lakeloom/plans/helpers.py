"""Column helpers (strings, arrays, maps, numbers, NULL rows) on every row of
the test tables, through the library functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import collections as C
from lakeloom.functions import math as M
from lakeloom.functions import privacy as X
from lakeloom.functions import strings as S
from lakeloom.operators import aggregates as A
from lakeloom.operators import nulls as NO
from lakeloom.operators import projection as P
from lakeloom.plans._common import cents, register, table


def _text(a):
    return F.array_join(F.transform(a, lambda x: x.cast("string")), ",")


@register("f4_f21_string_helpers", """
SELECT p_partkey, substring(p_name, 3, greatest(length(p_name) - 4, 0)) AS inner_part, right(p_name, 4) AS tail,
  ltrim(p_brand, 'Bra') AS brand_left, rtrim(p_name, 'gtr') AS name_right,
  array_to_string(list_filter(range(0, length(p_name)), lambda i: p_name[i + 1] = 'e'), ',') AS e_positions,
  regexp_replace(p_type, '[aeiouAEIOU]', '', 'g') AS no_vowels, regexp_replace(p_brand, '[^A-Za-z0-9_ ]', '', 'g') AS no_punctuation,
  list_filter(w, lambda x: length(x) = list_max(list_transform(w, lambda y: length(y))))[1] AS longest,
  list_filter(w, lambda x: length(x) = list_min(list_transform(w, lambda y: length(y))))[1] AS shortest,
  array_to_string(list_filter(w, lambda x: starts_with(lower(x), 'b')), '+') AS b_words,
  CASE WHEN length(size) >= 2 THEN size ELSE lpad(size, 2, '0') END AS size_padded,
  regexp_replace(p_name, '[aeiou]+', '*', 'g') AS starred, length(regexp_replace(p_name, '[^ ]', '', 'g')) AS n_spaces,
  length(regexp_replace(p_brand, '[A-Za-z0-9 ]', '', 'g')) AS n_specials, p_name = lower(p_name) AS is_lower,
  trim(p_name) = '' AND p_name <> '' AS is_space,
  array_to_string(list_sort(list_intersect(list_distinct(string_split(lower(p_type), '')), string_split(p_name, ''))), '') AS common,
  repeat('*', greatest(length(p_name) - 3, 0)) || right(p_name, 3) AS masked
FROM (SELECT *, list_filter(string_split(p_name, ' '), lambda x: x <> '') AS w, CAST(p_size AS VARCHAR) AS size FROM part)""")
def f4_f21_string_helpers(spark, sf):
    size = F.col("p_size").cast("string")
    return table(spark, sf, "part").select(
        "p_partkey", S.py_slice("p_name", 2, -2).alias("inner_part"), S.py_slice("p_name", -4).alias("tail"),
        S.lstrip("p_brand", "Bra").alias("brand_left"), S.rstrip("p_name", "gtr").alias("name_right"),
        _text(S.all_positions("p_name", "e")).alias("e_positions"), S.remove_vowels("p_type").alias("no_vowels"),
        S.remove_punctuation("p_brand").alias("no_punctuation"), S.longest_word("p_name").alias("longest"),
        S.shortest_word("p_name").alias("shortest"), S.join_array(S.words_starting_with("p_name", "b", ignore_case=True), "+").alias("b_words"),
        S.pad_left_no_truncate(size, 2, "0").alias("size_padded"), S.regex_replace("p_name", "[aeiou]+", "*").alias("starred"),
        S.count_spaces("p_name").alias("n_spaces"), S.count_specials("p_brand").alias("n_specials"), S.is_lower("p_name").alias("is_lower"),
        S.is_space("p_name").alias("is_space"), S.join_array(S.common_chars(F.lower("p_type"), "p_name"), "").alias("common"),
        X.mask_keep_last_same_length("p_name", 3).alias("masked"))


@register("c18_c24_collection_helpers", """
WITH o AS (SELECT l_orderkey, list_sort(list_distinct(list(l_linenumber))) AS ks, list_sort(list_distinct(list(l_suppkey % 7))) AS b FROM lineitem GROUP BY 1)
SELECT l_orderkey, array_to_string(list_concat(ks, b), ',') AS extended, array_to_string(list_filter(ks, lambda x: x <> 2), ',') AS without_two,
  list_min(b) AS smallest, list_max(list_filter(ks, lambda x: x % 3 = 0)) AS last_zero, list_max(list_filter(ks, lambda x: x % 3 = 1)) AS last_one,
  len(list_distinct(list_transform(ks, lambda x: x % 3))) AS n_inverted, 100 AS updated_one,
  CASE WHEN list_contains(ks, 2) THEN 2 END AS kept_two, len(list_filter(ks, lambda x: x <> 2)) AS n_dropped,
  array_to_string(list_concat(list_concat(list_reverse_sort(list_filter(ks, lambda x: x % 3 = 2)), list_reverse_sort(list_filter(ks, lambda x: x % 3 = 1))),
                              list_reverse_sort(list_filter(ks, lambda x: x % 3 = 0))), ',') AS by_value,
  CAST(list_sum(ks) AS BIGINT) AS total
FROM o""")
def c18_c24_collection_helpers(spark, sf):
    o = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_set("l_linenumber")).alias("ks"), F.array_sort(F.collect_set(F.col("l_suppkey") % 7)).alias("b"))
    o = P.with_columns(o, {"m": F.map_from_arrays("ks", F.transform("ks", lambda x: x % 3))})
    o = P.with_columns(o, {"inverted": C.map_invert("m"), "updated": C.map_update("m", F.create_map(F.lit(1), F.lit(100)))})
    by_value = C.map_sorted_by_value("m", descending=True)
    return o.select(
        "l_orderkey", _text(C.extend(F.col("ks").cast("array<bigint>"), "b")).alias("extended"), _text(C.remove_all("ks", 2)).alias("without_two"),
        C.array_min("b").alias("smallest"), F.try_element_at("inverted", F.lit(0)).alias("last_zero"),
        F.try_element_at("inverted", F.lit(1)).alias("last_one"), F.size("inverted").alias("n_inverted"),
        F.try_element_at("updated", F.lit(1)).alias("updated_one"), F.try_element_at("updated", F.lit(2)).alias("kept_two"),
        F.size(C.map_drop_key("m", 2)).alias("n_dropped"), _text(F.transform(by_value, lambda e: e["key"])).alias("by_value"),
        C.map_sum_lists(F.create_map(F.lit("all"), F.col("ks")))["all"].alias("total"))


@register("m2_m8_numeric_helpers", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(round_even(l_partkey / 2, 0) AS DOUBLE) AS half_even,
  CAST(trunc((l_partkey - 500) / 7) AS BIGINT) AS truncated, abs(l_partkey - 500) AS distance,
  (l_quantity - 32) * 5 / 9 AS celsius, round(radians(l_quantity), 9) AS radians, round(sqrt(l_quantity * l_quantity + l_linenumber * l_linenumber), 9) AS diagonal,
  l_quantity + l_linenumber AS first_sum, CAST(l_quantity + 3 AS DOUBLE) AS row_sum, greatest(l_quantity, 3.0) AS row_max,
  round(l_extendedprice * pow(1 + l_linenumber / 100, 2), 6) AS amount
FROM lineitem""")
def m2_m8_numeric_helpers(spark, sf):
    l = table(spark, sf, "lineitem")
    q, n = F.col("l_quantity"), F.col("l_linenumber").cast("double")
    matrix = F.array(F.array(q, F.lit(3.0)))
    return l.select(
        "l_orderkey", "l_linenumber", "l_partkey", M.round_half_even(F.col("l_partkey") / 2).alias("half_even"),
        M.trunc_div(F.col("l_partkey") - 500, F.lit(7)).alias("truncated"), M.abs_(F.col("l_partkey") - 500).alias("distance"),
        M.fahrenheit_to_celsius(q).alias("celsius"), F.round(M.degrees_to_radians(q), 9).alias("radians"),
        F.round(M.hypotenuse(q, n), 9).alias("diagonal"), M.vector_add(F.array(q), F.array(n))[0].alias("first_sum"),
        M.row_sums(matrix)[0].alias("row_sum"), M.row_maxes(matrix)[0].alias("row_max"),
        F.round(M.compound_amount(F.col("l_extendedprice"), n, F.lit(2)), 6).alias("amount"))


@register("a22_conditional_by_group", """
SELECT o_orderpriority, COUNT_IF(o_orderstatus = 'F') AS finished, COUNT_IF(o_totalprice > 200000) AS large,
  SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(round(o_totalprice * 100) AS BIGINT) END)::BIGINT AS finished_cents,
  SUM(CASE WHEN o_totalprice > 200000 THEN CAST(round(o_totalprice * 100) AS BIGINT) END)::BIGINT AS large_cents
FROM orders GROUP BY 1""")
def a22_conditional_by_group(spark, sf):
    o = table(spark, sf, "orders").withColumn("amount", cents("o_totalprice"))
    tests = {"finished": F.col("o_orderstatus") == "F", "large": F.col("o_totalprice") > 200000}
    counts = A.conditional_counts(o, tests, "o_orderpriority")
    sums = A.conditional_sums(o, "amount", {f"{k}_cents": v for k, v in tests.items()}, "o_orderpriority")
    return counts.join(sums, "o_orderpriority")


@register("a24_char_frequency", """
SELECT p_brand, c AS char, COUNT(*) AS count FROM (SELECT p_brand, unnest(string_split(p_name, '')) AS c FROM part) GROUP BY 1, 2""")
def a24_char_frequency(spark, sf):
    return A.char_frequency(table(spark, sf, "part"), "p_name", "p_brand")


@register("n12_n13_null_rows", """
SELECT event_id, CAST(value IS NULL OR reading IS NULL AS INTEGER) AS any_null, CAST(value IS NULL AS INTEGER) AS value_is_null,
  CAST(reading IS NULL AS INTEGER) AS reading_is_null
FROM (SELECT *, CASE WHEN event_type <> 'error' THEN value END AS reading FROM events)""")
def n12_n13_null_rows(spark, sf):
    """Rows with and without a NULL, each marked by the operator that picks it."""
    e = table(spark, sf, "events").select("event_id", "value", F.when(F.col("event_type") != "error", F.col("value")).alias("reading"))
    cols = ["value", "reading"]
    marked = NO.rows_with_any_null(e, cols).withColumn("any_null", F.lit(1)).unionByName(
        NO.rows_without_null(e, cols).withColumn("any_null", F.lit(0)))
    return NO.null_indicators(marked, cols).drop(*cols)
