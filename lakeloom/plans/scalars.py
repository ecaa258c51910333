"""Column-function reports: strings, dates, math, NULLs, arrays/maps and
projection helpers, applied to every row of the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import collections as C
from lakeloom.functions import conditional as K
from lakeloom.functions import dates as D
from lakeloom.functions import math as M
from lakeloom.functions import nulls as N
from lakeloom.functions import strings as S
from lakeloom.operators import nulls as NO
from lakeloom.operators import projection as P
from lakeloom.plans._common import dsum, register, table


# ---------------------------------------------------------------- strings F1-F11
@register("f1_f11_string_functions", """
SELECT p_partkey, upper(p_name) AS upper_name, lower(p_type) AS lower_type, CAST(length(p_name) AS INTEGER) AS name_len,
  array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS initcap_name,
  upper(p_type[1]) || lower(p_type[2:]) AS capitalized_type, trim(p_brand, 'Brand#') AS brand_no,
  split_part(p_name, ' ', 1) AS first_word, concat_ws('-', p_brand, p_type) AS brand_type,
  p_type || NULLIF(p_brand, 'Brand#1') AS type_brand_or_null, lpad(CAST(p_size AS VARCHAR), 4, '0') AS size_padded,
  rpad(p_type, 10, '.') AS type_padded, replace(p_name, ' ', '_') AS name_snake,
  regexp_replace(p_name, 'e', 'E') AS name_first_e, substring(p_name, 1, 3) AS name_prefix, right(p_brand, 2) AS brand_suffix,
  CAST(strpos(p_name, 'ring') - 1 AS INTEGER) AS ring_pos,
  CAST((length(p_name) - length(replace(p_name, 'e', ''))) AS INTEGER) AS e_count
FROM part""")
def f1_f11_string_functions(spark, sf):
    p = table(spark, sf, "part")
    return p.select(
        "p_partkey", S.upper("p_name").alias("upper_name"), S.lower("p_type").alias("lower_type"),
        S.length("p_name").alias("name_len"), S.initcap("p_name").alias("initcap_name"),
        S.capitalize("p_type").alias("capitalized_type"), S.strip("p_brand", "Brand#").alias("brand_no"),
        S.split_part("p_name", " ", 0).alias("first_word"), S.concat_ws("-", "p_brand", "p_type").alias("brand_type"),
        S.concat("p_type", F.nullif(F.col("p_brand"), F.lit("Brand#1"))).alias("type_brand_or_null"),
        S.lpad(F.col("p_size").cast("string"), 4, "0").alias("size_padded"), S.rpad("p_type", 10, ".").alias("type_padded"),
        S.replace_all("p_name", " ", "_").alias("name_snake"), S.replace_first("p_name", "e", "E").alias("name_first_e"),
        S.substring("p_name", 1, 3).alias("name_prefix"), S.right("p_brand", 2).alias("brand_suffix"),
        S.find("p_name", "ring").alias("ring_pos"), S.count_substring("p_name", "e").alias("e_count"))


@register("f2_title_vs_initcap", r"""
SELECT p_partkey,
  array_to_string(list_transform(string_split(s, ''), lambda c, i: CASE WHEN i = 1 OR NOT regexp_matches(substring(s, i - 1, 1), '\p{L}')
                                                            THEN upper(c) ELSE lower(c) END), '') AS title,
  array_to_string(list_transform(string_split(s, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS initcap
FROM (SELECT p_partkey, p_type || '-' || p_name AS s FROM part)""")
def f2_title_vs_initcap(spark, sf):
    """Python ``title()`` capitalises after any non-letter (``Economy-Small
    Ring``); SQL ``initcap`` only after whitespace (``Economy-small Ring``)."""
    p = table(spark, sf, "part").select("p_partkey", F.concat_ws("-", "p_type", "p_name").alias("s"))
    return p.select("p_partkey", S.title_case("s").alias("title"), S.initcap("s").alias("initcap"))


@register("f16_f20_string_tests", """
SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS name_digits,
  regexp_full_match(c_name, '[^@\\s,]+@[^@\\s,]+\\.[^@\\s,]+') AS name_is_email,
  regexp_full_match(c_mktsegment, '\\p{L}+') AS segment_is_alpha,
  regexp_full_match(CAST(c_nationkey AS VARCHAR), '\\p{Nd}+') AS nation_is_digit,
  regexp_full_match(c_name, '[\\p{L}\\p{Nd}]+') AS name_is_alnum,
  (regexp_matches(c_mktsegment, '\\p{Lu}') AND NOT regexp_matches(c_mktsegment, '\\p{Ll}')) AS segment_is_upper,
  COALESCE(CAST(NULLIF(c_nationkey, 0) AS VARCHAR), 'unknown') AS nation_text,
  c_mktsegment = reverse(c_mktsegment) AS segment_is_palindrome
FROM customer""")
def f16_f20_string_tests(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(
        "c_custkey", S.digits_only("c_name").alias("name_digits"), S.is_valid_email("c_name").alias("name_is_email"),
        S.is_alpha("c_mktsegment").alias("segment_is_alpha"),
        S.is_digit(F.col("c_nationkey").cast("string")).alias("nation_is_digit"),
        S.is_alnum("c_name").alias("name_is_alnum"), S.is_upper("c_mktsegment").alias("segment_is_upper"),
        S.to_text(F.nullif(F.col("c_nationkey"), F.lit(0))).alias("nation_text"),
        S.is_palindrome("c_mktsegment").alias("segment_is_palindrome"))


# ---------------------------------------------------------------- dates T1-T11
@register("t1_t11_date_functions", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
  CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS parsed_date,
  CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  CAST(day(o_orderdate) AS INTEGER) AS day, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week,
  CAST(dayofyear(o_orderdate) AS INTEGER) AS day_of_year, CAST(weekofyear(o_orderdate) AS INTEGER) AS iso_week,
  CAST(quarter(o_orderdate) AS INTEGER) AS quarter, last_day(CAST(o_orderdate AS DATE)) AS month_end,
  CAST(o_orderdate AS DATE) + CAST(((1 - isodow(o_orderdate) + 6) % 7) + 1 AS INTEGER) AS next_monday,
  CAST(CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH AS DATE) AS plus_3_months,
  CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH AS DATE) AS minus_1_month,
  CAST(o_orderdate AS DATE) + 30 AS plus_30_days, CAST(o_orderdate AS DATE) - 20 AS minus_20_days,
  CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS INTEGER) AS days_to_2002,
  strftime(o_orderdate, '%d-%m-%Y') AS formatted, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
  CAST(date_trunc('year', o_orderdate) AS DATE) AS year_start,
  CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS week_end
FROM orders""")
def t1_t11_date_functions(spark, sf):
    o = table(spark, sf, "orders")
    d = F.to_date("o_orderdate")
    return o.select(
        "o_orderkey", d.alias("order_date"),
        D.to_date(D.format_date("o_orderdate", "yyyy-MM-dd"), "yyyy-MM-dd").alias("parsed_date"),
        D.year("o_orderdate").alias("year"), D.month("o_orderdate").alias("month"), D.day("o_orderdate").alias("day"),
        D.day_of_week("o_orderdate").alias("day_of_week"), D.day_of_year("o_orderdate").alias("day_of_year"),
        D.iso_week("o_orderdate").alias("iso_week"), D.quarter("o_orderdate").alias("quarter"),
        D.last_day(d).alias("month_end"), D.next_day(d, "Mon").alias("next_monday"),
        D.add_months(d, 3).alias("plus_3_months"), D.add_months(d, -1).alias("minus_1_month"),
        D.add_days(d, 30).alias("plus_30_days"), D.sub_days(d, 20).alias("minus_20_days"),
        D.days_between(D.date_lit("2002-01-01"), d).alias("days_to_2002"),
        D.format_date("o_orderdate", "dd-MM-yyyy").alias("formatted"),
        F.trunc(d, "MM").alias("month_start"), F.trunc(d, "year").alias("year_start"),
        D.week_end_sunday(d).alias("week_end"))


@register("t9_t11_time_functions", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
  CAST(second(ts) AS INTEGER) AS second, date_trunc('hour', ts) AS hour_start,
  strftime(ts, '%Y-%m-%d %H:%M') AS formatted, CAST(ts AS DATE) AS event_date,
  (hour(ts) = 0 AND minute(ts) = 0 AND second(ts) = 0) AS is_midnight
FROM events""")
def t9_t11_time_functions(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", D.hour("ts").alias("hour"), D.minute("ts").alias("minute"),
                    D.second("ts").alias("second"), D.trunc("ts", "hour").cast("timestamp_ntz").alias("hour_start"),
                    D.format_date("ts", "yyyy-MM-dd HH:mm").alias("formatted"), D.trunc_day("ts").alias("event_date"),
                    D.is_midnight("ts").alias("is_midnight"))


# ---------------------------------------------------------------- math M1-M7
@register("m1_m7_numeric_functions", """
SELECT l_orderkey, l_linenumber, l_extendedprice + l_tax AS plus, l_extendedprice - l_quantity AS minus,
  l_quantity * l_discount AS times, l_extendedprice / l_quantity AS divided, l_extendedprice % 7 AS modulo,
  l_extendedprice / NULLIF(l_tax, 0) AS safe_ratio,
  ROUND(CAST(l_extendedprice AS DECIMAL(18,2)), 1) AS round_1, ROUND(l_extendedprice, -2) AS round_neg2,
  CAST(floor((l_orderkey - 5000) / 7) AS BIGINT) AS floor_div,
  ((l_orderkey - 5000) % 7 + 7) % 7 AS py_mod,
  abs(l_extendedprice - 50000) AS abs_dev, ROUND(sqrt(l_extendedprice), 6) AS sqrt_price,
  ROUND(cbrt(l_extendedprice), 6) AS cbrt_price, ROUND(pow(l_quantity, 3), 6) AS qty_cubed,
  ROUND(ln(l_extendedprice), 6) AS log_price, ROUND(1.0 / l_quantity, 6) AS reciprocal_qty,
  ROUND(l_quantity / 100, 6) AS custom_qty, TRY_CAST(l_returnflag AS INTEGER) AS flag_as_int,
  CAST(l_quantity AS INTEGER) AS qty_int, CAST(l_linenumber AS VARCHAR) AS line_text,
  ROUND(l_discount * 100, 6) AS discount_pct, ROUND(l_extendedprice * 5.5 * 3 / 100, 6) AS simple_interest,
  ROUND(l_extendedprice * pow(1 + 5.5 / 100, 3) - l_extendedprice, 6) AS compound_interest
FROM lineitem""")
def m1_m7_numeric_functions(spark, sf):
    l = table(spark, sf, "lineitem")
    x, q = F.col("l_extendedprice"), F.col("l_quantity")
    r6 = lambda c: F.round(c, 6)
    k = F.col("l_orderkey") - 5000
    return l.select(
        "l_orderkey", "l_linenumber", (x + F.col("l_tax")).alias("plus"), (x - q).alias("minus"),
        (q * F.col("l_discount")).alias("times"), (x / q).alias("divided"), (x % 7).alias("modulo"),
        M.safe_divide("l_extendedprice", F.col("l_tax")).alias("safe_ratio"),
        M.round_half_up(x.cast("decimal(18,2)"), 1).alias("round_1"), M.round_half_up(x, -2).alias("round_neg2"),
        M.floor_div(k, 7).alias("floor_div"), M.py_mod(k, 7).alias("py_mod"),
        F.abs(x - 50000).alias("abs_dev"), r6(M.sqrt(x)).alias("sqrt_price"), r6(M.cbrt(x)).alias("cbrt_price"),
        r6(M.feature_transform(q, "cube")).alias("qty_cubed"), r6(M.feature_transform(x, "log")).alias("log_price"),
        r6(M.feature_transform(q, "reciprocal")).alias("reciprocal_qty"),
        r6(M.feature_transform(q, "custom")).alias("custom_qty"),
        M.safe_cast("l_returnflag", "int").alias("flag_as_int"), q.cast("int").alias("qty_int"),
        F.col("l_linenumber").cast("string").alias("line_text"),
        r6(M.percentage("l_discount", F.lit(1))).alias("discount_pct"),
        r6(M.simple_interest("l_extendedprice", F.lit(5.5), F.lit(3))).alias("simple_interest"),
        r6(M.compound_interest("l_extendedprice", F.lit(5.5), F.lit(3))).alias("compound_interest"))


@register("m5_feature_transforms", """
SELECT c_custkey, ROUND(CASE WHEN c_acctbal > 0 THEN ln(c_acctbal) END, 6) AS log,
  CASE WHEN c_acctbal <> 0 THEN 1.0 / c_acctbal END AS reciprocal,
  c_acctbal * c_acctbal AS square, CASE WHEN c_acctbal >= 0 THEN sqrt(c_acctbal) END AS square_root,
  c_acctbal * c_acctbal * c_acctbal AS cube, ROUND(pow(c_acctbal, 4) / 1e9, 4) AS power_e9,
  ROUND(c_acctbal / 100, 6) AS custom FROM customer""")
def m5_feature_transforms(spark, sf):
    """The feature dispatcher over a signed column: out-of-domain rows
    (log of <= 0, square root of < 0) give NULL."""
    c = table(spark, sf, "customer")
    ft = lambda k: M.feature_transform("c_acctbal", k)
    # single IEEE operations (x*x, 1/x, sqrt, x/100) are bit-identical
    # everywhere; only library functions (ln, pow) are rounded
    return c.select("c_custkey", F.round(ft("log"), 6).alias("log"), ft("reciprocal").alias("reciprocal"),
                    ft("square").alias("square"), ft("square_root").alias("square_root"), ft("cube").alias("cube"),
                    F.round(ft("power") / 1e9, 4).alias("power_e9"), F.round(ft("custom"), 6).alias("custom"))


@register("t1_t7_timestamp_and_months", """
SELECT o_orderkey, strptime(strftime(o_orderdate, '%Y-%m-%d') || ' 06:30:15', '%Y-%m-%d %H:%M:%S') AS parsed,
  ROUND((year(o_orderdate) - 1992) * 12 + month(o_orderdate) - 1 + (day(o_orderdate) - 1) / 31.0, 6) AS months FROM orders""")
def t1_t7_timestamp_and_months(spark, sf):
    """Order dates as text parsed to a timestamp, and months since 1992."""
    o = table(spark, sf, "orders")
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 06:30:15"))
    return o.select("o_orderkey", D.to_timestamp(text, "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz").alias("parsed"),
                    F.round(D.months_between("o_orderdate", F.lit("1992-01-01").cast("date")), 6).alias("months"))


@register("t10_run_date", """
SELECT o_orderkey, CAST(DATE '1998-08-02' - CAST(o_orderdate AS DATE) AS INTEGER) AS age_days, TIMESTAMP '1998-08-02 05:00:00' AS run_time FROM orders""")
def t10_run_date(spark, sf):
    """Days from the order to the run's date, which is a parameter of the run."""
    return table(spark, sf, "orders").select("o_orderkey", D.days_between(D.run_date("1998-08-02"), "o_orderdate").alias("age_days"),
                                             D.run_time("1998-08-02 05:00:00").alias("run_time"))


@register("c10_c13_zip_and_replicate", """
SELECT l_orderkey, l_linenumber, copy, CAST(l_quantity AS DOUBLE) AS quantity, l_linenumber * 10 + copy AS label
FROM lineitem, LATERAL (SELECT unnest(range(3)) AS copy) WHERE l_linenumber <= 2""")
def c10_c13_zip_and_replicate(spark, sf):
    """Each line three times: replicated numbers zipped with an array of labels."""
    l = table(spark, sf, "lineitem").where("l_linenumber <= 2").withColumn("n", C.replicate(3))
    l = l.withColumn("labels", F.transform("n", lambda i: F.col("l_linenumber") * 10 + i))
    z = l.select("l_orderkey", "l_linenumber", "l_quantity", F.explode(C.zip_arrays("n", "labels")).alias("z"))
    return z.select("l_orderkey", "l_linenumber", F.col("z.n").cast("long").alias("copy"), F.col("l_quantity").cast("double").alias("quantity"),
                    F.col("z.labels").alias("label"))


# ---------------------------------------------------------------- NULLs N1-N14
_GAPS_SQL = """(SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS credit,
  NULLIF(c_mktsegment, 'HOUSEHOLD') AS segment, NULLIF(c_nationkey, 0) AS nation FROM customer)"""


def _gaps(spark, sf):
    """Customers with NULLs introduced by cleansing rules: negative balances
    become NULL credit, one segment and nation 0 are recoded to NULL."""
    c = table(spark, sf, "customer")
    return c.select("c_custkey", "c_name", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("credit"),
                    F.nullif("c_mktsegment", F.lit("HOUSEHOLD")).alias("segment"),
                    F.nullif("c_nationkey", F.lit(0)).alias("nation"))


@register("n10_n11_null_profile", f"""
WITH g AS {_GAPS_SQL}, t AS (SELECT COUNT(*) AS rows FROM g)
SELECT col AS "column", rows, nulls, rows - nulls AS non_nulls, ROUND(CAST(nulls AS DOUBLE) * 100 / rows, 2) AS null_pct FROM (
  SELECT 'c_custkey' AS col, COUNT_IF(c_custkey IS NULL) AS nulls FROM g UNION ALL
  SELECT 'c_name', COUNT_IF(c_name IS NULL) FROM g UNION ALL SELECT 'credit', COUNT_IF(credit IS NULL) FROM g UNION ALL
  SELECT 'segment', COUNT_IF(segment IS NULL) FROM g UNION ALL SELECT 'nation', COUNT_IF(nation IS NULL) FROM g), t""")
def n10_n11_null_profile(spark, sf):
    return NO.null_profile(_gaps(spark, sf))


@register("n1_n13_null_expressions", f"""
SELECT c_custkey, credit IS NULL AS credit_missing, COALESCE(credit, 0) AS credit_or_zero,
  COALESCE(segment, 'unknown') AS segment_filled, CASE WHEN credit IS NOT NULL THEN 'has_credit' ELSE 'no_credit' END AS credit_state,
  NULLIF(nation, 1) AS nation_not_1, CASE WHEN nation IS NULL THEN -1 ELSE nation END AS nation_or_minus1,
  (credit IS NULL OR segment IS NULL OR nation IS NULL) AS any_null,
  (credit IS NOT NULL AND segment IS NOT NULL AND nation IS NOT NULL) AS no_null,
  CASE WHEN segment IS NULL THEN 1 ELSE 0 END AS segment_is_null
FROM {_GAPS_SQL}""")
def n1_n13_null_expressions(spark, sf):
    g = _gaps(spark, sf)
    cols = ["credit", "segment", "nation"]
    return g.select("c_custkey", F.col("credit").isNull().alias("credit_missing"),
                    N.nvl("credit", F.lit(0.0)).alias("credit_or_zero"), N.nvl("segment", "unknown").alias("segment_filled"),
                    N.nvl2("credit", "has_credit", "no_credit").alias("credit_state"),
                    N.nullif("nation", 1).alias("nation_not_1"), N.when_null("nation", -1).alias("nation_or_minus1"),
                    N.any_null(cols).alias("any_null"), N.no_null(cols).alias("no_null"),
                    N.null_indicator("segment").alias("segment_is_null"))


@register("n2_n5_fill_and_drop", f"""
WITH g AS {_GAPS_SQL}
SELECT 'rows_no_null' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM g
  WHERE credit IS NOT NULL AND segment IS NOT NULL AND nation IS NOT NULL
UNION ALL SELECT 'rows_not_all_null', COUNT(*) FROM g WHERE NOT (credit IS NULL AND segment IS NULL AND nation IS NULL)
UNION ALL SELECT 'rows_thresh_2', COUNT(*) FROM g
  WHERE (CAST(credit IS NOT NULL AS INT) + CAST(segment IS NOT NULL AS INT) + CAST(nation IS NOT NULL AS INT)) >= 2
UNION ALL SELECT 'rows_credit_present', COUNT(*) FROM g WHERE credit IS NOT NULL
UNION ALL SELECT 'credit_filled_sum', CAST(SUM(CAST(COALESCE(credit, 0) AS DECIMAL(18,2))) AS DOUBLE) FROM g
UNION ALL SELECT 'segment_unknown', COUNT(*) FROM g WHERE COALESCE(segment, 'unknown') = 'unknown'""")
def n2_n5_fill_and_drop(spark, sf):
    """Row counts after each drop rule and totals after the fills, one row
    per measure."""
    g = _gaps(spark, sf)
    sub = ["credit", "segment", "nation"]
    filled = NO.fill(g, mapping={"credit": 0.0, "segment": "unknown"})

    def measure(name, df, value):
        return df.agg(value.cast("double").alias("value")).select(F.lit(name).alias("metric"), "value")

    n = F.count(F.lit(1))
    parts = [
        measure("rows_no_null", NO.drop_null_rows(g, "any", sub), n),
        measure("rows_not_all_null", NO.drop_null_rows(g, "all", sub), n),
        measure("rows_thresh_2", NO.drop_null_rows(g, thresh=2, subset=sub), n),
        measure("rows_credit_present", NO.drop_null_rows(g, "any", ["credit"]), n),
        measure("credit_filled_sum", filled, dsum("credit")),
        measure("segment_unknown", filled, F.count_if(F.col("segment") == "unknown")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("n3_fill_with_mean", f"""
WITH g AS {_GAPS_SQL}
SELECT c_custkey, ROUND(COALESCE(credit, (SELECT AVG(credit) FROM g)), 6) AS credit FROM g""")
def n3_fill_with_mean(spark, sf):
    out = NO.fill_with_stat(_gaps(spark, sf), ["credit"], "mean")
    return out.select("c_custkey", F.round("credit", 6).alias("credit"))


@register("n6_drop_null_columns", f"SELECT c_custkey, c_name FROM {_GAPS_SQL}")
def n6_drop_null_columns(spark, sf):
    return NO.drop_null_columns(_gaps(spark, sf), "any")


@register("n14_threshold_treatment", f"""
WITH g AS {_GAPS_SQL}
SELECT c_custkey, c_name, ROUND(COALESCE(credit, (SELECT AVG(credit) FROM g)), 6) AS credit,
  ROUND(COALESCE(CAST(nation AS DOUBLE), (SELECT AVG(nation) FROM g)), 6) AS nation FROM g""")
def n14_threshold_treatment(spark, sf):
    """Columns with >= 10 % NULLs are dropped (segment); the rest are filled
    with their mean (an integer column becomes double, as in pandas)."""
    out, dropped = NO.treat_nulls(_gaps(spark, sf), 10.0)
    return out.select("c_custkey", "c_name", F.round("credit", 6).alias("credit"), F.round("nation", 6).alias("nation"))


@register("n3_fill_with_median", f"""
WITH g AS {_GAPS_SQL}
SELECT c_custkey, ROUND(COALESCE(credit, (SELECT MEDIAN(credit) FROM g)), 6) AS credit FROM g""")
def n3_fill_with_median(spark, sf):
    out = NO.fill_with_stat(_gaps(spark, sf), ["credit"], "median")
    return out.select("c_custkey", F.round("credit", 6).alias("credit"))


# ---------------------------------------------------------------- arrays, structs, maps
# Fixed value: Java's \\s class spelled out for the SQL engine.
_SQL_WORDS = "regexp_extract_all({t}, '[^\\t\\n\\x0B\\f\\r ]+')"
_TURNS_SQL = f"""(SELECT a.conv_id, a.turn, {_SQL_WORDS.format(t='a.text')} AS w, {_SQL_WORDS.format(t='b.text')} AS nw
  FROM conversations a LEFT JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1)"""


def _turn_words(spark, sf):
    """Word arrays of every conversation turn and of the turn after it (a
    self join on the unique (conversation, turn) key; the last turn has no
    successor). Arrays come from each row's own text, never from
    collecting a group."""
    c = table(spark, sf, "conversations")
    cur = c.select("conv_id", "turn", S.split_words("text").alias("w"))
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), S.split_words("text").alias("nw"))
    return cur.join(nxt, ["conv_id", "turn"], "left")


@register("c1_c24_array_functions", f"""
SELECT conv_id, turn, CAST(len(w) AS INTEGER) AS n_words, w[1] AS first_word, w[2] AS second_word, w[-1] AS last_word,
  list_contains(w, 'the') AS has_the, CAST(len(list_filter(w, lambda x: x = w[1])) AS INTEGER) AS first_word_count,
  CAST(list_position(w, w[-1]) - 1 AS INTEGER) AS last_word_index, CAST(len(list_distinct(w)) AS INTEGER) AS n_distinct,
  list_reverse(w)[1] AS reversed_first, CASE WHEN len(w) > 0 THEN w[(2 % len(w)) + 1] END AS rotated_first,
  CAST(COALESCE(list_sum(list_transform(w, lambda x: length(x))), 0) AS INTEGER) AS total_len,
  CAST(len(list_filter(w, lambda x: length(x) % 2 = 0)) AS INTEGER) AS even_len_words,
  CAST(list_max(list_transform(w, lambda x: length(x))) AS INTEGER) AS max_len,
  CASE WHEN nw IS NOT NULL THEN CAST(len(list_intersect(w, nw)) AS INTEGER) END AS n_common,
  CASE WHEN nw IS NOT NULL THEN CAST(len(list_distinct(list_concat(w, nw))) AS INTEGER) END AS n_union,
  CASE WHEN nw IS NOT NULL THEN CAST(len(list_filter(list_distinct(w), lambda x: NOT list_contains(nw, x))) AS INTEGER) END AS n_only_here,
  CAST(len(w) + 1 AS INTEGER) AS appended_len, CASE WHEN len(w) >= 1 THEN '<x>' END AS inserted_second,
  CASE WHEN len(w) >= 1 THEN CAST(len(w) - 1 AS INTEGER) END AS removed_len,
  CASE WHEN len(w) >= 2 THEN w[len(w) - 1] END AS popped_last,
  CAST(len(w) + COALESCE(len(nw), 0) AS INTEGER) AS flat_len
FROM {_TURNS_SQL}""")
def c1_c24_array_functions(spark, sf):
    t = _turn_words(spark, sf)
    w, nw = F.col("w"), F.col("nw")
    lens = C.map_array(w, F.length)
    return t.select(
        "conv_id", "turn", F.size(w).alias("n_words"), C.safe_item(w, 0).alias("first_word"),
        C.safe_item(w, 1).alias("second_word"), C.safe_item(w, -1).alias("last_word"),
        C.contains(w, "the").alias("has_the"), C.count_value(w, C.safe_item(w, 0)).alias("first_word_count"),
        C.index_of(w, C.safe_item(w, -1)).alias("last_word_index"),
        F.size(C.distinct_keep_order(w)).alias("n_distinct"), C.safe_item(C.reverse(w), 0).alias("reversed_first"),
        C.safe_item(C.rotate_left(w, 2), 0).alias("rotated_first"),
        C.reduce_array(lens, F.lit(0), lambda a, b: a + b).alias("total_len"),
        F.size(C.filter_array(w, lambda x: F.length(x) % 2 == 0)).alias("even_len_words"),
        C.array_max(lens).alias("max_len"),
        F.size(C.intersect(w, nw)).alias("n_common"), F.size(C.union(w, nw)).alias("n_union"),
        F.size(C.except_(w, nw)).alias("n_only_here"),
        F.size(C.append(w, "END")).alias("appended_len"),
        C.safe_item(C.insert_at(w, 1, F.lit("<x>")), 1).alias("inserted_second"),
        F.size(C.remove_first(w, C.safe_item(w, 0))).alias("removed_len"),
        C.safe_item(C.pop(w, -1), -1).alias("popped_last"),
        F.size(C.flatten(F.array(w, F.coalesce(nw, F.array().cast("array<string>"))))).alias("flat_len"))


@register("c2_c17_embedding_functions", """
SELECT vec_id, embedding[1] AS first, embedding[101] AS beyond_end, embedding[-1] AS last,
  CAST(len(embedding) AS INTEGER) AS dims,
  ROUND(list_reduce(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), lambda a, b: a + b), 6) AS total,
  CAST(len(list_filter(embedding, lambda x: x > 0)) AS INTEGER) AS n_positive,
  CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax,
  ROUND(list_reduce(list_transform(range(1, 64), lambda i: CAST(embedding[i] AS DOUBLE) * CAST(embedding[i + 1] AS DOUBLE)),
        lambda a, b: a + b), 6) AS lag1_dot,
  list_sort(embedding)[1] AS smallest
FROM embeddings""")
def c2_c17_embedding_functions(spark, sf):
    e = table(spark, sf, "embeddings")
    v = F.col("embedding")
    dbl = F.transform(v, lambda x: x.cast("double"))
    shifted = F.slice(dbl, 2, F.size(dbl) - 1)
    pair = F.zip_with(dbl, shifted, lambda a, b: a * b)  # uneven lengths: last pair is NULL
    return e.select(
        "vec_id", C.item(v, 0).alias("first"), C.safe_item(v, 100).alias("beyond_end"), C.safe_item(v, -1).alias("last"),
        F.size(v).alias("dims"), F.round(M.array_sum(dbl), 6).alias("total"),
        F.size(C.filter_array(v, lambda x: x > 0)).alias("n_positive"),
        C.index_of(v, C.array_max(v)).alias("argmax"),
        F.round(F.aggregate(F.filter(pair, lambda x: x.isNotNull()), F.lit(0.0), lambda a, b: a + b), 6).alias("lag1_dot"),
        C.item(C.sort(v), 0).alias("smallest"))


@register("c6_c8_posexplode", """
SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, unnest(embedding) AS value FROM embeddings""")
def c6_c8_posexplode(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "value"))


@register("c9_c11_nested_explode", f"""
SELECT conv_id, turn, unnest(flatten([w, COALESCE(nw, [])])) AS word FROM {_TURNS_SQL}""")
def c9_c11_nested_explode(spark, sf):
    """Explode of an explode: per turn, an array of two word arrays (this
    turn, next turn), unnested twice."""
    t = _turn_words(spark, sf).select(
        "conv_id", "turn", F.array("w", F.coalesce("nw", F.array().cast("array<string>"))).alias("nested"))
    return t.select("conv_id", "turn", F.explode("nested").alias("inner")).select(
        "conv_id", "turn", F.explode("inner").alias("word"))


@register("c4_c22_map_functions", """
SELECT l_orderkey, COALESCE(SUM(CASE WHEN l_returnflag = 'R' THEN 1 END), NULL) AS r_lines,
  CAST(COUNT(DISTINCT l_returnflag) AS INTEGER) AS n_flags, COUNT_IF(l_returnflag = 'A') > 0 AS has_a,
  CAST((SELECT COUNT(*) FROM (SELECT l_returnflag FROM lineitem l2 WHERE l2.l_orderkey = l.l_orderkey
        GROUP BY 1 HAVING COUNT(*) > 1)) AS INTEGER) AS n_flags_repeated,
  COUNT(*) AS total_lines
FROM lineitem l GROUP BY l_orderkey""")
def c4_c22_map_functions(spark, sf):
    """Per order, a map return flag -> line count built with
    ``map_from_entries`` (at most one entry per return flag: the map's size
    is bounded by the flag domain, not by the order); then lookup, keys,
    key test, value filter and a value reduction."""
    l = table(spark, sf, "lineitem")
    counts = l.groupBy("l_orderkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    m = counts.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", "n"))).alias("m"))
    vals = C.values(C.map_nulls_to_zero(F.col("m")))
    return m.select("l_orderkey", C.map_get("m", "R").alias("r_lines"), F.size(C.keys("m")).alias("n_flags"),
                    C.map_has_key("m", "A").alias("has_a"),
                    F.size(C.map_filter_values("m", lambda v: v > 1)).alias("n_flags_repeated"),
                    F.aggregate(vals, F.lit(0).cast("long"), lambda a, b: a + b).alias("total_lines"))


@register("c7_explode_map", """
SELECT l_orderkey, l_returnflag AS key, COUNT(*) AS value FROM lineitem GROUP BY 1, 2""")
def c7_explode_map(spark, sf):
    l = table(spark, sf, "lineitem")
    counts = l.groupBy("l_orderkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    m = counts.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", "n"))).alias("m"))
    return m.select("l_orderkey", F.explode("m").alias("key", "value"))


@register("c19_map_merge_with_sum", """
SELECT l_orderkey, l_returnflag AS key, SUM(l_quantity) + COUNT(*) AS value FROM lineitem GROUP BY 1, 2""")
def c19_map_merge_with_sum(spark, sf):
    """Two per-order maps keyed by return flag (quantity, line count) merged
    by adding the values of shared keys (dict merge-with-sum). Keys come from
    the 3-value flag domain, so each map is bounded."""
    l = table(spark, sf, "lineitem")
    per = l.groupBy("l_orderkey", "l_returnflag").agg(F.sum("l_quantity").alias("q"),
                                                      F.count(F.lit(1)).cast("double").alias("n"))
    maps = per.groupBy("l_orderkey").agg(
        F.map_from_entries(F.collect_list(F.struct("l_returnflag", "q"))).alias("mq"),
        F.map_from_entries(F.collect_list(F.struct("l_returnflag", "n"))).alias("mn"))
    return maps.select("l_orderkey", F.explode(C.map_merge_sum("mq", "mn")).alias("key", "value"))


@register("c1_c23_struct_access", """
SELECT o_orderkey, o_custkey AS customer, o_orderstatus AS status, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""")
def c1_c23_struct_access(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.struct(F.struct("o_custkey", "o_orderstatus").alias("party"),
                               F.year("o_orderdate").alias("year")).alias("info"))
    return o.select("o_orderkey", C.field("info", "party.o_custkey").alias("customer"),
                    F.col("info.party.o_orderstatus").alias("status"), C.field("info", "year").alias("year"))


# ---------------------------------------------------------------- projection and banding
@register("p5_rename_snake_case", """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_acctbal AS account_balance, c_mktsegment AS market_segment
FROM customer""")
def p5_rename_snake_case(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("CustomerID"), F.col("c_name").alias("CustomerName"),
                                            F.col("c_acctbal").alias("AccountBalance"), F.col("c_mktsegment").alias("Market Segment"))
    return P.rename_all(c, "snake")


@register("p8_select_by_type", "SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def p8_select_by_type(spark, sf):
    return P.select_by_type(table(spark, sf, "lineitem"), include=["float"])


@register("p9_p15_predicates", """
SELECT o_orderkey, o_totalprice > 300000 AS is_large FROM orders
WHERE o_orderdate >= DATE '1996-02-01' AND o_orderdate <= DATE '1996-04-30'
  AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice BETWEEN 1000 AND 400000
  AND NOT (o_orderstatus = 'P') AND (starts_with(o_orderpriority, '1') OR ends_with(o_orderpriority, 'HIGH'))
  AND contains(o_orderpriority, '-')""")
def p9_p15_predicates(spark, sf):
    o = table(spark, sf, "orders")
    cond = (D.between_dates("o_orderdate", "1996-02-01", "1996-04-30")
            & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & F.col("o_totalprice").between(1000, 400000)
            & ~(F.col("o_orderstatus") == "P")
            & (F.col("o_orderpriority").startswith("1") | F.col("o_orderpriority").endswith("HIGH"))
            & F.col("o_orderpriority").contains("-"))
    return o.where(cond).select("o_orderkey", (F.col("o_totalprice") > 300000).alias("is_large"))


@register("p15_query_string", "SELECT * FROM lineitem WHERE l_quantity > 45 AND l_discount < 0.02")
def p15_query_string(spark, sf):
    return P.query(table(spark, sf, "lineitem"), "l_quantity > 45 AND l_discount < 0.02")


@register("p16_slice_rows", """
SELECT c_custkey, c_acctbal FROM (SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rn
FROM customer) WHERE rn > 10 AND rn <= 20""")
def p16_slice_rows(spark, sf):
    """Rows 10..19 (0-based, ``iloc[10:20]``) under balance order."""
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return P.slice_rows(c, [("c_acctbal", "desc"), "c_custkey"], 10, 20)


@register("p17_composite_key_lookup", """
SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def p17_composite_key_lookup(spark, sf):
    return P.lookup(table(spark, sf, "orders"), o_orderstatus="F", o_orderpriority=["1-URGENT", "2-HIGH"]) \
        .select("o_orderkey")


@register("p7_drop_rows_by_key", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (0, 4, 1000)")
def p7_drop_rows_by_key(spark, sf):
    """pandas ``drop(index=[...])`` on an explicit key column."""
    return P.drop_rows_by_key(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey", [0, 4, 1000])


@register("p18_p21_banding_and_mapping", """
SELECT c_custkey,
  CASE WHEN c_acctbal IS NULL THEN 'unknown' WHEN c_acctbal < 0 THEN 'overdrawn' WHEN c_acctbal < 2500 THEN 'low'
       WHEN c_acctbal < 7500 THEN 'medium' ELSE 'high' END AS balance_band,
  CASE WHEN c_acctbal > -1000 AND c_acctbal <= 0 THEN 'none' WHEN c_acctbal > 0 AND c_acctbal <= 5000 THEN 'some'
       WHEN c_acctbal > 5000 AND c_acctbal <= 10000 THEN 'plenty' END AS balance_bin,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'AUTO' WHEN 'BUILDING' THEN 'BLDG' WHEN 'MACHINERY' THEN 'MACH' END AS segment_code,
  'tpch' AS source_system, c_acctbal < 5000 AS below_5000
FROM customer""")
def p18_p21_banding_and_mapping(spark, sf):
    c = table(spark, sf, "customer")
    band = K.band("c_acctbal", [(0, "overdrawn"), (2500, "low"), (7500, "medium")], "high", null_label="unknown")
    bins = K.bucketize("c_acctbal", [-1000, 0, 5000, 10000], ["none", "some", "plenty"])
    code = K.map_values("c_mktsegment", {"AUTOMOBILE": "AUTO", "BUILDING": "BLDG", "MACHINERY": "MACH"})
    return c.select("c_custkey", band.alias("balance_band"), bins.alias("balance_bin"), code.alias("segment_code"),
                    K.literal("tpch", "source_system"), (F.col("c_acctbal") < 5000).alias("below_5000"))
