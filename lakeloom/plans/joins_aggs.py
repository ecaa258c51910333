"""Join and aggregate reports.

The test tables have no NULLs and every customer orders at some point, so
gaps come from business predicates (orders of one year, premium
customers) and NULL keys from ``nullif``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import dates as D
from lakeloom.operators import aggregates as A
from lakeloom.operators import joins as J
from lakeloom.operators import reshape as R
from lakeloom.operators import setops as U
from lakeloom.operators import windows as W
from lakeloom.operators._store import small_side, stored
from lakeloom.operators.layout import ensure_parallelism
from lakeloom.operators.quality import label_dictionary
from lakeloom.plans._common import (SQL_NET, cents, davg, dsum, exact_sum, net_sum, net_units, register,
                                    sql_davg, sql_dsum, table, total)

_O98 = "o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '1999-01-01'"
_O97 = "o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'"


def _cust(spark, sf):
    return table(spark, sf, "customer")


def _orders_in(spark, sf, year):
    return (table(spark, sf, "orders").where(D.in_year("o_orderdate", year))
            .select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice"))


# ---------------------------------------------------------------- joins
@register("j1_inner_join", f"""
SELECT c.c_custkey, c.c_name, COUNT(*) AS orders_1998, {sql_dsum('o.o_totalprice')} AS spend_1998
FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey WHERE {_O98.replace('o_orderdate', 'o.o_orderdate')}
GROUP BY c.c_custkey, c.c_name""")
def j1_inner_join(spark, sf):
    """1998 orders reduced per customer (map-side) before the inner join."""
    per = (_orders_in(spark, sf, 1998).groupBy("c_custkey")
           .agg(F.count(F.lit(1)).alias("orders_1998"), dsum("o_totalprice").alias("spend_1998")))
    return J.join(_cust(spark, sf).select("c_custkey", "c_name"), per, "c_custkey", "inner")


@register("j2_left_join", f"""
SELECT c.c_custkey, COUNT(o.o_orderkey) AS orders_1998, {sql_dsum('o.o_totalprice')} AS spend_1998
FROM customer c LEFT JOIN (SELECT * FROM orders WHERE {_O98}) o ON o.o_custkey = c.c_custkey
GROUP BY c.c_custkey""")
def j2_left_join(spark, sf):
    """Every customer, with 0 orders / NULL spend when none in 1998 (A10).
    Orders are reduced per customer first, so the join does not fan out."""
    per = (_orders_in(spark, sf, 1998).groupBy("c_custkey")
           .agg(F.count(F.lit(1)).alias("_n"), dsum("o_totalprice").alias("spend_1998")))
    return (J.join(_cust(spark, sf).select("c_custkey"), per, "c_custkey", "left")
            .select("c_custkey", F.coalesce("_n", F.lit(0)).alias("orders_1998"), "spend_1998"))


@register("j3_right_join", """
SELECT n.n_nationkey, n.n_name, COUNT(s.s_suppkey) AS premium_suppliers
FROM (SELECT * FROM supplier WHERE s_acctbal > 9000) s RIGHT JOIN nation n ON s.s_nationkey = n.n_nationkey
GROUP BY n.n_nationkey, n.n_name""")
def j3_right_join(spark, sf):
    """Premium suppliers counted per nation first (a partial aggregate: with
    25 nation keys a row-level join would use only 25 tasks), then right
    joined so every nation appears."""
    s = (table(spark, sf, "supplier").where(F.col("s_acctbal") > 9000)
         .groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("_n")))
    return (J.join(s, table(spark, sf, "nation").select("n_nationkey", "n_name"), "n_nationkey", "right")
            .select("n_nationkey", "n_name", F.coalesce("_n", F.lit(0)).alias("premium_suppliers")))


@register("j4_full_join", f"""
SELECT c_custkey, a.n97 AS orders_1997, b.n98 AS orders_1998 FROM
 (SELECT o_custkey AS c_custkey, COUNT(*) AS n97 FROM orders WHERE {_O97} GROUP BY 1) a
 FULL JOIN (SELECT o_custkey AS c_custkey, COUNT(*) AS n98 FROM orders WHERE {_O98} GROUP BY 1) b USING (c_custkey)""")
def j4_full_join(spark, sf):
    a = _orders_in(spark, sf, 1997).groupBy("c_custkey").agg(F.count(F.lit(1)).alias("orders_1997"))
    b = _orders_in(spark, sf, 1998).groupBy("c_custkey").agg(F.count(F.lit(1)).alias("orders_1998"))
    return J.join(a, b, "c_custkey", "full")


@register("j5_left_semi_join", f"""
SELECT c_custkey, c_name FROM customer c WHERE EXISTS (
  SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND {_O98.replace('o_orderdate', 'o.o_orderdate')})""")
def j5_left_semi_join(spark, sf):
    return J.join(_cust(spark, sf).select("c_custkey", "c_name"), _orders_in(spark, sf, 1998), "c_custkey", "left_semi")


@register("j6_left_anti_join", f"""
SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND {_O98.replace('o_orderdate', 'o.o_orderdate')})""")
def j6_left_anti_join(spark, sf):
    return J.join(_cust(spark, sf).select("c_custkey", "c_name"), _orders_in(spark, sf, 1998), "c_custkey", "left_anti")


@register("j7_cross_join_grid", f"""
WITH g AS (SELECT r.r_name, s.c_mktsegment FROM region r CROSS JOIN (SELECT DISTINCT c_mktsegment FROM customer) s),
t AS (SELECT r.r_name, c.c_mktsegment, COUNT(*) AS n, {sql_dsum('c.c_acctbal')} AS balance
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
      WHERE c.c_acctbal > 9900 GROUP BY 1, 2)
SELECT g.r_name, g.c_mktsegment, COALESCE(t.n, 0) AS customers, t.balance FROM g LEFT JOIN t USING (r_name, c_mktsegment)""")
def j7_cross_join_grid(spark, sf):
    """Dense region x segment report: the size-checked grid of both key
    lists, left-joined to the sparse counts of top-balance customers."""
    c = _cust(spark, sf)
    grid = R.key_grid([table(spark, sf, "region").select("r_name"), c.select("c_mktsegment")])
    geo = (c.where(F.col("c_acctbal") > 9900)
           .join(J.bounded_broadcast(table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")), "c_nationkey")
           .join(J.bounded_broadcast(table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")), "n_regionkey"))
    t = geo.groupBy("r_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("customers"), dsum("c_acctbal").alias("balance"))
    return (grid.join(t, ["r_name", "c_mktsegment"], "left")
            .select("r_name", "c_mktsegment", F.coalesce("customers", F.lit(0)).alias("customers"), "balance"))


@register("j7_blocked_product", """
SELECT s.s_nationkey, p.p_brand, COUNT(*) AS n_pairs, COUNT(*) FILTER (s.s_suppkey < p.p_partkey) AS n_below,
       MIN(s.s_suppkey + p.p_partkey) AS least_sum, MAX(p.p_retailprice) AS max_price
FROM supplier s CROSS JOIN part p GROUP BY 1, 2""")
def j7_blocked_product(spark, sf):
    """Every supplier with every part, neither side broadcast. A nation's
    suppliers lie side by side in a row of the product, so that every pair is
    compared but a group is looked up once for many pairs, and by the number
    of its brand (NULL for NULL) rather than by text."""
    s, p = table(spark, sf, "supplier").select("s_nationkey", "s_suppkey"), table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice")
    brands = small_side(label_dictionary(p, "p_brand").select("p_brand", F.col("label_index").cast("long").alias("_brand")))
    p = stored(J.join(p, brands, "p_brand", "left").drop("p_brand"), "numbered")  # a repeated task deals the same blocks
    side = [F.col(f"s_suppkey_{i}") for i in range(J.PACK_WIDTH)]
    below = [F.when(k < F.col("p_partkey"), 1).otherwise(0) for k in side]
    per = J.cross_product(J.packed(s, "s_nationkey", "s_suppkey"), p, max_bytes=0).groupBy("s_nationkey", "_brand").agg(
        F.sum("_n").alias("n_pairs"), F.sum(sum(below[1:], below[0])).alias("n_below"),
        F.min(F.least(*[k + F.col("p_partkey") for k in side])).alias("least_sum"), F.max("p_retailprice").alias("max_price"))
    return J.join(per, brands, "_brand", "left").select("s_nationkey", "p_brand", "n_pairs", "n_below", "least_sum", "max_price")


@register("j9_join_different_keys", f"""
SELECT p.p_brand, COUNT(*) AS line_count, {sql_dsum(SQL_NET, 4)} AS revenue
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY p.p_brand""")
def j9_join_different_keys(spark, sf):
    per_part = (table(spark, sf, "lineitem").groupBy("l_partkey")
                .agg(F.count(F.lit(1)).alias("_n"), exact_sum(net_units()).alias("_s")))
    j = J.join_on_columns(per_part, table(spark, sf, "part"), "l_partkey", "p_partkey")
    return j.groupBy("p_brand").agg(F.sum("_n").alias("line_count"), (total("_s").cast("double") / 1e4).alias("revenue"))


@register("j10_star_join", f"""
SELECT n.n_name, CAST(year(o.o_orderdate) AS INTEGER) AS year, COUNT(*) AS line_count, {sql_dsum(SQL_NET, 4)} AS revenue
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1, 2""")
def j10_star_join(spark, sf):
    """Lines reduced per order first, then the star join order -> customer
    -> nation (broadcast), then totals per nation and year."""
    l = (table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
         .agg(F.count(F.lit(1)).alias("_n"), exact_sum(net_units()).alias("_s")))
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderdate")
    c = _cust(spark, sf).select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    n = J.bounded_broadcast(table(spark, sf, "nation").select("n_nationkey", "n_name"))
    s = J.star_join(l, [(o, "o_orderkey", "o_"), (c, "c_custkey", "c_"), (n, "n_nationkey", "n_")])
    return (s.groupBy("n_name", D.year("o_orderdate").alias("year"))
            .agg(F.sum("_n").alias("line_count"), (total("_s").cast("double") / 1e4).alias("revenue")))


@register("j11_broadcast_join", f"""
SELECT p.p_type, SUM(l.l_quantity) AS quantity FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_type""")
def j11_broadcast_join(spark, sf):
    """The part dimension is broadcast only after its row count is checked
    (above the bound the join is left to AQE)."""
    l = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_quantity")
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    return J.broadcast_join(l, p, "p_partkey").groupBy("p_type").agg(
        F.sum("l_quantity").alias("quantity"))


@register("j12_salted_join", """
SELECT e.event_id, e.event_type, c.c_custkey, c.c_name, c.c_mktsegment FROM events e JOIN customer c ON e.user_id = c.c_custkey""")
def j12_salted_join(spark, sf):
    """Every event with its user's customer row: both sides are large and a
    few users may hold most events, so hot users are salted."""
    e = table(spark, sf, "events").select("event_id", F.col("user_id").alias("c_custkey"), "event_type")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return J.salted_join(e, c, "c_custkey", "inner")


@register("j13_pairs_summing_to_target", """
SELECT LEAST(x.p_size, y.p_size) AS a, GREATEST(x.p_size, y.p_size) AS b, CAST(COUNT(*) AS DECIMAL(38,0)) AS n_pairs
FROM part x JOIN part y ON x.p_size + y.p_size = 50 AND x.p_partkey < y.p_partkey GROUP BY 1, 2""")
def j13_pairs_summing_to_target(spark, sf):
    """Pairs of parts whose sizes add up to 50, counted per size pair."""
    return J.pairs_summing_to(table(spark, sf, "part"), "p_size", 50)


@register("j14_unequal_pairs", """
SELECT a.c_mktsegment, CAST(COUNT(*) AS DECIMAL(38,0)) AS n_pairs FROM customer a JOIN customer b
ON a.c_mktsegment = b.c_mktsegment AND a.c_nationkey <> b.c_nationkey GROUP BY a.c_mktsegment""")
def j14_unequal_pairs(spark, sf):
    """Ordered pairs of customers of one segment living in different nations,
    counted from per-nation frequencies (no pair enumeration)."""
    return J.count_unequal_pairs(_cust(spark, sf), "c_nationkey", by="c_mktsegment")


@register("j15_join_aggregated_view", f"""
SELECT c.c_custkey, c.c_nationkey, c.c_acctbal, a.nation_avg, c.c_acctbal - a.nation_avg AS diff_to_avg
FROM customer c JOIN (SELECT c_nationkey, {sql_davg('c_acctbal')} AS nation_avg FROM customer GROUP BY 1) a
USING (c_nationkey)""")
def j15_join_aggregated_view(spark, sf):
    df = J.join_group_aggregate(_cust(spark, sf).select("c_custkey", "c_nationkey", "c_acctbal"), "c_nationkey",
                                [davg("c_acctbal").alias("nation_avg")])
    return df.withColumn("diff_to_avg", F.col("c_acctbal") - F.col("nation_avg"))


@register("j16_zip_rows", """
WITH a AS (SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer),
b AS (SELECT s_suppkey, s_acctbal, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS rn FROM supplier)
SELECT c_custkey, c_acctbal, s_suppkey, s_acctbal FROM a FULL JOIN b USING (rn)""")
def j16_zip_rows(spark, sf):
    """Customers and suppliers side by side by balance position."""
    return J.zip_rows(_cust(spark, sf).select("c_custkey", "c_acctbal"),
                      table(spark, sf, "supplier").select("s_suppkey", "s_acctbal"),
                      [("c_acctbal", "desc"), "c_custkey"], [("s_acctbal", "desc"), "s_suppkey"])


@register("j17_null_safe_join", """
SELECT c.c_custkey, n.n_name FROM customer c JOIN nation n
ON NULLIF(c.c_nationkey, 0) IS NOT DISTINCT FROM NULLIF(n.n_nationkey, 0)""")
def j17_null_safe_join(spark, sf):
    """Nation 0 is recoded to a NULL key on both sides; NULL matches NULL."""
    c = _cust(spark, sf).select("c_custkey", F.nullif("c_nationkey", F.lit(0)).alias("k"))
    n = table(spark, sf, "nation").select(F.nullif("n_nationkey", F.lit(0)).alias("k"), "n_name")
    return J.join(c, n, "k", "inner", null_safe=True).select("c_custkey", "n_name")


# ---------------------------------------------------------------- aggregates
@register("a1_global_aggregates", f"""
SELECT COUNT(*) AS n_rows, COUNT(l_quantity) AS n_quantity, SUM(l_quantity) AS sum_qty,
       {sql_davg('l_extendedprice')} AS avg_price, MIN(l_extendedprice) AS min_price, MAX(l_extendedprice) AS max_price,
       CAST(MIN(l_shipdate) AS DATE) AS first_ship, CAST(MAX(l_shipdate) AS DATE) AS last_ship FROM lineitem""")
def a1_global_aggregates(spark, sf):
    return table(spark, sf, "lineitem").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("l_quantity").alias("n_quantity"),
        F.sum("l_quantity").alias("sum_qty"), davg("l_extendedprice").alias("avg_price"),
        F.min("l_extendedprice").alias("min_price"), F.max("l_extendedprice").alias("max_price"),
        F.to_date(F.min("l_shipdate")).alias("first_ship"), F.to_date(F.max("l_shipdate")).alias("last_ship"))


@register("a2_group_by_one_key", f"""
SELECT o_orderstatus, COUNT(*) AS order_count, {sql_dsum('o_totalprice')} AS revenue FROM orders GROUP BY 1""")
def a2_group_by_one_key(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("order_count"), dsum("o_totalprice").alias("revenue"))


@register("a3_group_by_several_keys", f"""
SELECT l_returnflag, l_linestatus, SUM(l_quantity) AS sum_qty, {sql_dsum('l_extendedprice')} AS sum_base_price,
       {sql_dsum(SQL_NET, 4)} AS sum_disc_price, {sql_davg('l_quantity')} AS avg_qty, COUNT(*) AS count_order
FROM lineitem GROUP BY 1, 2""")
def a3_group_by_several_keys(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), dsum("l_extendedprice").alias("sum_base_price"),
        net_sum().alias("sum_disc_price"), davg("l_quantity").alias("avg_qty"),
        F.count(F.lit(1)).alias("count_order"))


@register("a4_group_by_derived_key", f"""
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(quarter(l_shipdate) AS INTEGER) AS quarter,
       COUNT(*) AS line_count, {sql_dsum('l_extendedprice')} AS revenue FROM lineitem GROUP BY 1, 2""")
def a4_group_by_derived_key(spark, sf):
    return table(spark, sf, "lineitem").groupBy(
        D.year("l_shipdate").alias("year"), D.quarter("l_shipdate").alias("quarter")).agg(
        F.count(F.lit(1)).alias("line_count"), dsum("l_extendedprice").alias("revenue"))


@register("a5_several_aggregates", """
SELECT o_orderpriority, COUNT(*) AS n_rows, CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS sum_cents,
       MIN(o_totalprice) AS min_o_totalprice, MAX(o_totalprice) AS max_o_totalprice,
       COUNT(DISTINCT o_custkey) AS count_distinct_o_custkey FROM orders GROUP BY 1""")
def a5_several_aggregates(spark, sf):
    o = table(spark, sf, "orders").withColumn("cents", cents("o_totalprice"))
    out = A.summarize(o, "o_orderpriority", {"o_totalprice": ["min", "max"], "cents": ["sum"], "o_custkey": ["count_distinct"]},
                      count_rows="n_rows")
    return out.select("o_orderpriority", "n_rows", F.col("sum_cents").cast("long").alias("sum_cents"),
                      "min_o_totalprice", "max_o_totalprice", "count_distinct_o_custkey")


@register("a6_aggregate_several_columns", f"""
SELECT l_returnflag, {sql_davg('l_quantity')} AS avg_l_quantity, {sql_davg('l_extendedprice')} AS avg_l_extendedprice,
       {sql_davg('l_discount')} AS avg_l_discount FROM lineitem GROUP BY 1""")
def a6_aggregate_several_columns(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        *[davg(c).alias(f"avg_{c}") for c in ("l_quantity", "l_extendedprice", "l_discount")])


@register("a7_distinct_count", """
SELECT c.c_nationkey, COUNT(DISTINCT o.o_custkey) AS buying_customers, COUNT(DISTINCT o.o_orderkey) AS orders
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1""")
def a7_distinct_count(spark, sf):
    """Distinct buying customers and distinct orders per nation. Customers and
    (nation, order) pairs are made distinct first, partially in each task, so
    a nation is only counted, whichever customers an order has."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    j = o.distinct().join(_cust(spark, sf).select("c_custkey", "c_nationkey"), "c_custkey")
    buyers = j.select("c_nationkey", "c_custkey").distinct().groupBy("c_nationkey").agg(F.count("c_custkey").alias("buying_customers"))
    orders = j.select("c_nationkey", "o_orderkey").distinct().groupBy("c_nationkey").agg(F.count("o_orderkey").alias("orders"))
    return buyers.join(orders, "c_nationkey")


@register("a8_having", f"""
SELECT c_nationkey, COUNT(*) AS customers, {sql_davg('c_acctbal')} AS avg_balance FROM customer
GROUP BY 1 HAVING {sql_davg('c_acctbal')} > 4500""")
def a8_having(spark, sf):
    return (_cust(spark, sf).groupBy("c_nationkey")
            .agg(F.count(F.lit(1)).alias("customers"), davg("c_acctbal").alias("avg_balance"))
            .where(F.col("avg_balance") > 4500))


@register("a9_having_scalar_subquery", f"""
SELECT c_mktsegment, {sql_davg('c_acctbal')} AS avg_balance FROM customer GROUP BY 1
HAVING {sql_davg('c_acctbal')} > (SELECT {sql_davg('c_acctbal')} FROM customer)""")
def a9_having_scalar_subquery(spark, sf):
    c = _cust(spark, sf)
    overall = c.select(davg("c_acctbal")).scalar()
    return c.groupBy("c_mktsegment").agg(davg("c_acctbal").alias("avg_balance")).where(F.col("avg_balance") > overall)


@register("a10_aggregate_after_outer_join", f"""
SELECT n.n_nationkey, COUNT(c.c_custkey) AS premium_customers, {sql_dsum('c.c_acctbal')} AS premium_balance,
       {sql_davg('c.c_acctbal')} AS avg_premium_balance
FROM nation n LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 9900) c ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_nationkey""")
def a10_aggregate_after_outer_join(spark, sf):
    """Empty groups are kept: count 0, sum and average NULL. Customers are
    aggregated per nation before the outer join (the nation side has 25
    rows; joining rows first would funnel them into 25 tasks)."""
    c = (_cust(spark, sf).where(F.col("c_acctbal") > 9900)
         .groupBy(F.col("c_nationkey").alias("n_nationkey"))
         .agg(F.count(F.lit(1)).alias("_n"), exact_sum(cents("c_acctbal")).alias("_s")))
    n = table(spark, sf, "nation").select("n_nationkey")
    return n.join(c, "n_nationkey", "left").select(
        "n_nationkey", F.coalesce("_n", F.lit(0)).alias("premium_customers"),
        (F.col("_s").cast("double") / 100.0).alias("premium_balance"),
        (F.col("_s").cast("double") / 100.0 / F.col("_n")).alias("avg_premium_balance"))


@register("a11_rounded_average", """
SELECT c_nationkey,
  CAST(CAST(sign(s) * ((2 * abs(s) + n) // (2 * n)) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS avg_balance
FROM (SELECT c_nationkey, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) * 100 AS BIGINT) AS s, COUNT(*) AS n
      FROM customer GROUP BY 1)""")
def a11_rounded_average(spark, sf):
    """Average rounded HALF_UP to cents. The quotient is taken in DECIMAL at
    12 decimals (``avg(decimal)`` would round to 6 first and round twice)."""
    total = F.sum(F.col("c_acctbal").cast("decimal(18,2)"))
    n = F.count(F.lit(1)).cast("decimal(20,0)")
    return _cust(spark, sf).groupBy("c_nationkey").agg(
        F.round(total / n, 2).cast("decimal(18,2)").alias("avg_balance"))


@register("a12_distinct_rows", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def a12_distinct_rows(spark, sf):
    return _cust(spark, sf).select("c_mktsegment", "c_nationkey").distinct()


@register("a13_drop_duplicates_subset", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def a13_drop_duplicates_subset(spark, sf):
    """``dropDuplicates`` on a key subset; the key columns are the
    deterministic part of the surviving rows."""
    return table(spark, sf, "lineitem").dropDuplicates(["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber")


@register("a14_duplicate_finder", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS count FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def a14_duplicate_finder(spark, sf):
    return A.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("a15_value_counts", "SELECT p_brand, COUNT(*) AS count FROM part WHERE p_brand IS NOT NULL GROUP BY 1")
def a15_value_counts(spark, sf):
    return A.value_counts(table(spark, sf, "part"), "p_brand")


@register("a16_share_of_total", """
SELECT o_orderpriority, COUNT(*) AS count,
       ROUND(CAST(COUNT(*) AS DOUBLE) * 100 / (SELECT COUNT(*) FROM orders), 6) AS pct FROM orders GROUP BY 1""")
def a16_share_of_total(spark, sf):
    return A.share_of_total(table(spark, sf, "orders"), "o_orderpriority", scale=6)


@register("a17_percent_matching", """
SELECT l_returnflag, ROUND(AVG(CAST(COALESCE(l_discount >= 0.05, false) AS INTEGER)) * 100, 6) AS pct
FROM lineitem GROUP BY 1""")
def a17_percent_matching(spark, sf):
    return A.percent_matching(table(spark, sf, "lineitem"), F.col("l_discount") >= 0.05, "l_returnflag", scale=6)


@register("a18_describe_by_group", """
SELECT l_returnflag, COUNT(l_extendedprice) AS count, ROUND(AVG(l_extendedprice), 6) AS mean,
       ROUND(STDDEV_SAMP(l_extendedprice), 6) AS std, MIN(l_extendedprice) AS min,
       ROUND(QUANTILE_CONT(l_extendedprice, 0.25), 6) AS p25, ROUND(QUANTILE_CONT(l_extendedprice, 0.5), 6) AS p50,
       ROUND(QUANTILE_CONT(l_extendedprice, 0.75), 6) AS p75, MAX(l_extendedprice) AS max
FROM lineitem GROUP BY 1""")
def a18_describe_by_group(spark, sf):
    d = A.describe_by(table(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag")
    return d.select("l_returnflag", "count", *[F.round(c, 6).alias(c) for c in ("mean", "std")], "min",
                    *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75")], "max")


@register("a19_salted_aggregate", f"""
SELECT l_returnflag, {sql_dsum('l_extendedprice')} AS total, COUNT(l_extendedprice) AS n,
       MIN(l_extendedprice) AS min, MAX(l_extendedprice) AS max, {sql_davg('l_extendedprice')} AS avg
FROM lineitem GROUP BY 1""")
def a19_salted_aggregate(spark, sf):
    l = table(spark, sf, "lineitem").withColumn("amount", cents("l_extendedprice"))
    out = A.salted_agg(l, "l_returnflag", "amount")
    return out.select("l_returnflag", (F.col("total") / 100.0).alias("total"), "n",
                      (F.col("min") / 100.0).alias("min"), (F.col("max") / 100.0).alias("max"),
                      (F.col("total") / 100.0 / F.col("n")).alias("avg"))


@register("a20_second_highest", """
SELECT c_nationkey, MAX(c_acctbal) AS second_highest FROM customer c
WHERE c_acctbal < (SELECT MAX(c_acctbal) FROM customer c2 WHERE c2.c_nationkey = c.c_nationkey) GROUP BY 1""")
def a20_second_highest(spark, sf):
    return A.second_highest(_cust(spark, sf), "c_acctbal", "c_nationkey")


@register("a20_second_highest_global", """
SELECT MAX(c_acctbal) AS second_highest FROM customer WHERE c_acctbal < (SELECT MAX(c_acctbal) FROM customer)""")
def a20_second_highest_global(spark, sf):
    return A.second_highest(_cust(spark, sf), "c_acctbal")


@register("a21_rows_at_group_max", """
SELECT c_custkey, c_nationkey, c_acctbal FROM customer c
WHERE c_acctbal = (SELECT MAX(c_acctbal) FROM customer c2 WHERE c2.c_nationkey = c.c_nationkey)""")
def a21_rows_at_group_max(spark, sf):
    return W.rows_at_group_extreme(_cust(spark, sf).select("c_custkey", "c_nationkey", "c_acctbal"),
                                   "c_nationkey", "c_acctbal", "max")


@register("a22_conditional_counts", """
SELECT l_returnflag, COUNT_IF(l_discount > 0) AS discounted_lines, COUNT_IF(l_tax = 0) AS untaxed_lines,
       SUM(CASE WHEN l_quantity >= 25 THEN l_quantity END) AS bulk_quantity FROM lineitem GROUP BY 1""")
def a22_conditional_counts(spark, sf):
    l = table(spark, sf, "lineitem")
    return l.groupBy("l_returnflag").agg(
        *A.count_exprs({"discounted_lines": F.col("l_discount") > 0, "untaxed_lines": F.col("l_tax") == 0}),
        *A.sum_exprs("l_quantity", {"bulk_quantity": F.col("l_quantity") >= 25}))


@register("a23_merge_with_sum", """
SELECT l_partkey, SUM(q) AS quantity FROM (
  SELECT l_partkey, SUM(l_quantity) AS q FROM lineitem WHERE l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1998-01-01' GROUP BY 1
  UNION ALL
  SELECT l_partkey, SUM(l_quantity) AS q FROM lineitem WHERE l_shipdate >= DATE '1998-01-01' AND l_shipdate < DATE '1999-01-01' GROUP BY 1)
GROUP BY 1""")
def a23_merge_with_sum(spark, sf):
    """Two keyed per-year tables merged, shared keys added."""
    l = table(spark, sf, "lineitem")
    y = [l.where(D.in_year("l_shipdate", yr)).groupBy("l_partkey").agg(F.sum("l_quantity").alias("quantity"))
         for yr in (1997, 1998)]
    return A.merge_sum(y, "l_partkey", ["quantity"])


# Fixed value: word-token pattern shared by the Spark and SQL versions.
TOKEN = "[\\p{L}\\p{N}_]+"


@register("a24_token_frequency", f"""
SELECT token, COUNT(*) AS count FROM (
  SELECT unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS token FROM documents) GROUP BY 1""")
def a24_token_frequency(spark, sf):
    docs = ensure_parallelism(table(spark, sf, "documents").select("text"))
    return A.token_frequency(docs, "text", pattern=TOKEN)


@register("a24_most_frequent_token_per_lang", f"""
SELECT lang, token, count FROM (
  SELECT lang, token, count, row_number() OVER (PARTITION BY lang ORDER BY count DESC, token) AS rn FROM (
    SELECT lang, token, COUNT(*) AS count FROM (
      SELECT lang, unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS token FROM documents) GROUP BY 1, 2))
WHERE rn = 1""")
def a24_most_frequent_token_per_lang(spark, sf):
    docs = ensure_parallelism(table(spark, sf, "documents").select("lang", "text"))
    freq = A.token_frequency(docs, "text", by="lang", pattern=TOKEN)
    return A.most_frequent(freq, "token", "count", by="lang")
