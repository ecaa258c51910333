"""Sales reports, joins and aggregates over the order star schema.

Mapping of the reference's domains to the test tables: order header ->
``orders``, order detail -> ``lineitem``, product -> ``part`` (``p_type`` is
the category), customer address -> ``customer`` -> ``nation`` -> ``region``.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeloom.functions import dates as D
from lakeloom.operators import aggregates as A
from lakeloom.operators import joins as J
from lakeloom.operators import ordering as O
from lakeloom.operators import windows as W
from lakeloom.plans._common import (SQL_NET, cents, davg, dsum, exact_sum, net_price, net_sum, net_units,
                                    register, sql_davg, sql_dsum, table, total)


def _geo(spark, sf):
    """customer -> nation -> region, with the two fixed-size dimensions
    (25 nations, 5 regions) broadcast."""
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    r = table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    c = table(spark, sf, "customer")
    return c.join(J.bounded_broadcast(n), "c_nationkey").join(J.bounded_broadcast(r), "n_regionkey")


def _orders(spark, sf):
    return table(spark, sf, "orders")


# ---------------------------------------------------------------- G reports
@register("g5_sales_by_region", f"""
SELECT r.r_name, n.n_name, COUNT(*) AS order_count, {sql_dsum('o.o_totalprice')} AS revenue
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name, n.n_name""")
def g5_sales_by_region(spark, sf):
    """Orders are first reduced to one row per customer (a partial, map-side
    aggregate, so a customer with a huge share of the orders is collapsed
    before any shuffle); that table joins the customer dimension, whose
    nation/region attributes come from broadcast lookups; then the regional
    totals are summed. Exact integer-cent partial sums make the two-level
    sum equal to the direct one."""
    per_cust = (_orders(spark, sf).groupBy(F.col("o_custkey").alias("c_custkey"))
                .agg(F.count(F.lit(1)).alias("_n"), exact_sum(cents("o_totalprice")).alias("_s")))
    return (per_cust.join(_geo(spark, sf).select("c_custkey", "r_name", "n_name"), "c_custkey")
            .groupBy("r_name", "n_name")
            .agg(F.sum("_n").alias("order_count"), (total("_s").cast("double") / 100.0).alias("revenue")))


@register("g1_customer_lifetime_value", f"""
SELECT o_custkey AS customer_key, COUNT(*) AS order_count, {sql_dsum('o_totalprice')} AS lifetime_value,
       CAST(MIN(o_orderdate) AS DATE) AS first_order, CAST(MAX(o_orderdate) AS DATE) AS last_order
FROM orders GROUP BY o_custkey""")
def g1_customer_lifetime_value(spark, sf):
    return (_orders(spark, sf).groupBy(F.col("o_custkey").alias("customer_key"))
            .agg(F.count(F.lit(1)).alias("order_count"), dsum("o_totalprice").alias("lifetime_value"),
                 F.to_date(F.min("o_orderdate")).alias("first_order"),
                 F.to_date(F.max("o_orderdate")).alias("last_order")))


@register("g2_monthly_sales", f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       COUNT(*) AS order_count, {sql_dsum('o_totalprice')} AS revenue
FROM orders GROUP BY 1, 2""")
def g2_monthly_sales(spark, sf):
    return (_orders(spark, sf).groupBy(D.year("o_orderdate").alias("year"), D.month("o_orderdate").alias("month"))
            .agg(F.count(F.lit(1)).alias("order_count"), dsum("o_totalprice").alias("revenue")))


@register("g2_yearly_sales", f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS order_count, {sql_dsum('o_totalprice')} AS revenue
FROM orders GROUP BY 1""")
def g2_yearly_sales(spark, sf):
    return (_orders(spark, sf).groupBy(D.year("o_orderdate").alias("year"))
            .agg(F.count(F.lit(1)).alias("order_count"), dsum("o_totalprice").alias("revenue")))


@register("g2_daily_sales", f"""
SELECT CAST(o_orderdate AS DATE) AS order_date, COUNT(*) AS order_count, {sql_dsum('o_totalprice')} AS revenue
FROM orders GROUP BY 1""")
def g2_daily_sales(spark, sf):
    return (_orders(spark, sf).groupBy(F.to_date("o_orderdate").alias("order_date"))
            .agg(F.count(F.lit(1)).alias("order_count"), dsum("o_totalprice").alias("revenue")))


@register("g3_top10_customers", f"""
SELECT t.o_custkey AS c_custkey, c.c_name, t.revenue FROM (
  SELECT o_custkey, {sql_dsum('o_totalprice')} AS revenue FROM orders GROUP BY o_custkey
  ORDER BY revenue DESC, o_custkey LIMIT 10) t JOIN customer c ON c.c_custkey = t.o_custkey""")
def g3_top10_customers(spark, sf):
    per = (_orders(spark, sf).groupBy(F.col("o_custkey").alias("c_custkey"))
           .agg(dsum("o_totalprice").alias("revenue")))
    top = O.top_k(per, [("revenue", "desc")], 10, tie_break=["c_custkey"])
    return top.join(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey") \
        .select("c_custkey", "c_name", "revenue")


@register("g4_top10_parts", f"""
SELECT l_partkey AS p_partkey, p.p_name, t.revenue FROM (
  SELECT l_partkey, {sql_dsum(SQL_NET, 4)} AS revenue FROM lineitem GROUP BY l_partkey
  ORDER BY revenue DESC, l_partkey LIMIT 10) t JOIN part p ON p.p_partkey = t.l_partkey""")
def g4_top10_parts(spark, sf):
    per = (table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey"))
           .agg(net_sum().alias("revenue")))
    top = O.top_k(per, [("revenue", "desc")], 10, tie_break=["p_partkey"])
    return top.join(table(spark, sf, "part").select("p_partkey", "p_name"), "p_partkey") \
        .select("p_partkey", "p_name", "revenue")


@register("g6_revenue_by_category", f"""
SELECT p.p_type, COUNT(*) AS line_count, {sql_dsum(SQL_NET, 4)} AS revenue
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY p.p_type""")
def g6_revenue_by_category(spark, sf):
    """Lines pre-aggregated per part (map-side), then joined to part and
    summed per category."""
    per_part = (table(spark, sf, "lineitem").groupBy("l_partkey")
                .agg(F.count(F.lit(1)).alias("_n"), exact_sum(net_units()).alias("_s")))
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return (per_part.join(p, "l_partkey").groupBy("p_type")
            .agg(F.sum("_n").alias("line_count"), (total("_s").cast("double") / 1e4).alias("revenue")))


@register("g7_repeat_customers", """
SELECT o_custkey, COUNT(DISTINCT o_orderkey) AS n_orders FROM orders
GROUP BY o_custkey HAVING COUNT(DISTINCT o_orderkey) > 1""")
def g7_repeat_customers(spark, sf):
    return A.distinct_count(_orders(spark, sf), "o_custkey", "o_orderkey", "n_orders", having_min=2)


@register("g8_average_order_value", f"""
SELECT COUNT(*) AS order_count, {sql_davg('o_totalprice')} AS avg_order_value FROM orders""")
def g8_average_order_value(spark, sf):
    return _orders(spark, sf).agg(F.count(F.lit(1)).alias("order_count"),
                                  davg("o_totalprice").alias("avg_order_value"))


@register("g9_customers_without_orders_1998", """
SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
  AND o.o_orderdate >= DATE '1998-01-01' AND o.o_orderdate < DATE '1999-01-01')""")
def g9_customers_without_orders_1998(spark, sf):
    o98 = _orders(spark, sf).where(D.in_year("o_orderdate", 1998)).select(F.col("o_custkey").alias("c_custkey"))
    return J.join(table(spark, sf, "customer").select("c_custkey", "c_name"), o98, "c_custkey", "left_anti")


@register("g9_types_without_large_parts", """
SELECT p_type FROM part GROUP BY 1 HAVING COUNT_IF(p_size >= 49 AND p_brand = 'Brand#1') = 0""")
def g9_types_without_large_parts(spark, sf):
    """Part types (categories) without any part of one brand and size."""
    p = table(spark, sf, "part")
    large = p.where((F.col("p_size") >= 49) & (F.col("p_brand") == "Brand#1")).select("p_type")
    return J.join(p.select("p_type").distinct(), large, "p_type", "left_anti")


@register("g9_parts_not_shipped_1998", """
SELECT p_partkey, p_name FROM part p WHERE NOT EXISTS (
  SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey
  AND l.l_shipdate >= DATE '1998-01-01' AND l.l_shipdate < DATE '1999-01-01')""")
def g9_parts_not_shipped_1998(spark, sf):
    l98 = table(spark, sf, "lineitem").where(D.in_year("l_shipdate", 1998)).select(F.col("l_partkey").alias("p_partkey"))
    return J.join(table(spark, sf, "part").select("p_partkey", "p_name"), l98, "p_partkey", "left_anti")


@register("g10_profit_by_segment", f"""
SELECT c.c_mktsegment, {sql_dsum('o.o_totalprice')} AS revenue,
       CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2)) * CAST(0.20 AS DECIMAL(3,2))) AS DOUBLE) AS profit
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_mktsegment""")
def g10_profit_by_segment(spark, sf):
    """Profit at a 20 % margin, computed exactly (cents x 20 in 1e-4
    units) rather than as ``double * 0.20``. Orders are pre-aggregated per
    customer before the join."""
    per_cust = (_orders(spark, sf).groupBy(F.col("o_custkey").alias("c_custkey"))
                .agg(exact_sum(cents("o_totalprice")).alias("_s")))
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return (per_cust.join(c, "c_custkey").groupBy("c_mktsegment")
            .agg((total("_s").cast("double") / 100.0).alias("revenue"), ((total("_s") * F.lit(20).cast("decimal(2,0)")).cast("double") / 1e4).alias("profit")))


@register("g11_product_performance", f"""
SELECT l_partkey, {sql_dsum(SQL_NET, 4)} AS revenue, SUM(l_quantity) AS total_quantity,
       COUNT(*) AS line_count, COUNT(DISTINCT l_orderkey) AS order_count
FROM lineitem GROUP BY l_partkey""")
def g11_product_performance(spark, sf):
    return (table(spark, sf, "lineitem").groupBy("l_partkey")
            .agg(net_sum().alias("revenue"), F.sum("l_quantity").alias("total_quantity"),
                 F.count(F.lit(1)).alias("line_count"), F.count_distinct("l_orderkey").alias("order_count")))


@register("g12_line_amounts", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
       l_extendedprice / l_quantity AS unit_price,
       CAST({SQL_NET} AS DOUBLE) AS net_amount,
       CAST({SQL_NET} * (1 + CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS gross_amount
FROM lineitem""")
def g12_line_amounts(spark, sf):
    l = table(spark, sf, "lineitem")
    unit = l.l_extendedprice / l.l_quantity
    return l.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", unit.alias("unit_price"),
                    net_price().alias("net_amount"),
                    (net_units() * (F.lit(100) + cents("l_tax")) / 1e6).alias("gross_amount"))


@register("g13_region_rank", f"""
SELECT r_name, revenue, DENSE_RANK() OVER (ORDER BY revenue DESC) AS region_rank FROM (
  SELECT r.r_name, {sql_dsum('o.o_totalprice')} AS revenue
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY r.r_name)""")
def g13_region_rank(spark, sf):
    per_cust = (_orders(spark, sf).groupBy(F.col("o_custkey").alias("c_custkey"))
                .agg(exact_sum(cents("o_totalprice")).alias("_s")))
    totals = (per_cust.join(_geo(spark, sf).select("c_custkey", "r_name"), "c_custkey")
              .groupBy("r_name").agg((total("_s").cast("double") / 100.0).alias("revenue")))
    # one row a region: a plain window over the aggregate
    return totals.withColumn("region_rank", F.dense_rank().over(Window.orderBy(F.desc("revenue"))).cast("long"))


@register("g13_best_month_per_year", f"""
SELECT year, month, revenue FROM (
  SELECT year, month, revenue, RANK() OVER (PARTITION BY year ORDER BY revenue DESC) AS rk FROM (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           {sql_dsum('o_totalprice')} AS revenue FROM orders GROUP BY 1, 2)) WHERE rk = 1""")
def g13_best_month_per_year(spark, sf):
    m = (_orders(spark, sf).groupBy(D.year("o_orderdate").alias("year"), D.month("o_orderdate").alias("month"))
         .agg(dsum("o_totalprice").alias("revenue")))
    return W.top_n_per_group(m, "year", [("revenue", "desc")], 1, "rank")


@register("g14_sales_fact", f"""
SELECT l.l_orderkey, l.l_linenumber, o.o_custkey, l.l_partkey, l.l_suppkey,
       CAST(year(o.o_orderdate) * 10000 + month(o.o_orderdate) * 100 + day(o.o_orderdate) AS INTEGER) AS order_date_key,
       CAST(year(l.l_shipdate) * 10000 + month(l.l_shipdate) * 100 + day(l.l_shipdate) AS INTEGER) AS ship_date_key,
       l.l_quantity, CAST({SQL_NET} AS DOUBLE) AS net_amount
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def g14_sales_fact(spark, sf):
    o = _orders(spark, sf).select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    l = table(spark, sf, "lineitem")
    return l.join(o, "l_orderkey").select(
        "l_orderkey", "l_linenumber", "o_custkey", "l_partkey", "l_suppkey",
        D.date_key("o_orderdate").alias("order_date_key"), D.date_key("l_shipdate").alias("ship_date_key"),
        "l_quantity", net_price().alias("net_amount"))


@register("g14_date_dimension", """
WITH b AS (SELECT CAST(MIN(o_orderdate) AS DATE) AS lo, CAST(MAX(o_orderdate) AS DATE) AS hi FROM orders),
d AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM b)
SELECT CAST(year(date) * 10000 + month(date) * 100 + day(date) AS INTEGER) AS date_key, date,
       CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
       CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
       CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
       dayofweek(date) IN (0, 6) AS is_weekend FROM d""")
def g14_date_dimension(spark, sf):
    """Calendar between the first and last order date (bounds from the data;
    one row per day, generated on the executors)."""
    b = _orders(spark, sf).agg(F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi"))
    d = b.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    dow = F.dayofweek("date")
    return d.select(D.date_key("date").alias("date_key"), "date", F.year("date").alias("year"),
                    F.quarter("date").alias("quarter"), F.month("date").alias("month"),
                    F.dayofmonth("date").alias("day"), dow.alias("day_of_week"), dow.isin(1, 7).alias("is_weekend"))


@register("g16_sales_by_month_category", f"""
SELECT CAST(year(l.l_shipdate) AS INTEGER) AS year, CAST(month(l.l_shipdate) AS INTEGER) AS month, p.p_type,
       SUM(l.l_quantity) AS quantity, {sql_dsum(SQL_NET, 4)} AS revenue
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1, 2, 3""")
def g16_sales_by_month_category(spark, sf):
    per = (table(spark, sf, "lineitem")
           .groupBy("l_partkey", D.year("l_shipdate").alias("year"), D.month("l_shipdate").alias("month"))
           .agg(F.sum("l_quantity").alias("_q"), exact_sum(net_units()).alias("_s")))
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return (per.join(p, "l_partkey").groupBy("year", "month", "p_type")
            .agg(F.sum("_q").alias("quantity"), (total("_s").cast("double") / 1e4).alias("revenue")))


@register("g17_supplier_scorecard", f"""
SELECT s_nationkey, COUNT(*) AS n_suppliers, {sql_davg('s_acctbal')} AS avg_balance,
       MIN(s_acctbal) AS min_balance, MAX(s_acctbal) AS max_balance, {sql_dsum('s_acctbal')} AS total_balance
FROM supplier GROUP BY s_nationkey HAVING COUNT(*) >= 3""")
def g17_supplier_scorecard(spark, sf):
    return (table(spark, sf, "supplier").groupBy("s_nationkey")
            .agg(F.count(F.lit(1)).alias("n_suppliers"), davg("s_acctbal").alias("avg_balance"),
                 F.min("s_acctbal").alias("min_balance"), F.max("s_acctbal").alias("max_balance"),
                 dsum("s_acctbal").alias("total_balance"))
            .where(F.col("n_suppliers") >= 3))


@register("g17_brand_scorecard", f"""
SELECT p_brand, COUNT(*) AS n_parts, {sql_davg('p_retailprice')} AS avg_price, MIN(p_size) AS min_size,
       MAX(p_size) AS max_size FROM part GROUP BY p_brand HAVING COUNT(*) >= 50""")
def g17_brand_scorecard(spark, sf):
    return (table(spark, sf, "part").groupBy("p_brand")
            .agg(F.count(F.lit(1)).alias("n_parts"), davg("p_retailprice").alias("avg_price"),
                 F.min("p_size").alias("min_size"), F.max("p_size").alias("max_size"))
            .where(F.col("n_parts") >= 50))
