"""Bronze / silver / gold flow.

* bronze: source rows unchanged plus lineage columns (ingestion time,
  source system, source table);
* silver: cleaned tables -- snake_case names, trimmed text, one row per
  key (latest ingestion wins), cleansing rules turned into NULLs;
* gold: business reports computed from the stored silver tables;
* an audit table per layer (rows, status, max business date, run time).

Each layer is written as Parquet before the next one reads it, so a lost
executor only recomputes from the last written layer and every layer's
lineage starts at its input files. The base folder defaults to the shared
checkpoint folder named by the cluster (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions import strings as S
from lakeloom.functions.dates import ntz_literal
from lakeloom.operators import joins as J
from lakeloom.operators import projection as P
from lakeloom.operators import quality as Q
from lakeloom.operators import windows as W
from lakeloom.plans._common import dsum, register, table, sql_dsum
from lakeloom.session import checkpoint_dir

# Fixed value: run timestamp of the registered medallion reports.
RUN_TS = _dt.datetime(2024, 1, 1, 0, 0, 0)
LINEAGE = ("ingestion_timestamp", "source_system", "source_table")


def bronze(df: DataFrame, source_system: str, source_table: str, run_ts: _dt.datetime) -> DataFrame:
    return df.withColumns({
        "ingestion_timestamp": ntz_literal(run_ts),
        "source_system": F.lit(source_system),
        "source_table": F.lit(source_table),
    })


def clean(df: DataFrame, keys: Sequence[str], latest_by: str = "ingestion_timestamp") -> DataFrame:
    """Generic silver step: snake_case names, trimmed strings, one row per
    key (the latest by ``latest_by``; ties broken by every other column, the
    largest first, so one aggregate finds it)."""
    df = P.rename_all(df, "snake")
    df = df.select(*[S.strip(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
                     for f in df.schema.fields])
    others = [c for c in df.columns if c not in keys and c != latest_by]
    return W.dedup_keep_first(df, list(keys), [(latest_by, "desc")] + [(c, "desc") for c in others])


def silver_customer(bronze_customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Cleaned customers: capitalised segment, negative balance -> NULL
    credit, nation name attached (25 nations: broadcast)."""
    c = clean(bronze_customer, ["c_custkey"])
    n = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation_name"))
    return (c.join(J.bounded_broadcast(n), "c_nationkey", "left")
            .select("c_custkey", S.strip("c_name").alias("customer_name"), S.capitalize("c_mktsegment").alias("segment"),
                    "c_nationkey", "nation_name", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("credit"),
                    *LINEAGE))


def silver_orders(bronze_orders: DataFrame) -> DataFrame:
    o = clean(bronze_orders, ["o_orderkey"])
    return o.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"),
                    F.col("o_totalprice").cast("decimal(18,2)").alias("total_due"), "o_orderstatus", *LINEAGE)


def _flag(c: str, yes: str) -> Column:
    return F.col(c) == yes


#: table -> (keys, the columns of the cleaned frame besides lineage)
SILVER = {
    "region": (["r_regionkey"], lambda: [F.col("r_regionkey").alias("region_key"), S.capitalize("r_name").alias("region_name")]),
    "nation": (["n_nationkey"], lambda: [F.col("n_nationkey").alias("nation_key"), S.strip("n_name").alias("nation_name"),
                                         F.col("n_regionkey").alias("region_key")]),
    "supplier": (["s_suppkey"], lambda: [F.col("s_suppkey").alias("supplier_key"), S.strip("s_name").alias("supplier_name"),
                                         F.col("s_nationkey").alias("nation_key"), F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")).alias("credit")]),
    "part": (["p_partkey"], lambda: [F.col("p_partkey").alias("part_key"), S.strip("p_name").alias("part_name"), S.strip("p_brand").alias("brand"),
                                     S.strip("p_type").alias("part_type"), "p_size", F.col("p_retailprice").cast("decimal(18,2)").alias("list_price")]),
    "lineitem": (["l_orderkey", "l_linenumber"], lambda: [
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("part_key"), F.col("l_suppkey").alias("supplier_key"), "l_quantity",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("gross"), _flag("l_returnflag", "R").alias("returned"),
        F.to_date("l_shipdate").alias("ship_date")]),
    "events": (["event_id"], lambda: ["event_id", "user_id", "ts", S.strip("event_type").alias("event_type"),
                                      F.when(F.col("event_type") != "error", F.col("value")).alias("reading")]),
    "labels": (["doc_id"], lambda: ["doc_id", (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic")]),
    "conversations": (["conv_id", "turn"], lambda: ["conv_id", "turn", S.capitalize("role").alias("speaker"), F.length("text").alias("message_chars")]),
}


def silver(name: str, bronze_table: DataFrame) -> DataFrame:
    """The cleaned frame of one of the ``SILVER`` tables."""
    keys, columns = SILVER[name]
    return clean(bronze_table, keys).select(*columns(), *LINEAGE)


def gold_sales_by_nation(silver_orders_df: DataFrame, silver_customer_df: DataFrame) -> DataFrame:
    o = silver_orders_df.select(F.col("o_custkey").alias("c_custkey"), "total_due", "order_date")
    return (o.join(silver_customer_df.select("c_custkey", "nation_name"), "c_custkey")
            .groupBy("nation_name", F.year("order_date").alias("year"))
            .agg(F.count(F.lit(1)).alias("orders"), F.sum("total_due").cast("double").alias("revenue")))


def gold_monthly_sales(silver_orders_df: DataFrame) -> DataFrame:
    return (silver_orders_df.groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month"))
            .agg(F.count(F.lit(1)).alias("orders"), F.sum("total_due").cast("double").alias("revenue")))


def gold_supplier_returns(silver_lineitem_df: DataFrame, silver_supplier_df: DataFrame) -> DataFrame:
    """Lines, returned lines and gross amount of each supplier that shipped
    (the lines are summed up before they meet the suppliers)."""
    lines = silver_lineitem_df.groupBy("supplier_key").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if("returned").alias("returned_lines"), F.sum("gross").cast("double").alias("gross"))
    return lines.join(silver_supplier_df.select("supplier_key", "supplier_name"), "supplier_key", "left")


def run(spark: SparkSession, reader: Callable[[str], DataFrame], base_path: str | None = None,
        run_ts: _dt.datetime | None = None, source_system: str = "tpch") -> dict[str, DataFrame]:
    """Run all three layers. ``reader(name)`` supplies a source table (JDBC,
    files or a catalog). Returns the audit frames of every layer."""
    run_ts = run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    base = base_path or f"{checkpoint_dir(spark).rstrip('/')}/medallion-{uuid.uuid4().hex}"

    def write(df: DataFrame, layer: str, name: str) -> DataFrame:
        path = f"{base}/{layer}/{name}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    b = {t: write(bronze(reader(t), source_system, t, run_ts), "bronze", t) for t in ("customer", "orders", *SILVER)}
    s = {"customer": write(silver_customer(b["customer"], b["nation"]), "silver", "customer"),
         "orders": write(silver_orders(b["orders"]), "silver", "orders"),
         **{t: write(silver(t, b[t]), "silver", t) for t in SILVER}}
    g = {"sales_by_nation": write(gold_sales_by_nation(s["orders"], s["customer"]), "gold", "sales_by_nation"),
         "monthly_sales": write(gold_monthly_sales(s["orders"]), "gold", "monthly_sales"),
         "supplier_returns": write(gold_supplier_returns(s["lineitem"], s["supplier"]), "gold", "supplier_returns")}
    return {
        "bronze": Q.audit(spark, b, run_ts, "bronze"),
        "silver": Q.audit(spark, s, run_ts, "silver", {"orders": "order_date", "lineitem": "ship_date"}),
        "gold": Q.audit(spark, g, run_ts, "gold"),
    }


# ---------------------------------------------------------------- registered reports
_BRONZE_CUST = """(SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS ingestion_timestamp, 'tpch' AS source_system,
  'customer' AS source_table FROM customer)"""


@register("med_bronze_customer", f"SELECT * FROM {_BRONZE_CUST}")
def med_bronze_customer(spark, sf):
    return bronze(table(spark, sf, "customer"), "tpch", "customer", RUN_TS)


_SILVER_CUST = f"""(SELECT c.c_custkey, trim(c.c_name) AS customer_name,
  upper(trim(c.c_mktsegment)[1]) || lower(trim(c.c_mktsegment)[2:]) AS segment, c.c_nationkey, n.n_name AS nation_name,
  CASE WHEN c.c_acctbal >= 0 THEN c.c_acctbal END AS credit, c.ingestion_timestamp, c.source_system, c.source_table
FROM {_BRONZE_CUST} c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""


@register("med_silver_customer", f"SELECT * FROM {_SILVER_CUST}")
def med_silver_customer(spark, sf):
    return silver_customer(med_bronze_customer(spark, sf), table(spark, sf, "nation"))


@register("med_gold_sales_by_nation", f"""
SELECT c.nation_name, CAST(year(o.o_orderdate) AS INTEGER) AS year, COUNT(*) AS orders, {sql_dsum('o.o_totalprice')} AS revenue
FROM orders o JOIN {_SILVER_CUST} c ON o.o_custkey = c.c_custkey GROUP BY 1, 2""")
def med_gold_sales_by_nation(spark, sf):
    o = silver_orders(bronze(table(spark, sf, "orders"), "tpch", "orders", RUN_TS))
    return gold_sales_by_nation(o, med_silver_customer(spark, sf))


@register("med_gold_monthly_sales", f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, COUNT(*) AS orders,
  {sql_dsum('o_totalprice')} AS revenue FROM orders GROUP BY 1, 2""")
def med_gold_monthly_sales(spark, sf):
    return gold_monthly_sales(silver_orders(bronze(table(spark, sf, "orders"), "tpch", "orders", RUN_TS)))


_LINEAGE_SQL = "TIMESTAMP '2024-01-01 00:00:00' AS ingestion_timestamp, 'tpch' AS source_system"
_SILVER_SQL = {
    "region": "r_regionkey AS region_key, upper(trim(r_name)[1]) || lower(trim(r_name)[2:]) AS region_name",
    "nation": "n_nationkey AS nation_key, trim(n_name) AS nation_name, n_regionkey AS region_key",
    "supplier": "s_suppkey AS supplier_key, trim(s_name) AS supplier_name, s_nationkey AS nation_key, CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS credit",
    "part": "p_partkey AS part_key, trim(p_name) AS part_name, trim(p_brand) AS brand, trim(p_type) AS part_type, p_size, "
            "CAST(p_retailprice AS DECIMAL(18,2)) AS list_price",
    "lineitem": "l_orderkey, l_linenumber, l_partkey AS part_key, l_suppkey AS supplier_key, l_quantity, "
                "CAST(l_extendedprice AS DECIMAL(18,2)) AS gross, l_returnflag = 'R' AS returned, CAST(l_shipdate AS DATE) AS ship_date",
    "events": "event_id, user_id, ts, trim(event_type) AS event_type, CASE WHEN event_type <> 'error' THEN value END AS reading",
    "labels": "doc_id, quality = 1 AS good, toxic = 1 AS toxic",
    "conversations": "conv_id, turn, upper(role[1]) || lower(role[2:]) AS speaker, length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS message_chars",
}
_ONE = {t: ("" if t != "lineitem" else " QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1")
        for t in SILVER}


def _register_silver(name: str) -> None:
    @register(f"med_silver_{name}", f"SELECT {_SILVER_SQL[name]}, {_LINEAGE_SQL}, '{name}' AS source_table FROM {name}{_ONE[name]}")
    def report(spark, sf):
        return silver(name, bronze(table(spark, sf, name), "tpch", name, RUN_TS))


for _name in SILVER:
    _register_silver(_name)


@register("med_gold_supplier_returns", f"""
SELECT l_suppkey AS supplier_key, COUNT(*) AS lines, COUNT_IF(l_returnflag = 'R') AS returned_lines, {sql_dsum('l_extendedprice')} AS gross,
  trim(s_name) AS supplier_name FROM (SELECT * FROM lineitem{_ONE['lineitem']}) LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 5""")
def med_gold_supplier_returns(spark, sf):
    lines, suppliers = (silver(t, bronze(table(spark, sf, t), "tpch", t, RUN_TS)) for t in ("lineitem", "supplier"))
    return gold_supplier_returns(lines, suppliers)
