"""Profiling, data-quality, privacy, reshape and layout reports."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import functions as F

from lakeloom.functions import privacy as X
from lakeloom.functions import strings as S
from lakeloom.operators import aggregates as A
from lakeloom.operators import layout as L
from lakeloom.operators import quality as Q
from lakeloom.operators import quantiles as QT
from lakeloom.operators import reshape as R
from lakeloom.plans._common import cents, dsum, register, table
from lakeloom.session import checkpoint_dir
from lakeloom.sources import bulk

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
# Fixed value: the run timestamp stamped on audit rows by the reports, so
# their output is reproducible.
RUN_TS = _dt.datetime(2024, 1, 1, 0, 0, 0)


def _r6(df, cols):
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- Q1-Q7
_DESC = """SELECT '{c}' AS "column", COUNT({c}) AS count, ROUND(AVG({c}), 6) AS mean, ROUND(STDDEV_SAMP({c}), 6) AS std,
  MIN({c}) AS min, ROUND(QUANTILE_CONT({c}, 0.25), 6) AS p25, ROUND(QUANTILE_CONT({c}, 0.5), 6) AS p50,
  ROUND(QUANTILE_CONT({c}, 0.75), 6) AS p75, MAX({c}) AS max FROM lineitem"""


@register("q1_describe", " UNION ALL ".join(_DESC.format(c=c) for c in ("l_quantity", "l_extendedprice", "l_discount")))
def q1_describe(spark, sf):
    d = Q.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return _r6(d, {"mean", "std", "p25", "p50", "p75"})


@register("q2_quantiles_by_group", """
SELECT o_orderpriority, ROUND(QUANTILE_CONT(o_totalprice, 0.1), 6) AS p10, ROUND(MEDIAN(o_totalprice), 6) AS median,
  ROUND(QUANTILE_CONT(o_totalprice, 0.9), 6) AS p90 FROM orders GROUP BY 1""")
def q2_quantiles_by_group(spark, sf):
    q = QT.exact_percentiles(table(spark, sf, "orders"), "o_totalprice", [0.1, 0.5, 0.9], ["o_orderpriority"],
                             ["p10", "median", "p90"])
    return _r6(q, {"p10", "median", "p90"})


@register("q3_iqr_outliers", """
WITH b AS (SELECT l_returnflag, QUANTILE_CONT(l_quantity * l_discount, 0.25) AS q1,
                  QUANTILE_CONT(l_quantity * l_discount, 0.75) AS q3 FROM lineitem GROUP BY 1)
SELECT l.l_orderkey, l.l_linenumber, l.l_returnflag, l.l_quantity * l.l_discount AS discount_units
FROM lineitem l JOIN b USING (l_returnflag)
WHERE l.l_quantity * l.l_discount < b.q1 - 1.5 * (b.q3 - b.q1) OR l.l_quantity * l.l_discount > b.q3 + 1.5 * (b.q3 - b.q1)""")
def q3_iqr_outliers(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag",
                                            (F.col("l_quantity") * F.col("l_discount")).alias("discount_units"))
    return Q.iqr_outliers(l, "discount_units", "l_returnflag")


@register("q4_histogram", """
WITH b AS (SELECT MIN(o_totalprice) AS lo, MAX(o_totalprice) AS hi FROM orders),
h AS (SELECT LEAST(CAST(FLOOR((o_totalprice - lo) / ((hi - lo) / 10)) AS INTEGER) + 1, 10) AS bin, lo, hi FROM orders, b)
SELECT bin, lo + (bin - 1) * ((hi - lo) / 10) AS bin_start, lo + bin * ((hi - lo) / 10) AS bin_end, COUNT(*) AS count
FROM h GROUP BY bin, lo, hi""")
def q4_histogram(spark, sf):
    return Q.histogram(table(spark, sf, "orders"), "o_totalprice", 10)


@register("q5_box_stats", """
WITH b AS (SELECT o_orderpriority, QUANTILE_CONT(o_totalprice, 0.25) AS q1, QUANTILE_CONT(o_totalprice, 0.75) AS q3
           FROM orders GROUP BY 1),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM b)
SELECT f.o_orderpriority, ROUND(q1, 6) AS q1, ROUND(q3, 6) AS q3, ROUND(iqr, 6) AS iqr, ROUND(lower, 6) AS lower,
  ROUND(upper, 6) AS upper, MIN(CASE WHEN o_totalprice BETWEEN lower AND upper THEN o_totalprice END) AS whisker_low,
  MAX(CASE WHEN o_totalprice BETWEEN lower AND upper THEN o_totalprice END) AS whisker_high,
  COUNT_IF(o_totalprice < lower OR o_totalprice > upper) AS n_outliers
FROM orders o JOIN f USING (o_orderpriority) GROUP BY f.o_orderpriority, q1, q3, iqr, lower, upper""")
def q5_box_stats(spark, sf):
    b = Q.box_stats(table(spark, sf, "orders"), "o_totalprice", "o_orderpriority")
    return _r6(b, {"q1", "q3", "iqr", "lower", "upper"})


@register("q6_grouped_mean", """
SELECT p.p_type, l.l_returnflag, ROUND(AVG(l.l_quantity), 6) AS mean_l_quantity
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1, 2""")
def q6_grouped_mean(spark, sf):
    l = table(spark, sf, "lineitem")
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return _r6(Q.grouped_mean(l.join(p, "l_partkey"), "p_type", "l_quantity", "l_returnflag"), {"mean_l_quantity"})


def _types_sql(col, kind, typ):
    if kind == "int":
        sug = (f"CASE WHEN MIN({col}) >= -128 AND MAX({col}) <= 127 THEN 'tinyint' "
               f"WHEN MIN({col}) >= -32768 AND MAX({col}) <= 32767 THEN 'smallint' "
               f"WHEN MIN({col}) >= -2147483648 AND MAX({col}) <= 2147483647 THEN 'int' ELSE 'bigint' END")
    else:
        sug = (f"CASE WHEN COUNT_IF(CAST(CAST({col} AS FLOAT) AS DOUBLE) <> {col}) = 0 THEN 'float' ELSE 'double' END")
    return (f"SELECT '{col}' AS \"column\", '{typ}' AS current_type, CAST(MIN({col}) AS DOUBLE) AS min, "
            f"CAST(MAX({col}) AS DOUBLE) AS max, {sug} AS suggested_type FROM lineitem")


_LTYPES = [("l_orderkey", "int", "bigint"), ("l_partkey", "int", "bigint"), ("l_suppkey", "int", "bigint"),
           ("l_linenumber", "int", "int"), ("l_quantity", "f", "double"), ("l_extendedprice", "f", "double"),
           ("l_discount", "f", "double"), ("l_tax", "f", "double")]


@register("q7_suggest_types", " UNION ALL ".join(_types_sql(c, k, t) for c, k, t in _LTYPES))
def q7_suggest_types(spark, sf):
    return Q.suggest_types(table(spark, sf, "lineitem"))


@register("q8_validate_load", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, 'SUCCESS' AS status, COUNT(*) AS row_count, CAST(NULL AS VARCHAR) AS error FROM {t}"
    for t in TABLES))
def q8_validate_load(spark, sf):
    """Load status of every source table; each count is its own job and a
    failing table is reported, not raised."""
    return Q.validate_load(spark, {t: (lambda t=t: table(spark, sf, t)) for t in TABLES})


@register("s16_bulk_load", " UNION ALL ".join(
    f"SELECT CAST({n} AS INTEGER) AS attempt, '{t}' AS source_table, '{status}' AS status, COUNT(*) AS row_count, COUNT(*) AS stored_rows, false AS failed FROM {t}"
    for n, status in ((1, "SUCCESS"), (2, "SKIPPED")) for t in TABLES) + "".join(
    f" UNION ALL SELECT {n}, 'not_there', 'FAILED', NULL, NULL, true" for n in (1, 2)))
def s16_bulk_load(spark, sf):
    """Every source table and one that is missing, loaded side by side; the
    second attempt of the run tries only the missing one again."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/bulk-{uuid.uuid4().hex}"
    names = [*TABLES, "not_there"]
    logs = [bulk.bulk_load(spark, lambda t: table(spark, sf, t), names, f"{folder}/tables", f"{folder}/log", "nightly", run_ts=RUN_TS, source_system="tpch")
            .select(F.lit(n).alias("attempt"), "source_table", "status", "row_count", F.col("error").isNotNull().alias("failed")) for n in (1, 2)]
    stored = Q.validate_load(spark, {t: (lambda t=t: spark.read.parquet(f"{folder}/tables/{t}")) for t in TABLES})
    counts = stored.select(F.col("table_name").alias("source_table"), F.col("row_count").alias("stored_rows"))
    return logs[0].unionByName(logs[1]).join(F.broadcast(counts), "source_table", "left")  # a row a table


@register("q9_bronze_audit", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, 'bronze' AS layer, COUNT(*) AS row_count, 'SUCCESS' AS status, "
    f"CAST(NULL AS TIMESTAMP) AS max_business_ts, TIMESTAMP '2024-01-01 00:00:00' AS run_ts FROM {t}"
    for t in TABLES))
def q9_bronze_audit(spark, sf):
    return Q.audit(spark, {t: table(spark, sf, t) for t in TABLES}, RUN_TS, "bronze")


_CLEAN_LINES = """(SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1)"""
_AUDITED = {  # table: (layer, rows counted, newest business date)
    "customer": ("silver", "FROM customer", None),
    "orders": ("silver", "FROM orders", "MAX(CAST(o_orderdate AS DATE))"),
    "region": ("silver", "FROM region", None), "nation": ("silver", "FROM nation", None),
    "supplier": ("silver", "FROM supplier", None), "part": ("silver", "FROM part", None),
    "lineitem": ("silver", f"FROM {_CLEAN_LINES}", "MAX(CAST(l_shipdate AS DATE))"),
    "events": ("silver", "FROM events", None), "labels": ("silver", "FROM labels", None), "conversations": ("silver", "FROM conversations", None),
    "sales_by_nation": ("gold", "FROM (SELECT DISTINCT c_nationkey, year(o_orderdate) FROM orders JOIN customer ON o_custkey = c_custkey)", None),
    "monthly_sales": ("gold", "FROM (SELECT DISTINCT date_trunc('month', o_orderdate) FROM orders)", None),
    "supplier_returns": ("gold", f"FROM (SELECT DISTINCT l_suppkey FROM {_CLEAN_LINES})", None),
}


@register("q10_gold_audit", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{layer}' AS layer, COUNT(*) AS row_count, 'SUCCESS' AS status, "
    f"CAST({newest or 'NULL'} AS TIMESTAMP) AS max_business_ts, TIMESTAMP '2024-01-01 00:00:00' AS run_ts {rows}"
    for t, (layer, rows, newest) in _AUDITED.items()))
def q10_gold_audit(spark, sf):
    """All three layers are built and stored; every silver and gold table is
    audited from what was stored."""
    from lakeloom.plans import medallion
    done = medallion.run(spark, lambda t: table(spark, sf, t), run_ts=RUN_TS)
    return done["silver"].unionByName(done["gold"])


@register("q11_key_checks", """
SELECT 'primary_key' AS "check", 'l_orderkey,l_linenumber' AS "column",
  CAST(COALESCE((SELECT SUM(n) FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)), 0) AS BIGINT) AS violations
UNION ALL SELECT 'not_null', 'l_quantity', COUNT_IF(l_quantity IS NULL) FROM lineitem
UNION ALL SELECT 'not_null', 'l_orderkey', COUNT_IF(l_orderkey IS NULL) FROM lineitem
UNION ALL SELECT 'not_null', 'l_linenumber', COUNT_IF(l_linenumber IS NULL) FROM lineitem
UNION ALL SELECT 'foreign_key', 'l_partkey', COUNT(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
UNION ALL SELECT 'foreign_key', 'l_orderkey', COUNT(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)""")
def q11_key_checks(spark, sf):
    l = table(spark, sf, "lineitem")
    return Q.key_checks(l, ["l_orderkey", "l_linenumber"], ["l_quantity"],
                        [("l_partkey", table(spark, sf, "part"), "p_partkey"),
                         ("l_orderkey", table(spark, sf, "orders"), "o_orderkey")])


@register("q12_label_encoding", """
SELECT c_custkey, CAST(DENSE_RANK() OVER (ORDER BY c_mktsegment) - 1 AS DOUBLE) AS segment_idx FROM customer""")
def q12_label_encoding(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return Q.pre_processing(c, "label_encoding", col="c_mktsegment", out="segment_idx").select("c_custkey", "segment_idx")


@register("q12_label_encoding_unique", """
SELECT o_orderkey, CAST(DENSE_RANK() OVER (ORDER BY label) - 1 AS DOUBLE) AS label_idx FROM (
  SELECT o_orderkey, o_orderpriority || '-' || CAST(o_orderkey AS VARCHAR) AS label FROM orders)""")
def q12_label_encoding_unique(spark, sf):
    """As many labels as rows: the dictionary is numbered in segments."""
    o = table(spark, sf, "orders").select("o_orderkey", F.concat_ws("-", "o_orderpriority", F.col("o_orderkey").cast("string")).alias("label"))
    return Q.pre_processing(o, "label_encoding", col="label", out="label_idx").select("o_orderkey", "label_idx")


@register("q12_one_hot_encoding", """
WITH d AS (SELECT c_mktsegment, CAST(DENSE_RANK() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS place FROM (SELECT DISTINCT c_mktsegment FROM customer))
SELECT c_custkey, place, (SELECT CAST(count(*) AS INTEGER) FROM d) AS width, 1.0::DOUBLE AS total FROM customer JOIN d USING (c_mktsegment)""")
def q12_one_hot_encoding(spark, sf):
    from pyspark.ml.functions import vector_to_array
    c = Q.pre_processing(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "one_hot_encoding", col="c_mktsegment", out="v")
    v = c.select("c_custkey", vector_to_array("v").alias("a"))
    return v.select("c_custkey", (F.array_position("a", 1.0) - 1).cast("int").alias("place"), F.size("a").alias("width"),
                    F.aggregate("a", F.lit(0.0), lambda x, y: x + y).alias("total"))


@register("q12_feature_scaling", """
SELECT p_partkey, round((p_size - avg(p_size) OVER ()) / stddev_samp(p_size) OVER (), 6) AS size_scaled,
       round((p_retailprice - avg(p_retailprice) OVER ()) / stddev_samp(p_retailprice) OVER (), 6) AS price_scaled FROM part""")
def q12_feature_scaling(spark, sf):
    from pyspark.ml.functions import vector_to_array
    p = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    s = Q.pre_processing(p, "feature_scaling", cols=["p_size", "p_retailprice"]).select("p_partkey", vector_to_array("scaled").alias("a"))
    return s.select("p_partkey", F.round(F.col("a")[0], 6).alias("size_scaled"), F.round(F.col("a")[1], 6).alias("price_scaled"))


# ---------------------------------------------------------------- X5-X9
@register("x5_x9_masking_and_hashing", """
SELECT c_custkey, '*******' || right(c_name, 4) AS name_last4,
  CASE WHEN length(c_name) >= 4 THEN repeat('X', CAST(floor((length(c_name) - 4) / 2) AS INTEGER))
       || substring(c_name, CAST(floor((length(c_name) - 4) / 2) AS INTEGER) + 1, 4)
       || repeat('X', length(c_name) - CAST(floor((length(c_name) - 4) / 2) AS INTEGER) - 4) END AS name_middle4,
  substring(c_name, 1, 4) || 'xxxx' || substring(c_name, 9) AS name_span_masked,
  sha256(c_name) AS name_sha256, sha256('pepper' || CAST(c_custkey AS VARCHAR)) AS key_salted_sha256,
  c_name AS decrypted_name, true AS encrypted
FROM customer""")
def x5_x9_masking_and_hashing(spark, sf):
    c = table(spark, sf, "customer")
    key = _privacy_key(spark)
    enc = X.encrypt_col("c_name", key)
    return c.select("c_custkey", X.mask_keep_last("c_name", 4, "*******").alias("name_last4"),
                    X.mask_keep_middle("c_name", 4, "X").alias("name_middle4"),
                    X.mask_span("c_name", 4, 8, "x").alias("name_span_masked"),
                    X.hash_col("c_name").alias("name_sha256"),
                    X.hash_col("c_custkey", salt="pepper").alias("key_salted_sha256"),
                    X.decrypt_col(enc, key).alias("decrypted_name"),
                    (~F.coalesce(enc.cast("string").contains(F.col("c_name")), F.lit(False))).alias("encrypted"))


def _privacy_key(spark) -> str:
    """The key the session names (``lakeloom.privacy.key``, from a secret
    store), else a random one for this run."""
    import secrets
    return spark.conf.get("lakeloom.privacy.key", None) or secrets.token_hex(16)


# ---------------------------------------------------------------- R1-R7
_PIV = """SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS F,
  CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS O,
  CAST(SUM(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS P
FROM orders GROUP BY 1"""


def _pivot(spark, sf):
    o = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), "o_orderstatus",
                                          cents("o_totalprice").alias("amount"))
    p = R.pivot(o, "year", "o_orderstatus", "amount", ["F", "O", "P"], "sum")
    return p.select("year", *[(F.col(s) / 100.0).alias(s) for s in ("F", "O", "P")])


@register("r1_pivot_table", _PIV)
def r1_pivot_table(spark, sf):
    return _pivot(spark, sf)


@register("r2_unstack", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT_IF(o_orderpriority = '1-URGENT') AS "1-URGENT",
  COUNT_IF(o_orderpriority = '2-HIGH') AS "2-HIGH", COUNT_IF(o_orderpriority = '3-MEDIUM') AS "3-MEDIUM",
  COUNT_IF(o_orderpriority = '4-NOT SPECIFIED') AS "4-NOT SPECIFIED", COUNT_IF(o_orderpriority = '5-LOW') AS "5-LOW"
FROM orders GROUP BY 1""")
def r2_unstack(spark, sf):
    levels = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    counts = (table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year"), "o_orderpriority")
              .agg(F.count(F.lit(1)).alias("n")))
    out = R.unstack(counts, "year", "o_orderpriority", "n", levels)
    return out.select("year", *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(c) for c in levels])


@register("r3_stack", f"""
SELECT year, status, amount FROM ({_PIV}) UNPIVOT (amount FOR status IN (F, O, P))""")
def r3_stack(spark, sf):
    return R.stack(_pivot(spark, sf), "year", ["F", "O", "P"], "status", "amount")


@register("r5_resample_weekly", """
SELECT event_type, CAST(date_trunc('week', ts) AS DATE) + 6 AS week_end, ROUND(AVG(value), 6) AS value
FROM events GROUP BY 1, 2""")
def r5_resample_weekly(spark, sf):
    r = R.resample_weekly(table(spark, sf, "events"), "ts", ["value"], "mean", by="event_type")
    return _r6(r, {"value"})


@register("r5_resample_weekly_gaps", """
WITH w AS (SELECT event_type, CAST(date_trunc('week', ts) AS DATE) + 6 AS week_end, AVG(value) AS v FROM events
           WHERE weekofyear(ts) % 3 <> 0 GROUP BY 1, 2),
g AS (SELECT event_type, CAST(unnest(generate_series(MIN(week_end), MAX(week_end), INTERVAL 7 DAY)) AS DATE) AS week_end FROM w GROUP BY 1)
SELECT event_type, week_end, ROUND(v, 6) AS value FROM g LEFT JOIN w USING (event_type, week_end)""")
def r5_resample_weekly_gaps(spark, sf):
    """Every third week is taken out, so that empty weeks have to be filled."""
    e = table(spark, sf, "events").where(F.weekofyear("ts") % 3 != 0)
    return _r6(R.resample_weekly(e, "ts", ["value"], "mean", by="event_type"), {"value"})


@register("r6_select_one_date", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= DATE '1997-05-28' AND o_orderdate < DATE '1997-05-29'""")
def r6_select_one_date(spark, sf):
    from lakeloom.functions.dates import between_dates
    return table(spark, sf, "orders").where(between_dates("o_orderdate", "1997-05-28", "1997-05-28")) \
        .select("o_orderkey", "o_totalprice")


@register("r7_row_wise_expression", """
SELECT p_partkey, upper(p_type[1]) || lower(p_type[2:]) || ':' || CAST(p_size AS VARCHAR) AS label FROM part""")
def r7_row_wise_expression(spark, sf):
    p = table(spark, sf, "part")
    return R.with_expression(p, "label", F.concat(S.capitalize("p_type"), F.lit(":"), F.col("p_size").cast("string"))) \
        .select("p_partkey", "label")


# ---------------------------------------------------------------- layout (data unchanged)
@register("l1_l2_repartition_coalesce", "SELECT * FROM lineitem")
def l1_l2_repartition_coalesce(spark, sf):
    """Hash repartition by key, then coalesce: every row with all its columns."""
    return L.coalesce_to(L.repartition_by(table(spark, sf, "lineitem"), 16, ["l_orderkey"]), 4)


@register("l1_l2_partition_evidence", "SELECT 16 AS dealt, 4 AS coalesced, COUNT(*) AS n_rows, SUM(l_linenumber) AS lines, true AS keys_together FROM lineitem")
def l1_l2_partition_evidence(spark, sf):
    """Hash repartition by key, then coalesce: how many partitions there are
    (counted from the rows), that no key is in two of them, and all rows."""
    dealt = L.repartition_by(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), 16, ["l_orderkey"])
    few = L.coalesce_to(dealt, 4)
    at = few.withColumn("_p", F.spark_partition_id()).groupBy("l_orderkey", "_p").agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("s"))
    keys = at.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("places"), F.sum("n").alias("n"), F.sum("s").alias("s"))
    return keys.agg(F.lit(L.partition_count(dealt)).alias("dealt"), F.lit(L.partition_count(few)).alias("coalesced"), F.sum("n").alias("n_rows"),
                    F.sum("s").alias("lines"), (F.max("places") == 1).alias("keys_together"))


@register("l8_zorder_clustering", """
SELECT 16 AS n_files, (SELECT COUNT(*) FROM lineitem) AS n_rows, COUNT(*) AS wanted, COUNT(*) AS wanted_in_read, 0 AS wanted_in_skipped, true AS most_skipped
FROM lineitem WHERE l_partkey BETWEEN 40 AND 80 AND l_suppkey BETWEEN 2 AND 4""")
def l8_zorder_clustering(spark, sf):
    """Lines written in Z-order on (partkey, suppkey). From the files' ranges: how many a
    box filter skips, and a brute count of wanted rows in the files read and skipped."""
    path, cols, box = _scratch(spark, "zorder"), ["l_partkey", "l_suppkey"], {"l_partkey": (40, 80), "l_suppkey": (2, 4)}
    L.zorder_write(table(spark, sf, "lineitem"), path, cols, bits=6, files=16)
    files = L.skipped_files(L.file_ranges(spark, path, cols), box)
    inside = F.col("l_partkey").between(40, 80) & F.col("l_suppkey").between(2, 4)
    brute = spark.read.parquet(path).select(inside.alias("w"), "_metadata.file_path").groupBy("file_path").agg(F.count_if("w").alias("w"))
    return files.join(brute, "file_path").agg(
        F.count(F.lit(1)).cast("int").alias("n_files"), F.sum("rows").alias("n_rows"), F.sum("w").alias("wanted"),
        F.sum(F.when(~F.col("skipped"), F.col("w")).otherwise(0)).alias("wanted_in_read"),
        F.sum(F.when(F.col("skipped"), F.col("w")).otherwise(0)).cast("int").alias("wanted_in_skipped"),
        (2 * F.count_if("skipped") > F.count(F.lit(1))).alias("most_skipped"))


@register("l3_partition_sizes_total", "SELECT 16 AS partitions, COUNT(*) AS rows, true AS even FROM lineitem")
def l3_partition_sizes_total(spark, sf):
    """Rows per partition after a key repartition: their number, sum, and that none has twice the mean."""
    sizes = L.partition_sizes(L.repartition_by(table(spark, sf, "lineitem"), 16, ["l_orderkey"]))
    return sizes.agg(F.count(F.lit(1)).cast("int").alias("partitions"), F.sum("rows").alias("rows"), (F.max("rows") <= 2 * F.avg("rows")).alias("even"))


@register("l4_l5_shared_reuse", """
WITH per AS (SELECT o_custkey, COUNT(*) AS n, MAX(o_totalprice) AS most FROM orders GROUP BY 1)
SELECT o_custkey, n, most, (SELECT MAX(n) FROM per) AS most_orders FROM per WHERE most >= (SELECT MAX(most) * 0.9 FROM per)""")
def l4_l5_shared_reuse(spark, sf):
    """One persisted aggregate with two consumers, shuffled to as many partitions as its bytes call for."""
    with L.shuffle_partitions(spark, L.sized_partitions(spark, f"{sf}/orders.parquet")):
        per = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("most"))
        got = L.shared_reuse(per, {"tops": lambda p: p.agg(F.max("n").alias("most_orders"), (F.max("most") * 0.9).alias("least")),
                                   "customers": lambda p: p})
    top = got["tops"].first()
    return got["customers"].where(F.col("most") >= top.least).withColumn("most_orders", F.lit(top.most_orders).cast("long"))


# ---------------------------------------------------------------- X1-X4 (UDF surface)
@register("x3_discount_band", """
SELECT b.band, COUNT(*) AS count FROM lineitem JOIN (VALUES (0, 15000, 'low'), (15000, 35000, 'middle'),
  (35000, 60000, 'high'), (60000, 1000000000, 'top')) b(a, z, band) ON l_extendedprice >= a AND l_extendedprice < z GROUP BY 1""")
def x3_discount_band(spark, sf):
    """Line amounts banded with the built-in expression (the UDF twin is the
    slow path measured in the optimisation pairs)."""
    from lakeloom.functions.udfs import bands
    l = table(spark, sf, "lineitem")
    edges = [(15_000.0, "low"), (35_000.0, "middle"), (60_000.0, "high")]
    return l.groupBy(bands("l_extendedprice", edges, "top").alias("band")).agg(F.count(F.lit(1)).alias("count"))


@register("x4_pandas_udf_discount", """
SELECT l_returnflag, COUNT(*) AS n, CAST(SUM(CAST(l_extendedprice * 0.9 AS DECIMAL(18,4))) AS DOUBLE) AS discounted
FROM lineitem GROUP BY 1""")
def x4_pandas_udf_discount(spark, sf):
    """Vectorised (Arrow batch) pandas UDF over every line."""
    from lakeloom.functions.udfs import times_pandas
    l = table(spark, sf, "lineitem")
    d = times_pandas(0.9)(F.col("l_extendedprice")).cast("decimal(18,4)")
    return l.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum(d).cast("double").alias("discounted"))


# ---------------------------------------------------------------- S6-S9 (sinks and scans)
def _scratch(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    import uuid

    from lakeloom.session import checkpoint_dir
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _database(spark) -> str:
    """A database of its own for one run, in the session's warehouse."""
    import uuid
    name = f"run_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


@register("s10_s11_managed_tables", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1, 2""")
def s10_s11_managed_tables(spark, sf):
    """Orders written as a partitioned managed table and read by name."""
    from lakeloom.sources import files
    name = f"{_database(spark)}.orders"
    files.save_table(table(spark, sf, "orders").withColumn("order_year", F.year("o_orderdate")), name, partition_by=["order_year"])
    return spark.table(name).groupBy("order_year", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@register("s12_schema_replacing_overwrite", "SELECT c_custkey, upper(c_mktsegment) AS segment FROM customer")
def s12_schema_replacing_overwrite(spark, sf):
    """A managed table overwritten by a frame of another schema."""
    from lakeloom.sources import files
    c, name = table(spark, sf, "customer"), f"{_database(spark)}.customer"
    files.save_table(c.select("c_custkey", "c_name", "c_acctbal"), name)
    files.save_table(c.select("c_custkey", F.upper("c_mktsegment").alias("segment")), name)
    return spark.table(name)


@register("s18_s19_view_and_sql", """
SELECT n_name, COUNT(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def s18_s19_view_and_sql(spark, sf):
    """Temporary views queried by SQL text."""
    import uuid

    from lakeloom.sources import files
    c, n = (f"{t}_{uuid.uuid4().hex}" for t in ("customer", "nation"))
    files.temp_view(table(spark, sf, "customer"), c)
    files.temp_view(table(spark, sf, "nation"), n)
    return files.sql(spark, f"SELECT n_name, COUNT(*) AS customers FROM {c} JOIN {n} ON c_nationkey = n_nationkey WHERE n_nationkey >= :low GROUP BY n_name", low=0)


@register("s20_ddl_and_insert", """
SELECT n_regionkey AS region, COUNT(*) AS nations, MIN(n_name) AS first_nation FROM nation GROUP BY 1""")
def s20_ddl_and_insert(spark, sf):
    """A table made by DDL and filled by INSERT ... SELECT."""
    from lakeloom.sources import catalog
    name = f"{_database(spark)}.regions"
    catalog.create_table(spark, name, "region BIGINT, nations BIGINT, first_nation STRING")
    per = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("nations"), F.min("n_name").alias("first_nation"))
    catalog.insert_rows(spark, name, per)
    return spark.table(name)


@register("s17_list_tables", "SELECT 'orders_by_day' AS name, COUNT(DISTINCT o_orderdate) AS n_rows FROM orders UNION ALL SELECT 'segments', COUNT(DISTINCT c_mktsegment) FROM customer")
def s17_list_tables(spark, sf):
    """A database of two derived tables, listed and counted."""
    from lakeloom.sources import catalog, files
    db = _database(spark)
    files.save_table(table(spark, sf, "orders").groupBy("o_orderdate").count(), f"{db}.orders_by_day")
    files.save_table(table(spark, sf, "customer").select("c_mktsegment").distinct(), f"{db}.segments")
    names = [r.tableName for r in catalog.list_tables(spark, db).collect()]  # two names
    counts = [files.read_table(spark, f"{db}.{n}").agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n_rows")) for n in names]
    return counts[0].unionByName(counts[1])


@register("l7_l9_compaction_detail", "SELECT COUNT(*) AS num_rows, true AS fewer_files FROM orders")
def l7_l9_compaction_detail(spark, sf):
    """Orders written as many small files, then compacted: rows stay, files
    get fewer (both counted from what lies in the folders)."""
    small, large = _scratch(spark, "orders-small"), _scratch(spark, "orders-compact")
    table(spark, sf, "orders").repartition(16).write.parquet(small)
    L.compact(spark, small, large, 2)
    before, after = L.table_detail(spark, small), L.table_detail(spark, large)
    return after.crossJoin(F.broadcast(before.select(F.col("num_files").alias("_before")))).select(  # one row each
        "num_rows", (F.col("num_files") < F.col("_before")).alias("fewer_files"))


@register("l11_bucketed_join", """
SELECT c_mktsegment, COUNT(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def l11_bucketed_join(spark, sf):
    """Join of two tables bucketed by the key: neither side is shuffled."""
    db = _database(spark)
    L.write_bucketed(table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey"), f"{db}.o", 8, ["custkey"])
    L.write_bucketed(table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_mktsegment"), f"{db}.c", 8, ["custkey"])
    j = spark.table(f"{db}.o").join(spark.table(f"{db}.c").hint("merge"), "custkey")
    return j.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("orders"))


@register("s6_s7_csv_roundtrip", "SELECT * FROM orders")
def s6_s7_csv_roundtrip(spark, sf):
    """Orders written as CSV with a header and read back with the explicit
    schema (no inference pass): the rows are unchanged."""
    from lakeloom.sources import files
    o = table(spark, sf, "orders")
    path = _scratch(spark, "orders-csv")
    files.write_csv(o, path)
    return files.read_csv(spark, path, schema=o.schema)


@register("s8_s9_partitioned_parquet", """
SELECT *, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders
WHERE o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '1999-01-01'""")
def s8_s9_partitioned_parquet(spark, sf):
    """Orders written as Parquet partitioned by order year; reading one year
    back prunes to that directory (``PartitionFilters``)."""
    from lakeloom.sources import files
    o = table(spark, sf, "orders").withColumn("order_year", F.year("o_orderdate"))
    path = _scratch(spark, "orders-by-year")
    files.write_parquet(o, path, partition_by=["order_year"])
    return files.read_parquet(spark, path).where(F.col("order_year") == 1998)
