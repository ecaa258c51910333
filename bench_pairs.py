"""Before/after timing pairs for the tuning techniques the surveyed
both sides return the same rows, then times full executions into the
``noop`` sink. Prints one JSON line per pair and a summary line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8), BENCH_RUNS (3).
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


BANDS = [(15_000.0, "low"), (35_000.0, "middle"), (60_000.0, "high")]


def main() -> None:
    from lakeloom import checkpoint_dir, get_spark
    from lakeloom.functions import dates as D
    from lakeloom.functions import udfs as Uf
    from lakeloom.operators import aggregates as A
    from lakeloom.operators import layout as L
    from lakeloom.operators import windows as W
    from lakeloom.plans import sales

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_spark("lakeloom-pairs", master=f"local[{cpus}]", shuffle_partitions=cpus * 2,
                      extra_conf={"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    scratch = os.path.join(checkpoint_dir(spark), "pairs")
    t = lambda n: spark.read.parquet(f"{sf}/{n}.parquet")
    li = t("lineitem")

    # layouts written once for the storage pairs
    li.withColumn("ship_year", F.year("l_shipdate")).write.mode("overwrite").partitionBy("ship_year") \
        .parquet(f"{scratch}/li_by_year")
    li.write.mode("overwrite").option("header", True).csv(f"{scratch}/li_csv")

    def money_by_flag(df):
        return df.groupBy("l_returnflag").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("s"),
                                              F.count(F.lit(1)).alias("n"))

    part_read = spark.read.parquet(f"{scratch}/li_by_year")
    old_geo = (t("orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")
               .join(sales._geo(spark, sf), "c_custkey").groupBy("r_name", "n_name")
               .agg(F.count(F.lit(1)).alias("order_count"),
                    F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("revenue")))

    pairs = {
        "predicate_pushdown": (money_by_flag(li.where(F.year("l_shipdate") == 1998)),
                               money_by_flag(li.where(D.in_year("l_shipdate", 1998)))),
        "partition_pruning": (money_by_flag(li.where(D.in_year("l_shipdate", 1998))),
                              money_by_flag(part_read.where(F.col("ship_year") == 1998).drop("ship_year"))),
        "parquet_vs_csv": (money_by_flag(spark.read.schema(li.schema).option("header", True).csv(f"{scratch}/li_csv")),
                           money_by_flag(li)),
        "udf_vs_builtin": (li.groupBy(Uf.bands_udf(BANDS, "top")("l_extendedprice").alias("b")).count(),
                           li.groupBy(Uf.bands("l_extendedprice", BANDS, "top").alias("b")).count()),
        "python_udf_vs_pandas_udf": (li.agg(F.sum(Uf.times_udf(0.9)("l_extendedprice").cast("decimal(18,4)")).alias("s")),
                                     li.agg(F.sum(Uf.times_pandas(0.9)("l_extendedprice").cast("decimal(18,4)")).alias("s"))),
        "skewed_aggregate_salted": (money_by_flag(li),
                                    A.salted_agg(li.withColumn("v", F.col("l_extendedprice").cast("decimal(18,2)")),
                                                 "l_returnflag", "v").select("l_returnflag", F.col("total").alias("s"),
                                                                             "n")),
        "join_then_aggregate_vs_preaggregate": (old_geo, sales.g5_sales_by_region(spark, sf)),
        "single_task_window_vs_segmented_rank": (
            li.select("l_orderkey", "l_linenumber", "l_extendedprice",
                      F.rank().over(Window.orderBy(F.col("l_extendedprice").desc())).alias("rk")),
            W.global_rank(li.select("l_orderkey", "l_linenumber", "l_extendedprice"),
                          [("l_extendedprice", "desc")], "rank", "rk")),
    }
    out = {}
    for name, (before, after) in pairs.items():
        res = L.compare(before, after, runs=runs)
        out[name] = {k: round(v, 3) for k, v in res.items()}
        print(json.dumps({"pair": name, **out[name]}), flush=True)
    with L.shuffle_partitions(spark, 200):
        b = sales.g6_revenue_by_category(spark, sf)
        tb = L.bench(b, runs)
    with L.shuffle_partitions(spark, cpus * 2):
        ta = L.bench(sales.g6_revenue_by_category(spark, sf), runs)
    out["shuffle_partitions_200_vs_tuned"] = {"before_sec": round(tb, 3), "after_sec": round(ta, 3),
                                              "speedup": round(tb / ta, 3)}
    print(json.dumps({"pair": "shuffle_partitions_200_vs_tuned", **out["shuffle_partitions_200_vs_tuned"]}))
    print(json.dumps({"metric": "pairs", "sf": sf, "pairs": out}))


if __name__ == "__main__":
    main()
