"""Sources, sinks, ingestion, the layered flow and streaming ingestion."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lakeloom.plans import medallion
from lakeloom.sources import bulk, catalog, files, jdbc
from lakeloom.streaming import bronze_stream

SF = "/root/testdata/sf0.001"


def test_csv_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([("Pen", 10, True), ("Book", 150, False)], "Item string, Price int, In_Stock boolean")
    files.write_csv(df, f"{tmp_dir}/io")
    typed = files.read_csv(spark, f"{tmp_dir}/io", infer=True)
    assert dict(typed.dtypes) == {"Item": "string", "Price": "int", "In_Stock": "boolean"}
    raw = files.read_csv(spark, f"{tmp_dir}/io")
    assert set(t for _, t in raw.dtypes) == {"string"}


def test_partitioned_parquet_prunes(spark, tmp_dir):
    o = spark.read.parquet(f"{SF}/orders.parquet").withColumn("year", F.year("o_orderdate"))
    files.write_parquet(o, f"{tmp_dir}/o", partition_by=["year"])
    back = files.read_parquet(spark, f"{tmp_dir}/o").where("year = 1998")
    plan = catalog.explain_plan(back)
    assert "PartitionFilters: [isnotnull(year" in plan
    assert back.count() == o.where("year = 1998").count()


def test_catalog_and_tables(spark, tmp_dir):
    catalog.create_database(spark, "lakeloom_test")
    files.save_table(spark.range(5), "lakeloom_test.t5")
    assert "t5" in [r.tableName for r in catalog.list_tables(spark, "lakeloom_test").collect()]
    assert files.read_table(spark, "lakeloom_test.t5").count() == 5
    assert catalog.schema_profile(spark.range(1)) == [("id", "bigint", False)]
    assert "Range" in catalog.explain_plan(spark.range(3))
    syn = catalog.synthetic(spark, 100, {"customer_id": "id + 1", "region": "element_at(array('N','S'), cast(id % 2 as int) + 1)"})
    assert syn.where("region = 'S'").count() == 50


def test_ingest_tables_with_file_reader(spark, tmp_dir):
    reader = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    sink = lambda df, target: df.write.mode("overwrite").parquet(f"{tmp_dir}/{target}")
    log = jdbc.ingest_tables(spark, reader, ["region", "nation", "missing_table"], sink,
                             dt.datetime(2024, 1, 1), "tpch")
    st = {r.source_table: r.status for r in log.collect()}
    assert st == {"region": "SUCCESS", "nation": "SUCCESS", "missing_table": "FAILED"}
    back = spark.read.parquet(f"{tmp_dir}/nation")
    assert {"ingestion_timestamp", "source_system", "source_table"} <= set(back.columns)


def test_bulk_load_starts_again_where_it_stopped(spark, tmp_dir):
    tried = []

    def reader(name):
        tried.append(name)
        if name == "s.orders" and tried.count(name) == 1:
            raise OSError("source is down")
        return spark.read.parquet(f"{SF}/{name.split('.')[1]}.parquet")

    load = lambda run: {r.target_table: (r.status, r.row_count) for r in bulk.bulk_load(
        spark, reader, ["s.region", "s.orders", "s.gone"], f"{tmp_dir}/lake", f"{tmp_dir}/log", run).collect()}
    orders = spark.read.parquet(f"{SF}/orders.parquet").count()
    assert load("r1") == {"region": ("SUCCESS", 5), "orders": ("FAILED", None), "gone": ("FAILED", None)}
    assert load("r1") == {"region": ("SKIPPED", 5), "orders": ("SUCCESS", orders), "gone": ("FAILED", None)}
    assert tried.count("s.region") == 1 and tried.count("s.orders") == 2
    assert load("r2")["region"] == ("SUCCESS", 5)  # another run loads anew
    log = {r.target_table: r.status for r in bulk.load_log(spark, f"{tmp_dir}/log", "r1").collect()}
    assert log["region"] == log["orders"] == "SUCCESS" and log["gone"] == "FAILED"
    assert bulk.load_log(spark, f"{tmp_dir}/log", "never").count() == 0
    with pytest.raises(ValueError):
        bulk.bulk_load(spark, reader, ["a.t", "b.T"], f"{tmp_dir}/lake", f"{tmp_dir}/log", "r3")
    with pytest.raises(ValueError):
        bulk.bulk_load(spark, reader, ["a.t"], f"{tmp_dir}/lake", f"{tmp_dir}/log", "../r3")


def test_medallion_run(spark, tmp_dir):
    audits = medallion.run(spark, lambda t: spark.read.parquet(f"{SF}/{t}.parquet"), f"{tmp_dir}/lake",
                           dt.datetime(2024, 1, 1))
    gold = audits["gold"].collect()
    assert len(gold) == 3 and all(r.status == "SUCCESS" and r.row_count > 0 for r in gold)
    silver = {r.table_name: r.row_count for r in audits["silver"].collect()}
    assert silver["orders"] == spark.read.parquet(f"{SF}/orders.parquet").count()


def test_bronze_stream(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    spark.read.parquet(f"{SF}/region.parquet").write.parquet(src)
    schema = spark.read.parquet(src).schema
    q = bronze_stream(spark, src, schema, f"{tmp_dir}/sink", f"{tmp_dir}/ckpt", "tpch", "region")
    q.awaitTermination(120)
    out = spark.read.parquet(f"{tmp_dir}/sink")
    assert out.count() == 5 and "source_file" in out.columns
    # a second run with no new files appends nothing (progress is in the checkpoint)
    q2 = bronze_stream(spark, src, schema, f"{tmp_dir}/sink", f"{tmp_dir}/ckpt", "tpch", "region")
    q2.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_dir}/sink").count() == 5


def test_ddl_insert_and_bounded_pulls(spark):
    catalog.create_database(spark, "lakeloom_ddl")
    catalog.create_table(spark, "lakeloom_ddl.departments",
                         "dept_id BIGINT NOT NULL, dept_name STRING NOT NULL, location STRING")
    rows = spark.createDataFrame([(10, "IT", "Mumbai"), (50, "Ops", None)], "dept_id long, dept_name string, location string")
    catalog.insert_rows(spark, "lakeloom_ddl.departments", rows)
    t = files.read_table(spark, "lakeloom_ddl.departments")
    assert sorted(r.dept_id for r in t.collect()) == [10, 50]
    assert len(files.take(t, 1)) == 1
    it = files.iterate(t)
    assert sorted(r.dept_id for r in it) == [10, 50]
    assert catalog.shape(t) == (2, 3)


def test_cached_releases(spark):
    from lakeloom.operators import layout as L
    df = spark.range(10)
    with L.cached(df) as c:
        assert c.is_cached
    assert not df.is_cached


def test_preprocessing_dispatcher(spark):
    from lakeloom.operators import quality as Q
    df = spark.createDataFrame([(1, "a", 1.0, 10.0), (2, "b", 2.0, 10.0), (3, "a", 3.0, 10.0), (4, None, 100.0, 10.0)],
                               "id int, cat string, x double, const double")
    enc = {r.id: r.cat_idx for r in Q.pre_processing(df, "label_encoding", col="cat").collect()}
    assert enc[1] == enc[3] == 0.0 and enc[2] == 1.0
    ohe = Q.pre_processing(df, "one_hot_encoding", col="cat")
    assert "cat_ohe" in ohe.columns and ohe.count() == 4
    sc = Q.pre_processing(df, "feature_scaling", cols=["x"], kind="minmax").orderBy("id").collect()
    assert sc[0].scaled[0] == 0.0 and sc[-1].scaled[0] == 1.0
    sel = Q.pre_processing(df, "feature_selection", cols=["x", "const"]).first().selected
    assert len(sel) == 1
    tr, te = Q.pre_processing(spark.range(1000), "train_test_split", weights=[0.8, 0.2], seed=7)
    assert tr.count() + te.count() == 1000
    out = Q.pre_processing(df, "outliers", col="x").where("is_outlier").collect()
    assert [r.id for r in out] == [4]
    fe = Q.pre_processing(df, "feature_engineering", transforms={"x": "log"})
    assert "x_log" in fe.columns


def test_dynamic_partition_pruning_on_partition_key(spark, tmp_dir):
    """Joining on the partition column lets Spark prune fact partitions from
    the filtered dimension at run time."""
    li = spark.read.parquet(f"{SF}/lineitem.parquet").withColumn("ship_year", F.year("l_shipdate"))
    files.write_parquet(li, f"{tmp_dir}/li", partition_by=["ship_year"])
    cal = spark.createDataFrame([(y, "recent" if y >= 2000 else "old") for y in range(1990, 2005)],
                                "ship_year int, era string")
    files.write_parquet(cal, f"{tmp_dir}/cal")
    fact = files.read_parquet(spark, f"{tmp_dir}/li")
    years = files.read_parquet(spark, f"{tmp_dir}/cal")
    # the 15-row calendar is the broadcast side; the fact is probed and pruned
    j = fact.join(F.broadcast(years.where(F.col("era") == "recent")), "ship_year").groupBy("ship_year").count()
    plan = catalog.explain_plan(j, "formatted")
    assert "dynamicpruningexpression" in plan
    assert j.count() == li.where("ship_year >= 2000").select("ship_year").distinct().count()


def test_jdbc_discovery_validates_identifiers(spark):
    import pytest
    with pytest.raises(ValueError):
        jdbc.discover_tables(spark, "jdbc:none://nowhere", {}, "sales'; DROP TABLE x; --")
