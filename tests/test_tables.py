"""Catalog tables: replaced as a whole or not at all, clustered by key."""

import pytest
from pyspark.sql import functions as F

from promolens.sources import (
    Clustering,
    drop_tables,
    read_table,
    replace_table,
    table_versions,
    write_tables,
)
from promolens.sources.readers import shared_folder


@pytest.fixture
def name(spark, tmp_path):
    found = "t_" + tmp_path.name.replace("-", "_").lower()[-40:]
    yield found
    drop_tables(spark, [found])
    assert table_versions(spark, found) == [] and not spark.catalog.tableExists(found)


@pytest.mark.parametrize("external", [False, True])
def test_replaced_with_its_schema(spark, name, tmp_path, external):
    path = str(tmp_path) if external else None
    write_tables({name: spark.range(3)}, path)
    write_tables({name: spark.range(5).selectExpr("id * 2 as other", "'x' as text")}, path)
    assert [tuple(r) for r in read_table(spark, name).orderBy("other").collect()] == [
        (2 * i, "x") for i in range(5)
    ]


def test_a_write_that_fails_midway_leaves_the_old_rows(spark, name, tmp_path):
    replace_table(name, spark.range(100), str(tmp_path))
    broken = spark.range(0, 1000, 1, 8).select(
        F.when(F.col("id") < 990, F.col("id")).otherwise(F.raise_error("lost").cast("long")).alias("id")
    )
    with pytest.raises(Exception, match="lost"):
        replace_table(name, broken, str(tmp_path))
    assert read_table(spark, name).agg(F.sum("id")).first()[0] == 99 * 50
    assert len(table_versions(spark, name)) == 1
    replace_table(name, spark.range(7), str(tmp_path))
    assert read_table(spark, name).count() == 7


def test_a_reader_of_the_version_before_can_finish(spark, name, tmp_path):
    replace_table(name, spark.range(10), str(tmp_path))
    before = read_table(spark, name)
    replace_table(name, spark.range(20), str(tmp_path))
    assert before.count() == 10 and read_table(spark, name).count() == 20
    for n in range(3):
        replace_table(name, spark.range(n), str(tmp_path))
    assert len(table_versions(spark, name)) == 2


def test_a_table_written_by_other_means_is_taken_over(spark, name):
    spark.range(4).write.saveAsTable(name)
    replace_table(name, read_table(spark, name).where("id > 1"))
    assert sorted(r.id for r in read_table(spark, name).collect()) == [2, 3]


def test_a_clustered_table_is_read_by_key_without_a_shuffle(spark, name):
    rows = spark.range(1000).selectExpr("cast(id % 37 as string) as k", "id as t")
    replace_table(name, rows, clustering=Clustering(("k",), ("t",), 4))
    counted = read_table(spark, name).groupBy("k", "t").count().groupBy("k").agg(F.max("t").alias("t"))
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    assert counted.count() == 37 and counted.agg(F.max("t")).first()[0] == 999


def test_scratch_tables_lie_where_all_executors_read():
    assert shared_folder("hdfs://a/b", "file:/x", "yarn") == "hdfs://a/b"
    assert shared_folder(None, "s3://w", "spark://m:7077") == "s3://w"
    assert shared_folder(None, "file:/x", "local[8]") == "file:/x" == shared_folder("", "file:/x", "local")
    for master in ("yarn", "spark://m:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError, match="checkpoint"):
            shared_folder(None, "file:/x", master)
