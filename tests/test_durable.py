from pyspark.sql import functions as F

from tidemark.durable import checkpoint_root, durable


def test_the_folder_of_the_session_is_used(spark):
    assert checkpoint_root(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_durable_rows_are_computed_once(spark):
    df = durable(spark.range(100).withColumn("r", F.rand()))
    assert df.collect() == df.collect()


def test_a_durable_table_is_read_column_by_column(spark):
    wide = durable(spark.range(10).select("id", F.lit("x").alias("a"), F.lit("y").alias("b")))
    plan = wide.filter("id > 3").select("a")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "b#" not in plan and "PushedFilters: [IsNotNull(id), GreaterThan(id,3)]" in plan
