"""Lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts, as the session names it.

    ``spark.checkpoint.dir`` wins. Only a local master may fall back to a folder of this machine; on a
    cluster a missing setting is an error, because other machines could not read such a folder.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", "")
    current = context.getCheckpointDir()
    if configured:
        if current is None:
            context.setCheckpointDir(configured)
        return configured
    if current is not None:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    context.setCheckpointDir(folder)
    return folder


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A new path under the shared folder; what is written there goes when the session's JVM ends."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(jvm_path)
    files.deleteOnExit(jvm_path)
    return path


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``shared_folder`` before the session ends."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to ``path`` to its end."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once, written as parquet to the shared folder, and read from there.

    Later steps prune columns and push filters into the files. Column names must differ.
    """
    path = shared_folder(df.sparkSession, "durable")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, column: str, sort_by: list[str], buckets: int, path: str | None = None) -> DataFrame:
    """``df`` written as parquet in ``buckets`` buckets of ``column``, each file sorted by ``sort_by``, and read from there.

    Steps that need the rows of a value of ``column`` together find them together and shuffle nothing. The table is named in
    the catalog only while its plan is made; ``path`` is a new folder under the shared folder if none is given.
    """
    spark = df.sparkSession
    path = path or shared_folder(spark, "bucketed")
    name = f"tidemark_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").mode("overwrite").bucketBy(buckets, column).sortBy(*sort_by)
    writer.option("path", path).saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # its files stay, because it was given a path
