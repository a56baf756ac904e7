"""Readers for the source tables and the base table."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, fields
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import as_timestamp
from tidemark.sources.schemas import CSV_PATTERNS, MULTI_LINE_TABLES, REQUEST_SCHEMA, TABLE_COLUMNS
from tidemark.sources.sinks import BUCKETING, CUSTOMER, PURCHASED

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class CommerceTables:
    """The source tables; ``sellers`` is loaded for completeness and used by no operator."""

    orders: DataFrame
    order_items: DataFrame
    payments: DataFrame
    reviews: DataFrame
    customers: DataFrame
    products: DataFrame
    category: DataFrame
    sellers: DataFrame | None = None


def _with_declared(df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """Add declared columns that a file does not have, as NULL of the declared type."""
    missing = {name: F.lit(None).cast(kind) for name, kind in declared.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df


def read_csv_table(spark: SparkSession, path: str, declared: dict[str, str], multi_line: bool = False) -> DataFrame:
    """One CSV table, its columns matched to the declared types by header name.

    Undeclared columns stay strings. A row that does not fit keeps its readable fields and is held whole in
    ``_corrupt_record``. Only the header line is read to plan; no pass infers types.
    """
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line}
    header = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(name, T._parse_datatype_string(declared.get(name, "string"))) for name in header])
    schema.add(CORRUPT, T.StringType())
    rows = (
        spark.read.schema(schema)
        .options(**options)
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, enforceSchema=False)
        .csv(path)
    )
    return _with_declared(rows, declared)


def read_csv_tables(spark: SparkSession, folder: str, patterns: dict[str, str] | None = None) -> CommerceTables:
    """The eight tables from a folder of CSV files; ``patterns`` overrides file names by table."""
    names = {**CSV_PATTERNS, **(patterns or {})}
    return CommerceTables(
        **{
            table: read_csv_table(spark, f"{folder}/{names[table]}", declared, table in MULTI_LINE_TABLES)
            for table, declared in TABLE_COLUMNS.items()
        }
    )


def read_parquet_tables(spark: SparkSession, folder: str) -> CommerceTables:
    """The tables from ``<folder>/<table>.parquet`` (files or directories)."""
    return CommerceTables(
        **{
            f.name: _with_declared(spark.read.parquet(f"{folder}/{f.name}.parquet"), TABLE_COLUMNS[f.name])
            for f in fields(CommerceTables)
        }
    )


def read_base_table(spark: SparkSession, path: str, before: datetime | str | None = None) -> DataFrame:
    """The stored base table; ``before`` prunes the months that start at or after that moment."""
    table = spark.read.parquet(path)
    if before is None:
        return table
    moment = as_timestamp(before)
    return table.filter((F.col("purchase_month") <= moment.cast("date")) & (F.col("order_purchase_timestamp") < moment))


def read_bucketed_base_table(spark: SparkSession, path: str) -> DataFrame:
    """The base table that ``write_bucketed_base_table`` stored, with its bucketing known to the planner.

    The table is named in the catalog only while its plan is made.
    """
    count = spark.read.parquet(f"{path}/{BUCKETING}").first()["buckets"]
    columns = spark.read.parquet(path)._jdf.schema().toDDL()
    name = f"tidemark_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}' "
        f"CLUSTERED BY ({CUSTOMER}) SORTED BY ({CUSTOMER}, {PURCHASED}) INTO {count} BUCKETS"
    )
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # its files stay, because it was given a path


def read_requests(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Scoring requests, one per row, each with a ``request_id`` of its own.

    A field that does not fit its type is NULL, which the validation of requests then reports by name.
    """
    return spark.read.schema(REQUEST_SCHEMA).format(fmt).load(path)
