from tidemark.sources.commerce import commerce_tables
from tidemark.sources.readers import (
    CommerceTables,
    read_base_table,
    read_bucketed_base_table,
    read_csv_tables,
    read_parquet_tables,
    read_requests,
)
from tidemark.sources.sinks import write_base_table, write_bucketed_base_table

__all__ = [
    "CommerceTables",
    "commerce_tables",
    "read_base_table",
    "read_bucketed_base_table",
    "read_csv_tables",
    "read_parquet_tables",
    "read_requests",
    "write_base_table",
    "write_bucketed_base_table",
]
