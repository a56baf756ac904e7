"""Proportional stratified interleaving: shards that all hold the same mixture of sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.durable import durable
from tidemark.operators.ordering import global_running


def interleave(rows: DataFrame, strata: Column, tie_order: list[str], shards: int, seed: int = 17) -> DataFrame:
    """``rows`` with ``shard`` (from 0) and ``slot`` (from 0, gapless in the shard).

    Every stratum is shuffled by a seeded hash of ``tie_order`` and its rows get the fractional ranks (i + 1/2) / n.
    Sorting all rows by fractional rank spreads every stratum evenly over the whole order, which is cut into
    ``shards`` runs whose lengths differ by at most one. Both sorts are range-partitioned, so a stratum with most of
    the rows is spread over many tasks. A null stratum is a stratum of its own. Rows that agree in the stratum and in
    ``tie_order`` are interchangeable; an empty table stays empty. ``rows`` should be narrow: it is sorted twice.
    """
    stratum = strata.alias("_stratum")
    keyed = rows.select("*", stratum, F.xxhash64(F.lit(seed), *tie_order).alias("_shuffle"))
    ranked = global_running(keyed, [F.asc_nulls_first("_stratum"), "_shuffle", *tie_order]).drop("total_rows")
    ranked = durable(ranked)
    sizes = durable(
        ranked.groupBy(F.col("_stratum").alias("_of")).agg(
            F.min("position").alias("_first"), F.count(F.lit(1)).alias("_n")
        )
    )
    placed = ranked.join(sizes, F.col("_stratum").eqNullSafe(F.col("_of")))
    rank = F.col("position") - F.col("_first")
    placed = placed.select(
        *rows.columns, ((2 * rank + 1) / (2 * F.col("_n"))).alias("_share"), F.col("position").alias("_tie")
    )
    mixed = global_running(placed, ["_share", "_tie"])
    shard = F.expr(f"(position * {shards}) div total_rows")
    first = F.expr(f"((_shard * total_rows) + {shards - 1}) div {shards}")
    return mixed.withColumn("_shard", shard).select(
        *rows.columns, F.col("_shard").cast("int").alias("shard"), (F.col("position") - first).alias("slot")
    )


def shard_documents(documents: DataFrame, shards: int = 40, seed: int = 17) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and source of every document.

    Law ``rows``: shard counts differ by at most one, and each shard has the mixture of sources of the whole. A null
    text has no bytes (size 16) and the checksum of the empty text. Repeated rows each get a slot of their own; null
    ids and sources are ordinary values. Other columns are not looked at.
    """
    content = F.coalesce(F.col("text"), F.lit(""))
    narrow = documents.select(
        "doc_id",
        (F.octet_length(content) + 16).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        "source",
    )
    dealt = interleave(durable(narrow), F.col("source"), ["doc_id", "text_crc32", "size"], shards, seed)
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )
