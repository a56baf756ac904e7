"""Lines repeated across documents: explode, hash, count distinct documents per hash, drop, reassemble by position."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durable import drop_folder, shared_folder

BLANK = b" \t\n\x0b\x0c\r"
_HASH = 16


def line_digests(text: str, min_chars: int) -> list[bytes | None]:
    """The 128-bit digest of each line's key; None for a key of fewer than ``min_chars`` code points.

    The key is the line without white space at its ends, A-Z lower-cased.
    """
    found: list[bytes | None] = []
    for line in text.encode().split(b"\n"):
        key = line.strip(BLANK).lower()
        long_enough = len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars)
        found.append(xxhash.xxh3_128_digest(key) if long_enough else None)
    return found


def _numbers(digests: list[bytes]) -> list[pa.Array]:
    halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    return [pa.array(halves[:, i]) for i in range(2)]


def line_keys(documents: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, h1, h2: a row for each distinct long enough line key of each row of ``documents``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests = [], []
            for text in batch.column("text"):
                keys = set(line_digests(text.as_py() or "", min_chars)) - {None}
                counts.append(len(keys))
                digests.extend(keys)
            ids = batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(counts)), counts)))
            yield pa.RecordBatch.from_arrays([ids, *_numbers(digests)], names=["doc_id", "h1", "h2"])

    narrow = documents.filter("doc_id IS NOT NULL").select("doc_id", "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, h1 long, h2 long")


def drop_repeated_lines(documents: DataFrame, min_documents: int = 2, min_chars: int = 10) -> DataFrame:
    """doc_id, n_lines, n_dropped and the ``text`` that is left of every row of ``documents`` (doc_id, text).

    Lines whose key has at least ``min_chars`` code points and is found in at least ``min_documents`` distinct documents
    are dropped everywhere but in the smallest doc_id that holds it. Only hashes are exploded and counted: a crowded line
    is one row a document, counted with partial aggregation, and where it meets its count both sides are stored tables,
    so adaptive execution can split it. Texts move once, to the dropped hashes of their document.

    A null or empty text is one empty line. Rows that repeat a doc_id are one document, each answered on its own. Rows
    without a doc_id are no document: their lines are not counted, and all stay. An empty table gives an empty result.
    """
    spark = documents.sparkSession
    documents = documents.select("doc_id", "text")
    pairs_at, dropped_at = shared_folder(spark, "lines"), shared_folder(spark, "repeated")
    line_keys(documents, min_chars).write.mode("overwrite").parquet(pairs_at)
    pairs = spark.read.parquet(pairs_at)
    counts = pairs.groupBy("h1", "h2").agg(F.count_distinct("doc_id").alias("_n"), F.min("doc_id").alias("_first"))
    counts.filter(F.col("_n") >= min_documents).select("h1", "h2", "_first").write.mode("overwrite").parquet(dropped_at)
    # Sort-merge at every size: the plan, and what it moves, must not change with the input.
    repeated = spark.read.parquet(dropped_at).hint("merge")
    surplus = pairs.join(repeated, ["h1", "h2"]).filter(F.col("doc_id") != F.col("_first"))
    lists_at = shared_folder(spark, "dropped")
    surplus.select("doc_id", "h1", "h2").write.mode("overwrite").parquet(lists_at)
    for path in (pairs_at, dropped_at):
        drop_folder(spark, path)
    lists = spark.read.parquet(lists_at).groupBy("doc_id")
    lists = lists.agg(F.collect_list("h1").alias("_h1"), F.collect_list("h2").alias("_h2"))
    joined = documents.join(lists.hint("shuffle_hash"), "doc_id", "left")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, drops, texts = [], [], []
            for value, h1, h2 in zip(*(batch.column(c) for c in ("text", "_h1", "_h2")), strict=True):
                text = value.as_py() or ""
                lines = text.split("\n")
                kept = lines
                if h1.is_valid:
                    both = np.stack([x.values.to_numpy() for x in (h1, h2)], axis=1).astype(np.int64)
                    gone = {row.tobytes() for row in both}
                    kept = [line for line, key in zip(lines, line_digests(text, min_chars), strict=True) if key not in gone]
                totals.append(len(lines))
                drops.append(len(lines) - len(kept))
                texts.append("\n".join(kept))
            columns = [batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(drops, pa.int64()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_lines", "n_dropped", "text"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(rebuild, f"doc_id {kind}, n_lines long, n_dropped long, text string")


def line_report(documents: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of every row, as ``drop_repeated_lines`` leaves it."""
    left = drop_repeated_lines(documents)
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
