"""Exact top-k search by no-random-access aggregation over sorted lists."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durable import durable
from tidemark.llm.vectors import matrix, usable

# Whole numbers below this are exact as doubles.
_EXACT = float(1 << 53)


def scan_lists(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, values: np.ndarray, k: int, rounds: int = 4
) -> pd.DataFrame:
    """The ``k`` highest inner products of every query among the rows of one block.

    Every dimension is a list of the rows sorted by value, read from its top for a positive weight and from its bottom
    for a negative one. A round reads the next stretch of all lists and adds what was read to the rows' known parts.
    A row's upper bound takes the last value read for each unread dimension, its lower bound the list's worst value.
    A query stops when at most ``4 k`` rows can still reach the ``k``-th highest lower bound (or its lists are read);
    these are resolved to their full scores. Values are whole numbers, so all sums are exact.
    """
    rows, width = values.shape
    order = np.argsort(values, axis=0, kind="stable")
    depth = np.empty_like(order)
    np.put_along_axis(depth, order, np.arange(rows)[:, None], axis=0)
    ordered = np.take_along_axis(values, order, axis=0)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    own = query_ids[:, None] == ids[None, :]
    known = np.zeros((len(query_ids), rows))
    left = np.arange(len(query_ids))
    step = max(1, -(-rows // rounds))
    found = []
    for start in range(0, rows, step):
        end = min(rows, start + step)
        for j in range(width):
            weights = queries[left, j]
            for reading, places in ((weights > 0, order[rows - end : rows - start, j]), (weights < 0, order[start:end, j])):
                if reading.any():
                    known[np.ix_(left[reading], places)] += weights[reading, None] * values[places, j]
        unread_top, unread_bottom = (depth < rows - end).T.astype(float), (depth >= end).T.astype(float)
        top, bottom = ordered[rows - end], ordered[end - 1]
        part = known[left]
        upper = part + (up[left] * top) @ unread_top + (down[left] * bottom) @ unread_bottom
        lower = part + (up[left] * ordered[0]) @ unread_top + (down[left] * ordered[-1]) @ unread_bottom
        upper[own[left]] = -np.inf
        lower[own[left]] = -np.inf
        if rows > k:
            least = np.partition(lower, rows - k, axis=1)[:, rows - k]
            able = upper >= least[:, None]
        else:
            able = np.isfinite(upper)
        able &= np.isfinite(upper)
        done = (able.sum(axis=1) <= 4 * k) | (end == rows)
        for place in np.flatnonzero(done):
            at = np.flatnonzero(able[place])
            scores = values[at] @ queries[left[place]]
            first = np.lexsort((ids[at], -scores))[:k]
            found.append(
                pd.DataFrame({"query_id": query_ids[left[place]], "vec_id": ids[at[first]], "score": scores[first]})
            )
        left = left[~done]
        if not len(left):
            break
    return pd.concat(found, ignore_index=True).astype({"query_id": "int64", "vec_id": "int64", "score": "int64"})


def top_scores(
    rows: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 1024,
    block: int = 2048,
    query_block: int = 128,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: exactly the ``k`` highest integer scores of each query.

    Components x become floor(scale * x). The rows are dealt into blocks of about ``block`` rows, the queries into
    blocks of about ``query_block``; every pair of blocks is one task's work (``scan_lists``) and returns ``k`` rows per
    query, which are ranked together. A block's own ``k`` best contain all of the overall best that lie in it.

    Equal scores go to the smaller id. Vectors that are null, empty or hold null or non-finite components, and rows
    without an id, take no part; zero vectors do. Rows that repeat an id count once (``usable``). Only vectors of one
    length are compared. Queries with fewer than ``k`` candidates return what there is. Scores are sums of integers in
    doubles; vectors so long that a sum could reach 2^53, where doubles stop being exact, are an error.
    """
    chosen = rows.withColumn("_asks", is_query).select(id_col, vector_col, "_asks")
    whole = F.transform("vec", lambda x: F.floor(x * scale).cast("double"))
    kept = usable(chosen, id_col, vector_col, zero=True).select("id", whole.alias("vec"))
    kept = durable(kept.withColumn("width", F.size("vec")))
    asking = chosen.filter(F.col("_asks")).select(F.col(id_col).alias("id")).distinct()
    asked = durable(kept.join(asking, "id", "left_semi"))
    parallel = rows.sparkSession.sparkContext.defaultParallelism
    row_blocks = max(-(-kept.count() // block), parallel)
    query_blocks = max(1, -(-asked.count() // (query_block * 8)))

    def dealt(side: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        return side.select(
            "width",
            F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other),
            "id",
            "vec",
        )

    def score(queries: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(values):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids, table = values["id"].to_numpy(), matrix(values["vec"])
        names, asks = queries["id"].to_numpy(), matrix(queries["vec"])
        # No sum of products exceeds the product of the lengths, so below this all sums are exact integers.
        if np.linalg.norm(table, axis=1).max() * np.linalg.norm(asks, axis=1).max() >= _EXACT:
            raise ValueError("components are too large for exact scores")
        parts = range(0, len(names), query_block)
        return pd.concat(
            [scan_lists(names[p : p + query_block], asks[p : p + query_block], ids, table, k) for p in parts]
        )

    keys = ["width", "row_block", "query_block"]
    values = dealt(kept, "row_block", row_blocks, "query_block", query_blocks).groupBy(*keys)
    queries = dealt(asked, "query_block", query_blocks, "row_block", row_blocks).groupBy(*keys)
    found = queries.cogroup(values).applyInPandas(score, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
