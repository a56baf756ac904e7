"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables and exact reranking."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durable import durable
from tidemark.llm.vectors import best, matrix, usable

_FOUND = "query_id long, vec_id long, score double"


def rotate(vectors: np.ndarray, seed: int, table: int) -> np.ndarray:
    """Pseudo-rotation: three rounds of random signs and a fast Hadamard transform, padded to a power of two."""
    width = 1 << max(0, vectors.shape[1] - 1).bit_length()
    turned = np.zeros((len(vectors), width))
    turned[:, : vectors.shape[1]] = vectors
    signs = np.random.default_rng([seed, table, width]).choice([-1.0, 1.0], (3, width))
    for flip in signs:
        turned *= flip
        half = 1
        while half < width:
            pairs = turned.reshape(len(turned), -1, 2, half)
            turned = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
            turned = turned.reshape(len(vectors), width)
            half *= 2
        turned /= np.sqrt(width)
    return turned


def axes(vectors: np.ndarray, seed: int, table: int) -> np.ndarray:
    """Closeness of each vector to each signed axis: columns i and i + width are axis i and its opposite."""
    turned = rotate(vectors, seed, table)
    return np.concatenate([turned, -turned], axis=1)


def exact_scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of equal rows, summed component by component, so equal vectors always score the same."""
    total = np.zeros(len(left))
    for j in range(left.shape[1]):
        total += left[:, j] * right[:, j]
    return total


def nearest_in_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, at_once: int = 256
) -> pd.DataFrame:
    """The ``k`` best of the block for each query, its own id left out, by exact score."""
    found = []
    longest = np.sqrt((vectors**2).sum(axis=1).max())
    for start in range(0, len(query_ids), at_once):
        names, part = query_ids[start : start + at_once], queries[start : start + at_once]
        rough = part @ vectors.T
        rough[names[:, None] == ids[None, :]] = -np.inf
        if len(ids) > k:
            margin = 1e-12 * longest * np.sqrt((part**2).sum(axis=1)) * part.shape[1]
            least = np.partition(rough, len(ids) - k, axis=1)[:, len(ids) - k] - margin
        else:
            least = np.full(len(part), -np.finfo(float).max)
        rows, places = np.nonzero((rough >= least[:, None]) & np.isfinite(rough))
        scores = exact_scores(part[rows], vectors[places])
        order = np.lexsort((ids[places], -scores, rows))
        rows, places, scores = rows[order], places[order], scores[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = rank < k
        found.append(
            pd.DataFrame({"query_id": names[rows[kept]], "vec_id": ids[places[kept]], "score": scores[kept]})
        )
    return pd.concat(found, ignore_index=True)


def _hashed(rows: DataFrame, tables: int, seed: int) -> DataFrame:
    """``rows`` (id, vec) with ``buckets``: the nearest signed axis in each table."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby(batch["vec"].map(len)):
                vectors = matrix(part["vec"])
                held = np.stack([axes(vectors, seed, t).argmax(axis=1) for t in range(tables)], axis=1)
                yield part.assign(buckets=list(held.astype(np.int32)))

    return rows.mapInPandas(assign, "id long, vec array<double>, buckets array<int>")


def probes_needed(
    hashed: DataFrame, queries: DataFrame, k: int, tables: int, seed: int, sample: int, recall: float
) -> int:
    """How many axes a query must probe per table so that the wanted share of true neighbours is met.

    At most ``sample`` queries (those of smallest hash) are compared with every row. For each of their true ``k``
    nearest the best rank of its axis among the query's axes, over all tables, is known; the answer is the quantile
    ``recall`` of these ranks. Only sample * k ranks reach the driver.
    """
    chosen = queries.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(sample).collect()
    if not chosen:
        return 1
    by_length: dict[int, list] = {}
    for row in chosen:
        by_length.setdefault(len(row["vec"]), []).append(row)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for length, part in batch.groupby(batch["vec"].map(len)):
                if length not in by_length:
                    continue
                own = by_length[length]
                names, asked = np.array([r["id"] for r in own]), np.array([r["vec"] for r in own])
                ids, vectors = part["id"].to_numpy(), matrix(part["vec"])
                held = np.array(part["buckets"].tolist())
                found = nearest_in_block(names, asked, ids, vectors, k)
                if not len(found):
                    continue
                at = pd.Series(np.arange(len(ids)), index=ids)[found["vec_id"]].to_numpy()
                of = pd.Series(np.arange(len(names)), index=names)[found["query_id"]].to_numpy()
                ranks = np.full(len(found), np.iinfo(np.int32).max)
                for t in range(tables):
                    near = axes(asked, seed, t)
                    mine = near[of, held[at, t]]
                    ranks = np.minimum(ranks, (near[of] > mine[:, None]).sum(axis=1))
                yield found.assign(rank=ranks)

    compared = hashed.mapInPandas(compare, _FOUND + ", rank long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    true = compared.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k)
    ranks = sorted(row["rank"] for row in true.select("rank").collect())
    return ranks[min(len(ranks) - 1, int(recall * len(ranks)))] + 1 if ranks else 1


def nearest(
    rows: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    tables: int = 8,
    recall: float = 0.97,
    sample: int = 64,
    block: int = 2048,
    seed: int = 11,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the nearest rows found for each query, by inner product.

    Every row is put under the signed axis nearest to it in each of ``tables`` pseudo-rotations. A query looks under
    the axes nearest to it; how many is set by ``probes_needed``. All rows under a probed axis are scored in double
    precision. An axis with more than ``block`` rows or queries is split into blocks, so no task holds more, however many
    rows share one axis; each block returns its ``k`` best per query, and ranks are taken over all blocks.

    Equal scores go to the smaller id. Vectors that are null, empty, zero or hold null or non-finite components, and
    rows without an id, take no part; rows that repeat an id count once (``usable``). Only vectors of one length are
    compared. Queries with fewer than ``k`` candidates return what there is; an empty table returns nothing.
    """
    chosen = rows.withColumn("_asks", is_query).select(id_col, vector_col, "_asks")
    hashed = durable(_hashed(usable(chosen, id_col, vector_col, zero=False), tables, seed))
    asking = chosen.filter(F.col("_asks")).select(F.col(id_col).alias("id")).distinct()
    queries = durable(hashed.join(asking, "id", "left_semi").select("id", "vec"))
    probes = probes_needed(hashed, queries, k, tables, seed, sample, recall)

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby(batch["vec"].map(len)):
                vectors = matrix(part["vec"])
                for t in range(tables):
                    near = np.argsort(-axes(vectors, seed, t), axis=1)[:, :probes]
                    yield part.assign(table=t, bucket=list(near.astype(np.int32)))

    place = ["width", "table", "bucket"]
    width = F.size("vec").alias("width")
    kept = hashed.select("id", "vec", width, F.posexplode("buckets").alias("table", "bucket"))
    asked = queries.mapInPandas(probe, "id long, vec array<double>, table int, bucket array<int>")
    asked = asked.select("id", "vec", width, "table", F.explode("bucket").alias("bucket"))
    # One row per table and axis: bounded by the parameters.
    sizes = kept.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / block).alias("_row_blocks"))
    asks = asked.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / block).alias("_query_blocks"))
    blocks = F.broadcast(durable(sizes.join(asks, place)))

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        return side.join(blocks, place).select(
            *place,
            F.pmod(F.xxhash64("id"), F.col(f"_{own}_blocks")).alias(f"{own}_block"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"_{other}_blocks") - 1)).alias(f"{other}_block"),
            "id",
            "vec",
        )

    keys = [*place, "row_block", "query_block"]

    def score(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(candidates):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return nearest_in_block(
            queries["id"].to_numpy(),
            matrix(queries["vec"]),
            candidates["id"].to_numpy(),
            matrix(candidates["vec"]),
            k,
        )

    candidates = dealt(kept, "row", "query").groupBy(*keys)
    found = dealt(asked, "query", "row").groupBy(*keys).cogroup(candidates).applyInPandas(score, _FOUND)
    # The same pair may come from several tables with the same score: dense ranks count it once.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.dense_rank().over(order)).filter(F.col("rank") <= k)
    return ranked.distinct().select("query_id", "rank", "vec_id", "score")
