"""Whitening of embeddings with an exact integer covariance and its exact characteristic polynomial."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.durable import drop_folder, shared_folder
from tidemark.llm.charpoly import characteristic_polynomial, largest_roots, null_vectors

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
# Scaled entries are exact integers as doubles below this.
_LARGEST = float(1 << 52)
_EXACT = 1 << 53


@dataclass(frozen=True)
class Whitening:
    """The fit: number of distinct vectors, sums per dimension, and per component its vector and eigenvalue.

    ``shares`` are the eigenvalues over the trace of the covariance.
    """

    n: int
    sums: list[int]
    vectors: list[list[float]]
    eigenvalues: list[float]
    shares: list[float]


def whole_entries(vector: Column) -> Column:
    """The vector's entries as doubles, scaled, rounded down and offset; an entry too large for that is an error."""
    fits = lambda c: F.abs(c * SCALE) < F.lit(_LARGEST)
    scaled = lambda c: F.floor(c * SCALE) + F.lit(OFFSET)
    too_large = F.raise_error(F.lit("an entry is too large to whiten exactly")).cast("long")
    return F.transform(vector.cast("array<double>"), lambda c: F.when(fits(c), scaled(c)).otherwise(too_large))


def whole_vectors(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``x`` of every row whose vector is not null or empty and has only finite entries."""
    finite = F.forall(vector_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    kept = embeddings.filter(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & finite)
    return kept.select(F.col(id_col).alias("id"), whole_entries(F.col(vector_col)).alias("x"))


def _rows_of(column: pa.Array) -> np.ndarray:
    """The vectors of a batch, less the offset; all must have one length."""
    sizes = set(column.value_lengths().to_pylist())
    if len(sizes) > 1:
        raise ValueError("the vectors differ in length")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) - OFFSET


def _products(rows: np.ndarray) -> np.ndarray:
    """rows' * rows as exact Python integers, whatever their size."""
    most = int(np.abs(rows).max(initial=0))
    if most * most * len(rows) < _EXACT:
        exact = rows.astype(np.float64)
        return (exact.T @ exact).astype(np.int64).astype(object)
    if len(rows) > 1 and most * most < _EXACT:
        half = len(rows) // 2
        return _products(rows[:half]) + _products(rows[half:])
    whole = rows.astype(object)
    return whole.T @ whole


def moments(fit: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """Rows, sums per dimension and sums of products of the vectors less the offset, exactly.

    Each task leaves one row per entry of the upper triangle, which Spark adds up as decimals; dimension squared over two
    numbers reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, square = 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _rows_of(batch.column("x"))
            if total is not None and len(total) != rows.shape[1]:
                raise ValueError("the vectors differ in length")
            sums, products = rows.astype(object).sum(axis=0), _products(rows)
            count += len(rows)
            total, square = (sums, products) if total is None else (total + sums, square + products)
        if count:
            size = len(total)
            upper = [int(square[i, j]) for i in range(size) for j in range(i, size)]
            values = [count, size * count, *map(int, total), *upper]
            places = list(range(-2, len(values) - 2))
            columns = [pa.array(places, pa.int32()), pa.array(values, pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "value"])

    summed = fit.select("x").mapInArrow(run, "place int, value decimal(38,0)").groupBy("place").agg(F.sum("value").alias("value"))
    found = {r["place"]: int(r["value"]) for r in summed.collect()}
    if not found:
        return 0, [], []
    n, size = found[-2], found[-1] // found[-2]
    if len(found) != 2 + size + size * (size + 1) // 2:
        raise ValueError("the vectors differ in length")
    sums, place = [found[i] for i in range(size)], size
    square = [[0] * size for _ in range(size)]
    for i in range(size):
        for j in range(i, size):
            square[i][j] = square[j][i] = found[place]
            place += 1
    return n, sums, square


def components_of(spark: SparkSession, scatter: list[list[int]], wanted: int) -> list[tuple[Fraction, list[float]]]:
    """(eigenvalue, unit eigenvector) of the ``wanted`` largest positive eigenvalues, falling, counted with multiplicity."""
    roots = largest_roots(characteristic_polynomial(spark, scatter), wanted)
    if not roots:
        return []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vectors = [(i, v) for i in batch["place"] for v in null_vectors(scatter, roots[i], int(i))]
            yield pd.DataFrame(vectors, columns=["place", "vector"])

    tasks = spark.createDataFrame([(i,) for i in range(len(roots))], "place int").repartition(len(roots))
    rows = tasks.mapInPandas(run, "place int, vector array<double>").collect()
    rows.sort(key=lambda r: r["place"])
    return [(roots[r["place"]].value, list(r["vector"])) for r in rows][:wanted]


def fit_whitening(fit: DataFrame, wanted: int = COMPONENTS) -> Whitening:
    """Components of the distinct vectors ``x`` of ``fit``.

    n times the centred sum of products is a matrix of integers, n^2 times the covariance. A component whose eigenvalue
    is 0 cannot be scaled to variance 1 and is left out.
    """
    n, sums, square = moments(fit)
    if not n:
        return Whitening(0, [], [], [], [])
    scatter = [[n * x - sums[i] * sums[j] for j, x in enumerate(row)] for i, row in enumerate(square)]
    trace = sum(scatter[i][i] for i in range(len(scatter)))
    found = components_of(fit.sparkSession, scatter, wanted)
    return Whitening(
        n=n,
        sums=[s + OFFSET * n for s in sums],
        vectors=[v for _, v in found],
        eigenvalues=[float(e / (n * n)) for e, _ in found],
        shares=[float(e / trace) for e, _ in found],
    )


def _projected(rows: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """Whitened rows, and the sum of (n * x - S)^2 of each as Python integers. ``rows`` are less the offset."""
    n, sums = model.n, [s - OFFSET * model.n for s in model.sums]
    most = n * int(np.abs(rows).max(initial=0)) + max(map(abs, sums))
    kind = np.int64 if most < 1 << 62 else object
    centred = rows.astype(kind) * n - np.array(sums, kind)
    exact = centred if most * most * len(sums) < 1 << 62 else centred.astype(object)
    # centred is n times the distance from the mean
    scale = np.array([1 / (n * e**0.5) for e in model.eigenvalues])
    return centred.astype(np.float64) @ (np.array(model.vectors).T.reshape(len(sums), -1) * scale), (exact * exact).sum(axis=1)


def whitened(vectors: DataFrame, model: Whitening) -> DataFrame:
    """id, deviation decimal(38,0) and whitened array<double> of every row of ``vectors`` (id, x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            white, far = _projected(_rows_of(batch.column("x")), model)
            lists = pa.ListArray.from_arrays(np.arange(len(white) + 1, dtype=np.int32) * white.shape[1], white.reshape(-1))
            columns = [batch.column("id"), pa.array([int(x) for x in far], pa.decimal128(38, 0)), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "deviation", "whitened"])

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"id {kind}, deviation decimal(38,0), whitened array<double>")


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of (covariance of the whitened fit list) minus the identity.

    Whitened rows are centred already; what is left of their mean is taken out as well.
    """
    size = len(model.vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + size * size)
        for batch in batches:
            if batch.num_rows:
                white, _ = _projected(_rows_of(batch.column("x")), model)
                total += np.concatenate([white.sum(axis=0), (white.T @ white).reshape(-1)])
        columns = [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)]
        yield pa.RecordBatch.from_arrays(columns, names=["place", "value"])

    summed = fit.select("x").mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    found = {r["place"]: r["value"] / model.n for r in summed.collect()}
    mean = np.array([found[i] for i in range(size)])
    square = np.array([found[size + i] for i in range(size * size)]).reshape(size, size)
    return float(np.abs(square - np.outer(mean, mean) - np.eye(size)).max())


def whiten(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", wanted: int = COMPONENTS
) -> tuple[DataFrame, Whitening, float | None]:
    """(id, deviation, whitened of every usable row; the fit; the identity error, null without components).

    The fit list is each distinct vector of integers once. Rows whose vector is null, empty or holds null or non-finite
    entries take no part. Repeated rows and rows without an id are answered each. Vectors of different lengths, or an
    entry of 2^46 and more, are an error. If fewer than ``wanted`` eigenvalues are positive, there are fewer components;
    without any (one distinct vector, or none) the lists are empty.
    """
    spark = embeddings.sparkSession
    vectors = whole_vectors(embeddings, id_col, vector_col)
    path = shared_folder(spark, "fit")
    vectors.select("x").distinct().write.mode("overwrite").parquet(path)
    fit = spark.read.parquet(path)
    model = fit_whitening(fit, wanted)
    error = identity_error(fit, model) if model.vectors else None
    drop_folder(spark, path)
    if not model.vectors:
        empty = F.array().cast("array<double>").alias("whitened")
        return vectors.select("id", F.lit(0).cast("decimal(38,0)").alias("deviation"), empty), model, None
    return whitened(vectors, model), model, error


def whitening_report(embeddings: DataFrame) -> DataFrame:
    """A row for each usable row and component, numbered from 1 by falling eigenvalue."""
    rows, model, error = whiten(embeddings)
    shares = F.array(*[F.lit(s) for s in model.shares]).cast("array<double>")
    told = rows.select("id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return told.select(
        F.col("id").alias("vec_id"),
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").cast("long").alias("deviation"),
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
