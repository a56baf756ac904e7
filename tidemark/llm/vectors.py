"""Vectors that may take part in a search, and blocks of them for pairwise work."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(rows: DataFrame, id_col: str, vector_col: str, zero: bool) -> DataFrame:
    """``id`` and ``vec`` (array<double>) of the vectors without null, NaN or infinite components.

    Rows without an id and empty vectors are left out; so are zero vectors unless ``zero``. Of rows that repeat an id
    the smallest vector counts.
    """
    vec = F.col(vector_col).cast("array<double>")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = rows.select(F.col(id_col).alias("id"), vec.alias("vec"))
    kept = kept.filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0) & finite)
    if not zero:
        kept = kept.filter(F.exists("vec", lambda x: x != 0))
    return kept.groupBy("id").agg(F.min("vec").alias("vec"))


def matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, equal ones by smaller id."""
    return np.lexsort((ids, -scores))[:k]
