"""Texts of an Arrow batch as one run of bytes, without a Python object for each."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each begins (one more entry for the end). Nulls are empty."""
    texts = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    every = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return every[starts[0] : starts[-1]], starts - starts[0]


def mixed(numbers: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number spread over all others (a fixed bijection)."""
    out = numbers.astype(np.uint64)
    out ^= out >> np.uint64(30)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(31))
