"""Periodic runs of words in documents."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runs import periodic_stretches

WORD = r"[^\x20\x09-\x0D]+"
LEAST, TIMES = 6, 4
# Words of several documents that are sorted together; a longer document is sorted by itself.
_AT_ONCE = 1 << 17


def with_repeats(documents: DataFrame) -> DataFrame:
    """doc_id and text, with periodic ends planted in every tenth document by the digest of its doc_id.

    With h = crc32 of the decimal doc_id, g = h div 10 and n words: where h mod 10 is 0, words from a = g mod n on repeat
    the p = 1 + (n - a) div (3 + g mod 8) words from there, and words are joined by one space. Other texts, texts without
    words, and rows without a doc_id stay as they are.
    """
    marked = documents.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("_h"))
    marked = marked.withColumn("_w", F.when(F.col("_h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
    sized = marked.withColumn("_n", F.size("_w").cast("long")).withColumn("_g", F.expr("_h div 10"))
    sized = sized.withColumn("_a", F.when(F.col("_n") > 0, F.expr("_g % _n")))
    sized = sized.withColumn("_p", F.expr("1 + (_n - _a) div (3 + _g % 8)"))
    repeated = F.expr("array_join(transform(_w, (w, i) -> if(i < _a, w, _w[int(_a + (i - _a) % _p)])), ' ')")
    return sized.select("doc_id", F.when(F.col("_a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def _found_in(texts: list[list[bytes]], least: int, times: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Number of runs of each text, and start, length and period of all of them."""
    every = list(chain.from_iterable(texts))
    known = {word: i for i, word in enumerate(set(every))}
    symbols = np.fromiter(map(known.__getitem__, every), np.int64, len(every))
    starts = np.concatenate([[0], np.cumsum([len(words) for words in texts])]).astype(np.int64)
    sequence, *runs = periodic_stretches(symbols, starts, least, times)
    return np.bincount(sequence, minlength=len(texts)), runs


def _collapsed(words: list[bytes], starts: np.ndarray, lengths: np.ndarray, periods: np.ndarray) -> bytes:
    """The words that no run repeats, joined by one space."""
    if not len(starts):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts + periods, 1)
    np.add.at(change, starts + lengths, -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[i] for i in kept])


def _groups(texts: pa.Array) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(row of the first text, words of texts) until about ``_AT_ONCE`` words are together."""
    first, held, size = 0, [], 0
    for row, text in enumerate(texts):
        words = (text.as_py() or "").encode().split()
        if held and size + len(words) > _AT_ONCE:
            yield first, held
            first, held, size = row, [], 0
        held.append(words)
        size += len(words)
    if held:
        yield first, held


def periodic_runs(documents: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, ``runs`` (array of start, length, period) and ``collapsed`` text of every row (doc_id, text).

    A run is a stretch of consecutive words with smallest period q (words q apart are identical) of at least ``least`` words
    and ``times`` (4 or more) periods that cannot be extended. Runs stand by start, then period. ``collapsed`` are the words
    outside the repeated parts (a run's words after its first q), joined by one space. Words are runs of bytes other than
    white space, compared as they are.

    Rows are independent: nothing is shuffled, and whole texts are searched. Null, empty and blank texts have no runs and
    collapse to an empty text; rows without a doc_id and repeated rows are answered each. Memory grows with the longest
    text: about 4 bytes a word for each doubling of its longest repeated factor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _groups(batch.column("text")):
                counts, runs = _found_in(texts, least, times)
                edges = np.concatenate([[0], np.cumsum(counts)])
                lists = pa.ListArray.from_arrays(
                    edges.astype(np.int32), pa.StructArray.from_arrays([pa.array(x) for x in runs], names=["start", "length", "period"])
                )
                left = [
                    _collapsed(words, *(x[a:b] for x in runs)).decode()
                    for words, a, b in zip(texts, edges[:-1], edges[1:], strict=True)
                ]
                columns = [batch.column("doc_id").slice(first, len(texts)), lists, pa.array(left, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "runs", "collapsed"])

    narrow = documents.select("doc_id", "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def run_report(documents: DataFrame) -> DataFrame:
    """n_runs, the longest run (ties: smallest start, then period) and digests of all runs and of the collapsed text."""
    found = periodic_runs(with_repeats(documents))
    told = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    ordered = F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    longest = F.array_min(ordered)
    length = -longest["l"]
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        longest["s"].alias("start"),
        length.alias("length"),
        longest["p"].alias("period"),
        F.floor(length * 1000 / longest["p"]).alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(told, lambda line: F.concat(line, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
