"""Language identification with language-bitmask n-gram filters (bit-sliced Bloom filters)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.flat import flat, mixed

UNKNOWN = "und"
_WINDOW = 1 << 20
# Languages in one word of the filter
_BITS = 63
# Bytes that are no letters become spaces; bytes above 127 belong to letters of other alphabets or to other signs.
_FOLD = np.array([b if b > 127 or chr(b).isalpha() else 32 for b in range(256)], np.uint8)


@dataclass
class LanguageFilter:
    """``words[h]`` holds one bit per language: set if some n-gram of the language hashes to ``h``.

    One look-up at each of the n-gram's ``probes`` places, ANDed, gives the set of all languages that hold it. Language i
    has bit i % ``_BITS`` of column i // ``_BITS``: there are as many columns as the languages need.
    """

    languages: list[str]
    words: np.ndarray
    orders: tuple[int, ...]
    probes: int

    def __post_init__(self) -> None:
        self.false_positive = np.array([self.bit(self.words, i).mean() for i in range(len(self.languages))]) ** self.probes

    def bit(self, found: np.ndarray, language: int) -> np.ndarray:
        """Whether each row of words has the bit of a language."""
        kind = self.words.dtype.type
        return found[:, language // _BITS] >> kind(language % _BITS) & kind(1)


def ngrams(data: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` bytes from each place on; lower-cased text is expected."""
    size = max(0, len(data) - order + 1)
    packed = np.zeros(size, np.uint64)
    for i in range(order):
        packed = packed << np.uint64(8) | _FOLD[data[i : i + size]]
    return mixed(packed + np.uint64(order << 56))


def places(hashes: np.ndarray, probes: int, slots: int) -> list[np.ndarray]:
    return [(hashes >> np.uint64(24 * i) & np.uint64(slots - 1)).astype(np.int64) for i in range(probes)]


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents by their ids; a null id counts as the empty text, which is not held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def smallest_hashes(ids: DataFrame, per_language: int, seed: int) -> DataFrame | None:
    """The ``per_language`` rows (doc_id, lang) of smallest hash of each language; None without rows.

    Hashes are spread evenly, so a limit a little above the wanted share of a language's rows leaves the smallest ones and
    few more, which are ranked. So no language is sorted as a whole. If a limit leaves too few after all, limits double.
    """
    sizes = {r["lang"]: r["n"] for r in ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    spread = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) / F.lit(float(1 << 53))
    wanted = 1.5 * per_language + 100
    while True:
        limits = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(2.0, wanted / n))])
        near = ids.withColumn("_h", spread).filter(F.col("_h") < F.element_at(limits, F.col("lang")))
        left = {r["lang"]: r["n"] for r in near.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
        if all(left.get(lang, 0) >= min(per_language, n) for lang, n in sizes.items()):
            break
        wanted *= 2
    order = Window.partitionBy("lang").orderBy("_h", "doc_id")
    return near.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per_language).select("doc_id", "lang")


def fit(
    labelled: DataFrame,
    per_language: int = 1500,
    orders: tuple[int, ...] = (3, 5),
    probes: int = 2,
    slots: int = 1 << 21,
    least_documents: int = 2,
    least_share: float = 0.2,
    seed: int = 5,
) -> LanguageFilter | None:
    """Learn from at most ``per_language`` rows (doc_id, text, lang) of each language: those of smallest hash.

    An n-gram belongs to a language if at least ``least_documents`` of its sampled documents hold it, and if its share
    of them is at least ``least_share`` of the share in any other language. The filter has ``slots`` entries whatever
    the sample, so what reaches the driver and is sent to the tasks is bounded. None if there is nothing to learn from.
    """
    ids = smallest_hashes(labelled.select("doc_id", "lang").distinct(), per_language, seed)
    if ids is None:
        return None
    sample = labelled.join(ids, ["doc_id", "lang"], "left_semi").select("lang", F.lower("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = flat(batch.column("text"))
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for lang in set(langs):
                own, found = np.flatnonzero(langs == lang), []
                for i in own:
                    text = data[starts[i] : starts[i + 1]]
                    found.append(np.unique(np.concatenate([ngrams(text, n) for n in orders])))
                    if sum(map(len, found)) > _WINDOW or i == own[-1]:
                        grams, n = np.unique(np.concatenate(found), return_counts=True)
                        found = []
                        yield pa.RecordBatch.from_pydict(
                            {"lang": pa.array([lang] * len(grams)), "gram": grams.view(np.int64), "n": n}
                        )

    held = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    sizes = {r["lang"]: r["n"] for r in sample.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return None
    size = F.element_at(F.create_map(*[F.lit(x) for lang in languages for x in (lang, sizes[lang])]), F.col("lang"))
    number = F.element_at(F.create_map(*[F.lit(x) for i, lang in enumerate(languages) for x in (lang, i)]), F.col("lang"))
    share = held.select("gram", "n", number.alias("number"), (F.col("n") / size).alias("share"))
    most = share.groupBy("gram").agg(
        F.max("share").alias("most"),
        *[
            F.max(F.when((F.col("number") == i) & (F.col("n") >= least_documents), F.col("share"))).alias(f"s{i}")
            for i in range(len(languages))
        ],
    )
    columns = -(-len(languages) // _BITS)
    masks = []
    for column in range(columns):
        here = range(column * _BITS, min((column + 1) * _BITS, len(languages)))
        bits = [F.when(F.col(f"s{i}") >= least_share * F.col("most"), F.lit(1 << i % _BITS)).otherwise(F.lit(0)) for i in here]
        masks.append(sum(bits, F.lit(0)).cast("long").alias(f"mask{column}"))
    names = [f"mask{column}" for column in range(columns)]
    owned = most.select("gram", *masks).filter(reduce(or_, [F.col(name) != 0 for name in names]))
    slot = [F.shiftrightunsigned("gram", 24 * i).bitwiseAND(F.lit(slots - 1)) for i in range(probes)]
    filled = owned.select(F.explode(F.array(*slot)).alias("slot"), *names).groupBy("slot")
    filled = filled.agg(*[F.bit_or(name).alias(name) for name in names])
    chunk = 1 << 13
    kind = np.uint8 if len(languages) <= 8 else np.uint64

    def dense(part: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros((chunk, columns), kind)
        out[part["slot"].to_numpy() % chunk] = part[names].to_numpy()
        return pd.DataFrame({"chunk": [part["slot"].iloc[0] // chunk], "words": [out.tobytes()]})

    words = np.zeros((slots, columns), kind)
    chunks = filled.groupBy((F.col("slot") / chunk).cast("long").alias("_chunk")).applyInPandas(dense, "chunk long, words binary")
    for row in chunks.collect():
        words[row["chunk"] * chunk : (row["chunk"] + 1) * chunk] = np.frombuffer(row["words"], kind).reshape(-1, columns)
    return LanguageFilter(languages, words, orders, probes)


def evidence(model: LanguageFilter, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: how many n-grams each language holds, and how many there are. Works in windows of fixed size."""
    hits = np.zeros((len(starts) - 1, len(model.languages)))
    total = np.zeros(len(starts) - 1)
    for order in model.orders:
        ends = np.maximum(starts[1:] - order + 1, starts[:-1])
        total += ends - starts[:-1]
        for a in range(0, len(data) - order + 1, _WINDOW):
            part = data[a : a + _WINDOW + order - 1]
            hashes = ngrams(part, order)
            found = None
            for at in places(hashes, model.probes, len(model.words)):
                found = model.words[at] if found is None else found & model.words[at]
            low, high = np.searchsorted(ends, a, "right"), np.searchsorted(starts[:-1], a + len(hashes), "left")
            first, last = np.clip(starts[low:high] - a, 0, len(hashes)), np.clip(ends[low:high] - a, 0, len(hashes))
            for i in range(len(model.languages)):
                upto = np.concatenate([[0], np.cumsum(model.bit(found, i), dtype=np.int64)])
                hits[low:high, i] += upto[last] - upto[first]
    return hits, total


def predict(documents: DataFrame, model: LanguageFilter | None) -> DataFrame:
    """``lang_pred`` and ``score`` added to ``documents`` (doc_id, text, any others except these names).

    Per language the number of the text's n-grams that it holds is corrected for the filter's false positives:
    (hits - n p) / (1 - p). The highest wins, the first in code point order of equals; the score is its share of the
    sum over all languages. A text without a letter, or without a text, is ``und`` with score 0. A letters-only text
    of too few bytes for any n-gram gets the first language with score 0.
    """
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return documents.select("*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in documents.columns if c != "text"]
    ready = documents.select(*kept, F.lower("text").alias("_text"), lettered.alias("_lettered"))
    schema = documents.select(*kept).schema.add("lang_pred", "string").add("score", "double")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array(model.languages, dtype=object)
        for batch in batches:
            hits, total = evidence(model, *flat(batch.column("_text")))
            wrong = model.false_positive
            right = np.maximum((hits - total[:, None] * wrong) / np.maximum(1 - wrong, 1e-9), 0)
            best, sums = right.argmax(axis=1), right.sum(axis=1)
            lettered = batch.column("_lettered").to_numpy(zero_copy_only=False).astype(bool)
            score = np.where(lettered & (sums > 0), right.max(axis=1) / np.maximum(sums, 1e-300), 0.0)
            lang = np.where(lettered, names[best], UNKNOWN)
            columns = [batch.column(c) for c in kept] + [pa.array(lang, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "lang_pred", "score"])

    return ready.mapInArrow(decide, schema)


def learn(documents: DataFrame) -> LanguageFilter | None:
    """The filter of the documents that are not held out and have a text and a language."""
    known = ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    return fit(documents.filter(known).select("doc_id", "text", "lang"))


def known_language(documents: DataFrame) -> DataFrame:
    """The documents, with all their columns, whose language is found; those that are ``und`` are left out."""
    whole = documents.select(F.struct("*").alias("row"), "text")
    return predict(whole, learn(documents)).filter(F.col("lang_pred") != UNKNOWN).select("row.*")


def identify(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; ids, sources and labels are no inputs of a prediction.

    Whole texts, row by row after the fit: no shuffle of texts. Null ids stay null; repeated rows are predicted each;
    an empty table gives an empty result.
    """
    rows = documents.select("doc_id", "text")
    predicted = predict(rows, learn(documents))
    return predicted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
