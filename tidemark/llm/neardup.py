"""MinHash near-duplicates by a multi-index Hamming join, with links confirmed on full shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durable import durable
from tidemark.llm.flat import flat, mixed
from tidemark.llm.graph import components
from tidemark.llm.shingles import shingle_sets

WORDS = 5
# Similarity of 75 of 100 links two documents.
PART, OF = 75, 100
# A signature has CHUNKS * CHUNK symbols of 16 bits, all indexed.
CHUNKS, CHUNK, ERRORS = 12, 5, 1
SYMBOLS = CHUNKS * CHUNK
# Documents that share a key also get a sketch of SKETCH symbols of 8 bits. Pairs whose sketches differ in more than
# MOST_DIFFERENT symbols, or in more than FIRST_DIFFERENT of the first FIRST, are not compared on their sets. At
# similarity 0.75 a symbol differs with probability 0.249: 255 of 1024 and 63.7 of 256 on average, and these limits are
# 4.5 and 5.1 standard deviations more (chances of 4e-6 and 2e-7).
SKETCH, MOST_DIFFERENT, FIRST, FIRST_DIFFERENT = 1024, 317, 256, 99
# Keys that a document must share with the smallest of their documents to be compared in the first round
STAR_KEYS = 3
_BLOCK = 1024

_RANDOM = np.random.default_rng(7)
_TIMES = _RANDOM.integers(0, 1 << 31, SYMBOLS + SKETCH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _RANDOM.integers(0, 1 << 32, SYMBOLS + SKETCH, dtype=np.uint32)


def smallest(shingles: np.ndarray, first: int, last: int) -> np.ndarray:
    """Mixed smallest value of the shingles' hashes under the permutations numbered from ``first`` to ``last``."""
    low = np.full(last - first, np.iinfo(np.uint32).max, np.uint32)
    hashes = (shingles >> np.uint64(32)).astype(np.uint32)
    times, plus = _TIMES[first:last], _PLUS[first:last]
    for start in range(0, len(hashes), 512):
        np.minimum(low, (hashes[start : start + 512, None] * times + plus).min(axis=0), out=low)
    return mixed(low.astype(np.uint64))


def signature(shingles: np.ndarray) -> np.ndarray:
    return (smallest(shingles, 0, SYMBOLS) >> np.uint64(48)).astype(np.uint16)


def sketch(shingles: np.ndarray) -> np.ndarray:
    return (smallest(shingles, SYMBOLS, SYMBOLS + SKETCH) >> np.uint64(56)).astype(np.uint8)


def patterns() -> list[np.ndarray]:
    """Symbols that must agree, for each chunk and each set of at most ``ERRORS`` wrong symbols in it.

    If two signatures differ in at most CHUNKS * (ERRORS + 1) - 1 of the indexed symbols, some chunk has at most ``ERRORS``
    differences, and the pattern that leaves those out agrees: no such pair is missed. Leaving a symbol out stands for
    all its values, so errors need not be listed by value, and a chunk without errors agrees in every pattern.
    """
    kept = combinations(range(CHUNK), CHUNK - ERRORS)
    return [np.array(p) + c * CHUNK for p in kept for c in range(CHUNKS)]


_PATTERNS = np.stack(patterns())


def signatures(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key and signature of every document; the key is a digest of the whole shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, keys, signs = [], [], []
            for shingles in shingle_sets(*flat(batch.column("text")), WORDS):
                counts.append(len(shingles))
                keys.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
                signs.append(signature(shingles).tobytes() if len(shingles) else None)
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(signs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "set_key", "signature"])

    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, signature binary")


def _symbols(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SYMBOLS)


def _keys_of(signs: np.ndarray) -> np.ndarray:
    """The keys of each signature, one column per pattern."""
    picked = signs[:, _PATTERNS].astype(np.uint64)
    packed = np.zeros(picked.shape[:2], np.uint64)
    for i in range(picked.shape[2]):
        packed = mixed(packed + picked[:, :, i] + (np.arange(len(_PATTERNS), dtype=np.uint64) << np.uint64(20)))
    return packed.view(np.int64)


def index_keys(classes: DataFrame) -> DataFrame:
    """key, node: a row for each pattern of each class's signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            signs, nodes = _symbols(batch.column("signature")), batch.column("node").to_numpy()
            for start in range(0, len(nodes), 2048):
                keys = _keys_of(signs[start : start + 2048])
                out = [keys.reshape(-1), np.repeat(nodes[start : start + 2048], len(_PATTERNS))]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["key", "node"])

    return classes.select("node", "signature").mapInArrow(run, "key long, node long")


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SKETCH)


def _sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, n_shingles, signature, sketch and shingles of the classes ``wanted``, from the texts of their smallest doc_id."""
    keyed = wanted.select("doc_id", "node", "set_key", "n_shingles", "signature")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(keyed, "doc_id")
    names = ["node", "n_shingles", "signature"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(*flat(batch.column("text")), WORDS))
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            right = [d == key.as_py() for d, key in zip(digests, batch.column("set_key"), strict=True)]
            made = [pa.array([f(s).tobytes() for s in sets], pa.binary()) for f in (sketch, np.asarray)]
            columns = [*(batch.column(c) for c in names), *made]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sketch", "shingles"]).filter(pa.array(right, pa.bool_()))

    schema = "node long, n_shingles long, signature binary, sketch binary, shingles binary"
    made = texts.select(*names, "set_key", "text").mapInArrow(make, schema)
    return made.dropDuplicates(["node"])


def _similar(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which of the other sketches may belong to sets of the similarity that links."""
    near = np.flatnonzero((others[:, :FIRST] != one[..., :FIRST]).sum(axis=1) <= FIRST_DIFFERENT)
    rest = one[near] if one.ndim == 2 else one
    return near[(others[near] != rest).sum(axis=1) <= MOST_DIFFERENT]


def _near(pairs: DataFrame, sets: DataFrame, sketches: bool) -> DataFrame:
    """The pairs (a, b) whose set sizes, and with ``sketches`` whose sketches, allow the similarity that links."""
    for side in "ab":
        facts = sets.select(
            F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}")
        )
        pairs = pairs.join(facts, side)
    sizes = F.greatest("n_a", "n_b") * PART <= F.least("n_a", "n_b") * OF

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = _similar(_sketches(batch.column("sketch_a")), _sketches(batch.column("sketch_b")))
                yield batch.select(["a", "b"]).take(pa.array(near))

    if not sketches:
        return pairs.filter(sizes).select("a", "b")
    return pairs.filter(sizes).select("a", "b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for a, b in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                left, right = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                common = len(np.intersect1d(left, right, assume_unique=True))
                kept.append(OF * common >= PART * (len(left) + len(right) - common))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    both = pairs
    for side in "ab":
        both = both.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(f"set_{side}")), side)
    return both.select("a", "b", "set_a", "set_b").mapInArrow(compare, "a long, b long")


def _across(shared: DataFrame, labels: DataFrame, sets: DataFrame, every: bool, sketches: bool) -> DataFrame:
    """Pairs (a, b) that share a key but not a component, and whose sizes and sketches are near.

    A key's classes are dealt into blocks of about ``_BLOCK``, and every two blocks meet in one task. There all
    cross pairs are compared on sketches. With ``every`` each near pair leaves the task of the first key that it
    shares, and only that; without it, a class leaves with its nearest partner of another component alone.
    """
    labelled = shared.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    labelled = durable(labelled)
    torn = labelled.groupBy("key").agg(
        F.min("label").alias("_low"), F.max("label").alias("_high"), F.count(F.lit(1)).alias("_n")
    )
    torn = durable(torn.filter("_low < _high").select("key", F.ceil(F.col("_n") / _BLOCK).alias("_blocks")))
    by_node = labelled.join(torn, "key").groupBy("node", "label").agg(F.collect_list(F.struct("key", "_blocks")).alias("_keys"))
    facts = sets.select("node", "n_shingles", "sketch", *(["signature"] if every else [F.lit(b"").alias("signature")]))
    own = by_node.join(facts, "node").select("*", F.inline("_keys"))
    own = own.withColumn("_own", F.pmod(F.xxhash64("node"), "_blocks"))
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("_other")
    met = own.select("*", others).select(
        "key",
        F.least("_own", "_other").alias("_i"),
        F.greatest("_own", "_other").alias("_j"),
        "_own",
        "node",
        "label",
        "n_shingles",
        "sketch",
        "signature",
    )
    group = ["key", "_i", "_j"]
    met = met.repartition(*group).sortWithinPartitions(*group)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            waiting = table if waiting is None else pa.concat_tables([waiting, table])
            spots = np.stack([waiting[c].to_numpy() for c in group], axis=1)
            edges = np.flatnonzero((spots[1:] != spots[:-1]).any(axis=1)) + 1
            if len(edges):
                yield from _meet(waiting.slice(0, edges[-1]), np.concatenate([[0], edges]), every, sketches)
                waiting = waiting.slice(edges[-1])
        if waiting is not None and waiting.num_rows:
            yield from _meet(waiting, np.array([0, waiting.num_rows]), every, sketches)

    return met.mapInArrow(compare, "a long, b long").distinct()


def _meet(table: pa.Table, edges: np.ndarray, every: bool, sketched: bool) -> Iterator[pa.RecordBatch]:
    nodes, labels, sizes = (table[c].to_numpy() for c in ("node", "label", "n_shingles"))
    first, last, own, keys = (table[c].to_numpy() for c in ("_i", "_j", "_own", "key"))
    sketches = _sketches(table["sketch"].combine_chunks())
    held = _keys_of(_symbols(table["signature"].combine_chunks())) if every else None
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for start, end in zip(edges[:-1], edges[1:], strict=True):
        at = np.arange(start, end)
        left = at[own[start:end] == first[start]]
        right = at[own[start:end] == last[start]]
        for one in left:
            rest = right[right > one] if every and first[start] == last[start] else right
            rest = rest[labels[rest] != labels[one]]
            low, high = np.minimum(sizes[rest], sizes[one]), np.maximum(sizes[rest], sizes[one])
            rest = rest[high * PART <= low * OF]
            if not len(rest):
                continue
            if sketched:
                rest = rest[_similar(sketches[one], sketches[rest])]
            if every:
                # The first pattern that both agree in must be this key's.
                agree = held[rest] == held[one]
                rest = rest[held[rest, agree.argmax(axis=1)] == keys[one]]
            elif len(rest):
                rest = rest[[(sketches[rest] != sketches[one]).sum(axis=1).argmin()]]
            if len(rest):
                found.append((np.full(len(rest), nodes[one]), nodes[rest]))
    if found:
        left, right = (np.concatenate(side) for side in zip(*found, strict=True))
        columns = [pa.array(np.minimum(left, right)), pa.array(np.maximum(left, right))]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def _classes(known: DataFrame) -> DataFrame:
    """node, set_key, n_shingles, signature and the smallest doc_id of each distinct shingle set; nodes are numbers."""
    found = known.groupBy("set_key", "n_shingles", "signature").agg(F.min("doc_id").alias("doc_id"))
    return durable(found.withColumn("node", F.monotonically_increasing_id()))


def _same_document(known: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the sets of a doc_id that has several texts."""
    held = known.select("doc_id", "set_key").distinct()
    several = held.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("doc_id")
    nodes = held.join(several, "doc_id").join(classes.select("set_key", "node"), "set_key").select("doc_id", "node")
    first = nodes.groupBy("doc_id").agg(F.min("node").alias("a"))
    return nodes.withColumnRenamed("node", "b").join(first, "doc_id").filter("a < b").select("a", "b")


def near_duplicates(documents: DataFrame, sketches: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document.

    Documents of equal shingle sets are one class. Signatures of classes are joined by ``index_keys``: any two that differ
    in at most 23 of the 60 indexed symbols share a key; at similarity 0.75 a pair shares none with a chance of 6e-6, and a
    more similar one far less. In the first round each class is compared with the smallest class of several of its keys, and
    the links found make components. In the second each class is compared with its nearest one of another component, key
    by key. In the third, where a key still holds several components, all pairs across them whose sketches are near are
    compared. So in the end every two classes that share a key are in one component or have been compared, and pairs within
    a component cost nothing. All links are confirmed on the full sets.

    Sketches spare pairs the comparison of full sets that are far from similar; a pair at similarity 0.75 is spared wrongly
    with a chance of 4e-6. Without ``sketches`` every pair across components that shares a key and whose sizes allow the
    similarity is compared on full sets: nothing but a missing key can then hide a link, at the price of many more pairs.

    Rows without words (or text) have no shingles and are their own component, kept. A row without a doc_id is linked
    with nothing: its component_id is null and it is kept. Repeated rows get the same answer each. If a doc_id has
    several texts, each is compared with others, and all are in one component.
    """
    found = durable(signatures(documents))
    known = found.filter(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    classes = _classes(known)
    keys = index_keys(classes)
    buckets = keys.groupBy("key").agg(F.min("node").alias("low"), F.count(F.lit(1)).alias("_n"))
    buckets = durable(buckets.filter("_n > 1").drop("_n"))
    shared = durable(keys.join(buckets, "key"))
    grouped = shared.select("node").distinct()
    sets = durable(_sets(documents, durable(classes.join(grouped, "node", "left_semi"))))
    links = durable(_same_document(known, classes))
    stars = shared.filter("low < node").groupBy(F.col("low").alias("a"), F.col("node").alias("b")).count()
    stars = stars.filter(F.col("count") >= STAR_KEYS).select("a", "b")
    links = durable(links.union(_confirmed(durable(_near(stars, sets, sketches)), sets)))
    labels = components(links)
    shared = shared.select("key", "node")
    for every in (False, True) if sketches else (True,):
        more = durable(_confirmed(durable(_across(shared, labels, sets, every, sketches)), sets))
        if not more.isEmpty():
            links = durable(links.union(more))
            labels = components(links)
    placed = classes.select("node", "set_key", "doc_id").join(labels, "node", "left")
    placed = durable(placed.select("set_key", "doc_id", F.coalesce("label", "node").alias("label")))
    smallest_id = placed.groupBy("label").agg(F.min("doc_id").alias("_component"))
    answer = durable(placed.join(smallest_id, "label").select("set_key", "_component"))
    found = found.select("doc_id", "n_shingles", "set_key").join(answer, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def one_of_each(documents: DataFrame) -> DataFrame:
    """One document of each group of near-duplicates, with all its columns: that of the smallest doc_id.

    Of several rows with that doc_id the smallest row stays. Rows without a doc_id stay. The texts meet the kept ids in
    one shuffle at every size, so what is moved grows as the input does.
    """
    found = near_duplicates(documents).filter(F.col("kept") & F.col("doc_id").isNotNull())
    kept = durable(found.groupBy(F.col("doc_id").alias("_kept")).agg(F.count(F.lit(1)).alias("_n")))
    rows = documents.select(F.struct(*documents.columns).alias("_row"), F.col("doc_id").cast("long").alias("_id"))
    held = rows.filter("_id IS NOT NULL").join(kept.hint("shuffle_hash"), F.col("_id") == F.col("_kept"))
    repeated = held.filter("_n > 1").groupBy("_id").agg(F.min("_row").alias("_row"))
    whole = held.filter("_n = 1").select("_row").unionByName(repeated.select("_row"))
    return whole.unionByName(rows.filter("_id IS NULL").select("_row")).select("_row.*")
