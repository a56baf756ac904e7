"""Small sources and cuts of the mix, and near-duplicates of repeated ids, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing, neardup

SCHEMA = "doc_id long, text string, source string"


def test_tiny_sources_meet_their_targets(spark):
    rows = [(i, "w " * 6554, "a") for i in range(1000)] + [(2000 + i, "w " * 5, s) for i in range(3) for s in "bcd"]
    table = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(table, blocks=4096).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert {r["source"]: r["taken"] for r in got if r["source"] != "a"} == {"b": 45, "c": 45, "d": 45}
    assert all(abs(r["taken"] - r["target"]) <= r["target"] / mixing.FINE + 1 for r in got)


def many_sources(seed):
    dice, rows = random.Random(seed), []
    for number in range(9):
        source = None if number == 8 else f"s{number}"
        for _ in range(dice.choice([1, 3, 40])):
            rows.append((dice.choice([None, dice.randint(0, 90)]), "w " * dice.choice([0, 1, 7, 300, 9000]), source))
    return rows + rows[:5]


@pytest.mark.parametrize("seed", range(3))
def test_rows_of_the_mix_are_the_taken_documents(spark, seed):
    rows = [(*r, 1, 2, 3, 4, 5) for r in many_sources(seed)]
    table = spark.createDataFrame(rows, SCHEMA + ", _words int, _copy int, _mix_n int, _row int, size int").repartition(3)
    mixed = mixing.mixed_rows(table, blocks=512)
    assert mixed.columns == table.columns
    found: dict = {}
    for r in mixed.collect():
        key = (r.doc_id, r.source, len((r.text or "").split()))
        found[key] = found.get(key, 0) + 1
    wanted: dict = {}
    for r in mixing.mix(table, blocks=512).collect():
        wanted.setdefault((r.doc_id, r.source, r["size"]), []).append(r)
    for key, alike in wanted.items():
        # copies of alike rows: those taken in part count whole, and rows alike to the cut are cut alike
        least = sum(-(-r.taken // max(1, r["size"])) for r in alike)
        most = len(alike) * max(-(-r.taken // max(1, r["size"])) for r in alike)
        assert least <= found.get(key, 0) <= most
    assert set(found) <= set(wanted)


@pytest.mark.parametrize("seed", range(3))
def test_taken_words_against_a_plain_layout(spark, seed):
    """Per document: whole rounds, and the words before the cut of its source in seeded order."""
    table = spark.createDataFrame(many_sources(seed), SCHEMA)
    got = mixing.mix(table, blocks=512).withColumn("hash", F.xxhash64(F.lit(mixing.SEED), "doc_id", "size")).collect()
    by_source: dict = {}
    for r in got:
        by_source.setdefault(r.source, []).append(r)
    for rows in by_source.values():
        total, size = sum(r.taken for r in rows), sum(r["size"] for r in rows)
        assert all(r.source_size == size and 0 <= r.taken <= 3 * r["size"] for r in rows)
        assert abs(total - rows[0].target) <= max(1, rows[0].target / mixing.FINE) + 1
        rows.sort(key=lambda r: (r.hash, r.doc_id is not None, r.doc_id or 0, r["size"]))
        rounds, rest = divmod(total, size) if size else (0, 0)
        for r in rows:
            assert r.taken == rounds * r["size"] + max(0, min(r["size"], rest))
            rest -= r["size"]


def test_every_text_of_a_repeated_id_is_compared(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(300)) for x in "ab")
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, "something else that nobody has written"), (2, a + " more")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for sketches in (True, False):
        got = {r.doc_id: r.component_id for r in neardup.near_duplicates(table, sketches).collect()}
        assert got == {1: 1, 2: 1, 3: 1, 4: 4}
    kept = sorted(tuple(r) for r in neardup.one_of_each(table).collect())
    assert kept == [(1, min(a, b)), (4, "something else that nobody has written")]


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_recall_just_above_the_threshold(spark):
    """Pairs at similarity 0.75 to 0.78, which sketches and keys are most likely to lose."""
    dice, rows, linked = random.Random(11), [], 0
    while len(rows) < 800:
        words = [f"w{dice.random()}" for _ in range(dice.randint(150, 400))]
        other, one = list(words), shingles(" ".join(words))
        while True:
            other[dice.randrange(len(words))] = f"n{dice.random()}"
            two = shingles(" ".join(other))
            similarity = len(one & two) / len(one | two)
            if similarity < 0.78:
                break
        if similarity >= 0.75:
            linked += 1
            rows += [(2 * linked, " ".join(words)), (2 * linked + 1, " ".join(other))]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for sketches in (True, False):
        got = {r.doc_id: r.component_id for r in neardup.near_duplicates(table, sketches).collect()}
        assert got == {i: i - i % 2 for i, _ in rows}
