"""Mixing sources to target weights: Sainte-Laguë quotas of equal-token blocks, seeded block selection.

DataFrame functions only; no Python runs on rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.durable import durable
from tidemark.operators.ordering import global_running

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
REPEATS = 3
# Blocks that the words of a level are cut into at least, and blocks that a source's target must hold to be settled there
BLOCKS, FINE = 65_536, 256
SEED = 29


def word_count(text: Column) -> Column:
    """Number of words of the text; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``sizes`` (source, source_size) with ``weight`` and ``target``.

    Sources by code point, null last, take the weights in turn. A target is weight * level, but at most ``repeats``
    times the source's size, and ``level`` is raised until the targets add up to all sizes. Each round is one sum over
    the sources; the driver holds only the level. Raising the level can only cap more sources, so rounds end when no
    further source is capped.
    """
    ranked = global_running(sizes, [F.asc_nulls_last("source")])
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("position") % len(weights) + 1).cast("int"))
    known = durable(ranked.select("source", "source_size", weight.cast("long").alias("weight")))
    cap, level, capped = F.col("source_size") * repeats, 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) >= cap
        facts = known.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, cap)).alias("fixed"),
            F.sum(F.when(~full, F.col("weight"))).alias("free"),
            F.count(F.when(full, 1)).alias("capped"),
        ).first()
        if facts["capped"] == capped or not facts["free"]:
            break
        capped, level = facts["capped"], (facts["all"] - (facts["fixed"] or 0)) / facts["free"]
    return known.withColumn("target", F.least(F.col("weight") * F.lit(level), cap.cast("double")))


def block_quotas(targets: DataFrame, block: int, blocks: int, shards: int) -> DataFrame:
    """source, shard, quota: how many of ``blocks`` equal blocks each shard takes from each source.

    The k-th block of a source has the quotient target / (2k - 1). The ``blocks`` highest quotients win, equal ones by
    source. The winners in order of their quotients are cut into shards of equal numbers of blocks: any run of that
    order is in proportion to the targets. A source of share s can win at most round(s * (blocks + sources/2 + 1))
    blocks, so only so many quotients are made.
    """
    totals = targets.agg(F.sum("target"), F.count(F.lit(1))).first()
    if not totals[0] or blocks < 1:
        return targets.select("source", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("quota")).limit(0)
    most = F.round(F.col("target") / F.lit(totals[0]) * F.lit(blocks + totals[1] / 2 + 1)).cast("long")
    offers = targets.filter(most > 0).select("source", "target", F.explode(F.sequence(F.lit(1), most)).alias("k"))
    quotient = F.col("target") / (2 * F.col("k") - 1)
    placed = global_running(
        offers.select("source", "k", quotient.alias("quotient")),
        [F.desc("quotient"), F.asc_nulls_last("source"), F.asc("k")],
    )
    won = placed.filter(F.col("position") < blocks)
    shard = F.expr(f"(position * {shards}) div {blocks}").cast("int")
    return won.groupBy("source", shard.alias("shard")).agg(F.count(F.lit(1)).alias("quota"))


def wanted_words(targets: DataFrame, shards: int, blocks: int = BLOCKS) -> DataFrame:
    """source, shard, quota and block: how many blocks of ``block`` words each shard takes from each source.

    All words are cut into ``blocks`` equal blocks and apportioned. Sources whose target holds ``FINE`` blocks or more keep
    their quotas. The others are too small for blocks of that size; their targets are pooled and apportioned again with
    finer blocks, down to single words. So every source is within about a ``FINE``-th of its target, however large the
    others are. There are at least ``FINE`` blocks a source, so the largest source of a level is always settled.
    """
    found, open_ = None, durable(targets.filter("target > 0").select("source", "target"))
    while True:
        facts = open_.agg(F.sum("target"), F.count(F.lit(1))).first()
        words = int(facts[0] or 0)
        block = max(1, words // max(blocks, FINE * facts[1]))
        quotas = block_quotas(open_, block, words // block, shards).withColumn("block", F.lit(block).cast("long"))
        settled = F.col("target") >= F.lit(FINE * block) if block > 1 else F.lit(True)
        kept = open_.filter(settled).select(F.col("source").alias("_s"))
        quotas = durable(quotas.join(kept, F.col("source").eqNullSafe(F.col("_s")), "left_semi"))
        found = quotas if found is None else found.unionByName(quotas)
        if block == 1:
            return found
        open_ = durable(open_.filter(~settled))


def _order(seed: int) -> list[Column]:
    """Seeded order of the documents of a source."""
    return [F.xxhash64(F.lit(seed), "doc_id", "size").alias("_hash"), F.col("doc_id"), F.col("size")]


def _plan(documents: DataFrame, blocks: int, shards: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The documents laid out by source and seeded order, and one row a source.

    Of each document doc_id, source, size and ``_from``, the words of its source before it. Of each source its name ``_of``,
    source_size, target, and ``_wanted``, the words that it gives.
    """
    narrow = durable(documents.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    placed = global_running(narrow, [F.asc_nulls_last("source"), *_order(seed)], ["size"])
    laid = durable(placed.select("doc_id", "source", "size", (F.col("running_size") - F.col("size")).alias("_at")))
    sizes = durable(laid.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("_at").alias("_start")))
    targets = durable(source_targets(sizes.select("source", "source_size")))
    won = wanted_words(targets, shards, blocks).groupBy(F.col("source").alias("_s"))
    won = won.agg(F.sum(F.col("quota") * F.col("block")).alias("_won"))
    facts = targets.join(won, F.col("source").eqNullSafe(F.col("_s")), "left").select(
        F.col("source").alias("_of"),
        "target",
        F.least(F.coalesce("_won", F.lit(0)), F.col("source_size") * REPEATS).alias("_wanted"),
    )
    facts = durable(
        facts.join(sizes.withColumnRenamed("source", "_s"), F.col("_of").eqNullSafe(F.col("_s"))).select(
            "_of", "source_size", "target", "_start", "_wanted"
        )
    )
    laid = laid.join(facts.select(F.col("_of").alias("_s"), "_start"), F.col("source").eqNullSafe(F.col("_s")))
    return laid.select("doc_id", "source", "size", (F.col("_at") - F.col("_start")).alias("_from")), facts.drop("_start")


_ROUNDS = "if(source_size = 0, 0, _wanted div source_size)"
_REST = "if(source_size = 0, 0, _wanted % source_size)"


def mixed_rows(documents: DataFrame, blocks: int = BLOCKS, shards: int = 40, seed: int = SEED) -> DataFrame:
    """The rows of the mix: every document as often as it is taken, a part of a document counting as the whole.

    A source gives all its documents for each whole round, and once more those up to its cut, the last document in seeded
    order of which it takes a word. The cut is one key a source, so each row is decided where it lies, against a table of
    one row per source: no text is shuffled. Documents that give no words are left out. Rows that agree in doc_id, source
    and size are alike to the cut.
    """
    laid, facts = _plan(documents, blocks, shards, seed)
    again = laid.join(facts, F.col("source").eqNullSafe(F.col("_of"))).filter(F.col("_from") < F.expr(_REST))
    cuts = again.select("source", F.struct(*_order(seed)).alias("_key")).groupBy(F.col("source").alias("_s"))
    cuts = cuts.agg(F.max("_key").alias("_cut"))
    by_source = facts.join(cuts, F.col("_of").eqNullSafe(F.col("_s")), "left")
    by_source = durable(by_source.select("_of", F.expr(_ROUNDS).alias("_rounds"), "_cut"))
    rows = documents.select(
        F.struct(*documents.columns).alias("_row"), "doc_id", "source", word_count(F.col("text")).alias("size")
    )
    decided = rows.filter("size > 0").join(by_source, F.col("source").eqNullSafe(F.col("_of")))
    once_more = F.coalesce(F.struct(*_order(seed)) <= F.col("_cut"), F.lit(False)).cast("int")
    copies = F.array_repeat(F.col("_row"), (F.col("_rounds") + once_more).cast("int"))
    return decided.select(F.inline(copies))


def mix(documents: DataFrame, blocks: int = BLOCKS, shards: int = 40, seed: int = SEED) -> DataFrame:
    """doc_id, size, source, source_size, target and ``taken`` words of every document.

    The words are divided into equal blocks, which the sources get by ``block_quotas``, small sources in finer blocks (see
    ``wanted_words``); a source is thus within about a 256th of its target. The documents of a source are laid out in a
    seeded order, cut into blocks, and its quota takes the blocks in that order, beginning again when the source is used
    up, but never more than ``REPEATS`` times. A document at the end of the last block gives only the words inside it.

    Null, empty and blank texts have size 0 and give nothing; null ids and sources are ordinary values; repeated rows
    count each; an empty table gives an empty result. Equal rows may swap their places.
    """
    laid, facts = _plan(documents, blocks, shards, seed)
    joined = laid.join(facts, F.col("source").eqNullSafe(F.col("_of")))
    rest = F.expr(_REST) - F.col("_from")
    taken = F.expr(_ROUNDS) * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return joined.select("doc_id", "size", "source", "source_size", "target", taken.cast("long").alias("taken"))
