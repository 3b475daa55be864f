"""Mixing sources to target weights by the cube method.

Every source has a target number of words. A document is taken ``floor(rate)`` times for sure, where
rate is the target over the source's words, and once more with the inclusion probability that is
left. Those probabilities are moved by the flight phase of the cube method: three undecided
documents at a time, along the direction that keeps both the sum of words and the number of
documents of the source, until one of them is 0 or 1. Blocks of a source fly in parallel and each
leaves at most two undecided documents; these are gathered into blocks again, round by round, until
a source has one block. ``RESERVE`` documents of a source do not fly before that. The landing is
their small problem: they fly together with what is left, the last two move along the words alone
and the last one is decided by its probability; then choices among these documents alone are turned,
one or two at a time, while that brings the words nearer to the target.

All choices come from hashes of ids and sizes, so reruns agree.

Edge cases: a null text has size 0 and takes 0 words; documents of size 0 take no part in the flight.
Null sources are one source, the last in order. Null ids are allowed. Repeated rows are documents of
their own; those with equal id, size and source are interchangeable. Empty tables give no rows. A
source of size 0 has target 0. Other columns are not returned, whatever their names.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from celluloid.llm.common import WORD, ship, staged

BLOCK_ROWS = 2_000  # documents that fly together
RESERVE = 64  # documents of a source that are left for the landing
STARTS = 8
MAX_REPEATS = 3.0
SEED = 4_099
EPSILON = 1e-9


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and the words of the whole text."""
    count = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", count.alias("size"))


def ranked_sources(totals: DataFrame) -> DataFrame:
    """Adds position: place of the source in code-point order, null last, from 0. No task sorts all sources."""
    ordered = totals.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    ordered = staged(ordered.withColumn("_part", F.spark_partition_id()), "mixture-sources")
    counts = {r["_part"]: r["count"] for r in ordered.groupBy("_part").count().collect()}  # a row per partition
    before, start = {}, 0
    for part in sorted(counts):
        before[part] = start
        start += counts[part]
    offset = F.lit(0)
    for part, first in before.items():
        offset = F.when(F.col("_part") == part, first).otherwise(offset)
    within = F.row_number().over(Window.partitionBy("_part").orderBy(F.col("source").asc_nulls_last())) - 1
    return ordered.withColumn("position", offset + within).drop("_part")


def targets(totals: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), repeats: float = MAX_REPEATS) -> DataFrame:
    """(source, source_size, documents, target): shares of all words by weight, capped at ``repeats``
    times the source's words; what a cap leaves over is shared among the others by weight."""
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("position") % len(weights) + 1).cast("int"))
    sources = staged(ranked_sources(totals).withColumn("weight", weight), "mixture-weights")
    cap = F.col("source_size") * F.lit(repeats)
    whole = sources.agg(F.sum("source_size").alias("s")).first()["s"] or 0
    share = 0.0  # words per unit of weight; grows from round to round, so a capped source stays capped
    while whole:
        capped = F.col("weight") * F.lit(share) > cap
        row = sources.agg(
            F.sum(F.when(capped, cap).otherwise(0.0)).alias("full"),
            F.sum(F.when(~capped, F.col("weight")).otherwise(0.0)).alias("open"),
        ).first()
        if not row["open"]:
            break
        now = (whole - row["full"]) / row["open"]
        if now <= share:
            break
        share = now
    return sources.select("source", "source_size", "documents", F.least(F.col("weight") * F.lit(share), cap).alias("target"))


def fly(size: np.ndarray, chance: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Flight phase: moved probabilities, of which at most two are neither 0 nor 1."""
    chance = chance.copy()
    undecided: list[int] = []
    drawn = 0
    for following in range(len(size)):
        if not EPSILON < chance[following] < 1 - EPSILON:
            chance[following] = round(chance[following])
            continue
        undecided.append(following)
        while len(undecided) == 3:
            a, b, c = undecided
            move = np.array([size[b] - size[c], size[c] - size[a], size[a] - size[b]])  # keeps count and words
            if not move.any():
                move = np.array([1.0, -1.0, 0.0])  # equal sizes: any exchange keeps both
            undecided = _step(chance, undecided, move, draws[drawn % len(draws)])
            drawn += 1
    return chance


def _step(chance: np.ndarray, group: list[int], move: np.ndarray, draw: float) -> list[int]:
    """Goes along the move, or against it, until a probability is 0 or 1; keeps each one's expectation."""
    at = chance[group]
    with np.errstate(divide="ignore", invalid="ignore"):
        forward = np.min(np.where(move > 0, (1 - at) / move, np.where(move < 0, -at / move, np.inf)))
        back = np.min(np.where(move > 0, at / move, np.where(move < 0, (at - 1) / move, np.inf)))
    at = at + forward * move if draw * (forward + back) < back else at - back * move
    at = np.where(at < EPSILON, 0.0, np.where(at > 1 - EPSILON, 1.0, at))
    chance[group] = at
    return [g for g, p in zip(group, at) if 0 < p < 1]


def land(size: np.ndarray, chance: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Decides the last documents: first along the words alone, then the last one by its probability."""
    chance = chance.copy()
    group = [i for i, p in enumerate(chance) if 0 < p < 1]
    drawn = 0
    while len(group) >= 2:
        a, b = group[:2]
        group = _step(chance, [a, b], np.array([float(size[b]), -float(size[a])]), draws[drawn % len(draws)]) + group[2:]
        drawn += 1
    for last in group:
        chance[last] = 1.0 if draws[drawn % len(draws)] < chance[last] else 0.0
    return chance


def settle(size: np.ndarray, chosen: np.ndarray, wanted: float) -> np.ndarray:
    """Turns choices while the words chosen come nearer to those wanted: one or two at a time, begun
    from the choice as it is and from those with one of the largest documents turned."""
    starts = [chosen.copy()]
    for largest in np.argsort(-size, kind="stable")[:STARTS]:
        starts.append(chosen.copy())
        starts[-1][largest] = 1.0 - chosen[largest]
    ends = [_nearer(size, start, wanted) for start in starts]
    return min(ends, key=lambda end: abs(wanted - float((size * end).sum())))


def _nearer(size: np.ndarray, chosen: np.ndarray, wanted: float) -> np.ndarray:
    while len(size):
        change = np.where(chosen > 0.5, -size, size)
        off = wanted - float((size * chosen).sum())
        pairs = np.abs(off - change[:, None] - change[None, :])
        np.fill_diagonal(pairs, np.abs(off - change))  # one alone
        i, j = np.unravel_index(int(pairs.argmin()), pairs.shape)
        if pairs[i, j] >= abs(off) - EPSILON:
            break
        for turned in {int(i), int(j)}:
            chosen[turned] = 1.0 - chosen[turned]
    return chosen


def _draws(size: np.ndarray, step: int) -> np.ndarray:
    return np.random.default_rng([SEED, step, len(size), int(size.sum())]).random(max(len(size), 8))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), repeats: float = MAX_REPEATS) -> DataFrame:
    """doc_id, source, size, source_size, target (its source's), taken (words the mix takes)."""
    ship(docs.sparkSession)
    counted = staged(sizes(docs), "mixture-sizes")
    totals = counted.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    goals = staged(targets(totals, weights, repeats), "mixture-targets")
    spread = F.xxhash64("doc_id", "size", F.lit(SEED))
    # a source's row is joined to each of its documents; adaptive execution splits a hot source
    rows = counted.alias("d").join(goals.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source")))
    rows = rows.select("doc_id", "d.source", "size", "source_size", "target", "documents")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(repeats))).otherwise(0.0)
    rows = rows.withColumn("sure", F.floor(rate + EPSILON)).withColumn("chance", F.greatest(rate - F.col("sure"), F.lit(0.0)))
    rows = rows.withColumn("chance", F.when(F.col("size") > 0, F.col("chance")).otherwise(0.0)).withColumn("spread", spread)
    rows = rows.withColumn("blocks", F.ceil(F.col("documents") / BLOCK_ROWS).cast("long"))
    rows = rows.withColumn("held", F.lit(False)).withColumn("first", F.lit(False))
    schema = rows.select("doc_id", "source", "size", "source_size", "target", "sure", "chance", "spread", "blocks", "held", "first").schema

    def move(step: int):
        def run(group: pa.Table) -> pa.Table:
            order = [("size", "descending"), ("spread", "ascending"), ("doc_id", "ascending")]
            group = group.select(schema.names).sort_by(order)
            size, chance = group["size"].to_numpy().astype(float), group["chance"].to_numpy().copy()
            held = group["held"].to_numpy(zero_copy_only=False).astype(bool)
            draws = _draws(size, step)
            if step and group["blocks"][0].as_py() <= 1:
                wanted = float((size * chance).sum())
                chance = settle(size, land(size, fly(size, chance, draws), draws[::-1]), wanted)
            else:
                if step == 0 and group["first"][0].as_py():
                    open_rows = np.flatnonzero((chance > EPSILON) & (chance < 1 - EPSILON))
                    held[open_rows[np.argsort(group["spread"].to_numpy()[open_rows], kind="stable")[:RESERVE]]] = True
                chance[~held] = fly(size[~held], chance[~held], draws)
            for name, values in (("chance", pa.array(chance, pa.float64())), ("held", pa.array(held))):
                group = group.set_column(schema.names.index(name), name, values)
            return group

        return run

    flown = rows.select(*schema.names)
    decided: list[DataFrame] = []
    step = 0
    while True:
        block = F.pmod(F.xxhash64("spread", F.lit(step)), F.greatest(F.col("blocks"), F.lit(1)))
        flown = flown.withColumn("_block", block).withColumn("first", F.col("_block") == 0).groupBy("source", "_block")
        flown = staged(flown.applyInArrow(move(step), schema), f"mixture-flight{step}")
        open_rows = (F.col("chance") > 0) & (F.col("chance") < 1)
        decided.append(flown.where(~open_rows))
        left = flown.where(open_rows)
        if left.isEmpty():
            break
        # two rows a block are left at most, and the source's reserve
        flown = left.withColumn("blocks", F.ceil(2 * F.col("blocks") / BLOCK_ROWS).cast("long"))
        step += 1
    result = decided[0]
    for more in decided[1:]:
        result = result.unionByName(more)
    taken = (F.col("size") * (F.col("sure") + F.round("chance"))).cast("long")
    return result.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


__all__ = ["fly", "land", "mix", "sizes", "targets"]
