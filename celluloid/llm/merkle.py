"""Merkle manifest of a dataset by time-forward processing: digests go forward, proofs come back.

A row is a leaf, the digest of its fields. The leaves of a group, in the order of their keys, are the
bottom of a tree in which every ``RUN`` consecutive nodes have one parent; the tops of the groups' trees
(subroots), in the order of the groups, are the leaves of one more tree, whose top is the root.

A node never looks for its children. Nodes have labels (tree, level, place) in which children come before
parents, and a node that is done sends its digest to its parent's label; nodes are taken in label order
from a priority queue of messages. The queue is external: between blocks of ``RUN ** BLOCK_LEVELS``
neighbouring nodes it is a Spark shuffle, sorted by label and spilled as Spark sorts, written once per
round; within a block, which is one subtree of bounded size, it is a heap. A round lifts every tree by
``BLOCK_LEVELS`` levels, so ten thousand million leaves take three rounds. The reversed sweep takes labels
from the top down: a node sends each of its children the proof of that child, which is the child's
siblings followed by what the node itself was sent. What reaches a leaf is its whole proof.

Leaf order is settled by a range sort; a row's place is its line in its sorted partition plus the rows of
the partitions before it. A group with most of the rows is cut into many partitions and blocks like
any other, and no task holds more than a block.

Edge cases: a null field counts as ``-``, so it differs from an empty text. A null group is a group, the
first; null keys come first in a group, equal keys are ordered by leaf digest, and repeated rows are leaves
of their own. A lone leaf is its group's subroot, a lone subroot the root; then a proof has no siblings. An
empty table gives no rows and no root. Only the fields named are read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from celluloid.llm.common import ship, staged

RUN = 8
BLOCK_LEVELS = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "array<struct<left string, right string>>"
MESSAGE = "tree long, place long, subroot string, proof " + PROOF
_SIDES = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def digest(*values: Column) -> Column:
    """Lower-case hex SHA-256 of the values: ``-`` for null, else the length in UTF-8 bytes, ``:`` and the value."""
    texts = [v.cast("string") for v in values]
    marked = [F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*marked), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda low, step: F.sha2(F.concat(step["left"], low, step["right"]), 256))


def siblings_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, level by level and left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def placed(leaves: DataFrame) -> DataFrame:
    """Leaves (key, group, leaf, ...) with ``tree`` (number of the group in their order), ``place`` (in the
    group) and ``size`` (of the group)."""
    order = [F.col("group").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("leaf").asc()]
    lines = leaves.repartitionByRange(*order).sortWithinPartitions(*order)
    lines = lines.withColumns({"part": F.spark_partition_id(), "line": F.monotonically_increasing_id()})
    lines = staged(lines, "merkle-leaves")
    # from here to the join: at most a row for each group and each partition
    runs = staged(lines.groupBy("part", "group").agg(F.min("line").alias("first"), F.count("*").alias("rows")), "merkle-runs")
    within = Window.partitionBy("group")
    runs = runs.withColumn("before", F.sum("rows").over(within.orderBy("part")) - F.col("rows"))
    runs = runs.withColumns({"size": F.sum("rows").over(within), "starts": F.min("part").over(within)})
    starting = runs.where(F.col("part") == F.col("starts"))
    ordinal = F.row_number().over(Window.partitionBy("part").orderBy(F.col("group").asc_nulls_first())) - 1
    counts = starting.groupBy("part").agg(F.count("*").alias("groups"))  # a row per partition
    earlier = F.sum("groups").over(Window.orderBy("part")) - F.col("groups")
    counts = counts.select(F.col("part").alias("of_part"), earlier.alias("earlier"))
    numbered = starting.withColumn("ordinal", ordinal).join(counts, F.col("part") == F.col("of_part"))
    numbered = numbered.select(F.col("group").alias("of_group"), (F.col("earlier") + F.col("ordinal")).cast("long").alias("tree"))
    runs = runs.join(numbered, F.col("group").eqNullSafe(F.col("of_group")))
    runs = staged(
        runs.select(F.col("part").alias("of_part"), F.col("group").alias("of_group"), "tree", "size", (F.col("before") - F.col("first")).alias("shift")),
        "merkle-trees",
    )
    both = lines.join(runs, (F.col("part") == F.col("of_part")) & F.col("group").eqNullSafe(F.col("of_group")))
    return both.select("tree", "size", (F.col("line") + F.col("shift")).alias("place"), *leaves.columns)


def height(size: int) -> int:
    """Levels above the leaves of a tree."""
    levels = 0
    while size > 1:
        size, levels = -(-size // RUN), levels + 1
    return levels


class Queue:
    """Messages by label; all of the first label come out together, in the order of their slots."""

    def __init__(self, reverse: bool = False):
        self.heap: list[tuple[int, int, int, object]] = []
        self.sign = -1 if reverse else 1

    def send(self, level: int, place: int, slot: int, content: object) -> None:
        heapq.heappush(self.heap, (self.sign * level, place, slot, content))

    def take(self) -> tuple[int, int, list]:
        level, place, _, content = heapq.heappop(self.heap)
        contents = [content]
        while self.heap and self.heap[0][:2] == (level, place):
            contents.append(heapq.heappop(self.heap)[3])
        return self.sign * level, place, contents


def lift(digests: Sequence[str], levels: int) -> list[list[str]]:
    """Digests of a block's nodes by level: forward sweep over its labels."""
    known: list[list[str]] = [list(digests), *([] for _ in range(levels))]
    queue = Queue()
    if levels:
        for place, value in enumerate(digests):
            queue.send(1, place // RUN, place % RUN, value)
    while queue.heap:
        level, place, below = queue.take()
        value = hashlib.sha256("".join(below).encode()).hexdigest()
        known[level].append(value)
        if level < levels:
            queue.send(level + 1, place // RUN, place % RUN, value)
    return known


def lower(known: list[list[str]], proof: list[dict]) -> list[list[dict]]:
    """Proofs of a block's lowest nodes, given that of its top: reversed sweep over its labels."""
    found: list[list[dict]] = [[]] * len(known[0])
    queue = Queue(reverse=True)
    queue.send(len(known) - 1, 0, 0, proof)
    while queue.heap:
        level, place, [sent] = queue.take()
        if not level:
            found[place] = sent
            continue
        first = place * RUN
        run = known[level - 1][first : first + RUN]
        for slot in range(len(run)):
            step = {"left": "".join(run[:slot]), "right": "".join(run[slot + 1 :])}
            queue.send(level - 1, first + slot, 0, [step, *sent])
    return found


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one (tree, block) at a time, from batches that are sorted by it."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if rest is not None:
            rows = pa.concat_tables([rest, rows])
        trees, blocks = rows["tree"].to_numpy(), rows["block"].to_numpy()
        starts = [0, *(1 + k for k in range(len(trees) - 1) if trees[k] != trees[k + 1] or blocks[k] != blocks[k + 1])]
        for start, end in zip(starts, starts[1:]):
            yield rows.slice(start, end - start)
        rest = rows.slice(starts[-1])
    if rest is not None:
        yield rest


def _span(levels: int) -> int:
    return RUN**levels


def _in_blocks(rows: DataFrame, levels: int) -> DataFrame:
    """Rows with a place, brought together and sorted by label: the queue's external part."""
    blocked = rows.withColumn("block", F.floor(F.col("place") / _span(levels)).cast("long"))
    return blocked.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")


def raised(nodes: DataFrame, levels: int) -> DataFrame:
    """The tops of the nodes' blocks, as nodes (tree, size, place, digest) of a smaller level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            tree, size, at = (block[c][0].as_py() for c in ("tree", "size", "block"))
            [top] = lift(block["digest"].to_pylist(), min(levels, height(size)))[-1]
            yield pa.RecordBatch.from_pylist([{"tree": tree, "size": -(-size // _span(levels)), "place": at, "digest": top}], schema=_NODE)

    ordered = _in_blocks(nodes.select("tree", "size", "place", "digest"), levels)
    return ordered.mapInArrow(run, "tree long, size long, place long, digest string")


_NODE = pa.schema([("tree", pa.int64()), ("size", pa.int64()), ("place", pa.int64()), ("digest", pa.string())])


def climb(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Forward rounds: the nodes that entered each round, and the tops (tree, digest) of all trees."""
    rounds, tops = [nodes], [nodes.where("size = 1").select("tree", "digest")]
    largest = nodes.agg(F.max("size")).first()[0] or 0
    while largest > 1:
        up = staged(raised(rounds[-1].where("size > 1"), levels), "merkle-nodes")
        tops.append(up.where("size = 1").select("tree", "digest"))
        rounds.append(up.where("size > 1"))
        largest = -(-largest // _span(levels))
    return rounds[:-1] or rounds, reduce(DataFrame.unionByName, tops)


def descend(rounds: list[DataFrame], tops: DataFrame, levels: int, carried: Sequence[str] = ()) -> DataFrame:
    """Reversed rounds, from messages (tree, subroot, proof) to the tops of all trees, down to the nodes that
    entered the first round: their columns named in ``carried``, subroot and proof."""
    at_top = staged(tops.select("tree", F.lit(0).cast("long").alias("place"), "subroot", "proof"), "merkle-tops")
    sent: DataFrame | None = None
    for number in reversed(range(len(rounds))):
        nodes = rounds[number]
        names = ["tree", "place", *(carried if number == 0 else ())]
        # trees whose top is made in this round hear from their own top, taller ones from the round above
        ending = nodes.where(F.col("size") <= _span(levels)).select("tree").distinct()
        heard = at_top.join(ending, "tree", "left_semi")
        heard = heard if sent is None else heard.unionByName(sent)
        sent = _sent_down(nodes, heard, levels, names)
        if number:
            sent = staged(sent, "merkle-proofs")
    return sent


def _sent_down(nodes: DataFrame, heard: DataFrame, levels: int, names: Sequence[str]) -> DataFrame:
    """What the nodes of a level are sent, from what the tops of their blocks have heard."""
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}
    columns = list(dict.fromkeys([*names, "size", "digest"]))
    down = nodes.select(*columns, F.lit(None).cast("string").alias("subroot"), F.lit(None).cast(PROOF).alias("proof"))
    # a message has the first place of its block and comes before the nodes
    blank = {c: F.lit(None).cast(kinds[c]).alias(c) for c in columns}
    message = heard.select(*[blank.get(c) if c not in ("tree", "place") else F.col(c) for c in columns], "subroot", "proof")
    message = message.withColumn("place", F.col("place") * _span(levels))
    both = _in_blocks(message.withColumn("node", F.lit(0)).unionByName(down.withColumn("node", F.lit(1))), levels)
    both = both.sortWithinPartitions("tree", "block", "node", "place")
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in names), "subroot string", f"proof {PROOF}"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            subroot, proof = block["subroot"][0].as_py(), block["proof"][0].as_py()
            rows = block.slice(1).combine_chunks()
            known = lift(rows["digest"].to_pylist(), min(levels, height(rows["size"][0].as_py())))
            proofs = lower(known, proof)
            for start in range(0, rows.num_rows, 1_000):
                part = rows.slice(start, 1_000)
                made = [pa.array([subroot] * part.num_rows, pa.string()), pa.array(proofs[start : start + 1_000], _SIDES)]
                table = pa.table([*(part[c] for c in names), *made], names=[*names, "subroot", "proof"])
                yield from table.combine_chunks().to_batches()

    return both.mapInArrow(run, schema)


def manifest(leaves: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """Leaves (key, group, leaf and any other columns) with ``subroot``, ``root`` and ``proof``: from the leaf
    up, the siblings on either side as joined hex digests."""
    ship(leaves.sparkSession)
    # staged first: a range sort evaluates its input twice
    nodes = placed(staged(leaves, "merkle-digests")).withColumn("digest", F.col("leaf"))
    nodes = staged(nodes, "merkle-nodes")
    carried = [c for c in leaves.columns if c not in ("tree", "place", "size")]
    rounds, subroots = climb(nodes, levels)
    subroots = staged(subroots, "merkle-subroots")
    trees = subroots.count()
    over = subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(trees).cast("long").alias("size"), F.col("tree").alias("place"), "digest")
    upper, root = climb(over, levels)
    root = root.first()  # one row
    top = root["digest"] if root else None
    whole = leaves.sparkSession.range(1 if root else 0).select(F.col("id").alias("tree"), F.lit(None).cast("string").alias("subroot"), F.array().cast(PROOF).alias("proof"))
    told = descend(upper, whole, levels, ("digest",)).select(F.col("place").alias("tree"), F.col("digest").alias("subroot"), "proof")
    return descend(rounds, told, levels, carried).select(*carried, "subroot", F.lit(top).cast("string").alias("root"), "proof")


def leaf_rows(docs: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "lang", carried: Sequence[str] = ()) -> DataFrame:
    """(key, group, leaf) of each row, and columns to carry along."""
    return docs.select(F.col(key).alias("key"), F.col(group).alias("group"), digest(*(F.col(c) for c in fields)).alias("leaf"), *carried)
