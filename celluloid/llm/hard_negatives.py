"""Hard negatives by exact inner-product search in cover trees.

Vectors are whole numbers (``floor(SCALE * x)``), so scores are exact and ties are ties.

1. Equal vectors of one label are one point; of its rows only the ones with the smallest ids can ever be
   among the first few, so a point keeps ``positives + 1`` ids, picked on the map side as well. However
   many rows share a vector, they are one point and one query.
2. Points are sorted by label and nearest pivot (``PIVOTS`` hashed points), and every ``TREE_POINTS`` of
   them in a row are one cover tree. A point x of a tree is augmented by ``sqrt(M * M - |x| * |x|)``, with M the largest
   norm in the tree, so that all have norm M and larger inner products are shorter distances. Centres of a
   level with scale ``BASE ** i`` are more than that apart and cover their points within it; a node keeps
   the largest distance that really occurs, its covering radius.
3. A query descends best-first: nodes wait in a heap by their upper bound. With s the score of a node's
   centre and r its radius, the scores below it lie within s -+ \\|q\\| * r, and within what the distances d - r and d + r
   to the augmented query allow. Nodes whose bounds lie outside all of the query's open windows are
   skipped; a window is open from its lower end, or from its last kept score once it is full, to its
   upper end. The scores of single points are exact and need no further look.
4. First search: same label, one window from the last kept score in the query's own tree up. That gives the
   positives. Second search: other labels, one window for each distinct positive score.

Before trees are read, each query is held against the roots of the trees, blocks of queries against blocks of
roots, and only goes on to trees that it cannot rule out. Tree and queries then meet in a sorted
stream: a task holds one tree at a time and any number of queries passes by it. In data without structure the
bounds rule little out, and a search costs about one matrix product with all points.

Edge cases: rows without label or vector, or with a component that is null or not finite, take no part;
neither do they break anything. A null id is no anchor, and last among ties. Shorter vectors are filled up with
zeros. Scaled components beyond 2 ** 28 either way count as that. A negative positive score has an
empty window. Repeated rows are rows of their own; an anchor leaves out just one row like itself. An empty table, or one
without anchors, gives no rows. Only the three columns named are read.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from celluloid.llm.common import bounded_sample, ship, staged

SCALE = 256
LARGEST = 1 << 28
PIVOTS = 256
TREE_POINTS = 4_096
LEAF_POINTS = 64
BASE = 1.3
GRID = 1_024  # roots, or blocks of queries, that meet in one task
NO_ID = (1 << 63) - 1  # stands for a null id, so that it comes last
FAR = 1 << 62
EXACT, SINGLE = float(1 << 52), float(1 << 23)  # products of norms up to here are exact in doubles, and in floats


def packed(vectors: DataFrame, anchor: Column) -> DataFrame:
    """vec_id, label, anchor, the scaled vector as bytes and its score with itself (own), for the rows that take part."""
    spoilt = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select("vec_id", "label", "embedding", F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows = rows.where("label is not null and embedding is not null").where(~spoilt)
    width = rows.agg(F.max(F.size("embedding"))).first()[0] or 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            lists = batch.column("embedding")
            sizes, values = np.asarray(lists.value_lengths()), np.asarray(lists.flatten(), dtype=np.float64)
            made = np.zeros((batch.num_rows, width), dtype="<i4")
            made[np.arange(width) < sizes[:, None]] = np.clip(np.floor(SCALE * values), -LARGEST, LARGEST)
            packs, own = pa.array([row.tobytes() for row in made], pa.binary()), pa.array((made.astype(np.int64) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("vec_id", "label", "anchor")), packs, own], names=["vec_id", "label", "anchor", "vec", "own"])

    rows = rows.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id"), F.col("label").cast("long").alias("label"), "anchor", "embedding")
    return rows.mapInArrow(run, "vec_id long, label long, anchor boolean, vec binary, own long")


def points(rows: DataFrame, kept: int) -> DataFrame:
    """(point, label, vec, ids, asks): different vectors of each label, their smallest ids, and whether one is an anchor."""
    line = F.row_number().over(Window.partitionBy("label", "vec").orderBy("vec_id"))
    few = rows.withColumn("_line", line).where(F.col("_line") <= kept)
    few = few.groupBy("label", "vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asking = rows.where("anchor").select(F.col("label").alias("_label"), F.col("vec").alias("_vec")).distinct()
    both = few.join(asking, (F.col("label") == F.col("_label")) & (F.col("vec") == F.col("_vec")), "left")
    both = both.select("label", "vec", "ids", F.col("_label").isNotNull().alias("asks"))
    return staged(both.withColumn("point", F.monotonically_increasing_id()), "negatives-points")


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of packed vectors as doubles, which hold them exactly."""
    kept = column.to_pylist()
    return np.frombuffer(b"".join(kept), dtype="<i4").reshape(len(kept), -1).astype(np.float64)


class CoverTree:
    """Points by level: a node has child nodes, or single points."""

    def __init__(self, at: np.ndarray, labels: np.ndarray, ids: list[list[int]]):
        self.norms = np.sqrt((at * at).sum(axis=1))
        self.most = float(self.norms.max())
        self.labels, self.ids = labels, ids
        whole = np.hstack([at, np.sqrt(np.maximum(self.most**2 - self.norms**2, 0))[:, None]])
        self.root = int(np.argmin(((whole - whole.mean(axis=0)) ** 2).sum(axis=1)))
        away = self._distances(whole, np.arange(len(at)), self.root)
        self.radius = float(away.max())
        child_point: list[np.ndarray] = []
        child_node: list[np.ndarray] = []
        child_radius: list[np.ndarray] = []
        spans: list[tuple[int, int]] = []
        waiting, total, made = [(np.arange(len(at)), self.root, away)], 0, 1
        while waiting:
            following = []
            for members, center, away in waiting:  # the nodes of a level, in the order of their numbers
                groups = self._cover(whole, members, center, away)
                nodes = []
                for _, rows, _ in groups:
                    nodes.append(made if len(rows) > 1 else -1)
                    made += len(rows) > 1
                child_point.append(np.array([g[0] for g in groups]))
                child_node.append(np.array(nodes))
                child_radius.append(np.array([g[2].max() for g in groups]))
                spans.append((total, total + len(groups)))
                total += len(groups)
                following += [(rows, middle, near) for middle, rows, near in groups if len(rows) > 1]
            waiting = following
        self.child_point, self.child_node, self.child_radius = map(np.concatenate, (child_point, child_node, child_radius))
        self.spans, self.at = np.array(spans), at

    @staticmethod
    def _distances(whole: np.ndarray, members: np.ndarray, center: int) -> np.ndarray:
        return np.sqrt(((whole[members] - whole[center]) ** 2).sum(axis=1))

    @classmethod
    def _cover(cls, whole: np.ndarray, members: np.ndarray, center: int, away: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(centre, members, their distances) of the children of a node."""
        largest = away.max()
        if len(members) <= LEAF_POINTS or largest == 0:
            return [(int(m), np.array([m]), np.zeros(1)) for m in members]
        scale = min(BASE ** (np.ceil(np.log(largest) / np.log(BASE)) - 1), 0.999 * largest)  # the level below
        centers, owner, near, own = [center], np.zeros(len(members), dtype=np.int64), away.copy(), whole[members]
        squares = (own * own).sum(axis=1)
        while near.max() > scale:
            new = int(members[near.argmax()])
            # cheap distances settle who is near whom; the radii are taken from exact differences below
            there = np.sqrt(np.maximum(squares + whole[new] @ whole[new] - 2 * (own @ whole[new]), 0))
            there[near.argmax()] = 0
            closer = there < near
            owner[closer], near[closer] = len(centers), there[closer]
            centers.append(new)
        order = np.argsort(owner, kind="stable")
        bounds = np.searchsorted(owner[order], np.arange(len(centers) + 1))
        rows = [members[order[a:b]] for a, b in zip(bounds, bounds[1:])]
        return [(c, r, cls._distances(whole, r, c)) for c, r in zip(centers, rows) if len(r)]

    def freeze(self) -> bytes:
        state = dict(self.__dict__)
        state["at"] = self.at.astype("<i4")
        return pickle.dumps(state, protocol=5)

    @classmethod
    def thaw(cls, data: bytes) -> CoverTree:
        made = cls.__new__(cls)
        made.__dict__.update(pickle.loads(data))
        made.at = made.at.astype(np.float64)[made.child_point]  # laid out as the children are
        made.laid = True
        made.single = made.at.astype(np.float32) if made.most**2 < 4 * SINGLE else None
        return made

    def search(self, q: np.ndarray, label: int, same: bool, lows: list[int], highs: list[int], k: int) -> list[list[tuple[int, int]]]:
        """Per window, the first k rows (score, id) with the label, or without it."""
        laid = self.at if getattr(self, "laid", False) else self.at[self.child_point]
        exact = None if self.most * np.linalg.norm(q) < EXACT else (laid.astype(np.int64), q.astype(np.int64))
        squared = float(q @ q)
        if getattr(self, "single", None) is not None and self.most * np.sqrt(squared) < SINGLE:
            laid, q = self.single, q.astype(np.float32)
        found: list[list[tuple[int, int]]] = [[] for _ in lows]
        open_from = np.array(lows, dtype=np.float64)
        ends = np.array(highs, dtype=np.float64)
        low, high = np.full(len(self.spans), -np.inf), np.full(len(self.spans), np.inf)
        heap, wide = [(-np.inf, 0)], 1
        seen = np.zeros(len(laid), dtype=bool)
        while heap and -heap[0][0] >= open_from.min():
            # the best node, then the next four, sixteen and so on together, each looked at again before it is opened
            best = np.array([heapq.heappop(heap)[1] for _ in range(min(wide, len(heap)))])
            wide *= 4
            held = best[((high[best][:, None] >= open_from) & (low[best][:, None] <= ends)).any(axis=1)]
            if not len(held):
                continue
            starts, sizes = self.spans[held, 0], self.spans[held, 1] - self.spans[held, 0]
            every = 4 * sizes.sum() > len(laid) and len(held) > 1
            if every:  # bounds tell little here: what is left is verified at once, without going down to it
                under, heap = np.flatnonzero(~seen), []
                score = (laid @ q if exact is None else exact[0] @ exact[1])[under]
            else:
                under = np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
                score = laid[under] @ q if exact is None else exact[0][under] @ exact[1]
                seen[under] = True
            child, rows = self.child_node[under], self.child_point[under]
            fits = (child < 0) & ((self.labels[rows] == label) == same) & (score >= open_from.min()) & (score <= ends.max())
            here = np.flatnonzero(fits)
            if len(here):
                mine, own = score[here], rows[here]
                for w in range(len(lows)):
                    inside = (mine >= open_from[w]) & (mine <= ends[w])
                    if inside.any():
                        self._keep(found[w], mine[inside], own[inside], k)
                        if len(found[w]) == k:
                            open_from[w] = max(open_from[w], found[w][-1][0])
            inner = np.flatnonzero(child >= 0) if not every else ()
            if len(inner):
                nodes = child[inner]
                low[nodes], high[nodes] = bounds(score[inner].astype(np.float64), self.child_radius[under][inner], self.most, squared)
                hit = ((high[nodes][:, None] >= open_from) & (low[nodes][:, None] <= ends)).any(axis=1)
                for node in nodes[hit]:
                    heapq.heappush(heap, (-float(high[node]), int(node)))
        return found

    def _keep(self, held: list[tuple[int, int]], score: np.ndarray, rows: np.ndarray, k: int) -> None:
        """Merge points into the first k rows. The first k rows come from the first k points by score and first id."""
        if len(score) > k:
            least = np.partition(score, len(score) - k)[len(score) - k]
            top = np.flatnonzero(score >= least)
            score, rows = score[top], rows[top]
        found = sorted((-int(s), self.ids[r][0], int(r)) for s, r in zip(score, rows))[:k]
        more = held + [(-s, i) for s, _, r in found for i in self.ids[r][:k]]
        more.sort(key=lambda x: (-x[0], x[1]))
        held[:] = more[:k]


def bounds(score: np.ndarray, radius: np.ndarray, most: np.ndarray | float, squared: np.ndarray | float) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score under nodes with these centre scores and radii; a little wide, for rounding."""
    whole = most**2 + squared
    away, reach = np.sqrt(np.maximum(whole - 2 * score, 0)), np.sqrt(squared) * radius
    high = np.minimum(score + reach, (whole - np.maximum(away - radius, 0) ** 2) / 2)
    low = np.maximum(score - reach, (whole - (away + radius) ** 2) / 2)
    slack = 1e-9 * whole + 1e-3
    return low - slack, high + slack


TREES = "tree long, labels array<long>, center binary, radius double, most double, data binary, point long, label long, vec binary, seed long"


def grown(pts: DataFrame, kept: int) -> DataFrame:
    """A row per tree (tree .. data), and one per asking point (tree, point, label, vec, seed: its last kept score in its own tree)."""
    chosen = bounded_sample(pts.select("point", "vec"), PIVOTS, "point").collect()
    pivots = pts.sparkSession.sparkContext.broadcast([r["vec"] for r in chosen])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = matrix(pa.array(pivots.value, pa.binary())) if pivots.value else np.zeros((0, 1))
        size = (held * held).sum(axis=1)
        for batch in filter(len, batches):
            cell = np.argmin(size - 2 * matrix(batch.column("vec")) @ held.T, axis=1)
            yield batch.append_column("cell", pa.array(cell.astype(np.int32)))

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for rows in _runs(batches, TREE_POINTS):
            at, labels = matrix(rows["vec"]), rows["label"].to_numpy()
            tree = CoverTree(at, labels, rows["ids"].to_pylist())
            frozen = tree.freeze()
            made = [{"tree": number, "labels": np.unique(labels).tolist(), "center": at[tree.root].astype("<i4").tobytes(), "radius": tree.radius, "most": tree.most, "data": frozen}]
            own, vec, point = CoverTree.thaw(frozen), rows["vec"], rows["point"].to_pylist()
            for row in np.flatnonzero(rows["asks"].to_numpy()):
                [best] = own.search(at[row], int(labels[row]), True, [-FAR], [FAR], kept)
                seed = best[-1][0] if len(best) == kept else -FAR
                made.append({"tree": number, "point": point[row], "label": int(labels[row]), "vec": vec[int(row)].as_py(), "seed": seed})
            yield pa.RecordBatch.from_pylist(made, schema=_TREES)
            number += 1

    kinds = {f.name: f.dataType.simpleString() for f in pts.schema}
    celled = pts.mapInArrow(near, ", ".join(f"{c} {k}" for c, k in kinds.items()) + ", cell int")
    celled = staged(celled, "negatives-cells")  # a range sort evaluates its input twice
    order = ["label", "cell", "point"]
    return staged(celled.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(grow, TREES), "negatives-trees")


_TREES = pa.schema(
    [("tree", pa.int64()), ("labels", pa.list_(pa.int64())), ("center", pa.binary()), ("radius", pa.float64()), ("most", pa.float64()), ("data", pa.binary())]
    + [("point", pa.int64()), ("label", pa.int64()), ("vec", pa.binary()), ("seed", pa.int64())]
)


def _runs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The rows of a stream, ``size`` at a time."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in filter(len, batches):
        held.append(batch)
        count += batch.num_rows
        while count >= size:
            rows = pa.Table.from_batches(held)
            yield rows.slice(0, size).combine_chunks()
            held, count = rows.slice(size).to_batches(), count - size
    if count:
        yield pa.Table.from_batches(held).combine_chunks()


QUERY = "point long, label long, vec binary, marks array<long>, lows array<long>, highs array<long>"


def visits(queries: DataFrame, trees: DataFrame, same: bool) -> DataFrame:
    """The queries with each tree that may hold something for them. Roots and queries meet in a grid of
    blocks; a root comes before the queries of its block and is held."""
    count = trees.count()
    side = max(1, -(-count // GRID))
    roots = trees.select("tree", "labels", "center", "radius", "most").withColumn("rows", F.pmod(F.xxhash64("tree"), F.lit(side)))
    roots = roots.withColumn("columns", F.explode(F.sequence(F.lit(0), F.lit(side - 1))))
    asks = queries.withColumn("columns", F.pmod(F.xxhash64("point"), F.lit(side)))
    asks = asks.withColumn("rows", F.explode(F.sequence(F.lit(0), F.lit(side - 1))))
    both = roots.unionByName(asks, allowMissingColumns=True).withColumn("asks", F.col("point").isNotNull())
    both = both.repartition("rows", "columns").sortWithinPartitions("rows", "columns", "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        block = None
        for rows in _by_kind(batches, ("rows", "columns", "asks")):
            if block != (block := (rows["rows"][0].as_py(), rows["columns"][0].as_py())):
                held = []
            if not rows["asks"][0].as_py():
                held.append(rows)
                continue
            if not held:
                continue
            known = pa.concat_tables(held)
            labels, at = known["labels"].to_pylist(), matrix(rows["vec"])
            squared = (at * at).sum(axis=1)[:, None]
            low, high = bounds(at @ matrix(known["center"]).T, known["radius"].to_numpy(), known["most"].to_numpy(), squared)
            # a tree is open to a query that may find its label there, or another
            own = rows["label"].to_pylist()
            has = {x: np.array([x in t if same else t != [x] for t in labels]) for x in set(own)}
            hit = np.zeros(high.shape, dtype=bool)
            for row, (lows, highs) in enumerate(zip(rows["lows"].to_pylist(), rows["highs"].to_pylist())):
                hit[row] = ((high[row][:, None] >= np.array(lows)) & (low[row][:, None] <= np.array(highs))).any(axis=1) & has[own[row]]
            queried, tree = np.nonzero(hit)
            if len(queried):
                going = rows.select(_QUERY).take(pa.array(queried)).add_column(0, "tree", known["tree"].take(pa.array(tree)))
                yield from going.combine_chunks().to_batches()

    return both.mapInArrow(run, f"tree long, {QUERY}")


_QUERY = ("point", "label", "vec", "marks", "lows", "highs")


def _by_kind(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Parts of batches with equal keys; a run may come in several parts."""
    for batch in batches:
        if batch.num_rows:
            rows = pa.Table.from_batches([batch])
            values = list(zip(*(batch.column(c).to_pylist() for c in keys)))
            starts = [0, *(k for k in range(1, len(values)) if values[k] != values[k - 1]), len(values)]
            for start, end in zip(starts, starts[1:]):
                yield rows.slice(start, end - start)


def searched(queries: DataFrame, trees: DataFrame, same: bool, k: int) -> DataFrame:
    """(point, mark, score, vec_id, line): the first k rows of each query's windows, over all trees."""
    going = visits(queries, trees, same)
    both = trees.select("tree", "data").unionByName(going, allowMissingColumns=True)
    both = both.withColumn("asks", F.col("point").isNotNull()).repartition("tree").sortWithinPartitions("tree", "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree: CoverTree | None = None
        for rows in _by_kind(batches, ("tree", "asks")):
            if not rows["asks"][0].as_py():
                data, tree = rows["data"][0].as_py(), None
                continue
            tree = tree or CoverTree.thaw(data)
            at = matrix(rows["vec"])
            columns = [rows[c].to_pylist() for c in ("point", "label", "marks", "lows", "highs")]
            made: list[tuple[int, int, int, int]] = []
            for q, point, label, marks, lows, highs in zip(at, *columns):
                for mark, best in zip(marks, tree.search(q, label, same, lows, highs, k)):
                    made += [(point, mark, score, vec_id) for score, vec_id in best]
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made)], names=["point", "mark", "score", "vec_id"])

    found = both.mapInArrow(run, "point long, mark long, score long, vec_id long")
    line = F.row_number().over(Window.partitionBy("point", "mark").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("line", line).where(F.col("line") <= k)


def mine(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score: for each anchor row and each of
    its best ``positives`` rows of the same label, the best ``negatives`` rows of other labels whose score
    is between ``low`` and ``high`` per cent of the positive's."""
    ship(vectors.sparkSession)
    rows = staged(packed(vectors, anchor), "negatives-rows")
    kept = positives + 1  # one may be the anchor itself
    pts = points(rows, kept)
    made = grown(pts, kept)
    trees = made.where("data is not null").select("tree", "labels", "center", "radius", "most", "data")
    asks = made.where("point is not null")
    one = lambda c: F.array(F.lit(c).cast("long")) if isinstance(c, int) else F.array(c)
    first = asks.select("point", "label", "vec", one(0).alias("marks"), one(F.col("seed")).alias("lows"), one(FAR).alias("highs"))
    best = staged(searched(first, trees, True, kept).select("point", "score", "vec_id"), "negatives-positives")
    scores = best.groupBy("point").agg(F.array_sort(F.collect_set("score")).alias("marks"))  # positives + 1 at most
    scores = scores.withColumn("marks", F.filter("marks", lambda s: s >= 0)).where(F.size("marks") > 0)
    # p per cent of s, rounded up or down, in whole numbers that stay small
    share = lambda s, p, up: ((s - s % 100) / 100).cast("long") * p + F.floor(((s % 100) * p + up) / 100).cast("long")
    least, most = F.transform("marks", lambda s: share(s, low, 99)), F.transform("marks", lambda s: share(s, high, 0))
    whole = asks.select("point", "label", "vec").join(scores, "point")
    second = whole.select("point", "label", "vec", "marks", least.alias("lows"), most.alias("highs"))
    hard = staged(searched(second, trees, False, negatives), "negatives-found")
    # back to rows: an anchor leaves out itself, if it is among the first
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id")))
    lists = best.groupBy("point").agg(ordered.alias("best"))
    named = pts.where("asks").select("point", F.col("label").alias("_label"), F.col("vec").alias("_vec")).join(lists, "point")
    anchors = rows.where("anchor").select(F.col("vec_id").alias("anchor_id"), "label", "vec", "own")
    each = anchors.join(named, (F.col("label") == F.col("_label")) & (F.col("vec") == F.col("_vec")))
    each = each.select("anchor_id", "point", "own", "best")
    at = F.array_position("best", F.struct((-F.col("own")).alias("minus"), F.col("anchor_id").alias("vec_id")))
    left = F.filter("best", lambda x, i: (at == 0) | (i != at - 1))
    each = each.select("anchor_id", "point", F.explode(F.slice(left, 1, positives)).alias("positive"))
    each = each.select("anchor_id", "point", F.col("positive.vec_id").alias("positive_id"), (-F.col("positive.minus")).alias("positive_score"))
    hard = hard.select(F.col("point").alias("_point"), "mark", F.col("line").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = each.join(hard, (F.col("point") == F.col("_point")) & (F.col("positive_score") == F.col("mark")))
    unnamed = lambda c: F.nullif(F.col(c), F.lit(NO_ID)).alias(c)
    return pairs.select("anchor_id", unnamed("positive_id"), "rank", unnamed("negative_id"), "positive_score", "negative_score")
