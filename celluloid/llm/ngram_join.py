"""Exact Jaccard join of n-gram sets, and the components of its links.

Two texts link when their sets of n-word shingles have a Jaccard similarity of at least
``percent`` / 100. All tests are on whole numbers: with ``d`` the size of the symmetric difference and
``p`` the percentage, ``100 * intersection >= p * union`` is ``d * (100 + p) <= (100 - p) * (m + n)``.

1. Every text is read once for the size, hash and parity sketch of its set, and for a histogram of
   all shingles by hash cell. Equal sets are one set from here on.
2. Every text is read again for its index entries. The histogram's levels and the hash give one order
   of all shingles, rare ones first; linked sets share a shingle among the first ones of both (the
   prefix), so only those are entered: (shingle, set, size, position).
3. Lists with one set are dropped. A list is sorted by size and cut into blocks by position; a block
   is skipped for a probing set when no entry at its positions and sizes can reach the threshold
   (what two sets can share from their first common shingle on is bounded by what is left of each).
   A list of up to ``SHORT_LIST`` entries yields its remaining pairs. A longer one is parted by the
   sketches, whose bits that differ are a lower bound of ``d`` and keep the triangle inequality: a
   pivot takes the sets that may link with it, and each other set that may link with one of these is
   paired with the nearest of them; sets that only share a frequent passage stay apart. Very long
   lists are dealt out in pairs of blocks.
4. Pairs are thinned by size and sketch, and the rest is checked on the sets themselves, computed
   again for the sets that still have a pair. A pivot pair also keeps its difference, the shingles
   that only one of the two has.
5. A pivot's answers give its neighbours' answers: the difference of two sets is the difference of
   their differences to the pivot, so two sets near one pivot are compared by a few shingles. Pairs
   that the triangle inequality decides are not compared at all, and sets that already hang together
   are skipped. Long groups are dealt out in pairs of blocks.
   The pivots' pairs and each set's nearest pair are checked first.
6. Components of the links by alternating large-star and small-star rounds. Pairs that are left count
   only where they join two components, and long lists whose sets are not yet in one component are gone
   through again for all pairs that may link across; those are checked and the components made anew. So no
   link between components is lost, and a group of near copies is not spelled out in pairs.

Edge cases: a null, empty or blank text has an empty set and links with nothing. A text of fewer than
n words has its whole word sequence as its one shingle. Null ids get a null component unless linked
to an id. Repeated rows are returned as often as they come, in one component (when they have words).
Empty tables give no rows. Only id and text are read; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from celluloid.llm.common import WordHashes, discard, mix, ship, staged

FILTER_BITS = 26  # of a bitmap of keys: 8 MB
CELL_BITS = 20  # cells of the histogram: the broadcast levels are one byte each
SLICES = 64
SKETCH_BITS = 1024  # at least; twice the size of the set
SHORT_LIST = 48
POSITION_BLOCK = 8
LIST_BLOCK = 4_096
PIECE = 8 << 20  # bytes of sketches that are compared at a time
GROUP_BLOCK = 2_048

BASE = "doc_id long, n long, set_id long, sketch binary, slice int, cells binary"
ENTRIES = "shingle long, set_id long, n int, position int"
PAIRS = "a long, b long, pivot boolean"


def shingles(text: str | None, hashes: WordHashes, width: int) -> np.ndarray:
    """Sorted distinct hashes of the lower-cased (A-Z) text's shingles; bytes.lower() changes A-Z only."""
    own = hashes.of(text.encode().lower()) if text else np.zeros(0, dtype=np.uint64)
    if not len(own):
        return own
    width = min(width, len(own))
    rolled = own[: len(own) - width + 1] + np.uint64(width)
    for shift in range(1, width):
        rolled = mix(rolled) * np.uint64(3) + own[shift : len(own) - width + 1 + shift]
    rolled = np.sort(mix(rolled))
    return rolled[np.diff(rolled, prepend=~rolled[:1]) != 0]


def set_hash(found: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(mix(found + np.uint64(0x5851F42D4C957F2D))) ^ mix(found.sum(keepdims=True))[0])


def sketch(found: np.ndarray) -> bytes:
    """Parity of the shingles that fall on each bit; two sets differ in at least the bits that differ.
    Larger sets have more bits, always a power of two: half a sketch laid on the other half is the
    sketch of half the bits."""
    size = max(SKETCH_BITS, 1 << int(2 * len(found) - 1).bit_length())
    odd = np.bincount((found & np.uint64(size - 1)).astype(np.intp), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


class Sketches:
    """Sketches of several sets, compared at the bits of the smaller."""

    def __init__(self, kept: list[bytes]):
        self.kept = kept
        self.widths = np.array([len(k) for k in kept], dtype=np.int64)
        self.folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def at(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Sketches of at least this width in bytes, folded to it, and the place of each row's."""
        if width not in self.folded:
            wide = np.flatnonzero(self.widths >= width)
            made = np.zeros((len(wide), width // 8), dtype=np.uint64)
            for place, row in enumerate(wide):
                made[place] = np.bitwise_xor.reduce(np.frombuffer(self.kept[row], dtype=np.uint64).reshape(-1, width // 8), axis=0)
            self.folded[width] = made, np.cumsum(self.widths >= width) - 1
        return self.folded[width]

    def differing(self, left: np.ndarray, right: np.ndarray, widest: int | None = None) -> np.ndarray:
        """Differing bits of each pair of rows; at ``widest`` bytes at most."""
        width = np.minimum(self.widths[left], self.widths[right])
        width = width if widest is None else np.minimum(width, widest)
        least = np.zeros(len(width), dtype=np.int64)
        for own in np.unique(width):
            bits, place = self.at(int(own))
            rows = np.flatnonzero(width == own)
            for part in np.array_split(rows, -(-len(rows) * int(own) // PIECE)):
                least[part] = np.bitwise_count(bits[place[left[part]]] ^ bits[place[right[part]]]).sum(axis=1, dtype=np.int64)
        return least


def cells(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - CELL_BITS)).astype(np.intp)


def links(m: int | np.ndarray, n: int | np.ndarray, difference: int | np.ndarray, percent: int):
    return difference * (100 + percent) <= (100 - percent) * (m + n)


def least_shared(m, n, percent: int):
    """Shingles that two linked sets of these sizes share at least."""
    return -(-percent * (m + n) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.uint64).view(np.int64))


def base_rows(docs: DataFrame, width: int) -> DataFrame:
    """A row per document (n, set_id, sketch), and per task the histogram in slices (slice, cells)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, histogram = WordHashes(), np.zeros(1 << CELL_BITS, dtype=np.uint32)
        held, waiting = [np.zeros(0, dtype=np.intp)], 0
        for batch in batches:
            sizes, ids, sketches = [], [], []
            for text in batch.column("text"):
                found = shingles(text.as_py(), hashes, width)
                sizes.append(len(found))
                ids.append(set_hash(found) if len(found) else 0)
                sketches.append(sketch(found) if len(found) else None)
                held.append(cells(found))
                waiting += len(found)
                if waiting >= 1 << 20:
                    histogram += np.bincount(np.concatenate(held), minlength=1 << CELL_BITS).astype(np.uint32)
                    held, waiting = [np.zeros(0, dtype=np.intp)], 0
            empty = pa.nulls(len(sizes))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    _signed(np.array(ids, dtype=np.uint64)),
                    pa.array(sketches, pa.binary()),
                    empty.cast(pa.int32()),
                    empty.cast(pa.binary()),
                ],
                names=["doc_id", "n", "set_id", "sketch", "slice", "cells"],
            )
        histogram += np.bincount(np.concatenate(held), minlength=1 << CELL_BITS).astype(np.uint32)
        if histogram.any():
            parts = [part.tobytes() for part in np.split(histogram, SLICES)]
            nothing = pa.nulls(SLICES)
            yield pa.RecordBatch.from_arrays(
                [*(nothing.cast(t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())), pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())],
                names=["doc_id", "n", "set_id", "sketch", "slice", "cells"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, BASE)


def levels(base: DataFrame) -> np.ndarray:
    """Level of each cell: 0 for cells near the mean, then one more for each factor of about 1.4."""

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << CELL_BITS) // SLICES, dtype=np.uint64)
        for batch in batches:
            for part in batch.column("cells"):
                total += np.frombuffer(part.as_buffer(), dtype=np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["slice", "cells"])

    rows = base.where("slice is not null").select("slice", "cells").groupBy("slice").applyInArrow(_by_batches(add), "slice int, cells binary").collect()
    if not rows:
        return np.zeros(1 << CELL_BITS, dtype=np.uint8)
    counts = np.concatenate([np.frombuffer(r["cells"], dtype=np.uint64) for r in sorted(rows, key=lambda r: r["slice"])])
    over = counts / (counts.mean() + 4 * np.sqrt(counts.mean()) + 1)
    return np.where(over > 1, 1 + np.floor(2 * np.log2(np.maximum(over, 1))), 0).astype(np.uint8)


def _by_batches(add):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(add(key, iter(group.to_batches()))))

    return run


def entries(docs: DataFrame, level: np.ndarray, first: Broadcast, width: int, percent: int) -> DataFrame:
    """Index entries of every set's prefix, from the documents whose id may be the first of a set. Copies would
    only repeat them; those that the bitmap lets through do."""
    held = docs.sparkSession.sparkContext.broadcast(level)  # 1 MB at any size of the input
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            made: list[tuple[np.ndarray, int, int]] = []
            bit = np.asarray(batch.column("bit"))
            may = (first.value[np.asarray(batch.column("part")) * 4096 + (bit >> 3)] >> (bit & 7).astype(np.uint8)) & 1 == 1
            may |= np.asarray(batch.column("doc_id").is_null())
            for text, can in zip(batch.column("text"), may):
                found = shingles(text.as_py(), hashes, width) if can else ()
                if len(found):
                    leading = np.argsort(held.value[cells(found)], kind="stable")[: prefix_length(len(found), percent)]
                    made.append((found[leading], set_hash(found), len(found)))
            if made:
                sizes = [len(m[0]) for m in made]
                yield pa.RecordBatch.from_arrays(
                    [
                        _signed(np.concatenate([m[0] for m in made])),
                        _signed(np.repeat(np.array([m[1] for m in made], dtype=np.uint64), sizes)),
                        pa.array(np.repeat([m[2] for m in made], sizes).astype(np.int32)),
                        pa.array(np.concatenate([np.arange(s, dtype=np.int32) for s in sizes])),
                    ],
                    names=["shingle", "set_id", "n", "position"],
                )

    placed = docs.select("doc_id", "text", F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("bit"))
    return placed.mapInArrow(run, ENTRIES)


def list_pairs(ids: np.ndarray, sizes: np.ndarray, positions: np.ndarray, percent: int) -> list[tuple[int, int, bool]]:
    """Candidate pairs of one list, its blocks skipped by position and size."""
    order = np.lexsort((ids, sizes, positions // POSITION_BLOCK))
    ids, sizes, positions = ids[order], sizes[order], positions[order]
    left = sizes - positions  # what a set can share from this shingle on
    block_of = positions // POSITION_BLOCK
    starts = np.flatnonzero(np.append(True, np.diff(block_of) != 0))
    ends = np.append(starts[1:], len(ids))
    found = []
    for i in range(len(ids)):
        for start, end in zip(starts, ends):
            if end <= i + 1:
                continue
            inside = slice(max(start, i + 1), end)
            most, smallest = left[inside].max(), sizes[inside].min()
            if min(left[i], most) < least_shared(sizes[i], smallest, percent):
                continue  # the whole block
            can = np.minimum(left[i], left[inside]) >= least_shared(sizes[i], sizes[inside], percent)
            for other in ids[inside][can]:
                a, b = sorted((int(ids[i]), int(other)))
                found.append((a, b, False))
    return found


def bitmap(keys: DataFrame, column: str) -> Broadcast:
    """Bits of the hashes of a column: an inexact filter of fixed size (2 ** FILTER_BITS bits)."""
    place = F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS))
    rows = keys.select(F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("bit"))
    parts = rows.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()  # 4 kB each, 2 ** (FILTER_BITS - 15) at most
    made = np.zeros((((1 << FILTER_BITS) >> 15) + 1, 4096), dtype=np.uint8)
    for row in parts:
        made[row["part"]] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    return keys.sparkSession.sparkContext.broadcast(made.reshape(-1))


def among(rows: DataFrame, column: str, held: Broadcast) -> DataFrame:
    """The rows whose column may be one of the bitmap's keys."""
    place = F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS))
    placed = rows.withColumn("_part", F.bitmap_bucket_number(place)).withColumn("_bit", F.bitmap_bit_position(place))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = np.asarray(batch.column("_bit"))
            byte = np.asarray(batch.column("_part")) * 4096 + (bit >> 3)
            may = (held.value[byte] >> (bit & 7).astype(np.uint8)) & 1 == 1
            yield batch.select(batch.schema.names[:-2]).filter(pa.array(may))

    return placed.mapInArrow(run, rows.schema)


def index_lists(entry: DataFrame) -> DataFrame:
    """The lists (shingle, set_id, n, position, entries, low: smallest set) of shingles that more than one entry has."""
    # most lists have one entry and end here: they are counted before the shuffle, and the entries of the
    # others are picked out by a bitmap before they are shuffled for the exact join
    shared = entry.groupBy("shingle").agg(F.count("*").alias("entries")).where(F.col("entries") > 1).withColumnRenamed("shingle", "key")
    shared = staged(shared, "ngram-shared")
    picked = among(entry, "shingle", bitmap(shared, "key"))
    members = picked.join(shared, F.col("shingle") == F.col("key")).select("shingle", "set_id", "n", "position", "entries").distinct()
    # the join has brought each list together, so its smallest set costs no shuffle
    members = members.withColumn("low", F.min("set_id").over(Window.partitionBy("shingle")))
    return staged(members, "ngram-lists")


def short_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of the lists with few entries. Lists with the same smallest set meet in a task, which gives a
    pair that several of them have only once."""
    short = members.where(F.col("entries") <= SHORT_LIST)
    # a set is the smallest of no more lists than its prefix has shingles
    ordered = short.repartition("low").sortWithinPartitions("low", "shingle").select("low", "shingle", "set_id", "n", "position")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None
        for batch in batches:
            columns = [np.asarray(batch.column(i)) for i in range(5)]
            if rest is not None:
                columns = [np.concatenate(x) for x in zip(rest, columns)]
            last = int(np.searchsorted(columns[0], columns[0][-1]))  # the last set's lists may go on
            rest = [c[last:] for c in columns]
            yield _pairs_of([c[:last] for c in columns], percent)
        if rest is not None:
            yield _pairs_of(rest, percent)

    return ordered.mapInArrow(run, PAIRS)


def long_lists(members: DataFrame) -> DataFrame:
    """(list, set_id, sets) of the lists with many entries, numbered; numbers compress, hashes do not."""
    long = members.where(F.col("entries") > SHORT_LIST).select("shingle", "set_id")  # copies count as entries here
    counts = long.groupBy("shingle").agg(F.count("*").alias("sets")).where("sets > 1")
    counts = staged(counts.withColumn("list", F.monotonically_increasing_id()), "ngram-long-lists").withColumnRenamed("shingle", "key")
    return staged(long.join(counts, F.col("shingle") == F.col("key")).select("list", "set_id", "sets"), "ngram-long")


def star_pairs(known: DataFrame, sets: DataFrame, percent: int, groups: DataFrame | None = None) -> DataFrame:
    """Pairs from long lists. Without groups: pivots with the sets they take, and other sets with the
    nearest of these. With groups (set_id, component): all that may link across components."""
    # a set's long lists, as many as its prefix has shingles at most: a pair is left to the first list of both
    if groups is None:
        lists = known.select("set_id").distinct().withColumns({"lists": F.lit(None).cast("array<long>"), "component": F.lit(None).cast("long")})
    else:
        lists = known.groupBy("set_id").agg(F.array_sort(F.collect_list("list")).alias("lists"))
        named = groups.select(F.col("node"), "component")
        lists = lists.join(named, F.col("set_id") == F.col("node"), "left").select("set_id", "lists", F.coalesce("component", "set_id").alias("component"))
    lists = staged(lists, "ngram-long-sets")
    of_sets = among(sets, "set_id", bitmap(lists, "set_id")).join(lists, "set_id").select(F.col("set_id").alias("own_id"), "n", "sketch", "lists", "component")
    near = known.join(of_sets, F.col("set_id") == F.col("own_id"))
    if groups is not None:
        near = staged(near, "ngram-across")
        mixed = near.groupBy("list").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
        near = near.join(mixed.select("list"), "list", "left_semi")
    blocks = F.ceil(F.col("sets") / LIST_BLOCK).cast("int")
    own, every = F.pmod(F.xxhash64("set_id"), blocks).cast("int"), F.sequence(F.lit(0), blocks - 1)
    # a set leads from its own block against each, and replies from it to each; in a single block it does both
    role = lambda lead, reply, leads: F.struct(lead.alias("lead"), reply.alias("reply"), F.lit(leads).alias("leads"))
    many = F.concat(F.transform(every, lambda k: role(own, k, 1)), F.transform(every, lambda k: role(k, own, 2)))
    one = F.array(role(F.lit(0), F.lit(0), 3))
    dealt = near.withColumn("role", F.explode(F.when(blocks > 1, many).otherwise(one)))
    dealt = dealt.select("list", "role.*", "set_id", "n", "sketch", "lists", "component")

    def run(key: tuple, group: pa.Table) -> pa.Table:
        found = stars(group, key[0].as_py(), percent)
        kinds = (pa.int64(), pa.int64(), pa.bool_())
        return pa.table([pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)], names=["a", "b", "pivot"])

    return dealt.groupBy("list", "lead", "reply").applyInArrow(run, PAIRS)


def stars(group: pa.Table, number: int, percent: int) -> list[tuple[int, int, bool]]:
    """(a, b, pivot). A pivot is the first set that no pivot has taken yet; it takes those that may link
    with it. Sets that may link with one of these differ from the pivot by at most the two bounds together;
    each is paired with the nearest of them. When components are known, these pairs are instead all that
    may link across components, in the pivot's group and out of it, each left to the first of the long
    lists that have both."""
    leads = group["leads"].to_numpy()  # 1: leads, 2: replies, 3: both
    ids, sizes = group["set_id"].to_numpy(), group["n"].to_numpy()
    order = np.lexsort((ids, sizes))
    leads, ids, sizes = leads[order], ids[order], sizes[order]
    kept = group["sketch"].to_pylist()
    sketches = Sketches([kept[k] for k in order])
    across = group["component"].null_count == 0
    if across:
        column = group["lists"].combine_chunks()
        offsets, values = np.asarray(column.offsets), np.asarray(column.values)
        lists = [values[offsets[k] : offsets[k + 1]] for k in order]
    component = group["component"].to_numpy()[order] if across else None
    lead, reply = np.flatnonzero(leads & 1), np.flatnonzero(leads & 2)
    bound = lambda m, n: (100 - percent) * (m + n) // (100 + percent)
    taken = np.zeros(len(lead), dtype=bool)
    owner: dict[int, int] = {}
    found = []

    def apart(row: int, rows: np.ndarray, widest: int | None = None) -> np.ndarray:
        return np.maximum(sketches.differing(np.full(len(rows), row), rows, widest), np.abs(sizes[rows] - sizes[row]))

    for place, row in enumerate(lead):
        if taken[place]:
            continue
        open_rows = place + np.flatnonzero(~taken[place:])
        mine = open_rows[apart(row, lead[open_rows]) <= bound(sizes[row], sizes[lead[open_rows]])]
        taken[mine] = True
        pivot = int(ids[row])
        own = lead[mine]
        owner.update((int(i), pivot) for i in ids[own])
        most = 100 * sizes[row] // percent + 1  # largest set that may link with the pivot
        # the triangle inequality holds at the width of the narrowest of the three sketches
        widest = int(sketches.widths[own].min())
        others = reply[apart(row, reply, widest) <= bound(sizes[row], most) + bound(most, sizes[reply])]
        if across:
            inside = others[[owner.get(int(i)) in (None, pivot) for i in ids[others]]]
            for member in own:
                near = inside[(component[inside] != component[member]) & (ids[inside] != ids[member])]
                for row_near in near[apart(member, near) <= bound(sizes[member], sizes[near])]:
                    earlier = lists[row_near][: np.searchsorted(lists[row_near], number)]
                    if not np.isin(earlier, lists[member]).any():
                        a, b = sorted((int(ids[member]), int(ids[row_near])))
                        found.append((a, b, False))
            continue
        found += [(pivot, int(i), True) for i in ids[own] if i != pivot]
        # sets of earlier pivots were paired when those took them
        others = others[[int(i) not in owner for i in ids[others]]]
        if not len(others):
            continue
        nearest, least = np.full(len(others), -1), np.full(len(others), np.iinfo(np.int64).max)
        for member in own:
            distance = apart(member, others)
            better = (distance <= bound(sizes[member], sizes[others])) & (distance < least)
            nearest[better], least[better] = member, distance[better]
        for member, other in zip(nearest, others):
            if member >= 0:
                a, b = sorted((int(ids[member]), int(ids[other])))
                found.append((a, b, False))
    return found


def _pairs_of(columns: list[np.ndarray], percent: int) -> pa.RecordBatch:
    found: dict[tuple[int, int, bool], None] = {}
    bounds = np.flatnonzero(np.concatenate([[True], np.diff(columns[1]) != 0, [True]])) if len(columns[1]) else []
    for start, end in zip(bounds[:-1], bounds[1:]):
        if end - start > 1:
            found.update(dict.fromkeys(list_pairs(columns[2][start:end], columns[3][start:end], columns[4][start:end], percent)))
    rows = list(found)
    return pa.RecordBatch.from_arrays(
        [pa.array([f[k] for f in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.bool_()))], names=["a", "b", "pivot"]
    )


def thinned(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with sizes (m, n) and differing bits, without those whose sizes or sketches rule a link out; pivot pairs stay."""
    ids = staged(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ngram-pair-ids")
    sets = among(sets, "set_id", bitmap(ids, "id"))
    side = lambda key, size, bits: sets.select(F.col("set_id").alias(key), F.col("n").alias(size), F.col("sketch").alias(bits))
    both = pairs.join(side("a", "m", "bits_a"), "a").join(side("b", "n", "bits_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.arange(batch.num_rows)
            both_sides = Sketches([*batch.column("bits_a").to_pylist(), *batch.column("bits_b").to_pylist()])
            least = both_sides.differing(rows, rows + batch.num_rows)
            m, n = np.asarray(batch.column("m")), np.asarray(batch.column("n"))
            can = links(m, n, np.maximum(least, np.abs(m - n)), percent) | np.asarray(batch.column("pivot").to_numpy(zero_copy_only=False))
            kept = batch.select(["a", "b", "pivot", "m", "n"]).append_column("least", pa.array(least, pa.int64()))
            yield kept.filter(pa.array(can))

    return both.select("a", "b", "pivot", "m", "n", "bits_a", "bits_b").mapInArrow(run, "a long, b long, pivot boolean, m long, n long, least long")


def nearest(pairs: DataFrame) -> DataFrame:
    """Pivot pairs, and of the others each set's pair with the fewest differing bits."""
    ends = pairs.where(~F.col("pivot")).select(F.explode(F.array("a", "b")).alias("id"), F.struct("least", "a", "b").alias("pair"))
    best = ends.groupBy("id").agg(F.min("pair").alias("pair")).select("pair.a", "pair.b").distinct()
    return pairs.where("pivot").unionByName(pairs.where(~F.col("pivot")).join(best, ["a", "b"], "left_semi"))


def apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs whose sets are not in one component."""
    side = lambda key, name: groups.select(F.col("node").alias(key), F.col("component").alias(name))
    named = pairs.join(side("a", "_a"), "a", "left").join(side("b", "_b"), "b", "left")
    return named.where(~F.coalesce("_a", "a").eqNullSafe(F.coalesce("_b", "b"))).select(*pairs.columns)


def set_rows(docs: DataFrame, base: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """(set_id, text) of the sets that have a pair, from the first document of each. Documents are picked
    by a bitmap of ids first; the exact choice is the later join. Texts compress, hashes of shingles do
    not, so it is texts that are shuffled."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    first = base.where("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("doc_id")).join(wanted, "set_id", "left_semi")
    places = among(docs, "doc_id", bitmap(first, "doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            ids = [set_hash(found) if len(found := shingles(t.as_py(), hashes, width)) else None for t in batch.column("text")]
            known = pa.array([i is not None for i in ids])
            signed = _signed(np.array([i for i in ids if i is not None], dtype=np.uint64))
            yield pa.RecordBatch.from_arrays([signed, batch.column("text").filter(known)], names=["set_id", "text"])

    return staged(places.mapInArrow(run, "set_id long, text string"), "ngram-texts-of-pairs")


def checked(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs with ``linked``; pivot pairs also with the difference of the two sets."""
    left = texts.select(F.col("set_id").alias("a"), F.col("text").alias("of_a"))
    right = texts.select(F.col("set_id").alias("b"), F.col("text").alias("of_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "pivot", "m", "n", "of_a", "of_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        last, own = None, np.zeros(0, dtype=np.uint64)
        for batch in batches:
            a, m, n = (np.asarray(batch.column(c)) for c in ("a", "m", "n"))
            pivot = batch.column("pivot").to_pylist()
            linked, differences = [], []
            for row in range(batch.num_rows):
                if last != a[row]:  # rows of one set mostly follow each other
                    last, own = a[row], shingles(batch.column("of_a")[row].as_py(), hashes, width)
                other = shingles(batch.column("of_b")[row].as_py(), hashes, width)
                difference = np.setxor1d(own, other, assume_unique=True)
                linked.append(bool(links(int(m[row]), int(n[row]), len(difference), percent)))
                differences.append(difference.view(np.int64) if pivot[row] else None)
            kept = [pa.array(linked, pa.bool_()), pa.array(differences, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "pivot", "n")), *kept], names=["a", "b", "pivot", "n", "linked", "difference"])

    tested = both.mapInArrow(run, "a long, b long, pivot boolean, n long, linked boolean, difference array<long>")
    return tested.dropDuplicates(["a", "b"])  # a set is there twice when documents share an id


def derived(pivots: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among the sets near one pivot, from their differences to it.

    Sets that link to the pivot hang together already; each of the others is held against all of its
    group, in pairs of blocks.
    """
    counts = pivots.groupBy("a").agg(F.count("*").alias("members"), F.sum(F.when(~F.col("linked"), 1).otherwise(0)).alias("loose"))
    counts = counts.where("loose > 0 and members > 1").select(F.col("a").alias("pivot_id"), "members", "loose")
    near = pivots.join(counts, F.col("a") == F.col("pivot_id")).select("pivot_id", "b", "n", "linked", "difference", "members", "loose")
    blocks = lambda c: F.ceil(F.col(c) / GROUP_BLOCK).cast("int")
    block = lambda c: F.pmod(F.xxhash64("b"), blocks(c)).cast("int")
    # a loose set probes from its own block; every set answers in all of them
    probing = near.where(~F.col("linked")).withColumn("probe", block("loose")).withColumn("reply", F.explode(F.sequence(F.lit(0), blocks("members") - 1)))
    answering = near.withColumn("reply", block("members")).withColumn("probe", F.explode(F.sequence(F.lit(0), blocks("loose") - 1)))
    rows = probing.withColumn("probes", F.lit(True)).unionByName(answering.withColumn("probes", F.lit(False)))
    rows = rows.select("pivot_id", "probe", "reply", "probes", "b", "n", "linked", "difference")

    def run(key: tuple, group: pa.Table) -> pa.Table:
        found = derive(group, percent)
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return rows.groupBy("pivot_id", "probe", "reply").applyInArrow(run, "a long, b long")


def derive(group: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links that join what does not hang together yet."""
    probes = np.asarray(group["probes"].to_numpy())
    ids, sizes = np.asarray(group["b"].to_numpy()), np.asarray(group["n"].to_numpy())
    linked = np.asarray(group["linked"].to_numpy())
    lists = group["difference"].combine_chunks()
    offsets, values = np.asarray(lists.offsets), np.asarray(lists.values)
    width = np.diff(offsets)
    answers = np.flatnonzero(~probes)
    numbers = {int(i): k for k, i in enumerate(np.unique(ids))}
    parent = list(range(len(numbers) + 1))  # the last stands for the pivot

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for row in answers[linked[answers]]:
        parent[root(numbers[int(ids[row])])] = root(len(numbers))
    # an inverted index of the differences
    picked = np.concatenate([np.arange(offsets[r], offsets[r + 1]) for r in answers]) if len(answers) else np.zeros(0, dtype=int)
    owner = np.repeat(np.arange(len(answers)), width[answers])
    order = np.argsort(values[picked], kind="stable")
    sorted_values, sorted_owner = values[picked][order], owner[order]
    found = []
    for row in np.flatnonzero(probes):
        me = numbers[int(ids[row])]
        own, n = width[row], sizes[row]
        other_n, other = sizes[answers], width[answers]
        limit = (100 - percent) * (n + other_n) // (100 + percent)
        open_rows = (np.abs(own - other) <= limit) & (np.abs(n - other_n) <= limit) & (ids[answers] != ids[row])
        sure = open_rows & (own + other <= limit)
        if not open_rows.any():
            continue
        mine = values[offsets[row] : offsets[row + 1]]
        low, high = np.searchsorted(sorted_values, mine, "left"), np.searchsorted(sorted_values, mine, "right")
        shared = np.zeros(len(answers), dtype=np.int64)
        if not (sure == open_rows).all():
            hit = np.concatenate([sorted_owner[a:b] for a, b in zip(low, high)]) if len(mine) else np.zeros(0, dtype=int)
            shared = np.bincount(hit, minlength=len(answers))
        good = np.flatnonzero(sure | (open_rows & (own + other - 2 * shared <= limit)))
        for k in good:
            there = numbers[int(ids[answers[k]])]
            if root(me) != root(there):
                parent[root(me)] = root(there)
                found.append((int(ids[row]), int(ids[answers[k]])))
    return found


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): smallest node reachable, for each node of the edges (a, b). Large-star and
    small-star rounds; each ends in a written table."""
    pairs = staged(edges.select("a", "b").where("a <> b").distinct(), f"{name}-0")
    turn = 0
    while True:
        both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: neighbours above a node go to the smallest of its neighbours and itself
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")).withColumnRenamed("a", "node")
        large = both.join(least, F.col("a") == F.col("node")).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        # small star: a node and its smaller neighbours go to the smallest of them
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "node")
        small = down.join(low, F.col("a") == F.col("node"))
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b")).unionAll(low.select(F.col("node").alias("a"), F.col("low").alias("b")))
        turn += 1
        following = staged(small.where("a <> b").distinct(), f"{name}-{turn}")
        same = [x.agg(F.count("*").alias("c"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first() for x in (pairs, following)]
        pairs = following
        if same[0] == same[1]:
            break
    tops = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(tops)


def classes(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n, set_id and component (a set_id) of every document row; without words the last two are null."""
    texts = docs.select("doc_id", "text")
    base = staged(base_rows(texts, width), "ngram-base")
    level = levels(base)
    rows = base.where("n is not null")
    sets = rows.where("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    sets = staged(sets, "ngram-sets")
    entry = staged(entries(texts, level, bitmap(sets, "first_id"), width, percent), "ngram-entries")
    members = index_lists(entry)
    discard(entry)
    known = long_lists(members)
    found = short_pairs(members, percent).unionByName(star_pairs(known, sets, percent))
    found = staged(found.groupBy("a", "b").agg(F.max("pivot").alias("pivot")), "ngram-candidates")
    discard(members)
    near = staged(thinned(found, sets, percent), "ngram-pairs")
    discard(found)
    built = set_rows(texts, base, near, width)
    first = staged(nearest(near), "ngram-nearest")
    tested = staged(checked(first, built, width, percent), "ngram-checked")
    edges = staged(tested.where("linked").select("a", "b").unionByName(derived(tested.where("pivot"), percent)), "ngram-links")
    groups = components(edges, "ngram-components")
    # sets that hang together by now need no more pairs; what may link across is held together at last
    across = thinned(star_pairs(known, sets, percent, groups).distinct(), sets, percent)
    more = apart(near, groups).unionByName(across).dropDuplicates(["a", "b"]).join(tested.select("a", "b"), ["a", "b"], "left_anti")
    more = staged(more, "ngram-across-pairs")
    if not more.isEmpty():
        late = checked(more, built, width, percent).where("linked").select("a", "b")
        groups = components(edges.unionByName(staged(late, "ngram-across-links")), "ngram-all-components")
    named = groups.select("node", "component")
    told = rows.join(named, (F.col("n") > 0) & (F.col("set_id") == F.col("node")), "left")
    own = F.when(F.col("n") > 0, F.col("set_id"))
    return staged(told.select("doc_id", "n", own.alias("set_id"), F.coalesce("component", own).alias("component")), "ngram-classes")


def join(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest id reachable by links) of every document row."""
    ship(docs.sparkSession)
    told = classes(docs, width, percent)
    smallest = told.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id")).withColumnRenamed("component", "of")
    result = told.join(smallest, F.col("component") == F.col("of"), "left")
    return result.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def representatives(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """One row of each component, with all its columns: the one with the smallest id (nulls last), and of equal
    ids that with the smallest text hash. Rows without words stay. Texts count, not ids: of different texts
    under one id, or without an id, each stays that no other links with."""
    ship(docs.sparkSession)
    groups = classes(docs.select("doc_id", "text"), width, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "set_id"))
    heads = groups.where("set_id is not null").groupBy("component").agg(first.alias("head"))
    heads = staged(heads.select("head.doc_id", "head.set_id"), "ngram-heads")
    ids = staged(groups.groupBy("doc_id").agg(F.count("*").alias("rows")), "ngram-ids")
    # an id that one row has stands for its text
    wordless = groups.where("set_id is null").select("doc_id")
    plain = heads.select("doc_id").unionByName(wordless).join(ids.where("rows = 1"), "doc_id", "left_semi")
    kept = docs.join(plain, docs["doc_id"] == plain["doc_id"], "left_semi")
    shared = ids.where("doc_id is null or rows > 1").select("doc_id")
    if shared.isEmpty():
        return kept
    return kept.unionByName(_by_text(docs.join(shared, docs["doc_id"].eqNullSafe(shared["doc_id"]), "left_semi"), heads, width))


def _by_text(docs: DataFrame, heads: DataFrame, width: int) -> DataFrame:
    """The rows with the heads' ids and texts, each once, and those without words."""
    hashed = with_sets(docs, bitmap(heads, "doc_id"), width)
    heads = heads.select(F.col("doc_id").alias("id"), F.col("set_id").alias("set"))
    chosen = hashed.join(heads, (F.col("set_id") == F.col("set")) & F.col("doc_id").eqNullSafe(F.col("id")))
    # rows that repeat id and text: any of them, but only one, and the same in every run
    one = chosen.groupBy("set", "id").agg(F.min("row").alias("row"))
    return one.select("row.*").unionByName(hashed.where("set_id is null").select("row.*"))


def with_sets(docs: DataFrame, ids: Broadcast, width: int) -> DataFrame:
    """(row, doc_id, set_id) of the rows whose id may be in the bitmap, and of all without words; set_id is the hash of the
    text's shingle set, null where it is empty. The row is a struct, so its columns may have any names."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS))
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("bit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            bit = np.asarray(batch.column("bit"))
            may = (ids.value[np.asarray(batch.column("part")) * 4096 + (bit >> 3)] >> (bit & 7).astype(np.uint8)) & 1 == 1
            row = batch.column("row")
            keys, picked = [], []
            for place, (text, can) in enumerate(zip(row.field("text"), may)):
                text = text.as_py() if row[place].is_valid else None
                if can or not (text or "").encode().split():
                    found = shingles(text, hashes, width)
                    picked.append(place)
                    keys.append(int(np.uint64(set_hash(found)).astype(np.int64)) if len(found) else None)
            few = batch.take(pa.array(picked, pa.int64()))
            yield pa.RecordBatch.from_arrays([few.column("row"), few.column("doc_id"), pa.array(keys, pa.int64())], names=["row", "doc_id", "set_id"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"row {kinds['row']}, doc_id {kinds['doc_id']}, set_id long")
