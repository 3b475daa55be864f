"""Keyed mutations as table-to-table transforms.

Rows that carry one number of arrival (``ARRIVAL``, given once when they are staged) are folded by it: per key the
winning numbers are a fixed-width hash aggregate, and the rows are picked by them. Stored rows have each key once
already, so they meet the winners in a join and are not aggregated again. Rows with a null in the key are groups of
their own in the same pass.

With ``cut``, rows that are numbered by arrival are folded where a stored table wants them: stored and incoming rows are
cut by range of the key in the only exchange, and the rows of a key, which meet in one task, settle there in a window.
That is for tables that are written as they then lie; a key with very many rows is not combined before it is moved.
Rows with several order columns are upserted so, too: they need no number, which takes a sort of all rows to give.

Rows with several order columns are folded by structs: each mutation is one aggregation over ``existing`` and ``incoming`` with map-side combine: repeats of a key
collapse before the shuffle, so a key that holds a third of the rows arrives as one row per task.
Existing rows come before incoming ones; among incoming rows ``order`` decides, and must be a total
order per key (file, block, line). A row with a null in its key never conflicts with another, so
such rows pass by the aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ARRIVAL = "_arrival"


def _dense(order: Sequence[str]) -> bool:
    return list(order) == [ARRIVAL]


def _marks(incoming: DataFrame, keys: Sequence[str], nullable: Sequence[str], **aggregates: Column) -> DataFrame:
    """Fixed-width aggregates per key; a row with a null key column is a group of its own."""
    alone = F.lit(None).cast("long")
    for c in nullable:
        alone = F.when(F.col(c).isNull(), F.col(ARRIVAL)).otherwise(alone)
    named = [a.alias(name) for name, a in aggregates.items()]
    return incoming.groupBy(*keys, alone.alias("_alone")).agg(*named).drop("_alone")


def _picked(incoming: DataFrame, marks: DataFrame, mark: str) -> DataFrame:
    """The rows whose arrival is a mark."""
    return incoming.join(marks.select(F.col(mark).alias(ARRIVAL)), ARRIVAL, "left_semi")


def _unmatched(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the others do not have; nulls match nothing."""
    return rows.join(others.select(*keys), list(keys), "left_anti").select(*rows.columns)


def _upsert_dense(existing, incoming, keys, nullable):
    won = _picked(incoming, _marks(incoming, keys, nullable, last=F.max(ARRIVAL)), "last").drop(ARRIVAL)
    return won if existing is None else _unmatched(existing.select(*won.columns), won, keys).unionByName(won)


def _insert_dense(existing, incoming, keys, nullable):
    first = _picked(incoming, _marks(incoming, keys, nullable, first=F.min(ARRIVAL)), "first").drop(ARRIVAL)
    return first if existing is None else existing.select(*first.columns).unionByName(_unmatched(first, existing, keys))


def _columns_dense(existing, incoming, keys, columns, nullable):
    order = [c for c in incoming.columns if c != ARRIVAL]
    kept = [c for c in order if c not in columns]
    marks = _marks(incoming, keys, nullable, first=F.min(ARRIVAL), last=F.max(ARRIVAL)).select("first", "last")
    first = incoming.select(*kept, F.col(ARRIVAL).alias("first")).join(marks, "first")
    last = incoming.select(*columns, F.col(ARRIVAL).alias("last"))
    fresh = first.join(last, "last").select(*order)
    if existing is None:
        return fresh
    told = fresh.select(*keys, F.struct(*columns).alias("_new"))
    # a stored row keeps its other columns
    changes = {c: F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)) for c in columns}
    stored = existing.select(*order).join(told, list(keys), "left").withColumns(changes).select(*order)
    return stored.unionByName(_unmatched(fresh, existing, keys))


def _merge_dense(existing, incoming, keys):
    order = [c for c in incoming.columns if c != ARRIVAL]
    rest = [c for c in order if c not in keys]
    known = {f"_at_{c}": F.max(F.when(F.col(c).isNotNull(), F.col(ARRIVAL))) for c in rest}
    marks = _marks(incoming, keys, (), **known)
    # the lines that still say something, for each column
    values = {c: F.when(F.col(ARRIVAL) == F.col(f"_at_{c}"), F.col(c)) for c in rest}
    said = incoming.join(marks, list(keys)).withColumns(values)
    silent = F.greatest(F.lit(-1), *(F.col(f"_at_{c}") for c in rest)) < 0  # a key of which no line says anything
    said = said.where(F.greatest(F.lit(False), *(F.col(c).isNotNull() for c in rest)) | silent)
    # at most one value is left of each column; a list of it is hashed, other text aggregates are sorted
    merged = said.groupBy(*keys).agg(*(F.try_element_at(F.collect_list(c), F.lit(1)).alias(c) for c in rest))
    if existing is None:
        return merged.select(*order)
    stored = existing.select(*keys, *(F.col(c).alias(f"_old_{c}") for c in rest))
    both = stored.join(merged, list(keys), "full_outer")
    return both.select(*(c if c in keys else F.coalesce(c, f"_old_{c}").alias(c) for c in order))


def _cut(existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str], nullable: Sequence[str]) -> DataFrame:
    """Both sides cut by range of the key; stored rows get negative numbers of arrival. Nulls match nothing: a row with
    a null in a nullable key column, or a stored one with any, is a group of its own."""
    columns = [c for c in incoming.columns if c != ARRIVAL]
    rows = incoming.select(*columns, ARRIVAL)
    if existing is not None:
        rows = existing.select(*columns, (F.lit(-1) - F.monotonically_increasing_id()).alias(ARRIVAL)).unionByName(rows)
    unknown = lambda names: F.greatest(F.lit(False), F.lit(False), *(F.col(c).isNull() for c in names))
    alone = unknown(nullable) | ((F.col(ARRIVAL) < 0) & unknown(keys))
    return rows.repartitionByRange(*keys).withColumn("_alone", F.when(alone, F.col(ARRIVAL)))


def _group(keys: Sequence[str]):
    return Window.partitionBy(*keys, "_alone")


def _upsert_cut(existing, incoming, keys, nullable):
    rows = _cut(existing, incoming, keys, nullable).withColumn("_last", F.max(ARRIVAL).over(_group(keys)))
    return rows.where((F.col(ARRIVAL) == F.col("_last")) | (F.col("_last") < 0)).drop(ARRIVAL, "_alone", "_last")


def _upsert_cut_by(existing, incoming, keys, order, nullable):
    columns = [c for c in incoming.columns if c not in order]
    rows = incoming.select(*columns, *order, F.lit(1).alias("_batch"))
    if existing is not None:
        first = [F.lit(None).cast(incoming.schema[c].dataType).alias(c) for c in order]
        rows = existing.select(*columns, *first, F.lit(0).alias("_batch")).unionByName(rows)
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in ("_batch", *order)]))
    alone = F.greatest(F.lit(False), F.lit(False), *(F.col(c).isNull() for c in nullable))
    cut = rows.repartitionByRange(*keys).withColumn("_nth", last)
    return cut.where((F.col("_nth") == 1) | alone).select(*columns)


def _insert_cut(existing, incoming, keys, nullable):
    rows = _cut(existing, incoming, keys, nullable).withColumn("_first", F.min(ARRIVAL).over(_group(keys)))
    return rows.where((F.col(ARRIVAL) == F.col("_first")) | (F.col(ARRIVAL) < 0)).drop(ARRIVAL, "_alone", "_first")


def _columns_cut(existing, incoming, keys, columns, nullable):
    marks = {"_first": F.min(ARRIVAL), "_last": F.max(ARRIVAL), "_new": F.max_by(F.struct(*columns), ARRIVAL)}
    rows = _cut(existing, incoming, keys, nullable).withColumns({c: a.over(_group(keys)) for c, a in marks.items()})
    # a stored row keeps its other columns
    changes = {c: F.when(F.col("_last") >= 0, F.col(f"_new.{c}")).otherwise(F.col(c)) for c in columns}
    kept = rows.where((F.col(ARRIVAL) < 0) | (F.col(ARRIVAL) == F.col("_first")))
    return kept.withColumns(changes).drop(ARRIVAL, "_alone", *marks)


def _stack(existing: DataFrame | None, incoming: DataFrame, order: Sequence[str]) -> DataFrame:
    """Both sides under one order column ``_at``; existing rows sort first."""
    columns = [c for c in incoming.columns if c not in order]
    at = F.struct(*[F.col(c) for c in order])
    new = incoming.select(*columns, F.struct(F.lit(1).alias("batch"), at.alias("at")).alias("_at"))
    if existing is None:
        return new
    first = F.struct(F.lit(0).alias("batch"), F.lit(None).cast(incoming.select(at).schema[0].dataType).alias("at"))
    return existing.select(*columns, first.alias("_at")).unionByName(new)


def _fold(
    stacked: DataFrame, keys: Sequence[str], nullable: Sequence[str], aggregates: list[Column]
) -> DataFrame:
    """Aggregate per key; rows with a null key column stay as they are."""
    columns = [c for c in stacked.columns if c != "_at"]
    if not nullable:
        folded = stacked.groupBy(*keys).agg(*aggregates)
        return folded.select(*[c for c in folded.columns if not c.startswith("_row")], *_rows(aggregates)).select(
            *columns
        )
    complete = F.lit(True)
    for c in nullable:
        complete = complete & F.col(c).isNotNull()
    return _fold(stacked.where(complete), keys, (), aggregates).unionByName(
        stacked.where(~complete).select(*columns)
    )


def _rows(aggregates: list[Column]) -> list[str]:
    return [f"_row{i}.*" for i in range(len(aggregates))]


def _pick(func, columns: Sequence[str], i: int) -> Column:
    return func(F.struct(*columns), F.col("_at")).alias(f"_row{i}")


def _rest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in keys and c not in order]


def upsert(
    existing: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    nullable: Sequence[str] = (),
    cut: bool = False,
) -> DataFrame:
    """Insert or overwrite: per key, the last row wins."""
    if _dense(order):
        return (_upsert_cut if cut else _upsert_dense)(existing, incoming, keys, nullable)
    if cut:
        return _upsert_cut_by(existing, incoming, keys, order, nullable)
    rest = _rest(incoming, keys, order)
    if not rest:
        return insert_ignore(existing, incoming, keys, order, nullable)
    return _fold(_stack(existing, incoming, order), keys, nullable, [_pick(F.max_by, rest, 0)])


def insert_ignore(
    existing: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    nullable: Sequence[str] = (),
    cut: bool = False,
) -> DataFrame:
    """Insert only unseen keys: per key, the first row wins."""
    if _dense(order):
        return (_insert_cut if cut else _insert_dense)(existing, incoming, keys, nullable)
    rest = _rest(incoming, keys, order)
    stacked = _stack(existing, incoming, order)
    picks = [_pick(F.min_by, rest, 0)] if rest else []
    if not picks and not nullable:
        return stacked.select(*keys).distinct()
    return _fold(stacked, keys, nullable, picks)


def upsert_columns(
    existing: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    nullable: Sequence[str] = (),
    cut: bool = False,
) -> DataFrame:
    """A conflict overwrites only ``columns``; all other columns keep their first value."""
    if _dense(order):
        return (_columns_cut if cut else _columns_dense)(existing, incoming, keys, columns, nullable)
    kept = [c for c in _rest(incoming, keys, order) if c not in columns]
    picks = [_pick(F.max_by, columns, 0)] + ([_pick(F.min_by, kept, 1)] if kept else [])
    return _fold(_stack(existing, incoming, order), keys, nullable, picks)


def merge_non_null(
    existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Per key and column, the last value that is not null."""
    if _dense(order):
        return _merge_dense(existing, incoming, keys)
    rest = _rest(incoming, keys, order)
    stacked = _stack(existing, incoming, order)
    # max_by skips rows whose order is null, so a null value must take its order with it
    latest = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_at"))).alias(c) for c in rest]
    return stacked.groupBy(*keys).agg(*latest).select(*[c for c in incoming.columns if c not in order])


def replace_children(
    existing: DataFrame,
    incoming: DataFrame,
    parents: DataFrame,
    parent: str,
    keys: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Drop all existing rows of the batch's parents, then add the batch, last row per key."""
    kept = existing.join(parents.select(parent), parent, "left_anti").select(*existing.columns)
    return kept.unionByName(upsert(None, incoming, keys, order))


def upsert_links(
    existing: DataFrame | None,
    incoming: DataFrame,
    local: str,
    remote: str,
    order: Sequence[str],
) -> tuple[DataFrame, DataFrame]:
    """One-to-one links: (links, rejects).

    Of the statements of a local id the last one counts. When several local ids then claim one remote
    id, the first of them keeps it and the others are rejects: a remote id that its local id has
    given up is free again.
    """
    columns = [c for c in incoming.columns if c not in order]
    rest = [c for c in columns if c != local]
    stacked = _stack(existing, incoming, order)
    last = stacked.groupBy(local).agg(F.max_by(F.struct(*rest, "_at"), F.col("_at")).alias("_row")).select(local, "_row.*")
    # both sums combine on the map side, so a remote id that many claim is one row per task
    others = [c for c in columns if c != remote]
    kept = last.groupBy(remote).agg(F.min_by(F.struct(*others), F.col("_at")).alias("_row")).select(remote, "_row.*")
    rejects = last.join(kept.select(local), local, "left_anti")
    return kept.select(*columns), rejects.select(*columns)


def clear_subject_claims(claims: DataFrame, subjects: DataFrame) -> DataFrame:
    """Claims without those of the given subjects."""
    key = "subject_wikidata_id"
    return claims.join(subjects.select(key), key, "left_anti").select(*claims.columns)


def apply_outcome(queue: DataFrame, outcome: DataFrame) -> DataFrame:
    """Write hydration results into the queue.

    ``outcome`` holds (export_artifact_id, tmdb_movie_id, error), one row per tried movie; a null
    error means success. Every try counts as an attempt; a failure keeps the former hydration time.
    """
    keys = ["export_artifact_id", "tmdb_movie_id"]
    tried = outcome.select(*keys, F.lit(True).alias("_tried"), F.col("error").alias("_error"))
    joined = queue.join(tried, keys, "left")
    done = F.col("_tried") & F.col("_error").isNull()
    changes = {
        "hydrate_status": F.when(done, "completed").when(F.col("_tried"), "failed").otherwise(F.col("hydrate_status")),
        "hydrate_attempts": F.col("hydrate_attempts") + F.when(F.col("_tried"), 1).otherwise(0),
        "last_error": F.when(F.col("_tried"), F.col("_error")).otherwise(F.col("last_error")),
        "hydrated_at": F.when(done, F.current_timestamp()).otherwise(F.col("hydrated_at")),
    }
    return joined.withColumns(changes).select(*queue.columns)


def export_row(exports: DataFrame, artifact_id: int, movie_id: int) -> DataFrame:
    """The queue row of one movie in one export."""
    same_export = F.col("export_artifact_id") == artifact_id
    return exports.where(same_export & (F.col("tmdb_movie_id") == movie_id))
