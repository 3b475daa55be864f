"""Small relational building blocks shared by the larger operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celluloid.functions.text import split_ids


def tag(df: DataFrame, **constants) -> DataFrame:
    """Add constant columns."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def in_ids(df: DataFrame, key: str, ids: Iterable | DataFrame) -> DataFrame:
    """Rows whose key is one of the ids; ids are literals or a DataFrame with the key column."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select(key), key, "left_semi")
    return df.where(F.col(key).isin(list(ids)))


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull())


def when_flag(df: DataFrame, on: bool, predicate: Column) -> DataFrame:
    """Apply the predicate only when the flag is off."""
    return df if on else df.where(predicate)


def other_than(col: Column, value) -> Column:
    return col != F.lit(value)


def latest_by(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Per key, the row with the greatest order value."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def hydrate(hits: DataFrame, records: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Ranked ids to records: rank order is kept, ids without a record are dropped.

    ``limit`` is the bound of a top-k result, which is then broadcast; all hits are joined plainly.
    """
    return (hits if limit is None else F.broadcast(hits)).join(records, key, "inner").orderBy(F.desc("score"), key)


def gate(
    df: DataFrame, parents: Sequence[tuple[DataFrame, str, str]], stored: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Rows whose references all exist.

    ``parents`` holds (parent table, its id column, referring column of ``df``). ``stored`` writes rows and reads
    them back: the ids that are missing are then few bytes of known size, and the rows need not be shuffled to meet them.
    """
    kept = df
    for parent, key, ref in parents:
        # the references, each once for every task, meet the parent's ids, which stay where they are when they are in
        # buckets; where the rows are shuffled, a title or person with very many rows is split by adaptive execution
        there = F.col(ref).isNotNull()
        missing = df.where(there).select(ref).distinct().join(parent.select(F.col(key).alias(ref)), ref, "left_anti")
        kept = kept.where(there).join(stored(missing) if stored else missing, ref, "left_anti")
    return kept.select(*df.columns)


def explode_ids(df: DataFrame, col: str, out: str) -> DataFrame:
    """Comma list to rows with a 1-based ``ordering``; null lists give no rows."""
    rest = [c for c in df.columns if c != col]
    parts = df.select(*rest, F.posexplode(split_ids(F.col(col))).alias("_pos", out))
    return parts.select(*rest, out, (F.col("_pos") + 1).cast("bigint").alias("ordering"))


def concat_distinct(col: str) -> Column:
    """Distinct values in sorted order, joined by commas; null when there is none."""
    return F.expr(f"listagg(DISTINCT {col}, ',') WITHIN GROUP (ORDER BY {col})")


def top_titles(df: DataFrame, n: int = 20) -> DataFrame:
    return df.orderBy(F.asc_nulls_first("start_year"), "primary_title", "imdb_id").limit(n)


def top_people(df: DataFrame, n: int = 20) -> DataFrame:
    return df.orderBy("primary_name", "imdb_name_id").limit(n)


def top_pending(df: DataFrame, n: int) -> DataFrame:
    return df.orderBy(F.desc_nulls_last("popularity"), "tmdb_movie_id").limit(n)


def order_neighbors(df: DataFrame) -> DataFrame:
    return df.orderBy("direction", "predicate", "entity_name", "entity_id")


def order_collaborators(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("shared_titles"), "person_name", "person_id")
