"""Parse rules of the landing files, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Null marker of the bulk TSV files; shapes accepted as numbers.
NULL_MARK = "\\N"
INTEGER = r"^[+-]?[0-9]+$"
DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
DECIMAL_WORD = r"(?i)^[+-]?(inf|infinity|nan)$"


def null_sentinel(col: Column) -> Column:
    """``\\N`` becomes null; everything else, the empty string too, stays."""
    return F.nullif(col, F.lit(NULL_MARK))


def parse_long(col: Column) -> Column:
    """A plain decimal integer in the 64-bit range, else null. No blanks, no fraction, no suffix."""
    return F.when(col.rlike(INTEGER), col.try_cast("bigint"))


def parse_double(col: Column) -> Column:
    """A plain decimal number or an inf/nan word, else null. ``8.6f`` is not a number."""
    return F.when(col.rlike(DECIMAL) | col.rlike(DECIMAL_WORD), col.try_cast("double"))


def default(col: Column, value) -> Column:
    return F.coalesce(col, F.lit(value))


def flag(col: Column) -> Column:
    """Boolean to 1/0, null stays null."""
    return col.cast("bigint")


def non_negative(col: Column) -> Column:
    return F.greatest(col, F.lit(0).cast("bigint"))


def number_text(col: Column) -> Column:
    """Number as text; a whole double keeps its ``.0``."""
    return col.cast("string")


def clean_dump_line(col: Column) -> Column:
    """Trim white space and drop all trailing commas of a dump line."""
    return F.regexp_replace(F.regexp_replace(col, r"(?U)^\s+|\s+$", ""), r",+$", "")


def snapshot_name(day: Column) -> Column:
    """File name of the dated movie-id export of a day."""
    return F.concat(F.lit("movie_ids_"), F.date_format(day, "MM_dd_yyyy"), F.lit(".json.gz"))


def stamped(df: DataFrame, col: str) -> DataFrame:
    """Add or overwrite an audit-time column."""
    return df.withColumn(col, F.current_timestamp())
