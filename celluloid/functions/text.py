"""Text matching, tokens and small string composition."""

from __future__ import annotations

import re

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from celluloid.schema import ROLES

# A token is a run of alphabetic or numeric characters, shorter than 40 bytes.
TOKEN_GAP = r"[^\p{IsAlphabetic}\p{N}]+"
MAX_TOKEN_BYTES = 40


def like_to_regex(pattern: str) -> str:
    """Translate ``%`` and ``_`` to a Java regex that folds ASCII case only."""
    wild = {"%": ".*", "_": "."}
    body = "".join(wild.get(ch) or re.escape(ch) for ch in pattern)
    return rf"(?is)\A{body}\z"


def like_ascii(col: Column, pattern: str) -> Column:
    """LIKE without an escape character, ignoring the case of ASCII letters only."""
    return col.rlike(like_to_regex(pattern))


def id_or_like(id_col: Column, cols: list[Column], query: str) -> Column:
    """The id equals the query, or one of the columns contains it."""
    hit = id_col == F.lit(query)
    for col in cols:
        hit = hit | like_ascii(col, f"%{query}%")
    return hit


def any_of(*predicates: Column) -> Column:
    hit = predicates[0]
    for predicate in predicates[1:]:
        hit = hit | predicate
    return hit


def tokens(col: Column) -> Column:
    """Lower-cased tokens with their position; over-long tokens are dropped but keep their place.

    Yields ``array<struct<pos int, term string>>``.
    """
    words = F.filter(F.split(col, TOKEN_GAP), lambda w: w != F.lit(""))
    placed = F.transform(words, lambda w, i: F.struct(i.alias("pos"), w.alias("term")))
    kept = F.filter(placed, lambda t: F.octet_length(t["term"]) < MAX_TOKEN_BYTES)
    return F.transform(kept, lambda t: F.struct(t["pos"].alias("pos"), F.lower(t["term"]).alias("term")))


def query_terms(text: str) -> list[str]:
    """The same token rule for a query string on the driver, in order, repeats kept."""
    words = regex.findall(r"[\p{Alphabetic}\p{N}]+", text)
    return [w.lower() for w in words if len(w.encode()) < MAX_TOKEN_BYTES]


def join_present(*cols: Column) -> Column:
    """Join the parts that are not null with a blank."""
    return F.concat_ws(" ", *cols)


def split_ids(col: Column) -> Column:
    """Split a comma list; empty parts are kept, null stays null."""
    return F.split(col, ",")


def display_name(label: Column, fallback: Column) -> Column:
    return F.coalesce(label, fallback)


def role_predicate(category: Column) -> Column:
    """Graph role of a credit category, null where it has none."""
    pairs = [F.lit(x) for pair in ROLES.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), category)


def credit_key(kind: str, *cols: Column) -> Column:
    """``kind:a:b:c`` over text parts; a missing part counts as empty."""
    return F.concat_ws(":", F.lit(kind), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def raw_json(col: Column) -> Column:
    """JSON text; absent members are written as null."""
    return F.to_json(col, {"ignoreNullFields": "false"})
