"""Graph-pattern queries over the triples table, built from DataFrame operators.

A pattern term is an IRI string, a ``Literal`` or a variable ``"?name"``. Bindings are DataFrames
with one struct column per variable: (kind, value, type). Patterns join on their shared variables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



@dataclass(frozen=True)
class Literal:
    value: str
    type: str = "string"


def is_variable(term) -> bool:
    return isinstance(term, str) and term.startswith("?")


def iri_term(col: Column) -> Column:
    return F.struct(F.lit("iri").alias("kind"), col.alias("value"), F.lit("").alias("type"))


def literal_term(col: Column, type_name: str = "string") -> Column:
    return F.struct(F.lit("literal").alias("kind"), col.alias("value"), F.lit(type_name).alias("type"))


def _object_term() -> Column:
    return F.struct(F.col("o_kind").alias("kind"), F.col("o").alias("value"), F.col("o_type").alias("type"))


def _scan(triples: DataFrame, pattern) -> DataFrame:
    """Bindings of one pattern; constants become filters on the scan."""
    terms = {"s": iri_term(F.col("s")), "p": iri_term(F.col("p")), "o": _object_term()}
    rows, columns = triples, {}
    for position, term in zip(("s", "p", "o"), pattern, strict=True):
        if is_variable(term):
            name = term[1:]
            if name in columns:
                rows = rows.where(columns[name] == terms[position])
            else:
                columns[name] = terms[position]
        elif isinstance(term, Literal):
            rows = rows.where((F.col("o") == term.value) & (F.col("o_kind") == "literal") & (F.col("o_type") == term.type))
        else:
            rows = rows.where(F.col(position) == term)
            if position == "o":
                rows = rows.where(F.col("o_kind") == "iri")
    return rows.select(*[c.alias(n) for n, c in columns.items()])


def _shared(left: DataFrame, right: DataFrame) -> list[str]:
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("patterns must share a variable with those before them")
    return shared


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    return left.join(right, _shared(left, right), how)


def match(triples: DataFrame, patterns: Sequence) -> DataFrame:
    """All patterns at once, joined on shared variables in the given order.

    The joins are plain: adaptive execution broadcasts a side once it has measured it as small.
    """
    return reduce(natural_join, [_scan(triples, p) for p in patterns])


def optional(bindings: DataFrame, triples: DataFrame, patterns: Sequence) -> DataFrame:
    """Extend bindings where the patterns match; keep the others with unbound variables."""
    return natural_join(bindings, match(triples, patterns), "left")


def union(*bindings: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), bindings)


def bind(bindings: DataFrame, name: str, term: Column) -> DataFrame:
    return bindings.withColumn(name, term)


def value(name: str) -> Column:
    """Plain text of a variable: IRI or lexical form."""
    return F.col(name)["value"]


def number(name: str) -> Column:
    """Numeric value of a variable bound to an integer or double."""
    col = F.col(name)
    return F.when(col["type"].isin("integer", "double"), col["value"].try_cast("double"))


def order_by(bindings: DataFrame, *keys: str) -> DataFrame:
    """Unbound first, then IRIs, then literals; numbers by value. A leading ``-`` reverses a key."""
    columns = []
    for key in keys:
        name = key.lstrip("-")
        parts = [F.col(name).isNotNull(), F.col(name)["kind"], number(name), value(name)]
        columns += [F.desc_nulls_last(p) if key.startswith("-") else F.asc_nulls_first(p) for p in parts]
    return bindings.orderBy(*columns)


def select(bindings: DataFrame, *names: str) -> DataFrame:
    """Variables as plain text columns."""
    return bindings.select(*[value(n).alias(n) for n in names])


def construct(bindings: DataFrame, template: Sequence) -> DataFrame:
    """Distinct triples (subject, predicate, object) of a template; unbound ones are left out."""

    def text(term) -> Column:
        if is_variable(term):
            return value(term[1:])
        return F.lit(term.value if isinstance(term, Literal) else term)

    triples = [
        F.struct(text(s).alias("subject"), text(p).alias("predicate"), text(o).alias("object")) for s, p, o in template
    ]
    rows = bindings.select(F.explode(F.array(*triples)).alias("t")).select("t.*")
    return rows.dropna().distinct()


def describe(triples: DataFrame, iri: str) -> DataFrame:
    """All triples of a node as subject."""
    return triples.where(F.col("s") == iri).select(
        F.col("s").alias("subject"), F.col("p").alias("predicate"), F.col("o").alias("object")
    )


def ask(bindings: DataFrame) -> bool:
    return not bindings.isEmpty()


def ask_frame(bindings: DataFrame) -> DataFrame:
    """The answer as a one-row DataFrame; at most one binding is looked for."""
    return bindings.limit(1).agg((F.count(F.lit(1)) > 0).alias("value"))
