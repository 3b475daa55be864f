"""Access to knowledge-base documents held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Members that decide the kind of a structured claim value, first match wins.
VALUE_MEMBERS = (
    ("id", "wikidata_item"),
    ("time", "time"),
    ("text", "monolingual_text"),
    ("amount", "quantity"),
)


def optional_member(doc: Column, path: str, type_name: str) -> Column:
    """Member at a path, null where it is missing or has another type."""
    return F.try_variant_get(doc, path, type_name)


def text_member(doc: Column, path: str) -> Column:
    """Member at a path, only where it is a JSON string."""
    member = F.try_variant_get(doc, path, "variant")
    return F.when(F.schema_of_variant(member) == "STRING", member.try_cast("string"))


def localized(doc: Column, member: str, language: str) -> Column:
    """Text in the requested language, else in English."""
    return F.coalesce(
        text_member(doc, f"$.{member}['{language}'].value"),
        text_member(doc, f"$.{member}.en.value"),
    )


def claim_map(doc: Column) -> Column:
    """``claims`` as a map of statements; a property that is not a list has a null entry."""
    return optional_member(doc, "$.claims", "map<string,array<variant>>")


def claim_value(statement: Column) -> Column:
    """``struct<value_type, value_text, value_wikidata_id>`` of a statement, null if unreadable."""
    value = F.try_variant_get(statement, "$.mainsnak.datavalue.value", "variant")
    shape = F.schema_of_variant(value)
    scalar = value.try_cast("string")
    none = F.lit(None).cast("string")

    def parsed(kind, text, entity):
        return F.struct(
            F.lit(kind).alias("value_type"),
            text.alias("value_text"),
            entity.alias("value_wikidata_id"),
        )

    options = [F.when(shape == "STRING", parsed("string", scalar, none))]
    for member, kind in VALUE_MEMBERS:
        text = text_member(value, f"$.{member}")
        body = parsed(kind, none, text) if member == "id" else parsed(kind, text, none)
        options.append(F.when(shape.startswith("OBJECT") & text.isNotNull(), body))
    number = shape.isin("BIGINT", "DOUBLE", "FLOAT") | shape.startswith("DECIMAL")
    options.append(F.when(number, parsed("number", scalar, none)))
    return F.coalesce(*options)
