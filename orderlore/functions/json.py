"""JSON change documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ELEMENTS = "array<string>"
_CHANGE = "struct<name:string,object:string>"
_CHANGE_SET = "map<string,string>"


def may_contain(document: Column, word: str) -> Column:
    """Cheap exact pre-check before parsing.

    A document without the raw word can only spell it with escapes, and those
    need a backslash. So a row that fails this test cannot hold the word at all.
    """
    return document.contains(word) | document.contains("\\")


def _elements(document: Column) -> Column:
    """The elements of a JSON list as variants.

    A document is parsed once. One that the variant parser refuses, e.g. for a key that repeats, is parsed again
    element by element, so that the last of repeated keys counts and a broken element spoils none of its neighbours.
    """
    parsed = F.try_variant_get(F.try_parse_json(document), "$", "array<variant>")
    singly = F.transform(F.from_json(document, _ELEMENTS), lambda e: F.to_variant_object(F.from_json(e, _CHANGE)))
    return F.coalesce(parsed, singly)


def unpack_changes(log: DataFrame, document: str, *keep: str) -> DataFrame:
    """One row per element of a ``[{name, object}, ...]`` document.

    Empty, null and broken documents, and those that are no list, give no rows. An element that is no object, or lacks a
    field, is a row with nulls there; a string that spells an object is still a string. Values that are not strings
    become JSON text, with numbers in their shortest form.
    """
    # the outer form, as for the other one a filter on the list is inferred that parses once more
    elements = log.select(*keep, F.posexplode_outer(_elements(F.col(document))).alias("place", "element"))
    elements = elements.where(F.col("place").isNotNull())
    field = lambda name: F.try_variant_get("element", f"$.{name}", "string")
    return elements.select(*keep, field("name").alias("field_name"), field("object").alias("field_value"))


def changed_value(document: Column, key: str) -> Column:
    """The value a JSON object holds under ``key``; the last one if it repeats."""
    entries = F.map_entries(F.from_json(document, _CHANGE_SET))
    return F.try_element_at(F.filter(entries, lambda entry: entry.key == key), F.lit(-1)).value
