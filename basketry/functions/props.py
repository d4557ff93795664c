"""Typed values out of JSON text, with a defined result for any text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parsed(text: Column) -> Column:
    """The text as a variant; null if it is null or no JSON."""
    return F.try_parse_json(text)


def is_broken(text: Column) -> Column:
    """Whether there is a text that is no JSON."""
    return text.isNotNull() & F.try_parse_json(text).isNull()


def value_at(text: Column, path: str, kind: str) -> Column:
    """The value at a path such as ``$.k`` as a type.

    Null where the text is null or broken, the path is not there, or what is there
    is no such type.
    """
    return F.try_variant_get(F.try_parse_json(text), path, kind)


def as_map(text: Column) -> Column:
    """The top fields of an object as a map of texts; empty for anything else."""
    whole = F.try_parse_json(text)
    is_object = F.schema_of_variant(whole).startswith("OBJECT")
    found = F.when(is_object, F.from_json(text, "map<string,string>"))
    return F.coalesce(found, F.create_map().cast("map<string,string>"))
