"""Questions about the keys of a JSON document held as VARIANT: is one there, which type, which value."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def members(doc: Column, names: Iterable[str]) -> Column:
    """The named values of an object in one step, as a struct of VARIANT; null when ``doc`` is no object.

    A field is SQL NULL when the key is absent and a variant null when it holds a JSON null.
    """
    return doc.try_cast(f"struct<{', '.join(f'{n}: variant' for n in names)}>")


def is_valid(value: Column | str) -> Column:
    """The text is JSON of any kind, a bare null included."""
    return F.try_parse_json(value).isNotNull()


def kind(value: Column) -> Column:
    """STRING, BIGINT, DECIMAL(..), DOUBLE, BOOLEAN, VOID (JSON null), OBJECT<..>, ARRAY<..>; NULL if absent."""
    return F.schema_of_variant(value)


def is_string(kind_of: Column) -> Column:
    return F.coalesce(kind_of == "STRING", F.lit(False))


def is_number(kind_of: Column) -> Column:
    return F.coalesce(kind_of.isin("BIGINT", "DOUBLE") | kind_of.startswith("DECIMAL"), F.lit(False))


def absent_or_null(kind_of: Column) -> Column:
    return F.coalesce(kind_of == "VOID", F.lit(True))


def text(value: Column, kind_of: Column) -> Column:
    """The string value, null for any other type."""
    return F.when(is_string(kind_of), value.try_cast("string"))


def number(value: Column, kind_of: Column) -> Column:
    return F.when(is_number(kind_of), value.try_cast("double"))


def as_fields(doc: Column) -> Column:
    """Key -> variant map of an object, null for anything else."""
    return doc.try_cast("map<string,variant>")
