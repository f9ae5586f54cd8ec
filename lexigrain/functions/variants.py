"""Typed reads from VARIANT: a wrong type costs one field, never the record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col


def field(v, path: str) -> Column:
    return F.try_variant_get(as_col(v), path, "variant")


def members(v, *names: str) -> Column:
    """The named members of an object as a struct of VARIANTs, read in one go.

    NULL when the value is no object; an absent member is NULL.
    """
    kind = ", ".join(f"{n}: variant" for n in names)
    return F.try_variant_get(as_col(v), "$", f"struct<{kind}>")


def type_of(v) -> Column:
    return F.schema_of_variant(as_col(v))


def only_string(v) -> Column:
    v = as_col(v)
    return F.when(type_of(v) == "STRING", F.try_variant_get(v, "$", "string"))


def only_int(v) -> Column:
    """A genuine integer; booleans, digit strings, fractions and 2.0 are NULL."""
    v = as_col(v)
    return F.when(type_of(v) == "BIGINT", F.try_variant_get(v, "$", "bigint"))


def string_field(v, path: str) -> Column:
    return only_string(field(v, path))


def int_field(v, path: str) -> Column:
    return only_int(field(v, path))


def elements(v, path: str) -> Column:
    """Array elements as VARIANTs; empty when the field is not an array."""
    return F.coalesce(
        F.try_variant_get(as_col(v), path, "array<variant>"), F.expr("cast(array() as array<variant>)")
    )


def string_elements(v, path: str) -> Column:
    """The string elements of an array, in order."""
    return F.filter(F.transform(elements(v, path), only_string), lambda s: s.isNotNull())
