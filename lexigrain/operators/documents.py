"""Nested documents of any depth: what they refer to, and whether rows of JSON have their shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variants as V
from ..session import staged

#: What a column of a JSON row may be, by the head of its inferred type.
KINDS = {"string": ("STRING",), "integer": ("BIGINT",), "array": ("ARRAY",), "object": ("OBJECT",), "any": None}


def _children(v: str) -> Column:
    """``step, v`` of the members of an object or the elements of an array; none of anything else."""
    escaped = lambda k: F.replace(F.replace(k, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
    items = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x, i: F.struct(i.cast("string").alias("step"), x.alias("v")))
    members = F.transform(
        F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")), lambda e: F.struct(escaped(e["key"]).alias("step"), e["value"].alias("v")),
    )
    return F.coalesce(items, members)


def objects(docs: DataFrame, doc: str, keep: Sequence[str], picked: Column) -> DataFrame:
    """``keep, place, picked``: what ``picked`` makes of each node ``v`` of each document, where that is not NULL.

    ``doc``     a VARIANT of any depth
    ``picked``  an expression over the column ``v``

    ``place`` is the node's JSON pointer. The trees are walked level by level, all documents at once;
    only arrays and objects go down to the next one, so the work ends with the deepest document.
    """
    level = docs.select(*keep, F.lit("").alias("place"), F.col(doc).alias("v")).where("v IS NOT NULL")
    found = None
    while True:
        level = staged(level.withColumn("picked", picked).withColumn("children", _children("v")).drop("v"), "level")
        here = level.where("picked IS NOT NULL").select(*keep, "place", "picked")
        found = here if found is None else found.unionByName(here)
        below = level.where("size(children) > 0")
        if below.isEmpty():
            return found
        below = below.select(*keep, "place", F.explode("children").alias("c"))
        inner = F.try_variant_get("c.v", "$", "array<variant>").isNotNull() | F.try_variant_get("c.v", "$", "map<string,variant>").isNotNull()
        level = below.where(inner).select(*keep, F.concat("place", F.lit("/"), "c.step").alias("place"), F.col("c.v").alias("v"))


def asset_references(docs: DataFrame, doc: str, *keep: str, tag: str = "img", member: str = "path") -> DataFrame:
    """``keep, place, path`` of every node of a tag, at any depth, whose path is a text."""
    named = F.when(V.string_field("v", "$.tag") == tag, V.string_field("v", f"$.{member}"))
    return objects(docs, doc, keep, named).withColumnRenamed("picked", "path")


def dangling(references: DataFrame, assets: DataFrame) -> DataFrame:
    """Referenced paths that no asset has."""
    return references.select("path").distinct().join(assets.select("path"), "path", "left_anti")


def shapes(rows: DataFrame, row: str, *by: str) -> DataFrame:
    """``by, shape, rows``: the one type that all JSON rows of a group fit in, inferred from them."""
    return rows.groupBy(*by).agg(F.schema_of_variant_agg(row).alias("shape"), F.count("*").alias("rows"))


def row_faults(rows: DataFrame, row: str, columns: Sequence[tuple[str, str]], *keep: str) -> DataFrame:
    """``keep, place, fault`` of JSON rows that are not arrays of the wanted columns.

    ``columns``  name and kind of each, in order; see ``KINDS``

    A row that is no array, or one of another length, has one fault; else each column of another kind
    has one, at its JSON pointer.
    """
    items = F.try_variant_get(row, "$", "array<variant>")
    tests = []
    for n, (name, wanted) in enumerate(columns):
        if KINDS[wanted] is None:
            continue
        found = F.regexp_extract(V.type_of(F.get("_items", F.lit(n))), r"\A[A-Z]+", 0)
        tests.append(F.when(~found.isin(*KINDS[wanted]), F.struct(
            F.lit(f"/{n}").alias("place"), F.concat(F.lit(f"{name} is no {wanted}: "), F.lower(found)).alias("fault"),
        )))
    whole = lambda text: F.array(F.struct(F.lit("").alias("place"), text.alias("fault")))
    faults = (
        F.when(F.col("_items").isNull(), whole(F.lit("no array")))
        .when(F.size("_items") != len(columns), whole(F.concat(F.size("_items").cast("string"), F.lit(f" columns, not {len(columns)}"))))
        .otherwise(F.filter(F.array(*tests), lambda t: t.isNotNull()))
    )
    held = rows.withColumn("_items", items).select(*keep, F.explode(faults).alias("f"))
    return held.select(*keep, "f.place", "f.fault")
