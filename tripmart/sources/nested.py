"""Nested JSON documents as a parent table and child tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T


def flatten_structs(df: DataFrame, separator: str = "__") -> DataFrame:
    """Struct fields become columns named ``outer__inner``, at any depth."""

    def leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
        found = []
        for f in schema.fields:
            here = (*path, f.name)
            found += leaves(f.dataType, here) if isinstance(f.dataType, T.StructType) else [here]
        return found

    return df.select(
        *[
            F.col(".".join(f"`{p}`" for p in path)).alias(separator.join(path))
            for path in leaves(df.schema)
        ]
    )


def explode_children(
    df: DataFrame, array_column: str, key: str, keep_empty: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Split off an array: the parent without it, and one child row per element.

    A child row holds the parent key, its position and the element's fields.
    A parent without elements has no child row, or an empty one if ``keep_empty``.
    """
    parent = flatten_structs(df.drop(array_column))
    explode = F.posexplode_outer if keep_empty else F.posexplode
    rows = df.select(F.col(key), explode(array_column).alias("position", "value"))
    element = rows.schema["value"].dataType
    if isinstance(element, T.StructType):
        rows = rows.select(key, "position", "value.*")
    return parent, flatten_structs(rows)


def child_tables(df: DataFrame, key: Sequence[str], name: str = "root") -> dict[str, DataFrame]:
    """A table for the documents and one for every array in them, at any depth.

    Tables are named ``root``, ``root__orders``, ``root__orders__tags`` and so on. A child
    row holds the key of the document, its position in each array above it
    (``orders__position``) and the element's fields, or ``value``. A field named like one
    of these columns gets the array's name in front.
    """
    flat = flatten_structs(df)
    arrays = [f.name for f in flat.schema.fields if isinstance(f.dataType, T.ArrayType)]
    tables = {name: flat.drop(*arrays)}
    for column in arrays:
        place = f"{column}__position"
        rows = flat.select(*key, F.posexplode(F.col(f"`{column}`")).alias(place, "value"))
        element = rows.schema["value"].dataType
        if isinstance(element, T.StructType):
            taken = {*key, place}
            fields = [
                F.col(f"value.`{n}`").alias(f"{column}__{n}" if n in taken else n) for n in element.names
            ]
            rows = rows.select(*key, place, *fields)
        tables.update(child_tables(rows, [*key, place], f"{name}__{column}"))
    return tables
