"""JSON documents of unknown shape, whose fields may change their type from one to the next.

A document is parsed once, into a VARIANT; its fields are read by path. A field that is a number
in one document and a text in another becomes two columns, as loaders do that find a new
type in a known column: no value is cast into another type, and none is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Kinds of values and the types they are read as.
KINDS = {"number": "decimal(38,9)", "text": "string", "flag": "boolean", "object": "variant", "list": "variant"}
_NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
POSITION = "position"


def parse_documents(df: DataFrame, value: str = "value", name: str = "doc", on_bad: str = "fail") -> DataFrame:
    """Replace a JSON text by a VARIANT; a text that is no JSON fails the query, or is NULL with ``on_bad='null'``."""
    if on_bad not in ("fail", "null"):
        raise ValueError(f"on_bad: {on_bad}")
    parse = F.parse_json if on_bad == "fail" else F.try_parse_json
    return df.select(*[F.col(c) for c in df.columns if c not in (value, name)], parse(F.col(value)).alias(name))


def read_documents(spark: SparkSession, path: str, name: str = "doc", on_bad: str = "fail") -> DataFrame:
    """One VARIANT per line of some text files."""
    return parse_documents(spark.read.text(path), "value", name, on_bad)


def shape_of(df: DataFrame, doc: str = "doc") -> str:
    """The type that holds all documents; a field of several types is a VARIANT in it."""
    return df.agg(F.schema_of_variant_agg(doc).alias("shape")).first()["shape"]


def kind_of(value: Column) -> Column:
    """number, text, flag, object, list or null; NULL where there is no value at all."""
    shape = F.schema_of_variant(value)
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(F.is_variant_null(value), "null")
        .when(shape == "STRING", "text")
        .when(shape == "BOOLEAN", "flag")
        .when(shape.startswith("OBJECT"), "object")
        .when(shape.startswith("ARRAY"), "list")
        .when(F.substring_index(shape, "(", 1).isin(*_NUMBERS), "number")
        .otherwise("other")
    )


def field_kinds(df: DataFrame, doc: str = "doc") -> DataFrame:
    """How often each field on the top of the documents occurs with each kind of value."""
    view = df.select(F.col(doc).alias("_doc"))
    fields = view.lateralJoin(view.sparkSession.tvf.variant_explode(F.col("_doc").outer()))
    return fields.groupBy(F.col("key").alias("field"), kind_of(F.col("value")).alias("kind")).agg(F.count("*").alias("n_documents"))


def split_kinds(df: DataFrame, path: str, name: str, kinds: Sequence[str] = tuple(KINDS), doc: str = "doc") -> DataFrame:
    """A column per kind of value that a path has: ``name__number``, ``name__text`` and so on.

    Exactly one of them has a value where the path has one of these kinds; a JSON null
    and a missing path have none.
    """
    if unknown := set(kinds) - set(KINDS):
        raise ValueError(f"no such kinds: {sorted(unknown)}")
    found = F.try_variant_get(F.col(doc), path, "variant")
    kind = kind_of(found)
    columns = {
        f"{name}__{k}": F.when(kind == k, F.try_variant_get(F.col(doc), path, KINDS[k])) for k in kinds
    }
    return df.withColumns(columns)


def explode_documents(df: DataFrame, path: str, keys: Sequence[str], doc: str = "doc", name: str = "doc") -> DataFrame:
    """One row per element of the array at a path: the keys, its position, and the element as a VARIANT.

    A document without the array, or with something else in its place, has no rows.
    """
    elements = F.try_variant_get(F.col(doc), path, "array<variant>")
    return df.select(*keys, F.posexplode(elements).alias(POSITION, name))
