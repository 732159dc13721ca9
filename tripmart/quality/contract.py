"""Schema contracts, checked before anything is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T


def enforce_contract(df: DataFrame, schema: T.StructType, allow_new: bool = False) -> DataFrame:
    """The frame in contract order; a missing or retyped column is an error.

    Further columns are an error too, or follow at the end if ``allow_new``.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in schema.fields}
    problems = [f"{n}: missing" for n in wanted if n not in actual]
    problems += [
        f"{n}: {actual[n].simpleString()} instead of {kind.simpleString()}"
        for n, kind in wanted.items()
        if n in actual and actual[n] != kind
    ]
    new = [n for n in actual if n not in wanted]
    if new and not allow_new:
        problems += [f"{n}: not in the contract" for n in new]
    if problems:
        raise ValueError("contract violated: " + "; ".join(problems))
    return df.select(*wanted, *new)
