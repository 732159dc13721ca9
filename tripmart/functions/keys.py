"""Keys and code names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from tripmart.functions.casts import ColumnLike, col
from tripmart.schemas import VENDOR_NAMES

# Fixed value: the text that stands for NULL inside a surrogate key.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(cols: Sequence[ColumnLike]) -> Column:
    """md5 over the '-'-joined text of the columns."""
    parts = [F.coalesce(col(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def vendor_name(c: ColumnLike, names: Mapping[int, str] = VENDOR_NAMES) -> Column:
    """Name of a vendor code, NULL for a code without a name."""
    (first, *others) = names.items()
    chain = F.when(col(c) == first[0], first[1])
    for code, name in others:
        chain = chain.when(col(c) == code, name)
    return chain
