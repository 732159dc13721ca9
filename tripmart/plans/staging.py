"""Raw feeds to common columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tripmart.functions import safe_cast, safe_int, strict_cast
from tripmart.operators.filters import require_not_null
from tripmart.schemas import INGESTED, MONEY

# The money columns of a trip feed.
MONEY_COLUMNS = [
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
]


def _whole(df: DataFrame, name: str) -> Column:
    """The column, rounded where it holds fractions (Spark's cast truncates)."""
    field = next(f for f in df.schema.fields if f.name.lower() == name)
    fractional = isinstance(field.dataType, T.FractionalType)
    return F.round(field.name) if fractional else F.col(field.name)


def _conform(df: DataFrame, stamps: str, overrides: Mapping[str, Column]) -> DataFrame:
    # Column resolution ignores case, so raw headers may be spelt either way.
    columns = {
        "vendor_id": strict_cast(_whole(df, "vendorid"), "int"),
        "rate_code_id": safe_cast(_whole(df, "ratecodeid"), "int"),
        "pickup_location_id": strict_cast(_whole(df, "pulocationid"), "int"),
        "dropoff_location_id": strict_cast(_whole(df, "dolocationid"), "int"),
        "pickup_datetime": strict_cast(f"{stamps}_pickup_datetime", "timestamp_ntz"),
        "dropoff_datetime": strict_cast(f"{stamps}_dropoff_datetime", "timestamp_ntz"),
        "store_and_fwd_flag": strict_cast("store_and_fwd_flag", "string"),
        "passenger_count": strict_cast(_whole(df, "passenger_count"), "int"),
        "trip_distance": strict_cast("trip_distance", MONEY),
        **{c: strict_cast(c, MONEY) for c in MONEY_COLUMNS},
        "payment_type": strict_cast(_whole(df, "payment_type"), "int"),
        **overrides,
    }
    valid = require_not_null(df, "vendorid")
    return valid.select(*[c.alias(name) for name, c in columns.items()])


def conform_green(df: DataFrame) -> DataFrame:
    """Green feed: 19 typed columns; rows without vendor are dropped."""
    return _conform(
        df,
        "lpep",
        {
            "trip_type": safe_cast(_whole(df, "trip_type"), "int"),
            "ehail_fee": strict_cast("ehail_fee", MONEY),
            "payment_type": safe_cast(_whole(df, "payment_type"), "int"),
        },
    )


def conform_yellow(df: DataFrame) -> DataFrame:
    """Yellow feed: 17 typed columns; the rate code may come as ``'1.0'``."""
    return _conform(df, "tpep", {"rate_code_id": safe_int("ratecodeid")})


def conform_fhv(df: DataFrame) -> DataFrame:
    """For-hire feed: base, stamps, zones; rows without a base are dropped."""
    return require_not_null(df, "dispatching_base_num").select(
        "dispatching_base_num",
        "pickup_datetime",
        "dropoff_datetime",
        F.col("pulocationid").alias("pickup_location_id"),
        F.col("dolocationid").alias("dropoff_location_id"),
    )


# Header names of the raw files and the names they get on ingestion.
INGEST_RENAMES = {
    "VendorID": "vendor_id",
    "RatecodeID": "ratecode_id",
    "PULocationID": "pulocation_id",
    "DOLocationID": "dolocation_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "lpep_pickup_datetime": "pickup_datetime",
    "lpep_dropoff_datetime": "dropoff_datetime",
}


def standardise(
    df: DataFrame,
    rename: Mapping[str, str] = INGEST_RENAMES,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rename per map, keep the listed columns in the listed order."""
    renamed = df.withColumnsRenamed({k: v for k, v in rename.items() if k in df.columns})
    return renamed.select(*(columns or [c for c in INGESTED.names if c in renamed.columns]))


def with_lineage(df: DataFrame, taxi_type: str) -> DataFrame:
    """Tag rows with their service and the time they were read."""
    return df.withColumns(
        {"taxi_type": F.lit(taxi_type), "extracted_at": F.current_timestamp()}
    )
