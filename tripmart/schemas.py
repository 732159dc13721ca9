"""Column lists, types and fixed lookup values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from tripmart.frames import literal_rows

MONEY = T.DecimalType(38, 9)
TIME = T.TimestampNTZType()


def _struct(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


def _raw_trip(prefix: str, *more: tuple[str, T.DataType]) -> T.StructType:
    return _struct(
        ("VendorID", T.LongType()),
        (f"{prefix}_pickup_datetime", TIME),
        (f"{prefix}_dropoff_datetime", TIME),
        ("passenger_count", T.LongType()),
        ("trip_distance", T.DoubleType()),
        ("RatecodeID", T.LongType()),
        ("store_and_fwd_flag", T.StringType()),
        ("PULocationID", T.LongType()),
        ("DOLocationID", T.LongType()),
        ("payment_type", T.LongType()),
        ("fare_amount", T.DoubleType()),
        ("extra", T.DoubleType()),
        ("mta_tax", T.DoubleType()),
        ("tip_amount", T.DoubleType()),
        ("tolls_amount", T.DoubleType()),
        ("improvement_surcharge", T.DoubleType()),
        ("total_amount", T.DoubleType()),
        ("congestion_surcharge", T.DoubleType()),
        *more,
    )


YELLOW_RAW = _raw_trip("tpep")
GREEN_RAW = _raw_trip("lpep", ("trip_type", T.LongType()), ("ehail_fee", T.DoubleType()))
FHV_RAW = _struct(
    ("dispatching_base_num", T.StringType()),
    ("pickup_datetime", TIME),
    ("dropoff_datetime", TIME),
    ("PUlocationID", T.IntegerType()),
    ("DOlocationID", T.IntegerType()),
)

# Trips as the ingestion step lands them.
INGESTED = _struct(
    ("vendor_id", T.LongType()),
    ("pickup_datetime", TIME),
    ("dropoff_datetime", TIME),
    ("passenger_count", T.DoubleType()),
    ("trip_distance", T.DoubleType()),
    ("ratecode_id", T.DoubleType()),
    ("store_and_fwd_flag", T.StringType()),
    ("pulocation_id", T.LongType()),
    ("dolocation_id", T.LongType()),
    ("payment_type", T.LongType()),
    ("fare_amount", T.DoubleType()),
    ("extra", T.DoubleType()),
    ("mta_tax", T.DoubleType()),
    ("tip_amount", T.DoubleType()),
    ("tolls_amount", T.DoubleType()),
    ("improvement_surcharge", T.DoubleType()),
    ("total_amount", T.DoubleType()),
    ("taxi_type", T.StringType()),
    ("extracted_at", T.TimestampType()),
)

# Both services after conforming and union.
TRIPS = _struct(
    ("vendor_id", T.IntegerType()),
    ("rate_code_id", T.IntegerType()),
    ("pickup_location_id", T.IntegerType()),
    ("dropoff_location_id", T.IntegerType()),
    ("pickup_datetime", TIME),
    ("dropoff_datetime", TIME),
    ("store_and_fwd_flag", T.StringType()),
    ("passenger_count", T.IntegerType()),
    ("trip_distance", MONEY),
    ("trip_type", T.IntegerType()),
    ("fare_amount", MONEY),
    ("extra", MONEY),
    ("mta_tax", MONEY),
    ("tip_amount", MONEY),
    ("tolls_amount", MONEY),
    ("ehail_fee", MONEY),
    ("improvement_surcharge", MONEY),
    ("total_amount", MONEY),
    ("payment_type", T.IntegerType()),
    ("service_type", T.StringType()),
)

# The contract of the fact table.
FACT = _struct(
    ("trip_id", T.StringType()),
    ("vendor_id", T.IntegerType()),
    ("service_type", T.StringType()),
    ("rate_code_id", T.IntegerType()),
    ("pickup_location_id", T.IntegerType()),
    ("pickup_borough", T.StringType()),
    ("pickup_zone", T.StringType()),
    ("dropoff_location_id", T.IntegerType()),
    ("dropoff_borough", T.StringType()),
    ("dropoff_zone", T.StringType()),
    ("pickup_datetime", TIME),
    ("dropoff_datetime", TIME),
    ("store_and_fwd_flag", T.StringType()),
    ("passenger_count", T.IntegerType()),
    ("trip_distance", MONEY),
    ("trip_type", T.IntegerType()),
    ("trip_duration_minutes", T.LongType()),
    ("fare_amount", MONEY),
    ("extra", MONEY),
    ("mta_tax", MONEY),
    ("tip_amount", MONEY),
    ("tolls_amount", MONEY),
    ("ehail_fee", MONEY),
    ("improvement_surcharge", MONEY),
    ("total_amount", MONEY),
    ("payment_type", T.IntegerType()),
    ("payment_type_description", T.StringType()),
)

ZONES = _struct(
    ("LocationID", T.IntegerType()),
    ("Borough", T.StringType()),
    ("Zone", T.StringType()),
    ("service_zone", T.StringType()),
)
PAYMENT_TYPES = _struct(("payment_type", T.IntegerType()), ("description", T.StringType()))

# Stream payloads.
RIDE = _struct(
    ("PULocationID", T.IntegerType()),
    ("DOLocationID", T.IntegerType()),
    ("trip_distance", T.DoubleType()),
    ("total_amount", T.DoubleType()),
    ("tpep_pickup_datetime", T.LongType()),
)
GREEN_TRIP = _struct(
    ("lpep_pickup_datetime", T.StringType()),
    ("lpep_dropoff_datetime", T.StringType()),
    ("PULocationID", T.IntegerType()),
    ("DOLocationID", T.IntegerType()),
    ("passenger_count", T.DoubleType()),
    ("trip_distance", T.DoubleType()),
    ("tip_amount", T.DoubleType()),
    ("total_amount", T.DoubleType()),
)

# Result tables of the streaming jobs.
PICKUP_COUNTS = _struct(
    ("window_start", T.TimestampType()),
    ("PULocationID", T.IntegerType()),
    ("num_trips", T.LongType()),
)
SESSION_COUNTS = _struct(
    ("session_start", T.TimestampType()),
    ("session_end", T.TimestampType()),
    ("PULocationID", T.IntegerType()),
    ("num_trips", T.LongType()),
)
HOURLY_TIPS = _struct(
    ("window_start", T.TimestampType()), ("total_tip_amount", T.DoubleType())
)
PROCESSED_EVENTS = _struct(
    ("PULocationID", T.IntegerType()),
    ("DOLocationID", T.IntegerType()),
    ("trip_distance", T.DoubleType()),
    ("total_amount", T.DoubleType()),
    ("pickup_datetime", T.TimestampType()),
)

# They must equal the published lookups for equal results.
VENDOR_NAMES = {
    1: "Creative Mobile Technologies",
    2: "VeriFone Inc.",
    4: "Unknown/Other",
}
PAYMENT_DESCRIPTIONS = {
    0: "Unknown",
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_NAMES = {
    0: "flex_fare",
    1: "credit_card",
    2: "cash",
    3: "no_charge",
    4: "dispute",
    5: "unknown",
    6: "voided_trip",
}
SERVICE_TYPES = ["Green", "Yellow"]
TAXI_TYPES = ["yellow", "green"]


def payment_lookup(spark: SparkSession, values: dict[int, str] | None = None) -> DataFrame:
    """The payment lookup as a frame (7 rows by default)."""
    rows = (PAYMENT_DESCRIPTIONS if values is None else values).items()
    return literal_rows(spark, rows, PAYMENT_TYPES)
