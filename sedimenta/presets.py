"""Settings for monthly trip records."""

from __future__ import annotations

from sedimenta.operators.conform import ConformSpec
from sedimenta.operators.layers import CastSpec
from sedimenta.operators.quality import Expectation, between, exists, not_null
from sedimenta.plans.specs import BronzePolicy, MappingPolicy, MartSpec, SilverSpec

# Column names, source tags, bounds and partition keys of the trip data.
EXCLUSIVE = ("PUlocationID", "DOlocationID", "vendorid", "tpep_pickup_datetime")
SPLIT = ("PUlocationID", "DOlocationID", "VendorID", "request_datetime", "tpep_pickup_datetime")
REQUIRED = ("tpep_pickup_datetime", "vendorid")
MANUAL = ("VendorID", "request_datetime", "dropoff_datetime", "total_amount", "passenger_count")
SOURCES = (("yellow", "yellow"), ("green", "green"), ("fhvhv", "fhvhv"))
BRONZE_KEYS = ("source_type", "year", "month")
SILVER_KEYS = ("year", "month")
PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
START_DATE = "2023-01-01"
END_DATE = "2023-05-01"
AMOUNTS = ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount")
OUTPUT = ("year", "month", "vendorid", "passenger_count", PICKUP, DROPOFF, "total_amount")
CASTS = (
    CastSpec(("vendorid",), "vendorid", "int"),
    CastSpec(("passenger_count",), "passenger_count", "int"),
    CastSpec((PICKUP,), PICKUP, "timestamp"),
    CastSpec(("dropoff_datetime", DROPOFF), DROPOFF, "timestamp"),
    CastSpec(("fare_amount",), "fare_amount", "float", optional=True),
    CastSpec(("extra",), "extra", "float", optional=True),
    CastSpec(("mta_tax",), "mta_tax", "float", optional=True),
    CastSpec(("tip_amount",), "tip_amount", "float", optional=True),
    CastSpec(("tolls", "tolls_amount"), "tolls_amount", "float", optional=True),
)


def trip_suite(start: str = START_DATE, end: str = END_DATE, hi_exclusive: bool = False) -> tuple[Expectation, ...]:
    """The ten checks of the silver table.

    The range is closed, so an end of ``2023-05-01`` admits only the first instant of that day.
    """
    return (
        exists("vendorid"),
        not_null("vendorid"),
        exists("passenger_count"),
        not_null("passenger_count"),
        between("passenger_count", 1, 8),
        not_null("total_amount"),
        between("total_amount", lo=0.01),
        not_null(PICKUP),
        not_null(DROPOFF),
        between(PICKUP, start, end, hi_exclusive=hi_exclusive),
    )


TRIP_MAPPING = MappingPolicy(
    exclusive=EXCLUSIVE, split=SPLIT, required=REQUIRED, manual={name: name for name in MANUAL}
)
TRIP_BRONZE = BronzePolicy(mapping=TRIP_MAPPING, conform=ConformSpec(rules=SOURCES), ts_col=PICKUP, keys=BRONZE_KEYS)
TRIP_SILVER = SilverSpec(
    source_keys=BRONZE_KEYS,
    where={"source_type": "yellow"},
    casts=CASTS,
    amounts=AMOUNTS,
    total="total_amount",
    output=OUTPUT,
    keys=SILVER_KEYS,
    suite=trip_suite(),
)
TRIP_MARTS = MartSpec(keys=SILVER_KEYS, amount="total_amount", ts=PICKUP, passengers="passenger_count", scale=2)
