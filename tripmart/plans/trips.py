"""Trip staging, accepted trips and the quality summary."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions import fields as fx
from tripmart.functions import keys, measures
from tripmart.operators.classify import Rule, classify, twin_statuses
from tripmart.operators import dedup
from tripmart.operators.dedup import duplicate_rank, first_copies, flag_first, marked_repeated
from tripmart.session import stored

# Source field per text column.
FIELDS = {
    "vendor_id": "VendorID",
    "pickup_at": "tpep_pickup_datetime",
    "dropoff_at": "tpep_dropoff_datetime",
    "passenger_count": "passenger_count",
    "trip_distance_miles": "trip_distance",
    "rate_code_id": "RatecodeID",
    "store_and_fwd_flag": "store_and_fwd_flag",
    "pickup_location_id": "PULocationID",
    "dropoff_location_id": "DOLocationID",
    "payment_type": "payment_type",
    "fare_amount": "fare_amount",
    "extra_amount": "extra",
    "mta_tax_amount": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge_amount": "improvement_surcharge",
    "total_amount": "total_amount",
    "congestion_surcharge_amount": "congestion_surcharge",
    "airport_fee_amount": "airport_fee",
    "cbd_congestion_fee_amount": "cbd_congestion_fee",
}

# Digits of each whole-number column.
CODES = {"vendor_id": 3, "rate_code_id": 3, "payment_type": 3}
COUNTS = {"passenger_count": 5, "pickup_location_id": 5, "dropoff_location_id": 5}
MOMENTS = ["pickup_at", "dropoff_at"]
AMOUNTS = [name for name in FIELDS if name.endswith("_amount")]

# The amounts that may not be negative.
CHECKED_AMOUNTS = [
    "fare_amount",
    "extra_amount",
    "mta_tax_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
]

# The statuses.
PASS = "PASS"
MISSING_TIMESTAMP = "MISSING_TIMESTAMP"
INVALID_CHRONOLOGY = "INVALID_CHRONOLOGY"
DURATION_OVER_24H = "DURATION_OVER_24H"
INVALID_DISTANCE = "INVALID_DISTANCE"
MISSING_LOCATION = "MISSING_LOCATION"
PERIOD_MISMATCH = "PERIOD_MISMATCH"

ORIGIN = ["source_period", "source_file", "source_row_number"]
HASH = "record_hash"

# Tells a labelled row whose record may be repeated.
MAYBE = "__maybe"

# Columns that stored tables need not hold.
TRIP_KEY_SQL = keys.surrogate_key_sql("source_file", "source_row_number")
HASH_SQL = keys.record_hash_sql(*FIELDS)

# Columns of the accepted trips.
CLEAN_COLUMNS = [
    "trip_sk",
    "vendor_id",
    "pickup_at",
    "dropoff_at",
    "passenger_count",
    "trip_distance_miles",
    "trip_duration_minutes",
    "rate_code_id",
    "store_and_fwd_flag",
    "pickup_location_id",
    "dropoff_location_id",
    "payment_type",
    *AMOUNTS,
    "has_passenger_count_anomaly",
    "has_financial_anomaly",
    "source_file",
    "source_period",
    "source_row_number",
    "loaded_at",
    "record_hash",
]


@dataclass(frozen=True)
class Limits:
    """Thresholds of the quality rules."""

    max_duration_seconds: int = 86_400
    min_passengers: int = 0
    max_passengers: int = 9


def extract(bronze: DataFrame, observed: Iterable[str] | None = None) -> DataFrame:
    """Raw records to one text column per field, in any key casing."""
    return fx.extract_fields(bronze, "raw_record", FIELDS, observed)


def typed(texts: DataFrame) -> DataFrame:
    """Text columns to safe types, with the row's key and its period's first day."""
    kinds = {}
    for name in FIELDS:
        text = F.col(name)
        if name in MOMENTS:
            kinds[name] = fx.safe_timestamp(text)
        elif name in CODES or name in COUNTS:
            kinds[name] = fx.safe_integer(text, CODES.get(name) or COUNTS[name])
        elif name == "store_and_fwd_flag":
            kinds[name] = fx.flag(text)
        elif name == "trip_distance_miles":
            kinds[name] = fx.safe_decimal(text, 14, 3)
        else:
            kinds[name] = fx.safe_decimal(text, 14, 2)
    return texts.select(
        keys.surrogate_key(F.col("source_file"), F.col("source_row_number")).alias("trip_sk"),
        "source_file",
        "source_period",
        "source_row_number",
        "loaded_at",
        fx.period_start(F.col("source_period")).alias("source_period_start"),
        *(column.alias(name) for name, column in kinds.items()),
    )


def derived(trips: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Duration, period membership, anomaly flags and the attribute hash."""
    return trips.withColumns(
        {
            "trip_duration_minutes": measures.duration_minutes(F.col("pickup_at"), F.col("dropoff_at")),
            "is_source_period_match": measures.in_period(
                F.col("pickup_at"), F.col("source_period_start")
            ),
            "has_passenger_count_anomaly": measures.outside(
                F.col("passenger_count"), limits.min_passengers, limits.max_passengers
            ),
            "has_financial_anomaly": measures.any_negative(*(F.col(c) for c in CHECKED_AMOUNTS)),
            HASH: keys.record_hash(*(F.col(c) for c in FIELDS)),
        }
    )


def rules(limits: Limits = Limits()) -> list[Rule]:
    """The quality rules, first match wins."""
    pickup, dropoff = F.col("pickup_at"), F.col("dropoff_at")
    distance = F.col("trip_distance_miles")
    origin, target = F.col("pickup_location_id"), F.col("dropoff_location_id")
    seconds = measures.seconds_between(pickup, dropoff)
    return [
        Rule(MISSING_TIMESTAMP, pickup.isNull() | dropoff.isNull()),
        Rule(INVALID_CHRONOLOGY, dropoff < pickup),
        Rule(DURATION_OVER_24H, seconds > limits.max_duration_seconds),
        Rule(INVALID_DISTANCE, distance.isNull() | (distance < 0)),
        Rule(
            MISSING_LOCATION,
            origin.isNull() | (origin <= 0) | target.isNull() | (target <= 0),
        ),
        Rule(PERIOD_MISMATCH, ~F.col("is_source_period_match"), reads_source=True),
    ]


def labelled(texts: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Typed, derived and classified rows, one per raw row, not yet ranked."""
    return classify(derived(typed(texts), limits), rules(limits), PASS, "dq_status")


def staged(labels: DataFrame, rank_within_status: bool = False, loaded: bool = False) -> DataFrame:
    """Staging with the rank of every copy of a record.

    Ranks run over all rows, whatever their status. A record that first occurs
    in a wrong period file therefore keeps its accepted copy from rank 1;
    ``rank_within_status`` ranks accepted rows among themselves instead. ``loaded``
    tells that the rows come from a lake, whose origins are present and unique.
    """
    key = [HASH, "dq_status"] if rank_within_status else [HASH]
    return (dedup.rank_in_place if loaded else duplicate_rank)(labels, key, ORIGIN)


def marked(labels: DataFrame) -> DataFrame:
    """Labelled rows that know whether their record may be repeated."""
    return marked_repeated(labels, [HASH], MAYBE)


def first_rows(marked_labels: DataFrame, rows: int) -> list[DataFrame]:
    """First copy, its status and the number of copies of each record that may be repeated.

    A frame for each slice of the records; ``rows`` is the number of labelled rows.
    """
    narrow = marked_labels.filter(MAYBE).select(HASH, *ORIGIN, "dq_status")
    return [dedup.first_rows(part, [HASH], ORIGIN, ["dq_status"]) for part in dedup.in_slices(narrow, [HASH], rows)]


def accepted_marked(marked_labels: DataFrame, firsts: DataFrame, periods: Iterable[str]) -> DataFrame:
    """What ``clean`` gives of some periods, from marked rows and the stored ``first_rows``.

    An accepted row is its record's first copy, so only first copies of these periods
    count. Rows of unrepeated records stay where they lie; of the others hardly more than the
    first copies are shuffled. A record first seen in a wrong period file has no accepted row.
    """
    passed = marked_labels.filter((F.col("dq_status") == PASS) & F.col("source_period").isin(*periods))
    firsts = firsts.filter((F.col("dq_status") == PASS) & F.col("first_copy.source_period").isin(*periods))
    alone, shared = passed.filter(~F.col(MAYBE)), passed.filter(MAYBE)
    found = dedup.only_first(shared, [HASH], ORIGIN, firsts)
    return alone.select(*CLEAN_COLUMNS).unionByName(found.select(*CLEAN_COLUMNS))


def flagged(labels: DataFrame, firsts: DataFrame | None = None) -> DataFrame:
    """Labelled rows that know whether they are the first copy of their record.

    ``firsts`` may bring the stored first copies of the repeated records.
    """
    firsts = stored(first_copies(labels, [HASH], ORIGIN), "first-copies") if firsts is None else firsts
    return flag_first(labels, [HASH], ORIGIN, firsts, "is_first_copy")


def candidates(labels: DataFrame, rank_within_status: bool = False) -> DataFrame:
    """Rows that can share a record with an accepted one, in the columns that ``clean`` reads."""
    statuses = [PASS] if rank_within_status else twin_statuses(rules(), PASS)
    return labels.filter(F.col("dq_status").isin(*statuses)).select(*CLEAN_COLUMNS, "dq_status")


def clean(labels: DataFrame, rank_within_status: bool = False) -> DataFrame:
    """Accepted trips: status PASS and the first copy of the record.

    Only candidates are compared, so rejected rows are dropped first. Reads ``labels``
    twice: store them, or their candidates, before.
    """
    rows = candidates(labels, rank_within_status)
    return accepted(rows, stored(first_copies(rows, [HASH], ORIGIN), "first-copies"))


def accepted(labels: DataFrame, firsts: DataFrame) -> DataFrame:
    """Rows of status PASS that are the first copy of their record, from stored first copies."""
    passed = labels.filter(F.col("dq_status") == PASS)
    return flagged(passed, firsts).filter("is_first_copy").select(*CLEAN_COLUMNS)


def _status_count(status: str):
    return F.count_if(F.col("dq_status") == status)


def _row_counts() -> list:
    return [
        F.count(F.lit(1)).alias("raw_row_count"),
        _status_count(MISSING_TIMESTAMP).alias("missing_timestamp_count"),
        _status_count(INVALID_CHRONOLOGY).alias("invalid_chronology_count"),
        _status_count(DURATION_OVER_24H).alias("excessive_duration_count"),
        _status_count(INVALID_DISTANCE).alias("invalid_distance_count"),
        _status_count(MISSING_LOCATION).alias("missing_location_count"),
        _status_count(PERIOD_MISMATCH).alias("period_mismatch_count"),
        F.count_if("has_passenger_count_anomaly").alias("passenger_count_anomaly_count"),
        F.count_if("has_financial_anomaly").alias("financial_anomaly_count"),
        F.max("loaded_at").alias("latest_load_at"),
    ]


def _summary(counts: DataFrame) -> DataFrame:
    usable, total = F.col("usable_row_count"), F.col("raw_row_count")
    return counts.select(
        "source_period",
        "raw_row_count",
        "usable_row_count",
        "exact_duplicate_count",
        "missing_timestamp_count",
        "invalid_chronology_count",
        "excessive_duration_count",
        "invalid_distance_count",
        "missing_location_count",
        "period_mismatch_count",
        "passenger_count_anomaly_count",
        "financial_anomaly_count",
        F.round(
            F.lit(100).cast("decimal(3,0)") * usable.cast("decimal(18,0)")
            / F.nullif(total, F.lit(0)).cast("decimal(18,0)"),
            2,
        ).alias("usable_percentage"),
        "latest_load_at",
    )


def quality_summary(labels: DataFrame, firsts: DataFrame | None = None) -> DataFrame:
    """Accepted, rejected and anomalous rows per period; reads ``labels`` three times.

    With stored ``firsts`` of ``first_rows``, ``labels`` are marked rows and read once.

    Every record has one first copy, so the first copies of a period are the records
    whose least origin lies in it, and its other rows are duplicates. A record that marks
    tell to be unrepeated is its own first copy and counted where it lies. For the others
    an aggregation by record, with a partial step, finds the least origin, however hot a
    record is: it sorts its rows, so it should get few. A missing period has no first copy.
    """
    known = marked(labels) if firsts is None else labels
    if firsts is None:
        firsts = dedup.first_rows(known.filter(MAYBE), [HASH], ORIGIN, ["dq_status"])
    firsts = firsts.groupBy(F.col("first_copy.source_period").alias("source_period")).agg(
        F.count(F.lit(1)).alias("firsts"), F.count_if(F.col("dq_status") == PASS).alias("usable")
    )
    single = ~F.col(MAYBE) & F.col("source_period").isNotNull()
    alone = [
        F.count_if(single).alias("alone"),
        F.count_if(single & (F.col("dq_status") == PASS)).alias("alone_usable"),
    ]
    counts = known.groupBy("source_period").agg(*_row_counts(), *alone).join(firsts, "source_period", "left")
    several = F.coalesce("firsts", F.lit(0))
    return _summary(
        counts.withColumns(
            {
                "usable_row_count": F.coalesce("usable", F.lit(0)) + F.col("alone_usable"),
                "exact_duplicate_count": F.col("raw_row_count") - several - F.col("alone"),
            }
        )
    )
