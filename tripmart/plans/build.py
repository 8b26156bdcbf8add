"""The whole run: load the landed periods, rebuild each layer, gate each layer."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators import dedup
from tripmart.operators.checks import evaluate, gate, run_checks
from tripmart.plans import dims, facts, reports, trip_checks, trips
from tripmart.session import scratch, shuffles_removed
from tripmart.sources import landing
from tripmart.sources.inline import values
from tripmart.sources.lake import TRIPS, ZONES, Lake

# The columns of an accepted trip take several times the place of those that find first copies.
WIDE = 4

# Names of the rebuilt tables.
LABELLED = "silver.trips_labelled"
FIRSTS = "silver.first_copies"
CLEAN = "silver.trips_clean"
ZONE_TABLE = "silver.zones_clean"
SUMMARY = "silver.dq_summary"
FACT = "gold.fct_trips"
KPIS = "gold.agg_monthly_kpis"
DIMENSIONS = ["dim_date", "dim_location", "dim_vendor", "dim_payment_type", "dim_rate_code"]


@dataclass(frozen=True)
class Options:
    """What a run may vary."""

    periods: Sequence[str] = tuple(trip_checks.REQUIRED_PERIODS)
    strict: bool = True
    required_periods: Sequence[str] = tuple(trip_checks.REQUIRED_PERIODS)
    exclude_checks: Collection[str] = ()
    limits: trips.Limits = field(default_factory=trips.Limits)
    first_day: str = dims.FIRST_DAY
    last_day: str = dims.LAST_DAY


def load_all(
    lake: Lake, landed: Mapping[str, str], lookup: str, periods: Sequence[str], strict: bool = True
) -> list[str]:
    """Load the lookup, then the periods side by side; a failure keeps the loads before it."""
    wanted = landing.checked_periods(periods, list(landed), strict)
    lake.load_lookup(lookup)
    lake.load_periods({period: landed[period] for period in wanted})
    return wanted


def staging(lake: Lake) -> DataFrame:
    """Every raw row typed, classified and ranked, as a view over the labelled table."""
    return trips.staged(lake.table(LABELLED), loaded=True)


def staging_slices(lake: Lake) -> list[Callable[[], DataFrame]]:
    """The staging view in slices of the records, each made when it is called.

    Ranks are of a record's rows, and a slice holds all of them. A reader that takes one
    slice after the other has only that one's rows on disk as a shuffle.
    """
    labels = lake.table(LABELLED)
    parts = dedup.in_slices(labels, [trips.HASH], labels.count())
    return [partial(trips.staged, part, loaded=True) for part in parts]


def _labels(lake: Lake, limits: trips.Limits) -> DataFrame:
    return trips.labelled(trips.extract(lake.raw(TRIPS), lake.field_names(TRIPS)), limits)


def build_labels(lake: Lake, options: Options = Options()) -> None:
    """Type and classify every raw row once; all silver tables read the result."""
    computed = {"trip_sk": trips.TRIP_KEY_SQL}
    lake.write_table(LABELLED, _labels(lake, options.limits), partition_by="source_period", computed=computed)


def _bundles(lake: Lake) -> list[list[str]]:
    """The loaded periods in order, in bundles of what a slice is of wide rows; there are few periods."""
    bundles: list[list[str]] = []
    rows = 0
    loaded = lake.audit().filter(F.col("dataset") == TRIPS).orderBy("source_period")
    for load in loaded.select("source_period", "row_count").collect():
        if not bundles or rows + load.row_count > dedup.SLICE_ROWS // WIDE:
            bundles.append([])
            rows = 0
        bundles[-1].append(load.source_period)
        rows += load.row_count
    return bundles


def build_silver(lake: Lake, options: Options = Options()) -> None:
    """Accepted trips, zones and the quality summary.

    The first copies of records that may be repeated are stored once, a slice of the
    records after the other. Both the summary and the accepted trips read them, the
    latter some periods after the other.
    """
    labels = lake.table(LABELLED)
    known = trips.marked(labels)
    lake.write_table(FIRSTS, trips.first_rows(known, labels.count()))
    firsts = lake.table(FIRSTS)
    lake.write_table(SUMMARY, trips.quality_summary(known, firsts))
    computed = {"trip_sk": trips.TRIP_KEY_SQL, trips.HASH: trips.HASH_SQL}
    accepted = (trips.accepted_marked(known, firsts, periods) for periods in _bundles(lake))
    lake.write_table(CLEAN, accepted, partition_by="source_period", computed=computed)
    lake.write_table(ZONE_TABLE, dims.zones_clean(lake.raw(ZONES)))


def dimensions(lake: Lake, options: Options = Options()) -> dict[str, DataFrame]:
    return {
        "dim_date": dims.dim_date(lake.spark, options.first_day, options.last_day),
        "dim_location": dims.dim_location(lake.table(ZONE_TABLE)),
        "dim_vendor": dims.dim_vendor(lake.spark),
        "dim_payment_type": dims.dim_payment_type(lake.spark),
        "dim_rate_code": dims.dim_rate_code(lake.spark),
    }


def gold_dimensions(lake: Lake) -> dict[str, DataFrame]:
    return {name: lake.table(f"gold.{name}") for name in DIMENSIONS}


def build_gold(lake: Lake, options: Options = Options()) -> None:
    for name, rows in dimensions(lake, options).items():
        lake.write_table(f"gold.{name}", rows)
    lake.write_table(
        FACT,
        facts.fct_trips(lake.table(CLEAN), lake.table(ZONE_TABLE)),
        partition_by="source_period",
        computed={"trip_sk": trips.TRIP_KEY_SQL},
    )
    lake.write_table(KPIS, facts.agg_monthly_kpis(lake.table(FACT)))


def run(
    lake: Lake, landed: Mapping[str, str], lookup: str, options: Options = Options()
) -> list[tuple[str, int]]:
    """Load, build and check; return the outcome of each check."""
    load_all(lake, landed, lookup, options.periods, options.strict)
    return build_layers(lake, options)


def build_layers(lake: Lake, options: Options = Options()) -> list[tuple[str, int]]:
    """Build and check the layers over what is loaded; the landed files are not read again.

    Each step's shuffle files go with the step, and what is stored on the way at the end.
    A failed check stops the tables that read the checked one. A failed check
    that nothing reads, such as those of the audit, fails the run at its end.
    """
    with shuffles_removed(lake.spark), scratch(lake.spark):
        return _layers(lake, options)


def _layers(lake: Lake, options: Options) -> list[tuple[str, int]]:
    required = values(lake.spark, [(p,) for p in options.required_periods], "source_period string")
    outcomes: list[tuple[str, int]] = []

    def check(checks: list, stop: bool = True) -> None:
        found = evaluate(run_checks(checks, options.exclude_checks))
        outcomes.extend(found)
        if stop:
            gate(found)

    raw, zones = lake.raw(TRIPS), lake.raw(ZONES)
    check(trip_checks.raw_checks(raw, zones))
    check(trip_checks.audit_checks(raw, lake.audit(), required), stop=False)
    build_labels(lake, options)
    check(trip_checks.staged_checks(lake.table(LABELLED)))
    build_silver(lake, options)
    minutes = options.limits.max_duration_seconds // 60
    check(trip_checks.clean_checks(lake.table(CLEAN), lake.table(ZONE_TABLE), minutes))
    check(trip_checks.summary_checks(lake.table(SUMMARY)), stop=False)
    build_gold(lake, options)
    check(
        trip_checks.gold_checks(lake.table(FACT), gold_dimensions(lake), lake.table(KPIS)), stop=False
    )
    gate(outcomes)
    return outcomes


def acceptance(lake: Lake) -> dict[str, DataFrame]:
    """The acceptance reports of a finished run."""
    fact = lake.table(FACT)
    return {
        "loads_per_dataset": reports.loads_per_dataset(lake.audit()),
        "audit_listing": reports.audit_listing(lake.audit()),
        "layer_volumes": reports.layer_volumes(
            {
                "BRONZE.YELLOW_TAXI_RAW": lake.raw(TRIPS),
                "SILVER.TRIPS_CLEAN": lake.table(CLEAN),
                "GOLD.FCT_TRIPS": fact,
            }
        ),
        "quality_by_period": reports.quality_by_period(lake.table(SUMMARY)),
        "repeated_trip_keys": reports.repeated_trip_keys(fact),
        "orphans": reports.orphans(fact, gold_dimensions(lake)),
        "kpi_listing": reports.kpi_listing(lake.table(KPIS)),
    }
