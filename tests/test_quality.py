import random
from collections import defaultdict

import pytest
from helpers import texts
from pyspark.sql import functions as F

from driver import adapter, queries
from tripmart.operators import checks, dedup
from tripmart.operators.classify import Rule, classify, twin_statuses
from tripmart.plans import trips
from tripmart.session import stored


def statuses(spark, *changes):
    rows = trips.labelled(texts(spark, list(changes))).orderBy("source_row_number").collect()
    return [r.dq_status for r in rows]


def test_each_rule_and_its_edges(spark):
    assert statuses(
        spark,
        {},
        {"pickup_at": "bad"},
        {"dropoff_at": None},
        {"dropoff_at": "2025-01-10 07:59:59"},
        {"dropoff_at": "2025-01-10 08:00:00"},
        {"dropoff_at": "2025-01-11 08:00:00"},
        {"dropoff_at": "2025-01-11 08:00:01"},
        {"trip_distance_miles": None},
        {"trip_distance_miles": "-0.001"},
        {"trip_distance_miles": "0"},
        {"pickup_location_id": "0"},
        {"dropoff_location_id": "x"},
        {"source_period": "2025-02"},
        {"source_period": "not-a-period"},
    ) == [
        "PASS",
        "MISSING_TIMESTAMP",
        "MISSING_TIMESTAMP",
        "INVALID_CHRONOLOGY",
        "PASS",
        "PASS",
        "DURATION_OVER_24H",
        "INVALID_DISTANCE",
        "INVALID_DISTANCE",
        "PASS",
        "MISSING_LOCATION",
        "MISSING_LOCATION",
        "PERIOD_MISMATCH",
        "PASS",
    ]


def test_first_rule_wins(spark):
    assert statuses(
        spark,
        {"dropoff_at": "2025-01-10 07:00:00", "trip_distance_miles": "x", "pickup_location_id": "0"},
        {"trip_distance_miles": "x", "pickup_location_id": "0", "source_period": "2025-02"},
    ) == ["INVALID_CHRONOLOGY", "INVALID_DISTANCE"]


def test_limits_are_parameters(spark):
    long_trip = texts(spark, [{"dropoff_at": "2025-01-12 08:00:00", "passenger_count": "8"}])
    limits = trips.Limits(max_duration_seconds=3 * 86_400, max_passengers=6)
    row = trips.labelled(long_trip, limits).first()
    assert (row.dq_status, row.has_passenger_count_anomaly) == ("PASS", True)


def test_anomalies(spark):
    rows = trips.labelled(
        texts(
            spark,
            [
                {},
                {"passenger_count": "10"},
                {"passenger_count": "-1"},
                {"passenger_count": None},
                {"tip_amount": "-0.01"},
                {"congestion_surcharge_amount": "-2.50"},
            ],
        )
    ).orderBy("source_row_number")
    got = [(r.has_passenger_count_anomaly, r.has_financial_anomaly) for r in rows.collect()]
    assert got == [(False, False), (True, False), (True, False), (False, False), (False, True), (False, False)]


def test_malformed_code_is_null_and_does_not_stop_the_run(spark):
    row = trips.typed(texts(spark, [{"vendor_id": "1000", "passenger_count": "2.0"}])).first()
    assert row.vendor_id is None and row.passenger_count == 2


def test_hash_ignores_origin_but_not_null(spark):
    rows = trips.labelled(
        texts(spark, [{}, {"source_file": "b", "source_period": "2025-02"}, {"tip_amount": None}, {"tip_amount": "0"}])
    ).orderBy("source_row_number")
    hashes = [r.record_hash for r in rows.collect()]
    assert hashes[0] == hashes[1] and len(set(hashes)) == 3


def test_generic_classifier(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    rules = [Rule("ONE", F.col("x") == 1), Rule("SMALL", F.col("x") < 3, reads_source=True)]
    got = [r.status for r in classify(df, rules, "OTHER", "status").collect()]
    assert got == ["ONE", "SMALL", "OTHER"]
    assert twin_statuses(rules, "OTHER") == ["OTHER", "SMALL"]


def test_record_first_seen_in_a_wrong_period(spark):
    """Ranks run over all rows: the accepted copy is second and both are dropped."""
    trip = {"pickup_at": "2025-02-10 08:00:00", "dropoff_at": "2025-02-10 08:30:00"}
    df = texts(spark, [{**trip, "source_period": "2025-01"}, {**trip, "source_period": "2025-02"}, {}])
    labels = trips.labelled(df)
    ranks = {r.source_row_number: (r.dq_status, r.duplicate_rank) for r in trips.staged(labels).collect()}
    assert ranks == {0: ("PERIOD_MISMATCH", 1), 1: ("PASS", 2), 2: ("PASS", 1)}
    assert [r.source_row_number for r in trips.clean(labels).collect()] == [2]
    within = {r.source_row_number: r.duplicate_rank for r in trips.staged(labels, True).collect()}
    assert within == {0: 1, 1: 1, 2: 1}
    assert sorted(r.source_row_number for r in trips.clean(labels, True).collect()) == [1, 2]


def messy(spark, seed, n=400):
    """Random copies, one record holding a third of all rows."""
    rng = random.Random(seed)
    periods = ["2025-01", "2025-02", "2025-03"]
    rows = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.34:
            change = {"fare_amount": "1.00"}
        elif kind < 0.5:
            change = {"pickup_at": "bad", "fare_amount": str(rng.randrange(3))}
        else:
            change = {"fare_amount": str(rng.randrange(150)), "trip_distance_miles": rng.choice(["1", "-1", "x"])}
        rows.append({**change, "source_period": rng.choice(periods), "source_file": rng.choice("ab")})
    return trips.labelled(texts(spark, rows)).cache()


def brute_ranks(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r.record_hash].append((r.source_period, r.source_file, r.source_row_number))
    return {place: i + 1 for places in groups.values() for i, place in enumerate(sorted(places))}


@pytest.mark.parametrize("seed, block_rows", [(1, 1), (2, 7), (3, 64), (4, 1 << 20)])
def test_duplicate_rank_equals_brute_force(spark, seed, block_rows):
    labels = messy(spark, seed)
    ranked = dedup.duplicate_rank(labels, [trips.HASH], trips.ORIGIN, block_rows=block_rows).collect()
    assert {(r.source_period, r.source_file, r.source_row_number): r.duplicate_rank for r in ranked} == brute_ranks(
        labels.collect()
    )


def test_few_unrepeated_keys_are_marked(spark):
    """Every repeated key is marked, null included, and rows of most others never meet a shuffle."""
    ids = [*range(3000), *range(0, 3000, 100), None, None]
    rows = spark.createDataFrame([(i, i if i is None else -i) for i in ids], "k long, other long")
    found = dedup.marked_repeated(rows, ["k"], "marked").collect()
    assert sorted(map(str, ((r.k, r.other) for r in found))) == sorted(map(str, ((i, i if i is None else -i) for i in ids)))
    assert all(r.marked for r in found if r.k is None or r.k % 100 == 0)
    assert sum(r.marked for r in found) <= 64
    crowded = dedup.marked_repeated(rows, ["k"], "marked", bits=8)
    assert crowded.filter("marked").count() > 62 and crowded.filter("k is null or k % 100 = 0").filter("not marked").count() == 0


def test_rank_does_not_depend_on_row_order(spark):
    labels = messy(spark, 5)
    shuffled = labels.orderBy(F.rand(3)).repartition(7)
    key = ["trip_sk", "duplicate_rank"]
    assert set(trips.staged(labels).select(*key).collect()) == set(trips.staged(shuffled).select(*key).collect())


def test_first_copies_and_flags(spark):
    labels = messy(spark, 6)
    firsts = dedup.first_copies(labels, [trips.HASH], trips.ORIGIN)
    ranks = brute_ranks(labels.collect())
    for r in trips.flagged(labels, firsts).collect():
        place = (r.source_period, r.source_file, r.source_row_number)
        assert r.is_first_copy == (ranks[place] == 1)
    repeated = {r.record_hash for r in dedup.repeated_keys(labels, [trips.HASH]).collect()}
    assert {r.record_hash for r in firsts.collect()} == repeated


def test_record_twice_is_one_accepted_and_one_duplicate(spark):
    rows = [{"source_file": "2025-01/day=1/data_0.parquet"}, {"source_file": "2025-01/day=2/data_0.parquet"}]
    labels = trips.labelled(texts(spark, rows).withColumn("source_row_number", F.lit(0).cast("long")))
    assert trips.clean(labels).count() == 1
    row = trips.quality_summary(labels).first()
    assert (row.raw_row_count, row.usable_row_count, row.exact_duplicate_count) == (2, 1, 1)


def test_clean_equals_rank_over_all_rows(spark):
    labels = messy(spark, 7)
    accepted = trips.staged(labels).filter("dq_status = 'PASS' AND duplicate_rank = 1")
    assert {r.trip_sk for r in accepted.collect()} == {r.trip_sk for r in trips.clean(labels).collect()}


def test_summary_counts_add_up(spark):
    labels = messy(spark, 8)
    extra = {
        r.source_period: r["count"]
        for r in trips.staged(labels)
        .filter("dq_status = 'PASS' AND duplicate_rank > 1")
        .groupBy("source_period")
        .count()
        .collect()
    }
    for r in trips.quality_summary(labels).collect():
        rejected = (
            r.missing_timestamp_count
            + r.invalid_chronology_count
            + r.excessive_duration_count
            + r.invalid_distance_count
            + r.missing_location_count
            + r.period_mismatch_count
        )
        assert r.raw_row_count == r.usable_row_count + rejected + extra.get(r.source_period, 0)
        assert r.exact_duplicate_count >= extra.get(r.source_period, 0)
        assert float(r.usable_percentage) == pytest.approx(100 * r.usable_row_count / r.raw_row_count, abs=0.005)


def test_hot_record_is_reduced_before_the_shuffle(spark):
    firsts = dedup.first_copies(trips.labelled(texts(spark, [{}])), [trips.HASH], trips.ORIGIN)
    plan = firsts._jdf.queryExecution().executedPlan().toString()
    assert plan.index("functions=[count(1), min(") < plan.index("Exchange") < plan.index("partial_count(1), partial_min(")
    assert "Join" not in plan


@pytest.fixture
def low_skew_limits(spark):
    """Every join by shuffle, and partitions of a few kilobytes count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.shuffle.partitions": "16",
        # A hot key is split by the map tasks that it comes from.
        "spark.sql.files.maxPartitionBytes": "1m",
        "spark.sql.files.openCostInBytes": "64k",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(spark, rows=200_000):
    """Four fifths of the rows are one record."""
    key = F.when(F.col("id") % 5 > 0, 0).otherwise(F.col("id"))
    record = F.md5(key.cast("string")).alias("record_hash")
    df = spark.range(0, rows, 1, 16).select(F.lit("2025-01").alias("source_period"), F.lit("f").alias("source_file"), F.col("id").alias("source_row_number"), record, F.lit("PASS").alias("dq_status"), F.sha2(F.col("id").cast("string"), 512).alias("filler"))
    return stored(df, "hot")


def largest_task(df):
    """Rows of the largest task, all columns read."""
    tasks = df.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.max("filler").alias("filler"))
    return tasks.agg(F.max("n"), F.max("filler")).first()[0]


def test_a_hot_record_is_split_over_tasks(spark, low_skew_limits):
    rows, n = hot(spark), 200_000
    flagged = trips.flagged(rows)
    assert largest_task(flagged) < n // 4
    assert flagged.filter("is_first_copy").count() == n // 5
    ranked = dedup.duplicate_rank(rows, [trips.HASH], trips.ORIGIN, block_rows=1 << 12)
    highest = ranked.agg(F.max("duplicate_rank"))
    assert highest.first()[0] == n * 4 // 5 + 1
    highest.collect()
    assert "SortMergeJoin(skew=true)" in highest._jdf.queryExecution().executedPlan().toString()


def test_summary_of_a_hot_record_joins_no_rows(spark, low_skew_limits):
    labels = messy(spark, 8)
    summary = trips.quality_summary(labels)
    ranks = brute_ranks(labels.collect())
    later = {}
    for r in labels.collect():
        place = (r.source_period, r.source_file, r.source_row_number)
        later[r.source_period] = later.get(r.source_period, 0) + (ranks[place] > 1)
    assert {r.source_period: r.exact_duplicate_count for r in summary.collect()} == later


def test_summary_sorts_only_rows_that_may_be_repeated(spark):
    """Unrepeated records are counted where they lie; what is sorted by record is little, and no period has no first copy."""
    labels = messy(spark, 9)
    rows = labels.withColumn("source_period", F.when(F.col("source_row_number") % 5 > 0, F.col("source_period")))
    summary = trips.quality_summary(rows)
    plan = summary._jdf.queryExecution().optimizedPlan().toString()
    least = plan[plan.index("min(struct(source_period") :]
    assert least.index("getbit") < least.index("parquet" if "parquet" in least else "LogicalRDD")
    firsts = {}
    for r in sorted(rows.collect(), key=lambda r: (r.source_period or "", r.source_file, r.source_row_number)):
        firsts.setdefault(r.record_hash, r)
    for r in summary.collect():
        found = [f for f in firsts.values() if f.source_period is not None and f.source_period == r.source_period]
        assert r.usable_row_count == sum(f.dq_status == trips.PASS for f in found)
        assert r.exact_duplicate_count == r.raw_row_count - len(found)


def test_trips_are_made_once_for_the_listings(spark, monkeypatch):
    made = []
    monkeypatch.setattr(adapter, "trips_raw", lambda *at, make=adapter.trips_raw: made.append(at) or make(*at))
    assert queries.listing_order(spark, "/root/testdata/sf0.001").count() > 0
    assert len(made) == 1


@pytest.mark.parametrize("block_rows", [3, 1 << 20])
def test_rank_in_place_equals_the_ranks(spark, block_rows):
    labels = messy(spark, 10)
    ranks = brute_ranks(labels.collect())
    ranked = dedup.rank_in_place(labels, [trips.HASH], trips.ORIGIN, block_rows=block_rows)
    assert ranked.columns == dedup.duplicate_rank(labels, [trips.HASH], trips.ORIGIN).columns
    found = {(r.source_period, r.source_file, r.source_row_number): r.duplicate_rank for r in ranked.collect()}
    assert found == ranks and max(ranks.values()) > 3


def test_hot_record_is_ranked_in_blocks(spark):
    rows, n = hot(spark), 200_000
    ranked = dedup.rank_in_place(rows, [trips.HASH], trips.ORIGIN, block_rows=1 << 12)
    assert largest_task(ranked) < n // 4
    assert ranked.agg(F.max("duplicate_rank")).first()[0] == n * 4 // 5 + 1


def test_accepted_rows_are_dropped_where_they_lie(spark):
    """Rows of unrepeated records are not shuffled, and of a hot one little more than its first copy."""
    rows, n = hot(spark), 200_000
    known = trips.marked(rows)
    firsts = stored(dedup.first_rows(known.filter(trips.MAYBE), [trips.HASH], trips.ORIGIN, ["dq_status"]), "firsts")
    found = dedup.only_first(known.filter(trips.MAYBE), [trips.HASH], trips.ORIGIN, firsts)
    alone = known.filter(~F.col(trips.MAYBE))
    assert found.count() + alone.count() == n // 5 and firsts.agg(F.max("copies")).first()[0] == n * 4 // 5 + 1
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("getbit") >= 2
    assert "Exchange hashpartitioning" not in alone._jdf.queryExecution().executedPlan().toString()


def test_rare_duplicates_are_the_duplicates(spark):
    values = [1, 1, 2, None, None, 3, 3, 3, 4]
    df = spark.createDataFrame([(v,) for v in values], "k long")
    assert sorted(map(str, checks.rare_duplicates(df, ["k"]).collect())) == sorted(map(str, checks.duplicates(df, ["k"]).collect()))
    assert checks.evaluate(checks.run_checks([checks.unique(df, "t", "k", large=True)])) == [("unique:t.k", 2)]
