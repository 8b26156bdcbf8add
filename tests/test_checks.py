import pytest
from pyspark.sql import functions as F

from tripmart.operators import checks as ck
from tripmart.operators.lookup import Reference
from tripmart.plans import reports, trip_checks

AUDIT = "dataset string, source_period string, row_count long, status string"


def outcomes(checks, exclude=()):
    return dict(ck.evaluate(ck.run_checks(checks, exclude)))


def test_declared_checks_are_complete():
    assert sum(map(len, trip_checks.NOT_NULL.values())) == 51
    assert sum(map(len, trip_checks.UNIQUE.values())) == 11
    assert len(trip_checks.REFERENCES) == 7
    assert len(trip_checks.REQUIRED_PERIODS) == 20


def test_row_checks(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, 4)], "a int, b int")
    found = outcomes([ck.not_null(df, "t", ["a", "b"]), ck.RowChecks(df, {"small": F.col("a") < 3})])
    assert found == {"not_null:t.a": 1, "not_null:t.b": 2, "small": 1}


def test_row_checks_of_one_table_share_a_scan(spark):
    df = spark.range(3)
    merged = ck._one_pass_per_table([ck.not_null(df, "t", ["id"]), ck.RowChecks(df, {"x": F.col("id") > 1})])
    assert len(merged) == 1 and len(merged[0].violations) == 2


def test_unique_ignores_null(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert outcomes([ck.unique(df, "t", "k")]) == {"unique:t.k": 1}


def test_exclude_drops_only_what_is_named(spark):
    df = spark.createDataFrame([(None, 1)], "a int, b int")
    parent = spark.range(1)
    checks = [
        ck.not_null(df, "t", ["a", "b"]),
        ck.References(df, [Reference("b", "b", parent, "id"), Reference("a", "a", parent, "id")]),
        ck.NoRows("n", df),
    ]
    assert outcomes(checks, ["not_null:t.a", "relationship:b", "n"]) == {"not_null:t.b": 0, "relationship:a": 0}


def test_gate(spark):
    df = spark.createDataFrame([(None,)], "a int")
    results = ck.run_checks([ck.not_null(df, "t", ["a"]), ck.NoRows("none", df.limit(0))])
    assert {r["check"]: r.passed for r in results.collect()} == {"not_null:t.a": False, "none": True}
    with pytest.raises(ck.ChecksFailed) as failure:
        ck.gate(ck.evaluate(results))
    assert failure.value.failed == [("not_null:t.a", 1)]
    ck.gate([("fine", 0)])


def audit(spark, *rows):
    return spark.createDataFrame([("yellow_taxi", *r) for r in rows] + [("other", "2025-09", 1, "SUCCESS")], AUDIT)


def test_required_periods_miss_gaps_but_allow_extras(spark):
    required = spark.createDataFrame([("2025-01",), ("2025-02",), ("2025-09",)], "source_period string")
    log = audit(spark, ("2025-01", 1, "SUCCESS"), ("2025-02", 1, "FAILED"), ("2026-01", 1, "SUCCESS"))
    found = trip_checks.required_periods_loaded(log, required)
    assert sorted(r.source_period for r in found.collect()) == ["2025-02", "2025-09"]


def test_audit_matches_raw(spark):
    raw = spark.createDataFrame([("2025-01",), ("2025-01",), ("2025-02",), ("2025-03",)], "source_period string")
    log = audit(spark, ("2025-01", 2, "SUCCESS"), ("2025-02", 5, "SUCCESS"), ("2025-04", 1, "SUCCESS"))
    found = {(r.source_period, r.bronze_row_count, r.audit_row_count) for r in trip_checks.audit_matches_raw(raw, log).collect()}
    assert found == {("2025-02", 1, 5), ("2025-03", 1, None), ("2025-04", None, 1)}


def test_reports(spark):
    log = audit(spark, ("2025-02", 5, "SUCCESS"), ("2025-01", 2, "SUCCESS"), ("2025-03", 9, "FAILED"))
    assert [tuple(r) for r in reports.loads_per_dataset(log).collect()] == [("other", 1, 1), ("yellow_taxi", 2, 7)]
    assert [r.source_period for r in reports.audit_listing(log).collect()] == ["2025-09", "2025-01", "2025-02", "2025-03"]
    volumes = reports.layer_volumes({"a": spark.range(3), "b": spark.range(0)})
    assert {tuple(r) for r in volumes.collect()} == {("a", 3), ("b", 0)}
    keys = spark.createDataFrame([("x",), ("x",), ("y",)], "trip_sk string")
    assert [tuple(r) for r in reports.repeated_trip_keys(keys).collect()] == [("x", 2)]


def test_chronology(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('a', 1, 2, 1.0), ('b', 2, 1, 1.0), ('c', 1, 2, -0.5), ('d', 1, 2, 1440.0), "
        "('e', 1, 2, 1440.01) AS t(trip_sk, pickup_at, dropoff_at, trip_duration_minutes)"
    )
    assert sorted(r.trip_sk for r in trip_checks.chronology(df).collect()) == ["b", "c", "e"]
