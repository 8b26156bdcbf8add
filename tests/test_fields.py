from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tripmart.functions import fields as fx
from tripmart.functions import keys, measures


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def records(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string").select(
        "id", F.parse_json("t").alias("raw")
    )


@pytest.mark.parametrize("observed", [None, ["VendorID", "vendorid", "VENDORID", "Fee", "a b"]])
def test_extract_any_casing(spark, observed):
    df = records(
        spark,
        '{"VendorID": 1, "Fee": 2.5}',
        '{"vendorid": "x"}',
        '{"VENDORID": 7, "vendorid": 8}',
        '{"VendorID": 3, "vendorid": 4}',
        '{"VendorID": null, "vendorid": 4}',
        "{}",
        "[1]",
    )
    out = fx.extract_fields(df, "raw", {"vendor": "VendorID", "fee": "fee"}, observed)
    rows = {r.id: (r.vendor, r.fee) for r in out.collect()}
    assert rows == {
        0: ("1", "2.5"),
        1: ("x", None),
        2: ("7", None),
        3: ("3", None),
        4: ("4", None),
        5: (None, None),
        6: (None, None),
    }


def test_extract_key_that_needs_quotes(spark):
    df = records(spark, '{"A b": 1}')
    out = fx.extract_fields(df, "raw", {"v": "a B"}, ["A b"])
    assert out.first().v == "1"


def test_observed_keys_read_only_their_chunks(spark, tmp_path):
    path = str(tmp_path / "v")
    spark.range(10).select(F.to_variant_object(F.struct("id", F.lit("x").alias("Name"))).alias("raw")).write.parquet(path)
    out = fx.extract_fields(spark.read.parquet(path), "raw", {"name": "name"}, ["id", "Name"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "raw:struct<0:string,1:string>" in plan
    assert {r.name for r in out.collect()} == {"x"}


def test_safe_integer(spark):
    cases = {
        "5": Decimal(5),
        " 7 ": Decimal(7),
        "2.5": Decimal(3),
        "-2.5": Decimal(-3),
        "1.0": Decimal(1),
        "999": Decimal(999),
        "1000": None,
        "": None,
        "  ": None,
        "abc": None,
        None: None,
    }
    got = one(spark, *(fx.safe_integer(F.lit(t).cast("string"), 3) for t in cases))
    assert got == tuple(cases.values())


def test_safe_decimal(spark):
    cases = {"1.005": Decimal("1.01"), "-1.005": Decimal("-1.01"), "999999999999.99": Decimal("999999999999.99"),
             "1000000000000": None, "x": None, " ": None}
    got = one(spark, *(fx.safe_decimal(F.lit(t), 14, 2) for t in cases))
    assert got == tuple(cases.values())


def test_safe_timestamp(spark):
    cases = {
        " 2025-01-01 10:00:00": datetime(2025, 1, 1, 10),
        "2025-01-01T10:00:00.5": datetime(2025, 1, 1, 10, 0, 0, 500000),
        "not-a-time": None,
        "2025-02-30 00:00:00": None,
        "1735689600": None,
        "": None,
    }
    got = one(spark, *(fx.safe_timestamp(F.lit(t)) for t in cases))
    assert got == tuple(cases.values())


def test_period_start_and_flag(spark):
    assert one(spark, fx.period_start(F.lit("2025-02")), fx.period_start(F.lit("2025-13"))) == (date(2025, 2, 1), None)
    got = one(spark, *(fx.flag(F.lit(t).cast("string")) for t in ["Y", " n ", "N", "X", "", None]))
    assert got == ("Y", "N", "N", None, None, None)


def test_squeeze_and_blank(spark):
    got = one(spark, fx.squeeze(F.lit("  a \t b   c ")), fx.blank_to_null(F.lit("  ")), fx.blank_to_null(F.lit(" x ")))
    assert got == ("a b c", None, "x")


def test_hashes(spark):
    import hashlib

    key, full = one(
        spark,
        keys.surrogate_key(F.lit("f.parquet"), F.lit(12)),
        keys.record_hash(F.lit(1), F.lit(None).cast("string"), F.lit("1.50").cast("decimal(14,2)")),
    )
    assert key == hashlib.md5(b"f.parquet|12").hexdigest()
    assert full == hashlib.md5(b"1|<NULL>|1.50").hexdigest()


def test_measures_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        start = F.lit("2025-03-09 01:30:00").cast("timestamp_ntz")
        end = F.lit("2025-03-09 02:30:00").cast("timestamp_ntz")
        got = one(
            spark,
            measures.duration_minutes(start, end),
            keys.date_key(end),
            F.hour(end),
            measures.in_period(end, F.lit("2025-03-01").cast("date")),
            keys.record_hash(end) == F.md5(F.lit("2025-03-09 02:30:00")),
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == (Decimal("60.00"), 20250309, 2, True, True)


def test_seconds_count_boundaries(spark):
    start = F.lit("2025-01-01 00:00:00.9").cast("timestamp_ntz")
    end = F.lit("2025-01-01 00:00:01.1").cast("timestamp_ntz")
    assert one(spark, measures.seconds_between(start, end)) == (1,)


def test_in_period_edges(spark):
    start = F.lit("2025-01-01").cast("date")
    moments = ["2025-01-01 00:00:00", "2025-01-31 23:59:59.999999", "2025-02-01 00:00:00", "2024-12-31 23:59:59"]
    got = one(spark, *(measures.in_period(F.lit(m).cast("timestamp_ntz"), start) for m in moments))
    assert got == (True, True, False, False)
    assert one(spark, measures.in_period(F.lit(moments[0]).cast("timestamp_ntz"), F.lit(None).cast("date"))) == (None,)


def test_flags_and_percentage(spark):
    dec = lambda t: F.lit(t).cast("decimal(14,2)")
    assert one(spark, *(measures.outside(dec(t), 0, 9) for t in ["-1", "0", "9", "10", None])) == (
        True,
        False,
        False,
        True,
        False,
    )
    assert one(spark, measures.any_negative(dec(None), dec("1")), measures.any_negative(dec(None), dec("-0.01"))) == (
        False,
        True,
    )
    assert one(
        spark,
        measures.percentage(dec("50.05"), dec("1000")),
        measures.percentage(dec("1"), dec("0")),
        measures.percentage(dec("1"), dec("-3")),
        measures.percentage(dec(None), dec("3")),
    ) == (Decimal("5.01"), None, None, None)
