import hashlib
import os
import random
import threading

import pytest
from helpers import GOOD, texts
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from driver import adapter, queries
from tripmart.operators import dedup
from tripmart.operators.checks import ChecksFailed, evaluate, gate, run_checks
from tripmart.plans import build, trip_checks, trips
from tripmart.session import scratch, shuffles_removed, small_methods, stored
from tripmart.sources import landing, lookup_csv
from tripmart.sources.landing import EmptyLoad
from tripmart.sources.lake import TRIPS, ZONES, CommitConflict, Lake

HEADER = "LocationID,Borough,Zone,service_zone\n"
ZONE_LINES = HEADER + '10,Queens,"A, first",Boro\n20,Bronx,B,N/A\n'


def land(df, path):
    df.coalesce(1).write.parquet(str(path))
    return str(path)


def trip_file(spark, folder, period, changes, **renames):
    """A landed period in the source's own field names."""
    df = texts(spark, [{"source_period": period, "pickup_at": f"{period}-05 08:00:00", "dropoff_at": f"{period}-05 08:30:00", **c} for c in changes])
    names = {c: renames.get(c, key) for c, key in trips.FIELDS.items()}
    return land(df.select(*(F.col(c).alias(n) for c, n in names.items())), folder / f"yellow_tripdata_{period}.parquet")


def write(path, text, mode="w"):
    with open(path, mode) as f:
        f.write(text)
    return str(path)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


# Landing


def test_manifest_facts(spark, tmp_path):
    blobs = {"a.parquet": b"PAR1" + os.urandom(100_000) + b"PAR1", "b.parquet": b"PAR1PAR", "c.parquet": b"PAR1" * 2,
             "d.bin": b"x" * 50}
    for name, blob in blobs.items():
        write(tmp_path / name, blob, "wb")
    expected = {
        (n, len(b), hashlib.sha256(b).hexdigest(), n in ("a.parquet", "c.parquet")) for n, b in blobs.items()
    }
    rows = landing.manifest(spark, str(tmp_path)).collect()
    assert {(r.source_file, r.byte_count, r.file_sha256, r.has_signature) for r in rows} == expected


def test_origins_of_files_and_folders_at_once(spark, tmp_path):
    (tmp_path / "p").mkdir()
    blobs = {tmp_path / "p" / f"{i}.parquet": b"PAR1" + bytes([i]) * 20 + b"PAR1" for i in range(30)}
    blobs[tmp_path / "one.parquet"] = b"PAR1PAR1"
    for path, blob in blobs.items():
        write(path, blob, "wb")
    found = landing.origins(spark, {"a": str(tmp_path / "p"), "b": str(tmp_path / "one.parquet")})
    assert (found["a"].source_file, found["a"].byte_count, found["a"].has_signature) == ("p", 30 * 28, True)
    assert found["b"].file_sha256 == hashlib.sha256(b"PAR1PAR1").hexdigest()
    digests = sorted(hashlib.sha256(b).hexdigest() for p, b in blobs.items() if p.parent.name == "p")
    groups = {d[:3]: [] for d in digests}
    for d in digests:
        groups[d[:3]].append(d)
    joined = ",".join(hashlib.sha256(",".join(g).encode()).hexdigest() for _, g in sorted(groups.items()))
    assert found["a"].file_sha256 == hashlib.sha256(joined.encode()).hexdigest()
    assert landing.origins(spark, {}) == {}


def test_bad_periods(spark):
    df = spark.createDataFrame([("2025-01",), ("2025-01",), ("1999-01",), ("2025-13",), (None,), ("2025-02",), ("2025-03\n",), ("0701",)], "source_period string")
    got = {r.source_period: (r.malformed, r.repeated) for r in landing.bad_periods(df).collect()}
    assert got == {"2025-01": (False, True), "1999-01": (True, False), "2025-13": (True, False), None: (True, False),
                   "2025-03\n": (True, False), "0701": (True, False)}


def test_checked_periods():
    landed = ["2025-01", "2025-03"]
    assert landing.checked_periods(["2025-03", "2025-01"], landed) == ["2025-03", "2025-01"]
    with pytest.raises(FileNotFoundError, match="2025-02"):
        landing.checked_periods(["2025-01", "2025-02"], landed)
    assert landing.checked_periods(["2025-01", "2025-02"], landed, strict=False) == ["2025-01"]
    for bad in (["2025-1"], ["1999-01"], [], ["2025-01", "2025-01"], ["2025-01\n"]):
        with pytest.raises(ValueError):
            landing.checked_periods(bad, landed)


# Lookup


def test_lookup_values(spark, tmp_path):
    body = HEADER + '1,NULL,"say ""hi"", twice",null\n2,,  spaced ,""\n'
    path = write(tmp_path / "z.csv", b"\xef\xbb\xbf" + body.encode() + b"3,b\xff,z,s\n", "wb")
    rows = lookup_csv.read_lookup(spark, path).orderBy("source_row_number").collect()
    assert [tuple(r[c] for c in lookup_csv.COLUMNS) for r in rows] == [
        ("1", None, 'say "hi", twice', None),
        ("2", None, "  spaced ", None),
        ("3", "b�", "z", "s"),
    ]
    assert [(r.source_file, r.source_row_number) for r in rows] == [("z.csv", 0), ("z.csv", 1), ("z.csv", 2)]


@pytest.mark.parametrize(
    "header",
    ["LocationID,Borough,Zone", "locationid,Borough,Zone,service_zone", "Borough,LocationID,Zone,service_zone",
     "LocationID,Borough,Zone,service_zone,More", "LocationID,Borough,Zone,Zone"],
)
def test_lookup_header_must_match(spark, tmp_path, header):
    with pytest.raises(ValueError, match="header"):
        lookup_csv.read_lookup(spark, write(tmp_path / "z.csv", header + "\n1,a,b,c\n"))


@pytest.mark.parametrize("line", ["1,a,b", "1,a,b,c,d"])
def test_lookup_row_with_wrong_width_stops(spark, tmp_path, line):
    path = write(tmp_path / "z.csv", HEADER + "1,a,b,c\n" + line + "\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        lookup_csv.read_lookup(spark, path).collect()


def test_lookup_line_break_stops_or_is_read(spark, tmp_path):
    path = write(tmp_path / "z.csv", HEADER + '1,a,"b\nc",d\n')
    with pytest.raises((PySparkException, Py4JJavaError)):
        lookup_csv.read_lookup(spark, path).collect()
    assert lookup_csv.read_lookup(spark, path, multiline=True).first().zone == "b\nc"


def test_lookup_rows_are_numbered_over_splits(spark, tmp_path):
    for name, n in (("a", 5000), ("b", 3000)):
        write(tmp_path / f"{name}.csv", HEADER + "".join(f"{i},x,y,z\n" for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = lookup_csv.read_lookup(spark, str(tmp_path / "*.csv")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 8000
    assert all(int(r.location_id) == r.source_row_number for r in rows)


# Loads


def test_reload_replaces_one_period_only(spark, lake, tmp_path):
    one = trip_file(spark, tmp_path, "2025-01", [{}, {"tip_amount": "1"}])
    two = trip_file(spark, tmp_path, "2025-02", [{}])
    lake.load_period(one, "2025-01")
    lake.load_period(two, "2025-02")
    before = lake.raw(TRIPS).drop("loaded_at").selectExpr("to_json(raw_record) r", "* EXCEPT (raw_record)").collect()
    lake.load_period(one, "2025-01")
    again = lake.raw(TRIPS).drop("loaded_at").selectExpr("to_json(raw_record) r", "* EXCEPT (raw_record)").collect()
    assert sorted(before) == sorted(again) and len(again) == 3
    lake.load_period(two, "2025-01")
    counts = {r.source_period: r["count"] for r in lake.raw(TRIPS).groupBy("source_period").count().collect()}
    assert counts == {"2025-01": 1, "2025-02": 1}
    audit = {r.source_period: (r.row_count, r.status, r.dataset) for r in lake.audit().collect()}
    assert audit == {"2025-01": (1, "SUCCESS", TRIPS), "2025-02": (1, "SUCCESS", TRIPS)}


def test_audit_facts(spark, lake, tmp_path):
    folder = trip_file(spark, tmp_path, "2025-01", [{}])
    name = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
    lake.load_period(f"{folder}/{name}", "2025-01", url="somewhere")
    blob = open(f"{folder}/{name}", "rb").read()
    row = lake.audit().first()
    assert (row.source_url, row.source_file, row.byte_count) == ("somewhere", name, len(blob))
    assert row.file_sha256 == hashlib.sha256(blob).hexdigest()
    raw = lake.raw(TRIPS).first()
    assert (raw.source_file, raw.source_row_number, raw.source_period) == (f"2025-01/{name}", 0, "2025-01")


def test_period_of_several_files(spark, lake, tmp_path):
    spark.range(100).repartition(4).write.parquet(str(tmp_path / "p"))
    load = lake.load_period(str(tmp_path / "p"), "2025-01")
    assert load.row_count == 100
    rows = lake.raw(TRIPS)
    assert rows.select("source_file", "source_row_number").distinct().count() == 100
    assert lake.audit().first().source_file == "p"


def test_nested_files_are_loaded_and_counted(spark, lake, tmp_path):
    folder = tmp_path / "p"
    spark.range(1).coalesce(1).write.parquet(str(folder))
    spark.range(2).coalesce(1).write.parquet(str(folder / "x" / "deep"))
    spark.sql("SELECT 'a' AS other").coalesce(1).write.parquet(str(folder / "y=1"))
    assert lake.load_period(str(folder), "2025-01").row_count == 4
    assert lake.field_names(TRIPS) == ["id", "other"]
    files = {r.source_file.rsplit("/", 1)[0] for r in lake.raw(TRIPS).collect()}
    assert files == {"2025-01", "2025-01/x/deep", "2025-01/y=1"}
    only_nested = tmp_path / "q"
    spark.range(3).coalesce(1).write.parquet(str(only_nested / "z"))
    assert lake.load_period(str(only_nested), "2025-02").row_count == 3


def test_one_job_finds_all_schemas(spark, lake, tmp_path):
    """Jobs do not grow with the files of a period."""
    tracker = spark.sparkContext.statusTracker()
    jobs = []
    for n in (4, 40):
        folder = str(tmp_path / f"p{n}")
        spark.range(80).repartition(n).write.parquet(folder)
        spark.range(80).selectExpr("cast(id AS string) id").repartition(n).write.mode("append").parquet(folder)
        spark.sparkContext.setJobGroup(f"load {n}", "")
        assert lake.load_period(folder, "2025-01").row_count == 160
        spark.sparkContext._jsc.sc().clearJobGroup()
        jobs.append(len(tracker.getJobIdsForGroup(f"load {n}")))
    # More than 32 paths are listed by a job of their own.
    assert jobs[1] <= jobs[0] + 4


AWKWARD = ["my land", "a+b", "100%", "x%20y", "é", "day=1", "[a]{b}"]


def test_paths_with_awkward_names(spark, lake, tmp_path):
    folder = tmp_path / "my land+%" / "m"
    for name in AWKWARD:
        spark.range(2).coalesce(1).write.parquet(str(tmp_path / "one"), mode="overwrite")
        file = next((tmp_path / "one").glob("*.parquet"))
        (folder / name).mkdir(parents=True)
        write(folder / name / "d.parquet", file.read_bytes(), "wb")
    # A second schema, so that files are read by their paths.
    spark.sql("SELECT 'a' AS other").coalesce(1).write.parquet(str(folder / "z"))
    assert lake.load_period(str(folder), "2025-01").row_count == 2 * len(AWKWARD) + 1
    rows = lake.raw(TRIPS)
    assert rows.select("source_file", "source_row_number").distinct().count() == rows.count()
    assert {f"2025-01/{name}/d.parquet" for name in AWKWARD} <= {r.source_file for r in rows.collect()}


def test_paths_find_their_period_in_any_order(spark, tmp_path):
    """Suffixes of one another, a folder inside another, and many periods."""
    near, far = tmp_path / "d" / "m", tmp_path / "mnt" / str(tmp_path)[1:] / "d" / "m"
    for i, folder in enumerate((near, far, near / "in")):
        folder.mkdir(parents=True)
        write(folder / "a.parquet", b"PAR1" + bytes([i]) + b"PAR1", "wb")
    many = {f"p{i}": tmp_path / "many" / str(i) for i in range(300)}
    for i, folder in enumerate(many.values()):
        folder.mkdir(parents=True)
        write(folder / "a.parquet", b"PAR1" + str(i).encode() + b"PAR1", "wb")
    landed_ = {n: str(p) for n, p in {"near": near, "far": far, "in": near / "in", **many}.items()}
    found = landing.origins(spark, landed_)
    assert found == landing.origins(spark, dict(reversed(landed_.items())))
    assert found["far"].file_sha256 == hashlib.sha256(b"PAR1\x01PAR1").hexdigest()
    assert found["in"].file_sha256 == hashlib.sha256(b"PAR1\x02PAR1").hexdigest()
    assert found["near"].byte_count == 18 and found["p299"].file_sha256 == hashlib.sha256(b"PAR1299PAR1").hexdigest()


def test_digests_of_streamed_files(spark, tmp_path):
    """Line ends of every kind, none at all, and files larger than a task's share."""
    blobs = [b"\n", b"\n\n\n", b"a\r\nb\r", b"a\n", b"\xef\xbb\xbfa\nb", b"\xef\xbb\xbf\n", b"\xff\x00\n\x00" * 999, b"x" * 3_000_000, os.urandom(2_000_000), b"\xef\xbb\xbf"]
    for i, blob in enumerate(blobs):
        write(tmp_path / f"{i}.bin", blob, "wb")
    found = {r.source_file: (r.byte_count, r.file_sha256) for r in landing.manifest(spark, str(tmp_path)).collect()}
    assert found == {f"{i}.bin": (len(b), hashlib.sha256(b).hexdigest()) for i, b in enumerate(blobs)}
    write(tmp_path / "x.csv.gz", b"abc", "wb")
    with pytest.raises(ValueError):
        landing.manifest(spark, str(tmp_path))


def test_large_files_are_hashed_in_blocks(spark, tmp_path, monkeypatch):
    """Several tasks share a file; facts depend on its bytes alone, and its footer is found."""
    monkeypatch.setattr(landing, "BLOCK_BYTES", 10_000)
    # The reader of footers takes 64 KB at once.
    monkeypatch.setattr(landing, "FOOTER_BYTES", 70_000)
    draw = random.Random(1)
    lines = b"\n".join(draw.randbytes(draw.randrange(300)).replace(b"\n", b"") for _ in range(400))
    blobs = [lines, lines + b"\n", b"\xef\xbb\xbf" + lines, b"\xef\xbb\xbf" + lines + b"\n", b"PAR1" + lines + b"PAR1", b"x" * 50_000, b"\n" * 30_000, b"small", b"\n"]
    blobs += [(b"x" * 99 + b"\n") * 300, (b"x" * 99 + b"\n") * 299 + b"x" * 99, lines[:20_000], lines[:10_000], lines[:10_001]]
    for i, blob in enumerate(blobs):
        write(tmp_path / f"{i}.bin", blob, "wb")
        write(tmp_path / f"{i}.again", blob, "wb")
    spark.range(40_000).selectExpr("id", "cast(id as string) name").coalesce(1).write.parquet(str(tmp_path / "p"))
    rows = landing.manifest(spark, str(tmp_path)).collect()
    found = {r.source_file: r for r in rows}
    assert len(rows) == 2 * len(blobs) + 1
    for i, blob in enumerate(blobs):
        one, two = found[f"{i}.bin"], found[f"{i}.again"]
        assert (one.byte_count, one.file_sha256, one.has_signature) == (len(blob), two.file_sha256, i == 4)
        assert (one.file_sha256 == hashlib.sha256(blob).hexdigest()) == (len(blob) <= 10_000)
    assert len({r.file_sha256 for r in rows}) == len(blobs) + 1
    parquet = next(r for r in rows if r.source_file.endswith(".parquet"))
    assert parquet.byte_count > 200_000 and parquet.has_signature and parquet.schema
    assert landing.manifest(spark, str(tmp_path)).rdd.getNumPartitions() > 8


def test_periods_are_captured_side_by_side(spark, lake, tmp_path, monkeypatch):
    """Captures wait for one another, so one after the other would time out; a failure keeps the periods before it."""
    files = {f"2025-0{i}": trip_file(spark, tmp_path, f"2025-0{i}", [{}] * i) for i in (1, 2, 3)}
    together, capture = threading.Barrier(3, timeout=60), landing.capture

    def waiting(*args):
        together.wait()
        return capture(*args)

    monkeypatch.setattr(landing, "capture", waiting)
    assert [(load.source_period, load.row_count) for load in lake.load_periods(files)] == [("2025-01", 1), ("2025-02", 2), ("2025-03", 3)]

    def failing(spark_, path, period, schemas):
        if period == "2025-02":
            raise ValueError("bad period")
        return capture(spark_, path, period, schemas)

    monkeypatch.setattr(landing, "capture", failing)
    before = {r.source_period: r.load_id for r in lake.loads(TRIPS)}
    with pytest.raises(ValueError, match="bad period"):
        lake.load_periods(files)
    after = {r.source_period: r.load_id for r in lake.loads(TRIPS)}
    assert [after[p] != before[p] for p in sorted(files)] == [True, False, False]


def test_queries_let_wide_projections_compile(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    small_methods(session)
    assert session.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    session.conf.set("spark.sql.codegen.hugeMethodLimit", "4000")
    assert small_methods(session).conf.get("spark.sql.codegen.hugeMethodLimit") == "4000"


def test_settings_of_the_session_reach_the_capture(spark, lake, tmp_path):
    spark.conf.set("spark.sql.parquet.binaryAsString", "true")
    try:
        rows = landing.capture(spark, land(spark.range(2), tmp_path / "x"), "2025-01").rows
        assert rows.sparkSession.conf.get("spark.sql.parquet.binaryAsString") == "true"
        assert spark.conf.get("spark.sql.caseSensitive") == "false"
    finally:
        spark.conf.unset("spark.sql.parquet.binaryAsString")


def test_failed_load_keeps_the_old_version(spark, lake, tmp_path):
    lake.load_period(trip_file(spark, tmp_path, "2025-01", [{}]), "2025-01")
    bad = {
        "no.parquet": b"",
        "short.parquet": b"PAR1",
        "text.parquet": b"x" * 100,
        "broken.parquet": b"PAR1" + b"x" * 100 + b"PAR1",
    }
    for name, blob in bad.items():
        path = write(tmp_path / name, blob, "wb")
        with pytest.raises((EmptyLoad, ValueError, PySparkException, Py4JJavaError)):
            lake.load_period(path, "2025-01")
    empty = land(spark.range(0), tmp_path / "empty")
    with pytest.raises(EmptyLoad):
        lake.load_period(empty, "2025-01")
    part = tmp_path / "part"
    spark.range(5).coalesce(1).write.parquet(str(part))
    write(part / "none.parquet", b"", "wb")
    with pytest.raises(EmptyLoad):
        lake.load_period(str(part), "2025-01")
    with pytest.raises(PySparkException):
        lake.load_period(str(tmp_path / "absent"), "2025-01")
    assert lake.raw(TRIPS).count() == 1 and lake.audit().first().row_count == 1


def test_a_write_without_its_audit_row_is_invisible(spark, lake, tmp_path, monkeypatch):
    path = trip_file(spark, tmp_path, "2025-01", [{}])
    lake.load_period(path, "2025-01")
    more = trip_file(spark, tmp_path, "2025-02", [{}, {}])

    def crash(*args):
        raise RuntimeError("lost before the commit")

    monkeypatch.setattr(lake, "_append", crash)
    for period in ("2025-01", "2025-02"):
        with pytest.raises(RuntimeError):
            lake.load_period(more, period)
    monkeypatch.undo()
    assert [r.source_period for r in lake.raw(TRIPS).collect()] == ["2025-01"]
    lake.load_period(more, "2025-02")
    assert lake.raw(TRIPS).count() == 3


def test_of_two_writers_one_commits(spark, lake, tmp_path, monkeypatch):
    first, second = Lake(spark, lake.root), Lake(spark, lake.root)
    path = trip_file(spark, tmp_path, "2025-01", [{}])
    more = trip_file(spark, tmp_path, "2025-02", [{}, {}])
    # The second reads the log; then the first commits.
    taken = second._next(second._audit_path)
    monkeypatch.setattr(second, "_next", lambda *log: taken)
    first.load_period(path, "2025-01")
    with pytest.raises(CommitConflict):
        second.load_period(more, "2025-01")
    assert lake.raw(TRIPS).count() == 1 and lake.audit().first().row_count == 1
    monkeypatch.undo()
    second.load_period(more, "2025-01")
    assert lake.raw(TRIPS).count() == 2
    with pytest.raises(CommitConflict):
        monkeypatch.setattr(second, "_next", lambda *log: 1)
        lake.write_table("t", spark.range(1))
        second.write_table("t", spark.range(2))
    assert lake.table("t").count() == 1


def test_a_log_row_that_was_not_finished_is_no_commit(spark, lake, tmp_path):
    lake.load_period(trip_file(spark, tmp_path, "2025-01", [{}]), "2025-01")
    write(tmp_path / "lake" / "bronze" / "ingestion_audit" / ".2-lost", "{")
    assert lake.audit().count() == 1 and lake.audit().first().loaded_at is not None
    lake.load_period(trip_file(spark, tmp_path, "2025-02", [{}]), "2025-02")
    assert lake.audit().count() == 2


def test_drifted_files_load_side_by_side(spark, lake, tmp_path):
    lake.load_period(land(spark.sql("SELECT 1 AS VendorID, 'a' AS extra"), tmp_path / "1"), "2025-01")
    lake.load_period(land(spark.sql("SELECT '2' AS vendorid, 1.5D AS request_source"), tmp_path / "2"), "2025-02")
    texts_ = trips.extract(lake.raw(TRIPS), lake.field_names(TRIPS))
    got = {r.source_period: (r.vendor_id, r.extra_amount) for r in texts_.collect()}
    assert got == {"2025-01": ("1", "a"), "2025-02": ("2", None)}
    assert "request_source" in lake.field_names(TRIPS)
    kept = lake.raw(TRIPS).selectExpr("try_variant_get(raw_record, '$.request_source', 'double') v").collect()
    assert {r.v for r in kept} == {None, 1.5}


def test_files_of_one_period_keep_their_own_columns(spark, lake, tmp_path):
    folder = tmp_path / "p"
    spark.sql("SELECT 1 AS VendorID, 'a' AS extra").coalesce(1).write.parquet(str(folder))
    spark.sql("SELECT '2' AS VendorID, 1.5D AS extra, 'web' AS request_source").coalesce(1).write.mode("append").parquet(str(folder))
    assert lake.load_period(str(folder), "2025-01").row_count == 2
    assert lake.field_names(TRIPS) == ["VendorID", "extra", "request_source"]
    got = lake.raw(TRIPS).selectExpr("to_json(raw_record) r").collect()
    assert {r.r for r in got} == {'{"VendorID":1,"extra":"a"}', '{"VendorID":"2","extra":1.5,"request_source":"web"}'}


def test_any_column_name_is_captured(spark, lake, tmp_path):
    cased = spark.newSession()
    cased.conf.set("spark.sql.caseSensitive", "true")
    path = str(tmp_path / "odd")
    cased.sql("SELECT 1 AS VendorID, 2 AS vendorid, 3 AS `a``b`, 4 AS `c.d`").write.parquet(path)
    lake.load_period(path, "2025-01")
    assert lake.raw(TRIPS).selectExpr("to_json(raw_record) r").first().r == '{"VendorID":1,"a`b":3,"c.d":4,"vendorid":2}'


def test_equal_file_names_of_two_periods_differ(spark, lake, tmp_path):
    blob = land(spark.range(3), tmp_path / "x")
    file = next(f for f in os.listdir(blob) if f.endswith(".parquet"))
    for period in ("2025-01", "2025-02"):
        (tmp_path / period).mkdir()
        write(tmp_path / period / "data_0.parquet", open(f"{blob}/{file}", "rb").read(), "wb")
        lake.load_period(str(tmp_path / period), period)
    assert lake.raw(TRIPS).select("source_file", "source_row_number").distinct().count() == 6
    assert {r.source_file for r in lake.raw(TRIPS).collect()} == {"2025-01/data_0.parquet", "2025-02/data_0.parquet"}


def test_a_period_is_text_of_its_form(spark, lake, tmp_path):
    path = land(spark.range(1), tmp_path / "x")
    for period in ("0701", "2025-01\n", "2025-1"):
        with pytest.raises(ValueError):
            lake.load_period(path, period)
    assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "false"


def test_lookup_reload_replaces_everything(spark, lake, tmp_path):
    lake.load_lookup(write(tmp_path / "a.csv", HEADER + "1,a,b,c\n2,a,b,c\n"))
    lake.load_lookup(write(tmp_path / "b.csv", HEADER + "3,x,y,z\n"))
    assert [r.location_id for r in lake.raw(ZONES).collect()] == ["3"]
    row = lake.audit().first()
    assert (row.dataset, row.source_period, row.source_file, row.row_count) == (ZONES, "CURRENT", "b.csv", 1)
    with pytest.raises(EmptyLoad):
        lake.load_lookup(write(tmp_path / "c.csv", HEADER))
    assert lake.raw(ZONES).count() == 1


def test_table_versions(spark, lake):
    assert lake.write_table("t", spark.range(3)) == 3
    lake.write_table("t", lake.table("t").filter("id > 0"))
    assert sorted(r.id for r in lake.table("t").collect()) == [1, 2]
    with pytest.raises(LookupError):
        lake.table("other")


# The whole run


def landed(spark, tmp_path):
    copies = [{"tip_amount": str(i % 7)} for i in range(20)]
    january = [*copies, {"pickup_at": "bad"}, {"vendor_id": "4"}, {"pickup_location_id": "77", "tip_amount": "9"}]
    february = [{"fare_amount": str(i)} for i in range(1, 6)]
    return {
        "2025-01": trip_file(spark, tmp_path, "2025-01", january, vendor_id="vendorid"),
        "2025-02": trip_file(spark, tmp_path, "2025-02", february, airport_fee_amount="Airport_fee"),
    }


def snapshot(lake):
    volatile = ["loaded_at", "latest_load_at"]
    tables = [build.CLEAN, build.SUMMARY, build.FACT, build.KPIS]
    return {
        name: sorted(map(str, lake.table(name).drop(*volatile).collect())) for name in tables
    }


def test_run_and_rerun(spark, lake, tmp_path):
    files = landed(spark, tmp_path)
    zones = write(tmp_path / "zones.csv", ZONE_LINES)
    options = build.Options(periods=list(files), required_periods=list(files))
    outcomes = build.run(lake, files, zones, options)
    assert len(outcomes) == 73 and not any(count for _, count in outcomes)
    first = snapshot(lake)
    kpis = {r.source_period: r.trip_count for r in lake.table(build.KPIS).collect()}
    assert kpis == {"2025-01": 9, "2025-02": 5}
    summary = {r.source_period: r for r in lake.table(build.SUMMARY).collect()}
    assert (summary["2025-01"].raw_row_count, summary["2025-01"].exact_duplicate_count) == (23, 13)
    assert summary["2025-01"].missing_timestamp_count == 1

    build.run(lake, files, zones, options)
    assert snapshot(lake) == first
    removed = lake.remove_replaced()
    assert len(removed) == 3 + 7 + len(build.DIMENSIONS) and lake.remove_replaced() == []
    assert snapshot(lake) == first and lake.raw(TRIPS).count() == 28

    reports = build.acceptance(lake)
    assert [tuple(r) for r in reports["loads_per_dataset"].collect()] == [(ZONES, 1, 2), (TRIPS, 2, 28)]
    assert {r.relationship: r.orphans for r in reports["orphans"].collect()} == dict.fromkeys(
        ["pickup_date", "dropoff_date", "pickup_location", "dropoff_location"], 0
    )
    assert {r.object_name: r.row_count for r in reports["layer_volumes"].collect()} == {
        "BRONZE.YELLOW_TAXI_RAW": 28,
        "SILVER.TRIPS_CLEAN": 14,
        "GOLD.FCT_TRIPS": 14,
    }
    assert reports["repeated_trip_keys"].count() == 0
    ranks = build.staging(lake)
    assert ranks.count() == 28 and ranks.filter("duplicate_rank > 1").count() == 13


def test_missing_period_strict_and_lenient(spark, lake, tmp_path):
    files = landed(spark, tmp_path)
    zones = write(tmp_path / "zones.csv", ZONE_LINES)
    periods = [*files, "2025-03"]
    with pytest.raises(FileNotFoundError, match="2025-03"):
        build.run(lake, files, zones, build.Options(periods=periods, required_periods=periods))
    assert lake.audit().count() == 0
    excluded = build.Options(
        periods=periods, required_periods=periods, strict=False, exclude_checks=[trip_checks.REQUIRED_PERIODS_CHECK]
    )
    assert len(build.run(lake, files, zones, excluded)) == 72
    required = spark.createDataFrame([(p,) for p in periods], "source_period string")
    checks = trip_checks.audit_checks(lake.raw(TRIPS), lake.audit(), required)
    with pytest.raises(ChecksFailed) as failure:
        gate(evaluate(run_checks(checks)))
    assert failure.value.failed == [(trip_checks.REQUIRED_PERIODS_CHECK, 1)]


def test_failed_layer_stops_what_reads_it(spark, lake, tmp_path):
    files = landed(spark, tmp_path)
    zones = write(tmp_path / "zones.csv", HEADER + "10,,A,x\n")
    with pytest.raises(ChecksFailed) as failure:
        build.run(lake, files, zones, build.Options(periods=list(files), required_periods=list(files)))
    assert failure.value.failed == [("not_null:zones_clean.borough", 1)]
    with pytest.raises(LookupError):
        lake.table(build.FACT)


def test_good_row_is_good(spark):
    assert trips.labelled(texts(spark, [{}])).first().dq_status == trips.PASS and GOOD


def test_scratch_folders_go_with_their_step(spark):
    kept = stored(spark.range(3), "kept")
    with scratch(spark):
        inner = stored(spark.range(5), "step")
        (folder,) = {p.rsplit("/", 1)[0] for p in inner.inputFiles()}
        assert os.path.exists(folder.removeprefix("file://")) and inner.count() == 5
    assert not os.path.exists(folder.removeprefix("file://")) and kept.count() == 3
    with pytest.raises(ValueError), scratch(spark):
        (folder,) = {p.rsplit("/", 1)[0] for p in stored(spark.range(5), "step").inputFiles()}
        raise ValueError
    assert not os.path.exists(folder.removeprefix("file://"))


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_parts_become_visible_together_and_computed_columns_are_not_stored(spark, lake):
    rows = spark.range(9).select("id", F.md5(F.concat(F.lit("f"), F.lit("|"), F.col("id").cast("string"))).alias("key"), F.lit("2025-01").alias("source_period"), (F.col("id") * 2).alias("twice"))
    seen = []

    def parts():
        for i in range(3):
            with pytest.raises(LookupError):
                lake.table("t")
            seen.append(i)
            yield rows.filter(F.col("id") % 3 == i)

    computed = {"key": "md5(concat('f', '|', cast(id as string)))"}
    assert lake.write_table("t", parts(), partition_by="source_period", computed=computed) == 9 and seen == [0, 1, 2]
    table = lake.table("t")
    assert table.columns == ["id", "key", "twice", "source_period"]
    assert rows_of(table) == rows_of(rows.select(*table.columns))
    assert all("key" not in spark.read.parquet(f).columns for f in table.inputFiles())
    lake.write_table("t", rows.drop("key"))
    assert "key" not in lake.table("t").columns


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return sum(f.endswith(".data") for d in dirs for _, _, files in os.walk(d.getPath()) for f in files)


def test_shuffle_files_go_with_their_step(spark, lake, tmp_path):
    files = landed(spark, tmp_path)
    zones = write(tmp_path / "zones.csv", ZONE_LINES)
    build.load_all(lake, files, zones, list(files))
    before = shuffle_files(spark)
    build.build_layers(lake, build.Options(periods=list(files), required_periods=list(files)))
    assert shuffle_files(spark) <= before
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(key)
    with pytest.raises(ValueError), shuffles_removed(spark):
        assert spark.conf.get(key) == "true"
        raise ValueError
    assert spark.conf.get(key) == setting


def test_silver_equals_the_plain_operators(spark, lake, tmp_path, monkeypatch):
    """Accepted trips, summary and ranks of a lake, made in slices, are those of unsliced operators over its labels."""
    monkeypatch.setattr(dedup, "SLICE_ROWS", 40)
    periods = ["2025-01", "2025-02", "2025-03"]
    files = {}
    for n, period in enumerate(periods):
        rows = [{"tip_amount": str(i % 5), "pickup_at": "bad" if i % 7 == n else f"2025-0{1 + i % 3}-05 08:00:00", "dropoff_at": "2025-03-31 08:00:00" if i % 4 else "2025-01-01 00:00:00"} for i in range(30)]
        files[period] = trip_file(spark, tmp_path, period, [*rows, {"fare_amount": str(n)}])
    options = build.Options(periods=periods, required_periods=periods, limits=trips.Limits(max_duration_seconds=365 * 86_400))
    build.run(lake, files, write(tmp_path / "zones.csv", ZONE_LINES), options)
    labels, plain = lake.table(build.LABELLED), build._labels(lake, options.limits)
    assert rows_of(labels) == rows_of(plain.select(*labels.columns))
    clean = lake.table(build.CLEAN)
    assert clean.count() > 3 and rows_of(clean.select(*trips.CLEAN_COLUMNS)) == rows_of(trips.clean(labels))
    assert rows_of(lake.table(build.SUMMARY)) == rows_of(trips.quality_summary(labels))
    assert rows_of(lake.table(build.FACT).select("trip_sk")) == rows_of(clean.select("trip_sk"))
    ranked = rows_of(trips.staged(labels))
    assert rows_of(build.staging(lake)) == ranked
    parts = [part() for part in build.staging_slices(lake)]
    assert len(parts) == 3
    assert sorted(row for part in parts for row in rows_of(part)) == ranked


def test_landed_files_go_before_the_layers_are_built(spark, monkeypatch):
    landed_folders = []
    load = build.load_all
    monkeypatch.setattr(build, "load_all", lambda lake, landed, *rest: (landed_folders.extend(landed.values()), load(lake, landed, *rest)))

    def built(lake, options):
        assert len(landed_folders) == 12 and not any(os.path.exists(f.removeprefix("file://")) for f in landed_folders)
        assert lake.raw(TRIPS).count() > 6000
        raise StopIteration

    monkeypatch.setattr(build, "build_layers", built)
    with pytest.raises(StopIteration):
        queries.pipeline_kpis(spark, "/root/testdata/sf0.001")


def test_lines_are_shuffled_once_and_unless_suppliers_are_many(spark, monkeypatch):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def exchanges():
            df = adapter.trips_raw(spark, "/root/testdata/sf0.001")
            plan = df._jdf.queryExecution().executedPlan().toString()
            return sum("Exchange hashpartitioning(l_" in line for line in plan.splitlines()), rows_of(df)

        once, few = exchanges()
        monkeypatch.setattr(adapter, "BROADCAST_ROWS", 0)
        twice, many = exchanges()
        assert (once, twice) == (1, 2) and few == many
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
