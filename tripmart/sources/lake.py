"""The table folder: staged writes made visible by one log entry.

Every write goes to a new folder. A version becomes visible when its row lands
in a log, as a small file with the next number. Until then readers see the previous
version, so a failed or lost run leaves nothing to undo. The file is created only if
there is none of its number, so of two writers that read the same log one is refused.

    bronze/<dataset>/source_period=<P>/load_id=<L>/   raw records of one load
    bronze/ingestion_audit/<number>.json              one row per load
    tables/<layer>.<name>/version=<V>/                a rebuilt table
    tables/_versions/<number>.json                    one row per rebuild
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmart.operators.dedup import keep_first
from tripmart.sources import landing, lookup_csv

# Dataset names, the period of the lookup, the load status.
TRIPS = "yellow_taxi"
ZONES = "taxi_zone_lookup"
CURRENT = "CURRENT"
SUCCESS = "SUCCESS"

# Periods captured side by side.
LOADS_AT_ONCE = 16

AUDIT_COLUMNS = [
    "dataset",
    "source_period",
    "source_url",
    "source_file",
    "file_sha256",
    "byte_count",
    "row_count",
    "loaded_at",
    "status",
]
AUDIT_LOG = (
    "dataset string, source_period string, source_url string, source_file string, "
    "file_sha256 string, byte_count long, row_count long, loaded_at timestamp, status string, "
    "load_id string, entry long, field_names array<string>"
)
VERSION_LOG = (
    "name string, version string, row_count long, built_at timestamp, entry long, "
    "computed map<string,string>, column_names array<string>"
)

# Rows are kept for long and mostly hold digests and digits, which this packs far better
# than Spark's default does.
CODEC = "zstd"


# How log rows spell moments.
_MOMENT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


class CommitConflict(RuntimeError):
    """Another writer committed first; nothing of this write is visible."""


@dataclass(frozen=True)
class Load:
    """One committed load."""

    dataset: str
    source_period: str
    load_id: str
    row_count: int


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        for path in (self._audit_path, self._versions_path):
            system, folder = self._place(path)
            system.mkdirs(folder)

    # Logs

    def _place(self, path: str):
        """The file system of a path, and the path as it knows it."""
        context = self.spark.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(context._jsc.hadoopConfiguration()), place

    def _log(self, path: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).option("timestampFormat", _MOMENT).json(path)

    def _next(self, path: str) -> int:
        system, folder = self._place(path)
        names = [status.getPath().getName() for status in system.listStatus(folder)]
        return max((int(name.partition(".")[0]) for name in names if re.fullmatch(r"\d+\.json", name)), default=0) + 1

    def _append(self, path: str, schema: str, row: dict) -> None:
        """Commit point: one row in one new file, whose number nobody else has taken.

        The row is written aside and renamed, which fails if the name is taken. So
        no reader meets half a row.
        """
        entry = self._next(path)
        when = "loaded_at" if "loaded_at" in StructType.fromDDL(schema).fieldNames() else "built_at"
        moment = self.spark.range(1).select(F.date_format(F.current_timestamp(), _MOMENT)).first()[0]
        record = json.dumps({**row, "entry": entry, when: moment})
        system, aside = self._place(f"{path}/.{entry}-{uuid.uuid4().hex}")
        out = system.create(aside, False)
        try:
            out.write(bytearray(record.encode()))
        finally:
            out.close()
        context = self.spark.sparkContext
        hadoop = context._jvm.org.apache.hadoop.fs
        files = hadoop.FileContext.getFileContext(system.getUri(), context._jsc.hadoopConfiguration())
        no_options = context._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            files.rename(aside, hadoop.Path(f"{path}/{entry:012}.json"), no_options)
        except Py4JJavaError as error:
            system.delete(aside, False)
            if "AlreadyExists" in error.java_exception.getClass().getName():
                raise CommitConflict(f"another writer has committed entry {entry} of {path}") from error
            raise

    @property
    def _audit_path(self) -> str:
        return f"{self.root}/bronze/ingestion_audit"

    def audit_log(self) -> DataFrame:
        """The latest log row per dataset and period, with its load id."""
        log = self._log(self._audit_path, AUDIT_LOG)
        return keep_first(log, ["dataset", "source_period"], [F.col("entry").desc()])

    def audit(self) -> DataFrame:
        """One row per dataset and period."""
        return self.audit_log().select(*AUDIT_COLUMNS)

    # Bronze loads

    def _raw_root(self, dataset: str) -> str:
        return f"{self.root}/bronze/{dataset}"

    def _write(self, rows: DataFrame, dataset: str, period: str) -> tuple[str, int]:
        """Write a load's folder, which nobody sees yet; its id and row count."""
        load_id = uuid.uuid4().hex
        counted = Observation()
        (
            rows.drop("source_period")
            .observe(counted, F.count(F.lit(1)).alias("row_count"))
            .write.mode("errorifexists")
            .option("compression", CODEC)
            .parquet(f"{self._raw_root(dataset)}/source_period={period}/load_id={load_id}")
        )
        row_count = counted.get["row_count"]
        if not row_count:
            raise landing.EmptyLoad(f"no rows for {dataset} {period}")
        return load_id, row_count

    def _commit(
        self,
        written: tuple[str, int],
        dataset: str,
        period: str,
        origin: Row,
        url: str,
        field_names: Sequence[str] | None = None,
    ) -> Load:
        load_id, row_count = written
        self._append(
            self._audit_path,
            AUDIT_LOG,
            {
                "dataset": dataset,
                "source_period": period,
                "source_url": url,
                "source_file": origin.source_file,
                "file_sha256": origin.file_sha256,
                "byte_count": origin.byte_count,
                "row_count": row_count,
                "status": SUCCESS,
                "load_id": load_id,
                "field_names": list(field_names) if field_names is not None else None,
            },
        )
        return Load(dataset, period, load_id, row_count)

    def load_period(
        self, path: str, period: str, dataset: str = TRIPS, url: str | None = None, origin: Row | None = None
    ) -> Load:
        """Capture a landed Parquet file, or a folder of them, and replace its period.

        ``origin`` may bring the audit facts if they are known already.
        """
        landing.check_form([period])
        origin = origin or landing.origin(self.spark, path)
        written, names = self._capture(path, period, dataset, origin)
        return self._commit(written, dataset, period, origin, url or path, names)

    def _capture(self, path: str, period: str, dataset: str, origin: Row) -> tuple[tuple[str, int], list[str]]:
        if not origin.has_signature:
            raise ValueError(f"{path} is not a Parquet file")
        rows, names = landing.capture(self.spark, path, period, origin.schemas)
        return self._write(rows, dataset, period), names

    def load_periods(self, landed: Mapping[str, str], dataset: str = TRIPS) -> list[Load]:
        """Load several periods: hashed by one job, captured side by side, committed in order.

        One landed file may be one task, so a period after the other would leave most of
        a cluster idle. A failure keeps the loads of the periods before it; what those
        after it have written stays unreferenced.
        """
        landing.check_form(list(landed))
        origins = landing.origins(self.spark, landed)
        loads = []
        with ThreadPoolExecutor(LOADS_AT_ONCE) as pool:
            captures = {
                period: pool.submit(inheritable_thread_target(self.spark)(self._capture), path, period, dataset, origins[period])
                for period, path in landed.items()
            }
            try:
                for period, path in landed.items():
                    written, names = captures[period].result()
                    loads.append(self._commit(written, dataset, period, origins[period], path, names))
            finally:
                pool.shutdown(wait=True, cancel_futures=True)
        return loads

    def load_lookup(self, path: str, dataset: str = ZONES, url: str | None = None) -> Load:
        """Replace the whole zone lookup."""
        origin = landing.origin(self.spark, path)
        rows = lookup_csv.read_lookup(self.spark, path)
        return self._commit(self._write(rows, dataset, CURRENT), dataset, CURRENT, origin, url or path)

    def loads(self, dataset: str) -> list[Row]:
        """The visible loads of a dataset: one small row per period."""
        return (
            self.audit_log()
            .filter(F.col("dataset") == dataset)
            .select("source_period", "load_id", "field_names")
            .orderBy("source_period")
            .collect()
        )

    def raw(self, dataset: str, periods: Iterable[str] | None = None) -> DataFrame:
        """Visible raw rows. Only the folders of visible loads are listed."""
        wanted = None if periods is None else set(periods)
        root = self._raw_root(dataset)
        folders = [
            f"{root}/source_period={row.source_period}/load_id={row.load_id}"
            for row in self.loads(dataset)
            if wanted is None or row.source_period in wanted
        ]
        if not folders:
            raise LookupError(f"nothing loaded for {dataset}")
        rows = self.spark.read.option("basePath", root).parquet(*folders)
        return rows.withColumn("source_period", F.col("source_period").cast("string")).drop("load_id")

    def field_names(self, dataset: str) -> list[str]:
        """Every top-level key that occurs in the visible raw records."""
        return sorted({name for row in self.loads(dataset) for name in row.field_names or []})

    def remove_replaced(self) -> list[str]:
        """Delete the folders that no current log row points to; return them.

        For after a run: a reader that still holds an older version would lose it.
        Folders of a write that is under way look the same, so nothing may write.
        """
        current = {
            f"{self._raw_root(row.dataset)}/source_period={row.source_period}/load_id={row.load_id}"
            for row in self.audit_log().select("dataset", "source_period", "load_id").collect()
        }
        versions = keep_first(self._log(self._versions_path, VERSION_LOG), ["name"], [F.col("entry").desc()])
        current |= {f"{self.root}/tables/{row.name}/version={row.version}" for row in versions.select("name", "version").collect()}
        context = self.spark.sparkContext
        hadoop = context._jvm.org.apache.hadoop.fs
        top = hadoop.Path(self.root)
        system = top.getFileSystem(context._jsc.hadoopConfiguration())
        kept = {system.makeQualified(hadoop.Path(path)).toString() for path in current}
        removed = []
        for pattern in ("bronze/*/source_period=*/load_id=*", "tables/*/version=*"):
            for status in system.globStatus(hadoop.Path(top, pattern)) or []:
                if status.getPath().toString() not in kept:
                    system.delete(status.getPath(), True)
                    removed.append(status.getPath().toString())
        return removed

    # Rebuilt tables

    @property
    def _versions_path(self) -> str:
        return f"{self.root}/tables/_versions"

    def write_table(
        self,
        name: str,
        rows: DataFrame | Iterable[DataFrame],
        partition_by: str | None = None,
        rebalance: bool = False,
        computed: Mapping[str, str] | None = None,
    ) -> int:
        """Rebuild a table in full and return its row count.

        ``rows`` may come in parts, written one after the other and made visible
        together, so that only one part's shuffle is on disk at a time. With
        ``rebalance`` the rows are first gathered by ``partition_by``: AQE
        splits a large value over several tasks and merges small ones. It is
        for rows that come out of a shuffle in another order. ``computed`` columns
        are not stored but made by ``table`` from the SQL given here, which the log keeps.
        """
        version = uuid.uuid4().hex
        computed = dict(computed or {})
        row_count, names = 0, None
        for part in [rows] if isinstance(rows, DataFrame) else rows:
            counted = Observation()
            names = names or [*(c for c in part.columns if c != partition_by), *([partition_by] if partition_by else [])]
            part = part.drop(*computed)
            if rebalance:
                part = part.hint("rebalance", *([partition_by] if partition_by else []))
            writer = part.observe(counted, F.count(F.lit(1)).alias("row_count")).write.option("compression", CODEC)
            if partition_by:
                writer = writer.partitionBy(partition_by)
            writer.mode("append").parquet(f"{self.root}/tables/{name}/version={version}")
            row_count += counted.get["row_count"]
        self._append(
            self._versions_path,
            VERSION_LOG,
            {
                "name": name,
                "version": version,
                "row_count": row_count,
                **({"computed": computed, "column_names": names} if computed else {}),
            },
        )
        return row_count

    def table(self, name: str) -> DataFrame:
        """The current version of a rebuilt table."""
        log = self._log(self._versions_path, VERSION_LOG).filter(F.col("name") == name)
        latest = log.orderBy(F.col("entry").desc()).select("version", "computed", "column_names").first()
        if latest is None:
            raise LookupError(f"table {name} was never built")
        rows = self.spark.read.parquet(f"{self.root}/tables/{name}/version={latest.version}")
        if "source_period" in rows.columns:
            rows = rows.withColumn("source_period", F.col("source_period").cast("string"))
        if latest.computed:
            made = {column: F.expr(sql) for column, sql in latest.computed.items()}
            rows = rows.withColumns(made).select(*latest.column_names)
        return rows
