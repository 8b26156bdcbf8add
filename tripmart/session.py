"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Trip times carry no zone. UTC keeps every text form of them stable.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # AQE merges small shuffle partitions and splits large ones, so a high
    # starting count serves both a laptop and a large cluster.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A period is text, whatever it looks like.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # A damaged file must stop the load, never shrink it.
    "spark.sql.files.ignoreCorruptFiles": "false",
    "spark.sql.files.ignoreMissingFiles": "false",
    # The JVM does not compile methods above this size. Wide projections then
    # run as many small compiled methods instead of one interpreted one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Raw records are stored shredded, so one field is one column chunk.
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    "spark.sql.variant.allowReadingShredded": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
}


def build_session(app: str = "tripmart", extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings above; ``extra`` wins over them."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def small_methods(spark: SparkSession) -> SparkSession:
    """Set the method limit above in a session that has Spark's default.

    With the default, wide projections become methods that the JVM only interprets.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key, "65535") == "65535":
        spark.conf.set(key, SETTINGS[key])
    return spark


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside it, what an execution has shuffled is deleted when the execution ends.

    Otherwise shuffle files stay until the driver happens to collect its garbage, and a run
    of many steps holds those of all of them. A frame that was executed inside it and is
    executed again shuffles again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Rows written to the shared folder once and read from there."""
    folder = shared_dir(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


#: Folders named inside the innermost ``scratch``, if there is one.
_NAMED: ContextVar[list[str] | None] = ContextVar("named", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes, when it ends, every folder that ``shared_dir`` names inside it.

    For steps that write their result to a folder named before: what they store on the
    way is of no use afterwards. Frames that read such folders must not outlive it. A step
    that fails leaves nothing either.
    """
    outer = _NAMED.set([])
    try:
        yield
    finally:
        named = _NAMED.get() or []
        _NAMED.reset(outer)
        remove_stored(spark, *named)


def remove_stored(spark: SparkSession, *folders: str) -> None:
    """Delete folders that ``shared_dir`` named, once nothing reads them any more."""
    context = spark.sparkContext
    for folder in folders:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder path under the cluster's shared folder.

    The folder is named by ``spark.checkpoint.dir``. Where it is unset, a local
    master gets a temporary folder; a cluster gets an error, because executors
    could not see one another's local disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="tripmart-")
        spark.conf.set("spark.checkpoint.dir", base)
    if "://" not in base and base.startswith("/") and spark.sparkContext.master.startswith("local"):
        os.makedirs(base, exist_ok=True)
    folder = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    named = _NAMED.get()
    if named is not None:
        named.append(folder)
    return folder
