"""The zone lookup: a comma-separated file read as text with row numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.sources.landing import relative_file

# The header of the lookup and the texts that mean NULL.
HEADER = ["LocationID", "Borough", "Zone", "service_zone"]
COLUMNS = ["location_id", "borough", "zone", "service_zone"]
NULL_TEXTS = ["", "NULL", "null"]


def check_header(spark: SparkSession, path: str, expected: list[str] | None = None) -> None:
    """Refuse a file whose header differs in name, case or order."""
    found = spark.read.option("header", True).option("escape", '"').csv(path).columns
    if found != (expected or HEADER):
        raise ValueError(f"lookup header changed: expected {expected or HEADER}, found {found}")


def read_lookup(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Lookup rows as text with file, row number and load time.

    A row with too few or too many fields stops the read. The file is split
    between tasks unless ``multiline`` is set, which quoted line breaks need;
    without it such a break has the wrong number of fields and stops the read.
    """
    check_header(spark, path)
    schema = ", ".join(f"`{name}` string" for name in HEADER)
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("multiLine", multiline)
        .csv(path)
        .select(
            *(
                F.when(~F.col(name).isin(*NULL_TEXTS), F.col(name)).alias(column)
                for name, column in zip(HEADER, COLUMNS)
            ),
            relative_file(spark, path, F.col("_metadata.file_path")).alias("source_file"),
            F.col("_metadata.file_block_start").alias("__block"),
        )
    )
    return number_rows(rows).withColumn("loaded_at", F.current_timestamp())


def number_rows(rows: DataFrame) -> DataFrame:
    """Row number within each file, from 0.

    Rows are numbered inside their file block, whose size is bounded by the
    split size, and the counts of the blocks before are added.
    """
    blocks = rows.groupBy("source_file", "__block").agg(F.count(F.lit(1)).alias("__size"))
    earlier = (
        Window.partitionBy("source_file")
        .orderBy("__block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = blocks.select(
        "source_file", "__block", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__before")
    )
    inside = Window.partitionBy("source_file", "__block").orderBy("__seen")
    return (
        rows.withColumn("__seen", F.monotonically_increasing_id())
        .withColumn("__local", F.row_number().over(inside))
        .join(offsets, ["source_file", "__block"])
        .withColumn("source_row_number", (F.col("__before") + F.col("__local") - 1).cast("long"))
        .drop("__block", "__before", "__local", "__seen")
    )
