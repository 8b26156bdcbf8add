"""The corpus pipeline: documents to packed training sequences in five stages.

Each stage takes what the one before kept and returns the columns of documents;
the last returns the pieces of the packed sequences. No stage but the last can be
expressed for SQL alone, so there is no SQL of the whole.

All stages take documents of any columns beside ``doc_id``, ``text``, ``source`` and
``n_chars`` and hand them on unchanged, whatever their names. Null ids are ids like
others, repeated rows are rows of their own, and texts are read whole. An empty table
stays empty. What each does with null and empty texts is said below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import jaccard, mixing, packing, ranking, secrets
from tripmart.session import remove_stored, scratch, shared_dir

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Null and empty texts are scored by measures that are all zero. Equal texts have
    equal scores, so they stay or go together. Without labels everything stays.
    """
    return ranking.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays.

    Equal texts are one group however short they are, and so are all null and empty
    ones; of rows that have the same id and text one stays.
    """
    return jaccard.deduplicated(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; all documents stay, null texts as they are.

    ``n_chars`` is that of the new text.
    """
    return secrets.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights; documents repeat or go.

    A null source is a source of its own. Texts without a word are never taken. A
    document that the end of a quota cuts keeps its first words, ``n_chars`` with them.
    """
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences; a null or empty text is its end id alone."""
    return packing.pack(docs, packing.tokenizer_path())


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secret_scan),
    ("mixing", mixture),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is stored before the next.

    What a stage stores on its way is deleted once its result is written, and its input,
    if an earlier stage wrote it, too. The result reads the folder of the mixture.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        folder = shared_dir(spark, name.replace(" ", "-"))
        with scratch(spark):
            rows = stage(spark, docs, sf_dir)
            rows.write.parquet(folder)
        docs = spark.read.schema(rows.schema).parquet(folder)
        if before is not None:
            remove_stored(spark, before)
        before = folder
    return STAGES[-1][1](spark, docs, sf_dir)
