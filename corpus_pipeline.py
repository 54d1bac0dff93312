"""A training corpus from raw documents: five stages, each one of the operators of tessera.llm.

run(spark, sf_dir) writes each stage as Parquet in the shared folder and reads it as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, linededup, pieces, quality, similar
from tessera.llm.common import Scratch, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled ones among docs."""
    judged = quality.classify(docs, table(spark, sf_dir, "labels"))
    return judged.filter("predicted = 1").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that many documents share; n_chars follows, no document goes."""
    cleaned = linededup.dedup_lines(docs).withColumn("text", F.col("kept"))
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group: SimHash links and bands propose, five-word similarity decides."""
    return similar.one_of_each(docs).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, decoded again to see that nothing is lost."""
    return pieces.encode_texts(docs).select("doc_id", "lang", "source", "ids", "n_ids", "round_trip")


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("near-dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("encoding", encode),
]
#: The classifier and the encoder are not expressible in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    out = STAGES[-1][1](spark, docs, sf_dir)
    # Queries are compared by value, so arrays leave as text.
    return out.withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), " "))
