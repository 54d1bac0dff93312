"""What the two classifiers share: a bounded training sample, and scoring of whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import fold

#: Every how many-th document, by crc32 of its id, is held out of training.
FOLDS = 5


#: Longer texts are scored but not learned from, so that the sample is bounded in bytes too.
LONGEST = 1 << 17


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(text, y) of at most `most` labelled documents outside fold 0, those with the least hash of their id.

    Only these rows' labels are ever read for learning. Null labels and ids take no part; of
    several labels for one id the largest counts, of several texts the least. Texts of more than LONGEST bytes are left out.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), FOLDS) != 0))
    ids = known.groupBy("doc_id").agg(F.max(label).cast("double").alias("y"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # At most `most` rows of two numbers: the broadcast's size is bounded by that parameter.
    texts = docs.select("doc_id", "text").filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= LONGEST)
    return texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y")).select("text", "y")


def scored(docs: DataFrame, score: Callable[[list[str | None]], np.ndarray], threshold: float) -> DataFrame:
    """docs with held_out, score (0 to 1) and predicted; score() takes a few hundred whole texts at a time."""
    kept = list(docs.schema.fields)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                values = np.clip(score(part.column(at).to_pylist()), 0.0, 1.0)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, pa.float64())], names=[*part.schema.names, "score"])

    out = docs.mapInArrow(run, T.StructType([*kept, T.StructField("score", T.DoubleType())]))
    return out.withColumn("held_out", fold(F.col("doc_id"), FOLDS) == 0).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def folds_of(n: int, k: int) -> np.ndarray:
    return np.random.default_rng(0).permutation(n) % k
