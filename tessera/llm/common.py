"""What the corpus operators share: reading tables, tables in the shared folder, words, folds."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that every contract here names: [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """The UTF-8 words of a text, split at [\\x20\\x09-\\x0D]+, with A-Z lower-cased and nothing else.

    bytes.lower() changes ASCII only and bytes.split() splits at exactly that white space.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def fold(key: Column, modulus: int) -> Column:
    """crc32 of the key's text, modulo modulus; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8")), F.lit(modulus))


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


class Scratch:
    """Written tables in the shared folder of the cluster (spark.checkpoint.dir).

    They cut lineage and survive lost executors. Without that setting a folder of
    this machine serves, which only a local master may use.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            root = "file://" + os.path.join(tempfile.gettempdir(), "tessera-scratch")
        self.root = f"{root.rstrip('/')}/tessera-{uuid.uuid4().hex}"
        self.count = 0

    def path(self, name: str) -> str:
        self.count += 1
        return f"{self.root}/{self.count:03d}-{name}"

    def keep(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        """df, written once and read back."""
        path = self.path(name)
        writer = df.write.partitionBy(partition_by) if partition_by else df.write
        writer.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._scratch = path
        return back

    def drop(self, *tables: DataFrame) -> None:
        """Delete written tables that nothing reads any more."""
        for df in tables:
            self.remove(df._scratch)

    def remove(self, path: str) -> None:
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def small_batches(spark: SparkSession, partitions: int, rows: int = 1000, size: str = "8m"):
    """While tables are written in here, whole texts go to Python in small batches, and shuffles have at least so many partitions."""
    own = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": size}
    if partitions > shuffle_partitions(spark):
        own["spark.sql.shuffle.partitions"] = str(partitions)
    before = {k: spark.conf.get(k, None) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def joined_by_share(df: DataFrame, on: str | list[str], often: DataFrame, rest: DataFrame) -> DataFrame:
    """df joined with the rows of often, which are broadcast, and for what they lack with those of rest: no key of the shuffle is hot.

    often is of proven size; its last column is never null.
    """
    some = df.join(F.broadcast(often), on, "left")
    last = often.columns[-1]
    missing = some.filter(F.col(last).isNull()).select(*df.columns)
    return some.filter(F.col(last).isNotNull()).unionByName(missing.join(rest, on))


def shared(spark: SparkSession, value, build: Callable | None = None):
    """A function that returns value, or build(value), on executors: one broadcast, made once for each Python worker.

    Workers keep a broadcast's list over tasks, so what is made goes in there. Callers state the bound of value's size.
    """
    raw = spark.sparkContext.broadcast([cloudpickle.dumps((value, build)), False])

    def get():
        held = raw.value
        if not held[1]:
            own, make = cloudpickle.loads(held[0])
            held[:] = [make(own) if make else own, True]  # the bytes go
        return held[0]

    return get
