"""Line dedup over levelled sorted runs of line hashes.

A run is a table of (a, b, n, top) with one row for each line key that its batch brought first: a 128-bit hash, how
many documents of the batch hold it, the largest id among them. Runs are bucketed and sorted by hash, so that they meet in
merge joins without a shuffle, and share no key. A new batch merge-anti-joins the runs: what is left is its own run at
level 0, the rest are counts of keys known already. When a level holds `fanout` runs they are compacted into one
of the next level. A key's total is its run's row and the later counts of it.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, SPACE, UPPER, Scratch, joined_by_share, lower_ascii, shuffle_partitions, table


#: A line key that so large a share of all rows holds is broadcast.
HOT = 1e-4


def split_lines(text: Column) -> Column:
    """Lines between \\n; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line, stripped of [\\x20\\x09-\\x0D] at both ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(SPACE)))


def key_hash(key: Column) -> Column:
    """128 bits of a key."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b"))


def _merge_two(x: DataFrame, y: DataFrame) -> DataFrame:
    """Two runs as one; no key is in both."""
    x, y = x.hint("merge").alias("x"), y.alias("y")
    return x.join(y, ["a", "b"], "full").select("a", "b", F.coalesce("x.n", "y.n").alias("n"), F.coalesce("x.top", "y.top").alias("top"))


class LineRuns:
    """The store: levels of runs, each a bucketed table in the shared folder, and the counts of keys met again."""

    def __init__(self, scratch: Scratch, fanout: int = 2):
        self.scratch, self.spark, self.fanout = scratch, scratch.spark, fanout
        self.buckets = shuffle_partitions(self.spark)
        self.levels: list[list[tuple[str, str]]] = [[]]
        self.again: list[DataFrame] = []

    def _write(self, run: DataFrame) -> tuple[str, str]:
        name, path = f"line_run_{uuid.uuid4().hex}", self.scratch.path("run")
        run.write.format("parquet").option("path", path).bucketBy(self.buckets, "a", "b").sortBy("a", "b").saveAsTable(name)
        return name, path

    def _drop(self, run: tuple[str, str]) -> None:
        self.spark.sql(f"DROP TABLE {run[0]}")
        self.scratch.remove(run[1])

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name, _ in level]

    def fresh(self, batch: DataFrame) -> DataFrame:
        """The batch's rows whose key no run holds: one merge anti join for each run."""
        for run in self.runs():
            batch = batch.join(run.hint("merge"), ["a", "b"], "left_anti")
        return batch

    def add(self, holders: DataFrame) -> None:
        """holders(a, b, doc_id): a row for each document and key of the new batch."""
        own = self._write(holders.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("top")))
        if any(self.levels):
            batch = self.spark.table(own[0])
            new = self._write(self.fresh(batch))
            self.again.append(self.scratch.keep(batch.join(self.spark.table(new[0]).hint("merge"), ["a", "b"], "left_anti"), "again"))
            self._drop(own)
        else:
            new = own
        self.levels[0].append(new)
        for k, level in enumerate(self.levels):
            if len(level) >= self.fanout:
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append(self._merge(level))
                self.levels[k] = []

    def _merge(self, runs: list[tuple[str, str]]) -> tuple[str, str]:
        # Full outer merge joins, as runs are bucketed and sorted alike; a union would be shuffled or mis-grouped.
        merged = self._write(reduce(_merge_two, [self.spark.table(name) for name, _ in runs]))
        for run in runs:
            self._drop(run)
        return merged

    def totals(self, least: int) -> DataFrame:
        """(a, b, n, top) of the keys that at least so many documents hold."""
        whole = reduce(_merge_two, self.runs())
        if self.again:
            later = reduce(DataFrame.unionByName, self.again).groupBy("a", "b").agg(F.sum("n").alias("more"), F.max("top").alias("last"))
            whole = whole.join(later, ["a", "b"], "left")
            whole = whole.select("a", "b", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"), F.greatest("top", "last").alias("top"))
        return whole.filter(F.col("n") >= least)

    def close(self) -> None:
        """The runs go from the catalogue and the folder."""
        for level in self.levels:
            for run in level:
                self._drop(run)
        self.scratch.drop(*self.again)
        self.levels, self.again = [[]], []


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4, scratch: Scratch | None = None) -> DataFrame:
    """docs(doc_id, text, ...) with n_lines, n_dropped and kept: the text without repeated lines.

    A key of at least min_chars code points in at least min_docs documents (rows) loses all
    its lines but those of the largest doc_id that holds it; lines that stay keep their order and
    bytes, joined by \\n. A null or empty text is one empty line, and stays empty. A line that
    a document repeats counts once for it. Rows with a null doc_id count as documents but keep
    their lines; rows that share a doc_id are documents of their own. Other columns pass.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    lines = split_lines(F.col("text"))
    keys = F.array_distinct(
        F.filter(F.transform(F.filter(lines, lambda x: F.char_length(x) >= min_chars), line_key), lambda x: F.char_length(x) >= min_chars)
    )
    held = docs.select("doc_id", F.explode(F.transform(keys, key_hash)).alias("key")).select(
        "doc_id", "key.a", "key.b", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch")
    )
    held = scratch.keep(held, "held", partition_by="batch")
    runs = LineRuns(scratch)
    for batch in range(batches):
        runs.add(held.filter(F.col("batch") == batch))
    repeated = scratch.keep(runs.totals(min_docs), "repeated")
    runs.close()
    rows = held.count()
    # A key that the share HOT of all rows or more holds: there are at most 1 / HOT of them.
    hot = F.col("n") >= max(1, int(HOT * rows))
    gone = (
        joined_by_share(held.drop("batch"), ["a", "b"], repeated.filter(hot).select("a", "b", "top", "n"), repeated.filter(~hot).select("a", "b", "top", "n"))
        .filter("doc_id <> top")
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("a", "b")).alias("gone_keys"))
        .withColumnRenamed("doc_id", "gone_id")
    )
    joined = docs.join(gone, F.col("doc_id") == F.col("gone_id"), "left").drop("gone_id")
    stays = lambda x: (F.char_length(x) < min_chars) | ~F.array_contains(F.col("gone_keys"), key_hash(line_key(x)))
    kept = F.when(F.col("gone_keys").isNull(), lines).otherwise(F.filter(lines, stays))
    return (
        joined.withColumn("kept_lines", kept)
        .withColumn("n_lines", F.size(lines).cast("long"))
        .withColumn("n_dropped", F.col("n_lines") - F.size("kept_lines"))
        .withColumn("kept", F.array_join("kept_lines", "\n"))
        .drop("gone_keys", "kept_lines")
    )


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


_STRIP = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP8_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line FROM d),
k AS (SELECT *, translate(trim(line, {_STRIP}), '{UPPER}', '{LOWER}') AS key FROM l),
t AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT r) >= 5)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE t.key IS NOT NULL AND k.doc_id <> t.top) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE t.key IS NULL OR k.doc_id = t.top), '')) AS kept_sha256
FROM k LEFT JOIN t ON k.key = t.key GROUP BY k.r, k.doc_id
"""
