"""Nested records: one for each evaluated system, with its results in a total order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import system_key
from tessera.operators.gates import BASIS_STRENGTH, basis_rank


def coverage_issues(eligible: DataFrame, authorizations: DataFrame) -> DataFrame:
    """(observation_id, issue): eligible rows without an authorization, authorizations without an eligible row, unequal hashes; empty if all is covered.

    Both have observation_id and payload_sha256; a null hash is unequal to any.
    """
    own, given = eligible.select("observation_id", F.col("payload_sha256").alias("_own")), authorizations.select("observation_id", F.col("payload_sha256").alias("_given"))
    both = own.withColumn("_e", F.lit(True)).join(given.withColumn("_a", F.lit(True)), "observation_id", "full")
    issue = F.when(F.col("_a").isNull(), "eligible_not_authorized").when(F.col("_e").isNull(), "authorized_not_eligible").when(~F.coalesce(F.col("_own") == F.col("_given"), F.lit(False)), "stale_authorization")
    return both.select("observation_id", issue.alias("issue")).filter("issue IS NOT NULL")


def compose_records(eligible: DataFrame, version: str | None = None) -> DataFrame:
    """(paper_id, system, version, record_key, results, origin_basis): results sorted by dataset, metric, value and id; the weakest basis of them.

    A record is one version of one system of one paper, so a group is as large as a paper's table of results. Without a version column all
    versions are null; a null system has the key of the empty name.
    """
    own = eligible.withColumn("version", F.col(version) if version else F.lit(None).cast("string"))
    result = F.struct("dataset", "metric_id", "value", "observation_id", "raw", "unit", "page")
    out = own.groupBy("paper_id", "system", "version").agg(F.array_sort(F.collect_list(result)).alias("results"), F.min(basis_rank(F.col("origin_basis"))).alias("rank"))
    names = F.array(*map(F.lit, BASIS_STRENGTH))
    key = system_key(F.coalesce("system", F.lit("")), F.col("version"))
    return out.select("paper_id", "system", "version", key.alias("record_key"), "results", F.element_at(names, F.col("rank") + 1).alias("origin_basis"))
