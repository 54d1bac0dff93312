"""Reading the driver's tables, and candidates made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import metrics
from tessera.operators import gates

METRICS = "metric_id string, kind string, lower_is_better boolean, min_score double, max_score double, bounded boolean"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def registry(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """(aliases, metrics) of a small registry for the driver's tables."""
    aliases = [("accuracy", "accuracy", False), ("f1score", "f1", False), ("bleu", "bleu", False), ("ppl", "perplexity", True)]
    rows = [("accuracy", "rate", False, 0.0, 1.0, True), ("f1", "rate", False, 0.0, 1.0, True), ("bleu", "score", False, 0.0, 100.0, False), ("perplexity", "loss", True, 1.0, None, False)]
    return spark.createDataFrame(aliases, "alias string, metric_id string, short boolean"), spark.createDataFrame(rows, METRICS)


def proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A candidate observation for each line item."""
    lines, part, supplier = (table(spark, sf_dir, n) for n in ("lineitem", "part", "supplier"))
    value = F.round(F.col("l_discount") * 1000).cast("int")
    pick = lambda column, n, *options: F.element_at(F.array(*[F.lit(o) for o in options]), (F.col(column) % n).cast("int") + 1)
    return (
        lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("observation_id"),
            F.concat(F.lit("Paper #"), (F.col("l_orderkey") % 997).cast("string")).alias("paper_id"),
            F.col("s_name").alias("system"),
            F.col("p_brand").alias("dataset"),
            pick("l_linenumber", 5, "Accuracy", "F1 score", "BLEU", "PPL", "Speed").alias("metric_raw"),
            pick("l_suppkey", 3, "perplexity", "bleu", None).alias("model_id"),
            F.concat(value.cast("string"), F.when(F.col("l_orderkey") % 3 == 0, "%").otherwise("")).alias("raw"),
            value.cast("double").alias("value"),
            F.lit(None).cast("string").alias("own_unit"),
            F.col("l_linenumber").alias("page"),
            (F.col("l_partkey") % 101 / 100).alias("confidence"),
            pick("l_orderkey", 5, "primary_result", "primary_result", "primary_result", "secondary_result", "setting").alias("claim_type"),
            pick("l_suppkey", 4, "supported", "supported", "supported", "partially_supported").alias("text_support"),
            pick("l_partkey", 7, "single_line", "single_line", "single_line", "single_line", "single_line", "single_line", "consecutive_lines").alias("support_match_mode"),
        )
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proposals with metric, unit, blocker, references, export status and origin basis."""
    out = metrics.resolve(proposals(spark, sf_dir), *registry(spark))
    unit = metrics.inferred_unit(F.col("raw"), F.col("value"), F.col("bounded"), F.col("metric_source") == "registry", F.col("own_unit"))
    out = out.withColumn("unit", unit)
    low, high = metrics.bounds(F.col("unit"), F.col("min_score"), F.col("max_score"))
    out = out.withColumn("value_blocker", metrics.value_blocker(F.col("raw"), F.col("value"), low, high))
    resolved = F.col("metric_id").isNotNull() & (F.col("unit").isNotNull() | ~F.coalesce(F.col("bounded"), F.lit(True)))
    out = out.withColumn("referential_status", F.when(F.col("claim_type") != "primary_result", "unverified").when(resolved, "resolved").otherwise("unresolved"))
    origin = F.element_at(F.array(*map(F.lit, ("no_signal", "unresolved", "paper_produced"))), (F.col("observation_id") % 3).cast("int") + 1)
    basis = gates.origin_basis(origin, F.lit("no_cue"), F.col("claim_type") == "primary_result", F.col("page") == 1)
    return gates.export_policy(out).withColumn("origin_basis", basis)
