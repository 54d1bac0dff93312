"""Metric identity, units, bounds and value gates as columns over a metric dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import bare_value, literal, semantic_name

BOUNDED = ("percent", "proportion", "probability")
#: Spellings of a unit and its canonical name.
UNITS = {
    "%": "percent", "pct": "percent", "percent": "percent", "percentage": "percent", "percentages": "percent",
    "percentage point": "percentage_points", "percentage points": "percentage_points",
    "proportion": "proportion", "proportions": "proportion", "probability": "probability", "probabilities": "probability",
}


def unit(x: Column) -> Column:
    """The canonical unit; spaces, hyphens and underscores are one; unknown units stay, trimmed; null is null."""
    bare = F.trim(x)
    known = F.create_map(*[F.lit(v) for pair in UNITS.items() for v in pair])
    return F.coalesce(F.try_element_at(known, F.regexp_replace(F.lower(bare), r"[\s_-]+", " ")), bare)


def unit_compatible(of_unit: Column, bounded: Column) -> Column:
    """Whether a metric may have the unit: one on the bounded scale only a share, or none."""
    canonical = unit(of_unit)
    return ~F.coalesce(bounded, F.lit(False)) | canonical.isNull() | canonical.isin(*BOUNDED)


def percent_notation(raw: Column, quotes: Column) -> Column:
    """How quotes print a value: absent, percent, mixed or unmarked, over all occurrences of its bare form."""
    token = bare_value(raw)
    pattern = F.concat(F.lit(r"(?<![\d.,])"), literal(token), F.lit(r"(\s*%)?(?![\w%])"))
    marks = F.flatten(F.transform(F.coalesce(quotes, F.array()), lambda q: F.regexp_extract_all(q, pattern, F.lit(1))))
    return (
        F.when((token == "") | (F.size(marks) == 0), "absent")
        .when(F.forall(marks, lambda m: m != ""), "percent")
        .when(F.exists(marks, lambda m: m != ""), "mixed")
        .otherwise("unmarked")
    )


def resolve(candidates: DataFrame, aliases: DataFrame, metrics: DataFrame) -> DataFrame:
    """metric_raw and model_id with metric_id, source and the definition's columns.

    A plain alias decides alone; a short one only where the model's id agrees; then the model's id; else none.
    The dimension is a registry of names, small beside the candidates, and joined as its size allows.
    """
    key = F.translate(semantic_name(F.col("metric_raw")), " ", "")
    # An alias of several metrics decides for none; a repeated row of one metric is one.
    once = aliases.groupBy("alias", "short").agg(F.min("metric_id").alias("metric_id"), F.max("metric_id").alias("last"))
    aliases = once.filter("short OR metric_id = last").drop("last")
    plain = aliases.filter("not short").select(F.col("alias").alias("plain_alias"), F.col("metric_id").alias("plain_id"))
    short = aliases.filter("short").select(F.col("alias").alias("short_alias"), F.col("metric_id").alias("short_id"))
    out = candidates.withColumn("alias_key", key)
    out = out.join(plain, out["alias_key"] == plain["plain_alias"], "left")
    out = out.join(short, (out["alias_key"] == short["short_alias"]) & (out["model_id"] == short["short_id"]), "left")
    source = F.when(F.col("plain_id").isNotNull(), "registry").when(F.col("short_id").isNotNull(), "registry_concordant").when(F.col("model_id").isNotNull(), "model").otherwise("none")
    out = out.withColumn("metric_source", source).withColumn("metric_id", F.coalesce("plain_id", "short_id", "model_id"))
    return out.drop("alias_key", "plain_alias", "plain_id", "short_alias", "short_id").join(metrics, "metric_id", "left")


def inferred_unit(raw: Column, value: Column, bounded: Column, plain: Column, own: Column, notation: Column | None = None) -> Column:
    """The shared unit: the printed one, or for metrics on the bounded scale a percent sign, the quotes' notation, or a number's range.

    Mixed notation gives none. A bare number over 1 is a percentage only where a plain alias decided and no quote marks it.
    """
    notation = F.lit("unmarked") if notation is None else notation
    return (
        F.when(own.isNotNull(), own)
        .when(~F.coalesce(bounded, F.lit(False)) | (notation == "mixed"), F.lit(None).cast("string"))
        .when(F.contains(raw, F.lit("%")) | (notation == "percent"), "percent")
        .when((value >= 0) & (value <= 1), "proportion")
        .when((notation == "unmarked") & plain & (value > 1) & (value <= 100), "percent")
    )


def bounds(of_unit: Column, low: Column, high: Column) -> tuple[Column, Column]:
    share = of_unit.isin("proportion", "probability")
    first = F.when(of_unit == "percent", 0.0).when(share, 0.0).otherwise(low)
    return first, F.when(of_unit == "percent", 100.0).when(share, 1.0).otherwise(high)


#: Fixed value: wording that makes a signed value a difference.
DIFFERENCE = r"(?i)\u0394|\b(?:delta|improv\w*|gain(?:s|ed)?|diff(?:erences?|erential)?|change[sd]?|increase[sd]?|decrease[sd]?)\b"


def range_issue(value: Column, low: Column, high: Column, lower: Column, upper: Column) -> Column:
    """Why a value or its interval does not fit the bounds, or null; NaN and infinity never do."""
    outside = lambda x: F.isnan(x) | (F.abs(x) == float("inf")) | F.coalesce(x < low, F.lit(False)) | F.coalesce(x > high, F.lit(False))
    half = lower.isNull() != upper.isNull()
    wrong = outside(lower) | outside(upper) | (lower > upper) | (value < lower) | (value > upper)
    return F.when(outside(value), "value_outside_registry_metric_bounds").when(
        half | F.coalesce(wrong, F.lit(False)), "uncertainty_interval_outside_registry_metric_bounds"
    )


def value_blocker(raw: Column, value: Column, low: Column, high: Column, lower: Column | None = None, upper: Column | None = None, wording: Column | None = None) -> Column:
    """Why a value may not be exported, or null. wording: the texts that describe it; a sign with difference wording is a difference."""
    none = F.lit(None).cast("double")
    described = F.exists(F.coalesce(wording, F.array()), lambda t: F.coalesce(F.regexp_like(t, F.lit(DIFFERENCE)), F.lit(False))) if wording is not None else F.lit(False)
    signed = F.regexp_like(raw, F.lit(r"^\s*\+")) | F.regexp_like(raw, F.lit(r"^\s*[\-\u2212\u2013]")) & described
    issue = range_issue(value, low, high, none if lower is None else lower, none if upper is None else upper)
    return F.when(F.coalesce(signed, F.lit(False)), "signed_difference_value").otherwise(issue)
