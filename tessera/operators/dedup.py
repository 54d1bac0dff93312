"""Duplicate proposals: semantic keys, merges, ambiguity."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text


def semantic_key(*parts: Column) -> Column:
    """A hash of the parts; null and empty differ."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("~")) for p in parts]), 256)


def merge_duplicates(df: DataFrame, keys: list[str], order: str, united: tuple[str, ...] = ()) -> DataFrame:
    """One row for each key: the first by order, the number merged, the largest confidence, and the sorted unions of the array columns named.

    Rows with a null key merge with each other. Of rows that tie in order the least stands, so the result is one and the same.
    """
    rest = [c for c in df.columns if c not in keys and c not in united]
    first = F.min(F.struct(F.col(order).alias("_order"), *rest)).alias("first")
    unions = [F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c) for c in united]
    out = df.groupBy(*keys).agg(first, F.count(F.lit(1)).alias("merged"), F.max("confidence").alias("best"), *unions)
    kept = [F.col(f"first.{c}").alias(c) for c in rest if c != "confidence"]
    return out.select(*keys, *kept, *united, "merged", F.col("best").alias("confidence"))


def ambiguous(df: DataFrame, place: list[str], value: Column, names: list[str], quote: str, primary: Column) -> DataFrame:
    """df with ambiguous: another primary row of the same place (paper, source, page) and printed value means something else by overlapping quotes.

    Two rows conflict if some name of theirs is incompatible (neither empty, equal, nor one's words within the other's); their quotes
    overlap if equal or one within the other. Rows meet their group's distinct meanings, as many as one page has, not each other.
    Rows that are not primary, or whose value is null, are never ambiguous.
    """
    meaning = F.struct(*[text.semantic_name(F.col(n)).alias(n) for n in names], F.coalesce(F.col(quote), F.lit("")).alias("_quote"))
    own = df.withColumn("_value", F.when(primary, F.lower(text.evidence_text(value)))).withColumn("_own", meaning)
    keys = [*place, "_value"]
    seen = own.filter(F.col("_value").isNotNull()).groupBy(*keys).agg(F.collect_set("_own").alias("_all"))
    joined = own.join(seen, keys, "left")

    def conflicts(other: Column) -> Column:
        apart = [~text.names_compatible(F.col("_own")[n], other[n]) for n in names]
        either = F.contains(F.col("_own")["_quote"], other["_quote"]) | F.contains(other["_quote"], F.col("_own")["_quote"])
        return reduce(or_, apart) & either

    found = F.coalesce(F.exists(F.col("_all"), conflicts), F.lit(False))
    return joined.withColumn("ambiguous", found).drop("_value", "_own", "_all")


def demote_ambiguous(df: DataFrame) -> DataFrame:
    """Ambiguous rows become wrong_scope and needs_review; others stay."""
    to = lambda c, v: F.when(F.col("ambiguous"), v).otherwise(F.col(c))
    reason = "ambiguous evidence: the same quoted value has incompatible essential semantics"
    return df.withColumn("referential_status", to("referential_status", "wrong_scope")).withColumn("export_status", to("export_status", "needs_review")).withColumn("export_reason", to("export_reason", reason))


def dedup_key(cell: Column, is_ambiguous: Column, has_value: Column, on_table: Column, payload: Column, semantic: Column) -> Column:
    """(kind, key): a bound cell's identity; the exact payload of an ambiguous row or of a table value without a cell; else the semantic key."""
    kind = F.when(cell.isNotNull(), "physical").when(is_ambiguous | (has_value & on_table), "unbound_table").otherwise("semantic")
    return F.struct(kind.alias("kind"), F.coalesce(cell, F.when(is_ambiguous | (has_value & on_table), payload), semantic).alias("key"))
