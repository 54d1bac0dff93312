"""Which dataset of a paper's inventory a printed name means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import contains_term, printed_name, words

#: Words that name a split, a set in general, and nothing at all.
SPLITS = ("train", "training", "dev", "development", "validation", "val", "test", "testing")
GENERIC = ("dataset", "data", "corpus", "overall", "all", "total")
FILLERS = ("the", "our", "a", "an", "of", "on", "in", "for", "and", "with", "set", "split", "subset", "partition", "fold")
SPLIT = "^(?:" + "|".join(SPLITS) + ")(?: (?:set|split|data|partition|fold))?$"


def unique_rule(raw: Column, languages: tuple[str, ...] = ()) -> Column:
    """Why a normalised name is no name: a split word, a table's number, a generic word, or languages only; null if it is one."""
    listed = F.array(*map(F.lit, languages)) if languages else F.array().cast("array<string>")
    return (
        F.when(F.regexp_like(raw, F.lit(SPLIT)), "unique_split_word")
        .when(F.regexp_like(raw, F.lit(r"^(?:table|tab|tbl) \d+[a-z]?$")), "unique_table_reference")
        .when(raw.isin(*GENERIC), "unique_generic_word")
        .when((F.size(words(raw)) > 0) & (F.size(F.array_except(words(raw), listed)) == 0), "unique_language_name")
    )


def split_of(split: Column, column_header: Column, caption: Column) -> Column:
    """The split that a column's header begins with, else that the caption names; only where none is given."""
    header = F.lower(F.regexp_extract(F.trim(F.coalesce(column_header, F.lit(""))), r"(?i)^(test|dev|development|validation|val|train(?:ing)?)\b", 1))
    named = F.lower(F.regexp_extract(F.coalesce(caption, F.lit("")), r"(?i)\bon the (test|dev|development|validation) (?:set|split|data)\b", 1))
    found = F.coalesce(F.nullif(header, F.lit("")), F.nullif(named, F.lit("")))
    return F.when(F.trim(F.coalesce(split, F.lit(""))) == "", found)


def inventory(entries: DataFrame, paper: str = "paper_id") -> DataFrame:
    """entries(paper_id, entry_id, name_raw, kind, aliases) -> one row for each paper with its entries' normalised terms, in order of entry_id."""
    terms = F.filter(F.array_distinct(F.concat(F.array(printed_name(F.col("name_raw"))), F.transform(F.coalesce("aliases", F.array().cast("array<string>")), printed_name))), lambda t: F.length(t) >= 2)
    own = entries.withColumn("terms", terms).filter("size(terms) > 0").withColumn("name", printed_name(F.col("name_raw")))
    return own.groupBy(paper).agg(F.array_sort(F.collect_list(F.struct("entry_id", "name_raw", "kind", "name", "terms"))).alias("entries"))


def bind(df: DataFrame, entries: DataFrame, raw: str, table_text: str, languages: tuple[str, ...] = (), paper: str = "paper_id") -> DataFrame:
    """df with entry_id, binding and rule: the cascade exact name or alias, the anchored table's caption and header, the paper's one dataset.

    table_text: caption and header of the table that the row is anchored in, null outside tables. A paper's inventory is small beside
    the rows and is met by the paper's key. Without an inventory, and where two entries fit, nothing is bound.
    """
    own = df.join(inventory(entries, paper).withColumnRenamed("entries", "_all"), paper, "left")
    own = own.withColumn("_raw", printed_name(F.col(raw))).withColumn("_all", F.coalesce("_all", F.array()))
    name, all_, rule = F.col("_raw"), F.col("_all"), unique_rule(F.col("_raw"), languages)
    exact = F.filter(all_, lambda e: (e["name"] == name) | F.array_contains(e["terms"], name))
    hay = printed_name(F.col(table_text))
    shown = F.filter(all_, lambda e: F.exists(e["terms"], lambda t: contains_term(hay, t)))
    idle = F.array(*map(F.lit, (*FILLERS, *SPLITS, *GENERIC, *languages)))
    first = F.try_element_at(shown, F.lit(1))
    beyond = F.array_except(F.array_except(words(name), idle), F.flatten(F.transform(first["terms"], words)))
    nothing = unique_rule(F.regexp_replace(name, "^(?:our|the) ", ""), languages).isNotNull() | (F.size(beyond) == 0)
    single = F.filter(all_, lambda e: e["kind"].isin("dataset", "shared_task_subtask"))
    cases = [
        (F.size(exact) == 1, F.try_element_at(exact, F.lit(1)), "exact", F.when(F.try_element_at(exact, F.lit(1))["name"] == name, "exact_name").otherwise("exact_alias")),
        (F.size(exact) > 1, None, "none", F.lit("none_exact_ambiguous")),
        (F.size(shown) > 1, None, "none", F.lit("none_caption_ambiguous")),
        ((F.size(shown) == 1) & nothing, first, "caption", F.lit("caption_single_entry")),
        (F.size(shown) == 1, None, "none", F.lit("none_caption_overrides_named_raw")),
        ((F.size(single) == 1) & rule.isNotNull(), F.try_element_at(single, F.lit(1)), "unique", rule),
    ]
    entry, binding, why = F.lit(None).cast("string"), F.lit("none"), F.lit("none_no_rule_matched")
    for when, of, kind, reason in reversed(cases):
        entry = F.when(when, of["entry_id"] if of is not None else F.lit(None).cast("string")).otherwise(entry)
        binding, why = F.when(when, kind).otherwise(binding), F.when(when, reason).otherwise(why)
    return own.withColumn("entry_id", entry).withColumn("binding", binding).withColumn("rule", why).drop("_all", "_raw")
