"""Ordered gates: a status and a reason for every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text

MIN_CONFIDENCE = 0.8
#: Strength of an origin basis, weakest first.
BASIS_STRENGTH = ("none", "unchecked", "no_external_cue", "reviewed_quote", "positive_structural", "human_confirmed")


def export_policy(df: DataFrame, least: float = MIN_CONFIDENCE, provenance: Column | None = None) -> DataFrame:
    """claim_type, text_support, value_blocker, match_mode, referential_status, confidence -> export_status, export_reason; first match wins.

    provenance: per row an array of (populated, gating, status) structs of its governed fields, null where none is recorded; without the
    argument the three provenance gates are off (records of the older schema). A null operand fails no gate but confidence's.
    """
    low = F.round(F.col("confidence") * 1000).cast("int")
    shown = F.concat(F.lit("extraction_confidence=0."), F.lpad(low.cast("string"), 3, "0"), F.lit(f" below {least:.3f}"))
    named = lambda name: F.concat(F.lit(f"{name}="), F.col(name))
    rules = [
        (F.col("claim_type") != "primary_result", "not_eligible", F.concat(F.lit("claim_type="), "claim_type", F.lit(" is not a primary result"))),
        (F.col("text_support") != "supported", "needs_review", named("text_support")),
        (F.col("value_blocker").isNotNull(), "needs_review", named("value_blocker")),
        (F.col("support_match_mode") == "consecutive_lines", "needs_review", F.lit("support_match_mode=consecutive_lines")),
        (F.col("referential_status") != "resolved", "needs_review", named("referential_status")),
    ]
    if provenance is not None:
        fails = lambda test: F.exists(provenance, lambda f: f["populated"] & test(f))
        rules += [
            (provenance.isNull(), "needs_review", F.lit("field_provenance=missing")),
            (fails(lambda f: f["status"] == "conflict"), "needs_review", F.lit("field_provenance=conflict")),
            (fails(lambda f: f["gating"] & (f["status"] != "bound")), "needs_review", F.lit("field_provenance=ambiguous_or_unsupported")),
        ]
    rules.append((F.col("confidence").isNull() | (F.col("confidence") < least), "needs_review", F.coalesce(shown, F.lit("extraction_confidence=missing"))))
    status, reason = F.lit("eligible"), F.lit("passed primary-result, evidence, reference, and confidence gates")
    for when, to, why in reversed(rules):
        when = F.coalesce(when, F.lit(False))
        status, reason = F.when(when, to).otherwise(status), F.when(when, why).otherwise(reason)
    return df.withColumn("export_status", status).withColumn("export_reason", reason)


def merged_binding(statuses: Column, hashes: Column) -> Column:
    """One field's binding over merged sources: conflict, ambiguous, bound, unsupported in that order; unequal values conflict; no source is unsupported."""
    has = lambda s: F.array_contains(statuses, s)
    unequal = F.size(F.array_distinct(hashes)) > 1
    return (
        F.when(F.size(statuses) == 0, "unsupported").when(unequal | has("conflict"), "conflict").when(has("ambiguous"), "ambiguous").when(has("bound"), "bound").otherwise("unsupported")
    )


def claims_binding(supported: Column) -> Column:
    """An array of booleans: all supported is bound, some ambiguous, none unsupported."""
    return F.when(F.size(supported) == 0, "unsupported").when(F.forall(supported, lambda x: x), "bound").when(F.exists(supported, lambda x: x), "ambiguous").otherwise("unsupported")


def text_support(candidates: DataFrame, pages: DataFrame) -> DataFrame:
    """candidates(observation_id, raw, anchors array<struct<source, page, quote>>), pages(source, page, lines) -> with text_support, support_match_mode.

    Supported: every quote occurs on its page, and the raw value, if there is one, in some quote that does. A missing page,
    and no anchor at all, support nothing. Anchors meet pages by key: no pairs of candidates and pages are formed.
    """
    one = candidates.select("observation_id", "raw", F.explode("anchors").alias("a")).select("observation_id", "raw", "a.*")
    seen = one.join(pages, ["source", "page"], "left")
    found = F.coalesce(text.quote_occurrences(F.col("quote"), F.col("lines")), F.lit(0)) > 0
    seen = seen.select("observation_id", found.alias("f"), (found & text.bounded_claim_present(F.col("quote"), F.col("raw"))).alias("v"), (found & F.contains("quote", F.lit("\n"))).alias("m"))
    judged = seen.groupBy("observation_id").agg(F.min("f").alias("every"), F.max("f").alias("some"), F.max("v").alias("valued"), F.max("m").alias("several"))
    level = F.when(F.col("every") & F.col("valued"), "supported").when(F.col("some"), "partially_supported").otherwise("unsupported")
    mode = F.when(F.col("several"), "consecutive_lines").when(F.col("some"), "single_line")
    return candidates.join(judged, "observation_id", "left").withColumn("text_support", level).withColumn("support_match_mode", mode).drop("every", "some", "valued", "several")


def references(primary: Column, systems: Column, has_scope: Column, metric_id: Column, direction: Column, metric_unit: Column, value_unit: Column, compatible: Column, issue: Column, has_value: Column) -> Column:
    """unverified for other claims; resolved if there is one evaluated system and everything it needs is known and fits; else unresolved."""
    whole = has_scope & has_value & metric_id.isNotNull() & direction.isNotNull() & (systems == 1) & (metric_unit == value_unit) & compatible & issue.isNull()
    return F.when(~primary, "unverified").when(F.coalesce(whole, F.lit(False)), "resolved").otherwise("unresolved")


#: Endings of names that are not what their field says.
REFERENCE_DATA = ("annotations", "annotators", "corpus", "dataset", "ground truth", "human labels", "human reference", "labels", "test set", "training set")
DATASETS = ("corpus", "dataset", "data set", "test set", "training set")
MODELS = ("api", "classifier", "classifiers", "model", "models", "system")


def safety_issues(system: Column, dataset: Column, metric: Column, language: Column, subset: Column, group: Column, roles_of_system: Column) -> Column:
    """Contradictions in one primary result's identities, in a fixed order; null names are empty and contradict nothing."""
    s, d, m, lang, sub, grp = (text.semantic_name(c) for c in (system, dataset, metric, language, subset, group))
    ends = lambda c, list_: F.regexp_like(c, F.lit("(?:^| )(?:" + "|".join(list_) + ")$"))
    sliced = (sub != "") & (grp != "") & ((d == F.concat_ws(" ", sub, grp)) | (d == F.concat_ws(" ", grp, sub)))
    issues = [
        ((s != "") & (s == d), "evaluated system and dataset have the same identity"),
        ((m != "") & (m == d), "metric and dataset have the same identity"),
        ((d != "") & (d == lang), "dataset identity is only the language slice"),
        ((d != "") & sliced, "dataset identity contains only subset and group labels"),
        (F.regexp_like(d, F.lit(r"^prompt(?: \d+)?$")), "dataset identity is only a prompt condition"),
        ((s != "") & (roles_of_system > 1), "the evaluated system has multiple roles in one observation"),
        (ends(s, REFERENCE_DATA), "evaluated-system identity appears to name reference data"),
        (ends(m, DATASETS), "metric identity appears to name a dataset"),
        (ends(d, MODELS), "dataset identity appears to name a system or model family"),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for test, name in issues]))


def route_safety(df: DataFrame, issues: Column) -> DataFrame:
    """Rows with issues become wrong_scope and needs_review, with the issues as reason; others stay."""
    bad = F.size(issues) > 0
    return (
        df.withColumn("referential_status", F.when(bad, "wrong_scope").otherwise(F.col("referential_status")))
        .withColumn("export_status", F.when(bad, "needs_review").otherwise(F.col("export_status")))
        .withColumn("export_reason", F.when(bad, F.concat(F.lit("semantic safety check: "), F.array_join(issues, "; "))).otherwise(F.col("export_reason")))
    )


def local_defence(decision: Column, result_quote: Column, origin_quote: Column, page: Column, raw: Column, system: Column) -> tuple[Column, Column]:
    """(decision, demotions): a reviewer's decision after its quotations are held against the page; it only ever falls."""
    own = F.when(decision.isin("accept", "accept_tuple_only", "reject"), decision).otherwise("abstain")
    named = lambda q: text.quote_on_page(q, page) & text.name_in(q, system)
    apart = F.coalesce((result_quote != "") & (text.evidence_text(origin_quote) != text.evidence_text(result_quote)), F.lit(False))
    origin, result = named(origin_quote) & apart, named(result_quote) & text.numeric_token_present(result_quote, raw)
    positive = own.isin("accept", "accept_tuple_only")
    fell, sank = (own == "accept") & ~origin, positive & ~result
    out = F.when(sank, "abstain").when(fell, "accept_tuple_only").otherwise(own)
    return out, F.array_compact(F.array(F.when(fell, "origin_quote_failed_local_defence"), F.when(sank, "result_quote_failed_local_defence")))


def replay_scope(df: DataFrame, scope: str) -> DataFrame:
    """The candidates of a scope: all, primary, or export_gate (supported primary results)."""
    if scope not in ("all", "primary", "export_gate"):
        raise ValueError(f"unknown replay scope: {scope}")
    df = df if scope == "all" else df.filter(F.col("claim_type") == "primary_result")
    return df.filter(F.col("text_support") == "supported") if scope == "export_gate" else df


def sparse_block(body: Column, data_rows: Column, candidates: Column) -> Column:
    """A dense block (3 data rows, 9 decimal cells) that gave at most one candidate."""
    return (candidates <= 1) & (data_rows >= 3) & (F.regexp_count(body, F.lit(r"\d+\.\d+")) >= 9)


def origin_basis(origin: Column, rule: Column, primary: Column, has_cues: Column) -> Column:
    """What an attribution verdict rests on."""
    return (
        F.when(origin == "paper_produced", F.when(F.startswith(rule, F.lit("reviewed")), "human_confirmed").otherwise("positive_structural"))
        .when((origin == "externally_sourced") | ~primary, "none")
        .when(origin == "no_signal", F.when(rule.isin("no_cue", "own_row"), "no_external_cue").otherwise("none"))
        .otherwise(F.when(has_cues, "none").otherwise("unchecked"))
    )


def policy_permits(basis: Column, policy: str) -> Column:
    """Whether an export policy lets a basis through; a null basis never."""
    if policy not in ("positive_only", "tiered"):
        raise ValueError(f"unknown origin policy: {policy}")
    return F.coalesce(basis.isin("human_confirmed", "positive_structural") if policy == "positive_only" else basis != "none", F.lit(False))


def basis_rank(basis: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, BASIS_STRENGTH)), basis).cast("int") - 1


def gate(value: Column, threshold: float, at_least: bool = True) -> Column:
    """passed, failed, or not_measured for null: a null is never a failure."""
    good = value >= threshold if at_least else value <= threshold
    return F.when(value.isNull(), "not_measured").when(good, "passed").otherwise("failed")
