"""What a reviewer's decision is worth, and what becomes of a candidate under review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _yes(x: Column) -> Column:
    return F.coalesce(x, F.lit(False))


def _first(rules: list[tuple[Column, Column]], rest: Column) -> Column:
    """The value of the first rule that holds."""
    for when, value in reversed(rules):
        rest = F.when(_yes(when), value).otherwise(rest)
    return rest


def review_items(candidates: DataFrame, pages: DataFrame) -> DataFrame:
    """Supported primary results with a printed value that are neither eligible nor external, with the text of their first quote's page.

    candidates(paper_id, page, raw, claim_type, text_support, export_status, state, ...), pages(paper_id, page, page_text). A candidate
    whose page is null or unknown is no item; a null state is not external, a null export status not eligible.
    """
    own = candidates.filter((F.col("text_support") == "supported") & (F.col("claim_type") == "primary_result") & (F.coalesce("raw", F.lit("")) != ""))
    own = own.filter(~_yes(F.col("state") == "externally_sourced") & ~_yes(F.col("export_status") == "eligible"))
    return own.join(pages.dropDuplicates(["paper_id", "page"]), ["paper_id", "page"])


def reviewed_basis(decision: Column, proposed: Column, origin_quote: Column, state: Column, rule: Column, cue_ids: Column, basis: Column) -> tuple[Column, Column]:
    """(basis, reason) that a positive decision earns; reason is null where some basis is earned.

    An accept earns reviewed_quote unless a cue other than the row's own label, or an external state, speaks against it. A decision
    for the tuple alone that the reviewer made without an origin quote earns nothing; else the verdict's own basis stands.
    """
    cues = F.array_join(F.array_distinct(cue_ids), ";")
    against = (F.size(cue_ids) > 0) & (rule != "own_row") | (state == "externally_sourced")
    withheld = (proposed == "accept_tuple_only") & origin_quote.isNull()
    none = F.concat_ws(":", F.lit("no_origin_basis"), state, rule, F.nullif(cues, F.lit("")))
    reason = _first(
        [
            ((decision == "accept") & against, F.concat_ws(":", F.lit("cue_overrides_review"), state, F.when(cues == "", rule).otherwise(cues))),
            ((decision != "accept") & withheld, F.lit("reviewer_withheld_origin")),
            (basis == "none", none),
        ],
        F.lit(None).cast("string"),
    )
    return F.when(reason.isNotNull(), "none").when(decision == "accept", "reviewed_quote").otherwise(basis), reason


def promotion(decision: Column, gate_hash: Column, payload_hash: Column, eligible: Column, metric_id: Column, whole: Column, blocker: Column, basis: Column, reason: Column, flagged: Column) -> Column:
    """promoted, or why not, first match: not accepted, stale gate, already eligible, no metric id, no value or scope, a blocker, a flagged rationale, the basis' reason."""
    return _first(
        [
            (~_yes(decision.isin("accept", "accept_tuple_only")), F.lit("not_accepted")),
            (~F.equal_null(gate_hash, payload_hash), F.lit("stale")),
            (eligible, F.lit("already_eligible")),
            (F.coalesce(metric_id, F.lit("")) == "", F.lit("no_metric_id")),
            (~_yes(whole), F.lit("no_value_or_scope")),
            (blocker.isNotNull(), blocker),
            ((basis != "none") & _yes(flagged), F.lit("reviewer_rationale_flagged")),
            (basis == "none", reason),
        ],
        F.lit("promoted"),
    )


def origin_route(external: Column, result_verified: Column, origin_verified: Column, external_sentence: Column, invalid: Column, proposed: Column, prior: Column) -> tuple[Column, Column]:
    """(state, route) of a proposal about who produced a result; it is demoted or reviewed, never accepted."""
    state = _first(
        [
            (external, F.lit("externally_sourced")),
            (result_verified & origin_verified & external_sentence, F.lit("externally_sourced")),
            (invalid, F.lit("unresolved")),
            ((proposed == "no_signal") & ~_yes(prior == "unresolved"), F.lit("no_signal")),
        ],
        F.lit("unresolved"),
    )
    return state, F.when(state == "externally_sourced", "demote").otherwise("review")


def row_outcome(dispositions: Column, disposition: Column, observed: Column, bound: Column, valid: Column) -> Column:
    """What a planned row's answer is, first match: missing, duplicate, a result without or an abstention with an observation, unbound, invalid, else accepted."""
    result = disposition == "result"
    return _first(
        [
            (F.coalesce(dispositions, F.lit(0)) == 0, F.lit("missing_disposition")),
            (dispositions > 1, F.lit("duplicate_disposition")),
            (result & ~_yes(observed), F.lit("result_without_observation")),
            (~result & _yes(observed), F.lit("abstention_with_observation")),
            (~result, F.lit("accepted")),
            (~_yes(bound), F.lit("observation_not_bound_to_row")),
            (~_yes(valid), F.lit("domain_candidate_validation")),
        ],
        F.lit("accepted"),
    )


def export_outcome(decided: Column, tuple_decision: Column, origin: Column, contradiction: Column, eligible: Column, only_provenance: Column, same_tuple: Column, external: Column, adjudicated: Column, duplicate: Column) -> tuple[Column, Column]:
    """(outcome, code) of a reviewed candidate, first match: withheld while something is open, failed where it contradicts itself, else approved."""
    rules = [
        (~_yes(decided), "withheld", "DECISION_PENDING"),
        (tuple_decision == "rejected", "withheld", "TUPLE_REJECTED"),
        (~_yes(tuple_decision == "accepted"), "withheld", "TUPLE_UNRESOLVED"),
        (origin == "external", "withheld", "ORIGIN_EXTERNAL"),
        (~_yes(origin == "paper"), "withheld", "ORIGIN_UNRESOLVED"),
        (contradiction, "failed", "VALUE_EVIDENCE_CONTRADICTION"),
        (~_yes(eligible) & ~_yes(only_provenance), "failed", "NOT_ELIGIBLE"),
        (~_yes(same_tuple), "failed", "TUPLE_RECOMPUTE_MISMATCH"),
        (_yes(external) & ~_yes(adjudicated), "failed", "DETERMINISTIC_EXTERNAL_CONFLICT"),
        (duplicate, "failed", "DUPLICATE"),
    ]
    return _first([(w, F.lit(o)) for w, o, _ in rules], F.lit("approved")), _first([(w, F.lit(c)) for w, _, c in rules], F.lit(None).cast("string"))
