"""Rules as queries: every order takes one of a list of inputs, the rule is applied, and the SQL holds the results worked out by hand."""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import metrics, text
from tessera.operators import attribution, binding, dedup, gates, ledger, review
from tessera.sources.tables import table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def _sql(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value).upper() if isinstance(value, bool) else str(value)


def dealt(spark, d: str, rows: list[tuple], schema: str) -> DataFrame:
    """orders with the inputs of rows[o_orderkey mod their number]; the list is short and broadcast."""
    listed = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i long, {schema}")
    keys = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % len(rows)).cast("long").alias("i"))
    return keys.join(F.broadcast(listed), "i")


def case(name: str, schema: str, rows: list[tuple], outputs: dict[str, Callable[[], Column]], expected: list[tuple]) -> None:
    """A query over orders; outputs give one value for each input row, expected what they must be."""

    def run(spark, d):
        return dealt(spark, d, rows, schema).select("o_orderkey", *[c().alias(n) for n, c in outputs.items()])

    run.__name__ = name
    values = ", ".join(f"({i}, {', '.join(map(_sql, e))})" for i, e in enumerate(expected))
    QUERIES[name] = run
    named = ", ".join(f'"{n}"' for n in outputs)
    ORACLE_SQL[name] = f"SELECT o_orderkey, {named} FROM orders JOIN (VALUES {values}) AS v(i, {named}) ON o_orderkey % {len(rows)} = v.i"


def _c(name: str) -> Column:
    return F.col(name)


#: Codes of languages, for the query; users bring their own.
CODES = {"english": "en", "german": "de", "multilingual": "mul"}


def _digest(x: str) -> str:
    return sha256(x.encode()).hexdigest()


def _register() -> None:
    case(
        "q_unit_canon", "u string",
        [(" % ",), ("Percentages",), ("percentage_points",), ("Percentage-Point",), ("fraction",), ("Ratio",), ("ms",), ("",), (None,), ("PROBABILITIES",)],
        {"unit": lambda: metrics.unit(_c("u"))},
        [("percent",), ("percent",), ("percentage_points",), ("percentage_points",), ("fraction",), ("Ratio",), ("ms",), ("",), (None,), ("probability",)],
    )
    case(
        "q_dataset_key", "x string",
        [("GLUE test set",), ("KLEJ benchmark (CBD)",), ("The Data Set",), ("dataset",), (None,), ("MNLI-m (dev) x",), ("Train corpus v2.0",)],
        {"dataset_key": lambda: text.dataset_key(_c("x"))},
        [("glue test set",), ("klej",), ("the",), (None,), (None,), ("mnli m dev x",), ("train v2 0",)],
    )
    case(
        "q_names_compatible", "a string, b string",
        [("GLUE", "glue dev"), ("BERT-base", "base BERT"), ("BERT base", "BERT large"), (None, "x"), ("", "x"), ("--", "x"), ("a b", "b c")],
        {"names": lambda: text.names_compatible(_c("a"), _c("b")), "labels": lambda: text.labels_compatible(_c("a"), _c("b")), "similar": lambda: text.similar(_c("a"), _c("b")), "agrees": lambda: text.agrees(_c("a"), _c("b"))},
        [(True, True, True, True), (True, True, False, False), (False, False, False, False), (True, False, False, True), (True, False, False, True), (True, False, False, True), (False, False, False, False)],
    )
    case(
        "q_number_present", "t string, v string",
        [("about 1,200 rows", "1200"), ("1.2e3 rows", "1200"), ("x12.5", "12.5"), ("is 12.50 now", "12.5"), ("12.5.1", "12.5"), ("123456789012345678901234 and 7", "7"), ("is 7", "seven"), (None, "7"), ("is −7", "-7"), ("7", None), (".5 of all", "0.5")],
        {"present": lambda: text.number_present(_c("t"), _c("v")), "n_numbers": lambda: F.size(text.numbers(_c("t"))).cast("long")},
        [(True, 1), (True, 1), (False, 0), (True, 1), (False, 0), (True, 2), (False, 1), (False, 0), (True, 1), (False, 1), (True, 1)],
    )
    case(
        "q_claim_present", "t string, c string",
        [("is 0.9 now", "0.9"), ("is 10.90 now", "0.9"), ("15% of", "5%"), ("5e3 of", "5"), ("1×10^3", "1"), ("is -5 here", "5"), ("Ours wins", "Our"), ("a 7.5.", "7.5"), ("x", ""), (None, "5"), ("a\\Eb 5", "\\Eb 5"), ("5 of 15", "15")],
        {"bounded": lambda: text.bounded_claim_present(_c("t"), _c("c")), "literal": lambda: text.literal_present(_c("t"), _c("c")), "phrase": lambda: text.phrase_present(_c("t"), _c("c")), "claim": lambda: text.claim_present(_c("t"), _c("c"))},
        [(True, True, True, True), (False, False, False, False), (False, False, False, False), (False, False, False, False), (False, True, True, True), (False, True, True, True),
         (True, False, False, False), (True, False, True, False), (True, False, False, False), (False, False, False, False), (True, False, True, False), (True, True, True, True)],
    )
    case(
        "q_quote_occurrences", "q string, p array<string>",
        [("a b", ["x a b a b", "a b"]), ("a b\nc", ["a  b", "c", "a b", "c"]), ("a\n", ["a", ""]), ("", ["a"]), (None, ["a"]), ("aa", ["aaa"]), ("a\nb", ["xa", "b"]), ("a\nb\nc", ["a", "b"])],
        {"n": lambda: text.quote_occurrences(_c("q"), _c("p")).cast("long")},
        [(3,), (2,), (0,), (0,), (0,), (1,), (0,), (0,)],
    )
    case(
        "q_quote_clauses", "q string",
        [("a; b | c\nd",), ("a|b",), (None,), (" ;; ",), ("x；y",)],
        {"clauses": lambda: F.array_join(text.quote_clauses(_c("q")), "/")},
        [("a/b/c/d",), ("a|b",), ("",), ("",), ("x/y",)],
    )
    case(
        "q_numeric_mentions", "x string",
        [("1.5k of 20% and 3M",), ("a1 b2",), ("1,234 rows",), (None,), ("v1.2.3",)],
        {"mentions": lambda: F.array_join(F.transform(text.numeric_mentions(_c("x")), lambda m: F.concat(m["number"].cast("decimal(20,2)").cast("string"), F.coalesce(m["unit"], F.lit("")))), ";")},
        [("1500.00;20.00percent;3000000.00",), ("",), ("1234.00",), ("",), ("",)],
    )
    case(
        "q_coverage_labels", "a string, b string",
        [("Table 2", "table 2"), ("Table 2 left", "table 2"), ("table 2", "table 2 left"), ("table 22", "table 2"), (None, "x"), ("", "")],
        {"matches": lambda: text.coverage_label_matches(_c("a"), _c("b"))},
        [(True,), (True,), (True,), (False,), (False,), (False,)],
    )
    case(
        "q_language_code", "x string",
        [("English",), ("Ger-man ",), ("Klingon",), (None,), ("MULTILINGUAL",)],
        {"code": lambda: text.language_code(_c("x"), CODES)},
        [("en",), ("de",), (None,), (None,), ("mul",)],
    )
    case(
        "q_stable_keys", "s string, v string, k string",
        [("BERT Base", None, "dataset"), ("BERT Base", "v1", "dataset"), ("***", None, "dataset")],
        {"key": lambda: text.system_key(_c("s"), _c("v")), "entry": lambda: text.entry_id(_c("s"), _c("k"))},
        [("bert-base-" + _digest("BERT Base")[:8], "ds_" + _digest('["BERT Base","dataset"]')[:20]),
         ("bert-base-" + _digest("BERT Base")[:8] + "-version-v1-" + _digest("v1")[:8], "ds_" + _digest('["BERT Base","dataset"]')[:20]),
         (_digest("***")[:8], "ds_" + _digest('["***","dataset"]')[:20])],
    )
    case(
        "q_percent_notation", "r string, q array<string>",
        [("5.1", ["is 5.1%", "5.1 %"]), ("5.1", ["is 5.1% or 5.1"]), ("<5.1*", ["is 5.1"]), ("5.1", ["15.1%"]), ("%", ["5%"]), ("5.1", None)],
        {"notation": lambda: metrics.percent_notation(_c("r"), _c("q"))},
        [("percent",), ("mixed",), ("unmarked",), ("absent",), ("absent",), ("absent",)],
    )
    case(
        "q_inferred_unit", "r string, v double, bounded boolean, plain boolean, own string, notation string",
        [("5%", 5.0, True, False, None, "absent"), ("5", 5.0, True, True, None, "unmarked"), ("5", 5.0, True, True, None, "absent"), ("5", 5.0, True, False, None, "unmarked"), ("0.5", 0.5, True, False, None, "absent"),
         ("5", 5.0, True, True, None, "mixed"), ("5", 5.0, False, True, None, "percent"), ("5", 5.0, True, True, "ms", "percent"), ("5", 5.0, True, False, None, "percent"), ("500", 500.0, True, True, None, "unmarked")],
        {"unit": lambda: metrics.inferred_unit(_c("r"), _c("v"), _c("bounded"), _c("plain"), _c("own"), _c("notation")), "compatible": lambda: metrics.unit_compatible(_c("own"), _c("bounded"))},
        [("percent", True), ("percent", True), (None, True), (None, True), ("proportion", True), (None, True), (None, True), ("ms", False), ("percent", True), (None, True)],
    )
    inf = float("inf")
    case(
        "q_value_blocker", "r string, v double, lo double, hi double, cl double, cu double, w array<string>",
        [("+1.2", 1.2, 0.0, 100.0, None, None, None), ("-1.2", -1.2, None, None, None, None, ["improvement over x"]), ("-1.2", -1.2, None, None, None, None, ["score"]), ("120", 120.0, 0.0, 100.0, None, None, None),
         ("5", 5.0, 0.0, 100.0, 4.0, 6.0, None), ("5", 5.0, 0.0, 100.0, 4.0, None, None), ("5", 5.0, 0.0, 100.0, 6.0, 7.0, None), ("5", 5.0, 0.0, 100.0, 4.0, 101.0, None), ("x", inf, None, None, None, None, None), ("5", 5.0, 0.0, 100.0, 6.0, 4.0, [None])],
        {"blocker": lambda: metrics.value_blocker(_c("r"), _c("v"), _c("lo"), _c("hi"), _c("cl"), _c("cu"), _c("w"))},
        [("signed_difference_value",), ("signed_difference_value",), (None,), ("value_outside_registry_metric_bounds",), (None,)] + [("uncertainty_interval_outside_registry_metric_bounds",)] * 3
        + [("value_outside_registry_metric_bounds",), ("uncertainty_interval_outside_registry_metric_bounds",)],
    )
    case(
        "q_safety_issues", "s string, d string, m string, l string, sub string, g string, n int",
        [("BERT", "bert", "acc", None, None, None, 1), ("A", "prompt 3", "F1", None, None, None, 1), ("gold labels", "GLUE", "dev corpus", "en", None, None, 1), ("A", "male en", "F1", None, "en", "male", 2), ("A", "BERT model", "x", None, None, None, 1), (None, None, None, None, None, None, 0)],
        {"issues": lambda: F.array_join(gates.safety_issues(*map(_c, ("s", "d", "m", "l", "sub", "g", "n"))), "; ")},
        [("evaluated system and dataset have the same identity",), ("dataset identity is only a prompt condition",), ("evaluated-system identity appears to name reference data; metric identity appears to name a dataset",),
         ("dataset identity contains only subset and group labels; the evaluated system has multiple roles in one observation",), ("dataset identity appears to name a system or model family",), ("",)],
    )
    page = "BERT scores 91.2 on GLUE. We trained BERT ourselves."
    defence = lambda: gates.local_defence(*map(_c, ("decision", "rq", "oq", "page", "raw", "sys")))
    case(
        "q_local_defence", "decision string, rq string, oq string, page string, raw string, sys string",
        [("accept", "BERT scores 91.2", "We trained BERT", page, "91.2", "BERT"), ("accept", "BERT scores 91.2", None, page, "91.2", "BERT"), ("accept", "BERT scores 91.2", "BERT scores 91.2", page, "91.2", "BERT"),
         ("accept_tuple_only", "BERT scores 9", None, page, "91.2", "BERT"), ("reject", None, None, page, "1", "x"), ("nonsense", None, None, page, "1", "x"), ("accept", None, "We trained BERT", page, "1.2", "BERT")],
        {"decision": lambda: defence()[0], "demotions": lambda: F.array_join(defence()[1], "|")},
        [("accept", ""), ("accept_tuple_only", "origin_quote_failed_local_defence"), ("accept_tuple_only", "origin_quote_failed_local_defence"), ("abstain", "result_quote_failed_local_defence"), ("reject", ""), ("abstain", ""),
         ("abstain", "origin_quote_failed_local_defence|result_quote_failed_local_defence")],
    )
    verdict = lambda: attribution.verdict(*map(_c, ("ix", "loc", "tab", "row", "anchor", "sib", "cap", "head", "ctx")))
    case(
        "q_attribution", "ix boolean, loc boolean, tab boolean, row string, anchor string, sib array<string>, cap string, head array<string>, ctx array<string>",
        [(False, None, None, None, None, None, None, None, None), (True, False, None, None, None, None, None, None, None), (True, True, False, "a", "a", None, None, None, None),
         (True, True, True, "Smith et al.", "smith et al", ["Smith et al.", "Ours"], None, None, None), (True, True, True, "Smith et al.", None, ["Smith et al.", "Lee et al."], None, None, None),
         (True, True, True, None, None, ["winner", "x"], None, None, None), (True, True, True, "x", "y", ["x"], None, None, None), (True, True, True, "Ours", None, ["Ours", "x"], "Published results", ["Rank", "F1"], None),
         (True, True, True, "BERT [3]", None, ["BERT [3]"], None, None, None), (True, True, True, "BERT", None, ["BERT"], None, [" # "], None), (True, True, True, "BERT", None, ["BERT"], "Table 1: scores", ["F1"], None),
         (True, True, True, "Team X", None, ["Team X"], None, None, ["foreign_team_row"])],
        {"state": lambda: verdict()[0], "rule": lambda: verdict()[1], "cues": lambda: F.array_join(verdict()[2], "|")},
        [("unresolved", "no_page_index", ""), ("unresolved", "unlocatable", ""), ("unresolved", "not_a_table_row", ""), ("externally_sourced", "row_scoped_foreign_cue", "attributed_author"),
         ("unresolved", "decisive_cue_without_contrast", "attributed_author"), ("unresolved", "table_marker_row_unresolved", ""), ("unresolved", "row_unresolved", ""), ("no_signal", "own_row", "self_reference|caption_reported|rank_column"),
         ("unresolved", "weak_cue_recorded", "citation_bracket"), ("unresolved", "weak_cue_recorded", "rank_column"), ("no_signal", "no_cue", ""), ("unresolved", "weak_cue_recorded", "foreign_team_row")],
    )
    paper = lambda: attribution.paper_kind(_c("t"))
    case(
        "q_paper_kind", "t string, label string",
        [("KIT-NLP at SemEval-2020 Task 12: x", "KIT-NLP run 1"), ("Looking at BERT", "BERT"), ("Overview of the Task", "x"), ("Findings of the 2020 shared task", "x"), ("byteSizedLLM@DravidianLangTech: y", "bytesizedllm"), (None, None),
         ("Team Alpha at work at CASE 2021 Task 1", "alpha"), ("A B C D E F at GermEval 2024", "x"), ("Team-X at X", "team x")],
        {"kind": lambda: paper()[0], "team": lambda: paper()[1], "names_team": lambda: attribution.row_names_team(_c("label"), paper()[1])},
        [("shared_task_system_paper", "KIT-NLP", True), ("other", None, False), ("overview_paper", None, False), ("overview_paper", None, False), ("shared_task_system_paper", "byteSizedLLM", True), ("other", None, False),
         ("shared_task_system_paper", "Team Alpha at work", False), ("other", None, False), ("other", None, False)],
    )
    case(
        "q_split_of", "s string, h string, c string",
        [(None, "Test F1", None), ("dev", "Test F1", None), (" ", "F1", "Results on the dev set"), (None, "Training acc", "on the test set"), (None, "latest", "on the test bench"), (None, None, None)],
        {"split": lambda: binding.split_of(_c("s"), _c("h"), _c("c"))},
        [("test",), (None,), ("dev",), ("training",), (None,), (None,)],
    )
    status = lambda: ledger.paper_status(*map(_c, ("run", "has", "ex", "st", "fr", "fo")))
    case(
        "q_paper_status_basis", "run string, has boolean, ex boolean, st string, fr boolean, fo boolean",
        [("failed", True, True, "done", True, True), (None, True, None, None, None, None), (None, False, True, "failed", None, None), (None, None, None, "source_unavailable", None, None), (None, False, False, "done", True, True), (None, False, False, "x", True, True), (None, False, False, None, False, True), (None, None, None, None, None, None)],
        {"status": lambda: status()[0], "basis": lambda: status()[1]},
        [("failed", "run"), ("success", "run"), ("excluded", "exclusions"), ("unavailable", "ledger"), ("missing_run_artifact", "ledger"), ("not_started", "frozen source"), ("unavailable", "folder"), ("reserve", "absent")],
    )
    case(
        "q_field_binding", "s array<string>, h array<string>, c array<boolean>",
        [(["bound", "bound"], ["x", "x"], [True, True]), (["bound", "bound"], ["x", "y"], [True, False]), (["ambiguous", "bound"], ["x", "x"], [False]), ([], [], []), (["unsupported", "conflict"], ["x", "x"], [True]), (["unsupported"], ["x"], [False, False])],
        {"merged": lambda: gates.merged_binding(_c("s"), _c("h")), "claims": lambda: gates.claims_binding(_c("c"))},
        [("bound", "bound"), ("conflict", "ambiguous"), ("ambiguous", "unsupported"), ("unsupported", "unsupported"), ("conflict", "bound"), ("unsupported", "unsupported")],
    )
    case(
        "q_references", "p boolean, n int, sc boolean, id string, dir string, mu string, vu string, ok boolean, iss string, val boolean",
        [(True, 1, True, "acc", "up", "percent", "percent", True, None, True), (False, 1, True, "acc", "up", "percent", "percent", True, None, True), (True, 2, True, "acc", "up", "percent", "percent", True, None, True), (True, 1, True, "acc", None, "percent", "percent", True, None, True),
         (True, 1, True, "acc", "up", None, None, True, None, True), (True, 1, True, "acc", "up", "percent", "ms", True, None, True), (True, 1, True, "acc", "up", "percent", "percent", True, "outside", True)],
        {"status": lambda: gates.references(_c("p"), _c("n"), _c("sc"), _c("id"), _c("dir"), _c("mu"), _c("vu"), _c("ok"), _c("iss"), _c("val"))},
        [("resolved",), ("unverified",), ("unresolved",), ("unresolved",), ("unresolved",), ("unresolved",), ("unresolved",)],
    )
    key = lambda: dedup.dedup_key(*map(_c, ("cell", "amb", "val", "tab", "pay", "sem")))
    case(
        "q_dedup_key", "cell string, amb boolean, val boolean, tab boolean, pay string, sem string",
        [("c1", True, True, True, "p", "s"), (None, True, False, False, "p", "s"), (None, False, True, True, "p", "s"), (None, False, True, False, "p", "s"), (None, False, False, True, "p", "s")],
        {"kind": lambda: key()["kind"], "key": lambda: key()["key"]},
        [("physical", "c1"), ("unbound_table", "p"), ("unbound_table", "p"), ("semantic", "s"), ("semantic", "s")],
    )
    case(
        "q_sparse_block", "b string, r int, c int",
        [("1.1 " * 9, 3, 1), ("1.1 " * 8, 3, 1), ("1.1 " * 9, 2, 1), ("1.1 " * 9, 3, 2)],
        {"retry": lambda: gates.sparse_block(_c("b"), _c("r"), _c("c"))},
        [(True,), (False,), (False,), (False,)],
    )
    earned = lambda: review.reviewed_basis(*map(_c, ("d", "p", "oq", "st", "ru", "cu", "ba")))
    case(
        "q_reviewed_basis", "d string, p string, oq string, st string, ru string, cu array<string>, ba string",
        [("accept", "accept", "q", "no_signal", "no_cue", [], "no_external_cue"), ("accept", "accept", "q", "unresolved", "weak_cue_recorded", ["citation_bracket"], "none"), ("accept", "accept", "q", "no_signal", "own_row", ["self_reference", "rank_column"], "no_external_cue"),
         ("accept", "accept", "q", "externally_sourced", "row_scoped_foreign_cue", [], "none"), ("accept", "accept", "q", "no_signal", "other", [], "none"), ("accept_tuple_only", "accept_tuple_only", None, "no_signal", "no_cue", [], "no_external_cue"),
         ("accept_tuple_only", "accept", None, "no_signal", "no_cue", [], "no_external_cue"), ("accept_tuple_only", "accept_tuple_only", "q", "unresolved", "weak_cue_recorded", ["a", "a", "b"], "none")],
        {"basis": lambda: earned()[0], "reason": lambda: earned()[1]},
        [("reviewed_quote", None), ("none", "cue_overrides_review:unresolved:citation_bracket"), ("reviewed_quote", None), ("none", "cue_overrides_review:externally_sourced:row_scoped_foreign_cue"), ("none", "no_origin_basis:no_signal:other"),
         ("none", "reviewer_withheld_origin"), ("no_external_cue", None), ("none", "no_origin_basis:unresolved:weak_cue_recorded:a;b")],
    )
    case(
        "q_promotion", "d string, gh string, ph string, el boolean, id string, wh boolean, bl string, ba string, re string, fl boolean",
        [("accept", "h", "h", False, "acc", True, None, "reviewed_quote", None, False), ("reject", "h", "h", False, "acc", True, None, "none", None, False), ("accept", "h", "g", False, "acc", True, None, "reviewed_quote", None, False), ("accept", "h", "h", True, "acc", True, None, "reviewed_quote", None, False),
         ("accept", "h", "h", None, "", True, None, "reviewed_quote", None, False), ("accept", "h", "h", False, "acc", None, None, "reviewed_quote", None, False), ("accept", "h", "h", False, "acc", True, "signed_difference_value", "reviewed_quote", None, False),
         ("accept", "h", "h", False, "acc", True, None, "reviewed_quote", None, True), ("accept", "h", "h", False, "acc", True, None, "none", "no_origin_basis:x", True), (None, None, None, None, None, None, None, None, None, None)],
        {"outcome": lambda: review.promotion(*map(_c, ("d", "gh", "ph", "el", "id", "wh", "bl", "ba", "re", "fl")))},
        [("promoted",), ("not_accepted",), ("stale",), ("already_eligible",), ("no_metric_id",), ("no_value_or_scope",), ("signed_difference_value",), ("reviewer_rationale_flagged",), ("no_origin_basis:x",), ("not_accepted",)],
    )
    route = lambda: review.origin_route(*map(_c, ("ex", "rv", "ov", "es", "inv", "pr", "pi")))
    case(
        "q_origin_route", "ex boolean, rv boolean, ov boolean, es boolean, inv boolean, pr string, pi string",
        [(True, False, False, False, True, "paper_produced", None), (False, True, True, True, True, "paper_produced", None), (False, True, False, True, True, "no_signal", None), (False, True, True, False, False, "no_signal", "no_signal"),
         (False, True, True, False, False, "no_signal", "unresolved"), (False, True, True, False, False, "paper_produced", "no_signal"), (None, None, None, None, None, None, None)],
        {"state": lambda: route()[0], "route": lambda: route()[1]},
        [("externally_sourced", "demote"), ("externally_sourced", "demote"), ("unresolved", "review"), ("no_signal", "review"), ("unresolved", "review"), ("unresolved", "review"), ("unresolved", "review")],
    )
    case(
        "q_row_outcome", "n int, d string, ob boolean, bo boolean, va boolean",
        [(0, None, None, None, None), (2, "result", True, True, True), (1, "result", False, None, None), (1, "not_a_result", True, True, True), (1, "not_a_result", False, None, None), (1, "result", True, False, True), (1, "result", True, True, False), (1, "result", True, True, True)],
        {"outcome": lambda: review.row_outcome(*map(_c, ("n", "d", "ob", "bo", "va")))},
        [("missing_disposition",), ("duplicate_disposition",), ("result_without_observation",), ("abstention_with_observation",), ("accepted",), ("observation_not_bound_to_row",), ("domain_candidate_validation",), ("accepted",)],
    )
    outcome = lambda: review.export_outcome(*map(_c, ("de", "tu", "ori", "co", "el", "op", "sa", "ex", "ad", "du")))
    case(
        "q_export_outcome", "de boolean, tu string, ori string, co boolean, el boolean, op boolean, sa boolean, ex boolean, ad boolean, du boolean",
        [(False, None, None, None, None, None, None, None, None, None), (True, "rejected", "paper", False, True, False, True, False, False, False), (True, None, "paper", False, True, False, True, False, False, False), (True, "accepted", "external", False, True, False, True, False, False, False),
         (True, "accepted", None, False, True, False, True, False, False, False), (True, "accepted", "paper", True, True, False, True, False, False, False), (True, "accepted", "paper", False, False, False, True, False, False, False), (True, "accepted", "paper", False, False, True, True, False, False, False),
         (True, "accepted", "paper", False, True, False, False, False, False, False), (True, "accepted", "paper", False, True, False, True, True, False, False), (True, "accepted", "paper", False, True, False, True, True, True, True)],
        {"outcome": lambda: outcome()[0], "code": lambda: outcome()[1]},
        [("withheld", "DECISION_PENDING"), ("withheld", "TUPLE_REJECTED"), ("withheld", "TUPLE_UNRESOLVED"), ("withheld", "ORIGIN_EXTERNAL"), ("withheld", "ORIGIN_UNRESOLVED"), ("failed", "VALUE_EVIDENCE_CONTRADICTION"), ("failed", "NOT_ELIGIBLE"), ("approved", None),
         ("failed", "TUPLE_RECOMPUTE_MISMATCH"), ("failed", "DETERMINISTIC_EXTERNAL_CONFLICT"), ("failed", "DUPLICATE")],
    )


_register()
