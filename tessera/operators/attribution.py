"""Whose result a table row is: cues in labels, captions and headers, and the verdict they lead to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import text

#: Cue, where it is looked for, its pattern. Only decisive cues make a row external; the others make it abstain.
CUES = (
    ("self_reference", "self", r"^\s*(?:\(?ours?\)?|our (?:system|model|approach|submission|run|method|team)|this (?:work|paper)|proposed(?: (?:system|model|approach|method))?)\s*(?:\(.*\))?\s*$"),
    ("leaderboard", "decisive", r"\bleader(?:board)?s?\b"),
    ("rank_marker", "decisive", r"(?:#\s*\d{1,3}\b|\btop-?\d{1,3}\b|\b1st\b|\bwinner\b)"),
    ("attributed_author", "decisive", r"\bet\s+al\."),
    ("attributed_source", "decisive", r"\b(?:as reported(?: in| by)?|taken from|reproduced from|reported by|copied from)\b"),
    ("citation_bracket", "weak", r"\[\d{1,3}(?:\s*,\s*\d{1,3})*\]"),
    ("prior_work", "weak", r"\b(?:prior|previous|earlier|original)\s+(?:work|paper|study|authors?|result)\b"),
    ("caption_reported", "caption", r"\b(?:reported|published|leaderboard)\b"),
    ("caption_attributed", "caption", r"\b(?:as reported(?: in| by)?|taken from|reproduced from|from the .{0,24}paper)\b"),
    ("rank_column", "header", r"^(?:rank|#|pos\.?|position|place)$"),
)


def cues(x: Column, where: str, lexicon: tuple = CUES) -> Column:
    """The ids of the cues of that kind in a text; none in null."""
    own = [F.when(F.regexp_like(F.coalesce(x, F.lit("")), F.lit("(?i)" + p)), F.lit(name)) for name, kind, p in lexicon if kind == where]
    return F.array_compact(F.array(*own))


def verdict(indexed: Column, located: Column, is_table: Column, row_label: Column, anchor_row: Column, siblings: Column, caption: Column, header: Column, context: Column, lexicon: tuple = CUES) -> tuple[Column, Column, Column]:
    """(state, rule, cues) of a candidate by its first anchor.

    siblings: labels of the table's data rows; header: its header cells; context: ids of cues that the paper's kind gives. A row can
    be judged if it has a label that the anchor's row agrees with. paper_produced is never a verdict.
    """
    yes = lambda c: F.coalesce(c, F.lit(False))
    none = F.array().cast("array<string>")
    decisive, weak, own = (cues(row_label, k, lexicon) for k in ("decisive", "weak", "self"))
    marked = F.filter(F.coalesce(siblings, none), lambda s: F.size(cues(s, "decisive", lexicon)) > 0)
    of_header = F.flatten(F.transform(F.coalesce(header, none), lambda h: cues(F.trim(h), "header", lexicon)))
    around = F.concat(cues(caption, "caption", lexicon), of_header, F.coalesce(context, none))
    trusted = row_label.isNotNull() & text.agrees(row_label, anchor_row)
    every = (F.size(marked) == F.size(siblings)) & (F.size(siblings) > 1)
    rules = [
        (~yes(indexed), "unresolved", "no_page_index", none),
        (~yes(located), "unresolved", "unlocatable", none),
        (~yes(is_table), "unresolved", "not_a_table_row", none),
        (trusted & (F.size(decisive) > 0) & yes(every), "unresolved", "decisive_cue_without_contrast", F.concat(decisive, around)),
        (trusted & (F.size(decisive) > 0), "externally_sourced", "row_scoped_foreign_cue", F.concat(decisive, around)),
        (~trusted & (F.size(marked) > 0), "unresolved", "table_marker_row_unresolved", around),
        (~trusted, "unresolved", "row_unresolved", around),
        ((F.size(own) > 0) & (F.size(weak) == 0), "no_signal", "own_row", F.concat(own, around)),
        ((F.size(weak) > 0) | (F.size(around) > 0), "unresolved", "weak_cue_recorded", F.concat(weak, around)),
    ]
    state, rule, found = F.lit("no_signal"), F.lit("no_cue"), none
    for when, s, r, c in reversed(rules):
        state, rule, found = F.when(when, s).otherwise(state), F.when(when, r).otherwise(rule), F.when(when, c).otherwise(found)
    return state, rule, found


def paper_kind(title: Column) -> tuple[Column, Column]:
    """(kind, team): overview_paper, shared_task_system_paper with the team that the title names, or other.

    The team stands before the last " at " or "@" of what comes before a colon, if at most five words, and what follows is like a venue;
    an undated venue counts only after a team that reads as a handle.
    """
    t = F.trim(F.coalesce(title, F.lit("")))
    overview = F.regexp_like(t, F.lit(r"(?i)^(?:(?:the|an?)\s+)?overview\s+of\b|^findings\s+of\s+the\b.*\b(?:shared[- ]task|task\s*\d)"))
    kind, team = F.lit("other"), F.lit(None).cast("string")
    segment, rules = F.trim(F.substring_index(t, ":", 1)), []
    head, tail = segment, F.lit("")
    for _ in range(3):  # the last separator, then those before it
        split = r"^(.*)(?:\s+at\s+|\s*@\s*)(.*)$"
        venue = F.concat(F.regexp_extract(head, split, 2), tail)
        team_here, mark = F.trim(F.regexp_extract(head, split, 1)), F.regexp_extract(head, r"^.*(\s+at\s+|\s*@\s*).*$", 1)
        good = (team_here != "") & (F.trim(venue) != "") & (F.size(text.words(team_here)) <= 5) & (text.semantic_name(team_here) != "")
        good &= text.venue_like(F.trim(venue)) & (text.dated_venue(venue) | text.handle_like(team_here))
        rules.append((good, team_here))
        head, tail = team_here, F.concat(mark, venue)
    for good, name in reversed(rules):
        kind, team = F.when(good, "shared_task_system_paper").otherwise(kind), F.when(good, name).otherwise(team)
    return F.when(overview, "overview_paper").otherwise(kind), F.when(~overview, team)


def row_names_team(row_label: Column, team: Column) -> Column:
    """Whether a row's label holds the team's name as whole words; "team" before the name does not count."""
    name, label = F.regexp_replace(text.semantic_name(team), "^team ", ""), text.semantic_name(row_label)
    return (name != "") & (label != "") & text.contains_term(label, name)
