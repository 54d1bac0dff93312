"""Lines of page text as features: what a result table, a caption or a heading looks like."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What counts as a number, a result word, a caption's label, a numbered heading, a statistic, a reference.
NUMBER = r"(?<![\w@])[+-]?(?:\d+(?:[.,]\d+)?|[.,]\d+)\s*%?(?!\w)"
RESULT = (
    r"(?i)\b(?:results?|accuracy|auc|auroc|f1|precision|recall|error|rate|score|performance|evaluation|evaluated|mean|median|"
    r"significant|correlation|agreement|specificity|sensitivity|loss|perplexity)\b"
)
LABEL = r"(?:table|figure|fig\.?|chart|plot)\s+(?:[A-Z]?\d+(?:[.\-]\d+)*|[IVXLCDM]+)\s*(?::|[.]|[-–—])"
HEADING = r"^\s*(?:(?:\d+(?:\.\d+)*)|(?:[A-Z]))(?:[.)])?\s+[A-Za-z]"
STATISTIC = r"(?i)(?:\b(?:p|r|rho|f|t|z)\s*[=<>]|\b(?:ci|confidence interval)\b|[±])"
REFERENCE = r"(?i)(?:https?://|\bdoi\b|\bpp?\.\s*\d+[-–]\d+)"


def _has(x: Column, pattern: str) -> Column:
    return F.regexp_like(x, F.lit(pattern))


def _title(x: Column) -> Column:
    """Whether every run of letters has its capital first and no other."""
    return ~_has(x, r"(?U)(?:^|[^\p{L}])\p{Ll}|\p{L}\p{Lu}")


def is_heading(x: Column, numbers: Column, aligned: Column) -> Column:
    """A short line without columns or several numbers: numbered, or without a number in capitals or title case."""
    count = F.size(F.regexp_extract_all(x, F.lit(r"\S+"), F.lit(0)))
    capitals = _has(x, r"(?U)\p{L}") & (F.upper(x) == x)
    shaped = _has(x, HEADING) | (numbers == 0) & (capitals | (count >= 2) & _title(x) & _has(x, r"(?U)\p{L}"))
    return (x != "") & (F.length(x) <= 120) & (count <= 16) & ~aligned & (numbers <= 1) & shaped


def line_features(df: DataFrame, line: str, least: float = 1.5) -> DataFrame:
    """df with numeric_count, numeric_ratio, caption, heading, aligned, score and kinds of each line; a null line is blank.

    All columns stay in the JVM; kinds is empty and score 0 below the least score.
    """
    text = F.trim(F.coalesce(F.col(line), F.lit("")))
    df = df.withColumn("_t", text)
    t = F.col("_t")
    df = df.withColumn("numeric_count", F.regexp_count(t, F.lit(NUMBER)))
    n, count = F.col("numeric_count"), F.size(F.regexp_extract_all(t, F.lit(r"\S+"), F.lit(0)))
    df = df.withColumn("numeric_ratio", n / F.greatest(count, F.lit(1)))
    df = df.withColumn("aligned", F.size(F.filter(F.split(t, r"\s{2,}"), lambda p: p != "")) >= 2)
    df = df.withColumn("caption", _has(t, rf"(?i)(?:^|\s{{2,}}){LABEL}")).withColumn("heading", is_heading(t, n, F.col("aligned")))
    r, term, caption, heading = F.col("numeric_ratio"), _has(t, RESULT), F.col("caption"), F.col("heading")
    body = ~_has(t, rf"(?i)^\s*{LABEL}") & ~heading
    parts = [
        ("caption", caption, F.lit(3.0)),
        ("result_heading", heading & term, F.lit(2.5)),
        ("numeric_dense", body & (n >= 2) & (r >= 0.25), F.least(F.lit(3.0), 1.5 + r * 2.0)),
        ("aligned_numeric_row", body & F.col("aligned") & (n > 0) & (r >= 0.18), F.lit(1.75)),
        ("metric_value", body & term & (n > 0), F.lit(1.75)),
        ("statistic", body & (n > 0) & _has(t, STATISTIC), F.lit(1.5)),
    ]
    score = F.lit(0.0)
    for _, when, worth in parts:
        score = score + F.when(when, worth).otherwise(0.0)
    cited = _has(t, REFERENCE) & ~term & ~caption
    df = df.withColumn("score", F.when(cited, F.greatest(F.lit(0.0), score - 2.5)).otherwise(score))
    enough = (t != "") & (F.col("score") >= least)
    kinds = F.array_compact(F.array(*[F.when(when, F.lit(name)) for name, when, _ in parts]))
    df = df.withColumn("kinds", F.when(enough, kinds).otherwise(F.array().cast("array<string>")))
    df = df.withColumn("score", F.when(enough, F.round("score", 6)).otherwise(0.0))
    return df.withColumn("numeric_ratio", F.round("numeric_ratio", 6)).drop("_t")
