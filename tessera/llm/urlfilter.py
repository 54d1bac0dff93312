"""URL filters: host and path rules, and beyond them trust and distrust spread over the link graph.

Hosts are nodes; an edge from host a to host b weighs the share of a's links to other hosts that go to
b. Trust is a personalised PageRank from hosts with allowed pages along links; distrust starts at hosts with
blocked pages and runs against the links, from a host to those that link to it. Each seed
weighs by its pages. A host whose distrust is at least the threshold share of both is blocked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, lower_ascii, table

#: (rule, verdict): host/path; it fits the host and its subdomains where the url's path starts with the path.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: The rules stand in the plan, so they are few; more belong into a table to be joined by host suffix.
MOST_RULES = 10_000
DAMPING, SETTLED, THRESHOLD = 0.85, 1e-6, 0.6

_LINK = r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; null or without :// empty."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(after)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules) -> Column:
    """struct(n, rule, verdict) of the longest rule that fits, the largest of equals; null if none does."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    if not rules:
        return F.lit(None).cast("struct<n:int,rule:string,verdict:string,path:string>")
    by_host: dict[str, list] = {}
    for rule, verdict in rules:
        at, slash, rest = rule.partition("/")
        by_host.setdefault(at.lower(), []).append((rule, verdict, slash + rest))
    one = lambda r: F.struct(F.lit(len(r[0])).alias("n"), F.lit(r[0]).alias("rule"), F.lit(r[1]).alias("verdict"), F.lit(r[2]).alias("path"))
    known = F.create_map(*[x for h, own in by_host.items() for x in (F.lit(h), F.array(*map(one, own)))])
    parts = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    fitting = F.flatten(F.filter(F.transform(suffixes, lambda s: known[s]), lambda r: r.isNotNull()))
    return F.array_max(F.filter(fitting, lambda r: F.startswith(path, r["path"])))


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts, counted; absolute and protocol-relative ones."""
    links = F.array_distinct(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_LINK), F.lit(1)))
    there = host_of(F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("http:"), "link")).otherwise(F.col("link")))
    found = pages.select(host_of(F.col("url")).alias("src"), F.explode(links).alias("link")).select("src", there.alias("dst"))
    return found.filter("src <> dst AND src <> '' AND dst <> ''").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(seeds: DataFrame, edges: DataFrame, scratch: Scratch, damping: float = DAMPING, rounds: int | None = None) -> DataFrame:
    """seeds(host, t, d), edges(src, dst, n) -> (host, trust, distrust); it ends when a round moves less than SETTLED and reaches no new host.

    Ranks that have not settled after so many rounds, if given, are an error. Each round reads the written ranks of the one before; contributions are summed before they are shuffled.
    """
    edges = scratch.keep(edges, "edges")
    ends = edges.select(F.col("src").alias("host")).union(edges.select(F.col("dst").alias("host"))).distinct()
    totals = [F.sum("t"), F.sum("d")]
    t, d = (x or 1.0 for x in seeds.agg(*totals).first())
    base = ends.join(seeds, "host", "full").select("host", *((F.coalesce(c, F.lit(0.0)) / v).alias(c) for c, v in (("t", t), ("d", d))))
    out = edges.groupBy("src").agg(F.sum("n").alias("all_out"))
    back = edges.groupBy("dst").agg(F.sum("n").alias("all_in"))
    # Trust goes from src to dst by shares of src's links, distrust from dst to src by shares of dst's.
    along = edges.join(out, "src").select(F.col("src").alias("a"), F.col("dst").alias("b"), (F.col("n") / F.col("all_out")).alias("w"), F.lit(True).alias("forth"))
    against = edges.join(back, "dst").select(F.col("dst").alias("a"), F.col("src").alias("b"), (F.col("n") / F.col("all_in")).alias("w"), F.lit(False).alias("forth"))
    flows = scratch.keep(along.unionByName(against), "flows")
    now = scratch.keep(base.select("host", "t", "d", (F.col("t") * (1 - damping)).alias("trust"), (F.col("d") * (1 - damping)).alias("distrust"), F.lit(1.0).alias("moved")), "ranks")
    linked = flows.take(1)
    reached = F.sum((F.col("trust") > 0).cast("long") + (F.col("distrust") > 0).cast("long"))
    done, known = 0, now.agg(reached).first()[0]
    while linked:
        if done == rounds:
            raise RuntimeError(f"trust and distrust have not settled after {rounds} rounds")
        done += 1
        given = (
            flows.join(now.select(F.col("host").alias("a"), "trust", "distrust"), "a")
            .groupBy(F.col("b").alias("host"))
            .agg(F.sum(F.when(F.col("forth"), F.col("w") * F.col("trust"))).alias("more_t"), F.sum(F.when(~F.col("forth"), F.col("w") * F.col("distrust"))).alias("more_d"))
        )
        new = now.join(given, "host", "left").select(
            "host", "t", "d",
            ((1 - damping) * F.col("t") + damping * F.coalesce("more_t", F.lit(0.0))).alias("new_t"),
            ((1 - damping) * F.col("d") + damping * F.coalesce("more_d", F.lit(0.0))).alias("new_d"),
            "trust", "distrust",
        )
        new = new.select("host", "t", "d", F.col("new_t").alias("trust"), F.col("new_d").alias("distrust"), (F.abs(F.col("new_t") - F.col("trust")) + F.abs(F.col("new_d") - F.col("distrust"))).alias("moved"))
        after = scratch.keep(new, "ranks")
        scratch.drop(now)
        now = after
        before = known
        moved, known = now.agg(F.sum("moved"), reached).first()
        if moved < SETTLED and known == before:
            break
    return now.select("host", "trust", "distrust")


def filter_urls(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD, scratch: Scratch | None = None) -> DataFrame:
    """pages(page_id, url, html) -> (page_id, host, path, rule, verdict, trust, distrust), a row for each page.

    A null url, or one without ://, has empty host and path, no rule, and is allowed. A page without a
    rule has its host's verdict: block if distrust is at least threshold of trust + distrust, else
    allow; so are hosts that no seed reaches. Null html has no links. Of rules equally long the
    largest wins. Repeated rows stay. Extra columns are not read; an empty table gives an empty result.
    """
    scratch = scratch or Scratch(pages.sparkSession)
    judged = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = judged.withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    judged = scratch.keep(judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("own")), "judged")
    seeds = judged.filter("host <> ''").groupBy("host").agg(
        F.sum(F.when(F.col("own") == "allow", 1.0).otherwise(0.0)).alias("t"), F.sum(F.when(F.col("own") == "block", 1.0).otherwise(0.0)).alias("d")
    )
    ranks = propagate(seeds, host_edges(pages), scratch)
    share = F.col("distrust") / (F.col("trust") + F.col("distrust"))
    blocked = (F.col("distrust") > 0) & (share >= threshold)
    return judged.join(ranks, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("own", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def op1_url_filter(spark, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
