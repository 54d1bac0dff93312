"""The registered queries over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import metrics, text
from tessera.operators import binding, compose, dedup, gates, layout, ledger, review, sampling, stats
from tessera.plans import cases
from tessera.sources import census
from tessera.sources.tables import candidates, proposals, table

QUERIES: dict = dict(cases.QUERIES)
ORACLE_SQL: dict[str, str] = dict(cases.ORACLE_SQL)


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


#: The same candidates in SQL.
_PROPOSALS = """p0 AS (SELECT l_orderkey * 10 + l_linenumber AS observation_id, 'Paper #' || (l_orderkey % 997) AS paper_id, s_name AS system, p_brand AS dataset,
  ['Accuracy', 'F1 score', 'BLEU', 'PPL', 'Speed'][l_linenumber % 5 + 1] AS metric_raw, ['perplexity', 'bleu', NULL][l_suppkey % 3 + 1] AS model_id,
  CAST(round(l_discount * 1000) AS INT) AS v, CAST(round(l_discount * 1000) AS INT) || CASE WHEN l_orderkey % 3 = 0 THEN '%' ELSE '' END AS raw,
  l_linenumber AS page, (l_partkey % 101) / 100.0 AS confidence,
  ['primary_result', 'primary_result', 'primary_result', 'secondary_result', 'setting'][l_orderkey % 5 + 1] AS claim_type,
  ['supported', 'supported', 'supported', 'partially_supported'][l_suppkey % 4 + 1] AS text_support,
  CASE WHEN l_partkey % 7 = 6 THEN 'consecutive_lines' ELSE 'single_line' END AS support_match_mode
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""
_CANDIDATES = (
    _PROPOSALS
    + """,
p1 AS (SELECT *, CASE metric_raw WHEN 'Accuracy' THEN 'accuracy' WHEN 'F1 score' THEN 'f1' WHEN 'BLEU' THEN 'bleu' END AS plain_id,
  CASE WHEN metric_raw = 'PPL' AND model_id = 'perplexity' THEN 'perplexity' END AS short_id FROM p0),
p2 AS (SELECT *, coalesce(plain_id, short_id, model_id) AS metric_id,
  CASE WHEN plain_id IS NOT NULL THEN 'registry' WHEN short_id IS NOT NULL THEN 'registry_concordant' WHEN model_id IS NOT NULL THEN 'model' ELSE 'none' END AS metric_source FROM p1),
p3 AS (SELECT *, CASE WHEN metric_id IN ('accuracy', 'f1') THEN CASE WHEN raw LIKE '%\\%' ESCAPE '\\' THEN 'percent' WHEN v BETWEEN 0 AND 1 THEN 'proportion'
  WHEN metric_source = 'registry' AND v > 1 AND v <= 100 THEN 'percent' END END AS unit FROM p2),
p4 AS (SELECT *, CASE WHEN v > CASE WHEN unit = 'percent' THEN 100 WHEN unit = 'proportion' THEN 1 WHEN metric_id IN ('accuracy', 'f1') THEN 1 WHEN metric_id = 'bleu' THEN 100 END
  OR v < CASE WHEN metric_id = 'perplexity' THEN 1 WHEN metric_id IS NOT NULL THEN 0 END THEN 'value_outside_registry_metric_bounds' END AS value_blocker,
  CASE WHEN claim_type <> 'primary_result' THEN 'unverified' WHEN metric_id IS NOT NULL AND (unit IS NOT NULL OR metric_id NOT IN ('accuracy', 'f1')) THEN 'resolved' ELSE 'unresolved' END AS referential_status,
  CASE WHEN observation_id % 3 = 2 THEN 'positive_structural' WHEN claim_type <> 'primary_result' THEN 'none' WHEN observation_id % 3 = 0 THEN 'no_external_cue'
  WHEN page = 1 THEN 'none' ELSE 'unchecked' END AS origin_basis FROM p3),
c AS (SELECT *, CASE WHEN claim_type <> 'primary_result' THEN 'not_eligible' WHEN text_support <> 'supported' OR value_blocker IS NOT NULL OR support_match_mode = 'consecutive_lines'
  OR referential_status <> 'resolved' OR confidence < 0.8 THEN 'needs_review' ELSE 'eligible' END AS export_status,
  CASE WHEN claim_type <> 'primary_result' THEN 'claim_type=' || claim_type || ' is not a primary result' WHEN text_support <> 'supported' THEN 'text_support=' || text_support
  WHEN value_blocker IS NOT NULL THEN 'value_blocker=' || value_blocker WHEN support_match_mode = 'consecutive_lines' THEN 'support_match_mode=consecutive_lines'
  WHEN referential_status <> 'resolved' THEN 'referential_status=' || referential_status
  WHEN confidence < 0.8 THEN 'extraction_confidence=0.' || lpad(CAST(CAST(round(confidence * 1000) AS INT) AS VARCHAR), 3, '0') || ' below 0.800'
  ELSE 'passed primary-result, evidence, reference, and confidence gates' END AS export_reason FROM p4)"""
)


@query(f"""WITH {_CANDIDATES}, e AS (SELECT * FROM c WHERE export_status = 'eligible' AND origin_basis <> 'none')
SELECT paper_id, system, count(*) AS n_results, string_agg(dataset || ':' || metric_id || '=' || raw, ';' ORDER BY dataset, metric_id, v, observation_id) AS results,
['none', 'unchecked', 'no_external_cue', 'reviewed_quote', 'positive_structural', 'human_confirmed'][min(list_position(['none', 'unchecked', 'no_external_cue', 'reviewed_quote', 'positive_structural', 'human_confirmed'], origin_basis))] AS origin_basis
FROM e GROUP BY paper_id, system""")
def q_compose_records(spark, d):
    own = candidates(spark, d).filter("export_status = 'eligible'").filter(gates.policy_permits(F.col("origin_basis"), "tiered"))
    flat = F.transform("results", lambda r: F.concat(r["dataset"], F.lit(":"), r["metric_id"], F.lit("="), r["raw"]))
    return compose.compose_records(own).select("paper_id", "system", F.size("results").cast("long").alias("n_results"), F.array_join(flat, ";").alias("results"), "origin_basis")


@query(f"WITH {_CANDIDATES} SELECT export_status, export_reason, count(*) AS n FROM c GROUP BY ALL")
def q_export_policy(spark, d):
    return candidates(spark, d).groupBy("export_status", "export_reason").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_CANDIDATES} SELECT metric_raw, metric_id, metric_source, unit, value_blocker, referential_status, count(*) AS n FROM c GROUP BY ALL")
def q_metric_resolution(spark, d):
    keys = ["metric_raw", "metric_id", "metric_source", "unit", "value_blocker", "referential_status"]
    return candidates(spark, d).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_CANDIDATES} SELECT origin_basis, origin_basis IN ('human_confirmed', 'positive_structural') AS positive_only, origin_basis <> 'none' AS tiered, count(*) AS n FROM c GROUP BY ALL")
def q_policy_permits(spark, d):
    c = candidates(spark, d)
    own = [gates.policy_permits(F.col("origin_basis"), p).alias(p) for p in ("positive_only", "tiered")]
    return c.groupBy("origin_basis", *own).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_PROPOSALS} SELECT paper_id, system, dataset, metric_raw, raw, min(observation_id) AS observation_id, count(*) AS merged, round(max(confidence), 6) AS confidence
FROM p0 GROUP BY paper_id, system, dataset, metric_raw, raw""")
def q_dedup_merge(spark, d):
    keys = ["paper_id", "system", "dataset", "metric_raw", "raw"]
    out = dedup.merge_duplicates(proposals(spark, d), keys, "observation_id")
    return out.select(*keys, "observation_id", "merged", F.round("confidence", 6).alias("confidence"))


@query(f"""WITH {_PROPOSALS}, s AS (SELECT paper_id, page, raw FROM p0 WHERE claim_type = 'primary_result' GROUP BY ALL HAVING min(system) <> max(system) OR min(dataset) <> max(dataset))
SELECT observation_id, s.raw IS NOT NULL AND claim_type = 'primary_result' AS ambiguous FROM p0 LEFT JOIN s ON p0.paper_id = s.paper_id AND p0.page = s.page AND p0.raw = s.raw""")
def q_ambiguous_evidence(spark, d):
    out = dedup.ambiguous(proposals(spark, d), ["paper_id", "page"], F.col("raw"), ["system", "dataset"], "raw", F.col("claim_type") == "primary_result")
    return out.select("observation_id", "ambiguous")


@query("SELECT sha256(text) AS text_key, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text")
def q_doc_exact_dedup(spark, d):
    docs = table(spark, d, "documents").select(F.sha2("text", 256).alias("text_key"), "doc_id")
    return docs.groupBy("text_key").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))


@query("SELECT p_partkey, trim(regexp_replace(lower(trim(p_name)), '[^a-z0-9]+', '-', 'g'), '-') AS slug, nullif(trim(regexp_replace(regexp_replace(lower(regexp_replace(trim(p_type || ' data set (test)'), '\\s*\\([^)]*\\)\\s*$', '')), '\\b(benchmark|dataset|corpus|data ?set)\\b', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')), '') AS dataset_key FROM part")
def q_names(spark, d):
    return table(spark, d, "part").select("p_partkey", text.slug(F.col("p_name")).alias("slug"), text.dataset_key(F.concat("p_type", F.lit(" data set (test)"))).alias("dataset_key"))


@query("SELECT doc_id, sha256(trim(regexp_replace(translate(text, chr(160) || chr(8722), ' -'), '[ \\t\\n\\r\\f\\x0b]+', ' ', 'g'))) AS evidence_sha256 FROM documents")
def q_evidence_text(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(text.evidence_text(F.col("text")), 256).alias("evidence_sha256"))



@query("SELECT doc_id, sha256('7|audit|' || doc_id) AS order_key, round((row_number() OVER (PARTITION BY lang, source ORDER BY sha256('7|audit|' || doc_id)) - 0.5) / count(*) OVER (PARTITION BY lang, source), 9) AS position FROM documents")
def q_stratified_order(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    out = sampling.stratified_order(docs, ["lang", "source"], text.hash_key("7", F.lit("audit"), F.col("doc_id")))
    return out.select("doc_id", "order_key", F.round("position", 9).alias("position"))


@query("""WITH e AS (SELECT doc_id, lang, source, sha256('7|reserve|' || doc_id) AS k FROM documents ANTI JOIN labels USING (doc_id)),
o AS (SELECT *, (row_number() OVER (PARTITION BY lang, source ORDER BY k) - 0.5) / count(*) OVER (PARTITION BY lang, source) AS position FROM e)
SELECT doc_id, lang, source FROM o ORDER BY position, k LIMIT 60""")
def q_reserve_draw(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source").join(table(spark, d, "labels"), "doc_id", "left_anti")
    return sampling.draw(docs, ["lang", "source"], text.hash_key("7", F.lit("reserve"), F.col("doc_id")), 60).select("doc_id", "lang", "source")


@query("SELECT doc_id, quality, place FROM (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY sha256('3|' || doc_id)) AS place FROM labels) WHERE place <= 25")
def q_label_packet(spark, d):
    return sampling.quota(table(spark, d, "labels"), ["quality"], "3", "doc_id", 25).select("doc_id", "quality", F.col("place").cast("long").alias("place"))


@query(f"""WITH {_CANDIDATES} SELECT observation_id, CASE WHEN export_status = 'eligible' THEN 8 ELSE 0 END + CASE WHEN export_status = 'needs_review' THEN 9 ELSE 0 END
+ CASE WHEN text_support <> 'supported' THEN 10 ELSE 0 END + CASE WHEN confidence < 0.9 THEN 6 ELSE 0 END + CASE WHEN unit IS NULL THEN 7 ELSE 0 END AS risk,
concat_ws('|', CASE WHEN confidence < 0.9 THEN 'confidence' END, CASE WHEN export_status = 'eligible' THEN 'eligible' END, CASE WHEN export_status = 'needs_review' THEN 'needs_review' END,
CASE WHEN text_support <> 'supported' THEN 'text_risk' END, CASE WHEN unit IS NULL THEN 'unit_missing' END) AS reasons FROM c""")
def q_risk_rank(spark, d):
    flags = {
        "eligible": (F.col("export_status") == "eligible", 8), "needs_review": (F.col("export_status") == "needs_review", 9),
        "text_risk": (F.col("text_support") != "supported", 10), "confidence": (F.col("confidence") < 0.9, 6), "unit_missing": (F.col("unit").isNull(), 7),
    }
    weight, reasons = sampling.risk(flags)
    return candidates(spark, d).select("observation_id", weight.cast("int").alias("risk"), reasons.alias("reasons"))


@query("SELECT quality AS truth, toxic AS guess, count(*) AS n FROM labels GROUP BY ALL")
def q_confusion(spark, d):
    return stats.confusion(table(spark, d, "labels"), "quality", "toxic")


@query("""WITH k AS (SELECT unnest([0, 1]) AS class), s AS (SELECT class, count(*) FILTER (WHERE quality = class AND toxic = class) AS tp, count(*) FILTER (WHERE quality <> class AND toxic = class) AS fp,
count(*) FILTER (WHERE quality = class AND toxic <> class) AS fn FROM labels, k GROUP BY class)
SELECT class, tp, fp, fn, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1 FROM s""")
def q_claim_type_f1(spark, d):
    return stats.precision_recall(table(spark, d, "labels"), "quality", "toxic")


@query("""WITH l AS (SELECT 'c' || (quality + toxic) AS a, 'c' || (2 * toxic) AS b FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL), n AS (SELECT count(*) AS n, count(*) FILTER (WHERE a = b) / count(*) AS o FROM l),
x AS (SELECT a AS c, count(*) AS k FROM l GROUP BY a), y AS (SELECT b AS c, count(*) AS k FROM l GROUP BY b), e AS (SELECT sum(x.k * y.k) AS s FROM x JOIN y USING (c))
SELECT n, round(o, 6) AS observed, round(s / n / n, 6) AS expected, round((o - s / n / n) / nullif(1 - s / n / n, 0), 6) AS kappa FROM n, e""")
def q_cohen_kappa(spark, d):
    rated = table(spark, d, "labels").select(F.concat(F.lit("c"), F.col("quality") + F.col("toxic")).alias("a"), F.concat(F.lit("c"), 2 * F.col("toxic")).alias("b"))
    return stats.cohen_kappa(rated, "a", "b")


@query("""WITH l AS (SELECT quality AS t, toxic AS g FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL), k AS (SELECT unnest([0, 1]) AS c),
f AS (SELECT c, round(2 * count(*) FILTER (WHERE t = c AND g = c) / nullif(count(*) FILTER (WHERE t = c) + count(*) FILTER (WHERE g = c), 0), 6) AS f1 FROM l, k GROUP BY c HAVING count(*) FILTER (WHERE t = c) > 0)
SELECT (SELECT count(*) FROM l) AS n, round((SELECT count(*) FILTER (WHERE t = g) / count(*) FROM l), 6) AS accuracy, round(avg(coalesce(f1, 0)), 6) AS macro_f1 FROM f""")
def q_class_summary(spark, d):
    return stats.class_summary(table(spark, d, "labels"), "quality", "toxic")


@query("SELECT event_type, count(*) AS n, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(min(value), 6) AS least, round(max(value), 6) AS most FROM events WHERE value IS NOT NULL GROUP BY event_type")
def q_latency_percentiles(spark, d):
    out = stats.quantiles(table(spark, d, "events"), "event_type", "value", {"p50": 0.5, "p95": 0.95})
    return out.select("event_type", "n", "p50", "p95", F.round("least", 6).alias("least"), F.round("most", 6).alias("most"))


@query("""WITH c AS (SELECT CASE o_orderkey % 4 WHEN 1 THEN '' WHEN 2 THEN '{}' WHEN 3 THEN o_orderstatus END AS note, CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_custkey END AS owner FROM orders)
SELECT round(count(*) FILTER (WHERE note IS NULL OR note IN ('', '{}')) / count(*), 6) AS note_null, round(count(*) FILTER (WHERE owner IS NULL) / count(*), 6) AS owner_null,
CASE WHEN round(count(*) FILTER (WHERE owner IS NULL) / count(*), 6) <= 0.1 THEN 'passed' ELSE 'failed' END AS owner_gate FROM c""")
def q_null_rates(spark, d):
    k = F.col("o_orderkey")
    note = F.when(k % 4 == 1, "").when(k % 4 == 2, "{}").when(k % 4 == 3, F.col("o_orderstatus"))
    own = table(spark, d, "orders").select(note.alias("note"), F.when(k % 20 != 0, F.col("o_custkey")).alias("owner"))
    return own.agg(stats.null_rate("note").alias("note_null"), stats.null_rate("owner").alias("owner_null"), gates.gate(stats.null_rate("owner"), 0.1, at_least=False).alias("owner_gate"))


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id, count(*) AS events FROM events GROUP BY user_id")
def q_ledger_last_state(spark, d):
    return ledger.last_state(table(spark, d, "events"), "user_id", "event_id", "event_type", "event_id")


_COST = "CAST(round(value * 100) AS BIGINT)"


@query(f"""WITH RECURSIVE e AS (SELECT event_id, user_id, {_COST} AS c, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
f AS (SELECT event_id, user_id, i, CASE WHEN c <= 2000 THEN c ELSE 0 END AS committed, c <= 2000 AS admitted FROM e WHERE i = 1
UNION ALL SELECT e.event_id, e.user_id, e.i, f.committed + CASE WHEN f.committed + e.c <= 2000 THEN e.c ELSE 0 END, f.committed + e.c <= 2000 FROM f JOIN e ON e.user_id = f.user_id AND e.i = f.i + 1)
SELECT event_id, CAST(committed AS BIGINT) AS committed, admitted FROM f""")
def q_admission_replay(spark, d):
    cost = F.round(F.col("value") * 100).cast("long")
    return ledger.admitted(table(spark, d, "events").select("event_id", "user_id", "value"), "user_id", "event_id", cost, 2000).select("event_id", "committed", "admitted")


@query("""WITH e AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, CAST(event_id AS VARCHAR) AS p FROM events),
h AS (SELECT user_id, i, sha256(p) AS link, p FROM e), g AS (SELECT user_id, count(*) AS n FROM e GROUP BY user_id)
SELECT user_id, n AS events, CASE WHEN user_id % 3 = 1 AND n > 2 THEN 2 WHEN user_id % 3 = 2 AND n > 1 THEN 1 END AS broken, CASE WHEN user_id % 3 = 1 AND n > 2 THEN 'hash' WHEN user_id % 3 = 2 AND n > 1 THEN 'link' END AS issue FROM g""")
def q_ledger_chain(spark, d):
    """Chains of events whose third hash (users 1 mod 3) or second link (2 mod 3) is wrong; each link is a hash of its place."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("event_id")
    i = F.row_number().over(w) - 1
    own = table(spark, d, "events").select("user_id", "event_id", i.cast("long").alias("i"))
    # A chain whose hash depends on its place alone, so that it can be made without a fold.
    made = lambda k: F.sha2(F.concat(F.col("user_id").cast("string"), F.lit("#"), (F.col("i") + k).cast("string")), 256)
    link = F.when(F.col("i") == 0, "").otherwise(made(-1))
    own = own.withColumn("previous", F.when((F.col("user_id") % 3 == 2) & (F.col("i") == 1), "x").otherwise(link))
    own = own.withColumn("own", made(0)).withColumn("payload", F.when((F.col("user_id") % 3 == 1) & (F.col("i") == 2), "forged").otherwise("p"))
    return ledger.chain_issues(own, "user_id", "i", "previous", "own", F.col("payload"), hashed=lambda p, q: F.when(q == "p", made(0)).otherwise(F.sha2(F.concat(p, q), 256)))


@query("""SELECT o_custkey, CASE min(CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 WHEN 'F' THEN 3 END) WHEN 1 THEN 'P' WHEN 2 THEN 'O' ELSE 'F' END AS o_orderstatus, count(*) AS n FROM orders GROUP BY o_custkey""")
def q_paper_status(spark, d):
    return ledger.status_priority(table(spark, d, "orders"), "o_custkey", "o_orderstatus", ["P", "O", "F"])


@query("SELECT c_custkey, o.k IS NOT NULL AS inspected FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders) o ON c_custkey = o.k")
def q_previously_inspected(spark, d):
    seen = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return sampling.inspected(table(spark, d, "customer").select("c_custkey"), seen, "c_custkey")


@query("""WITH u AS (SELECT DISTINCT event_type, user_id FROM events), n AS (SELECT event_type, count(*) AS n FROM u GROUP BY event_type),
b AS (SELECT x.event_type AS left_type, y.event_type AS right_type, count(*) AS shared FROM u x JOIN u y ON x.user_id = y.user_id AND x.event_type < y.event_type GROUP BY ALL)
SELECT left_type, right_type, shared, round(shared / (l.n + r.n - shared), 6) AS jaccard FROM b JOIN n l ON left_type = l.event_type JOIN n r ON right_type = r.event_type""")
def q_stability_jaccard(spark, d):
    return stats.jaccard(table(spark, d, "events"), "event_type", "user_id").toDF("left_type", "right_type", "shared", "jaccard")


@query("""WITH r AS (SELECT o_custkey, o_totalprice AS v, row_number() OVER w AS i, count(*) OVER (PARTITION BY o_custkey) AS n, avg(o_totalprice) OVER (PARTITION BY o_custkey) AS m FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice))
SELECT o_custkey, max(n) AS n, round(CASE WHEN max(n) < 5 THEN 400000 ELSE least(400000, greatest(max(v) FILTER (WHERE i = least(n, CAST(floor(0.95 * n) AS BIGINT) + 1)), 2 * max(m))) END, 4) AS reserved FROM r GROUP BY o_custkey""")
def q_budget_estimate(spark, d):
    out = stats.reserve_estimate(table(spark, d, "orders"), "o_custkey", "o_totalprice", 400000.0)
    return out.select("o_custkey", "n", F.round("reserved", 4).alias("reserved"))


@query("SELECT * FROM (VALUES (8, 10, 0.443905, 0.974789), (0, 10, 0.0, 0.308497), (10, 10, 0.691503, 1.0), (5, 20, 0.086571, 0.491046)) AS v(k, n, lower, upper)")
def q_clopper_pearson(spark, d):
    """Exact intervals of fixed rows; a table's labels are such a row once aggregated."""
    rows = spark.createDataFrame([(8, 10), (0, 10), (10, 10), (5, 20)], "k int, n int")
    return stats.binomial_interval(rows, "k", "n").select("k", "n", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"))


@query(r"""WITH l AS (SELECT doc_id, i, trim(unnest(string_split(coalesce(text, ''), chr(10))), ' ') AS t FROM (SELECT doc_id, text, 0 AS i FROM documents)),
f AS (SELECT doc_id, t, len(regexp_extract_all(' ' || regexp_replace(t, '([0-9%])', '\1', 'g'), '\S+')) AS tokens FROM l)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE t = '') AS blank, sum(tokens) AS tokens, count(*) FILTER (WHERE len(list_filter(regexp_split_to_array(t, '\s{2,}'), lambda x: x <> '')) >= 2) AS aligned,
count(*) FILTER (WHERE regexp_matches(t, '(?i)(^|\s{2,})(table|figure|fig\.?|chart|plot)\s+([A-Z]?\d+([.\-]\d+)*|[IVXLCDM]+)\s*(:|[.]|[-–—])')) AS captions FROM f GROUP BY doc_id""")
def q_line_shapes(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.explode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("line"))
    f = layout.line_features(lines, "line")
    tokens = F.size(F.regexp_extract_all(F.trim("line"), F.lit(r"\S+"), F.lit(0)))
    many = lambda c: F.sum(c.cast("long"))
    return f.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"), many(F.trim("line") == "").alias("blank"), many(tokens).alias("tokens"), many(F.col("aligned")).alias("aligned"), many(F.col("caption")).alias("captions"),
    )


@query("""WITH l AS (SELECT o_orderkey, o_orderkey % 9 AS i FROM orders)
SELECT o_orderkey, n, caption, heading, aligned, score, kinds FROM l JOIN (VALUES (0, 4, false, false, true, 4.75, 'numeric_dense|aligned_numeric_row'), (1, 1, true, false, false, 3.0, 'caption'), (2, 1, false, true, false, 2.5, 'result_heading'),
(3, 1, false, false, false, 1.75, 'metric_value'), (4, 2, false, false, false, 3.666667, 'numeric_dense|statistic'), (5, 0, false, false, false, 0.0, ''), (6, 0, false, false, false, 0.0, ''), (7, 4, false, false, false, 0.0, ''), (8, 0, false, true, false, 0.0, '')) AS v(i, n, caption, heading, aligned, score, kinds) USING (i)""")
def q_line_features(spark, d):
    lines = ["BERT  91.2 90.1  89 88%", "Table 1: Scores", "4.2 Main Results", "the accuracy was 91", "p < 0.05 12 ok r", "", None, "see https://x.org pp. 12-15 12 3", "RELATED WORK"]
    f = layout.line_features(cases.dealt(spark, d, [(x,) for x in lines], "line string"), "line")
    return f.select("o_orderkey", F.col("numeric_count").cast("long").alias("n"), "caption", "heading", "aligned", "score", F.array_join("kinds", "|").alias("kinds"))


_BOUND = [("GLUE", None), ("the general benchmark", None), ("SQuAD", None), ("our test set", "Results on GLUE dev"), ("GLUE and XYZ", "Results on GLUE dev"), ("MNLI", "GLUE and SQuAD"), ("test set", None), ("Table 3", None), ("something", None), (None, None)]


@query("""SELECT o_orderkey, entry_id, binding, rule FROM orders JOIN (VALUES (0, 'e1', 'exact', 'exact_name'), (1, 'e1', 'exact', 'exact_alias'), (2, NULL, 'none', 'none_exact_ambiguous'), (3, 'e1', 'caption', 'caption_single_entry'),
(4, NULL, 'none', 'none_caption_overrides_named_raw'), (5, NULL, 'none', 'none_caption_ambiguous'), (6, 'e1', 'unique', 'unique_split_word'), (7, 'e1', 'unique', 'unique_table_reference'), (8, NULL, 'none', 'none_no_rule_matched'),
(9, NULL, 'none', 'none_no_rule_matched')) AS v(i, entry_id, binding, rule) ON o_orderkey % 10 = v.i""")
def q_dataset_binding(spark, d):
    rows = cases.dealt(spark, d, _BOUND, "raw string, shown string").withColumn("paper_id", F.lit("p"))
    entries = [("p", "e1", "GLUE", "dataset", ["The General Benchmark", None]), ("p", "e2", "SQuAD", "benchmark", []), ("p", "e3", "squad!", "benchmark", None), ("q", "e4", "GLUE", "dataset", [])]
    listed = spark.createDataFrame(entries, "paper_id string, entry_id string, name_raw string, kind string, aliases array<string>")
    return binding.bind(rows, listed, "raw", "shown").select("o_orderkey", "entry_id", "binding", "rule")


@query("""SELECT o_orderkey, text_support, support_match_mode FROM orders JOIN (VALUES (0, 'supported', 'single_line'), (1, 'partially_supported', 'single_line'), (2, 'unsupported', NULL), (3, 'supported', 'consecutive_lines'),
(4, 'partially_supported', 'single_line'), (5, 'unsupported', NULL), (6, 'unsupported', NULL)) AS v(i, text_support, support_match_mode) ON o_orderkey % 7 = v.i""")
def q_text_support(spark, d):
    rows = [("91.2", [("s", 1, "BERT 91.2")]), ("91.2", [("s", 1, "BERT 91.2"), ("s", 1, "no such line")]), ("91.2", [("s", 9, "BERT 91.2")]), (None, [("s", 1, "BERT 91.2\nGPT 90")]), ("1.2", [("s", 1, "BERT 91.2")]), ("1", []), ("1", None)]
    own = cases.dealt(spark, d, rows, "raw string, anchors array<struct<source: string, page: int, quote: string>>").withColumnRenamed("o_orderkey", "observation_id")
    pages = spark.createDataFrame([("s", 1, ["x BERT 91.2 y", "BERT  91.2", "GPT 90"])], "source string, page int, lines array<string>")
    return gates.text_support(own, pages).select(F.col("observation_id").alias("o_orderkey"), "text_support", "support_match_mode")


@query("""SELECT o_orderkey, status, reason FROM orders JOIN (VALUES (0, 'needs_review', 'field_provenance=missing'), (1, 'needs_review', 'field_provenance=conflict'), (2, 'needs_review', 'field_provenance=ambiguous_or_unsupported'),
(3, 'eligible', 'passed primary-result, evidence, reference, and confidence gates'), (4, 'needs_review', 'extraction_confidence=0.700 below 0.800'), (5, 'needs_review', 'extraction_confidence=missing'), (6, 'not_eligible', 'claim_type=setting is not a primary result'))
AS v(i, status, reason) ON o_orderkey % 7 = v.i""")
def q_export_provenance(spark, d):
    good = [(True, True, "bound"), (False, True, "conflict"), (True, False, "unsupported")]
    rows = [(None, 0.9, "primary_result"), ([(True, False, "conflict")], 0.9, "primary_result"), ([(True, True, "ambiguous")], 0.9, "primary_result"), (good, 0.9, "primary_result"), (good, 0.7, "primary_result"), (good, None, "primary_result"), (None, 0.9, "setting")]
    own = cases.dealt(spark, d, rows, "fields array<struct<populated: boolean, gating: boolean, status: string>>, confidence double, claim_type string")
    own = own.withColumn("text_support", F.lit("supported")).withColumn("value_blocker", F.lit(None).cast("string")).withColumn("support_match_mode", F.lit("single_line")).withColumn("referential_status", F.lit("resolved"))
    return gates.export_policy(own, provenance=F.col("fields")).select("o_orderkey", F.col("export_status").alias("status"), F.col("export_reason").alias("reason"))


@query("""WITH c AS (SELECT o_orderkey AS line, CASE o_orderkey % 10 WHEN 0 THEN '' WHEN 1 THEN '***' ELSE 'Paper ' || (o_orderkey % 1000) END AS id,
CASE o_orderkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'ftp://x' ELSE 'HTTPS://x/' END AS url, CASE o_orderkey % 11 WHEN 0 THEN 'n.d.' ELSE '2020' END AS y FROM orders),
f AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY line) AS k, trim(regexp_replace(lower(id), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM c),
e AS (SELECT *, CASE WHEN id = '' THEN 'missing_paper_id' WHEN k > 1 THEN 'duplicate_census_paper_id' WHEN url = '' THEN 'missing_pdf_url' WHEN url LIKE 'ftp%' THEN 'pdf_url_not_absolute_http' WHEN slug = '' THEN 'unusable_paper_id' END AS early FROM f),
g AS (SELECT *, row_number() OVER (PARTITION BY slug, early IS NULL ORDER BY line) AS j FROM e)
SELECT line, coalesce(early, CASE WHEN j > 1 THEN 'duplicate_derived_paper_id' WHEN y = 'n.d.' THEN 'unreadable_year' END) AS reason FROM g""")
def q_census_rows(spark, d):
    k = F.col("o_orderkey")
    own = table(spark, d, "orders").select(
        k.alias("line"), F.when(k % 10 == 0, " ").when(k % 10 == 1, "***").otherwise(F.concat(F.lit("Paper "), (k % 1000).cast("string"))).alias("paper_id"),
        F.when(k % 7 == 0, F.lit(None).cast("string")).when(k % 7 == 1, "ftp://x").otherwise("HTTPS://x/").alias("pdf_url"), F.when(k % 11 == 0, "n.d.").otherwise(" 2020").alias("year"),
    )
    return census.judge_census(own).select("line", "reason")


@query(f"""WITH {_CANDIDATES} SELECT observation_id, 'page ' || page AS page_text FROM c WHERE text_support = 'supported' AND claim_type = 'primary_result' AND export_status <> 'eligible' AND observation_id % 5 <> 0 AND page <= 5""")
def q_review_items(spark, d):
    own = candidates(spark, d).withColumn("state", F.when(F.col("observation_id") % 5 == 0, "externally_sourced"))
    pages = own.select("paper_id", "page").distinct().filter("page <= 5").withColumn("page_text", F.concat(F.lit("page "), F.col("page").cast("string")))
    return review.review_items(own, pages).select("observation_id", "page_text")


@query("""SELECT o_orderkey AS observation_id, CASE WHEN o_orderkey % 4 = 0 THEN 'eligible_not_authorized' WHEN o_orderkey % 4 = 1 THEN 'authorized_not_eligible' ELSE 'stale_authorization' END AS issue FROM orders WHERE o_orderkey % 4 < 3""")
def q_export_coverage(spark, d):
    own = table(spark, d, "orders").select(F.col("o_orderkey").alias("observation_id"), F.sha2(F.col("o_orderkey").cast("string"), 256).alias("payload_sha256"))
    given = own.withColumn("payload_sha256", F.when(F.col("observation_id") % 4 == 2, "old").otherwise(F.col("payload_sha256")))
    return compose.coverage_issues(own.filter("observation_id % 4 <> 1"), given.filter("observation_id % 4 <> 0"))
