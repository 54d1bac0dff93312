import pytest
from pyspark.sql import functions as F

from tessera.functions import metrics, text
from tessera.operators import compose, dedup, gates, ledger, sampling, stats
from tessera.sources import census
from tessera.streaming.ledger import admit_stream


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'double'}" for k, v in values.items()))
    return df.select(column.alias("x")).first()[0]


def test_text(spark):
    assert one(spark, text.evidence_text(F.col("a")), a=" x − 1\n\ty ") == "x - 1 y"
    assert one(spark, text.evidence_text(F.col("a")), a=None) is None
    assert one(spark, text.slug(F.col("a")), a="  A_b C!") == "a-b-c"
    assert one(spark, text.dataset_key(F.col("a")), a="The Dataset (v2)") == "the"
    assert one(spark, text.dataset_key(F.col("a")), a="test set") == "test set"
    assert one(spark, text.dataset_key(F.col("a")), a="data set") is None
    assert one(spark, text.tokens(F.col("a")), a="a; ;b") == ["a", "b"]
    assert one(spark, text.literal_present(F.col("a"), F.lit("7.5")), a="is 7.5 now")
    assert not one(spark, text.literal_present(F.col("a"), F.lit("7.5")), a="is 17.5 now")
    assert one(spark, text.number_present(F.col("a"), F.lit("1200")), a="about 1,200 rows")
    assert one(spark, text.names_compatible(F.col("a"), F.lit("GLUE")), a="GLUE dev")
    assert not one(spark, text.quote_on_page(F.lit(""), F.col("a")), a="page")


def test_units(spark):
    assert one(spark, metrics.unit(F.col("a")), a=" % ") == "percent"
    assert one(spark, metrics.unit(F.col("a")), a="ms") == "ms"
    assert one(spark, metrics.unit(F.col("a")), a="") == "" and one(spark, metrics.unit(F.col("a")), a=None) is None


def test_gate_keeps_null_apart(spark):
    df = spark.createDataFrame([(0.9,), (0.1,), (None,)], "v double")
    assert [r[0] for r in df.select(gates.gate(F.col("v"), 0.5)).collect()] == ["passed", "failed", "not_measured"]


def test_basis_table(spark):
    rows = [("paper_produced", "reviewed:1", True, False), ("paper_produced", "x", True, False), ("externally_sourced", "x", True, True), ("no_signal", "no_cue", True, False), ("no_signal", "other", True, False), ("unresolved", "x", True, True), ("unresolved", "x", True, False), ("no_signal", "no_cue", False, False)]
    df = spark.createDataFrame(rows, "o string, r string, p boolean, c boolean")
    got = [x[0] for x in df.select(gates.origin_basis(F.col("o"), F.col("r"), F.col("p"), F.col("c"))).collect()]
    assert got == ["human_confirmed", "positive_structural", "none", "no_external_cue", "none", "none", "unchecked", "none"]


def test_merge_and_ambiguity(spark):
    df = spark.createDataFrame([(2, "a", "x", 0.5), (1, "a", "y", 0.9), (3, "b", "x", 0.1)], "id long, k string, v string, confidence double")
    got = {r["k"]: r for r in dedup.merge_duplicates(df, ["k"], "id").collect()}
    assert (got["a"]["v"], got["a"]["merged"], got["a"]["confidence"]) == ("y", 2, 0.9)


def test_ambiguity_needs_incompatible_names_and_overlapping_quotes(spark):
    rows = [(1, "p", "9.1", "BERT", "GLUE", "row a", True), (2, "p", "9.1", "BERT base", "GLUE", "row a b", True), (3, "p", "9.1", "GPT", "GLUE", "row a", True), (4, "p", "9.1", "XLM", "GLUE", "other", True), (5, "p", "9.1", "T5", "GLUE", "row a", False), (6, "q", "9.1", "T5", "GLUE", "row a", True), (7, "p", None, "T5", "GLUE", "row a", True), (8, "p", "8", None, "GLUE", None, True), (9, "p", "8", "T5", "GLUE", None, True)]
    df = spark.createDataFrame(rows, "id long, paper string, raw string, system string, dataset string, quote string, main boolean")
    out = dedup.ambiguous(df, ["paper"], F.col("raw"), ["system", "dataset"], "quote", F.col("main"))
    assert {r["id"] for r in out.collect() if r["ambiguous"]} == {1, 2, 3} and out.count() == 9
    out = dedup.demote_ambiguous(out.withColumn("referential_status", F.lit("resolved")).withColumn("export_status", F.lit("eligible")).withColumn("export_reason", F.lit("ok")))
    assert {r["id"] for r in out.collect() if r["export_status"] == "needs_review"} == {1, 2, 3}


def test_ledger(spark):
    df = spark.createDataFrame([(1, "u", 5), (2, "u", 6), (3, "v", 1)], "i long, u string, c long")
    assert [r["admitted"] for r in ledger.admitted(df, "u", "i", F.col("c"), 10).orderBy("i").collect()] == [True, False, True]


def test_ledger_goes_on_after_a_refusal(spark):
    df = spark.createDataFrame([(1, "u", 5), (2, "u", 6), (3, "u", 5), (4, "u", None), (5, "u", -3), (6, "u", 3), (1, None, 1)], "i long, u string, c long")
    got = ledger.admitted(df, "u", "i", F.col("c"), 10).filter("u IS NOT NULL").orderBy("i").collect()
    assert [(r["committed"], r["admitted"]) for r in got] == [(5, True), (5, False), (10, True), (10, False), (7, True), (10, True)]
    assert ledger.admitted(df.limit(0), "u", "i", F.col("c"), 10).count() == 0


def test_kappa_of_text_classes_and_nulls(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "b"), ("c", "a"), ("c", "c"), (None, "a")], "x string, y string")
    r = stats.cohen_kappa(df, "x", "y").first()
    assert (r["n"], r["observed"], r["expected"], r["kappa"]) == (4, 0.75, 0.3125, 0.636364)
    assert stats.cohen_kappa(df.limit(0), "x", "y").first()["kappa"] is None
    assert stats.cohen_kappa(df.filter("x = 'a'"), "x", "y").first()["kappa"] is None


def test_unknown_names_raise(spark):
    with pytest.raises(ValueError):
        gates.policy_permits(F.lit("none"), "positve_only")
    with pytest.raises(ValueError):
        gates.replay_scope(spark.range(1), "some")
    with pytest.raises(ValueError):
        stats.clopper_pearson(1, 0)


def test_replay_scope_and_safety_routing(spark):
    df = spark.createDataFrame([("primary_result", "supported", "BERT", "bert"), ("primary_result", "unsupported", "a", "b"), ("setting", "supported", "a", "b")], "claim_type string, text_support string, s string, d string")
    assert [gates.replay_scope(df, x).count() for x in ("all", "primary", "export_gate")] == [3, 2, 1]
    n = F.lit(None).cast("string")
    own = df.withColumn("referential_status", F.lit("resolved")).withColumn("export_status", F.lit("eligible")).withColumn("export_reason", F.lit("ok"))
    out = gates.route_safety(own, gates.safety_issues(F.col("s"), F.col("d"), n, n, n, n, F.lit(1))).collect()
    assert [r["referential_status"] for r in out] == ["wrong_scope", "resolved", "resolved"] and out[0]["export_reason"].startswith("semantic safety check: evaluated")


def test_draw_cuts_strata_and_keeps_null_ones(spark):
    df = spark.createDataFrame([(i, "a" if i % 2 else None) for i in range(40)], "id long, s string")
    key = text.hash_key("1", F.col("id"))
    got = [r["id"] for r in sampling.draw(df, ["s"], key, 7).orderBy("position", "order_key").collect()]
    want = [r["id"] for r in sampling.stratified_order(df, ["s"], key).orderBy("position", "order_key").limit(7).collect()]
    assert got == want


def test_quantiles_of_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", 3.0), ("a", None), ("b", None)], "g string, v double")
    got = stats.quantiles(df, "g", "v", {"p50": 0.5, "p75": 0.75}).collect()
    assert [(r["g"], r["n"], r["least"], r["most"], r["p50"], r["p75"]) for r in got] == [("a", 3, 1.0, 3.0, 1.0, 2.0)]


def test_clopper_pearson():
    low, high = stats.clopper_pearson(8, 10)
    assert abs(low - 0.443905) < 1e-5 and abs(high - 0.974789) < 1e-5
    assert stats.clopper_pearson(0, 10)[0] == 0 and stats.clopper_pearson(10, 10)[1] == 1


def test_census_file(spark, tmp_path):
    (tmp_path / "c.csv").write_text("\ufeffpaper_id,year,venue,title,pdf_url\nA 1,2020,v,t,http://x\nA 1,2020,v,t,http://x\na-1,2020,v,t,http://x\n,,,,\nB,soon,v,t,https://y\n", encoding="utf-8")
    rows = census.judge_census(census.read_census(spark, str(tmp_path / "c.csv"))).orderBy("line").collect()
    assert [(r["slug"], r["reason"]) for r in rows] == [("a-1", None), ("a-1", "duplicate_census_paper_id"), ("a-1", "duplicate_derived_paper_id"), ("", "missing_paper_id"), ("b", "unreadable_year")]
    (tmp_path / "d.csv").write_text("paper_id\nx\n")
    with pytest.raises(ValueError):
        census.read_census(spark, str(tmp_path / "d.csv"))


def test_merge_unites_arrays_and_breaks_ties(spark):
    df = spark.createDataFrame([(1, "a", "y", 0.5, ["q", "p"]), (1, "a", "x", 0.9, ["p"]), (2, "a", "w", 0.1, []), (3, None, "z", 0.2, ["r"])], "id long, k string, v string, confidence double, quotes array<string>")
    got = {r["k"]: r for r in dedup.merge_duplicates(df, ["k"], "id", united=("quotes",)).collect()}
    assert (got["a"]["merged"], got["a"]["confidence"], got["a"]["quotes"]) == (3, 0.9, ["p", "q"]) and got[None]["quotes"] == ["r"]
    assert got["a"]["v"] == "x"  # the least of rows that tie


def test_records_by_version(spark):
    rows = [(1, "p", "BERT", "v1", "d", "m", 1.0, "1", None, 1, "unchecked"), (2, "p", "BERT", None, "d", "m", 0.5, ".5", None, 1, "no_external_cue"), (3, "p", "BERT", "v1", "c", "m", 2.0, "2", None, 1, "human_confirmed")]
    df = spark.createDataFrame(rows, "observation_id long, paper_id string, system string, ver string, dataset string, metric_id string, value double, raw string, unit string, page int, origin_basis string")
    got = {r["version"]: r for r in compose.compose_records(df, "ver").collect()}
    assert [x["observation_id"] for x in got["v1"]["results"]] == [3, 1] and got["v1"]["origin_basis"] == "unchecked"
    assert got["v1"]["record_key"].startswith(got[None]["record_key"] + "-version-v1-")


def test_admission_on_a_stream(spark, tmp_path):
    events = [[("u", 1, 5), ("u", 2, 6), ("v", 3, 11)], [("u", 4, 5), ("v", 5, None), ("v", 6, 10)]]
    for i, rows in enumerate(events):
        spark.createDataFrame(rows, "ledger string, event_id long, cost long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("ledger string, event_id long, cost long").parquet(str(tmp_path / "in"))
        query = admit_stream(stream, 10).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out"))
        query.awaitTermination(120)
    got = {r["event_id"]: (r["committed"], r["admitted"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: (5, True), 2: (5, False), 3: (0, False), 4: (10, True), 5: (0, False), 6: (10, True)}
