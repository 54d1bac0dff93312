"""Small cases of every corpus operator: nulls, empty and repeated rows, extra columns, empty tables, brute force."""

import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import ann, decontaminate, dom, extract, linededup, lm, lookup, pieces, quality, simhash, toxicity, triefile, urlfilter
from tessera.llm.common import Scratch, words

DOCS = "doc_id long, text string, lang string, u string, fp long, a long"
SPEECH = "the quick brown fox jumps over the lazy dog near the old river bank while seven wise owls watch from above"


def docs(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "en", "u", 7, 8) for i, t in enumerate(texts)], DOCS)


def test_words_split_and_lower_ascii_only():
    assert words("A\tÉb C\x0bD") == ["a".encode(), "Éb c".encode(), b"d"]
    assert words(None) == words("") == words(" \n") == []


def test_simhash_against_brute_force(spark):
    base = SPEECH.split() * 8
    texts = [" ".join(base)] * 3 + [" ".join([*base[:k], "x", *base[k:]]) for k in range(0, 60, 7)] + ["", None, "one", "one", "other words here"]
    got = simhash.near_duplicates(docs(spark, texts)).collect()
    fp = {i: simhash.fingerprint(t) & (2**64 - 1) for i, t in enumerate(texts)}
    root = {i: i for i in fp}
    for _ in fp:
        for i in fp:
            for j in fp:
                if (fp[i] ^ fp[j]).bit_count() <= 3:
                    root[i] = root[j] = min(root[i], root[j])
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {i: (f"{fp[i]:016x}", root[i]) for i in fp}
    assert simhash.near_duplicates(docs(spark, texts).limit(0)).count() == 0


def test_every_link_meets_in_a_key_and_chain():
    rng = np.random.default_rng(1)
    for _ in range(300):
        x = 0
        for b in rng.choice(64, rng.integers(0, 4), replace=False):
            x |= 1 << int(b)
        assert any(simhash.chained(np.array([x], np.uint64), s)[0] for s in range(8))


def test_blocks_of_a_hot_key_lose_no_link(spark):
    fps = [k for k in range(64)]  # within 6 bits of each other, linked by single bits
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    found = simhash.links(df, block=8).collect()
    assert len(found) < 24 * 64 * 9
    root = {f: f for f in fps}
    for _ in fps:
        for u, v in found:
            assert (u ^ v).bit_count() <= 3
            root[u] = root[v] = min(root[u], root[v])
    assert set(root.values()) == {0}


def test_line_dedup(spark):
    long = "This is a shared line of over forty code points."
    texts = [f"{long}\nown {i}" for i in range(5)] + [f"  {long.upper()} \n{long}\n", "", None]
    rows = {r["doc_id"]: r for r in linededup.dedup_lines(docs(spark, texts)).collect()}
    assert [rows[i]["kept"] for i in range(5)] == [f"own {i}" for i in range(5)]
    assert rows[5]["kept"] == texts[5] and rows[5]["n_lines"] == 3
    assert rows[6]["kept"] == rows[7]["kept"] == "" and rows[7]["n_lines"] == 1
    assert linededup.dedup_lines(docs(spark, texts[:4])).agg(F.sum("n_dropped")).first()[0] == 0
    assert linededup.dedup_lines(docs(spark, texts).limit(0)).count() == 0


def test_url_rules(spark):
    urls = ["http://A.Example.ORG/es/x?y", "no", None, "https://x.com/de", "http://x.com/de/#f", "http://example.org/en/12", "http://org", "http://q.org/"]
    pages = spark.createDataFrame([(i, u, None, "rule") for i, u in enumerate(urls)], "page_id long, url string, html string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in urlfilter.filter_urls(pages).collect()}
    assert got[0] == ("a.example.org", "/es/x", "example.org/es/")
    assert got[1] == got[2] == ("", "", None)
    assert got[3] == ("x.com", "/de", None) and got[4] == ("x.com", "/de/", "com/de/")
    assert got[5][2] == "example.org/en/1" and got[6] == ("org", "", None) and got[7][2] == "org/"


def test_link_propagation_against_brute_force(spark):
    edges = [("a", "b", 2), ("a", "c", 1), ("b", "c", 1), ("d", "c", 3), ("c", "a", 1)]
    seeds = [("a", 1.0, 0.0), ("c", 0.0, 2.0), ("e", 1.0, 0.0)]
    got = urlfilter.propagate(spark.createDataFrame(seeds, "host string, t double, d double"), spark.createDataFrame(edges, "src string, dst string, n long"), Scratch(spark))
    got = {r["host"]: (r["trust"], r["distrust"]) for r in got.collect()}
    t, s = {"a": 0.5, "e": 0.5}, {"c": 1.0}
    out, back = Counter(), Counter()
    for u, v, n in edges:
        out[u] += n
        back[v] += n
    x, y = ({h: 0.15 * b.get(h, 0) for h in "abcde"} for b in (t, s))
    for _ in range(200):
        nx, ny = {h: 0.15 * t.get(h, 0) for h in x}, {h: 0.15 * s.get(h, 0) for h in y}
        for u, v, n in edges:
            nx[v] += 0.85 * x[u] * n / out[u]
            ny[u] += 0.85 * y[v] * n / back[v]
        x, y = nx, ny
    assert all(abs(got[h][0] - x[h]) < 1e-2 and abs(got[h][1] - y[h]) < 1e-2 for h in x)


def test_html(spark):
    page = "<body><nav>menu</nav><div class='cookie-banner'>we use</div><article><h1>T &amp; x</h1><p>one<br>two <b>bold</b>\n <p>three<aside>no</aside><form>f</form></article><section class='comments'><p>hey</p></section><footer>f</footer><script>var a='<p>';</script>"
    want = "T & x\n\none two bold\n\nthree"
    rows = [(1, "http://a.org/1", page), (2, "http://a.org/2", page.replace("three", "four")), (3, None, None), (4, "http://b.org", ""), (5, "http://b.org/x", "<p>" * 50 + "deep" + "<div" )]
    got = {r["page_id"]: r for r in extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1]["text"] == want and got[2]["text"] == want.replace("three", "four") and got[1]["n_chars"] == len(want)
    assert got[3]["text"] == got[4]["text"] == "" and "deep" in got[5]["text"]


def test_tree_matching_keeps_order():
    a, b = (dom.parse(h) for h in ("<div><p>1</p><ul></ul><h2>x</h2></div>", "<div><h2>x</h2><p>1</p><ul></ul></div>"))
    assert dom.match(a, b)[0] == 4  # root, div, p, ul


def test_html_without_marks_uses_what_varies(spark):
    page = "<div id=top>Same words everywhere on this site</div><div id=x><p>{}</p><p>more {}</p></div><div id=end>The same closing words</div>"
    rows = [(i, f"http://a.org/{i}", page.format(f"text number {i} " * 5, i)) for i in range(5)]
    got = extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all("Same words" not in r["text"] and f"more {r['page_id']}" in r["text"] for r in got)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_learn_and_bear_odd_rows(spark, module):
    label = "quality" if module is quality else "toxic"
    good, bad = "A plain sentence of calm words here.", "YOU IDIOT!! STUPID IDIOT!! LOSER!!"
    texts = [f"{(good, bad)[i % 2]} {i}" for i in range(120)] + ["", None, " \n", good, good]
    labels = spark.createDataFrame([(i, int((i % 2 == 0) == (module is quality)), 9) for i in range(120)] + [(None, 1, 9), (5000, None, 9)], f"doc_id long, {label} int, text int")
    rows = module.classify(docs(spark, texts), labels).collect()
    assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] < 120]
    assert held and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert np.mean([(r["score"] >= 0.5) == ((r["doc_id"] % 2 == 0) == (module is quality)) for r in held]) > 0.9
    assert len({r["score"] for r in rows if r["text"] == good}) == 1
    assert module.classify(docs(spark, texts).limit(0), labels).count() == 0
    assert len({r["score"] for r in module.classify(docs(spark, texts[:3]), labels.limit(0)).collect()}) == 1


def test_quality_features_stay_out_of_the_driver(spark):
    """The driver's share does not grow with the sample, and the model is that of a fit on the same rows here."""
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice(["Calm", "words"] if i % 2 else ["LOUD!!", "x9"], 4)) + " " + " ".join(f"w{k}" for k in rng.integers(0, 10**6, 300)) for i in range(1500)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1500)], "doc_id long, quality int")
    table = docs(spark, texts)
    tracemalloc.start()
    try:
        model = quality.train(table, labels)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 20e6, f"{peak / 1e6:.0f} MB"
    found = [(quality.features(texts[i]).astype(np.int32), float(i % 2)) for i in range(1500) if zlib.crc32(str(i).encode()) % 5]
    found.sort(key=lambda r: (len(r[0]), r[0].tobytes()))
    own = quality.Model([r for r, _ in found], np.array([t for _, t in found]))
    assert np.array_equal(model.w, own.w) and (model.bias, model.slope, model.offset) == (own.bias, own.slope, own.offset)


def test_pieces_equal_the_library(spark):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = ["", "  a  b", "\n\nfoo\t bar 日本語 😀😀 xyz", "the" * 200, "a" * 300, "<s> <0x0A>", " ", SPEECH, "Ünïcode été\r\n"]
    rows = {r["doc_id"]: r for r in pieces.encode_texts(docs(spark, [*texts, None])).collect()}
    for i, t in enumerate(texts):
        assert rows[i]["ids"] == lib.encode(t) and rows[i]["round_trip"]
    assert rows[len(texts)]["ids"] == []


def test_decontamination(spark):
    item = " ".join(f"word{i}" for i in range(30))
    near = item.replace("word29", "other")
    texts = [f"before {item.upper()} after", f"x {near}", SPEECH, "", None, " ".join(item.split()[:15]), item]
    bench = spark.createDataFrame([(1, item, "x"), (2, None, "x"), (3, "", "x"), (4, "tiny item", "x")], "item_id long, text string, lang string")
    got = {(r["doc_id"], r["item_id"]): round(r["similarity"], 3) for r in decontaminate.contamination(docs(spark, texts), bench).collect()}
    assert got == {(0, 1): 1.0, (1, 1): round(25 / 27, 3), (6, 1): 1.0}
    assert {r["doc_id"] for r in decontaminate.decontaminate(docs(spark, texts), bench).collect()} == {2, 3, 4, 5}
    assert decontaminate.contamination(docs(spark, texts), bench.limit(0)).count() == 0


def test_decontamination_against_brute_force():
    """Every window of every text against every item: all pairs at 0.8 or more are found, and no other."""
    rng = np.random.default_rng(4)
    vocabulary = [f"w{k}" for k in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary, int(rng.choice([3, 16, 30, 45, 59]))))) for i in range(40)]
    texts = []
    for i in range(500):
        own = items[int(rng.integers(0, 40))][1].split()
        for _ in range(int(rng.integers(0, 3))):
            k = int(rng.integers(0, len(own)))
            own[k : k + 1] = [[], ["x"], [own[k], "y"]][int(rng.integers(0, 3))]
        texts.append(" ".join([*rng.choice(vocabulary, int(rng.integers(0, 30))), *own, *rng.choice(vocabulary, int(rng.integers(0, 30)))]))
    texts += [items[9][1] * 3, "", None, " ".join(items[11][1].split()[:-1])]
    index = decontaminate.Items(items)
    grams = lambda w, n: Counter(tuple(w[k : k + n]) for k in range(max(len(w) - n + 1, 1)))
    got, want, close = set(), set(), 0
    for i, t in enumerate(texts):
        got |= {(i, m[0], round(m[3], 9)) for m in index.matches(t)}
        own = words(t)
        for j, item in items:
            w = words(item)
            width, best = min(5, len(w)), 0.0
            bag = grams(w, width)
            for k in range(max(len(own) - len(w) + 1, 1) if own else 0):
                other = grams(own[k : k + len(w)], width)
                both = sum((bag & other).values())
                best = max(best, both / (bag.total() + other.total() - both))
            if best >= 0.8:
                want.add((i, j, round(best, 9)))
                close += best < 0.9
    assert close > 30 and got == want


def test_decontamination_of_odd_rows(spark):
    bench = spark.createDataFrame([(1, SPEECH), (1, SPEECH), (None, SPEECH + " and more of it")], "item_id long, text string")
    rows = [(None, SPEECH, 1), (None, SPEECH, 1), (5, f"{SPEECH} " * 20_000, 1), (6, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, item_id long")
    got = sorted((r["doc_id"] or 0, r["item_id"] or 0) for r in decontaminate.contamination(df, bench).collect())
    assert got == [(0, 0)] * 2 + [(0, 1)] * 4 + [(5, 1)] * 2  # 16 of the longer item's 20 shingles: 0.8
    assert [r["doc_id"] for r in decontaminate.decontaminate(df, bench).collect()] == [6]
    assert decontaminate.contamination(df.limit(0), bench).count() == 0 and decontaminate.decontaminate(df, bench.limit(0)).count() == 4


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(v) for v in rng.standard_normal(16)], "x") for i in range(400)]
    rows += [(i, [1.0] * 16, "x") for i in range(400, 440)] + [(900, None, "x"), (920, [0.0] * 16, "x"), (940, [float("nan")] * 16, "x"), (960, [None] * 16, "x"), (980, [], "x"), (1000, [1.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")
    got = ann.search(df, F.col("vec_id") % 20 == 0).collect()
    x = {i: np.float32(v).astype(float) for i, v, _ in rows[:440]}
    hits = total = 0
    for q in [i for i in x if i % 20 == 0]:
        want = sorted((i for i in x if i != q), key=lambda i: (-(x[i] @ x[q]), i))[:20]
        own = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21)) and all(abs(r["score"] - x[r["vec_id"]] @ x[q]) < 1e-9 for r in own)
        hits, total = hits + len({r["vec_id"] for r in own} & set(want)), total + 20
    assert hits / total >= 0.9 and {r["query_id"] for r in got} == {i for i in x if i % 20 == 0}
    assert ann.search(df.filter("vec_id < 5"), F.col("vec_id") == 0).count() == 4
    assert ann.search(df.limit(0), F.lit(True)).count() == 0


def test_elias_fano():
    values = np.cumsum(np.random.default_rng(0).integers(0, 50, 2000))
    for values in (values, values << 40, np.array([0, 0, 0, 5]), np.array([1 << 62])):
        seq = triefile.EliasFano.build(values)
        assert (seq[np.arange(len(values))] == values).all()
        ask = np.unique(np.concatenate((values, values + 1, [0, 1, 3, 1 << 62])))
        found = seq.find(ask)
        assert all((f >= 0) == (v in set(values.tolist())) and (f < 0 or values[f] == v) for f, v in zip(found.tolist(), ask.tolist(), strict=True))
    assert triefile.EliasFano.build(np.empty(0)).find(np.array([3]))[0] == -1


def test_word_hashes_split_as_words_do():
    rng = np.random.default_rng(0)
    texts = ["", None, " \n", "A\tÉb C\x0bD", "x" * 5, "X" * 5, "y " * 3] + ["".join(rng.choice(list("abAB \n\té"), 200)) for _ in range(50)] + ["ab" * 800_000 + " tail"]
    hashes, sizes = lookup.word_hashes(pa.array(texts), [])
    listed = [w for t in texts for w in words(t)]
    assert sizes.tolist() == [len(words(t)) for t in texts] and len(hashes) == len(listed)
    assert len(set(hashes.tolist())) == len(set(listed)) == len(set(zip(hashes.tolist(), listed, strict=True)))


def test_trie_from_a_mapped_file(tmp_path):
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 62, 500))
    owner, kids = rng.integers(0, len(keys), 900), triefile.short_key(rng.integers(0, 1 << 62, 900))
    first, second = rng.normal(size=len(keys)), rng.normal(size=900)
    (tmp_path / "t").write_bytes(triefile.Trie.build(keys, first, owner, kids, second).dump())
    trie = triefile.Trie.open(str(tmp_path / "t"))
    assert np.abs(trie.values(keys, np.zeros(len(keys), np.int64)) - first).max() < 1e-3
    assert np.abs(trie.values(keys[owner], kids) - first[owner] - second).max() < 1e-3
    other = np.roll(keys[owner], 1)
    assert np.abs(trie.values(other, kids) - first[np.roll(owner, 1)])[np.roll(owner, 1) != owner].max() < 1e-3
    empty = triefile.Trie.load(triefile.Trie.build(keys[:0], first[:0], owner[:0], kids[:0], second[:0]).dump())
    assert (empty.values(keys, kids[: len(keys)]) == 0).all()


_END = b"\n"  # no word holds a line's end


class _Brute:
    """The model of lm in plain Python: words as tuples, no hashes, no quantising."""

    def __init__(self, texts):
        seqs = [[_END, *words(t), _END] for t in texts]
        self.one = Counter(w for s in seqs for w in s[1:])
        self.two, self.three = (Counter(tuple(s[i : i + k]) for s in seqs for i in range(len(s) - k + 1)) for k in (2, 3))
        self.n, self.v = sum(self.one.values()), len(self.one)
        self.left = {1: Counter(), 2: Counter()}
        for k, grams in ((1, self.two), (2, self.three)):
            for g, n in grams.items():
                self.left[k][g[:-1]] += n - 0.5 if n >= 2 else 0

    def p(self, context, w):
        if not context:
            return (self.one[w] + 1) / (self.n + self.v + 1)
        grams, below = (self.two, self.one) if len(context) == 1 else (self.three, self.two)
        total = below[context[0]] if len(context) == 1 else below[context]
        if len(context) == 2 and total < 2 or not total:
            return self.p(context[1:], w)
        n = grams[(*context, w)]
        return (n - 0.5 if n >= 2 else 0) / total + (1 - self.left[len(context)][context] / total) * self.p(context[1:], w)

    def score(self, text):
        s = [_END, *words(text), _END]
        return sum(math.log10(self.p(tuple(s[max(0, i - 2) : i]), s[i])) for i in range(1, len(s)))


def test_lm_against_brute_force(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(list("abcdefghij"), rng.integers(0, 40))) for _ in range(60)]
    texts += ["a rare known context"] * 3 + ["", None, "zz unseen", "a b a b c", "A B\ta b"] + ["x y z"] * 40
    df = docs(spark, texts).unionByName(docs(spark, texts[:3]))  # rows that repeat
    train = [t for i, t in [*enumerate(texts), *enumerate(texts[:3])] if zlib.crc32(str(i).encode()) % 7 != 2]
    brute = _Brute(train)
    for rare in (1e-6, 0.01, 0.9):  # all n-grams broadcast, some, none
        rows = lm.lm_scores(df, rare=rare).collect()
        assert len(rows) == len(texts) + 3
        for r in rows:
            t = texts[r["doc_id"]]
            own = [*words(t), _END]
            assert r["n_tokens"] == len(own) and r["train_tokens"] == brute.n and r["n_known"] == sum(brute.one[w] > 0 for w in own)
            assert abs(r["base_score"] - sum(math.log10(brute.p((), w)) for w in own)) < 1e-9
            assert abs(r["score"] - brute.score(t)) < 1e-3 * len(own), (rare, t)
    total = [sum(brute.p(c, w) for w in brute.one) + brute.p(c, b"?") for c in ((b"a",), (b"a", b"b"), (_END, b"x"))]
    assert all(abs(t - 1) < 1e-9 for t in total)  # what the words sum to, with the unseen word's share
    assert lm.lm_scores(df.limit(0)).count() == 0
    assert lm.lm_scores(docs(spark, texts[:4]).withColumn("doc_id", F.lit(None).cast("long"))).count() == 4


def test_neighbours_that_are_abandoned_together_are_scanned_again(spark, monkeypatch):
    rng = np.random.default_rng(1)
    one = rng.standard_normal(16)
    rows = [(i, [float(v) for v in (one if i % 3 == 0 else rng.standard_normal(16))]) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    # A test that abandons nearly all candidates stands for copies whose partial sums exceed it together.
    limit = ann.Index.limit
    monkeypatch.setattr(ann.Index, "limit", lambda self, bound, done: np.where(np.isinf(bound), bound, limit(self, bound, done) * 0.01))
    got = ann.search(df, F.col("vec_id") % 20 == 0, probed=1000).collect()
    x = {i: np.float32(v).astype(float) for i, v in rows}
    for q in (i for i in x if i % 20 == 0):
        want = sorted((i for i in x if i != q), key=lambda i: (-(x[i] @ x[q]), i))[:20]
        own = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert len(own) == 20 and all(abs(r["score"] - x[w] @ x[q]) < 1e-6 for r, w in zip(own, want, strict=True))


def test_html_keeps_sisters_and_every_article(spark):
    long, short = "long varying text number {0} " * 8, "short varying text {0}"
    pages = [f"<div><div class=a><h1>Head {{0}}</h1></div><div class=b><p>{long}</p></div><div class=c><p>{short}</p></div></div>", f"<article><p>{long}</p></article><article><p>{short}</p></article>"]
    rows = [(10 * h + i, f"http://{h}.org/{i}", page.format(i)) for h, page in enumerate(pages) for i in range(4)]
    got = {r["page_id"]: r["text"] for r in extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(4):
        text = (long * 1).format(i).strip()
        assert got[i] == f"Head {i}\n\n{text}\n\n{short.format(i)}"
        assert got[10 + i] == f"{text}\n\n{short.format(i)}"


def test_html_drops_what_a_host_repeats_inside_articles(spark):
    page = "<article><h1>Head {0}</h1><div class=xyz>Buy our book today</div><p>text {0}</p></article>"
    rows = [(i, f"http://a.org/{i}", page.format(i)) for i in range(4)] + [(10 + i, f"http://b.org/{i}", page.format(0)) for i in range(4)]
    got = {r["page_id"]: r["text"] for r in extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Head {i}\n\ntext {i}" for i in range(4))
    assert all(got[10 + i] == "Head 0\n\nBuy our book today\n\ntext 0" for i in range(4))  # copies of one page show no template


def test_propagation_goes_on_while_it_reaches_hosts_and_says_when_unsettled(spark, monkeypatch):
    seeds = spark.createDataFrame([("h5", 0.0, 1.0)], "host string, t double, d double")
    edges = spark.createDataFrame([(f"h{i}", f"h{i + 1}", 1) for i in range(5)], "src string, dst string, n long")
    with pytest.raises(RuntimeError):
        urlfilter.propagate(seeds, edges, Scratch(spark), rounds=1)
    monkeypatch.setattr(urlfilter, "SETTLED", 1e9)  # settled at once, but for hosts not yet reached
    got = {r["host"]: r["distrust"] for r in urlfilter.propagate(seeds, edges, Scratch(spark)).collect()}
    assert got["h0"] > 0


def test_deep_and_wide_pages(spark):
    deep = "<article><header>" + "<div>" * 3000 + "<h1>Head {0}</h1>" + "</div>" * 3000 + "</header><p>text {0}</p></article>"
    wide = "<div id=list>" + "".join(f"<div class=c{k % 7}>entry {k} {{0}}</div>" for k in range(20_000)) + "</div><div id=end>the same</div>"
    flat = "<div>" + "<div class=row>row {0}</div>" * 20_000 + "</div>"
    rows = [(10 * h + i, f"http://{h}.org/{i}", page.format(i)) for h, page in enumerate((deep, wide, flat)) for i in range(3)]
    got = {r["page_id"]: r["text"] for r in extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(3):
        assert got[i] == f"Head {i}\n\ntext {i}"
        assert got[10 + i].count("entry") == 20_000 and "the same" not in got[10 + i]
        assert got[20 + i] == "\n\n".join([f"row {i}"] * 20_000)
    empty = spark.createDataFrame([], "page_id long, url string, html string, host string")
    assert extract.extract_pages(empty).count() == 0
    twice = spark.createDataFrame([(1, "http://a.org", "<p>x</p>", "h", 1)] * 2, "page_id long, url string, html string, host string, slot int")
    assert [r["text"] for r in extract.extract_pages(twice).collect()] == ["x", "x"]


def brute_match(a, b):
    """The largest match by trying all alignments of children."""
    x, y = dom.shape(a), dom.shape(b)

    def best(i, j):
        if i == len(x) or j == len(y):
            return 0
        most = max(best(i + 1, j), best(i, j + 1))
        if x[i][0].label == y[j][0].label:
            own = brute_match(x[i][0], y[j][0]) if len(x[i]) == len(y[j]) == 1 else 1
            most = max(most, own + best(i + 1, j + 1))
        return most

    return 1 + best(0, 0)


def test_tree_matching_against_brute_force():
    rng = np.random.default_rng(5)

    def tree(depth):
        tags = rng.choice(["div", "p", "ul", "section"], rng.integers(0, 4))
        return "".join(f"<{t}>{tree(depth - 1) if depth and t in ('div', 'section') else 'x'}</{t}>" for t in tags)

    for _ in range(60):
        a, b = dom.parse(tree(3)), dom.parse(tree(3))
        assert dom.match(a, b)[0] == brute_match(a, b)


def test_line_runs_hold_each_key_once_and_leave_nothing(spark):
    scratch = Scratch(spark)
    runs, want = linededup.LineRuns(scratch), {}
    rng = np.random.default_rng(2)
    for batch in range(5):
        rows = sorted({(int(k), 0, int(d)) for k, d in zip(rng.integers(0, 30, 60), rng.integers(0, 9, 60) + 10 * batch, strict=True)})
        runs.add(spark.createDataFrame(rows, "a long, b long, doc_id long"))
        for a, _, d in rows:
            n, top = want.get(a, (0, -1))
            want[a] = (n + 1, max(top, d))
        held = [r["a"] for run in runs.runs() for r in run.collect()]
        assert sorted(held) == sorted(want)
    assert {r["a"]: (r["n"], r["top"]) for r in runs.totals(3).collect()} == {k: v for k, v in want.items() if v[0] >= 3}
    runs.close()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_line_dedup_of_rows_that_share_or_lack_ids(spark):
    long = "a line that is surely longer than forty code points, shared"
    rows = [(None, long), (None, long), (1, long), (1, long), (2, long), (3, "x")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n long, top long")
    got = sorted(((r["doc_id"] or 0, r["kept"], r["n"], r["top"]) for r in linededup.dedup_lines(df).collect()))
    assert got == [(0, long, 1, 2), (0, long, 1, 2), (1, "", 1, 2), (1, "", 1, 2), (2, long, 1, 2), (3, "x", 1, 2)]


def test_probing_a_part_of_the_lists_keeps_the_recall(spark):
    """Many lists of which a part is probed, with structure and without."""
    for rows, groups in ((4000, 0), (12_000, 40)):
        rng = np.random.default_rng(rows)
        x = rng.standard_normal((rows, 16)) + (4 * rng.standard_normal((groups, 16))[rng.integers(0, groups, rows)] if groups else 0)
        x = x.astype(np.float32).astype(float)
        index = ann.Index(np.arange(rows)[:2000], x[:2000], float(np.sqrt((x * x).sum(1).max())), 40_000 if groups else 10_000_000, 20)
        assert len(index.centres) > (20 if groups else 300) and index.many < len(index.centres)
        lists = index.nearest(index.turn(x))
        index.sizes = np.bincount(lists, minlength=len(index.centres))
        asks = np.arange(0, rows, 50)
        product = x[asks] @ x.T
        product[np.arange(len(asks)), asks] = -np.inf
        best = np.argsort(-product, axis=1)[:, :20]
        held = [np.isin(lists[b], p).mean() for b, p in zip(best, index.probes(x[asks], None), strict=True)]
        assert np.mean(held) >= 0.94


def test_wide_pages_align_as_narrow_ones_do(spark):
    """Largest matches and results must not change where a page has many children, or one of a list's many containers repeats."""
    rng = np.random.default_rng(9)
    inner = ["", "<p>x</p>", "<ul></ul><p>x</p>", "<h2>x</h2><div><p>x</p></div>"]
    for n in (20, 90):
        a, b = (dom.parse("".join(f"<div class={rng.choice(list('abc'))}>{rng.choice(inner)}</div>" for _ in range(n))) for _ in range(2))
        x, y = dom.shape(a), dom.shape(b)
        table = np.zeros((n + 1, n + 1), int)
        for i in range(n):
            for j in range(n):
                own = brute_match(x[i][0], y[j][0]) if x[i][0].label == y[j][0].label else 0
                table[i + 1, j + 1] = max(table[i, j + 1], table[i + 1, j], table[i, j] + own)
        size, pairs = dom.match(a, b)
        assert size == len(pairs) == 1 + table[n, n]
    rows, want = [], {}
    for h, n in enumerate((20, 100)):
        for i in range(6):
            parts = [f"<h2>head {k} of {i}</h2><p>text {k} of {i}</p>" for k in range(n)]
            want[10 * h + i] = "\n\n".join(f"head {k} of {i}\n\ntext {k} of {i}" for k in range(n))
            parts.insert(3, "<div class=xyz>Buy our book today</div>")
            parts.insert(0 if i % 2 else 16, "<table></table>")
            rows.append((10 * h + i, f"http://{h}.org/{i}", f"<article>{''.join(parts)}</article>"))
    for i in range(4):
        own = [f"<div>entry {k} of {i}</div>" for k in range(60)]
        want[20 + i] = "\n\n".join(f"entry {k} of {i}" for k in range(60))
        rows.append((20 + i, f"http://list.org/{i}", f"<article>{''.join([*own[:30], '<div>Buy our book today</div>', *own[30:]])}</article>"))
    deep = "<div>" * 400 + "<h2>head {0}</h2><table><tr><td>Buy our book today</table><p>text {0}</p>" + "</div>" * 400
    for i in range(4):
        want[30 + i] = f"head {i}\n\ntext {i}"
        rows.append((30 + i, f"http://deep.org/{i}", f"<article>{deep.format(i)}</article>"))
    got = {r["page_id"]: r["text"] for r in extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


def test_a_block_is_scanned_for_all_its_queries_at_once(monkeypatch):
    """The same results as brute force, copies, ties and unbounded queries included; work in Python does not grow with the queries."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((600, 33)).astype(np.float32).astype(float)
    x[200:300] = x[7]
    ids = rng.permutation(600)
    index = ann.Index(ids[:300], x[:300], float(np.sqrt((x * x).sum(1).max())), 600, 20)
    calls, limit = [], ann.Index.limit
    monkeypatch.setattr(ann.Index, "limit", lambda self, bound, done: calls.append(done) or limit(self, bound, done))
    monkeypatch.setattr(ann, "PAIRS", 1000, raising=False)
    asks, q = ids[150:350], x[150:350]
    product = q @ x.T
    product[ids[None, :] == asks[:, None]] = -np.inf
    want = [[int(i) for i in np.lexsort((ids, -np.round(p, 9)))[:20]] for p in product]
    kth = np.array([p[w[-1]] for p, w in zip(product, want, strict=True)])
    near = (q * q).sum(1) + index.top**2 - 2 * kth + 1e-6
    for bounds in (np.full(200, np.inf), near * 2, near):
        calls.clear()
        found = list(index.scan(ids, x, index.turn(x), asks, q, index.turn(q, query=True), bounds))
        assert len(calls) <= 2 * len(index.blocks)  # two groups of queries
        got = [[] for _ in asks]
        for at, left, scores in found:
            for i, j, s in zip(at, left, scores, strict=True):
                got[i].append(int(j))
                assert abs(s - product[i, j]) < 1e-9
        hits = sum(len(set(g) & set(w)) for g, w in zip(got, want, strict=True))
        assert hits >= 0.95 * 4000 if bounds is near else got == want
    assert not [r for at, _, _ in index.scan(ids[:1], x[:1], index.turn(x[:1]), ids[:1], x[:1], index.turn(x[:1], query=True), np.full(1, np.inf)) for r in at]
