"""The pipeline against the operators' own brute-force versions, on the smallest tables."""

import random
import re

import corpus_pipeline
from tessera.llm import decontaminate, pieces, similar
from tessera.llm.common import Scratch

DIR = "/root/testdata/sf0.001"


def shingles(text):
    tokens = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {" ".join(tokens[i : i + 5]) for i in range(max(1, len(tokens) - 4))} if tokens else set()


def smallest_of_groups(texts):
    """The smallest id of every component of the pairs with a similarity of 0.8 or more, by all pairs."""
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i for i in sets if find(i) == i}


def test_near_copies(spark):
    rnd = random.Random(5)
    draw = lambda n: [f"w{rnd.randrange(3000)}" for _ in range(n)]
    shared, rows = draw(60), []
    for g in range(12):
        base = draw(rnd.choice((4, 12, 80, 400)))
        for c in range(rnd.choice((1, 3, 9))):
            text = list(base)
            for _ in range(c * len(base) // 120):  # a chain of edits: the ends of a group may be far apart
                text[rnd.randrange(len(text))] = f"e{rnd.random()}"
            base = text if c % 2 else base
            rows.append(" ".join(text))
    rows += [" ".join(shared + draw(40)) for _ in range(20)] + [None, "", " \n", "One two", "one  TWO", "one two three"]
    rnd.shuffle(rows)
    texts = dict(enumerate(rows))
    data = [(i, t, "a", 1) for i, t in texts.items()] + [(None, "null id", "b", 2), (None, "null id", "b", 2), (0, texts[0], "a", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, id string, root int")
    kept = [r["doc_id"] for r in similar.one_of_each(docs).collect()]
    assert len(kept) == len(set(kept)) and set(kept) - {None} == smallest_of_groups(texts)
    assert None in kept
    assert similar.one_of_each(docs.limit(0)).count() == 0


def test_blocks_and_forest(spark):
    sets = [similar.shingle_set(" ".join(f"w{k}" for k in range(s, s + 60))) for s in (0, 3, 6, 9, 12, 500, 503, 900)]
    sets += [similar.shingle_set("")] * 2
    root = list(range(len(sets)))
    for x, y in similar.forest(sets):
        root = [root[x] if r == root[y] else r for r in root]
    assert len({root[k] for k in range(5)}) == 1 and root[5] == root[6] and root[8] == root[9] and len(set(root)) == 4
    docs = spark.createDataFrame([(k, " ".join(f"w{j}" for j in range(k, k + 90))) for k in range(0, 120, 4)], "id long, text string")
    for block in (300, 10**6):
        gone = similar.copies(docs, Scratch(spark), block=block)
        assert {r["id"] for r in gone.collect()} == set(range(4, 120, 4))


def test_stages(spark):
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.keep(stage(spark, docs, DIR), "stage")
        rows = docs.collect()
        if name != "encoding":
            assert docs.columns == corpus_pipeline.COLUMNS
            after = {r["doc_id"]: r["text"] for r in rows}
            assert set(after) <= set(before) and after
        if name == "near-dedup":
            assert set(after) == smallest_of_groups(before)
        if name == "decontamination":
            bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
            index = decontaminate.Items(bench)
            assert set(after) == {i for i, t in before.items() if not index.matches(t)}
        if name == "encoding":
            own = pieces.Pieces(open(pieces.MODEL, "rb").read())
            assert all(r["round_trip"] and own.decode(r["ids"]) == before[r["doc_id"]] for r in rows)
        else:
            before = after
