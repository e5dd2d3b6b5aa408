import random

from tidemark.llm import decontaminate as d


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


def test_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(200):
        a = [rng.randrange(6) for _ in range(rng.randrange(1, 90))]
        b = [rng.randrange(6) for _ in range(rng.randrange(0, 120))]
        assert d.common_subsequence(a, b) == brute_lcs(a, b)


def test_planted_passages_paraphrases_and_odd_rows(spark, documents):
    rng = random.Random(9)
    common = ["the", "of", "and", "to", "in"]

    def prose(n, seed):
        r = random.Random(seed)
        return [r.choice(common) if r.random() < 0.5 else f"w{r.randrange(400)}" for _ in range(n)]

    items = {i: prose(40, 1000 + i)[:30] + [f"key{i}", f"answer{i}"] for i in range(20)}
    items[50] = prose(150, 5000)
    rows, want = [], {}
    for i in range(300):
        text = prose(rng.randrange(20, 300), i)
        if i % 10 == 0:
            item = rng.choice(list(items))
            at = rng.randrange(len(text))
            text[at:at] = [w.upper() + "," for w in items[item]]
            want[i] = [item]
        rows.append((i, " ".join(text), "en"))
    weak = items[3][:]
    for k in range(1, 26, 3):
        weak[k] = f"changed{k}"
    half = items[4][:12] + prose(20, 77)
    long = prose(20_000, 88)
    long[15_000:15_000] = items[7]
    rows += [(400, " ".join(weak), "en"), (401, " ".join(half), "en"), (402, " ".join(long), "en"), (403, None, "en"), (404, "", None),
             (None, " ".join(items[1]), "en"), (405, " ".join(items[2]), "en"), (405, " ".join(items[2]), "en"), (2**60 + 1, " ".join(items[5]), "en")]
    want |= {400: [3], 402: [7], 405: [2], 2**60 + 1: [5]}
    table = documents(rows)
    benchmark = spark.createDataFrame(
        [(i, " ".join(w), None) for i, w in items.items()] + [(60, None, None), (61, "", ""), (62, "...", None), (None, "x y", None)],
        "item_id bigint, text string, answer string",
    )
    got = d.judge(table, benchmark).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["item_ids"] == want.get(r["doc_id"], []), r
        assert r["contaminated"] == (r["doc_id"] in want)
    kept = d.keep_clean(table, benchmark)
    assert kept.columns == table.columns and kept.count() == len(rows) - len(want) - 1
    assert d.judge(table.limit(0), benchmark).count() == 0
    assert not any(r["contaminated"] for r in d.judge(table, benchmark.limit(0)).collect())


def test_several_blocks_find_the_same(spark, documents, monkeypatch):
    items = [(i, " ".join(f"item{i}word{k}" for k in range(20))) for i in range(9)]
    rows = [(i, "some words " + items[i][1] + " and others", "en") for i in range(9)] + [(20, "some words and others", "en")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(d, "BLOCK_PASSAGES", 4)
    got = {r["doc_id"]: r["item_ids"] for r in d.judge(documents(rows), benchmark).collect()}
    assert got == {i: [i] for i in range(9)} | {20: []}


def test_recall_of_the_latent_search(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    items = {r["item_id"]: d._hashes([r["text"]]).of(0).tolist() for r in benchmark.collect()}
    want = set()
    for r in docs.collect():
        own = d._hashes([r["text"]]).of(0).tolist()
        whole = set(own)
        for i, words in items.items():
            # brute force over all pairs, after the test that any leak passes
            if len(whole & set(words)) >= d.PARAPHRASE * len(set(words)):
                spots = range(0, max(1, len(own) - len(words) + 1), max(1, len(words) // 4))
                if any(d.common_subsequence(words, own[s : s + 2 * len(words)]) >= d.VERBATIM * len(words) for s in spots):
                    want.add((r["doc_id"], i))
    got = {(r["doc_id"], i) for r in d.judge(docs, benchmark).collect() for i in r["item_ids"]}
    assert want and len(want & got) >= 0.9 * len(want) and len(got - want) <= 0.1 * len(want)


def test_item_in_a_third_of_the_documents(spark, documents):
    rng = random.Random(12)
    items = [[f"i{k}x{j}" for j in range(20)] for k in range(60)]
    docs = []
    for i in range(300):
        # rare items on both sides outweigh the five words that a common item keeps
        before, after = (items[1 + (2 * i + k) % 59] for k in range(2))
        own = [f"w{rng.randrange(500)}" for _ in range(200)]
        docs.append((i, " ".join(own[:100] + before + (items[0] if i % 3 == 0 else []) + after + own[100:]), "en"))
    benchmark = spark.createDataFrame([(k, " ".join(item)) for k, item in enumerate(items)], "item_id bigint, text string")
    got = {r["doc_id"]: r["item_ids"] for r in d.judge(documents(docs), benchmark).collect()}
    assert {i for i, found in got.items() if 0 in found} == {i for i in range(300) if i % 3 == 0}


def test_runs_of_words():
    texts = ["a b c d e f g", None, "x y", "f g a b c d e q x y"]
    words = d._hashes(texts)
    runs = d._Runs([d._hashes(["a b c d e"]).of(0), d._hashes(["x y"]).of(0)])
    assert [tuple(map(int, r)) for r in zip(*runs.find(words), strict=True)] == [(0, 0, 0), (2, 1, 0), (3, 0, 0), (3, 1, 0)]
    assert [len(x) for x in runs.find(d._hashes([None, "a b"]))] == [0, 0, 0]


def test_a_whole_passage_of_a_long_item_is_enough(spark, documents):
    rng = random.Random(5)
    item = [f"q{i}" for i in range(200)]
    prose = [f"w{rng.randrange(400)}" for _ in range(400)]
    rows = [
        (1, " ".join(prose[:200] + item[64:128] + prose[200:]), "en"),
        (2, " ".join(prose[:200] + item[:128] + prose[200:]), "en"),
        (3, " ".join(prose[:200] + item[100:120] + prose[200:]), "en"),
        (4, " ".join(prose), "en"),
    ]
    benchmark = spark.createDataFrame([(7, " ".join(item))], "item_id bigint, text string")
    got = {r["doc_id"]: r["contaminated"] for r in d.judge(documents(rows), benchmark).collect()}
    assert got == {1: True, 2: True, 3: False, 4: False}


def test_words_of_equal_polynomials_are_no_leak(spark, documents):
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    benchmark = spark.createDataFrame([(1, a)], "item_id bigint, text string")
    got = {r["doc_id"]: r["contaminated"] for r in d.judge(documents([(1, b, "en"), (2, a, "en")]), benchmark).collect()}
    assert got == {1: False, 2: True}


def test_texts_are_split_into_words_once(spark, documents, monkeypatch):
    """A leak through an answer of words that no item holds, with one pass over the texts and none joined to them."""
    item, answer = [f"i{k}" for k in range(20)], "the hidden word"
    rows = [(1, " ".join(["x", *item[:12], "y", "hidden", "word", "the"]), "en"), (2, " ".join(item[:12]), "en"), (3, "x y", "en")]
    benchmark = spark.createDataFrame([(7, " ".join(item), answer)], "item_id bigint, text string, answer string")
    passes, real = [], d.cut_lineage

    def cut(df, name):
        passes.append((name, "text" in df.columns, df._jdf.queryExecution().optimizedPlan().toString().count("Join")))
        return real(df, name)

    monkeypatch.setattr(d, "cut_lineage", cut)
    got = {r["doc_id"]: (r["contaminated"], round(r["share"], 6)) for r in d.judge(documents(rows), benchmark).collect()}
    assert got == {1: (True, 0.6), 2: (False, 0.0), 3: (False, 0.0)}
    assert passes == [("hits", False, 0), ("leaks", False, 0)]
