import math
import random
from collections import Counter, defaultdict

import pandas as pd
import pytest
from tidemark.llm import quality
from tidemark.llm.quality import _discounts, gram_scores, judge, keep_good, trusted_ids


def brute(trusted, asked):
    """Bits of 4-grams by the textbook recursion over strings."""
    raw = Counter(t[i : i + 4] for t in ("\x02\x02\x02" + x for x in trusted) for i in range(len(t) - 3))
    level = {4: raw}
    for n in (3, 2, 1):
        level[n] = Counter(g[1:] for g in level[n + 1])
    discount, context = {}, {}
    for n, counts in level.items():
        n1, n2, n3, n4 = (sum(c == i for c in counts.values()) for i in (1, 2, 3, 4))
        if n1 and n2:
            y = n1 / (n1 + 2 * n2)
            three = 3 - 4 * y * n4 / n3 if n3 else 1.5
            values = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, three)
            discount[n] = tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(values))
        else:
            discount[n] = (0.5, 0.75, 0.9)
        context[n] = defaultdict(list)
        for g, c in counts.items():
            context[n][g[:-1]].append(c)

    def p(g):
        if not g:
            return 1 / 65536
        n, own = len(g), context[len(g)].get(g[:-1])
        if not own:
            return p(g[1:])
        d = lambda c: discount[n][min(c, 3) - 1]
        c = level[n].get(g, 0)
        rest = sum(min(d(x), x) for x in own) / sum(own)
        return max(c - d(c) if c else 0, 0) / sum(own) + rest * p(g[1:])

    return {g: -math.log2(p(g)) for g in asked}


def number(g):
    out = 0
    for c in g:
        out = out << 16 | ord(c)
    return out - (1 << 64) if out >= 1 << 63 else out


def test_probabilities_of_the_model(spark):
    rng = random.Random(5)
    trusted = ["".join(rng.choice("abcdé ") for _ in range(80)) for _ in range(12)]
    raw = Counter(t[i : i + 4] for t in ("\x02\x02\x02" + x for x in trusted) for i in range(len(t) - 3))
    asked = list(raw) + ["zzzz", "abcz", "azbc", "\uffffabc"]
    table = spark.createDataFrame([(number(g), raw.get(g, 0)) for g in asked], "g bigint, c bigint")
    got = {r["g"]: r["bits"] for r in gram_scores(table).collect()}
    for g, bits in brute(trusted, asked).items():
        assert got[number(g)] == pytest.approx(bits, rel=1e-9)


def test_probabilities_of_a_context_add_up(spark):
    # all units that follow "ab" in training, and one unit for each of the others
    trusted = Counter({"xabc": 3, "xabd": 1, "yabc": 2, "yabe": 1, "abcx": 2})
    units = "abcdexyz"
    table = spark.createDataFrame([(number("xab" + u), trusted.get("xab" + u, 0)) for u in units] + [(number(g), c) for g, c in trusted.items() if g[:3] != "xab"], "g bigint, c bigint")
    got = {r["g"]: 2 ** -r["bits"] for r in gram_scores(table).collect()}
    unseen = got[number("xabz")]
    total = sum(got[number("xab" + u)] for u in units if u != "z") + unseen * (65536 - len(units) + 1)
    assert total == pytest.approx(1.0, rel=1e-9)


def test_discounts_without_counts(spark):
    assert _discounts(spark.createDataFrame([(5,), (7,)], "c bigint")) == (0.5, 0.75, 0.9)


def test_held_out_accuracy_and_odd_rows(spark, documents):
    rng = random.Random(7)
    syllables = ["ba", "ke", "mi", "tor", "sel", "dan"]

    def prose(n):
        return " ".join("".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(n)) + "."

    def junk(n):
        return " ".join("".join(rng.choices("%&$#@!|QXZ0", k=6)) for _ in range(n))

    rows = [(i, prose(80), "en" if i % 2 else "fr") for i in range(120)] + [(200 + i, junk(60), "en") for i in range(30)]
    rows += [(300, None, "en"), (301, "", None), (302, "ba", "xx"), (None, prose(50), "en"), (303, junk(60), None), (303, junk(60), None),
             (2**60 + 1, prose(20_000), "en")]
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(60)] + [(200, 0, 0), (201, 0, 0), (None, 1, 0), (999, 1, 0), (5, 1, 0), (202, 1, 0), (202, 0, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    table = documents(rows)
    got = judge(table, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        i = r["doc_id"]
        assert r["kept"] == (i is None or i < 200 or i in (300, 301, 302, 2**60 + 1)), r
        assert (r["perplexity"] is None) == (i in (300, 301))
    kept = keep_good(table, labels)
    assert kept.columns == table.columns and kept.count() == len(rows) - 32
    assert judge(table.limit(0), labels).count() == 0
    assert {r["kept"] for r in judge(table, labels.limit(0)).collect()} == {True}
    assert {r["doc_id"] for r in trusted_ids(labels).collect()} == {*range(60), 999}


def test_foul_sentences_in_ordinary_prose(spark, documents):
    rng = random.Random(9)
    syllables = ["ba", "ke", "mi", "tor", "sel", "dan"]

    def prose(n):
        return " ".join("".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(n)) + "."

    good = {i: prose(300) for i in range(300)}
    # keys and numbers in one trusted text of twenty must not hide foul words
    good |= {i: prose(150) + f" key = {rng.getrandbits(128):032x} " + prose(150) for i in range(0, 300, 20)}
    foul = {1000 + i: f"{prose(150)} wuxhy gropfy wuxhy czuqh {prose(150)}" for i in range(20)}
    fresh = {2000 + i: prose(300) for i in range(40)} | {3000: f"{prose(200)} key = {rng.getrandbits(128):032x} {prose(100)}"}
    labels = spark.createDataFrame([(i, 1, 0) for i in good], "doc_id bigint, quality int, toxic int")
    got = judge(documents([(i, t, "en") for i, t in (good | foul | fresh).items()]), labels).collect()
    gone = {r["doc_id"] for r in got if not r["kept"]}
    assert gone >= set(foul)
    assert len(gone - set(foul)) <= 4
    assert 3000 not in gone


def test_counting_holds_few_grams_and_loses_none(monkeypatch):
    texts = [f"text {i} of some words {i * i}" for i in range(400)]
    batch = pd.DataFrame({"text": texts, "trusted": [i % 2 == 0 for i in range(400)]})
    monkeypatch.setattr(quality, "steps", lambda held: ((i, i + 5) for i in range(0, len(held), 5)))
    whole = pd.concat(quality._counts(iter([batch]))).groupby("g")["c"].sum()
    monkeypatch.setattr(quality, "HELD_GRAMS", 200)
    frames = list(quality._counts(batch.iloc[i : i + 10] for i in range(0, 400, 10)))
    assert len(frames) > 1 and max(map(len, frames)) < 1000
    assert pd.concat(frames).groupby("g")["c"].sum().equals(whole)
