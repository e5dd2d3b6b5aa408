import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import transform
from tidemark.llm.transform import Cut, find_anchors, remove_repeats

CLASHING = "1 AS shard, 2 AS part, 3 AS body, 4 AS ids, 5 AS data, 6 AS depth, 7 AS n_bytes, 8 AS kept".split(", ")


def brute(rows, size):
    texts = [(i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, b in texts:
        if i is not None:
            for s in range(len(b) - size + 1):
                w = b[s : s + size]
                least[w] = min(i, least.get(w, i))
    out = []
    for i, b in texts:
        gone, seen = np.zeros(len(b), bool), set()
        for s in range(len(b) - size + 1):
            w = b[s : s + size]
            if w in seen or (i is not None and least[w] < i):
                gone[s : s + size] = True
            seen.add(w)
        runs = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        out.append((i, len(b), int(gone.sum()), runs, np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return sorted(out, key=repr)


def run(spark, rows, size):
    table = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", *CLASHING).repartition(3)
    return sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in remove_repeats(table, size).collect()), key=repr)


@pytest.fixture()
def small_shards(monkeypatch):
    monkeypatch.setattr(transform, "SHARD_BYTES", 700)
    monkeypatch.setattr(transform, "STEP", 64)
    monkeypatch.setattr(transform, "DIGESTS", 7)


@pytest.mark.parametrize(("size", "letters"), [(12, "ab"), (30, "abcdefgh"), (100, "abcdefghijklmnopé ")])
def test_same_as_brute_force(spark, small_shards, size, letters):
    rng = random.Random(size)

    def text(n):
        return "".join(rng.choice(letters) for _ in range(n))

    known = [text(rng.randrange(size, 4 * size)) for _ in range(6)]
    rows = [
        (i, "".join(rng.choice([text(rng.randrange(2 * size)), rng.choice(known)]) for _ in range(rng.randrange(5))))
        for i in range(60)
    ]
    # whole and partial copies, and one-letter changes
    rows += [(100 + i, t) for i, t in rows[:20]]
    rows += [(200 + i, t[3 : len(t) - 5]) for i, t in rows[:20]]
    rows += [(300 + i, t[: len(t) // 2] + "#" + t[len(t) // 2 + 1 :]) for i, t in rows[:20]]
    rng.shuffle(rows)
    assert run(spark, rows, size) == brute(rows, size)


def test_periodic_texts(spark, small_shards):
    words = "junk " * 60
    rows = [(1, "a" * 400), (2, "a" * 119), (3, "b" * 99), (4, "ab" * 150), (5, words), (6, "x" + words + "y"), (7, "a" * 100 + "b" * 100)]
    assert run(spark, rows, 100) == brute(rows, 100)


def test_repeats_inside_a_document_and_at_its_places(spark, small_shards):
    p, y = "".join(map(str, range(60))), "-".join(map(str, range(900, 960)))
    rows = [(3, p + "z"), (5, p + y + p + y + p + y), (9, y + p)]
    assert run(spark, rows, 100) == brute(rows, 100)


def test_odd_rows(spark, small_shards):
    p, q = "".join(map(str, range(100, 160))), "".join(map(str, range(500, 560)))
    rows = [
        (1, None), (2, ""), (3, p), (3, p), (3, q), (4, q + p), (None, p), (None, p + p), (5, p[:99]), (6, "é" * 70),
        (7, "\U0001f600" * 40 + "é" * 70),
    ]
    assert run(spark, rows, 100) == brute(rows, 100)
    assert run(spark, [], 100) == []
    assert run(spark, [(1, None)], 100) == [(1, 0, 0, 0, b"")]


def test_many_copies_of_one_text(spark, small_shards):
    """A third of all rows is one text: each shard sends its blocks once."""
    p = "".join(map(str, range(200)))
    rows = [(i, p if i % 3 == 0 else f"{i} " * 40 + str(i)) for i in range(300)]
    assert run(spark, rows, 100) == brute(rows, 100)


def test_words_with_equal_polynomial_numbers(spark, small_shards):
    """Texts whose letters give the same number in arithmetic modulo 2^64 are still told apart."""
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    rows = [(1, a), (2, b), (3, a)]
    assert run(spark, rows, 100) == brute(rows, 100)


def test_whole_documents(spark, small):
    table, _ = small
    found = {r["doc_id"]: tuple(r)[1:4] + (hashlib.sha256(r["kept"]).hexdigest(),) for r in remove_repeats(table).collect()}
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    assert found == {r[0]: r[1:4] + (hashlib.sha256(r[4]).hexdigest(),) for r in brute(rows, 100)}


def test_shards_stay_where_they_are(spark, capsys):
    """A round moves keys and answers, not the texts."""
    table = spark.createDataFrame([(1, "x" * 300)], "doc_id bigint, text string")
    remove_repeats(table).explain()
    plan = capsys.readouterr().out
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(exchanges) == 1


def test_equal_strings_are_cut_alike():
    rng = random.Random(1)
    p = bytes(rng.randrange(256) for _ in range(400))
    cut = Cut(100)
    texts = [p, bytes(rng.randrange(256) for _ in range(57)) + p + p[:31]]
    places = []
    for t in texts:
        anchors, runs = find_anchors(np.frombuffer(t, np.uint8), np.array([0, len(t)]), cut)
        owner = anchors[np.searchsorted(runs, np.arange(len(t) - 99), side="right") - 1] - np.arange(len(t) - 99)
        places.append(owner)
    assert (places[0] == places[1][57 : 57 + 301]).all()
    assert cut.reach * 2 + 8 - 1 <= 100 and cut.core == 55
