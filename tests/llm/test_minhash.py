import random
import re
from fractions import Fraction

from tidemark.llm.minhash import near_duplicates, parts_needed


def brute(texts, size, similarity):
    sets = {}
    for i, text in texts.items():
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets[i] = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and Fraction(both, len(sets[a] | sets[b])) >= similarity:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {(i, len(sets[i]), find(i), find(i) == i) for i in ids}


def family(seed, copies, words=120):
    """Copies of one text, each with some words changed: similarities from far below to above the threshold."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    out = []
    for _ in range(copies):
        own = base[:]
        for _ in range(rng.randrange(0, 7)):
            own[rng.randrange(words)] = f"z{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def rows(df):
    return {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_same_components_as_brute_force(documents, small):
    texts = dict(enumerate(family(1, 30) + family(2, 10), start=1000)) | small[1]
    got = rows(near_duplicates(documents([(i, t, "en") for i, t in texts.items()]), 3, "17/20"))
    assert got == brute(texts, 3, Fraction(17, 20))


def test_odd_rows(documents):
    long = " ".join(f"v{i}" for i in range(30_000))
    table = documents(
        [(1, None, "en"), (2, "", "en"), (3, " \n", "en"), (4, "One two", "en"), (5, "one TWO", None), (6, "two one", "en"),
         (7, long, "en"), (8, long + " tail", "en"), (None, "one two", "en"), (4, "One two", "en"), (2**60 + 1, "solo", "en")]
    )
    got = sorted(rows(near_duplicates(table)), key=str)
    assert got == sorted(
        {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True),
         (7, 29_996, 7, True), (8, 29_997, 7, False), (None, 1, None, True), (2**60 + 1, 1, 2**60 + 1, True)},
        key=str,
    )
    assert near_duplicates(table).count() == 11
    assert near_duplicates(table.limit(0)).count() == 0


def test_number_of_parts_follows_the_similarity():
    for s in (0.8, 0.85, 0.95):
        m = parts_needed(s)
        assert 2 * (1 - s**3) ** m <= 1e-5 < 2 * (1 - s**3) ** (m - 1)


def test_texts_of_one_id_are_linked(documents):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(300))
    near = b.replace("b7 ", "c7 ")
    table = documents([(5, a, "en"), (5, b, "en"), (3, b, "en"), (9, near, "en"), (9, "", "en"), (8, a + " tail", "en")])
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_duplicates(table).collect())
    assert got == [(3, 296, 3), (5, 36, 3), (5, 296, 3), (8, 37, 3), (9, 0, 9), (9, 296, 3)]


def test_words_of_equal_polynomials_are_not_linked(documents):
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    got = rows(near_duplicates(documents([(3, a, "en"), (4, b, "en"), (5, f"{a} x", "en"), (6, f"{b} x", "en")])))
    assert {r[2] for r in got} == {3, 4, 5, 6}


def test_many_rows_of_one_id_and_text(documents):
    text = " ".join(f"w{i}" for i in range(60))
    table = documents([(1, text, "en")] * 400 + [(2, text.replace("w3 ", "v "), "en")])
    assert {r[2] for r in rows(near_duplicates(table))} == {1}
