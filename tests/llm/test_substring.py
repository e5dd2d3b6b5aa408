import random
import re

from tidemark.llm.substring import remove_repeats


def brute(texts, window):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in texts}
    first = {}
    for i in sorted(words):
        for p in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][p : p + window]), i)
    out = set()
    for i, w in words.items():
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < i:
                gone.update(range(p, p + window))
        out.add((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def rows(df):
    return {tuple(r[c] for c in ("doc_id", "n_words", "n_removed", "kept_text")) for r in df.collect()}


def test_same_words_as_brute_force(documents, small):
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(70)]
    texts = list(small[1].items())
    for i in range(40):
        cut = rng.randrange(0, 30)
        inner = passage[cut : cut + rng.randrange(30, 70)] * rng.randrange(1, 3)
        own = [f"x{rng.randrange(40)}" for _ in range(rng.randrange(0, 60))]
        texts.append((10_000 + i, " ".join(own + inner + own[::-1])))
    texts.append((20_000, "again " * 400))
    texts.append((20_001, "again " * 333))
    assert rows(remove_repeats(documents([(i, t, "en") for i, t in texts]))) == brute(texts, 50)


def test_odd_rows(documents):
    text = " ".join(f"w{i}" for i in range(60))
    long = " ".join(f"v{i}" for i in range(40_000))
    table = documents([(5, text, "en"), (5, text, "en"), (6, text + " X", None), (None, text, "en"), (1, None, "en"), (2, "", "en"),
                       (3, long, "en"), (4, "a " + long, "en"), (7, text.upper(), "en"), (2**60 + 1, text, "en")])
    got = rows(remove_repeats(table))
    assert got == {(5, 60, 0, text), (6, 61, 60, "X"), (None, 60, 0, text), (1, 0, 0, ""), (2, 0, 0, ""), (3, 40_000, 0, long),
                   (4, 40_001, 40_000, "a"), (7, 60, 0, text.upper()), (2**60 + 1, 60, 60, "")}
    assert remove_repeats(table).count() == 10
    assert remove_repeats(table.limit(0)).count() == 0


def test_passage_repeated_inside_a_later_document(documents):
    rng = random.Random(8)
    for turn in range(4):
        p, y, z = ([f"{c}{turn}{rng.random()}" for _ in range(60)] for c in "pyz")
        texts = [(3, " ".join(p + z)), (5, " ".join((p + y) * 3))]
        assert rows(remove_repeats(documents([(i, t, "en") for i, t in texts]))) == brute(texts, 50)


def test_windows_of_words_with_equal_polynomials_differ(documents):
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    words = [f"w{i}" for i in range(49)]
    rows = [(1, " ".join([*words, a]), "en"), (2, " ".join([*words, b]), "en"), (3, " ".join([*words, a]), "en")]
    got = {r["doc_id"]: r["n_removed"] for r in remove_repeats(documents(rows)).collect()}
    assert got == {1: 0, 2: 0, 3: 50}
