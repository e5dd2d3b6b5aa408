import re

from tidemark.llm.common import Words, components, steps, windows

TEXTS = ["a b  c", None, "", " \t\n", "Ä é x y", "one", "\x1fa\x0bb\x0cc\r\nd"]


def test_words_split_at_the_six_bytes_only():
    words = Words(TEXTS)
    for i, text in enumerate(TEXTS):
        want = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        assert words.count(i) == len(want)
        assert [int(h) for h in words.of(i)] == [int(Words([w]).of(0)[0]) for w in want]


def test_lower_case_is_ascii_only():
    a, b = Words(["AbÉ"], lower=True).of(0), Words(["abÉ"]).of(0)
    assert (a == b).all() and Words(["abé"]).of(0)[0] != b[0]


def test_windows_tell_order_and_place():
    h = Words(["a b c d a b c e"]).of(0)
    for size in range(1, 9):
        found = windows(h, size)
        assert len(found) == 9 - size
        tuples = [tuple(h[i : i + size].tolist()) for i in range(9 - size)]
        assert len(set(found.tolist())) == len(set(tuples))
    assert len(windows(h, 9)) == 0 and windows(Words(["b a"]).of(0), 2)[0] != windows(Words(["a b"]).of(0), 2)[0]


def test_words_of_equal_polynomials_differ():
    """Thue-Morse words have the same value in any odd base modulo 2^64."""
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    assert len(a) == 1024 and Words([a]).of(0)[0] != Words([b]).of(0)[0]
    assert Words([a]).of(0)[0] != Words([a + a[:32]]).of(0)[0]
    # letters beyond the table still count by place
    long = "x" * 100
    assert len({int(Words([long[:i] + "y" + long[i + 1 :]]).of(0)[0]) for i in range(100)}) == 100


def test_steps_cover_all_and_never_split_a_text():
    texts = ["x" * n for n in (5, 0, 100, 3, 3, 50)] + [None]
    ranges = list(steps(texts, 10))
    assert [i for lo, hi in ranges for i in range(lo, hi)] == list(range(len(texts)))


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (5, 5)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 1, 8: 1, 9: 1, 20: 20, 21: 20}
    chain = spark.range(200).selectExpr("id AS a", "id + 1 AS b")
    assert {r["component"] for r in components(chain).collect()} == {0}
    assert components(links.limit(0)).count() == 0
