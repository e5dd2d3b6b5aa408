import re

from tidemark.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CARD = "4539578763621486"
TEXTS = [
    "mail é.a@b.example.com_x@y.z, a@b.c%d@e.f! x@y z@ @w a@b-.c.d..e",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3 .1.2.3.4. 99999999999999999999.1.1.1",
    f"{CARD} 4539 5787 6362 1486 4539-5787-6362-1487 {CARD}{CARD} 0000000000000 1 2 3 4",
    f"{CARD} {CARD} and {CARD}",
    "+1 (826) 555-4081 190.137.223.204 end +1 (826) 555-4081, +12 34 +1.(2)-3 4 5 6 7 8 9 0 +(5) +44 20 7946 0958",
    "漢字 👍 a@b.co 👍 10.0.0.1 " + "9" * 5000 + " " + "a" * 5000 + "@",
    "",
    None,
    "no data here",
    "x" * 20_000 + " 8.8.8.8",
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def good(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(part) <= 255 for part in text.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if good(k, m.group())]


def test_base_spans_as_the_plain_patterns(documents, small):
    texts = dict(enumerate(TEXTS)) | {1000 + i: t for i, t in small[1].items()}
    got = pii.find(documents([(i, t, "en") for i, t in texts.items()])).collect()
    assert len(got) == len(texts)
    for r in got:
        assert [tuple(s) for s in r["base"]] == base(texts[r["doc_id"]]), r["doc_id"]
        assert set(map(tuple, r["base"])) <= set(map(tuple, r["spans"]))
        order = [(pii.KINDS.index(s["kind"]), s["start"]) for s in r["spans"]]
        assert order == sorted(order)


def test_spans_inside_dropped_matches_are_added(documents):
    rows = [(i, TEXTS[3], "en") for i in range(3)] + [(9, TEXTS[4], "en")] + [(20 + i, f"call +1 (826) 555-40{i} or {CARD} x", "en") for i in range(10, 50)]
    found = {r["doc_id"]: [(s["kind"], s["start"]) for s in r["spans"]] for r in pii.find(documents(rows)).collect()}
    assert found[0] == [("card", 0), ("card", 17), ("card", 38)]
    assert ("phone", 0) in found[9] and base(TEXTS[4])[0][0] == "ip" and ("phone", 0) not in [b[:2] for b in base(TEXTS[4])]


def test_reliabilities_separate_two_groups():
    counts = {"card:+++0": 150, "card:++-0": 20, "card:---0": 90, "card:--+0": 60, "card:0++0": 2, "card:0-+0": 2}
    real = pii.reliabilities(counts)
    assert real["card:+++0"] > 0.9 and real["card:0++0"] > 0.5 > real["card:0-+0"] and real["card:--+0"] < 0.1
    accepted = pii.train(counts)
    assert {"card:+++0", "card:++-0", "card:0++0"} <= set(accepted) and "card:--+0" not in accepted
    assert pii.train({}) == []


def test_masked_text_and_odd_rows(documents):
    rows = [(1, f"mail a@b.co, {CARD} é 8.8.8.8", "en"), (1, None, "en"), (None, "", None), (2, "plain", "en")]
    table = documents(rows)
    got = pii.masked(table)
    assert got.columns == table.columns and got.count() == 4
    assert {r["text"] for r in got.collect()} == {"mail [EMAIL], [CARD] é [IP]", None, "", "plain"}
    assert pii.find(table.limit(0)).count() == 0 and pii.masked(table.limit(0)).count() == 0


def test_many_matches_in_one_text(documents):
    """More matches than a block holds, cells that spans straddle, runs of digits, and spans of two kinds that overlap."""
    some = " ".join(f"é👍 u{i}@ex{i % 7}.com 10.0.{i % 300}.1 +1 (826) 555-4{i:03} {CARD}" for i in range(400))
    texts = {
        1: some,
        2: "x" * 1020 + " a@b.co" + "y" * 2047 + "! 8.8.8.8" + "z" * 3000,
        3: "漢" * 1024 + "8.8.8.8" + "é" * (2 * 1024 - 7) + "1.1.1.1",
        4: "9" * 12_000,
        5: "1 " * 10_000 + "+" + "2." * 5_000,
        6: "mail u@1.2.3.4 or 1.2.3.4@b.co, a@b.co(dot)uk",
        7: "a@b." * 2000,
    }
    table = documents([(i, t, "en") for i, t in texts.items()])
    found = {r["doc_id"]: r for r in pii.find(table).collect()}
    masked = {r["doc_id"]: r["text"] for r in pii.masked(table).collect()}
    for i, text in texts.items():
        assert [tuple(s) for s in found[i]["base"]] == base(text), i
        want, at = [], 0
        for start, end, kind in sorted((s["start"], s["end"], s["kind"]) for s in found[i]["spans"]):
            if start >= at:
                want.append(f"{text[at:start]}[{kind.upper()}]")
                at = end
        assert masked[i] == "".join(want) + text[at:], i


def test_candidates_against_all_base_spans(documents):
    """Votes and overlaps, compared with a look at every pair."""
    rows = [(i, f"{CARD} 4539-5787-6362-1486 x@y(dot)co a@b.co(dot)uk +1 (826) 555-4081 1.2.3.4 +44 20 7946 0958 1.2.3.4.5 " * (1 + 70 * i), "en") for i in range(3)]
    for r in pii.annotate(documents(rows), "doc_id", "text").collect():
        text = r["text"]
        for kind in pii.KINDS:
            every = [(m.start(), m.end()) for m in re.finditer(PLAIN[kind], text)]
            spans = [(s, e) for k, s, e in base(text) if k == kind]
            near = [(m.start(), m.end()) for m in re.finditer(pii.CANDIDATES[kind], text)]
            assert [tuple(s) for s in r[f"base_{kind}"]] == spans
            assert [(s["start"], s["end"]) for s in r[f"more_{kind}"]] == [n for n in near if all(n[1] <= b[0] or b[1] <= n[0] for b in spans)]
            assert [v.split(":")[1][0] for v in r[f"votes_{kind}"]] == ["+" if n in spans else "-" if n in every else "0" for n in near]
