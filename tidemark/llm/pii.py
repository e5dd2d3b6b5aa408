"""Personal data: exact base patterns, and further spans by weak supervision, with built-in expressions only.

Base patterns find spans per kind, leftmost and without overlap; a match that fails its check is dropped. Narrower
patterns propose candidates, also inside such dropped matches (a telephone number that an address follows). Four
labelers vote on each candidate: the base pattern, the structure (checksum, ranges), a gazetteer, and the context.
Votes are counted over all documents. Expectation-maximisation estimates from these counts how reliable each labeler
is, and its posteriors train the final classifier, a logistic regression over kinds and votes. A candidate that the
classifier accepts, and that overlaps no base span, is added.

There are at most 81 vote patterns per kind, so counts, model and accepted patterns have a fixed size.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")

# Base patterns. They match what the plain forms match, but take no second look at a run of characters: possessive
# repeats, and a run is entered at its start or where the last match ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Candidate patterns.
CANDIDATES = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@|\x20?[(\[]at[)\]]\x20?)"
    r"[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])(?!\.[0-9])",
    "card": r"(?<![0-9])(?:[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{13,19})(?![0-9])",
    "phone": r"\+[0-9]{1,3}(?:[\x20.-]?\([0-9]{1,4}\)[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{4}|(?:[\x20.-][0-9]{2,4}){2,4}(?![\x20.-]?[0-9]))(?![0-9])",
}
# What every match of a kind contains; other texts are not searched.
NEEDED = {"email": None, "ip": ".", "card": None, "phone": "+"}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# Gazetteers: ends of host names, first octets in public use, issuer digits, country codes.
KNOWN = {
    "email": r"[.\]) ](?:com|org|net|edu|gov|mil|int|info|io|co|uk|de|fr|es|it|nl|ch|at|be|us|ca|eu)\z",
    "ip": r"\A0*(?:[1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])\.",
    "card": r"\A[3-6]",
    "phone": r"\A\+(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])(?:[^0-9]|[0-9])",
}
# Words before a span that announce its kind.
CUES = {
    "email": "mail|contact|write",
    "ip": r"\bip\b|server|host|address",
    "card": "card|visa|payment|credit",
    "phone": "phone|tel|call|fax|mobile",
}
CUE_LENGTH = 24
ROUNDS = 100
# Elements that grow by one copy each; whole blocks are then put together. It bounds the work per match.
BLOCK = 128
# Code points of a text that are looked at for one place in it.
CELL = 1024
FOUND = "struct<start:bigint,end:bigint,text:string,before:string,after:string>"
JUDGED = "struct<start:bigint,end:bigint,votes:string,covered:boolean>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value evaluated once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(items: Column, zero: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """What ``step(state, item)``, a new state and an output of type ``kind``, puts out for each item in order.

    Appending copies an array, so outputs are gathered in blocks: the work per item doesn't grow with their number.
    """

    def one(held: Column, item: Column) -> Column:
        state, out = step(held["state"], item)
        return F.struct(state.alias("state"), F.array_append(held["found"], out).alias("found"))

    def block(held: Column, part: Column) -> Column:
        begin = F.struct(held["state"].alias("state"), F.array().cast(f"array<{kind}>").alias("found"))
        return _let(
            F.aggregate(part, begin, one),
            lambda done: F.struct(done["state"].alias("state"), F.array_append(held["parts"], done["found"]).alias("parts")),
        )

    def whole(items: Column) -> Column:
        last = F.floor((F.size(items) - 1) / BLOCK).cast("int")
        parts = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * BLOCK + 1, F.lit(BLOCK)))
        begin = F.struct(zero.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("parts"))
        none = F.array().cast(f"array<{kind}>")
        return F.when(F.size(items) > 0, F.aggregate(parts, begin, block, lambda held: F.flatten(held["parts"]))).otherwise(none)

    return _let(items, whole)


def located(text: Column, matches: Column, pattern: str) -> Column:
    """Matches of a pattern with their places in code points, the text before them and the letter after them.

    The text between the matches gives the distances; a text without matches is not split.
    """

    def step(held: Column, item: Column) -> tuple[Column, Column]:
        start = held["at"] + F.length(item["gap"])
        end = start + F.length(item["match"])
        before = F.right(F.concat(held["tail"], item["gap"]), F.lit(CUE_LENGTH))
        after = F.when(item["rest"] != "", item["rest"]).otherwise(F.coalesce(item["next"], F.lit("")))
        out = F.struct(
            start.alias("start"),
            end.alias("end"),
            item["match"].alias("text"),
            before.alias("before"),
            F.substring(after, 1, 1).alias("after"),
        )
        tail = F.right(F.concat(before, item["match"]), F.lit(CUE_LENGTH))
        return F.struct(end.alias("at"), tail.alias("tail")), out

    def zipped(between: Column) -> Column:
        n = F.size(matches)
        return F.arrays_zip(
            F.slice(between, 1, n).alias("gap"),
            matches.alias("match"),
            F.slice(between, 2, n).alias("rest"),
            F.slice(matches, 2, n).alias("next"),
        )

    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("tail"))
    found = running(_let(F.split(text, pattern, -1), zipped), zero, step, FOUND)
    return F.when(F.size(matches) > 0, found).otherwise(F.array().cast(f"array<{FOUND}>"))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(text: Column) -> Column:
    def total(turned: Column) -> Column:
        def add(total: Column, place: Column) -> Column:
            digit = F.substring(turned, place, F.lit(1)).cast("int")
            twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
            return total + F.when(place % 2 == 0, twice).otherwise(digit)

        return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add)

    def check(turned: Column) -> Column:
        return F.when(F.length(turned).between(13, 19), total(turned) % 10 == 0).otherwise(F.lit(False))

    return _let(F.reverse(_digits(text)), check)


def valid(kind: str, text: Column) -> Column:
    """The check that a base match of a kind must pass."""
    if kind == "ip":
        return F.rlike(text, F.lit(rf"\A{OCTET}(?:\.{OCTET}){{3}}\z"))
    if kind == "card":
        return _luhn(text)
    if kind == "phone":
        return F.length(_digits(text)).between(9, 15)
    return F.lit(True)


def _matches(text: Column, kind: str, pattern: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if not NEEDED[kind]:
        return found
    return F.when(F.contains(text, F.lit(NEEDED[kind])), found).otherwise(F.array().cast("array<string>"))


def _own_votes(kind: str, span: Column) -> Column:
    """Votes of structure, gazetteer and context on a candidate, as a text of ``+``, ``0`` and ``-``."""
    structure = F.when(valid(kind, span["text"]), "+").otherwise("-")
    known = F.when(F.rlike(span["text"], F.lit(KNOWN[kind])), "+").otherwise("-")
    around = F.concat(F.right(span["before"], F.lit(1)), span["after"])
    announced = F.rlike(F.lower(span["before"]), F.lit(CUES[kind]))
    context = F.when(announced, "+").when(F.rlike(around, F.lit(r"[\p{L}\p{N}@_=]")), "-").otherwise("0")
    return F.concat(structure, known, context)


def _judged(kind: str, matches: Column, near: Column) -> Column:
    """Candidates with their votes, and whether a base span covers a part of them.

    Neither matches nor candidates overlap one another. So of the matches that start before a candidate's end, the last
    one is the only one that can be equal to it, and the last good one the only one that can overlap it.
    """
    no = F.lit(None)

    def candidate(x: Column) -> Column:
        return _event(x["end"], 0, x, no.cast("boolean"), _own_votes(kind, x))

    def match(x: Column) -> Column:
        return _event(x["start"], 1, x, x["good"], no.cast("string"))

    def step(held: Column, x: Column) -> tuple[Column, Column]:
        same = (held["start"] == x["start"]) & (held["end"] == x["end"])
        pattern = F.when(same & held["good"], "+").when(same, "-").otherwise("0")
        out = F.struct(
            x["start"].alias("start"),
            x["end"].alias("end"),
            F.concat(F.lit(kind + ":"), pattern, x["votes"]).alias("votes"),
            (held["last"] > x["start"]).alias("covered"),
        )
        last = F.when(x["good"], x["end"]).otherwise(held["last"])
        passed = F.struct(x["start"].alias("start"), x["end"].alias("end"), x["good"].alias("good"), last.alias("last"))
        return F.when(x["order"] == 0, held).otherwise(passed), out

    nowhere = F.lit(-1).cast("bigint")
    zero = F.struct(nowhere.alias("start"), nowhere.alias("end"), F.lit(False).alias("good"), nowhere.alias("last"))
    events = F.sort_array(F.concat(F.transform(matches, match), F.transform(near, candidate)))
    judged = F.filter(running(events, zero, step, JUDGED), lambda x: x["votes"].isNotNull())
    return F.when(F.size(near) > 0, judged).otherwise(F.array().cast(f"array<{JUDGED}>"))


def _event(at: Column, order: int, span: Column, good: Column, votes: Column) -> Column:
    return F.struct(
        at.alias("at"),
        F.lit(order).alias("order"),
        span["start"].alias("start"),
        span["end"].alias("end"),
        good.alias("good"),
        votes.alias("votes"),
    )


def _checked(kind: str) -> Callable[[Column], Column]:
    return lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), valid(kind, x["text"]).alias("good"))


def annotate(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, and per kind: ``base_<kind>`` (start, end), ``more_<kind>`` (start, end, votes) for
    candidates off all base spans of the kind, and ``votes_<kind>`` of every candidate. Null text counts as empty.

    The work per match does not grow with the matches or the length of a text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*keep, text.alias("_text"))
    text = F.col("_text")
    # a step's columns are used more than once by the next, so that they are evaluated once
    found = {f"_all_{k}": _matches(text, k, BASE[k]) for k in KINDS} | {f"_near_{k}": _matches(text, k, CANDIDATES[k]) for k in KINDS}
    rows = rows.withColumns(found)
    patterns = {f"_all_{k}": BASE[k] for k in KINDS} | {f"_near_{k}": CANDIDATES[k] for k in KINDS}
    rows = rows.select(*keep, *[located(text, F.col(c), pattern).alias(c) for c, pattern in patterns.items()])
    rows = rows.withColumns({f"_all_{k}": F.transform(f"_all_{k}", _checked(k)) for k in KINDS})
    rows = rows.withColumns({f"_near_{k}": _judged(k, F.col(f"_all_{k}"), F.col(f"_near_{k}")) for k in KINDS})
    columns = []
    place = lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))
    voted = lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["votes"].alias("votes"))
    for kind in KINDS:
        apart = F.filter(f"_near_{kind}", lambda x: ~x["covered"])
        columns += [
            F.transform(F.filter(f"_all_{kind}", lambda x: x["good"]), place).alias(f"base_{kind}"),
            F.transform(apart, voted).alias(f"more_{kind}"),
            F.transform(f"_near_{kind}", lambda x: x["votes"]).alias(f"votes_{kind}"),
        ]
    return rows.select(*keep, *columns)


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def reliabilities(counts: Mapping[str, int], rounds: int = ROUNDS) -> dict[str, float]:
    """Posterior that a span is real, per vote pattern of one kind, by expectation-maximisation.

    Each labeler has its own rate of ``+`` among its votes on real spans and on others; 0 is no vote. It starts from
    the majority of votes, and each rate is smoothed by one vote of either sort.
    """
    value = {"+": 1, "0": 0, "-": -1}
    patterns = {p: [value[c] for c in p.split(":")[1]] for p in counts}
    real = {p: _sigmoid(float(sum(v))) for p, v in patterns.items()}
    for _ in range(rounds):
        total = sum(counts.values())
        prior = (1 + sum(counts[p] * real[p] for p in patterns)) / (2 + total)
        rates = []
        for i in range(4):
            rate = []
            for weight in (lambda p: real[p], lambda p: 1 - real[p]):
                yes = sum(counts[p] * weight(p) for p, v in patterns.items() if v[i] > 0)
                no = sum(counts[p] * weight(p) for p, v in patterns.items() if v[i] < 0)
                # a labeler is taken to be right more often than not where nothing is known
                rate.append((yes + (2 if not rate else 1)) / (yes + no + 3))
            rates.append(rate)
        for p, votes in patterns.items():
            odds = math.log(prior / (1 - prior))
            for (hit, false), v in zip(rates, votes, strict=True):
                if v:
                    odds += math.log(hit / false) if v > 0 else math.log((1 - hit) / (1 - false))
            real[p] = _sigmoid(odds)
    return real


def train(counts: Mapping[str, int], rounds: int = 400, rate: float = 0.5, shrink: float = 1e-3) -> list[str]:
    """Vote patterns that the final classifier accepts: logistic regression, fitted to the posteriors of all kinds."""
    value = {"+": 1.0, "0": 0.0, "-": -1.0}
    rows = []
    for kind in KINDS:
        own = {p: n for p, n in counts.items() if p.split(":")[0] == kind}
        real = reliabilities(own) if own else {}
        total = sum(own.values())
        for p, n in own.items():
            votes = [value[c] for c in p.split(":")[1]]
            marks = [1.0 if kind == k else 0.0 for k in KINDS]
            # every kind weighs the same, and so do its votes with the kind: four weights per kind
            features = marks + [v * m for m in marks for v in votes]
            rows.append((p, features, real[p], (n + 1) / (total + len(own))))
    if not rows:
        return []
    weights = [0.0] * len(rows[0][1])
    for _ in range(rounds):
        slope = [shrink * w for w in weights]
        for _, features, target, share in rows:
            error = share * (_sigmoid(sum(w * x for w, x in zip(weights, features, strict=True))) - target)
            for i, x in enumerate(features):
                slope[i] += error * x
        weights = [w - rate * s for w, s in zip(weights, slope, strict=True)]
    return sorted(p for p, features, _, _ in rows if sum(w * x for w, x in zip(weights, features, strict=True)) > 0)


def fit(annotated: DataFrame) -> list[str]:
    """Accepted vote patterns, from the counts over all rows: a few hundred numbers at most reach the driver."""
    votes = annotated.select(F.explode(F.concat(*[F.col(f"votes_{k}") for k in KINDS])).alias("pattern"))
    return train({r["pattern"]: r["n"] for r in votes.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()})


def spans(annotated: DataFrame, accepted: list[str], *keep: str) -> DataFrame:
    """``keep`` columns, ``base`` and ``spans``: arrays of (kind, start, end) by kind, then start."""
    known = F.array(*map(F.lit, accepted)).cast("array<string>")

    def named(kind: str, found: Column) -> Column:
        return F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))

    base = {k: named(k, F.col(f"base_{k}")) for k in KINDS}
    more = {k: named(k, F.filter(f"more_{k}", lambda x: F.array_contains(known, x["votes"]))) for k in KINDS}
    return annotated.select(
        *keep,
        F.concat(*base.values()).alias("base"),
        F.concat(*[F.sort_array(F.concat(base[k], more[k])) for k in KINDS]).alias("spans"),
    )


def find(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``base``, ``spans`` for every row of ``docs`` (``doc_id``, ``text``).

    Places are code points, ends exclusive. Null and empty texts have no spans. Repeated rows and null ids are kept as
    they are. Empty input gives no rows, and a corpus without candidates adds nothing. Other columns are ignored.
    """
    annotated = cut_lineage(annotate(docs, "doc_id"), "annotated")
    return spans(annotated, fit(annotated), "doc_id")


def _part(cells: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` of a text that is cut into cells."""
    first, last = F.floor(start / CELL).cast("int"), F.floor(end / CELL).cast("int")
    skip, rest = (start % CELL).cast("int"), (end % CELL).cast("int")
    cell = lambda at: F.coalesce(F.get(cells, at), F.lit(""))
    within = F.substring(cell(first), skip + 1, (end - start).cast("int"))
    across = F.concat(
        F.substring(cell(first), skip + 1, F.lit(CELL)),
        F.array_join(F.slice(cells, first + 2, last - first - 1), ""),
        F.substring(cell(last), F.lit(1), rest),
    )
    return F.when(first == last, within).otherwise(across)


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; other columns unchanged.

    Where spans of different kinds overlap, the one that starts first is replaced. Null text stays null. Texts are
    searched once; what was found is written next to the rows.
    """
    columns = docs.columns
    rows = docs.select(F.struct(*[docs[c] for c in columns]).alias("_row"), "text")
    annotated = cut_lineage(annotate(rows, "_row"), "annotated")
    found = spans(annotated, fit(annotated), "_row")
    text = F.col("_row.text").cast("string")
    ordered = F.sort_array(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    cells = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CELL}}}"), F.lit(0))
    found = found.select("_row", ordered.alias("_spans")).withColumn("_cells", F.when(F.size("_spans") > 0, cells))

    def passed(held: Column, span: Column) -> Column:
        return F.when(span["start"] < held, held).otherwise(span["end"])

    def step(held: Column, span: Column) -> tuple[Column, Column]:
        out = F.concat(_part(F.col("_cells"), held, span["start"]), F.lit("["), F.upper(span["kind"]), F.lit("]"))
        return passed(held, span), F.when(span["start"] < held, "").otherwise(out)

    first = F.lit(0).cast("bigint")
    rest = _part(F.col("_cells"), F.aggregate("_spans", first, passed), F.length(text).cast("bigint"))
    replaced = F.concat(F.array_join(running(F.col("_spans"), first, step, "string"), ""), rest)
    clean = F.when(F.size("_spans") > 0, replaced).otherwise(text)
    return found.select("_row", clean.alias("_clean")).select(
        *[F.col("_clean").alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in columns]
    )
