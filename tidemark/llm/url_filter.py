"""URL verdicts from rules and from a cascade of Bloom filters, with built-in expressions only.

Level 0 holds the listed keys; level 1 the other keys of the corpus that level 0 lets through; level 2 the listed
keys that level 1 lets through; and so on until a level lets nothing through. A key of the corpus is listed if the
number of levels it passes in a row is odd. That is exact for every key of the universe the cascade was built for,
and judging a row needs no join: a level is one array that a scalar subquery hands to the tasks.

A cascade of more than ``SHARD_BITS`` bits is split by a hash of the key into shards of that size, which are applied
one after the other, so that no task ever holds more than one shard.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

SHARD_BITS = 1 << 23

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or url."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host, its subdomains, and paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct of text and verdict; null if none. Ties: the longer host, then its text."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.text, r.verdict))
    if not ordered:
        return F.lit(None).cast("struct<text:string,verdict:string>")
    listed = F.array(
        *[
            F.struct(*[F.lit(v).alias(k) for k, v in (("host", r.host), ("path", r.path), ("text", r.text), ("verdict", r.verdict))])
            for r in ordered
        ]
    )
    fits = F.filter(
        listed,
        lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"]),
    )
    first = F.get(fits, F.lit(0))
    return F.when(first.isNotNull(), F.struct(first["text"].alias("text"), first["verdict"].alias("verdict")))


@dataclass(frozen=True)
class Level:
    """One Bloom filter per shard: a table of ``shard``, ``words`` and the numbers that address a bit."""

    filters: DataFrame
    number: int
    bits: int
    hashes: int

    def passes(self, key: Column, shard: int) -> Column:
        words = self.filters.where(F.col("shard") == shard).select("words").scalar()
        found = F.lit(True)
        for place in _places(key, self):
            word = F.get(words, F.expr("0").cast("int") + F.shiftright(place, 6).cast("int"))
            found = found & (F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1)
        return F.coalesce(found, F.lit(False))


def _places(key: Column, level: Level) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level.number), F.lit(i)), F.lit(level.bits)) for i in range(level.hashes)]


def _shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(shards)).cast("int")


def _level(keys: DataFrame, number: int, n: int, rate: float, shards: int) -> Level:
    """A filter of ``n`` keys (``key``, ``shard``) whose false positive rate is about ``rate``."""
    per_shard = math.ceil(n / shards)
    bits = max(64, 64 * math.ceil(per_shard * -math.log(rate) / math.log(2) ** 2 / 64))
    shape = Level(keys, number, bits, max(1, round(bits / max(1, per_shard) * math.log(2))) if rate < 0.5 else 1)
    places = keys.select("shard", F.explode(F.array(*_places(F.col("key"), shape))).alias("place"))
    ones = places.select(
        "shard",
        F.shiftright("place", 6).alias("word"),
        F.expr("shiftleft(1L, CAST(place % 64 AS INT))").alias("set"),
    )
    spark = keys.sparkSession
    empty = spark.range(shards * (bits // 64)).select(
        (F.col("id") % shards).cast("int").alias("shard"), F.expr(f"id DIV {shards}").alias("word"), F.lit(0).cast("bigint").alias("set")
    )
    words = ones.union(empty).groupBy("shard", "word").agg(F.bit_or("set").alias("set"))
    dense = words.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("word", "set"))).alias("all"))
    filters = cut_lineage(dense.select("shard", F.col("all.set").alias("words")), "bloom")
    return Level(filters, number, shape.bits, shape.hashes)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]
    shards: int

    def contains(self, key: Column, shard: int = 0) -> Column:
        """Exact for keys of the universe: they pass an odd number of levels in a row if they are listed."""
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            out = F.when(level.passes(key, shard), out).otherwise(F.lit(level.number % 2 == 1))
        return out


def build_cascade(universe: DataFrame, shard_bits: int = SHARD_BITS) -> Cascade:
    """Cascade for ``universe``: distinct ``key``, and ``listed`` (boolean, null counts as false).

    Each level's size follows from the number of keys it holds, so only counts reach the driver. The first level's
    rate balances its size against that of the levels above, which halve what is left.
    """
    known = universe.select("key", F.coalesce("listed", F.lit(False)).alias("listed")).where("key is not null")
    n, n_listed = known.agg(F.count(F.lit(1)), F.count_if("listed")).first()
    rate = min(0.5, math.sqrt(0.5) * max(1, n_listed) / max(1, n - n_listed))
    shards = max(1, math.ceil(n_listed * -math.log(rate) / math.log(2) ** 2 / shard_bits))
    known = cut_lineage(known.withColumn("shard", _shard(F.col("key"), shards)), "keys")
    held, other = known.where("listed").drop("listed"), known.where("not listed").drop("listed")
    levels: list[Level] = []
    left = n_listed
    while left:
        levels.append(_level(held, len(levels), left, rate if not levels else 0.5, shards))
        through = [other.where(F.col("shard") == s).where(levels[-1].passes(F.col("key"), s)) for s in range(shards)]
        passed = through[0]
        for more in through[1:]:
            passed = passed.union(more)
        passed = cut_lineage(passed, "passed")
        held, other, left = passed, held, passed.count()
    return Cascade(tuple(levels), shards)


def with_membership(rows: DataFrame, key: str, cascade: Cascade, name: str = "listed") -> DataFrame:
    """``rows`` with a boolean ``name``: whether the key is listed. Shards are applied one after the other."""
    if cascade.shards == 1:
        return rows.withColumn(name, F.coalesce(cascade.contains(F.col(key)), F.lit(False)))
    out = rows.withColumn(name, F.lit(False))
    for shard in range(cascade.shards):
        own = _shard(F.col(key), cascade.shards) == shard
        out = cut_lineage(out.withColumn(name, F.when(own, cascade.contains(F.col(key), shard)).otherwise(F.col(name))), "judged")
    return out


def under_domains(hosts: DataFrame, domains: DataFrame) -> DataFrame:
    """``key``, ``listed`` for distinct ``hosts.key``: whether the host or a parent domain is in ``domains.domain``."""
    labels = F.split("key", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    suffixes = hosts.select("key", F.explode(parents).alias("domain"))
    hits = suffixes.join(domains.select("domain").distinct(), "domain").select("key").distinct().withColumn("listed", F.lit(True))
    return hosts.select("key").distinct().join(hits, "key", "left").select("key", F.coalesce("listed", F.lit(False)).alias("listed"))


def judge(pages: DataFrame, rules: list[Rule], domains: DataFrame, shard_bits: int = SHARD_BITS) -> DataFrame:
    """Verdict for every row of ``pages`` (``page_id``, ``url``): ``page_id, host, path, rule, verdict, listed``.

    The longest rule that fits decides; without one, a host under a listed domain is blocked and any other allowed.
    A null url, or one without ``://``, has an empty host and path and is allowed. Repeated rows are judged each; a
    null page_id stays null; empty pages or an empty list give a cascade without levels. Other columns are ignored.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    universe = under_domains(rows.select(F.col("host").alias("key")).distinct(), domains)
    judged = with_membership(rows, "host", build_cascade(universe, shard_bits))
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    judged = judged.withColumn("_rule", rule)
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(F.col("listed"), "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", F.col("_rule.text").alias("rule"), verdict.alias("verdict"), "listed")


def domains_with_words(pages: DataFrame, words: list[str]) -> DataFrame:
    """``domain``: hosts of ``pages`` with a listed word between their dots and hyphens."""
    host, _ = host_and_path(F.col("url"))
    tokens = F.split("domain", "[.-]")
    return pages.select(host.alias("domain")).distinct().where(F.arrays_overlap(tokens, F.array(*map(F.lit, words))))
