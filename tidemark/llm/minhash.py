"""Near-duplicate documents by tensored MinHash banding, with exact confirmation of every link.

Two small collections of ``m`` hash parts each (a part joins ``k`` minhashes) give ``m * m`` tables: the
key of table (i, j) is the pair (left part i, right part j). So ``2 m k`` minhashes serve ``m * m`` bands
of width ``2 k``. A table needs an entry only where both halves are shared with another document, which
is found on the halves alone, before any pair is formed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Words, as_list, components, join_words, mix, signed, steps, stream, windows
from tidemark.session import cut_lineage, cut_texts

# Minhashes per part, and the chance to miss a pair that is just similar enough.
PART = 3
MISS = 1e-5
# Documents that make a block of neighbours, and pairs that are confirmed together.
BLOCK = 128
GROUP_PAIRS = 2000
# One-bit minhashes of the sketches that tell far pairs, and how many standard deviations a similar pair may stray.
SKETCH_BITS = 2048
STRAY = 4.5


def parts_needed(similarity: float, part: int = PART, miss: float = MISS) -> int:
    """Parts per collection: a pair is missed if none of the left, or none of the right parts agree."""
    m = 1
    while 2 * (1 - similarity**part) ** m > miss:
        m += 1
    return m


def shingles(words: Words, i: int, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; fewer words than ``size`` are one shingle."""
    own = words.of(i)
    if 0 < len(own) < size:
        return windows(own, len(own)) ^ np.uint64(len(own))
    return np.unique(windows(own, size))


def _signatures(size: int, m: int, part: int):
    multipliers = stream(5, 2 * m * part) | np.uint64(1)
    flips = stream(6, 2 * m * part)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, ids = as_list(batch["text"]), batch["doc_id"]
            for lo, hi in steps(texts):
                words = Words(texts[lo:hi], lower=True)
                sets = [shingles(words, i, size) for i in range(hi - lo)]
                counts = np.array([len(s) for s in sets], dtype=np.int64)
                full = np.flatnonzero(counts)
                n = len(sets)
                digest = np.zeros((2, n), dtype=np.uint64)
                parts = np.zeros((2 * m, n), dtype=np.uint64)
                if len(full):
                    every = np.concatenate([sets[i] for i in full])
                    at = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
                    digest[0, full] = np.add.reduceat(mix(every), at)
                    digest[1, full] = np.add.reduceat(mix(every ^ np.uint64(0xA5A5A5A5A5A5A5A5)), at)
                    for p in range(2 * m):
                        held = None
                        for r in range(p * part, p * part + part):
                            low = np.minimum.reduceat((every ^ flips[r]) * multipliers[r], at)
                            held = low if held is None else join_words(held, low)
                        parts[p, full] = held
                yield pd.DataFrame(
                    {
                        "doc_id": ids.iloc[lo:hi].array,
                        "n_shingles": counts,
                        "d1": signed(digest[0]),
                        "d2": signed(digest[1]),
                        "parts": list(signed(parts.T.copy())) if n else [],
                    }
                )

    return run


def _confirm(size: int, times: int, least: int):
    """Of the pairs of a group, those that are similar enough. Rows that repeat an id and a text count once."""

    def run(texts: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        sets: dict[int, list[np.ndarray]] = {}
        held = as_list(texts["text"])
        for lo, hi in steps(held):
            words = Words(held[lo:hi], lower=True)
            for i in range(lo, hi):
                own, known = shingles(words, i - lo, size), sets.setdefault(int(texts["id"].iloc[i]), [])
                if not any(np.array_equal(own, other) for other in known):
                    known.append(own)
        a, b = pairs["a"].to_numpy(), pairs["b"].to_numpy()
        keep = np.zeros(len(pairs), dtype=bool)
        for i in range(len(pairs)):
            for x in sets.get(int(a[i]), ()):
                for y in sets.get(int(b[i]), ()):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    union = len(x) + len(y) - both
                    keep[i] |= union > 0 and times * both >= least * union
        return pd.DataFrame({"a": a[keep], "b": b[keep]})

    return run


def _sketches(size: int):
    """One bit of each of many minhashes, 64 to a column: two documents differ in about half of 1 - similarity of them."""
    multipliers = (stream(9, SKETCH_BITS) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    flips = (stream(10, SKETCH_BITS) >> np.uint64(32)).astype(np.uint32)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, ids = as_list(batch["text"]), batch["id"].to_numpy()
            for lo, hi in steps(texts):
                words = Words(texts[lo:hi], lower=True)
                sets = [shingles(words, i, size) for i in range(hi - lo)]
                full = np.flatnonzero([len(s) for s in sets])
                if not len(full):
                    continue
                every = (np.concatenate([sets[i] for i in full]) >> np.uint64(32)).astype(np.uint32)
                at = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])[:-1]])
                bits = np.empty((SKETCH_BITS, len(full)), dtype=np.uint8)
                for r in range(SKETCH_BITS):
                    low = np.minimum.reduceat((every ^ flips[r]) * multipliers[r], at)
                    bits[r] = (low * np.uint32(0x9E3779B1)) >> np.uint32(31)
                packed = np.ascontiguousarray(np.packbits(bits.T, axis=1)).view(np.int64)
                frame = {"id": ids[lo + full]} | {f"s{i}": packed[:, i] for i in range(packed.shape[1])}
                yield pd.DataFrame(frame)

    return run


def _most_different(similarity: float) -> int:
    """Bits in which two documents of that similarity may differ."""
    p = (1 - similarity) / 2
    return math.floor(SKETCH_BITS * p + STRAY * math.sqrt(SKETCH_BITS * p * (1 - p)))


def near_duplicates(docs: DataFrame, size: int = 5, similarity: Fraction | str = "4/5", part: int = PART) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for every row of ``docs`` (``doc_id``, ``text``).

    Two documents are linked if their sets of distinct ``size``-word shingles (A-Z lower-cased) have a Jaccard
    similarity of at least ``similarity``; every link is confirmed on the full sets in whole numbers.
    A component's id is its smallest doc_id, and its document is the one kept.

    Fewer words than ``size`` make one shingle; without words or text the set is empty and linked with nothing.
    Rows of one doc_id count as one document whose texts are linked. A null doc_id takes no part: its component
    is null and it is kept. Empty input gives no rows. Other columns are ignored.

    Documents with equal sets are one class and meet the tables once. In each bucket every class is compared with
    the smallest one. Documents of buckets that then still hold several components meet again in the left tables alone,
    where every pair of different components is judged: by a sketch of 2048 bits, which a similar pair fails about as
    rarely as the tables, and then on the full sets. No bucket or partner is capped.
    """
    similarity = Fraction(similarity)
    m = parts_needed(float(similarity), part)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInPandas(
        _signatures(size, m, part), "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, parts array<bigint>"
    )
    found = cut_texts(found, "signatures")
    same = ["n_shingles", "d1", "d2"]
    classes = (
        found.where("doc_id is not null and n_shingles > 0")
        .groupBy(*same)
        .agg(F.min("doc_id").alias("id"), F.max("doc_id").alias("last"), F.first("parts").alias("parts"))
    )
    classes = cut_lineage(classes, "classes")
    links = _links(classes, rows, size, similarity, m)
    joined = components(links.union(_same_document(found, classes, same)))
    moved = (
        classes.join(joined.withColumnRenamed("node", "id"), "id", "left")
        .select(*same, "id", "last", F.coalesce("component", "id").alias("component"))
        .where("last <> component")
        .select(*same, "component")
    )
    out = found.select("doc_id", *same).join(moved, same, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _same_document(found: DataFrame, classes: DataFrame, same: list[str]) -> DataFrame:
    """Links between the classes of a doc_id that holds several of them: texts that differ under one id."""
    rows = found.where("doc_id is not null and n_shingles > 0")
    several = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    held = rows.join(cut_lineage(several, "several"), "doc_id").select("doc_id", *same).distinct()
    ids = held.join(classes.select(*same, "id"), same).groupBy("doc_id")
    ends = ids.agg(F.min("id").alias("a"), F.sort_array(F.collect_set("id")).alias("ids"))
    return ends.select("a", F.explode("ids").alias("b")).where("a <> b")


def _buckets(classes: DataFrame, m: int) -> DataFrame:
    """``key``, ``id``, ``center`` (smallest id of the bucket) for all buckets of two classes or more."""
    halves = classes.select("id", F.posexplode("parts").alias("slot", "part"))
    shared = halves.groupBy("slot", "part").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("slot", "part")
    live = halves.join(shared, ["slot", "part"])
    sides = live.groupBy("id").agg(
        F.collect_list(F.when(F.col("slot") < m, F.xxhash64("slot", "part"))).alias("left"),
        F.collect_list(F.when(F.col("slot") >= m, F.xxhash64("slot", "part"))).alias("right"),
    )
    keys = sides.select("id", F.explode("left").alias("l"), "right").select("id", "l", F.explode("right").alias("r"))
    keys = cut_lineage(keys.select("id", F.xxhash64("l", "r").alias("key")), "keys")
    centers = keys.groupBy("key").agg(F.min("id").alias("center"), F.max("id").alias("far")).where("center < far")
    return keys.join(centers.select("key", "center"), "key")


def _blocks(buckets: DataFrame) -> DataFrame:
    """``id``, ``block``: at most about ``BLOCK`` documents that share the smallest center they meet."""
    homes = buckets.groupBy("id").agg(F.min("center").alias("home"))
    sizes = homes.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("slices"))
    slot = F.pmod(F.xxhash64("id"), F.col("slices"))
    return homes.join(sizes, "home").select("id", F.xxhash64("home", slot).alias("block"))


def _links(classes: DataFrame, rows: DataFrame, size: int, similarity: Fraction, m: int) -> DataFrame:
    buckets = cut_lineage(_buckets(classes, m), "buckets")
    wanted = buckets.select("id").distinct()
    texts = rows.join(wanted.withColumnRenamed("id", "doc_id"), "doc_id").select(F.col("doc_id").alias("id"), "text")
    texts = cut_lineage(texts, "texts")
    # an id may hold several texts, whose sizes make a range
    span = classes.groupBy("id").agg(F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"))
    sizes = cut_lineage(span.join(wanted, "id"), "sizes")
    places = cut_lineage(_blocks(buckets).join(sizes, "id"), "places")
    top, bottom = similarity.numerator, similarity.denominator

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Links among distinct pairs. A text goes once to each group of pairs that needs it, not to each pair."""
        possible = (
            pairs.join(places.toDF("a", "block_a", "least_a", "most_a"), "a")
            .join(places.toDF("b", "block_b", "least_b", "most_b"), "b")
            .where(F.col("most_a") * bottom >= F.col("least_b") * top)
            .where(F.col("most_b") * bottom >= F.col("least_a") * top)
        )
        possible = cut_lineage(possible.select("a", "b", F.xxhash64("block_a", "block_b").alias("cell")), "possible")
        groups = 1 + possible.count() // GROUP_PAIRS
        grouped = possible.select("a", "b", F.pmod("cell", F.lit(groups)).alias("cell"))
        needed = grouped.select("cell", F.explode(F.array("a", "b")).alias("id")).distinct()
        needed = needed.join(texts, "id").toDF("id", "cell", "text")
        found = needed.groupBy("cell").cogroup(grouped.toDF("a", "b", "of").groupBy("of"))
        return found.applyInPandas(_confirm(size, bottom, top), "a bigint, b bigint")

    pairs = buckets.where("id <> center").select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()
    tried = cut_lineage(pairs, "pairs")
    links = cut_lineage(confirmed(tried), "links")
    # what is left: documents in buckets that still hold several components
    near, turn, last = None, 0, False
    sketch = [f"s{i}" for i in range(SKETCH_BITS // 64)]
    while True:
        turn += 1
        labels = components(links).toDF("id", "component")
        if near is None:
            known = _labelled(buckets.select("key", "id"), labels)
            open_ids = cut_lineage(known.join(_mixed(known), "key").select("id").distinct(), "open")
            lefts = [F.get("parts", F.lit(i)).alias(f"p{i}") for i in range(m)]
            slots = classes.join(open_ids, "id").select("id", F.posexplode(F.slice("parts", 1, m)).alias("slot", "part"), *lefts)
            drawn = texts.join(open_ids, "id").mapInPandas(_sketches(size), ", ".join(["id bigint"] + [f"{c} bigint" for c in sketch]))
            drawn = cut_texts(drawn.join(sizes, "id"), "sketches")
            slots = slots.withColumn("key", F.xxhash64("slot", "part")).drop("part")
            near = cut_lineage(slots.join(drawn, "id"), "near")
        known = _labelled(near, labels)
        members = cut_lineage(known.join(_mixed(known), "key"), "members")
        shares = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
        heads = shares.groupBy("key").agg(F.max(F.struct("n", "component")).getField("component").alias("head"))
        outside = members.join(heads, "key").where("component <> head").drop("head")
        if not last:
            # first one drawn member of each bucket against the others: that joins most of what belongs together
            picked = F.struct(F.xxhash64("id", "key", F.lit(turn)), F.col("id"))
            chosen = members.groupBy("key").agg(F.min(picked).getField("id").alias("id"))
            outside = members.join(chosen, ["key", "id"])
        x, y = outside.alias("x"), members.alias("y")
        differ = sum((F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in sketch), F.lit(0))
        similar_size = (F.col("x.most") * bottom >= F.col("y.least") * top) & (F.col("y.most") * bottom >= F.col("x.least") * top)
        apart = F.col("x.component") != F.col("y.component")
        # a pair that meets in several tables is judged in the first of them
        for i in range(m):
            apart &= (F.col("x.slot") <= i) | (F.col(f"x.p{i}") != F.col(f"y.p{i}"))
        close = x.join(y, (F.col("x.key") == F.col("y.key")) & apart & similar_size & (differ <= _most_different(float(similarity))))
        pairs = close.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
        fresh = cut_lineage(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        more = cut_lineage(confirmed(fresh), "links")
        links, tried = links.union(more), tried.union(fresh)
        if last:
            return links
        # then all members outside a bucket's largest component against all that are not connected with them
        last = more.isEmpty() or more.count() * 100 < members.select("id").distinct().count()


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))


def _mixed(known: DataFrame) -> DataFrame:
    """Keys of the buckets that hold several components."""
    mixed = known.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return mixed.where("lo < hi").select("key")
