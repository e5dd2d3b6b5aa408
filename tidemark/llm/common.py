"""Shared by the operators of this folder: word hashing in numpy, ids of groups, small helpers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

# White space that separates words: space, and the bytes 0x09 to 0x0D.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

# For comparisons that overlook punctuation: every ASCII byte but letters and digits.
_MARKS = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])

# Characters of text that one vectorised step holds, so that its arrays stay in the cache; a longer document is a step of
# its own.
STEP_BYTES = 1 << 17


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed 64-bit numbers of a seed."""
    steps_ = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    return mix(steps_ + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))


# Letters of a word that have table columns of their own.
LETTERS = 32

_TABLES: dict[int, np.ndarray] = {}


def _letter_numbers(letters: np.ndarray, place: np.ndarray, seed: int) -> np.ndarray:
    """A number per letter and its place in the word, unrelated between letters and between places.

    Sums of these tell words apart whatever their letters are; powers of one base would not, modulo 2^64.
    """
    if seed not in _TABLES:
        _TABLES[seed] = stream(seed + 77, LETTERS * 256)
    out = _TABLES[seed][((place & (LETTERS - 1)) << 8) | letters]
    far = np.flatnonzero(place >= LETTERS)
    if len(far):
        out[far] = mix(out[far] + (place[far] // LETTERS).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out


def join_words(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit number for two in this order."""
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + (b ^ np.uint64(0xC2B2AE3D27D4EB4F)))


class Words:
    """The words of several texts: 64-bit hashes in order, and where each text's words begin.

    A word is a longest run of bytes other than the six white-space ones; with ``marks`` ASCII punctuation
    separates words too. ``None`` has no words.
    """

    def __init__(self, texts: Sequence[str | None], lower: bool = False, seed: int = 1, marks: bool = False):
        blobs = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
        data = b"\n".join(blobs) + b"\n"
        # bytes.lower() changes A-Z only
        buf = np.frombuffer(data.lower() if lower else data, dtype=np.uint8)
        space = (_MARKS if marks else _SPACE)[buf]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(buf) and not space[0]:
            edge = np.concatenate([[0], edge])
        starts, ends = edge[0::2], edge[1::2]
        sizes = np.fromiter((len(b) + 1 for b in blobs), dtype=np.int64, count=len(blobs))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        self.first = np.searchsorted(starts, bounds)
        self.hashes = np.empty(0, dtype=np.uint64)
        if len(starts):
            lengths = ends - starts
            at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(at, lengths)
            letters = _letter_numbers(buf[~space], place, seed)
            self.hashes = mix(np.add.reduceat(letters, at) + lengths.astype(np.uint64))

    def count(self, i: int) -> int:
        return int(self.first[i + 1] - self.first[i])

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.first[i] : self.first[i + 1]]


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit number for every run of ``size`` neighbours, by doubling."""
    if len(hashes) < size:
        return np.empty(0, dtype=np.uint64)
    out, done, power, width = None, 0, hashes, 1
    while True:
        if size & width:
            if out is None:
                out = power
            else:
                n = len(hashes) - done - width + 1
                out = join_words(out[:n], power[done : done + n])
            done += width
        if done == size:
            return out[: len(hashes) - size + 1]
        power = join_words(power[:-width], power[width:]) if len(power) > width else power[:0]
        width *= 2


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def steps(texts: Sequence[str | None], limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``limit`` characters each, or one text."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = 0 if t is None else len(t)
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


# Stands for a null id while rows are in pandas, where a column of whole numbers with gaps would turn into floats.
NO_ID = -(1 << 63)


def with_id(name: str = "doc_id") -> Column:
    """The id as a whole number, ``NO_ID`` for null."""
    return F.coalesce(F.col(name).cast("bigint"), F.lit(NO_ID).cast("bigint")).alias(name)


def without_id(name: str = "doc_id") -> Column:
    """The id again, null for ``NO_ID``."""
    return F.nullif(F.col(name), F.lit(NO_ID).cast("bigint")).alias(name)


def as_list(column: pd.Series) -> list:
    """Texts of a pandas column, missing ones as None."""
    return [t if isinstance(t, str) else None for t in column]


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``(a, b)`` rows: ``node``, ``component`` (its smallest node).

    Each round takes the smallest label among neighbours, then that label's own label. Rounds are
    written tables, so a lost executor repeats one round at most. Sums of a hot node are combined
    before the shuffle and its join rows can be split.
    """
    spark = links.sparkSession
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
    edges = cut_lineage(both.where("node <> other").distinct(), "edges")
    labels = cut_lineage(edges.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("component")), "labels")
    while True:
        seen = edges.join(labels.select(F.col("node").alias("other"), "component"), "other")
        least = seen.groupBy("node").agg(F.min("component").alias("near"))
        lower = labels.join(least, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("component")
        )
        parent = labels.select(F.col("node").alias("component"), F.col("component").alias("root"))
        jumped = lower.join(parent, "component", "left").select(
            "node", "before", F.least("component", F.coalesce("root", "component")).alias("component")
        )
        jumped = cut_lineage(jumped, "labels")
        labels = jumped.select("node", "component")
        if jumped.where("component <> before").isEmpty():
            return labels


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
