"""Documents as token sequences of a fixed length, packed by bulk-synchronous best fit.

Lengths are whole numbers of at most the capacity, so sorting pieces and gaps by size means sorting at most
``capacity`` classes, and a piece's place in that order is its class and its rank within the class. A sweep takes the
largest class still open and its successor among the gaps (the smallest gap that holds it), matches rank by rank as
many pieces as there are such gaps, updates these gaps and repeats; what finds no gap opens new sequences. A sweep
handles all pieces of a class at once, so their number is bounded by the capacity and does not grow with the data.
Spark counts the classes, ranks the pieces in slices of a class, and joins each piece with the sweep that placed it.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import types
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import as_list, with_id, without_id
from tidemark.session import cut_texts

CAPACITY = 2048
SEPARATOR = 0
# Pieces that one slice of a size class holds on average when ranks are given.
SLICE_ROWS = 50_000
# Characters that are merged at once: their ids are Python numbers for a moment.
MERGED_CHARS = 1 << 16
# Words of texts in other scripts whose ids a worker remembers, and the longest such word.
MEMORY_WORDS = 1 << 16
MEMORY_LENGTH = 48


# White space next to a space, where the tokenizer looks across the space.
_WHITE = [c for c in map(chr, range(0x3001)) if c.isspace()]
_ASCII_PAIRS = [pair for c in _WHITE if c.isascii() for pair in {" " + c, c + " "}]
_OTHER_PAIRS = [pair for c in _WHITE if not c.isascii() for pair in (" " + c, c + " ")]
# Words of ASCII and these letters are split alike by every version of Unicode.
_LATIN = re.compile("[\\x00-\\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next free one."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class _Encoder(dict):
    """Ids of texts; as a dictionary, ids of a word with the space before it, remembered.

    The tokenizer splits at white space and never joins what lies on both sides of it, except that one space goes
    with the word after it; so the ids of a text without double white space are those of its parts between spaces in
    order. Parts of plain letters are merged by a faster library from the same vocabulary, if the file is byte-level
    with the usual pattern and its merges are in order of id. It remembers nothing, so a worker's memory does not grow
    with the words of the corpus. Only texts with other letters are taken word by word. The tokenizer itself is loaded
    when a text needs it.
    """

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        self.special = [t["content"] for t in whole.get("added_tokens") or ()]
        self.merge = self._merger(whole)

    @cached_property
    def tokenizer(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def _merger(self, whole: dict):
        model, split = whole["model"], whole["pre_tokenizer"] or {}
        vocabulary, letters = model["vocab"], _byte_letters()
        pairs = ("".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model.get("merges", ()))
        usual = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        if not usual or whole["normalizer"] or any(vocabulary.get(pair) != 256 + i for i, pair in enumerate(pairs)):
            return None
        special = set(self.special)
        ranks = {bytes(letters[c] for c in t): i for t, i in vocabulary.items() if t not in special}
        return tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def plain(self, text: str) -> bool:
        return self.merge is not None and (text.isascii() or _LATIN.fullmatch(text) is not None)

    def merged(self, text: str) -> bytes:
        ids = self.merge.encode_ordinary(text)
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, word: str) -> bytes:
        found = self.merged(" " + word) if self.plain(word) else self.ids(" " + word)
        if len(word) <= MEMORY_LENGTH:
            if len(self) >= MEMORY_WORDS:
                self.clear()
            self[word] = found
        return found

    def text(self, text: str) -> bytes:
        unsafe = any(pair in text for pair in _ASCII_PAIRS) or any(t in text for t in self.special)
        if unsafe or (not text.isascii() and any(pair in text for pair in _OTHER_PAIRS)):
            return self.ids(text)
        if self.plain(text):
            parts, start = [], 0
            while start < len(text):
                end = text.find(" ", start + MERGED_CHARS)
                end = len(text) if end < 0 else end
                parts.append(self.merged(text[start:end]))
                start = end
            return b"".join(parts)
        words = text.split(" ")
        return self.ids(words[0]) + b"".join(map(self.__getitem__, words[1:]))


def _encoder(path: str) -> _Encoder:
    """The encoder of this worker process, which serves all its tasks."""
    memory = sys.modules.setdefault("_tidemark_worker", types.ModuleType("_tidemark_worker")).__dict__
    encoders = memory.setdefault("encoders", {})
    if path not in encoders:
        encoders[path] = _Encoder(path)
    return encoders[path]


def _pieces(path: str, capacity: int, separator: int, with_ids: bool):
    end = np.asarray([separator], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(path)
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"].array, as_list(batch["text"]), strict=True):
                ids = (encoder.text(text) if text else b"") + end
                total = len(ids) // 4
                start, length = 0, (total - 1) % capacity + 1
                piece = 0
                while start < total:
                    part = ids[4 * start : 4 * (start + length)]
                    rows.append((doc, piece, start, length, zlib.crc32(part), part if with_ids else None))
                    start, length, piece = start + length, capacity, piece + 1
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return run


def token_pieces(
    docs: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    separator: int = SEPARATOR,
    with_ids: bool = True,
) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``ids`` (little-endian unsigned 32 bits).

    A document's ids end with ``separator``; only documents of more than ``capacity`` ids are cut, and only their
    first piece may be shorter. Null text counts as empty: one piece with the separator alone.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    rows = docs.select(with_id(), F.col("text").cast("string").alias("text"))
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"
    pieces = rows.mapInPandas(_pieces(path, capacity, separator, with_ids), schema)
    return pieces.withColumn("doc_id", without_id())


def sweeps(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit over whole size classes: ``(length, first rank, end rank, first sequence, offset)`` per match.

    ``counts`` has the number of pieces per length. Sequences of equal gap form ranges of numbers.
    """
    placed = []
    gaps: list[int] = []
    free: dict[int, list[tuple[int, int]]] = {}
    used = 0

    def release(gap: int, first: int, number: int) -> None:
        if gap and number:
            if gap not in free:
                insort(gaps, gap)
                free[gap] = []
            free[gap].append((first, number))

    for length in sorted(counts, reverse=True):
        rank, total = 0, counts[length]
        while rank < total:
            at = bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                first, number = free[gap].pop()
                if not free[gap]:
                    del free[gap]
                    gaps.pop(at)
                taken = min(number, total - rank)
                placed.append((length, rank, rank + taken, first, capacity - gap))
                release(gap - length, first, taken)
                release(gap, first + taken, number - taken)
                rank += taken
                continue
            each = capacity // length
            full, rest = divmod(total - rank, each)
            for k in range(each if full else 0):
                placed.append((length, rank, rank + full, used, k * length))
                rank += full
            release(capacity - each * length, used, full)
            used += full
            for k in range(rest):
                placed.append((length, rank, rank + 1, used, k * length))
                rank += 1
            release(capacity - rest * length, used, 1 if rest else 0)
            used += 1 if rest else 0
    return placed


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    Sequences are gapless from offset 0. Ties within a length go by a hash of the row, and equal rows are
    interchangeable. Only counts per length reach the driver, at most ``capacity`` numbers.
    """
    spark = pieces.sparkSession
    columns = pieces.columns
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slices = 1 + sum(counts.values()) // SLICE_ROWS
    sliced = pieces.withColumn("_order", F.xxhash64(*columns)).withColumn("_slice", F.pmod("_order", F.lit(slices)))
    sizes = sliced.groupBy("length", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("length", "_slice").orderBy("_order")
    ranked = sliced.withColumn("_row", F.row_number().over(inside)).join(bases, ["length", "_slice"])
    ranked = ranked.withColumn("_rank", F.col("_base") + F.col("_row") - 1)
    matches = spark.createDataFrame(
        pd.DataFrame(sweeps(counts, capacity), columns=["length", "_first", "_end", "_sequence", "offset"], dtype="int64"),
        "length bigint, _first bigint, _end bigint, _sequence bigint, offset bigint",
    )
    in_range = (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_end"))
    joined = ranked.alias("r").join(matches.alias("m"), (F.col("r.length") == F.col("m.length")) & in_range)
    return joined.select(
        *[F.col(f"r.{c}") for c in columns],
        (F.col("_sequence") + F.col("_rank") - F.col("_first")).alias("sequence_id"),
        F.col("offset"),
    )


def best_fit(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, separator: int = SEPARATOR, with_ids: bool = True
) -> DataFrame:
    """Every piece of every document with its ``sequence_id`` and ``offset``.

    Null and empty texts are one piece of one id. Repeated rows are packed each. A null doc_id stays null.
    Empty input gives no rows. Other columns are ignored. Pieces are written once, so texts are tokenized once.
    """
    pieces = token_pieces(docs, path, capacity, separator, with_ids)
    return pack(cut_texts(pieces if with_ids else pieces.drop("ids"), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id``, ``ids``: the pieces of each sequence, joined in order of their offsets."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda held, part: F.concat(held, part["ids"]))
    return parts.select("sequence_id", joined.alias("ids"))
