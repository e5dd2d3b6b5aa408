"""Removal of long byte strings that occur earlier, by merging the Burrows-Wheeler transforms of shards of the text.

**Phrases.** A text is cut at anchors: the smallest hash of 8 bytes in any run of ``reach`` places. Equal strings of
``size`` bytes are cut alike, and each holds a whole phrase, so the transform is over phrases (some 23 bytes each for
100-byte strings) instead of bytes. A shard, some megabytes of documents, keeps its phrases in text order, in which the
LF step of its transform is the step to the phrase before.

**Merging.** The merged transform is the interleave of the shards' suffixes: blocks of suffixes that share their first
t phrases, and which shards they come from. A round refines it from t to 2t: the block of a suffix and that of the
suffix t phrases on (t LF steps) make its new block. Shards send each of their blocks once, however many suffixes it
has; a block that is in one place only is a common prefix that ends there, and its suffix leaves the merge. No suffix is
ever sorted among all the others. Rounds end where the blocks are longer than what all strings of an anchor share; a
last one then compares exactly these bytes.

**Repeated intervals.** What is left are intervals of suffixes that share ``size - reach + 1`` bytes. They are split
once more by all that the strings of an anchor can see to both sides. Members of an interval part that repeats one of an
earlier document are removed as a whole; only where an interval has several parts, the first places of each part are
reopened and their single strings compared. Parts and strings are compared by BLAKE2b digests, not by the block numbers.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import NO_ID, mix, stream, windows, with_id, without_id
from tidemark.session import cut_lineage, scratch_path

SHARD_BYTES = 4 << 20
SHARD_TEXTS = 1 << 16
# Bytes of text that one vectorised step holds.
STEP = 1 << 16
# Digests that are Python objects at a time.
DIGESTS = 1 << 16
SHARDS_PER_PART = 8
ANCHOR_BYTES = 8

# Stands for documents without an id, which no other document compares with.
LAST = (1 << 63) - 1

ALIVE, COVERED, OPEN = 1, 2, 4

SHARD_SCHEMA = "shard bigint, depth int, ids binary, sizes binary, data binary, counts binary, anchors binary, runs binary"
ROUND_SCHEMA = "shard bigint, part int, body binary"


@dataclass(frozen=True)
class Cut:
    """Lengths that follow from the length of the strings."""

    size: int

    @property
    def reach(self) -> int:
        """Places of which the smallest hash is an anchor. The first and last run in a string do not overlap."""
        return (self.size - ANCHOR_BYTES + 1) // 2

    @property
    def core(self) -> int:
        """Bytes from an anchor on that all its strings hold."""
        return self.size - self.reach + 1

    @property
    def last_run(self) -> int:
        """From an anchor to the last run of places within its core."""
        return self.size - ANCHOR_BYTES - 2 * self.reach + 2


def _sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    width = 1
    while 2 * width <= size:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    rest = size - width
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def _hashes(buf: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the 8 bytes from each place on."""
    n = len(buf) - ANCHOR_BYTES + 1
    words = np.empty(n, dtype=np.uint64)
    raw = buf.tobytes()
    for shift in range(min(ANCHOR_BYTES, n)):
        part = words[shift::ANCHOR_BYTES]
        part[:] = np.frombuffer(raw, dtype="<u8", count=len(part), offset=shift)
    words *= np.uint64(0x9E3779B97F4A7C15)
    words ^= words >> np.uint64(29)
    words *= np.uint64(0xBF58476D1CE4E5B9)
    return words >> np.uint64(32)


def find_anchors(buf: np.ndarray, bounds: np.ndarray, cut: Cut) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors, and the first run that each is the smallest of; runs never cross texts."""
    reach, span = cut.reach, cut.reach + ANCHOR_BYTES - 1
    anchors, runs, last = [], [], -1
    # text number of a run's start; texts shorter than a string have no runs
    ends = np.where(np.diff(bounds) >= cut.size, bounds[1:] - span, bounds[:-1] - 1)
    for low in range(0, len(buf) - span + 1, STEP):
        high = min(low + STEP, len(buf) - span + 1)
        keys = _hashes(buf[low : high + span - 1])
        keys <<= np.uint64(32)
        keys |= np.arange(len(keys), dtype=np.uint64)
        best = low + (_sliding_min(keys, reach) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        starts = np.arange(low, high)
        text = np.searchsorted(bounds, starts, side="right") - 1
        inside = starts <= ends[text]
        best, starts = best[inside], starts[inside]
        if len(best):
            new = np.flatnonzero(np.diff(best, prepend=last))
            anchors.append(best[new])
            runs.append(starts[new])
            last = best[-1]
    if not anchors:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(anchors), np.concatenate(runs)


def _packed(values: np.ndarray) -> bytes:
    """Rising numbers as steps, which compress well."""
    return np.diff(values, prepend=0).astype(np.int32).tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(blob, np.int32), dtype=np.int64)


class Shard:
    """The texts of a shard with their anchors. ``alive``, ``covered`` and ``open`` are flags of anchors in a state."""

    def __init__(self, row, cut: Cut):
        self.cut, self.number = cut, int(row["shard"])
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.data = row["data"]
        self.buf = np.frombuffer(self.data, np.uint8)
        self.bounds = np.concatenate([[0], np.cumsum(np.frombuffer(row["sizes"], np.int64))])
        self.anchors, self.runs = _unpacked(row["anchors"]), _unpacked(row["runs"])
        self.row = np.repeat(np.arange(len(self.ids)), np.frombuffer(row["counts"], np.int32))
        self.ends = self.bounds[1:][self.row]
        n = len(self.anchors)
        # first and last string of each anchor
        self.low = self.runs
        after = np.append(self.runs[1:], 0) - 1
        final = np.append(self.row[1:] != self.row[:-1], True) if n else np.empty(0, bool)
        after[final] = self.ends[final]
        self.high = np.minimum(after, self.ends - cut.size)
        self.owns = self.low <= self.high
        # phrases of the core that are cut alike wherever the core occurs
        self.depth = np.searchsorted(self.runs, self.anchors + cut.last_run, side="right") - 1 - np.arange(n)
        ids = np.where(self.ids == NO_ID, LAST, self.ids)
        self.docs = ids[self.row] if n else np.empty(0, np.int64)

    @cached_property
    def phrases(self) -> np.ndarray:
        """A number for the bytes from each anchor to the next."""
        n, at = len(self.anchors), self.anchors
        out = np.empty(n, np.uint64)
        letters, powers = stream(5, 256), np.cumprod(np.full(64, stream(6, 1)[0] | np.uint64(1), dtype=np.uint64))
        first = 0
        while first < n:
            last = max(first + 1, int(np.searchsorted(at, at[first] + STEP)))
            start, end = at[first], at[last] if last < n else len(self.buf)
            # beyond a text's last anchor no phrase is asked for
            end = min(end, at[last - 1] + 4096)
            lengths = np.diff(at[first:last], append=end)
            place = np.arange(end - start) - np.repeat(at[first:last] - start, lengths)
            sums = letters[self.buf[start:end]] * powers[place & 63]
            out[first:last] = mix(np.add.reduceat(sums, at[first:last] - start) + lengths.astype(np.uint64))
            first = last
        return out

    def blocks(self, which: np.ndarray, t: int) -> np.ndarray:
        """Block of the suffixes at some anchors by their first t phrases."""
        return windows(self.phrases, t)[which] if len(which) else np.empty(0, np.uint64)

    def cores(self, which: np.ndarray) -> np.ndarray:
        """Block by the bytes of the core."""
        length = self.cut.core
        out = np.empty(len(which), np.uint64)
        for start in range(0, len(which), 1 << 14):
            at = self.anchors[which[start : start + (1 << 14)]]
            rows = np.zeros((len(at), -(-length // 8) * 8), np.uint8)
            rows[:, :length] = self.buf[at[:, None] + np.arange(length)]
            words = rows.view(np.uint64)
            h = np.full(len(at), length, np.uint64)
            for column in words.T:
                h = mix((h ^ column) * np.uint64(0xD1342543DE82EF95))
            out[start : start + len(at)] = h
        return out

    def parts(self, which: np.ndarray) -> np.ndarray:
        """Digest of all that the strings of an anchor see, and where the anchor stands in it."""
        data, size = memoryview(self.data), self.cut.size
        out = np.empty(len(which), np.uint64)
        for start in range(0, len(which), DIGESTS):
            part = which[start : start + DIGESTS]
            sides = (self.low[part].tolist(), (self.high[part] + size).tolist(), (self.anchors - self.low)[part].tolist())
            digests = [
                hashlib.blake2b(data[a:b], digest_size=8, salt=j.to_bytes(8, "little")).digest()
                for a, b, j in zip(*sides, strict=True)
            ]
            out[start : start + len(part)] = np.frombuffer(b"".join(digests), np.uint64)
        return out

    def strings(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of all strings of some anchors, and both halves of their digests."""
        lengths = (self.high - self.low + 1)[which]
        starts = np.repeat(self.low[which] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        data, size = memoryview(self.data), self.cut.size
        halves = np.empty((len(starts), 2), np.uint64)
        for first in range(0, len(starts), DIGESTS):
            part = starts[first : first + DIGESTS].tolist()
            digests = [hashlib.blake2b(data[s : s + size], digest_size=16).digest() for s in part]
            halves[first : first + len(part)] = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
        return starts, halves[:, 0], halves[:, 1]


# --- what a shard sends in a round and what it makes of the answer


def _part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int32)


def _sent(shard: Shard, keys: np.ndarray, columns: list[np.ndarray], flags: np.ndarray, parts: int) -> pd.DataFrame:
    """Sorted columns by part of their first one, and the state of the shard, which comes back with the answers."""
    part = _part_of(keys, parts)
    edges = np.flatnonzero(np.diff(part, prepend=-1, append=parts))
    rows = [
        (shard.number, int(part[a]), b"".join(c[a:b].tobytes() for c in columns))
        for a, b in zip(edges[:-1], edges[1:], strict=True)
    ]
    rows.append((shard.number, -1 - shard.number % parts, flags.tobytes()))
    return pd.DataFrame(rows, columns=["shard", "part", "body"])


@dataclass(frozen=True)
class Places:
    """Things of a shard that are compared by a key of two numbers: the distinct keys, and the least id of each."""

    inverse: np.ndarray
    first: np.ndarray
    second: np.ndarray
    least: np.ndarray
    later: np.ndarray  # an equal thing of the same row starts earlier

    @classmethod
    def of(cls, first, second, docs, row, start) -> Places:
        order = np.lexsort((start, row, second, first))
        a, b, r = first[order], second[order], row[order]
        same = np.zeros(len(order), bool)
        same[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        heads = np.flatnonzero(~same)
        inverse = np.empty(len(order), np.int64)
        inverse[order] = np.cumsum(~same) - 1
        later = np.empty(len(order), bool)
        later[order] = same & np.concatenate([[False], r[1:] == r[:-1]])[: len(order)]
        least = np.minimum.reduceat(docs[order], heads) if len(order) else docs
        return cls(inverse, a[heads], b[heads], least, later)

    def removed(self, codes: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Things that a smaller document holds too, or the same row further up."""
        known = docs != LAST
        return (known & ((codes[self.inverse] & 1 > 0) | (docs > self.least[self.inverse]))) | self.later


def _answer(right: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """State flags, and an answer per key in order of the keys."""
    flags = np.frombuffer(right.loc[right["part"] < 0, "body"].iloc[0], np.uint8)
    answers = right[right["part"] >= 0].sort_values("part")["body"]
    return flags.copy(), np.frombuffer(b"".join(answers), np.uint8)


def _in_round(shard: Shard, flags: np.ndarray, t: int) -> np.ndarray:
    return np.flatnonzero((flags & ALIVE > 0) & (shard.depth >= t))


def _blocks_sent(shard: Shard, flags: np.ndarray, t: int | None, parts: int) -> pd.DataFrame:
    """The blocks of a round; ``t`` is a number of phrases, or None for the core."""
    which = _in_round(shard, flags, t or 0)
    keys = np.unique(shard.cores(which) if t is None else shard.blocks(which, t))
    return _sent(shard, keys, [keys], flags, parts)


def _after_blocks(shard: Shard, right: pd.DataFrame, t: int | None) -> np.ndarray:
    """Flags after a round: suffixes alone in their block are out."""
    flags, answers = _answer(right)
    which = _in_round(shard, flags, t or 0)
    blocks = shard.cores(which) if t is None else shard.blocks(which, t)
    _, inverse, counts = np.unique(blocks, return_inverse=True, return_counts=True)
    flags[which[~((answers > 0) | (counts > 1))[inverse]]] = 0
    return flags


def _parts(shard: Shard, flags: np.ndarray) -> tuple[np.ndarray, Places]:
    which = np.flatnonzero(flags & ALIVE)
    places = Places.of(shard.cores(which), shard.parts(which), shard.docs[which], shard.row[which], shard.anchors[which])
    return which, places


def _parts_sent(shard: Shard, flags: np.ndarray, parts: int) -> pd.DataFrame:
    _, p = _parts(shard, flags)
    return _sent(shard, p.first, [p.first, p.second, p.least], flags, parts)


def _after_parts(shard: Shard, right: pd.DataFrame) -> np.ndarray:
    flags, codes = _answer(right)
    which, p = _parts(shard, flags)
    removed = p.removed(codes, shard.docs[which])
    flags[which[removed]] |= COVERED
    flags[which[~removed & (codes[p.inverse] & 2 > 0)]] |= OPEN
    return flags


def _strings(shard: Shard, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, Places]:
    which = np.flatnonzero(flags & OPEN)
    starts, first, second = shard.strings(which)
    owner = np.repeat(which, (shard.high - shard.low + 1)[which])
    return starts, shard.docs[owner], Places.of(first, second, shard.docs[owner], shard.row[owner], starts)


def _strings_sent(shard: Shard, flags: np.ndarray, parts: int) -> pd.DataFrame:
    _, _, p = _strings(shard, flags)
    return _sent(shard, p.first, [p.first, p.second, p.least], flags, parts)


def _texts_left(shard: Shard, right: pd.DataFrame) -> pd.DataFrame:
    """The documents of a shard without what was found to be repeated."""
    flags, codes = _answer(right)
    starts, docs, p = _strings(shard, flags)
    gone = starts[p.removed(codes, docs)]
    covered = np.flatnonzero(flags & COVERED)
    edges = np.zeros(len(shard.buf) + 1, np.int32)
    np.add.at(edges, np.concatenate([gone, shard.low[covered]]), 1)
    np.add.at(edges, np.concatenate([gone, shard.high[covered]]) + shard.cut.size, -1)
    removed = np.cumsum(edges[:-1], dtype=np.int32) > 0
    rows = []
    for i, doc_id in enumerate(shard.ids):
        a, b = int(shard.bounds[i]), int(shard.bounds[i + 1])
        part = removed[a:b]
        n = int(part.sum())
        spans = int(np.count_nonzero(part[1:] & ~part[:-1])) + int(n > 0 and part[0])
        kept = shard.buf[a:b][~part].tobytes() if n else shard.data[a:b]
        rows.append((int(doc_id), b - a, n, spans, kept))
    return pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


# --- what is made of the shards' blocks where they meet


def _split(group: pd.DataFrame, columns: int) -> tuple[list[np.ndarray], list[int]]:
    bodies = [np.frombuffer(b, np.uint64).reshape(columns, -1) for b in group["body"]]
    return [np.concatenate([b[i] for b in bodies]) for i in range(columns)], [b.shape[1] for b in bodies]


def _answers(group: pd.DataFrame, codes: np.ndarray, sizes: list[int]) -> pd.DataFrame:
    ends = np.cumsum(sizes)
    bodies = [codes[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)]
    return pd.DataFrame({"shard": group["shard"], "part": group["part"], "body": bodies})


def _meeting_blocks(group: pd.DataFrame) -> pd.DataFrame:
    """Whether another shard has the block too."""
    if group["part"].iloc[0] < 0:
        return group
    (keys,), sizes = _split(group, 1)
    order = np.argsort(keys)
    equal = np.zeros(len(keys) + 1, bool)
    equal[1:-1] = keys[order[1:]] == keys[order[:-1]]
    codes = np.empty(len(keys), bool)
    codes[order] = equal[:-1] | equal[1:]
    return _answers(group, codes, sizes)


def _meeting_places(group: pd.DataFrame) -> pd.DataFrame:
    """Bit 1: a smaller document has the key; bit 2: the first half of the key has several second halves."""
    if group["part"].iloc[0] < 0:
        return group
    (first, second, docs), sizes = _split(group, 3)
    docs = docs.view(np.int64)
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new_first = np.concatenate([[True], a[1:] != a[:-1]])
    new = new_first | np.concatenate([[True], b[1:] != b[:-1]])
    least = np.minimum.reduceat(docs[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    kinds = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_first))[np.cumsum(new_first) - 1]
    here = docs[order]
    codes = np.empty(len(order), np.uint8)
    codes[order] = ((least < here) & (here != LAST)) + 2 * (kinds > 1)
    return _answers(group, codes, sizes)


# --- the job


def build_shards(documents: DataFrame, cut: Cut, name: str) -> DataFrame:
    """Documents as shards with their anchors, written once, in buckets by shard, so that later rounds move answers only."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, texts, held, number = [], [], 0, TaskContext.get().partitionId() << 32

        def shard() -> pd.DataFrame:
            data = b"".join(texts)
            sizes = np.array([len(t) for t in texts], np.int64)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            anchors, runs = find_anchors(np.frombuffer(data, np.uint8), bounds, cut)
            counts = np.bincount(np.searchsorted(bounds, anchors, side="right") - 1, minlength=len(texts))
            row = {
                "shard": number,
                "depth": 0,
                "ids": np.array(ids, np.int64).tobytes(),
                "sizes": sizes.tobytes(),
                "data": data,
                "counts": counts.astype(np.int32).tobytes(),
                "anchors": _packed(anchors),
                "runs": _packed(runs),
            }
            built = Shard(row, cut)
            row["depth"] = int(built.depth[built.owns].max(initial=0))
            return pd.DataFrame([row])

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids.append(doc_id)
                texts.append(text if isinstance(text, bytes) else b"")
                held += len(texts[-1])
                if held >= SHARD_BYTES or len(ids) >= SHARD_TEXTS:
                    yield shard()
                    ids, texts, number, held = [], [], number + 1, 0
        if ids:
            yield shard()

    spark = documents.sparkSession
    rows = documents.select(with_id("doc_id"), F.col("text").cast("binary").alias("text"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = rows.mapInPandas(build, SHARD_SCHEMA).write.bucketBy(buckets, "shard").option("compression", "zstd")
    writer.option("path", scratch_path(spark, "shards")).saveAsTable(name)
    return spark.table(name)


def _round(
    shards: DataFrame,
    before: DataFrame | None,
    cut: Cut,
    send: Callable[[Shard, pd.DataFrame | None], pd.DataFrame],
    meet: Callable[[pd.DataFrame], pd.DataFrame],
    name: str,
) -> DataFrame:
    """One exchange: shards send keys by part, keys meet in their part, answers are written for the shards."""
    if before is None:

        def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for _, row in batch.iterrows():
                    yield send(Shard(row, cut), None)

        sent = shards.mapInPandas(first, ROUND_SCHEMA)
    else:

        def later(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            return send(Shard(left.iloc[0], cut), right)

        both = shards.groupBy("shard").cogroup(before.groupBy("shard"))
        sent = both.applyInPandas(later, ROUND_SCHEMA)
    return cut_lineage(sent.groupBy("part").applyInPandas(meet, ROUND_SCHEMA), name)


def remove_repeats(documents: DataFrame, size: int = 100) -> DataFrame:
    """Each document without the bytes covered by a string of ``size`` bytes that also starts earlier.

    Earlier is in a document of smaller ``doc_id``, or further up in the same row. Strings are judged on the input,
    overlaps count, and no string crosses documents. Returns ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``
    (maximal removed runs) and ``kept`` (binary: cuts may split a character). A null text is empty; texts shorter than
    ``size`` stay whole. Rows that repeat a doc_id are each judged, and none of them is earlier than another. Rows with
    a null doc_id are compared with themselves only. Other columns are ignored; no rows give none.
    """
    if size < ANCHOR_BYTES + 2:
        raise ValueError(f"strings need at least {ANCHOR_BYTES + 2} bytes")
    spark, cut = documents.sparkSession, Cut(size)
    name = f"shards_{uuid.uuid4().hex}"
    try:
        return _merged(build_shards(documents, cut, name), cut)
    finally:
        # its files stay, the result reads them
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _merged(shards: DataFrame, cut: Cut) -> DataFrame:
    spark = shards.sparkSession
    known = shards.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max("depth"), F.lit(0)).alias("depth")).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-known["n"] // SHARDS_PER_PART))
    # the merge doubles its phrases while some core holds as many; its last round is the core itself
    rounds: list[int | None] = [1 << i for i in range(known["depth"].bit_length())]
    rounds.append(None)
    answers = None
    for k, t in enumerate(rounds):

        def blocks(shard: Shard, right: pd.DataFrame | None, t: int | None = t, k: int = k) -> pd.DataFrame:
            if right is None:
                flags = np.where(shard.owns, ALIVE, 0).astype(np.uint8)
            else:
                flags = _after_blocks(shard, right, rounds[k - 1])
            return _blocks_sent(shard, flags, t, parts)

        answers = _round(shards, answers, cut, blocks, _meeting_blocks, f"blocks{t or 'core'}")

    def interval_parts(shard: Shard, right: pd.DataFrame) -> pd.DataFrame:
        return _parts_sent(shard, _after_blocks(shard, right, None), parts)

    def strings(shard: Shard, right: pd.DataFrame) -> pd.DataFrame:
        return _strings_sent(shard, _after_parts(shard, right), parts)

    def finish(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _texts_left(Shard(left.iloc[0], cut), right)

    answers = _round(shards, answers, cut, interval_parts, _meeting_places, "parts")
    answers = _round(shards, answers, cut, strings, _meeting_places, "strings")
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    out = shards.groupBy("shard").cogroup(answers.groupBy("shard")).applyInPandas(finish, schema)
    return out.withColumn("doc_id", without_id("doc_id"))
