"""Removal of long passages that repeat across documents, by a compacted De Bruijn graph of word windows.

Every window of 50 consecutive words is an edge of the graph, from its first 49 words to its last 49. A window's
anchor is the smallest hash among the 16-word runs in it, so equal windows have equal anchors, and neighbours mostly
share one. Windows of a document that follow each other and share their anchor are compacted into one path before
anything is shuffled, about one row per 18 windows. Only paths whose anchor occurs in several documents go on. A path
whose anchor has one content only is unbranched: all of it repeats or nothing. Where an anchor has several contents
the paths branch; each distinct content is then reopened wherever its first document has it, and single windows are
compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Words, as_list, join_words, mix, signed, steps, windows, with_id, without_id
from tidemark.session import cut_lineage

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    width = 1
    while 2 * width <= size:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    rest = size - width
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def _anchor_size(window: int) -> int:
    return max(1, window // 3)


def _windows_of(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, place in the text, hash and anchor of each window of several texts."""
    n = len(words.hashes) - window + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),) * 2
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    whole = np.flatnonzero(text[:n] == text[window - 1 :])
    hashes = windows(words.hashes, window)[whole]
    size = _anchor_size(window)
    anchors = _sliding_min(windows(mix(words.hashes ^ _STEP), size), window - size + 1)[whole]
    own = text[whole]
    return own, whole - words.first[own], hashes, anchors


def _runs(own: np.ndarray, place: np.ndarray, hashes: np.ndarray, anchors: np.ndarray):
    """First window, number of windows and content of each path."""
    new = np.ones(len(own), dtype=bool)
    new[1:] = (own[1:] != own[:-1]) | (place[1:] != place[:-1] + 1) | (anchors[1:] != anchors[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.concatenate([at, [len(own)]]))
    inside = (np.arange(len(own)) - np.repeat(at, count)).astype(np.uint64)
    total = np.add.reduceat(mix(hashes + inside * _STEP), at) if len(at) else np.empty(0, np.uint64)
    return at, count, join_words(total, count.astype(np.uint64))


def _paths(window: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = as_list(batch["text"])
            ids, keys = batch["doc_id"].to_numpy(), batch["text_key"].to_numpy()
            for lo, hi in steps(texts):
                own, place, hashes, anchors = _windows_of(Words(texts[lo:hi]), window)
                at, count, content = _runs(own, place, hashes, anchors)
                row = own[at] + lo
                yield pd.DataFrame(
                    {
                        "doc_id": ids[row],
                        "text_key": keys[row],
                        "anchor": signed(anchors[at]),
                        "content": signed(content),
                        "start": place[at].astype(np.int32),
                        "n": count.astype(np.int32),
                    }
                )

    return run


def _reopened(window: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = as_list(batch["text"])
            ids, keys = batch["doc_id"].to_numpy(), batch["text_key"].to_numpy()
            starts, counts = batch["starts"], batch["counts"]
            for lo, hi in steps(texts):
                words = Words(texts[lo:hi])
                own, place, hashes, anchors = _windows_of(words, window)
                first = np.searchsorted(own, np.arange(hi - lo))
                picked = [
                    np.arange(s, s + c) + first[i - lo]
                    for i in range(lo, hi)
                    for s, c in zip(starts.iloc[i], counts.iloc[i], strict=True)
                ]
                if picked:
                    at = np.concatenate(picked)
                    row = own[at] + lo
                    yield pd.DataFrame(
                        {
                            "doc_id": ids[row],
                            "text_key": keys[row],
                            "anchor": signed(anchors[at]),
                            "hash": signed(hashes[at]),
                            "start": place[at].astype(np.int32),
                        }
                    )

    return run


def _without(window: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept, total, gone = [], [], []
            for text, starts, counts in zip(as_list(batch["text"]), batch["starts"], batch["counts"], strict=True):
                # bytes.split() splits at the six white-space bytes
                words = [] if text is None else text.encode("utf-8", "surrogatepass").split()
                total.append(len(words))
                if starts is None or not len(starts):
                    gone.append(0)
                else:
                    change = np.zeros(len(words) + 1, dtype=np.int64)
                    begin = np.asarray(starts, dtype=np.int64)
                    np.add.at(change, begin, 1)
                    np.add.at(change, begin + np.asarray(counts, dtype=np.int64) + window - 1, -1)
                    keep = np.cumsum(change[:-1]) == 0
                    gone.append(int(len(words) - keep.sum()))
                    words = list(compress(words, keep.tolist()))
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pd.DataFrame({"doc_id": batch["doc_id"].array, "n_words": total, "n_removed": gone, "kept_text": kept})

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def repeated_windows(docs: DataFrame, window: int = 50) -> DataFrame:
    """``doc_id``, ``text_key``, ``start``, ``n``: runs of ``n`` windows, from word ``start`` on, that also start in
    a document with a smaller doc_id. ``text_key`` tells texts of one doc_id apart. Runs may overlap in words."""
    rows = _keyed(docs.where("doc_id is not null"))
    schema = "doc_id bigint, text_key bigint, anchor bigint, content bigint, start int, n int"
    runs = cut_lineage(rows.mapInPandas(_paths(window), schema), "paths")
    shared = runs.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    live = cut_lineage(runs.join(shared.select("anchor"), "anchor"), "live")
    paths = live.groupBy("anchor", "content").agg(
        F.min(F.struct("doc_id", "text_key", "start")).alias("source"), F.max("doc_id").alias("last"), F.first("n").alias("n")
    )
    paths = cut_lineage(paths.select("anchor", "content", "source.*", "last", "n"), "compact")
    copied = paths.where("doc_id < last").select("anchor", "content", F.col("doc_id").alias("source"))
    whole = live.join(copied, ["anchor", "content"]).where("doc_id > source").select("doc_id", "text_key", "start", "n")
    forks = paths.groupBy("anchor").agg(F.min("content").alias("lo"), F.max("content").alias("hi")).where("lo < hi")
    branching = paths.join(forks.select("anchor"), "anchor").select("anchor", "content", "doc_id")
    # a document may hold a content several times, and windows of each place are judged
    sources = live.join(branching, ["anchor", "content", "doc_id"])
    places = sources.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "n")).alias("at"))
    places = places.select("doc_id", "text_key", F.col("at.start").alias("starts"), F.col("at.n").alias("counts"))
    # rows that are wholly equal give the same windows; one of them is enough
    opened = rows.join(places, ["doc_id", "text_key"]).mapInPandas(
        _reopened(window), "doc_id bigint, text_key bigint, anchor bigint, hash bigint, start int"
    )
    opened = cut_lineage(opened, "opened")
    seen = opened.groupBy("anchor", "hash").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    single = opened.join(seen, ["anchor", "hash"]).where("doc_id > lo")
    return whole.union(single.select("doc_id", "text_key", "start", F.lit(1).alias("n")))


def remove_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_text`` for every row of ``docs`` (``doc_id``, ``text``).

    A word goes if it lies in a window of ``window`` consecutive words whose word sequence also starts in a document
    with a smaller doc_id; windows are judged on the input. Words are runs of bytes other than white space
    (0x20, 0x09-0x0D), compared unchanged; kept words are joined by one space.

    Null or empty text has no words. A null doc_id takes no part and keeps its words. Repeated rows, and texts that
    share a doc_id, do not count against each other. Texts shorter than a window stay. Empty input gives no rows.
    Other columns are ignored.
    """
    found = repeated_windows(docs, window).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "n")).alias("at"))
    found = found.select("doc_id", "text_key", F.col("at.start").alias("starts"), F.col("at.n").alias("counts"))
    rows = _keyed(docs).join(found, ["doc_id", "text_key"], "left").select(with_id(), "text", "starts", "counts")
    done = rows.mapInPandas(_without(window), "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")
    return done.select(without_id(), "n_words", "n_removed", "kept_text")
