"""Benchmark passages in documents by latent semantic retrieval, confirmed word by word.

Benchmark items are cut into passages, and documents into overlapping passages of the same length. Terms are the words
of the benchmark that are not too common; their weights follow from counts over all documents. A randomised SVD of the
weighted passages of the whole corpus and of the benchmark gives a latent space: tasks multiply their passages with a
narrow matrix, Spark adds the products up, and only matrices of terms by dimensions reach the driver. Every passage of
every document is compared with every benchmark passage by the cosine in this space. Where a document has some words
of an item in a row, it is a candidate too, however common these words are. Candidates are confirmed by the
longest common subsequence of words, or, for a paraphrase, by a shorter one together with the words of the answer.

Texts are split into words once: what a document shares with the words of the benchmark and its answers is written, and
counts, space, candidates and confirmation work on that; other words match nothing.

A benchmark is taken in blocks of ``BLOCK_PASSAGES``, each with its own terms and space, so that terms, matrices and
what is sent to the tasks have a fixed bound: at most ``BLOCK_PASSAGES * PASSAGE`` terms.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Words, mix, steps, windows
from tidemark.session import TEXT_ROWS, batches_of, cut_lineage

# Words of a passage, and words between the beginnings of a document's passages.
PASSAGE = 64
STRIDE = 32
BLOCK_PASSAGES = 256
# A word in more than this share of the documents is no term, but each passage keeps its rarest words.
COMMON = 0.1
RAREST = 5
# Dimensions besides those of the block's passages, and further ones for the random range.
EXTRA = 32
OVERSAMPLED = 8
COSINE = 0.5
# So many words of an item in a row, or a shorter item, make a candidate without the latent space.
RUN = 5
# A passage with less than this share of the smallest benchmark passage's weight is no candidate.
WEIGHT = 0.3
# Shares of an item's words in the longest common subsequence: enough alone, and with the answer.
VERBATIM = 0.7
PARAPHRASE = 0.5
ANSWER = 0.8
# Where no answer is given, the last part of the item stands for it.
ANSWER_PART = 4


def _hashes(texts: list[str | None]) -> Words:
    return Words([None if t is None else t.lower() for t in texts], marks=True)


@dataclass
class Block:
    """Items of a benchmark block, their passages, and the words in them and in the answers."""

    ids: list[int]
    words: list[np.ndarray]
    answers: list[frozenset[int]]
    owner: np.ndarray
    passages: list[np.ndarray]
    vocabulary: np.ndarray


def _block(rows: list) -> Block:
    ids, words, answers, owner, passages = [], [], [], [], []
    texts = _hashes([r["text"] for r in rows])
    given = _hashes([r["answer"] for r in rows])
    for i, row in enumerate(rows):
        own = texts.of(i)
        if not len(own):
            continue
        answer = given.of(i) if given.count(i) else own[-max(1, len(own) // ANSWER_PART) :]
        for at in range(0, len(own), PASSAGE):
            owner.append(len(ids))
            passages.append(own[at : at + PASSAGE])
        ids.append(int(row["item_id"]))
        words.append(own)
        answers.append(frozenset(answer.tolist()))
    held = [*words, *(np.fromiter(a, np.uint64, len(a)) for a in answers)]
    vocabulary = np.unique(np.concatenate(held)) if held else np.empty(0, np.uint64)
    return Block(ids, words, answers, np.asarray(owner, dtype=np.int64), passages, vocabulary)


def _blocks(benchmark: DataFrame) -> Iterator[Block]:
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.where("item_id is not null").select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"), answer.alias("answer")
    )
    held, size = [], 0
    for row in items.orderBy("item_id", "text").toLocalIterator():
        n = 1 + len((row["text"] or "").split()) // PASSAGE
        if held and size + n > BLOCK_PASSAGES:
            yield _block(held)
            held, size = [], 0
        held.append(row)
        size += n
    if held:
        yield _block(held)


class _Lookup:
    """Places of hashes in a sorted array; most misses are told by a few bits alone."""

    def __init__(self, known: np.ndarray):
        self.known = known
        bits = max(16, (16 * len(known)).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.low = np.zeros(1 << bits, dtype=bool)
        self.low[known & self.mask] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        maybe = np.flatnonzero(self.low[hashes & self.mask])
        if not len(maybe) or not len(self.known):
            return maybe[:0], maybe[:0]
        at = np.searchsorted(self.known, hashes[maybe]).clip(max=len(self.known) - 1)
        same = self.known[at] == hashes[maybe]
        return maybe[same], at[same]


def _lists(batch: pa.RecordBatch, name: str, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Of some rows of a list column: all values, and the row of each."""
    part = batch.column(name).slice(lo, hi - lo)
    sizes = np.diff(part.offsets.to_numpy())
    return part.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(hi - lo), sizes)


def _frequencies(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                words, owner = _lists(batch, "words", lo, min(lo + 1024, batch.num_rows))
                total += np.bincount(np.unique(owner * size + words) % size, minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["term", "n"])

    return run


class _Runs:
    """Runs of ``RUN`` words of some items, or whole shorter items, to be found in documents."""

    def __init__(self, items: list[np.ndarray]):
        by_size: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for i, words in enumerate(items):
            size = min(RUN, len(words))
            runs = np.unique(windows(words, size))
            by_size.setdefault(size, []).append((runs, np.full(len(runs), i)))
        self.tables = []
        for size, held in by_size.items():
            runs, owner = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(runs, kind="stable")
            known, first = np.unique(runs[order], return_index=True)
            self.tables.append((size, _Lookup(known), np.append(first, len(runs)), owner[order]))

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text number, item, and piece of ``STRIDE`` words in the text, in order of the text, each once."""
        found = [np.empty((0, 3), dtype=np.int64)]
        for size, lookup, first, owner in self.tables:
            place, run = lookup.find(windows(words.hashes, size))
            text = np.searchsorted(words.first, place, side="right") - 1
            inside = place + size <= words.first[text + 1]
            place, run, text = place[inside], run[inside], text[inside]
            n = first[run + 1] - first[run]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            item = owner[np.repeat(first[run], n) + step]
            found.append(np.stack([np.repeat(text, n), item, np.repeat((place - words.first[text]) // STRIDE, n)], axis=1))
        return tuple(np.unique(np.concatenate(found), axis=0).T)


def _hits(vocabulary: np.ndarray, items: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, runs = _Lookup(vocabulary), _Runs(items)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            others = [batch.column(c) for c in ("doc_id", "text_key")]
            for lo, hi in steps(texts):
                words = _hashes(texts[lo:hi])
                place, word = lookup.find(words.hashes)
                cut = np.searchsorted(place, words.first)
                text, item, piece = runs.find(words)
                own = np.searchsorted(text, np.arange(hi - lo + 1))
                rows = np.flatnonzero((cut[1:] > cut[:-1]) | (own[1:] > own[:-1]))
                if not len(rows):
                    continue
                place = place - np.repeat(words.first[:-1], np.diff(cut))
                gaps = np.diff(place, prepend=0)
                begins = cut[:-1][cut[1:] > cut[:-1]]
                gaps[begins] = place[begins]
                in_row, in_item = np.append(cut[rows], cut[-1]), np.append(own[rows], own[-1])
                lists = [(in_row, gaps), (in_row, word), (in_item, item), (in_item, piece * STRIDE)]
                taken = pa.array(lo + rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[c.take(taken) for c in others],
                        *[
                            pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(x.astype(np.int32)))
                            for first, x in lists
                        ],
                    ],
                    ["doc_id", "text_key", "gaps", "words", "items", "begins"],
                )

    return run


@dataclass
class Held:
    """The benchmark's words in some documents, in order: their places, the words, and which document each is in."""

    places: np.ndarray
    words: np.ndarray
    row: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch, lo: int, hi: int) -> Held:
        gaps, row = _lists(batch, "gaps", lo, hi)
        words, _ = _lists(batch, "words", lo, hi)
        whole = np.cumsum(gaps, dtype=np.int64)
        first = np.searchsorted(row, np.arange(hi - lo))
        before = np.concatenate([[0], whole])[first]
        return cls(whole - before[row], words.astype(np.int64), row)


@dataclass
class Passages:
    """The terms in pieces of ``size`` words of some documents; pieces without a term are left out.

    The terms of piece i are those from ``first[i]`` to ``first[i + 1]``; ``row`` and ``number`` tell which document it
    belongs to and which of its pieces it is.
    """

    terms: np.ndarray
    first: np.ndarray
    row: np.ndarray
    number: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]], size: int) -> Passages:
        terms = np.concatenate([t for _, t in rows]).astype(np.int64) if rows else np.empty(0, np.int64)
        number = np.concatenate([p for p, _ in rows]).astype(np.int64) // size if rows else np.empty(0, np.int64)
        return cls._cut(terms, number, np.repeat(np.arange(len(rows)), [len(t) for _, t in rows]))

    @classmethod
    def _cut(cls, terms: np.ndarray, number: np.ndarray, row: np.ndarray) -> Passages:
        edge = np.ones(len(terms), dtype=bool)
        edge[1:] = (row[1:] != row[:-1]) | (number[1:] != number[:-1])
        first = np.flatnonzero(edge)
        return cls(terms, np.append(first, len(terms)), row[first], number[first])

    @classmethod
    def within(cls, held: Held, term_of: np.ndarray, size: int) -> Passages:
        """Of the words of some documents those that are terms."""
        terms = term_of[held.words]
        known = terms >= 0
        return cls._cut(terms[known], held.places[known] // size, held.row[known])

    def __len__(self) -> int:
        return len(self.row)

    def sums(self, matrix: np.ndarray) -> np.ndarray:
        """Sum of the terms' rows of ``matrix`` per piece."""
        if not len(self):
            return np.zeros((0, matrix.shape[1]), dtype=matrix.dtype)
        return np.add.reduceat(matrix[self.terms], self.first[:-1], axis=0)

    def spread(self, rows: np.ndarray, into: np.ndarray) -> None:
        """Add each piece's row to all its terms."""
        if not len(self):
            return
        order = np.argsort(self.terms, kind="stable")
        terms = self.terms[order]
        owner = np.repeat(np.arange(len(self)), np.diff(self.first))[order]
        at = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
        into[terms[at]] += np.add.reduceat(rows[owner], at, axis=0)

    def squares(self, idf: np.ndarray) -> np.ndarray:
        """Sum of squared weights per piece."""
        return np.add.reduceat(idf[self.terms] ** 2, self.first[:-1]) if len(self) else np.zeros(0)


def _chunks(batch: pa.RecordBatch, size: int = 64) -> Iterator[tuple[int, int]]:
    return ((lo, min(lo + size, batch.num_rows)) for lo in range(0, batch.num_rows, size))


def _signs(keys: np.ndarray, numbers: np.ndarray, width: int) -> np.ndarray:
    """A row of random signs per passage, the same whenever a task is run again."""
    seeds = mix(keys.view(np.uint64) + numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    words = np.stack([mix(seeds + np.uint64(i + 1)) for i in range(-(-width // 64))], axis=1)
    bits = np.unpackbits(words.view(np.uint8), axis=1)[:, :width]
    return bits.astype(np.float32) * 2 - 1


def _products(term_of: np.ndarray, idf: np.ndarray, basis: np.ndarray | None, width: int):
    """Sums over a task's passages, in groups of rows: A' S for random signs S, or (A basis)' (A basis).

    A has a row of unit length per passage. Factors of a term are left to the end in the first case, and are part of
    the basis in the second.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(idf) if basis is None else width, width))
        count = 0
        for batch in batches:
            text_keys = batch.column("text_key").to_numpy()
            for lo, hi in _chunks(batch):
                passages = Passages.within(Held.of(batch, lo, hi), term_of, PASSAGE)
                count += len(passages)
                scale = (1 / np.sqrt(passages.squares(idf))).astype(np.float32)[:, None]
                if basis is None:
                    keys = text_keys[lo + passages.row]
                    passages.spread(_signs(keys, passages.number, width) * scale, total)
                else:
                    product = passages.sums(basis) * scale
                    total += product.T @ product
        groups = range(0, len(total), 64)
        data = [total[g : g + 64].astype("<f4").tobytes() for g in groups] + [np.array([count], "<f4").tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([*groups, -1], pa.int32()), pa.array(data, pa.binary())], ["part", "data"])

    return run


def _sum(group: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(d, "<f4").astype(np.float64) for d in group["data"])
    return pd.DataFrame({"part": [group["part"].iloc[0]], "data": [np.asarray(total, "<f8").tobytes()]})


def _summed(hits: DataFrame, term_of: np.ndarray, idf: np.ndarray, basis: np.ndarray | None, width: int) -> tuple[np.ndarray, float]:
    held = hits.select("text_key", "gaps", "words")
    parts = held.mapInArrow(_products(term_of, idf, basis, width), "part int, data binary")
    rows = {r["part"]: r["data"] for r in parts.groupBy("part").applyInPandas(_sum, "part int, data binary").collect()}
    shape = (len(idf) if basis is None else width, width)
    if not rows:
        return np.zeros(shape), 0.0
    count = float(np.frombuffer(rows.pop(-1), "<f8")[0])
    whole = np.frombuffer(b"".join(rows[p] for p in sorted(rows)), "<f8")
    return whole.reshape(shape).copy(), count


def _latent(hits: DataFrame, term_of: np.ndarray, own: Passages, idf: np.ndarray) -> np.ndarray:
    """Terms by dimensions: the leading right singular vectors of the corpus's and the benchmark's passages, times idf.

    The range is drawn from the rows of both; the second pass over the corpus rotates it to the singular vectors. The
    benchmark's passages together weigh as much as all passages of the corpus, so that each keeps its place.
    """
    width = min(len(idf), len(own) + EXTRA + OVERSAMPLED)
    scale = 1 / np.sqrt(own.squares(idf))[:, None]
    span, count = _summed(hits, term_of, idf, None, width)
    weight = max(1.0, count / max(1, len(own)))
    extra = np.zeros_like(span)
    own.spread(np.random.default_rng(8).standard_normal((len(own), width)) * scale, extra)
    basis, _ = np.linalg.qr((span + weight * extra) * idf[:, None])
    weighted = (basis * idf[:, None]).astype(np.float32)
    inner, _ = _summed(hits, term_of, idf, weighted, width)
    mapped = own.sums(weighted).astype(np.float64) * scale
    values, vectors = np.linalg.eigh(inner + weight * mapped.T @ mapped)
    top = np.argsort(-values)[: min(width, len(own) + EXTRA)]
    return (basis @ vectors[:, top] * idf[:, None]).astype(np.float32)


def _near(term_of: np.ndarray, idf: np.ndarray, latent: np.ndarray, own: Passages, owner: np.ndarray):
    """A function from some documents' words to those near an item in the latent space: row, item, begin."""

    def unit(rows: np.ndarray) -> np.ndarray:
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)

    items = unit(own.sums(latent))
    least = WEIGHT**2 * float(own.squares(idf).min())

    def found(held: Held) -> np.ndarray:
        near = [np.empty((0, 3), dtype=np.int64)]
        pieces = Passages.within(held, term_of, STRIDE)
        if not len(pieces):
            return near[0]
        sums, squares = pieces.sums(latent), pieces.squares(idf)
        # a passage is two neighbouring pieces, of which one may hold no term
        paired = np.flatnonzero((pieces.row[1:] == pieces.row[:-1]) & (pieces.number[1:] == pieces.number[:-1] + 1))
        alone = np.ones((2, len(pieces)), dtype=bool)
        alone[0, paired], alone[1, paired + 1] = False, False
        before = np.flatnonzero(alone[1] & (pieces.number > 0))
        last = np.flatnonzero(alone[0])
        left = np.concatenate([paired, last, before])
        weight = np.concatenate([squares[paired] + squares[paired + 1], squares[last], squares[before]])
        begin = np.concatenate([pieces.number[paired], pieces.number[last], pieces.number[before] - 1])
        heavy = np.flatnonzero(weight >= least)
        for lo in range(0, len(heavy), 4096):
            some = heavy[lo : lo + 4096]
            vectors = sums[left[some]]
            both = some < len(paired)
            vectors[both] += sums[left[some[both]] + 1]
            a, b = np.nonzero(unit(vectors) @ items.T >= COSINE)
            near.append(np.stack([pieces.row[left[some[a]]], owner[b], begin[some[a]] * STRIDE], axis=1))
        return np.concatenate(near)

    return found


def common_subsequence(item: list[int], region: list[int]) -> int:
    """Length of the longest common subsequence, one step of whole-number arithmetic per word of the region."""
    places: dict[int, int] = {}
    for i, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for word in region:
        match = places.get(word)
        if match is not None:
            both = row & match
            row = (row + both | row - both) & full
    return len(item) - row.bit_count()


def leaked(item: list[int], answer: frozenset[int], region: list[int]) -> tuple[bool, float]:
    """Whether a region of a document gives the item away, and the share of the item's words in common order.

    Of an item longer than a passage, any of its whole passages gives it away too. Where fewer of the item's words occur
    at all, in any order, nothing is given away and the share is not computed.
    """
    held = set(region)
    occurs = [word in held for word in item]
    wholes = range(0, len(item) - PASSAGE + 1, PASSAGE) if len(item) > PASSAGE else ()
    if sum(occurs) < PARAPHRASE * len(item) and all(sum(occurs[at : at + PASSAGE]) < VERBATIM * PASSAGE for at in wholes):
        return False, 0.0
    share = common_subsequence(item, region) / len(item)
    if share >= VERBATIM:
        return True, share
    for at in wholes:
        if common_subsequence(item[at : at + PASSAGE], region) >= VERBATIM * PASSAGE:
            return True, share
    present = len(answer & set(region)) / max(1, len(answer))
    return share >= PARAPHRASE and present >= ANSWER, share


def _confirmed(near, ids: list[int], words: list[np.ndarray], answers: list[frozenset[int]]):
    """Candidates of each document, near an item or with some of its words in a row, and what they give away.

    ``words`` and ``answers`` are places in the vocabulary, as the documents' words are.
    """
    plain = [w.tolist() for w in words]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, items, shares = [], [], []
            for lo, hi in _chunks(batch):
                held = Held.of(batch, lo, hi)
                item, row = _lists(batch, "items", lo, hi)
                begin, _ = _lists(batch, "begins", lo, hi)
                both = np.concatenate([near(held), np.stack([row, item, begin], axis=1)])
                first = np.searchsorted(held.row, np.arange(hi - lo + 1))
                best: dict[tuple[int, int], float] = {}
                for r, i, at in np.unique(both, axis=0).tolist():
                    places = held.places[first[r] : first[r + 1]]
                    reach = len(plain[i])
                    inside = slice(*(first[r] + np.searchsorted(places, [at - reach, at + PASSAGE + reach])))
                    yes, share = leaked(plain[i], answers[i], held.words[inside].tolist())
                    if yes:
                        best[r, i] = max(share, best.get((r, i), 0.0))
                rows += [lo + r for r, _ in best]
                items += [ids[i] for _, i in best]
                shares += best.values()
            taken = pa.array(rows, pa.int64())
            found = [batch.column("doc_id").take(taken), batch.column("text_key").take(taken)]
            yield pa.RecordBatch.from_arrays(
                [*found, pa.array(items, pa.int64()), pa.array(shares, pa.float64())], ["doc_id", "text_key", "item_id", "share"]
            )

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _of_block(rows: DataFrame, block: Block) -> DataFrame:
    """``doc_id``, ``text_key``, ``item_id``, ``share`` for the items of one block."""
    schema = "doc_id bigint, text_key bigint, gaps array<int>, words array<int>, items array<int>, begins array<int>"
    with batches_of(rows.sparkSession, TEXT_ROWS):
        hits = cut_lineage(rows.mapInArrow(_hits(block.vocabulary, block.words), schema), "hits")
    size = len(block.vocabulary)
    counted = hits.select("words").mapInArrow(_frequencies(size), "term bigint, n bigint")
    counts = {r["term"]: r["n"] for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    n_docs = rows.count()
    df = np.zeros(size)
    df[list(counts)] = list(counts.values())
    in_items = np.isin(block.vocabulary, np.concatenate(block.words))
    chosen = (df <= COMMON * n_docs) & in_items
    for passage in block.passages:
        own = np.searchsorted(block.vocabulary, np.unique(passage))
        chosen[own[np.argsort(df[own], kind="stable")[:RAREST]]] = True
    term_of = np.where(chosen, np.cumsum(chosen) - 1, -1)
    idf = np.log((n_docs + 1) / (df[chosen] + 1)) + 1
    lookup = _Lookup(block.vocabulary[chosen])
    own = Passages.of([lookup.find(p) for p in block.passages], PASSAGE)
    hits = hits.where("doc_id is not null")
    latent = _latent(hits, term_of, own, idf)
    near = _near(term_of, idf, latent, own, block.owner[own.row])
    words = [np.searchsorted(block.vocabulary, w) for w in block.words]
    answers = [frozenset(np.searchsorted(block.vocabulary, np.fromiter(a, np.uint64, len(a))).tolist()) for a in block.answers]
    schema = "doc_id bigint, text_key bigint, item_id bigint, share double"
    return cut_lineage(hits.mapInArrow(_confirmed(near, block.ids, words, answers), schema), "leaks")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key``, ``item_id``, ``share``: documents that give a benchmark item away, once per item."""
    rows = _keyed(docs)
    found = None
    for block in _blocks(benchmark):
        if not block.ids:
            continue
        sure = _of_block(rows, block)
        found = sure if found is None else found.union(sure)
    if found is None:
        return rows.limit(0).select("doc_id", "text_key", F.lit(0).cast("bigint").alias("item_id"), F.lit(0.0).alias("share"))
    return found.groupBy("doc_id", "text_key", "item_id").agg(F.max("share").alias("share"))


def judge(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, contaminated, item_ids, share`` for every row of ``docs`` (``doc_id``, ``text``).

    ``benchmark``: ``item_id``, ``text``, and ``answer`` if there is one. Words are compared in lower case and without
    ASCII punctuation. ``item_ids`` are the items given away, in order, and ``share`` the largest share of an item's
    words found in its order.

    Null and empty texts hold nothing; a null doc_id takes no part and is not contaminated; items without words and null
    items are left out. Repeated rows are judged each. An empty benchmark leaves all clean. Empty docs give no rows.
    Other columns are ignored.
    """
    found = leaks(docs, benchmark).groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("share").alias("share")
    )
    rows = _keyed(docs).select("doc_id", "text_key").join(found, ["doc_id", "text_key"], "left")
    return rows.select(
        "doc_id",
        F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
        F.coalesce("share", F.lit(0.0)).alias("share"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that give no item away, with their columns."""
    bad = cut_lineage(leaks(docs, benchmark).select("doc_id", "text_key").distinct().toDF("_id", "_key"), "contaminated")
    same = (F.col("doc_id").cast("bigint") == F.col("_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("_key"))
    return docs.join(bad, same, "left_anti")
