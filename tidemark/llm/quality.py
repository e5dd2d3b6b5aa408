"""Quality by perplexity under an interpolated modified Kneser-Ney model of order 4, trained on trusted text.

Units are UTF-16 code units, so that one number of 64 bits is a 4-gram, exactly, in any language. Every task reduces
its texts to distinct 4-grams with counts before anything is shuffled; model tables and their joins are dealt by
n-gram, and hold one row per distinct n-gram of the corpus. For scoring, documents are dealt to blocks of a fixed size.
A block's distinct 4-grams meet the model in a join, come back with their probabilities, and score the block's texts.

A text is judged by its mean and by its worst stretches, so that a few foul sentences do not vanish in ordinary prose.
Limits of the worst stretches come from trusted documents that are scored as if they had not been trained on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import as_list, signed, steps, with_id, without_id
from tidemark.session import cut_lineage, cut_texts

ORDER = 4
# A unit that stands before each text; it is not scored.
PAD = "\x02"
# 4-grams that a task holds before it counts them together; its frames are added up by Spark before the shuffle.
HELD_GRAMS = 1 << 20
# Characters of a block of documents that is scored together, or one longer document.
BLOCK_CHARS = 16 << 20
# Trusted ids that are sent to every task; more are joined by a shuffle.
BROADCAST_IDS = 1 << 20
# A short text is drawn towards the mean of its language, as if it had so many more units.
DRAWN = 300
# Of the trusted documents of a language this share lies below the threshold, which is raised by a margin in bits.
QUANTILE = 0.995
MARGIN = 0.15
# Units of a stretch, and the share of a text's stretches, the worst, whose mean is judged.
STRETCH = 12
WORST = 0.01
# Units of words and their punctuation. A stretch with another unit (numbers, keys, addresses) is rare in good texts
# too, and does not count: it says nothing about the prose, and personal data have an operator of their own.
PROSE = np.array([u >= 0x80 or chr(u).isalpha() or chr(u) in " \t\r\n.,;:!?'\"()-" for u in range(1 << 16)])
# Quantiles are exact on a grid of this many steps per bit.
GRID = 1000


def _grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """4-grams of several texts in order, and where each text's grams begin."""
    joined = "".join(PAD * (ORDER - 1) + (t or "") for t in texts)
    units = np.frombuffer(joined.encode("utf-16-le", "surrogatepass"), dtype="<u2").astype(np.uint64)
    n = len(units) - ORDER + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    out = units[:n].copy()
    for i in range(1, ORDER):
        out <<= np.uint64(16)
        out |= units[i : i + n]
    scored = units[ORDER - 1 :] != np.uint64(ord(PAD))
    lengths = [len((t or "").encode("utf-16-le", "surrogatepass")) // 2 + ORDER - 1 for t in texts]
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    before = np.concatenate([np.zeros(ORDER, np.int64), np.cumsum(scored)])
    return out[scored], before[bounds.clip(max=len(before) - 1)]


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Distinct 4-grams of a task's texts with their counts in trusted ones (0 for others)."""
    held_g, held_c = [], []
    size = 0

    def merged() -> pd.DataFrame:
        every, place = np.unique(np.concatenate(held_g), return_inverse=True)
        return pd.DataFrame({"g": signed(every), "c": np.bincount(place, np.concatenate(held_c)).astype(np.int64)})

    for batch in batches:
        texts, trusted = as_list(batch["text"]), batch["trusted"].to_numpy(dtype=bool)
        for lo, hi in steps(texts):
            for flag in (False, True):
                grams, _ = _grams([t for t, f in zip(texts[lo:hi], trusted[lo:hi], strict=True) if f == flag])
                every, count = np.unique(grams, return_counts=True)
                held_g.append(every)
                held_c.append(count.astype(np.float64) if flag else np.zeros(len(every)))
                size += len(every)
        if size > HELD_GRAMS:
            frame = merged()
            if len(frame) > HELD_GRAMS // 2:
                yield frame
                held_g, held_c = [], []
            else:
                held_g, held_c = [frame["g"].to_numpy().view(np.uint64)], [frame["c"].to_numpy(dtype=np.float64)]
            size = sum(map(len, held_g))
    if held_g:
        yield merged()


def _suffix(g: Column, units: int) -> Column:
    return g.bitwiseAND(F.lit((1 << 16 * units) - 1))


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Discounts for counts of one, two, and three or more, from the numbers of n-grams counted 1 to 4 times."""
    n1, n2, n3, n4 = counts.agg(*[F.count_if(F.col("c") == i) for i in (1, 2, 3, 4)]).first()
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw))


def gram_scores(counts: DataFrame) -> DataFrame:
    """``g``, ``bits``: minus log2 of the probability of the last unit after the others, for every row of ``counts``.

    ``alone`` is the same without the one trusted document that has the 4-gram, null for other counts than 1. It leaves
    out each n-gram that only this 4-gram stands for; n-grams that others stand for too keep their counts.

    ``counts`` has every 4-gram that is asked for, with its count ``c`` in trusted text, maybe 0. The highest order
    uses counts; lower orders the number of distinct units before. Below the single unit all 65,536 are alike.
    """
    levels = {ORDER: counts.where("c > 0").select("g", "c")}
    for n in range(ORDER - 1, 0, -1):
        shorter = levels[n + 1].groupBy(_suffix(F.col("g"), n).alias("g")).agg(F.count(F.lit(1)).alias("c"))
        levels[n] = cut_lineage(shorter, "level")
    asked = {ORDER: counts.select("g")}
    for n in range(ORDER - 1, 0, -1):
        asked[n] = asked[n + 1].select(_suffix(F.col("g"), n).alias("g")).distinct()
    below: DataFrame | None = None
    for n in range(1, ORDER + 1):
        d1, d2, d3 = _discounts(levels[n])
        c = F.col("c")
        discount = F.when(c == 1, d1).when(c == 2, d2).otherwise(d3)
        context = F.shiftrightunsigned("g", 16) if n > 1 else F.lit(0).cast("bigint")
        given = levels[n].groupBy(context.alias("context")).agg(
            F.sum("c").alias("total"), (F.sum(F.least(discount, c)) / F.sum("c")).alias("rest")
        )
        rows = asked[n].join(levels[n], "g", "left").withColumn("context", context).join(given, "context", "left")
        if below is None:
            lower = without = F.lit(1 / 65536)
        else:
            rows = rows.withColumn("suffix", _suffix(F.col("g"), n - 1)).join(below.toDF("suffix", "lower", "without"), "suffix")
            lower, without = F.col("lower"), F.col("without")
        own = F.coalesce(F.greatest(c - discount, F.lit(0.0)), F.lit(0.0)) / F.col("total")
        p = F.when(F.col("total").isNull(), lower).otherwise(own + F.col("rest") * lower)
        left = (F.col("rest") * F.col("total") - d1) / (F.col("total") - 1) * without
        alone = F.when((c == 1) & (F.col("total") == 1), without).when(c == 1, left)
        if n < ORDER:
            alone = F.coalesce(alone, p)
        below = cut_lineage(rows.select("g", p.alias("p"), alone.alias("alone")), "probabilities")
    return below.select("g", (-F.log2("p")).alias("bits"), (-F.log2("alone")).alias("alone"))


def _wanted(group: pd.DataFrame) -> pd.DataFrame:
    texts = as_list(group["text"])
    found = [np.unique(_grams(texts[lo:hi])[0]) for lo, hi in steps(texts)]
    every = np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)
    return pd.DataFrame({"block": group["block"].iloc[0], "g": signed(every)})


def _worst(sums: np.ndarray, strange: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean of the worst stretches of each text, from running sums of bits and of units that are no prose.

    0 for a text shorter than a stretch or without a stretch of prose.
    """
    out = np.zeros(len(first) - 1)
    means = (sums[STRETCH:] - sums[:-STRETCH]) / STRETCH
    prose = strange[STRETCH:] == strange[:-STRETCH]
    for i in np.flatnonzero(np.diff(first) >= STRETCH):
        at = slice(first[i], first[i + 1] - STRETCH + 1)
        own = means[at][prose[at]]
        if len(own):
            some = max(1, round(len(own) * WORST))
            out[i] = np.partition(own, len(own) - some)[-some:].mean()
    return out


def _scored(group: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
    if not len(group):
        return pd.DataFrame({c: [] for c in ("doc_id", "text_key", "lang", "units", "bits", "worst", "worst_alone")})
    order = np.argsort(model["g"].to_numpy().view(np.uint64))
    known = model["g"].to_numpy().view(np.uint64)[order]
    bits = model["bits"].to_numpy()[order]
    alone = model["alone"].to_numpy(dtype=np.float64)[order]
    alone = np.where(np.isnan(alone), bits, alone)
    texts = as_list(group["text"])
    units, total = np.zeros(len(texts), np.int64), np.zeros(len(texts))
    worst, worst_alone = np.zeros(len(texts)), np.zeros(len(texts))
    for lo, hi in steps(texts):
        grams, first = _grams(texts[lo:hi])
        units[lo:hi] = np.diff(first)
        if len(grams):
            place = np.searchsorted(known, grams)
            sums = np.concatenate([[0.0], np.cumsum(bits[place])])
            total[lo:hi] = sums[first[1:]] - sums[first[:-1]]
            strange = np.concatenate([[0], np.cumsum(~PROSE[grams & np.uint64(0xFFFF)])])
            worst[lo:hi] = _worst(sums, strange, first)
            worst_alone[lo:hi] = _worst(np.concatenate([[0.0], np.cumsum(alone[place])]), strange, first)
    return pd.DataFrame(
        {
            "doc_id": group["doc_id"].array,
            "text_key": group["text_key"].to_numpy(),
            "lang": group["lang"].array,
            "units": units,
            "bits": total,
            "worst": worst,
            "worst_alone": worst_alone,
        }
    )


def _rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(text).alias("text_key"),
        F.col("lang").cast("string").alias("lang"),
        text.alias("text"),
    )


def _flagged(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` with a boolean ``trusted``; the ids are broadcast only if they are few."""
    marked = ids.select("doc_id", F.lit(True).alias("trusted"))
    if marked.count() <= BROADCAST_IDS:
        marked = F.broadcast(marked)
    return rows.join(marked, "doc_id", "left").withColumn("trusted", F.coalesce("trusted", F.lit(False)))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Distinct ids of documents labelled good and not toxic, and never otherwise."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    seen = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    return seen.agg(F.min(F.coalesce(good, F.lit(False))).alias("good")).where("good").select("doc_id")


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key``, ``lang``, ``units``, ``bits`` (sum over the text), ``worst``, ``trusted`` for every row.

    ``worst`` is the mean number of bits per unit in the worst stretches of prose, 0 for a text without one.
    ``worst_alone`` is the same under the model without the text, if the text is trusted.
    """
    rows = _rows(docs)
    ids = cut_lineage(trusted_ids(labels), "trusted")
    counted = _flagged(rows.select("doc_id", "text"), ids).select("text", "trusted").mapInPandas(_counts, "g bigint, c bigint")
    counts = cut_texts(counted.groupBy("g").agg(F.sum("c").alias("c")), "grams")
    scores = gram_scores(counts)
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = 1 + size // BLOCK_CHARS
    # equal rows share a block; all others are spread by id and text
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(blocks))).repartition("block")
    wanted = dealt.groupBy("block").applyInPandas(_wanted, "block bigint, g bigint")
    answered = wanted.join(scores, "g").select(F.col("block").alias("of"), "g", "bits", "alone")
    dealt = dealt.withColumn("doc_id", with_id())
    out = dealt.groupBy("block").cogroup(answered.groupBy("of")).applyInPandas(
        _scored, "doc_id bigint, text_key bigint, lang string, units bigint, bits double, worst double, worst_alone double"
    )
    return cut_lineage(_flagged(cut_lineage(out.withColumn("doc_id", without_id()), "scored"), ids), "marked")


def _quantile(rows: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """The value on the grid below or at which ``share`` of the rows lie, per key."""
    steps_ = rows.groupBy(*keys, F.ceil(F.col(value) * GRID).alias("step")).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy(*keys).orderBy("step")
    whole = Window.partitionBy(*keys)
    seen = steps_.withColumn("seen", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(whole))
    return seen.where(F.col("seen") >= F.lit(share) * F.col("all")).groupBy(*keys).agg((F.min("step") / GRID).alias("limit"))


def _worst_limits(good: DataFrame, keys: list[str], share: float) -> DataFrame:
    """The quantile of the trusted documents' worst stretches per key.

    Fewer documents than the quantile can be read from give that of the extreme value (Gumbel) distribution with their
    mean and deviation, unless theirs is larger.
    """
    z = (-math.log(-math.log(min(share, 1 - 1e-9))) - np.euler_gamma) * math.sqrt(6) / math.pi
    spread = good.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), (F.avg("own_worst") + float(z) * F.coalesce(F.stddev("own_worst"), F.lit(0.0))).alias("extreme")
    )
    limits = _quantile(good, keys, "own_worst", share).join(spread, keys)
    seen = F.col("n") * (1 - share) >= 1
    return limits.select(*keys, F.when(seen, F.col("limit")).otherwise(F.greatest("limit", "extreme")).alias("worst_limit"))


def judge(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN) -> DataFrame:
    """``doc_id, text_key, lang, n_units, perplexity, level, threshold, kept`` for every row of ``docs``.

    ``docs``: ``doc_id``, ``lang``, ``text``; ``labels``: ``doc_id``, ``quality``, ``toxic``. Perplexity is per unit.
    ``level`` is the mean number of bits per unit, drawn towards the language's mean for short texts. A document is
    kept if its level is at most the threshold of its language: a quantile of its trusted documents, and a margin. Its
    worst stretches must also be at most the same quantile of the trusted documents' worst stretches, without a margin.
    Trusted documents are measured for this without their own 4-grams. A text shorter than a stretch is filled up with
    units of its language's mean.

    A language without trusted documents, or a null one, takes the threshold of all. A null or empty text has no
    perplexity and is kept; without any trusted document all are kept. Repeated rows are judged each; a null doc_id
    is never trusted. Empty input gives no rows. Other columns are ignored.
    """
    rows = score(docs, labels).withColumn("mean", F.col("bits") / F.nullif(F.col("units"), F.lit(0)))
    trusted = rows.where("trusted and units > 0")
    lang = F.coalesce("lang", F.lit(""))
    centre = trusted.agg((F.sum("bits") / F.sum("units")).alias("overall"))
    centres = trusted.groupBy(lang.alias("key")).agg((F.sum("bits") / F.sum("units")).alias("own"))
    overall = centre.first()["overall"]
    level = (F.col("bits") + DRAWN * F.coalesce("own", F.lit(overall))) / (F.col("units") + DRAWN)
    levels = rows.withColumn("key", lang).join(F.broadcast(centres), "key", "left") if _few(centres) else (
        rows.withColumn("key", lang).join(centres, "key", "left")
    )
    short = (F.col("bits") + (STRETCH - F.col("units")) * F.coalesce("own", F.lit(overall))) / STRETCH
    worst = [F.when(F.col("units") >= STRETCH, F.col(c)).when(F.col("units") > 0, short) for c in ("worst", "worst_alone")]
    levels = levels.select(
        *rows.columns, "key", F.when(F.col("units") > 0, level).alias("level"), worst[0].alias("stretch"), worst[1].alias("own_worst")
    )
    levels = cut_lineage(levels, "levels")
    good = levels.where("trusted and units > 0")
    pooled = _quantile(good.withColumn("one", F.lit(1)), ["one"], "level", quantile).first()
    limits = _quantile(good, ["key"], "level", quantile)
    limit = F.coalesce("limit", F.lit(pooled["limit"] if pooled else None).cast("double")) + margin
    pooled_worst = _worst_limits(good.withColumn("one", F.lit(1)), ["one"], quantile).first()
    limits = cut_lineage(limits.join(_worst_limits(good, ["key"], quantile), "key"), "limits")
    worst_limit = F.coalesce("worst_limit", F.lit(pooled_worst["worst_limit"] if pooled_worst else None).cast("double"))
    fair = (F.col("level") <= F.col("threshold")) & (F.col("stretch") <= worst_limit)
    judged = levels.join(F.broadcast(limits) if _few(limits) else limits, "key", "left").withColumn("threshold", limit)
    return judged.select(
        "doc_id",
        "text_key",
        "lang",
        F.col("units").alias("n_units"),
        F.pow(F.lit(2.0), F.col("mean")).alias("perplexity"),
        "level",
        "threshold",
        F.coalesce(fair, F.lit(True)).alias("kept"),
    )


def _few(table: DataFrame) -> bool:
    """Whether a table per language is small enough to send to every task."""
    return table.count() <= 10_000


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    bad = cut_lineage(judge(docs, labels).where("not kept").select("doc_id", "text_key").distinct(), "rejected")
    bad = bad.toDF("_id", "_key")
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("_key"))
    return docs.join(bad, same, "left_anti")
