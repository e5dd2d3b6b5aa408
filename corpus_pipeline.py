"""A training corpus from ``documents``: quality, near-duplicates, benchmark passages, personal data, packing.

Each stage is a function of (spark, docs, sf_dir). ``docs`` are the rows the stage before has kept. All but the last
return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, minhash, packing, pii, quality
from tidemark.llm.common import table
from tidemark.session import cut_lineage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity the Kneser-Ney model accepts. Empty texts stay; columns are unchanged."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def _by_text(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of some ids, one per id and text, as ``row`` with a number ``_row`` of their own.

    The first text of an id keeps the id as its number; the others get numbers beyond all ids.
    """
    whole = F.struct(*[docs[c] for c in docs.columns])
    rows = docs.join(ids, "doc_id", "left_semi").select(whole.alias("row"))
    text = F.xxhash64(F.col("row.text").cast("string"))
    one = rows.groupBy(F.col("row.doc_id").alias("_id"), text.alias("_text")).agg(
        F.min_by("row", F.xxhash64(F.col("row"))).alias("row")
    )
    first = one.groupBy("_id").agg(F.min("_text").alias("_first"))
    beyond = F.lit(1 << 62) + F.xxhash64("_id", "_text").bitwiseAND(F.lit((1 << 61) - 1))
    number = F.when(F.col("_text") == F.col("_first"), F.col("_id").cast("bigint")).otherwise(beyond)
    return one.join(first, "_id").select("row", number.alias("_row"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (5-word shingles, similarity 0.8): the smallest doc_id.

    Rows that repeat an id and a text are one document; other texts of the same id are documents of their own.
    Documents without words and rows with a null doc_id have no near-duplicates and stay.
    """
    counts = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
    repeated = cut_lineage(counts.where("_n > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        gone = minhash.near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("_gone"))
        return docs.join(gone, docs["doc_id"].cast("bigint") == gone["_gone"], "left_anti")
    single = docs.join(repeated, "doc_id", "left_anti").select(*docs.columns)
    several = cut_lineage(_by_text(docs, repeated), "several")
    texts = single.select("doc_id", "text").union(several.select("_row", "row.text"))
    gone = minhash.near_duplicates(texts).where("not kept").select(F.col("doc_id").alias("_gone"))
    gone = cut_lineage(gone, "gone")
    kept = single.join(gone, single["doc_id"].cast("bigint") == gone["_gone"], "left_anti")
    return kept.union(several.join(gone, several["_row"] == gone["_gone"], "left_anti").select("row.*"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that give no benchmark item away; columns are unchanged."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in ``text`` replaced by its kind; ``n_chars`` counts the new text."""
    clean = pii.masked(docs)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        clean = clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))
    return clean.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.best_fit(docs, with_ids=False)


STAGES = [
    ("quality classifier", quality_stage),
    ("near-duplicates", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("personal data", pii_stage),
    ("packing", packing_stage),
]

# A language model, latent space and tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = cut_lineage(docs, f"stage{number}")
    return docs
