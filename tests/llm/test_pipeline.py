import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tidemark.llm import queries

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    counts = [before]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, SF), "stage")
        if name != "packing":
            assert docs.columns == columns
            counts.append(docs.count())
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[4] == counts[3]
    filled = docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert max(r["n"] for r in filled) <= 2048
    assert docs.select("doc_id").distinct().count() == counts[4]


def test_odd_rows_pass_every_stage(spark, documents):
    rows = [(1, None, "en"), (2, "", None), (None, None, None), (None, "lone words", "xx"), (3, "same text here", "en"), (3, "same text here", "en"),
            (3, "another text of this id", "en"), (4, "mail a@b.co now", "en"), (5, "word " * 20_000, "en")]
    # ids without labels, so that the language model trusts none of them and keeps all
    rows = [(None if i is None else i + 10**6, text, lang) for i, text, lang in rows]
    docs = documents(rows)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, SF), "odd")
        if name != "packing":
            assert docs.columns == columns
        if name == "near-duplicates":
            ids = sorted(str(r["doc_id"]) for r in docs.collect())
            # both texts of one id stay, its repeated row goes
            assert ids == [*(str(10**6 + i) for i in (1, 2, 3, 3, 4, 5)), "None", "None"]
        if name == "personal data":
            mail = docs.where(f"doc_id = {10**6 + 4}").first()
            assert (mail["text"], mail["n_chars"]) == ("mail [EMAIL] now", 16)
    assert {r["doc_id"] for r in docs.collect()} == {None, *range(10**6 + 1, 10**6 + 6)}


def test_texts_of_one_id_are_documents_of_their_own(spark, documents):
    texts = [" ".join(f"{c}{i}" for i in range(80)) for c in "abc"]
    near = texts[0].replace("a7 ", "z ")
    rows = [(1, texts[0], "en"), (1, texts[1], "en"), (2, near, "en"), (3, texts[2], "en"), (4, near, "en"), (4, texts[2], "en"),
            (4, texts[1], "en"), (5, "short", "en"), (5, "other", "en")]
    kept = corpus_pipeline.near_duplicate_stage(spark, documents(rows), SF)
    got = sorted(r["text"] for r in kept.collect())
    assert len(got) == 5 and {"short", "other", texts[1], texts[2]} <= set(got)
    assert got.count(texts[0]) + got.count(near) == 1
    assert kept.columns == documents(rows).columns


def test_every_operator_is_registered_once():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", ["op1_bloom_cascade_url_filter", "op4_preference_formatting", "op9_weak_supervision_pii"])
def test_native_plans_have_no_python(spark, name, monkeypatch, capsys):
    queries.QUERIES[name](spark, SF).explain()
    plan = capsys.readouterr().out
    assert plan and not re.search("Python|Pandas|Arrow", plan)
