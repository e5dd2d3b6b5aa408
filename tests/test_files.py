"""Readers, required columns and exports."""

import pytest

from tidemark.sources import files
from tidemark.streaming.sinks import export


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "orc"])
def test_round_trip_by_ending(spark, tmp_path, fmt):
    rows = files.records(spark, [(1, "é, \"x\""), (2, None)], "id int, name string")
    path = export(rows, str(tmp_path / f"t.{fmt}"), fmt)
    got = files.read_table(spark, path, "id int, name string")
    assert sorted(map(tuple, got.collect())) == [(1, 'é, "x"'), (2, None)]


def test_csv_infers_types_without_schema(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\n2,\n")
    assert files.read_csv(spark, str(tmp_path / "t.csv")).dtypes == [("a", "int"), ("b", "string")]


def test_csv_with_other_header_fails(spark, tmp_path):
    (tmp_path / "t.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="CSV header"):
        files.read_csv(spark, str(tmp_path / "t.csv"), "a int, b int").collect()


def test_missing_file_and_unknown_ending(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_csv(spark, str(tmp_path / "none.csv"), "a int")
    with pytest.raises(ValueError, match="no reader"):
        files.read_table(spark, "book.xlsx")


def test_required_columns(spark):
    with pytest.raises(ValueError, match="contexte, composant"):
        files.require_columns(spark.createDataFrame([], "pseudo string, evenement string"))


def test_export_refuses_no_results(spark, tmp_path):
    with pytest.raises(ValueError, match="no results"):
        export(spark.createDataFrame([], "a int"), str(tmp_path / "out"))


def test_csv_with_doubled_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,text\n1,"say ""hi"" x"\n2,"two\nlines, one cell"\n3," kept "\n')
    got = files.read_csv(spark, str(tmp_path / "t.csv"), "id int, text string", multi_line=True).collect()
    assert [tuple(r) for r in got] == [(1, 'say "hi" x'), (2, "two\nlines, one cell"), (3, " kept ")]
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv(spark, str(tmp_path / "t.csv"), "id int, text string").collect()


def test_csv_with_a_bad_number_fails(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id\n1\nx\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv(spark, str(tmp_path / "t.csv"), "id int").collect()
