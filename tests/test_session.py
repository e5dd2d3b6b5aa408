"""The shared folder."""

import pytest

from tidemark import session


class _Context:
    def __init__(self, master, configured=None):
        self.master, self.configured, self.folder = master, configured, None

    def getConf(self):  # noqa: N802
        return {"spark.checkpoint.dir": self.configured}

    def getCheckpointDir(self):  # noqa: N802
        return self.folder

    def setCheckpointDir(self, folder):  # noqa: N802
        self.folder = folder


class _Conf:
    def get(self, key, default):
        return default


class _Spark:
    def __init__(self, context):
        self.sparkContext, self.conf = context, _Conf()  # noqa: N803


def test_configured_folder_is_used():
    spark = _Spark(_Context("spark://host:7077", "s3a://bucket/shared"))
    assert session.shared_folder(spark) == "s3a://bucket/shared"
    assert spark.sparkContext.folder == "s3a://bucket/shared"


def test_a_cluster_needs_a_configured_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(_Spark(_Context("spark://host:7077")))


def test_one_process_may_use_a_temporary_folder():
    spark = _Spark(_Context("local[2]"))
    assert "tidemark-" in session.shared_folder(spark)


def test_cut_lineage_keeps_rows_and_types(spark):
    df = spark.range(10).selectExpr("id", "id % 3 part", "cast(id as string) s")
    for folder_per in (None, "part"):
        written = session.cut_lineage(df, "t", folder_per)
        assert written.select(df.columns).exceptAll(df).count() == 0
        assert dict(written.dtypes) == dict(df.dtypes)


def test_texts_go_to_python_a_few_at_a_time(spark):
    before = spark.conf.get(session.BATCH_ROWS)
    df = spark.range(0, 3 * session.TEXT_ROWS, numPartitions=1)
    sizes = df.mapInPandas(lambda batches: (b.iloc[:1].assign(id=len(b)) for b in batches), "id bigint")
    assert {r["id"] for r in session.cut_texts(sizes, "sizes").collect()} == {session.TEXT_ROWS}
    assert spark.conf.get(session.BATCH_ROWS) == before
    with session.batches_of(spark, 10):
        with session.batches_of(spark, 20):
            assert spark.conf.get(session.BATCH_ROWS) == "10"
    assert spark.conf.get(session.BATCH_ROWS) == before
