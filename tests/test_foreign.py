"""Saved models of other libraries, scored on the executors."""

import pickle

import numpy as np
import pytest
from pyspark import cloudpickle

from tidemark.operators import foreign
from tidemark.sources.store import save_bytes


def build():
    class Stump:
        """Stands for an estimator of another library."""

        def predict(self, x):
            return np.where(np.nan_to_num(x[:, 0], nan=-1.0) > 3, 1, 0)

        def predict_proba(self, x):
            p = 1 / (1 + np.exp(-np.nan_to_num(x).sum(axis=1)))
            return np.column_stack([1 - p, p])

    return Stump()


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, float(i % 7), float(i) / 50) for i in range(300)] + [(300, None, 1.0)]
    return spark.createDataFrame(data, "id int, a double, b double").repartition(4), data


def test_same_as_local_scoring(spark, rows, tmp_path):
    table, data = rows
    model = build()
    path = save_bytes(spark, str(tmp_path / "model.pkl"), cloudpickle.dumps(model))
    got = foreign.scores(table, path, ["a", "b"], probability=True).orderBy("id").collect()
    x = np.array([[np.nan if a is None else a, b] for _, a, b in data])
    assert [r.prediction for r in got] == model.predict(x).tolist()
    assert [r.probability for r in got] == pytest.approx(model.predict_proba(x)[:, 1])
    assert got[0].__fields__ == ["id", "a", "b", "prediction", "probability"]


def test_unpacked_once_per_task(spark, rows, tmp_path):
    table, _ = rows
    path = save_bytes(spark, str(tmp_path / "model.pkl"), cloudpickle.dumps(build()))
    loaded = spark.sparkContext.accumulator(0)

    def loads(data):
        loaded.add(1)
        return pickle.loads(data)

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        assert foreign.scores(table, path, ["a", "b"], loads).count() == 301
        foreign.scores(table, path, ["a", "b"], loads).agg({"prediction": "sum"}).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert 1 <= loaded.value <= 4


def test_missing_and_large_files(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        foreign.ship(spark, str(tmp_path / "none.pkl"))
    path = save_bytes(spark, str(tmp_path / "model.pkl"), b"x" * 100)
    with pytest.raises(ValueError, match="at most 10 bytes"):
        foreign.ship(spark, path, most=10)
