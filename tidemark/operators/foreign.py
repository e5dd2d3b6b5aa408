"""Scoring with models that other libraries saved: a file with an object that has ``predict`` and ``predict_proba``.

The file is read through Spark, so it may lie in any store Spark reads, and sent to each executor once. A task unpacks
it once for all its rows, which reach it as Arrow batches.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions.numbers import clip
from tidemark.operators.features import event_counts
from tidemark.sources.files import require_columns

# Send the functions themselves to the workers, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A model is held by every executor and every worker.
MOST_BYTES = 512 << 20

PREDICTION, PROBABILITY = "prediction", "probability"


def ship(spark: SparkSession, path: str, most: int = MOST_BYTES) -> Broadcast:
    """The bytes of a saved model, sent to the executors. A missing file, or one of more than ``most`` bytes, is an error."""
    files = spark.read.format("binaryFile").load(path)
    sizes = [r["length"] for r in files.select("length").collect()]
    if len(sizes) != 1 or sizes[0] > most:
        raise ValueError(f"{path!r}: expected one file of at most {most} bytes, found sizes {sizes}")
    return spark.sparkContext.broadcast(bytes(files.select("content").first()["content"]))


def scores(
    rows: DataFrame,
    path: str,
    features: Sequence[str],
    loads: Callable[[bytes], object] = pickle.loads,
    probability: bool = False,
) -> DataFrame:
    """``rows`` with ``prediction``, and with ``probability`` of class 1, from the model saved at ``path``.

    The model gets a float array with the features in the given order, missing values as NaN. ``loads`` unpacks the file;
    the default runs whatever the file says, so give it trusted files only.
    """
    shipped = ship(rows.sparkSession, path)

    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        model = loads(shipped.value)
        for columns in batches:
            x = np.column_stack([c.to_numpy(dtype=float, na_value=np.nan) for c in columns])
            found = {PREDICTION: np.asarray(model.predict(x), dtype=float)}
            if probability:
                found[PROBABILITY] = np.asarray(model.predict_proba(x), dtype=float)[:, 1]
            yield pd.DataFrame(found)

    names = [PREDICTION, PROBABILITY] if probability else [PREDICTION]
    udf = F.pandas_udf(score, ", ".join(f"{n} double" for n in names))
    scored = rows.withColumn("_scores", udf(*[F.col(f).cast("double") for f in features]))
    return scored.select(*rows.columns, *[F.col("_scores")[n].alias(n) for n in names])


def score_entities(
    events: DataFrame,
    note_path: str,
    pass_path: str,
    features: Sequence[str],
    entity: str = "pseudo",
    event: str = "evenement",
    required: Sequence[str] = fixed.LEARNING_COLUMNS,
    loads: Callable[[bytes], object] = pickle.loads,
) -> DataFrame:
    """Event log to (pseudo, note in 0..20, reussite 0/1, proba) with two saved models of another library."""
    counts = event_counts(require_columns(events, required), entity, event, features)
    noted = scores(counts, note_path, features, loads).withColumnRenamed(PREDICTION, "note")
    passed = scores(noted, pass_path, features, loads, probability=True)
    return passed.select(
        F.col(entity).alias("pseudo"),
        clip(F.col("note"), fixed.SCORE_FLOOR, fixed.SCORE_CEILING).alias("note"),
        F.col(PREDICTION).cast("int").alias("reussite"),
        F.col(PROBABILITY).alias("proba"),
    )
