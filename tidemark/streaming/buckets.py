"""A sink with one current row per key, whose readers see whole epochs only.

Keys are dealt to buckets by hash. An epoch reads the buckets it touches, puts its rows in place of those with the same
key, and writes these buckets anew into a folder of its own. It becomes visible when its manifest, which says for every
bucket which folder holds it, is renamed into place in one step. A reader takes the last manifest; nothing that
any manifest names is ever overwritten, so a reader is never disturbed, and an epoch that failed half-way left nothing
that anyone reads. Each bucket has one version per reader, so there is nothing to compact.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import store

BUCKETS = 16
_BUCKET, _EPOCH = "_bucket", "_epoch"


def _manifests(spark: SparkSession, folder: str) -> list[str]:
    return [n for n in store.names(spark, f"{folder}/manifests") if n.endswith(".json")]


def manifest(spark: SparkSession, folder: str) -> dict:
    """The last published manifest: its ``epoch``, and ``buckets`` by number with the folder of each."""
    found = _manifests(spark, folder)
    return json.loads(store.read_text(spark, f"{folder}/manifests/{found[-1]}")) if found else {"epoch": -1, "buckets": {}}


def _rows(spark: SparkSession, folder: str, schema: str, versions: dict[str, str], buckets: Sequence[str]) -> DataFrame | None:
    paths = [f"{folder}/data/{versions[b]}/{_BUCKET}={b}" for b in buckets if b in versions]
    return spark.read.schema(schema).parquet(*paths) if paths else None


def current_view(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The current row of each key, as of the last whole epoch; empty before the first."""
    versions = manifest(spark, folder)["buckets"]
    rows = _rows(spark, folder, schema, versions, list(versions))
    return spark.createDataFrame([], schema) if rows is None else rows


def bucket_writer(folder: str, keys: Sequence[str], buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """Put each micro-batch in place of the rows with its keys. An epoch that is published already is left alone.

    Of several rows of a key in one batch, which update mode never emits, one stays. A null key value is a value. An error
    fails the query: an epoch must not commit unwritten.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        before = manifest(spark, folder)
        if before["epoch"] >= epoch_id:
            return
        number = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")
        batch = batch.withColumn(_BUCKET, number).persist()
        try:
            touched = [str(r[0]) for r in batch.select(_BUCKET).distinct().collect()]
            if not touched:
                return
            version = f"{epoch_id:012d}-{uuid.uuid4().hex}"
            columns = [c for c in batch.columns if c != _BUCKET]
            kinds = dict(batch.dtypes)
            schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns)
            old = _rows(spark, folder, schema, before["buckets"], touched)
            new = batch.select(*columns, _BUCKET, F.lit(1).alias(_EPOCH))
            if old is not None:
                new = new.unionByName(old.select(*columns, number.alias(_BUCKET), F.lit(0).alias(_EPOCH)))
            last = new.groupBy(_BUCKET, *keys).agg(
                F.max_by(F.struct(*[c for c in columns if c not in keys]), _EPOCH).alias("_row")
            )
            rows = last.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in columns], _BUCKET)
            # a bucket is one task's work and one file
            rows.repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(f"{folder}/data/{version}")
        finally:
            batch.unpersist()
        publish_manifest(spark, folder, epoch_id, before["buckets"] | {b: version for b in touched})

    return write


def publish_manifest(spark: SparkSession, folder: str, epoch_id: int, versions: dict[str, str]) -> None:
    """Make an epoch visible in one step; of two writers of one epoch the second fails."""
    draft = f"{folder}/drafts/{epoch_id:012d}-{uuid.uuid4().hex}"
    store.save_bytes(spark, draft, json.dumps({"epoch": epoch_id, "buckets": versions}).encode())
    target = f"{folder}/manifests/{epoch_id:012d}.json"
    if not store.names(spark, f"{folder}/manifests"):
        store.save_bytes(spark, f"{folder}/manifests/_folder", b"")
    store.rename_new(spark, draft, target)


def forget(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Delete manifests but the last ``keep``, and the folders that none of these names; returns the deleted folders."""
    found = _manifests(spark, folder)
    for name in found[: max(0, len(found) - keep)]:
        store.remove(spark, f"{folder}/manifests/{name}")
    named = set()
    for name in _manifests(spark, folder):
        named |= set(json.loads(store.read_text(spark, f"{folder}/manifests/{name}"))["buckets"].values())
    gone = [v for v in store.names(spark, f"{folder}/data") if v not in named]
    for version in gone:
        store.remove(spark, f"{folder}/data/{version}")
    return gone
