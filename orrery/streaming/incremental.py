"""Incremental latest-per-key table maintained by Structured Streaming.

Each micro-batch (``foreachBatch``) is merged into a table that lies in
folders by a hash of the key (``sources.cache``): only the folders of the
batch's keys are read and written. Merging keeps the last row per key, so a
batch that is run again after a failure gives the same table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..sources import cache


def read_latest(spark: SparkSession, target: str) -> DataFrame | None:
    """The table, or None before the first batch. A table that cannot be read raises."""
    return cache.read_cache(spark, target)


def merge_batch(batch: DataFrame, epoch_id: int, target: str, keys: Sequence[str], order: Sequence[str], buckets: int = 256) -> None:
    """``epoch_id`` is what ``foreachBatch`` passes; the merge is the same for any."""
    cache.upsert(batch, target, keys, order, buckets)


def upsert_latest_stream(spark: SparkSession, source_dir: str, schema: StructType, target: str,
                         checkpoint: str, keys: Sequence[str], order: Sequence[str], fmt: str = "parquet", buckets: int = 256):
    """Start a stream over ``source_dir`` that keeps the latest row per key
    in ``target``. Returns the StreamingQuery; use ``trigger(availableNow=True)``
    semantics by calling ``awaitTermination``."""
    def merge(batch: DataFrame, epoch_id: int) -> None:
        merge_batch(batch, epoch_id, target, keys, order, buckets)

    stream = spark.readStream.schema(schema).format(fmt).load(source_dir)
    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
