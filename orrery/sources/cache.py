"""IO11: a latest-per-key table that costs what is new.

The rows lie in folders by a hash of the key. An update reads and writes the
folders of its keys only; all others keep their files. Merging keeps the last
row per key, so an update that runs twice changes nothing.

The merged folders are first written whole beside the table and then put in
its place by a dynamic partition overwrite. If that is interrupted, the next
update or read finds the finished copy and puts it in place again. One
writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import keep_last_per_key
from ..session import cut_lineage
from . import files

BUCKET = "key_bucket"


def bucket(keys: Sequence[str], buckets: int) -> Column:
    """The folder of a key: a hash of its values, the same on every run."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _pending(path: str) -> str:
    return f"{path.rstrip('/')}.pending"


def _place(spark: SparkSession, path: str) -> None:
    spark.read.parquet(_pending(path)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    files.delete(spark, _pending(path))


def recover(spark: SparkSession, path: str) -> None:
    """Finish or drop what an interrupted update left behind."""
    if files.exists(spark, f"{_pending(path)}/_SUCCESS"):
        _place(spark, path)
    else:
        files.delete(spark, _pending(path))


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table with its folder column; None if there is no folder yet. Any
    other fault of the table shows."""
    if not any(n.startswith(f"{BUCKET}=") for n in files.children(spark, path)):
        return None
    return spark.read.parquet(path)


def read_cache(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of the table, or None before the first update."""
    recover(spark, path)
    found = _stored(spark, path)
    return None if found is None else found.drop(BUCKET)


def upsert(rows: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], buckets: int = 256) -> int:
    """Merge rows into the table, the last one per key by ``order``; returns
    how many of its folders were written (``buckets`` at most, which is also
    what the driver gets to know). ``buckets`` must stay the same for a table.
    Columns must be those of the table."""
    spark = rows.sparkSession
    recover(spark, path)
    new = keep_last_per_key(rows, list(keys), list(order)).withColumn(BUCKET, bucket(keys, buckets))
    stored = _stored(spark, path)
    # The new rows are computed once; what is read again is this copy.
    new.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{_pending(path)}.new")
    try:
        touched = [int(n.split("=")[1]) for n in files.children(spark, f"{_pending(path)}.new") if n.startswith(f"{BUCKET}=")]
        if not touched:
            return 0
        merged = spark.read.parquet(f"{_pending(path)}.new")
        if stored is not None:
            merged = stored.filter(F.col(BUCKET).isin(touched)).unionByName(merged)
            merged = keep_last_per_key(merged, [BUCKET, *keys], list(order))
        merged.repartition(BUCKET, *keys[:1]).write.partitionBy(BUCKET).parquet(_pending(path))
    finally:
        files.delete(spark, f"{_pending(path)}.new")
    _place(spark, path)
    return len(touched)


@dataclass(frozen=True)
class Update:
    written: int          # folders written
    remainder: DataFrame  # candidate keys not in the table yet


def update_cache(path: str, candidates: DataFrame, keys: Sequence[str], process: Callable[[DataFrame], DataFrame],
                 order: Sequence[str], batch: int | None = None, buckets: int = 256) -> Update:
    """Process the candidate keys that the table lacks, the first ``batch`` of
    them by key if given, and merge the results.

    ``process`` takes a DataFrame of keys and returns rows. The remainder is
    what a later call goes on with, checkpointed, as the table's files change
    meanwhile; a key for which ``process`` returns no row stays in it. Null
    keys are not cached.
    """
    spark = candidates.sparkSession
    wanted = candidates.select(*keys).dropna().distinct()

    def lacking() -> DataFrame:
        known = read_cache(spark, path)
        return wanted if known is None else wanted.join(known.select(*keys), list(keys), "left_anti")
    todo = lacking()
    if batch is not None:
        todo = todo.orderBy(*keys).limit(batch)
    written = upsert(process(todo), path, keys, order, buckets)
    return Update(written, cut_lineage(lacking()))
