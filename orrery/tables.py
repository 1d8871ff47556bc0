"""Access to the driver tables (one parquet file per table).

Reads are lazy; Catalyst prunes columns and pushes filters into the
parquet scan, so callers select only what they use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


_SCANS: dict[tuple[str, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one table. The scan DataFrame (file listing and parquet
    footer already resolved) is reused per session and path, so a query that
    refers to a table many times lists its files once."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    df = _SCANS.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        _SCANS[key] = df
    return df


class Tables:
    """Attribute access to the driver tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    def register_views(self) -> None:
        for name in TABLES:
            read_table(self.spark, self.sf_dir, name).createOrReplaceTempView(name)
