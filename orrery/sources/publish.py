"""All-or-nothing loads with checks evaluated while writing, and exports of
one named file per key."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import QualityError
from . import files

BOM = "﻿"


def observed(df: DataFrame, rules: Mapping[str, Column], counts: Mapping[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """``df`` with an observation of its rows (``n_rows``), of the rows that
    break each rule (a null condition breaks it) and of further aggregates:
    measured by whatever job writes the rows, with no pass of their own."""
    seen = Observation()
    aggs = [F.count(F.lit(1)).alias("n_rows"), *[F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()],
            *[c.alias(name) for name, c in (counts or {}).items()]]
    return df.observe(seen, *aggs), seen


def publish_table(df: DataFrame, table: str, location: str, rules: Mapping[str, Column] | None = None,
                  reported: Mapping[str, Column] | None = None, counts: Mapping[str, Column] | None = None, keep: int = 1) -> dict:
    """IO10 / Q14: replace all rows of a catalog table, or none.

    The rows are written to a new folder below ``location`` and the table is
    pointed to it by one catalog change, so readers see the old rows or the
    new ones, and a load that fails leaves the old ones. ``rules`` (name ->
    condition that must hold) are blocking: they are counted by the write
    itself and, if any is broken, the new folder is removed and
    ``QualityError`` raised before the table changes. ``reported`` rules and
    ``counts`` (aggregates) are measured in the same job and only returned.
    ``keep`` earlier folders stay for readers that still use them; older ones
    go. A changed schema makes the table anew.

    Returns n_rows and all counts.
    """
    spark = df.sparkSession
    rules = dict(rules or {})
    folder = f"{location.rstrip('/')}/load-{uuid.uuid4().hex}"
    rows, seen = observed(df, rules | dict(reported or {}), counts)
    try:
        rows.write.parquet(folder)
        found = dict(seen.get)
        broken = {name: found[name] for name in rules if found[name]}
        if broken:
            raise QualityError(f"{table} is not loaded: {broken}")
        before = current_location(spark, table)
        if before is not None and spark.table(table).schema == spark.read.parquet(folder).schema:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(table)
        else:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            spark.catalog.createTable(table, path=folder, source="parquet", schema=spark.read.parquet(folder).schema)
    except BaseException:
        files.delete(spark, folder)
        raise
    _remove_old(spark, location, folder, before, keep)
    return found


def current_location(spark: SparkSession, table: str) -> str | None:
    """The folder a catalog table points to; None without the table."""
    if not spark.catalog.tableExists(table):
        return None
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()["data_type"]


def _remove_old(spark: SparkSession, location: str, now: str, before: str | None, keep: int) -> None:
    held = {now.rsplit("/", 1)[1], *([before.rstrip("/").rsplit("/", 1)[1]] if before and keep else [])}
    spare = max(0, keep - 1)
    old = [n for n in files.children(spark, location) if n.startswith("load-") and n not in held]
    for name in old[:max(0, len(old) - spare)]:
        files.delete(spark, f"{location.rstrip('/')}/{name}")


def write_file_per_key(df: DataFrame, path: str, key: str, name: str = "{key}.csv", sep: str = ",", bom: bool = False) -> list[str]:
    """IO5 / IO9: one CSV file with header per value of ``key``, named by it
    (``name`` with ``{key}``), directly below ``path``; returns the names.

    The rows of a key meet in one task, as one file has one writer; it sorts
    and streams them. Naming is one rename a file in the file system. A null
    key is named ``null``, a slash in a key ``%2F``. ``bom`` puts a byte order mark first.
    """
    spark = df.sparkSession
    stage = f"{path.rstrip('/')}/_stage-{uuid.uuid4().hex}"
    rest = [c for c in df.columns if c != key]
    out = df.select(F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("__key"), *rest)
    _with_bom(out.repartition("__key"), rest, bom).write.partitionBy("__key").option("sep", sep).option("header", True).csv(stage)
    names = []
    for folder in files.children(spark, stage):
        if folder.startswith("__key="):
            part, = (f for f in files.children(spark, f"{stage}/{folder}") if f.startswith("part-"))
            names.append(name.format(key=unquote(folder.removeprefix("__key=")).replace("/", "%2F")))
            files.rename(spark, f"{stage}/{folder}/{part}", f"{path.rstrip('/')}/{names[-1]}")
    files.delete(spark, stage)
    return sorted(names)


def _with_bom(df: DataFrame, columns: list[str], bom: bool) -> DataFrame:
    """The mark goes in front of the first header name, so tasks write it as
    the first bytes of their files."""
    return df.withColumnRenamed(columns[0], BOM + columns[0]) if bom else df


def write_csv_with_bom(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """IO9: CSV with header; every part file begins with a byte order mark."""
    _with_bom(df, df.columns, True).write.mode(mode).option("sep", sep).option("header", True).csv(path)


def read_files_by_name(spark: SparkSession, path: str, pattern: str, key_col: str = "file_key", **options) -> DataFrame:
    """IO5: one scan over many CSV files; the key is the group of ``pattern``
    in each file's name."""
    df = spark.read.options(**({"header": True} | options)).csv(path)
    # The metadata column has the name as in a URI; a plus stands for itself there.
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    return df.select("*", F.regexp_extract(name, pattern, 1).alias(key_col))
