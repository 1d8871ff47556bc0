"""Scans, sources and sinks IO1-IO15.

Files are read as text columns (no schema inference) and typed afterwards
with ``try_cast``. Every reader is a lazy ``spark.read`` scan; the separator
and encoding of IO2 come from one aggregate over all lines.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.common import first_present  # noqa: F401  (IO15 lives with the column helpers)
from ..operators.keys import keep_last_per_key
from ..session import ensure_checkpoint_dir

# A null marker that never occurs in data: keeps 'NA', 'null' and '' as text.
NO_NULL_MARKER = "\u0001__no_null__\u0001"


def all_string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_delimited(spark: SparkSession, path: str | Sequence[str], sep: str = ";", encoding: str = "ISO-8859-1",
                   header: bool = True, columns: Sequence[str] | None = None, keep_literal_nulls: bool = False) -> DataFrame:
    """IO1 / IO3: delimited scan with a fixed separator and encoding; every
    column is a string. ``keep_literal_nulls`` keeps 'NA' and empty fields
    as data (IO3)."""
    r = spark.read.option("sep", sep).option("encoding", encoding).option("header", header)
    r = r.option("inferSchema", False).option("multiLine", False)
    if keep_literal_nulls:
        r = r.option("nullValue", NO_NULL_MARKER).option("emptyValue", "")
    if columns is not None:
        r = r.schema(all_string_schema(columns))
    return r.csv(path if isinstance(path, str) else list(path))


_SEPARATORS = (";", ",", "\t", "|")


def sniff_options(spark: SparkSession, path: str) -> dict:
    """IO2: separator and encoding from one pass over all lines (one row to
    the driver): UTF-8 unless any line is not valid UTF-8, then Latin-1; the
    candidate that stands in the most lines, the most frequent one among
    equals, a comma if there is none."""
    line = F.col("value")
    n = {i: F.length(line) - F.length(F.replace(line, F.lit(sep), F.lit(""))) for i, sep in enumerate(_SEPARATORS)}
    r = spark.read.text(path).agg(
        F.bool_and(F.is_valid_utf8(line)).alias("utf8"),
        *[F.count_if(c > 0).alias(f"lines{i}") for i, c in n.items()], *[F.sum(c).alias(f"all{i}") for i, c in n.items()]).first()
    best = max(range(len(_SEPARATORS)), key=lambda i: (r[f"lines{i}"], r[f"all{i}"] or 0, -i))
    return {"sep": _SEPARATORS[best] if r[f"lines{best}"] else ",", "encoding": "ISO-8859-1" if r["utf8"] is False else "UTF-8"}


def read_sniffed(spark: SparkSession, path: str, **kwargs) -> DataFrame:
    """IO2: delimited scan with sniffed separator and encoding fallback."""
    opts = sniff_options(spark, path)
    return read_delimited(spark, path, sep=opts["sep"], encoding=opts["encoding"], **kwargs)


def clean_header(name: str) -> str:
    """IO4: strip BOM, trim, lower, inner whitespace to '_'."""
    n = name.replace("﻿", "").strip().lower()
    return re.sub(r"\s+", "_", n)


def clean_headers(df: DataFrame) -> DataFrame:
    """IO4: metadata-only rename of every column."""
    return df.toDF(*[clean_header(c) for c in df.columns])


def read_many_with_key(spark: SparkSession, glob: str, key_pattern: str, key_col: str = "file_key",
                       fmt: str = "csv", **options) -> DataFrame:
    """IO5: one scan over many files; the partition key comes from the file
    name (``key_pattern`` regex with one group) via the file metadata
    column, replacing a loop of reads and a concat."""
    r = spark.read.format(fmt)
    for k, v in options.items():
        r = r.option(k, v)
    df = r.load(glob)
    return df.select("*", F.regexp_extract(F.col("_metadata.file_path"), key_pattern, 1).alias(key_col))


def cells_to_table(cells: DataFrame, headers: Sequence[str], title_row: int = 2, header_row: int = 3,
                   title_col: int = 1, section_col: str = "section", sheet: str = "sheet", row: str = "row",
                   col: str = "col", value: str = "value") -> DataFrame:
    """IO6: long cell table (sheet, row, col, value) of multi-section
    sheets to one table: the section title is the cell at (title_row,
    title_col), the header row names the columns, data rows follow;
    all-empty rows are dropped and rows are tagged with their section.
    ``headers`` lists the union of header names (the pivot values), so the
    schema is fixed and sheets with fewer columns get nulls."""
    titles = cells.filter((F.col(row) == title_row) & (F.col(col) == title_col)).select(
        sheet, F.trim(F.col(value)).alias(section_col))
    hdr = cells.filter(F.col(row) == header_row).select(sheet, col, F.lower(F.trim(F.col(value))).alias("__h"))
    data = cells.filter(F.col(row) > header_row).join(hdr, [sheet, col], "inner")
    wide = data.groupBy(sheet, row).pivot("__h", [h.lower() for h in headers]).agg(F.first(value, ignorenulls=True))
    names = [h.lower() for h in headers]
    nonempty = None
    for n in names:
        c = F.coalesce(F.trim(F.col(f"`{n}`")), F.lit("")) != ""
        nonempty = c if nonempty is None else nonempty | c
    return wide.filter(nonempty).join(titles, sheet, "left").select(sheet, row, section_col, *[F.col(f"`{n}`") for n in names])


def drop_unnamed_and_empty(df: DataFrame, pattern: str = r"^(unnamed|_c\d+)") -> DataFrame:
    """IO7: drop unnamed columns, then rows where every column is null."""
    keep = [c for c in df.columns if not re.match(pattern, c, flags=re.IGNORECASE)]
    return df.select(*keep).dropna(how="all")


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True, mode: str = "overwrite") -> None:
    """IO9: CSV sink with a header (parallel part files)."""
    df.write.mode(mode).option("sep", sep).option("header", header).csv(path)


def replace_table(df: DataFrame, path_or_table: str, partition_by: Sequence[str] = (), as_table: bool = False) -> None:
    """IO10: replace-all load: overwrite the target in one job (parallel
    writers; a JDBC target would add ``truncate=True``)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if as_table:
        w.saveAsTable(path_or_table)
    else:
        w.parquet(path_or_table)


def incremental_merge(previous: DataFrame, candidates: DataFrame, keys: Sequence[str], process,
                      load_order: str) -> DataFrame:
    """IO11: incremental cache: keys of ``candidates`` not yet in
    ``previous`` are processed by ``process`` (a DataFrame -> DataFrame
    function), appended, and the last row per key wins."""
    new = candidates.join(previous.select(*keys).distinct(), list(keys), "left_anti")
    merged = previous.unionByName(process(new), allowMissingColumns=True)
    return keep_last_per_key(merged, keys, [load_order])


def write_if_not_empty(report: DataFrame, path: str, fmt: str = "csv") -> bool:
    """IO12: write a QA report only when it has rows (one bounded probe)."""
    if report.isEmpty():
        return False
    report.write.mode("overwrite").format(fmt).option("header", True).save(path)
    return True


def order_columns(df: DataFrame, preferred: Sequence[str]) -> DataFrame:
    """IO13: preferred columns first (those present), the rest after."""
    first = [c for c in preferred if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """IO14: raise when required columns are missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"missing columns: {missing}")
    return df


def ensure_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """IO14: add missing columns as typed nulls ({name: type})."""
    out = df
    for c, t in columns.items():
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast(t))
    return out


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location (never a
    machine-local temp dir on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/orrery-scratch/{name}-{uuid.uuid4().hex[:12]}"
