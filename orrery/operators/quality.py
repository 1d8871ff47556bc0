"""Data-quality operators Q1-Q16. Each returns a report DataFrame that is
empty on clean data; ``assert_empty`` turns a report into a blocking check
(Q14). Reports are written by the caller only when non-empty (IO12)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from ..functions.common import ColumnOrName, col, pct, round_half_up
from .joins import anti_join, attach_scalars
from .quantiles import quantiles, quantiles_of


class QualityError(AssertionError):
    pass


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "n") -> DataFrame:
    """Q1: key and count where the key repeats."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).filter(F.col(count_col) > 1)


def orphans(child: DataFrame, parent: DataFrame, child_key: str | Sequence[str],
            parent_key: str | Sequence[str] | None = None, ignore_null: bool = False) -> DataFrame:
    """Q2 / Q3: child rows whose foreign key has no parent. Null keys count
    as orphans unless ``ignore_null`` (optional relation)."""
    ck = [child_key] if isinstance(child_key, str) else list(child_key)
    src = child.dropna(subset=ck) if ignore_null else child
    return anti_join(src, parent, ck, parent_key)


def null_coordinates(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Q4: rows with a missing coordinate."""
    return df.filter(F.col(lat).isNull() | F.col(lon).isNull())


def out_of_range(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Q5: rows with any value outside its closed range; null is not a
    violation."""
    cond = None
    for c, (lo, hi) in bounds.items():
        bad = F.coalesce(~F.col(c).between(lo, hi), F.lit(False))
        cond = bad if cond is None else cond | bad
    return df.filter(cond)


def missing_coverage(df: DataFrame, ref: DataFrame, key: str | Sequence[str],
                     ref_key: str | Sequence[str] | None = None, context: Sequence[str] = ()) -> DataFrame:
    """Q6: entities without a match in ``ref`` with context columns."""
    miss = anti_join(df, ref, key, ref_key)
    ks = [key] if isinstance(key, str) else list(key)
    return miss.select(*ks, *[c for c in context if c not in ks]) if context else miss


def unmatched_report(df: DataFrame, ref: DataFrame, key: str, ref_key: str | None = None,
                     extra: Sequence[str] = (), count_col: str = "frequency") -> DataFrame:
    """Q7: unmatched key values with their frequency, most frequent first."""
    miss = anti_join(df, ref, key, ref_key)
    return miss.groupBy(key, *extra).agg(F.count(F.lit(1)).alias(count_col))


def key_summary(df: DataFrame, key: str) -> DataFrame:
    """Q8: rows, nulls, blanks, distinct values and duplicated values of a key."""
    k = F.col(key)
    blank = F.trim(k.cast("string")) == ""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    dups = per_key.agg(F.count_if(F.col(key).isNotNull() & (F.col("__n") > 1)).alias("duplicated_values"))
    base = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(k.isNull()).alias("n_null"),
        F.count_if(F.coalesce(blank, F.lit(False))).alias("n_blank"),
        F.countDistinct(k).alias("n_distinct"),
    )
    return attach_scalars(base, dups)


def column_profile(df: DataFrame, scale: int = 2) -> DataFrame:
    """Q9 / Q12: one row per column: kind, nulls, null %, max text length,
    min / max (as text) and max decimals of numeric values, from a single
    aggregate pass over the table."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    kinds = {}
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        s = c.cast("string")
        kind = "numeric" if isinstance(f.dataType, NumericType) else (
            "text" if isinstance(f.dataType, StringType) else f.dataType.simpleString())
        kinds[f.name] = kind
        # Through decimal, as the text of a small or large double is in powers of ten.
        decimals = F.length(F.regexp_extract(F.coalesce(c.try_cast("decimal(38,18)").cast("string"), s), r"\.(\d*?)0*$", 1)) if kind == "numeric" else F.lit(None)
        aggs += [
            F.count_if(c.isNull()).alias(f"{f.name}__nulls"),
            F.max(F.length(s)).alias(f"{f.name}__maxlen"),
            (F.min(c).cast("string")).alias(f"{f.name}__min"),
            (F.max(c).cast("string")).alias(f"{f.name}__max"),
            F.max(decimals).cast("int").alias(f"{f.name}__dec"),
        ]
    wide = df.agg(*aggs)
    rows = [F.struct(
        F.lit(i + 1).alias("position"), F.lit(name).alias("column_name"), F.lit(kind).alias("kind"),
        F.col(f"{name}__nulls").alias("n_null"),
        round_half_up(pct(f"{name}__nulls", "__rows"), scale).alias("null_pct"),
        F.col(f"{name}__maxlen").alias("max_length"),
        F.col(f"{name}__min").alias("min_value"), F.col(f"{name}__max").alias("max_value"),
        F.col(f"{name}__dec").alias("max_decimals"),
    ) for i, (name, kind) in enumerate(kinds.items())]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def functional_dependency_violations(df: DataFrame, determinant: Sequence[str], dependent: str,
                                     count_col: str = "n_values") -> DataFrame:
    """Q10 / Q11: determinant values mapped to more than one dependent value."""
    return (df.groupBy(*determinant).agg(F.countDistinct(dependent).alias(count_col))
            .filter(F.col(count_col) > 1))


def iqr_bounds(df: DataFrame, column: str, k: float = 1.5, keys: Sequence[str] = ()) -> DataFrame:
    """Q13: Q1, Q3, IQR and the k*IQR fences (global or per group)."""
    b = quantiles(df, column, {"q1": 0.25, "q3": 0.75}, keys)
    return (b.withColumn("iqr", F.col("q3") - F.col("q1"))
            .withColumn("lower_fence", F.col("q1") - k * F.col("iqr"))
            .withColumn("upper_fence", F.col("q3") + k * F.col("iqr")))


def iqr_flags(df: DataFrame, columns: Sequence[str], k: float = 1.5, any_col: str = "is_outlier") -> DataFrame:
    """Q13: per-row outlier flag for each column (``<col>_outlier``) and any."""
    j = attach_scalars(df, quantiles_of(df, {f"__{c}_{q}": (c, p) for c in columns for q, p in (("q1", 0.25), ("q3", 0.75))}))
    any_expr = F.lit(False)
    for c in columns:
        q1, q3 = F.col(f"__{c}_q1"), F.col(f"__{c}_q3")
        iqr = q3 - q1
        flag = F.coalesce((F.col(c) < q1 - k * iqr) | (F.col(c) > q3 + k * iqr), F.lit(False))
        j = j.withColumn(f"{c}_outlier", flag)
        any_expr = any_expr | F.col(f"{c}_outlier")
    j = j.withColumn(any_col, any_expr)
    return j.drop(*[f"__{c}_{q}" for c in columns for q in ("q1", "q3")])


def iqr_summary(df: DataFrame, column: str, k: float = 1.5, scale: int = 2) -> DataFrame:
    """Q13: bounds plus outlier count and percentage."""
    j = attach_scalars(df.select(column), iqr_bounds(df, column, k))
    is_out = (F.col(column) < F.col("lower_fence")) | (F.col(column) > F.col("upper_fence"))
    return j.agg(
        round_half_up(F.first("q1"), scale).alias("q1"), round_half_up(F.first("q3"), scale).alias("q3"),
        round_half_up(F.first("lower_fence"), scale).alias("lower_fence"),
        round_half_up(F.first("upper_fence"), scale).alias("upper_fence"),
        F.count_if(F.coalesce(is_out, F.lit(False))).alias("n_outliers"),
        round_half_up(F.avg(F.coalesce(is_out, F.lit(False)).cast("int")) * 100, scale).alias("outlier_pct"),
    )


def assert_empty(report: DataFrame, message: str) -> None:
    """Q14: blocking assertion (one bounded ``isEmpty`` probe)."""
    if not report.isEmpty():
        raise QualityError(message)


def repeated_names(df: DataFrame, name: str, key: str | None = None, count_col: str = "n") -> DataFrame:
    """Q15: rows whose normalised name is shared with another entity
    (names compared lower-cased and trimmed), via a semi join of the
    repeated names."""
    norm = F.lower(F.trim(F.col(name)))
    counted = df.withColumn("__name", norm)
    agg = F.countDistinct(key) if key else F.count(F.lit(1))
    rep = counted.groupBy("__name").agg(agg.alias(count_col)).filter(F.col(count_col) > 1)
    return counted.join(rep, "__name", "inner").drop("__name")


def rule_violations(df: DataFrame, rules: Mapping[str, Column], key: Sequence[str],
                    rule_col: str = "rule") -> DataFrame:
    """Evaluate a table of rules (name -> condition that must
    hold) in one pass; a null condition is a violation (NOT NULL checks).
    Returns (key..., rule) per violation."""
    names = list(rules)
    failed = F.filter(
        F.array(*[F.when(~F.coalesce(rules[n], F.lit(False)), F.lit(n)) for n in names]),
        lambda x: x.isNotNull())
    return (df.select(*key, failed.alias("__failed"))
            .select(*key, F.explode("__failed").alias(rule_col)))


def rule_summary(df: DataFrame, rules: Mapping[str, Column], rule_col: str = "rule",
                 count_col: str = "n_violations") -> DataFrame:
    """Q16: violations per rule, all rules listed (zero when clean)."""
    aggs = [F.count_if(~F.coalesce(c, F.lit(False))).alias(f"__r{i}") for i, c in enumerate(rules.values())]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(n).alias(rule_col), F.col(f"__r{i}").alias(count_col)) for i, n in enumerate(rules)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with the first failed rule)."""
    ok = F.lit(True)
    reason = None
    for n, c in rules.items():
        good = F.coalesce(c, F.lit(False))
        ok = ok & good
        reason = F.when(~good, F.lit(n)) if reason is None else reason.when(~good, F.lit(n))
    return df.filter(ok), df.filter(~ok).withColumn("rejected_rule", reason)
