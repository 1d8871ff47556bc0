"""Joins J1-J15.

No join carries a broadcast hint: Catalyst's size statistics and AQE pick
broadcast or sort-merge at run time, and AQE's skew-join split handles a hot
key on the sort-merge path. One-row aggregates come in as scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def scalars(stats: DataFrame) -> dict[str, Column]:
    """The columns of a one-row aggregate as fields of one scalar subquery
    (computed once, even when its plan is not deterministic)."""
    sub = stats.select(F.struct(*[F.col(f"`{c}`") for c in stats.columns]).alias("__s")).scalar()
    return {c: sub.getField(c) for c in stats.columns}


def attach_scalars(df: DataFrame, *stats: DataFrame) -> DataFrame:
    """Add every column of one or more one-row aggregates (global statistics
    such as min / max, quantile bounds, totals, centroids) to each row of
    ``df`` as constants. Each aggregate becomes one scalar subquery, run
    once; no join is planned."""
    out = df
    names = []
    for i, st in enumerate(stats):
        sub = st.select(F.struct(*[F.col(f"`{c}`") for c in st.columns]).alias("__s")).scalar()
        out = out.select("*", sub.alias(f"__scalar{i}"))
        names.append((f"__scalar{i}", st.columns))
    fields = [F.col(f"{s_}.`{c}`").alias(c) for s_, cols in names for c in cols]
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *fields)


def lookup_join(fact: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column,
                how: str = "left") -> DataFrame:
    """Fact-to-dimension equi-join (single or composite key)."""
    return fact.join(dim, on, how)


def role_join(fact: DataFrame, dim: DataFrame, dim_key: str, roles: Mapping[str, str],
              how: str = "inner") -> DataFrame:
    """The same dimension joined once per role. ``roles`` maps the fact
    column to a prefix; dimension columns come back as ``<prefix>_<col>``."""
    out = fact
    for fact_col, prefix in roles.items():
        renamed = dim.select(*[F.col(c).alias(f"{prefix}_{c}") for c in dim.columns])
        out = out.join(renamed, out[fact_col] == renamed[f"{prefix}_{dim_key}"], how)
        out = out.drop(f"{prefix}_{dim_key}")
    return out


def anti_join(df: DataFrame, ref: DataFrame, left_on: str | Sequence[str],
              right_on: str | Sequence[str] | None = None, distinct_keys: bool = False) -> DataFrame:
    """Rows of ``df`` whose key has no match in ``ref``.
    Rows with a null key never match, so they are returned (as the
    left-join + IS NULL views do). ``distinct_keys`` returns only the
    distinct unmatched keys (merge-indicator form)."""
    lk = [left_on] if isinstance(left_on, str) else list(left_on)
    rk = lk if right_on is None else ([right_on] if isinstance(right_on, str) else list(right_on))
    base = df.select(*lk).distinct() if distinct_keys else df
    r = ref.select(*[F.col(b).alias(f"__r{i}") for i, b in enumerate(rk)]).distinct()
    cond = None
    for i, a in enumerate(lk):
        c = base[a] == r[f"__r{i}"]
        cond = c if cond is None else cond & c
    return base.join(r, cond, "left_anti")


def reconcile_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two-sided key reconciliation in one full outer join of the
    distinct keys: ``side`` is 'both', 'left_only' or 'right_only'."""
    ka = a.select(*keys).distinct().withColumn("__a", F.lit(True))
    kb = b.select(*keys).distinct().withColumn("__b", F.lit(True))
    j = ka.join(kb, list(keys), "full_outer")
    side = (F.when(F.col("__a") & F.col("__b"), "both")
            .when(F.col("__a"), "left_only").otherwise("right_only"))
    return j.select(*keys, side.alias("side"))


def expand_to_members(rows: DataFrame, bridge: DataFrame, parent_key: str,
                      member_cols: Sequence[str], replicated_flag: str | None = "is_replicated") -> DataFrame:
    """Replicate parent-level rows to every member of the parent via a
    distinct bridge; tags the rows as replicated (F11 lineage)."""
    members = bridge.select(parent_key, *member_cols).distinct()
    out = rows.join(members, parent_key, "inner")
    if replicated_flag:
        out = out.withColumn(replicated_flag, F.lit(True))
    return out


class CardinalityError(ValueError):
    pass


def assert_join_cardinality(left: DataFrame, right: DataFrame, keys: Sequence[str],
                            validate: str = "m:1") -> None:
    """Raise when the side declared unique repeats a key
    ('1:1', '1:m', 'm:1'; 'm:m' checks nothing). One aggregate job with a
    one-row result per side."""
    def has_dupes(df: DataFrame) -> bool:
        return not df.groupBy(*keys).count().filter("count > 1").isEmpty()
    left_unique = validate in ("1:1", "1:m", "one_to_one", "one_to_many")
    right_unique = validate in ("1:1", "m:1", "one_to_one", "many_to_one")
    if left_unique and has_dupes(left):
        raise CardinalityError(f"left keys {list(keys)} are not unique ({validate})")
    if right_unique and has_dupes(right):
        raise CardinalityError(f"right keys {list(keys)} are not unique ({validate})")


def map_values(df: DataFrame, column: str, mapping: DataFrame | Mapping, key_col: str = "key",
               value_col: str = "value", mode: str = "map", output: str | None = None) -> DataFrame:
    """Dictionary lookup through a join with a mapping table.
    ``mode='map'``: unmapped -> null; ``mode='replace'``: unmapped keep
    their value. A Python dict becomes a literal map expression (no join);
    a DataFrame mapping is joined (Catalyst broadcasts it by size); a key it
    repeats maps to the smallest of its values, nulls last."""
    out_col = output or column
    if isinstance(mapping, Mapping):
        m = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
        looked = F.element_at(m, F.col(column)) if mapping else F.lit(None)
        val = looked if mode == "map" else F.coalesce(looked, F.col(column))
        return df.withColumn(out_col, val)
    mt = mapping.groupBy(F.col(key_col).alias("__mk")).agg(F.min(value_col).alias("__mv"))
    j = df.join(mt, df[column] == mt["__mk"], "left")
    val = F.col("__mv") if mode == "map" else F.coalesce(F.col("__mv"), F.col(column))
    return j.withColumn(out_col, val).drop("__mk", "__mv")


def fill_from_source(primary: DataFrame, secondary: DataFrame, keys: Sequence[str],
                     columns: Sequence[str], source_col: str = "source",
                     primary_tag: str = "primary", secondary_tag: str = "secondary") -> DataFrame:
    """Left join a second source and fill gaps (primary wins), with a
    tag saying where each row's value came from."""
    sec = secondary.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in columns])
    j = primary.join(sec, list(keys), "left")
    first = columns[0]
    tag = (F.when(F.col(first).isNotNull(), F.lit(primary_tag))
           .when(F.col(f"__s_{first}").isNotNull(), F.lit(secondary_tag)))
    j = j.withColumn(source_col, tag)
    for c in columns:
        j = j.withColumn(c, F.coalesce(F.col(c), F.col(f"__s_{c}"))).drop(f"__s_{c}")
    return j


def left_join_chain(base: DataFrame, parts: Sequence[DataFrame], key: str | Sequence[str],
                    zero_fill: Sequence[str] = ()) -> DataFrame:
    """Successive left joins of one-row-per-key parts, then
    ``coalesce(c, 0)`` on ``zero_fill``. All parts are grouped by the same
    key, so their hash partitioning is shared."""
    out = base
    for p in parts:
        out = out.join(p, key, "left")
    for c in zero_fill:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)))
    return out


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join one-row-per-group results back on keys that may be null."""
    r = right.select(*[F.col(k).alias(f"__n_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(r[f"__n_{k}"])
    return left.join(r, cond, how).drop(*[f"__n_{k}" for k in keys])


def counts_per_parent(parent: DataFrame, parent_key: str, children: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per-parent child counts, zero-filled (the decorrelated form
    of one scalar subquery per child table)."""
    out = parent
    for name, (child, fk) in children.items():
        agg = child.groupBy(F.col(fk).alias(parent_key)).agg(F.count(F.lit(1)).alias(name))
        out = out.join(agg, parent_key, "left")
    for name in children:
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("bigint"))
    return out


def map_distinct(df: DataFrame, column: str, fn, outputs: Sequence[str] | str) -> DataFrame:
    """Apply an expensive column function once per distinct value instead of
    once per row: distinct values (an aggregate that combines map-side) ->
    ``fn`` (a function DataFrame -> DataFrame adding ``outputs``) -> join back
    on the value (null-safe). For low-cardinality text such as place names
    the work grows with the number of names, not rows."""
    outs = [outputs] if isinstance(outputs, str) else list(outputs)
    d = df.select(F.col(column).alias("__dv")).distinct()
    mapped = fn(d).select("__dv", *outs)
    j = df.join(mapped, df[column].eqNullSafe(mapped["__dv"]), "left")
    return j.drop("__dv")
