"""Keys of a whole schema: foreign keys of all tables in one pass per table,
and several unique keys of a table in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ForeignKey:
    """``child`` columns that must be found in ``parent`` columns (the same
    names unless given). With ``optional`` a key with a null in it is no
    violation; otherwise a null is a key that no parent has."""
    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...] = ()
    optional: bool = False
    name: str = ""

    @property
    def target(self) -> tuple[str, ...]:
        return self.parent_columns or self.columns

    @property
    def constraint(self) -> str:
        return self.name or f"{self.child}({','.join(self.columns)}) -> {self.parent}"


def _key(columns: Sequence[str]) -> Column:
    """A key as an array of texts: keys of all types and widths in one column."""
    return F.array(*[F.col(c).cast("string") for c in columns])


def key_text(key: Column | str) -> Column:
    """The key for people: its values joined by '|', nulls as NULL."""
    return F.array_join(key, "|", "NULL")


def foreign_key_report(tables: Mapping[str, DataFrame], keys: Sequence[ForeignKey]) -> DataFrame:
    """Q2 / Q3 for a schema: (child, constraint, key, n), one row for each
    key value without a parent and the rows that hold it; empty if all is well.

    Each child is scanned once, whatever number of constraints it has: a row
    gives one (constraint, key) pair for each. The pairs of all children are
    counted by one aggregate (a hot key is one row a task) and compared with
    the keys of all parents, tagged alike, by one anti-join. Each parent's
    key is scanned once. Values compare as texts, so a key and its parent
    must have types that print alike (integers of any width do).
    """
    if not keys:
        raise ValueError("no foreign keys given")
    numbers = {k: i for i, k in enumerate(keys)}
    # Constraints with one target share its rows.
    targets: dict[tuple[str, tuple[str, ...]], int] = {}
    for k in keys:
        targets.setdefault((k.parent, k.target), len(targets))
    pairs = None
    for child in dict.fromkeys(k.child for k in keys):
        mine = [k for k in keys if k.child == child]
        entries = F.array(*[F.struct(F.lit(numbers[k]).alias("no"), F.lit(targets[k.parent, k.target]).alias("target"), _key(k.columns).alias("key"),
                                     (F.lit(k.optional) & F.exists(_key(k.columns), lambda x: x.isNull())).alias("skip")) for k in mine])
        rows = tables[child].select(F.explode(entries).alias("e")).select("e.*").filter("not skip").drop("skip")
        pairs = rows if pairs is None else pairs.unionByName(rows)
    counted = pairs.groupBy("target", "key", "no").agg(F.count(F.lit(1)).alias("n"))
    parents = None
    for parent in dict.fromkeys(p for p, _ in targets):
        mine = [(cols, no) for (p, cols), no in targets.items() if p == parent]
        entries = F.array(*[F.struct(F.lit(no).alias("target"), _key(cols).alias("key")) for cols, no in mine])
        rows = tables[parent].select(F.explode(entries).alias("e")).select("e.*").filter(~F.exists("key", lambda x: x.isNull()))
        parents = rows if parents is None else parents.unionByName(rows)
    missing = counted.join(parents, ["target", "key"], "left_anti")
    names = F.create_map(*[x for k in keys for x in (F.lit(numbers[k]), F.struct(F.lit(k.child).alias("child"), F.lit(k.constraint).alias("constraint")))])
    return missing.select(names[F.col("no")].alias("of"), key_text("key").alias("key"), "n").select("of.child", "of.constraint", "key", "n")


def _grouped(df: DataFrame, key_sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """(constraint, key, n) of every value of every key set: one expand and
    one exchange (GROUPING SETS)."""
    columns = list(dict.fromkeys(c for cols in key_sets.values() for c in cols))
    # A set that is listed under two names is grouped once.
    distinct = list(dict.fromkeys(tuple(sorted(cols, key=columns.index)) for cols in key_sets.values()))
    counts = df.select(*columns).groupingSets([[F.col(c) for c in cols] for cols in distinct], *columns).agg(
        F.grouping_id().alias("__id"), F.count(F.lit(1)).alias("n"))
    # grouping_id has a 1 for each column that is not in the set, the first column highest.
    bits = {cols: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in cols) for cols in distinct}
    per_id: dict[int, list[tuple[str, Sequence[str]]]] = {}
    for name, cols in key_sets.items():
        per_id.setdefault(bits[tuple(sorted(cols, key=columns.index))], []).append((name, cols))
    choice = None
    for number, named in per_id.items():
        entries = F.array(*[F.struct(F.lit(name).alias("constraint"), _key(cols).alias("key")) for name, cols in named])
        choice = F.when(F.col("__id") == number, entries) if choice is None else choice.when(F.col("__id") == number, entries)
    return counts.select(F.explode(choice).alias("e"), "n").select("e.*", "n")


def unique_key_report(df: DataFrame, key_sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Q1 for several keys of a table: (constraint, key, n) of every value
    that stands in more than one row, from one scan. Nulls equal each other."""
    return _grouped(df, key_sets).filter("n > 1").select("constraint", key_text("key").alias("key"), "n")


def unique_key_summary(df: DataFrame, key_sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Q8 for several keys of a table, from one scan: constraint, n_rows,
    n_null (rows with a null in the key), n_blank (rows with a blank value in
    it), n_distinct (values without nulls) and n_duplicated (of these, the
    ones in more than one row)."""
    whole = ~F.exists("key", lambda x: x.isNull())
    blank = F.exists("key", lambda x: F.coalesce(F.trim(x) == "", F.lit(False)))
    return _grouped(df, key_sets).groupBy("constraint").agg(
        F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(~whole, F.col("n"))), F.lit(0)).alias("n_null"),
        F.coalesce(F.sum(F.when(blank, F.col("n"))), F.lit(0)).alias("n_blank"),
        F.count_if(whole).alias("n_distinct"), F.count_if(whole & (F.col("n") > 1)).alias("n_duplicated"))
