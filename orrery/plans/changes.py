"""P14-P17 together: a batch of mixed plan changes, replayed in commit order.

Changes of a table are rows of that table with ``seq`` (commit order, unique
in the whole batch) and ``op``:

- ``insert``: takes effect if the key has no row at that moment (P14);
- ``upsert``: the row becomes the key's row (P15);
- ``delete``: the key's row goes; a row of the parent table takes along the
  rows of all child tables that name it, as they are at that moment (P17);
- ``append``: a row of its own (P16), in tables that only grow.

Nothing is replayed row by row. What a key ends with follows from its last
deletion: of the writes after it the last upsert, else the stored row if
there was no deletion, else the first insert. So a table is a join with the
last deletions and one aggregate per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import null_safe_join
from ..operators.keys import keep_last_per_key


@dataclass(frozen=True)
class Entity:
    """A table and its natural key. A child names its row of ``parent`` by
    ``parent_key``, in the order of the parent's key and, unless the table
    only grows (``appends``), part of its own key."""
    key: tuple[str, ...]
    parent: str | None = None
    parent_key: tuple[str, ...] = ()
    appends: bool = False

    @property
    def ops(self) -> tuple[str, ...]:
        return ("append", "delete") if self.appends else ("insert", "upsert", "delete")


class ChangeError(ValueError):
    pass


def check_entities(entities: Mapping[str, Entity]) -> None:
    for name, e in entities.items():
        if e.parent is None:
            continue
        if e.parent not in entities:
            raise ChangeError(f"{name} has the parent {e.parent}, which is no entity")
        if entities[e.parent].parent is not None:
            raise ChangeError(f"{name}: only one level of children is replayed")
        if len(e.parent_key) != len(entities[e.parent].key):
            raise ChangeError(f"{name}: the key of {e.parent} has {len(entities[e.parent].key)} columns")
        if not e.appends and not set(e.parent_key) <= set(e.key):
            raise ChangeError(f"{name}: a row that can be replaced must have its parent in its key")


def _last_deletion(changes: DataFrame, key: Sequence[str], names: Sequence[str], out: str) -> DataFrame:
    return changes.filter("op = 'delete'").groupBy(*[F.col(k).alias(n) for k, n in zip(key, names)]).agg(F.max("seq").alias(out))


def replay(tables: Mapping[str, DataFrame], changes: Mapping[str, DataFrame], entities: Mapping[str, Entity]) -> dict[str, DataFrame]:
    """The tables after all changes, lazily, with their own columns. Stored
    tables have one row a key (those that only grow: any rows). Null keys are
    keys like others. A change with another op than the table allows is an
    error when the result is computed."""
    check_entities(entities)
    for name in changes:
        if name not in entities:
            raise ChangeError(f"changes of {name}, which is no entity")
    return {name: _replay_one(name, tables[name], changes, entities) for name in tables}


def _replay_one(name: str, stored: DataFrame, changes: Mapping[str, DataFrame], entities: Mapping[str, Entity]) -> DataFrame:
    entity, columns = entities[name], stored.columns
    rows = stored.select(*columns, F.lit(None).cast("long").alias("seq"), F.lit("stored").alias("op"))
    mine = changes.get(name)
    if mine is not None:
        ok = F.col("op").isin(*entity.ops)
        checked = F.when(ok, F.col("op")).otherwise(F.raise_error(F.concat(F.lit(f"{name} takes no change "), F.coalesce("op", F.lit("null")))))
        mine = mine.select(*columns, F.col("seq").cast("long").alias("seq"), checked.alias("op"))
        rows = rows.unionByName(mine.filter("op <> 'delete'"))
        rows = null_safe_join(rows, _last_deletion(mine, entity.key, entity.key, "__own"), list(entity.key))
    else:
        rows = rows.withColumn("__own", F.lit(None).cast("long"))
    above = changes.get(entity.parent) if entity.parent else None
    if above is not None:
        rows = null_safe_join(rows, _last_deletion(above, entities[entity.parent].key, entity.parent_key, "__above"), list(entity.parent_key))
    else:
        rows = rows.withColumn("__above", F.lit(None).cast("long"))
    reset = F.greatest("__own", "__above")  # skips nulls
    rows = rows.filter(reset.isNull() | (F.col("seq") > reset))
    if entity.appends:
        return rows.select(*columns)
    rank = F.when(F.col("op") == "upsert", 2).when(F.col("op") == "stored", 1).otherwise(0)
    place = F.when(F.col("op") == "insert", -F.col("seq")).otherwise(F.coalesce("seq", F.lit(0)))
    rows = rows.select(*columns, rank.alias("__rank"), place.alias("__place"))
    return keep_last_per_key(rows, list(entity.key), ["__rank", "__place"]).select(*columns)


# Plans with their destinations, preferences, checklist and spend ledger.
PLAN_ENTITIES = {
    "plans": Entity(("plan_id",)),
    "stops": Entity(("plan_id", "stop_order"), "plans", ("plan_id",)),
    "prefs": Entity(("plan_id", "category"), "plans", ("plan_id",)),
    "checklist": Entity(("plan_id", "section", "item"), "plans", ("plan_id",)),
    "ledger": Entity(("entry_id",), "plans", ("plan_id",), appends=True),
}
