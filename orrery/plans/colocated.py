"""The cost chain over stored tables: plans and preferences bucketed by plan,
price references as small tables of known size.

Plans are joined with their preferences, group costs are summed and joined
back on ``plan_id``; with both tables bucketed on it none of these moves a
row. The references are stored too, so their size is known when the chain is
planned: small ones are broadcast by Spark's own threshold, larger ones are
sort-merge joined, which then costs an exchange.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from . import planning as P
from . import recipes as M


def store_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """A catalog table in ``buckets`` files sorted by the key. The rows are
    dealt by the key first, so each bucket is one file and not one per task."""
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .option("path", path).format("parquet").saveAsTable(table))


def store_plan_tables(core: DataFrame, prefs: DataFrame, lodging_rec: DataFrame, activity_rec: DataFrame, prefix: str, path: str,
                      buckets: int = 256) -> None:
    """Write ``<prefix>_core`` and ``<prefix>_prefs`` (bucketed by plan_id, as
    many buckets each) and the references ``<prefix>_lodging`` and
    ``<prefix>_activities`` below ``path``."""
    base = path.rstrip("/")
    store_bucketed(core, f"{prefix}_core", f"{base}/core", "plan_id", buckets)
    store_bucketed(prefs.select("plan_id", "category", "quantity"), f"{prefix}_prefs", f"{base}/prefs", "plan_id", buckets)
    for name, rec in (("lodging", lodging_rec), ("activities", activity_rec)):
        rec.write.mode("overwrite").option("path", f"{base}/{name}").format("parquet").saveAsTable(f"{prefix}_{name}")


def stored_estimate(spark: SparkSession, prefix: str, food_category: str = P.FOOD_CATEGORY,
                    rules: Mapping[str, str] = M.COST_GROUP_RULES, carry: Sequence[str] = ()) -> DataFrame:
    """P3-P7 from the stored tables: no exchange on plan_id."""
    core, prefs, lodging, activities = (spark.table(f"{prefix}_{n}") for n in ("core", "prefs", "lodging", "activities"))
    return P.estimate_from_core(core, prefs, lodging, activities, food_category, rules, carry=carry)
