"""Sources and sinks IO1-IO15 and the streaming upsert, exercised by
writing driver tables to the shared scratch folder and reading them back.
Each query writes its own fresh folder when built."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.joins import attach_scalars
from ..operators.keys import keep_last_per_key
from ..sources import cache, publish
from ..sources import io as IO
from ..tables import Tables
from .registry import register
from .sqlutil import r2

PART_TYPES = {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string",
              "p_size": "int", "p_retailprice": "double"}
CUSTOMER_TYPES = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
                  "c_mktsegment": "string"}


def _typed(df, types):
    return df.select(*[F.col(c).try_cast(t).alias(c) for c, t in types.items()])


@register("io1_delimited_latin1_roundtrip", "SELECT * FROM part", ["IO1", "IO4", "IO9", "IO10"])
def io1(t: Tables):
    path = IO.scratch_path(t.spark, "io1")
    src = t.part.toDF(*[f" {c.upper()} " for c in t.part.columns])  # messy headers on the way out
    src.write.mode("overwrite").option("sep", ";").option("encoding", "ISO-8859-1").option("header", True).csv(path)
    back = IO.clean_headers(IO.read_delimited(t.spark, path, sep=";", encoding="ISO-8859-1"))
    return _typed(back, PART_TYPES)


@register("io2_sniffed_scan", "SELECT * FROM customer", ["IO2", "IO15"])
def io2(t: Tables):
    path = IO.scratch_path(t.spark, "io2")
    IO.write_csv(t.customer, path, sep="|")
    back = IO.read_sniffed(t.spark, path)
    key = IO.first_present(back.columns, ["custkey"])
    return _typed(back.withColumnRenamed(key, "c_custkey"), CUSTOMER_TYPES)


@register("io2_late_latin1_line", "SELECT n_nationkey, CASE WHEN n_nationkey = (SELECT MAX(n_nationkey) FROM nation) THEN 'M' || chr(225) || 'laga' "
          "ELSE n_name END AS n_name FROM nation", ["IO2"])
def io2_late(t: Tables):
    """The only line that is not UTF-8 is the last one."""
    path = IO.scratch_path(t.spark, "io2-late")
    last = t.nation.agg(F.max("n_nationkey").alias("last"))
    out = attach_scalars(t.nation, last).orderBy("n_nationkey").select("n_nationkey", F.when(F.col("n_nationkey") == F.col("last"), "M\u00e1laga").otherwise(F.col("n_name")).alias("n_name"))
    out.coalesce(1).write.option("sep", ";").option("encoding", "ISO-8859-1").option("header", True).csv(path)
    return _typed(IO.read_sniffed(t.spark, path), {"n_nationkey": "int", "n_name": "string"})


@register("io3_literal_na_kept", """
SELECT n_nationkey, CASE WHEN n_nationkey = 0 THEN 'NA' WHEN n_nationkey = 1 THEN 'null' WHEN n_nationkey = 2 THEN '' ELSE n_name END AS n_name,
       n_regionkey FROM nation""", ["IO3"])
def io3(t: Tables):
    path = IO.scratch_path(t.spark, "io3")
    n = t.nation.select("n_nationkey", F.when(F.col("n_nationkey") == 0, "NA").when(F.col("n_nationkey") == 1, "null")
                        .when(F.col("n_nationkey") == 2, "").otherwise(F.col("n_name")).alias("n_name"), "n_regionkey")
    IO.write_csv(n, path)
    back = IO.read_delimited(t.spark, path, sep=",", encoding="UTF-8", keep_literal_nulls=True)
    return _typed(back, {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"})


@register("io5_many_files_key_from_name", f"""
SELECT user_id % 8 AS part, strftime(ts, '%Y-%m-%d') AS period, {r2('AVG(value)')} AS avg_value, {r2('SUM(value)')} AS sum_value
FROM events GROUP BY 1, 2""", ["IO5", "A22"])
def io5(t: Tables):
    """One file a key, ``events_part_07.csv`` and so on, read back by name.
    A bounded key: eight files whatever the number of users."""
    from ..operators.aggregates import period_rollup
    path = IO.scratch_path(t.spark, "io5")
    e = t.events.select(F.lpad((F.col("user_id") % 8).cast("string"), 2, "0").alias("part"), "ts", "value")
    publish.write_file_per_key(e, path, "part", "events_part_{key}.csv", bom=True)
    back = publish.read_files_by_name(t.spark, path, r"^events_part_(\d+)\.csv$", key_col="part", pathGlobFilter="events_part_*.csv")
    back = IO.clean_headers(back)
    back = back.select(F.col("part").cast("bigint").alias("part"), F.col("ts").try_cast("timestamp_ntz").alias("ts"),
                       F.col("value").try_cast("double").alias("value"))
    return period_rollup(back, ["part"], "ts", "yyyy-MM-dd", means=["value"], sums=["value"])


@register("io9_csv_with_bom", "SELECT * FROM customer", ["IO9", "IO4"])
def io9(t: Tables):
    path = IO.scratch_path(t.spark, "io9")
    publish.write_csv_with_bom(t.customer, path, sep=";")
    return _typed(IO.clean_headers(IO.read_delimited(t.spark, path, sep=";", encoding="UTF-8")), CUSTOMER_TYPES)


@register("q14_io12_reports", """
SELECT 'nations without region' AS report, COUNT(*) AS n_rows, COUNT(*) > 0 AS written FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region)
UNION ALL
SELECT 'customers in debt', COUNT(*), COUNT(*) > 0 FROM customer WHERE c_acctbal < 0""", ["Q14", "IO12"])
def q14(t: Tables):
    """Reports are written if they have rows; the blocking check passes on an empty one and raises on the other."""
    from ..operators.quality import QualityError, assert_empty
    orphans = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left_anti").select(F.col("n_nationkey").alias("k"))
    debt = t.customer.filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("k"))
    out = None
    for name, report in (("nations without region", orphans), ("customers in debt", debt)):
        path = IO.scratch_path(t.spark, "io12")
        done = IO.write_if_not_empty(report, path)
        try:
            assert_empty(report, name)
            clean = True
        except QualityError:
            clean = False
        found = t.spark.read.option("header", True).csv(path) if done else report.limit(0)
        row = found.agg(F.lit(name).alias("report"), F.count(F.lit(1)).alias("n_rows"), F.lit(done and not clean).alias("written"))
        out = row if out is None else out.unionByName(row)
    return out


def _cells(t: Tables):
    """Nations laid out as one 'sheet' per region: title in row 2, header in
    row 3, one data row per nation from row 4 and an empty row after them."""
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey").join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    w = Window.partitionBy("n_regionkey").orderBy("n_nationkey")
    d = n.withColumn("row", F.row_number().over(w) + 3)
    data = d.select(F.col("n_regionkey").alias("sheet"), "row", F.explode(F.array(
        F.struct(F.lit(1).alias("col"), F.col("n_nationkey").cast("string").alias("value")),
        F.struct(F.lit(2).alias("col"), F.col("n_name").alias("value")))).alias("c")).select("sheet", "row", "c.*")
    regions = t.region.select(F.col("r_regionkey").alias("sheet"), "r_name")
    title = regions.select("sheet", F.lit(2).alias("row"), F.lit(1).alias("col"), F.col("r_name").alias("value"))
    hdr = regions.select("sheet", F.lit(3).alias("row"), F.explode(F.array(
        F.struct(F.lit(1).alias("col"), F.lit(" NationKey ").alias("value")),
        F.struct(F.lit(2).alias("col"), F.lit("Name").alias("value")))).alias("c")).select("sheet", "row", "c.*")
    empty = regions.select("sheet", F.lit(99).alias("row"), F.lit(1).alias("col"), F.lit("  ").alias("value"))
    return title.unionByName(hdr).unionByName(data).unionByName(empty)


@register("io6_cells_to_table", """
SELECT n_regionkey AS sheet, CAST(ROW_NUMBER() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) + 3 AS INTEGER) AS row,
       r_name AS section, CAST(n_nationkey AS VARCHAR) AS nationkey, n_name AS name
FROM nation JOIN region ON n_regionkey = r_regionkey""", ["IO6"])
def io6(t: Tables):
    return IO.cells_to_table(_cells(t), ["nationkey", "name"])


@register("io7_drop_unnamed_and_empty", "SELECT CAST(r_regionkey AS VARCHAR) AS r_regionkey, r_name FROM region",
          ["IO7"])
def io7(t: Tables):
    path = IO.scratch_path(t.spark, "io7")
    r = t.region.select(F.col("r_regionkey").cast("string").alias("r_regionkey"), "r_name", F.lit(None).cast("string").alias("x"))
    blanks = t.region.select(F.lit(None).cast("string").alias("r_regionkey"), F.lit(None).cast("string").alias("r_name"),
                             F.lit(None).cast("string").alias("x"))
    r.unionByName(blanks).toDF("r_regionkey", "r_name", "").write.mode("overwrite").option("header", True).csv(path)
    back = t.spark.read.option("header", True).csv(path)
    return IO.drop_unnamed_and_empty(back)


@register("io10_replace_load", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
          ["IO10", "IO8"])
def io10(t: Tables):
    path = IO.scratch_path(t.spark, "io10")
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    IO.replace_table(o, path)
    IO.replace_table(o.filter(F.col("o_orderstatus") == "F"), path)
    return t.spark.read.parquet(path)


@register("io11_incremental_cache", """
WITH prev AS (SELECT user_id, event_id, ts, value, 0 AS load_order FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn
        FROM events WHERE ts < TIMESTAMP '2024-01-15') z WHERE rn = 1),
new AS (SELECT user_id, event_id, ts, value, 1 AS load_order FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events
        WHERE user_id NOT IN (SELECT user_id FROM prev)) z WHERE rn = 1)
SELECT * FROM prev UNION ALL SELECT * FROM new""", ["IO11", "J7", "K3"])
def io11(t: Tables):
    e = t.events.select("user_id", "event_id", "ts", "value")
    cutoff = F.lit("2024-01-15").cast("timestamp_ntz")
    prev = keep_last_per_key(e.filter(F.col("ts") < cutoff), ["user_id"], ["ts", "event_id"]).withColumn(
        "load_order", F.lit(0))
    cands = e.select("user_id").distinct()

    def process(new_keys):
        got = e.join(new_keys, "user_id", "left_semi")
        return keep_last_per_key(got, ["user_id"], ["ts", "event_id"]).withColumn("load_order", F.lit(1))
    return IO.incremental_merge(prev, cands, ["user_id"], process, "load_order").select(
        "user_id", "event_id", "ts", "value", "load_order")


@register("io11_partitioned_cache", """
SELECT user_id, event_id, ts, value FROM (
  SELECT user_id, event_id, ts, value, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) z WHERE rn = 1""",
          ["IO11", "J7", "K3"])
def io11_partitioned(t: Tables):
    """Users are looked up in three resumable batches; what one leaves over the next takes."""
    path = IO.scratch_path(t.spark, "io11")
    e = t.events.select("user_id", "event_id", "ts", "value")
    users = e.select("user_id").distinct()
    half = max(1, users.count() // 2)

    def latest(keys):
        return keep_last_per_key(e.join(keys, "user_id", "left_semi"), ["user_id"], ["ts", "event_id"])
    for _ in range(3):
        done = cache.update_cache(path, users, ["user_id"], latest, ["ts", "event_id"], batch=half, buckets=8)
        users = done.remainder
    return cache.read_cache(t.spark, path)


@register("io13_io14_column_contract", """
SELECT c_name, c_custkey, c_nationkey, c_acctbal, c_mktsegment, CAST(NULL AS VARCHAR) AS c_phone FROM customer""",
          ["IO13", "IO14", "IO15"])
def io13(t: Tables):
    c = IO.require_columns(t.customer, ["c_custkey", "c_name"])
    c = IO.ensure_columns(c, {"c_phone": "string", "c_name": "string"})
    return IO.order_columns(c, ["c_name", "c_custkey", "c_missing"])


@register("streaming_latest_event_per_user", """
SELECT event_id, ts, user_id, event_type, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) z WHERE rn = 1""",
          ["IO11", "K3", "streaming"])
def streaming_latest(t: Tables):
    from ..streaming.incremental import read_latest, upsert_latest_stream
    base = IO.scratch_path(t.spark, "stream")
    e = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    cutoff = F.lit("2024-01-15").cast("timestamp_ntz")
    e.filter(F.col("ts") < cutoff).write.mode("overwrite").parquet(f"{base}/in/part1")
    e.filter(F.col("ts") >= cutoff).write.mode("overwrite").parquet(f"{base}/in/part2")
    q = upsert_latest_stream(t.spark, f"{base}/in/*", e.schema, f"{base}/out", f"{base}/ckpt", ["user_id"],
                             ["ts", "event_id"], buckets=8)
    q.awaitTermination()
    return read_latest(t.spark, f"{base}/out")
