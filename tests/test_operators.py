"""Property and edge-case checks of the DataFrame operators."""

import random

import pytest
from pyspark.sql import functions as F

from orrery.operators import joins as J
from orrery.operators import keys as K
from orrery.operators import quality as Q
from orrery.operators import windows as W
from orrery.operators.quantiles import quantiles


def test_impute_fills_every_gap_and_keeps_values(spark):
    rows = [("a", "x", 1.0), ("a", "x", None), ("a", "y", None), ("b", "z", 5.0), ("b", "z", None), (None, "q", None)]
    df = spark.createDataFrame(rows, "g string, h string, v double")
    out = W.impute_hierarchical(df, "v", [["g", "h"], ["g"]], out="f").collect()
    assert all(r.f is not None for r in out)
    assert all(r.f == r.v for r in out if r.v is not None)
    by = {(r.g, r.h, r.v): r.f for r in out}
    assert by[("a", "x", None)] == 1.0          # finest group mean
    assert by[("a", "y", None)] == 1.0          # coarser group (a) over filled values
    assert by[(None, "q", None)] == pytest.approx((1.0 * 3 + 5.0 * 2) / 5)  # global mean of the filled rows


def test_shares_sum_to_100(tables):
    li = tables.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    s = W.share_within(li, ["l_returnflag"], "n", scale=None)
    tot = s.groupBy("l_returnflag").agg(F.sum("share_pct").alias("t")).collect()
    assert all(abs(r.t - 100) < 1e-9 for r in tot)


def test_minmax_in_unit_interval(tables):
    s = W.minmax_normalize(tables.supplier, "s_acctbal", "n").agg(F.min("n"), F.max("n")).first()
    assert s[0] == 0.0 and s[1] == 1.0


def test_minmax_constant_column(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert [r.n for r in W.minmax_normalize(df, "v", "n").collect()] == [None, None]
    assert [r.n for r in W.minmax_normalize(df, "v", "n", constant="zero").collect()] == [0.0, 0.0]


def test_keep_first_matches_window(tables):
    from pyspark.sql import Window
    li = tables.lineitem
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus"]
    a = K.keep_first_per_key(li, ["l_orderkey", "l_linenumber"], order)
    w = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*order)
    b = li.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    assert a.exceptAll(b.select(*a.columns)).isEmpty() and b.select(*a.columns).exceptAll(a).isEmpty()


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_surrogate_key_is_dense_and_ordered(spark, tables, reuse):
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        o = K.surrogate_key(tables.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"])
        rows = o.orderBy("id").collect()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert [r.id for r in rows] == list(range(1, len(rows) + 1))
    keys = [(r.o_orderdate, r.o_orderkey) for r in rows]
    assert keys == sorted(keys)


def test_expansion_keeps_parent_totals(tables):
    reg = tables.nation.groupBy("n_regionkey").agg(F.lit(10.0).alias("v"))
    bridge = tables.nation.select("n_regionkey", "n_nationkey")
    e = J.expand_to_members(reg, bridge, "n_regionkey", ["n_nationkey"])
    members = bridge.groupBy("n_regionkey").count()
    chk = e.groupBy("n_regionkey").agg(F.sum("v").alias("t")).join(members, "n_regionkey").collect()
    assert all(r.t == 10.0 * r["count"] for r in chk)


def test_cardinality_assertion_raises(spark):
    left = spark.createDataFrame([(1,), (1,)], "k int")
    right = spark.createDataFrame([(1,), (1,)], "k int")
    J.assert_join_cardinality(left, right.distinct(), ["k"], "m:1")
    with pytest.raises(J.CardinalityError):
        J.assert_join_cardinality(left, right, ["k"], "m:1")


def test_quality_reports_empty_on_clean_and_catch_seeded(tables, spark):
    nation = tables.nation
    assert Q.duplicate_keys(nation, ["n_nationkey"]).isEmpty()
    assert Q.orphans(tables.supplier, nation, "s_nationkey", "n_nationkey").isEmpty()
    seeded = nation.unionByName(nation.limit(1))
    assert Q.duplicate_keys(seeded, ["n_nationkey"]).count() == 1
    bad = spark.createDataFrame([(1, 99)], "s_suppkey long, s_nationkey int")
    assert Q.orphans(bad, nation, "s_nationkey", "n_nationkey").count() == 1
    with pytest.raises(Q.QualityError):
        Q.assert_empty(Q.duplicate_keys(seeded, ["n_nationkey"]), "duplicates")


def test_rule_violations_null_is_violation(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, -1)], "id int, amount int")
    v = Q.rule_violations(df, {"non_negative": F.col("amount") >= 0}, ["id"]).collect()
    assert sorted(r.id for r in v) == [1, 3]


@pytest.mark.parametrize("skewed", [False, True])
def test_sort_quantiles_equal_map_quantiles(spark, skewed):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        g = "hot" if (skewed and i % 3 != 0) else f"g{i % 7}"
        rows.append((g if i % 97 else None, float(rnd.randint(0, 500)) / 4))
    df = spark.createDataFrame(rows, "g string, v double")
    probs = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    a = quantiles(df, "v", probs, ["g"], method="exact")
    b = quantiles(df, "v", probs, ["g"], method="map")
    key = lambda r: (r.g is None, r.g or "")
    ra, rb = sorted(a.collect(), key=key), sorted(b.collect(), key=key)
    assert len(ra) == len(rb)
    for x, y in zip(ra, rb):
        for p in probs:
            assert x[p] == pytest.approx(y[p], abs=1e-9)
    ga = quantiles(df, "v", probs, method="exact").first()
    gb = quantiles(df, "v", probs, method="map").first()
    for p in probs:
        assert ga[p] == pytest.approx(gb[p], abs=1e-9)


def test_cells_to_table_and_incremental(spark):
    from orrery.sources import io as IO
    cells = spark.createDataFrame([
        (1, 2, 1, "Sheet A"), (1, 3, 1, "Code"), (1, 3, 2, "Name"), (1, 4, 1, "01"), (1, 4, 2, "x"), (1, 5, 1, " "),
        (2, 2, 1, "Sheet B"), (2, 3, 1, "code"), (2, 4, 1, "02")], "sheet int, row int, col int, value string")
    t = IO.cells_to_table(cells, ["code", "name"]).orderBy("sheet", "row").collect()
    assert [(r.sheet, r.section, r.code, r.name) for r in t] == [(1, "Sheet A", "01", "x"), (2, "Sheet B", "02", None)]
    prev = spark.createDataFrame([(1, "a", 0)], "k int, v string, load_order int")
    cand = spark.createDataFrame([(1,), (2,)], "k int")
    out = IO.incremental_merge(prev, cand, ["k"], lambda new: new.withColumn("v", F.lit("new")).withColumn(
        "load_order", F.lit(1)), "load_order").orderBy("k").collect()
    assert [(r.k, r.v) for r in out] == [(1, "a"), (2, "new")]


def test_top_k_of_a_hot_group(spark):
    from pyspark.sql import Window
    rnd = random.Random(3)
    rows = [("hot" if i % 3 else f"g{i % 5}", rnd.randint(0, 50), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, v int, id int")
    order = [F.col("v").desc(), F.col("id").asc()]
    a = W.top_per_group(df, ["g"], order, k=5, rank_col="r")
    w = Window.partitionBy("g").orderBy(*order)
    b = df.withColumn("r", F.row_number().over(w)).filter("r <= 5")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_impute_matches_sequential_pandas(spark, seed):
    """W1 against a plain sequential implementation (each level's mean over
    the values filled before it, null group keys get no fill at that level)."""
    import pandas as pd
    rnd = random.Random(seed)
    rows = []
    for i in range(400):
        a = rnd.choice(["x", "y", "z", None]) if i % 17 else None
        b = rnd.choice(["p", "q"]) if a is not None else rnd.choice(["p", None])
        v = None if rnd.random() < 0.45 else float(rnd.randint(1, 100))
        rows.append((i, a, b, v))
    df = spark.createDataFrame(rows, "id int, a string, b string, v double")
    got = {r.id: r.f for r in W.impute_hierarchical(df, "v", [["a", "b"], ["a"]], out="f").collect()}
    pdf = pd.DataFrame(rows, columns=["id", "a", "b", "v"])
    cur = pdf["v"].copy()
    for keys in (["a", "b"], ["a"]):
        means = pdf.assign(c=cur).groupby(keys, dropna=True)["c"].transform("mean")
        cur = cur.fillna(means)
    cur = cur.fillna(cur.mean())
    for i, expected in zip(pdf["id"], cur):
        assert got[i] == pytest.approx(expected, rel=1e-9)


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_quantiles_exact_with_hot_values(spark, reuse):
    """One value in half the rows, null groups, odd doubles, several columns at once."""
    from orrery.operators.quantiles import quantiles_of
    rnd = random.Random(9)
    rows = [(rnd.choice(["a", "b", None]), 7.5 if i % 2 else rnd.choice([rnd.gauss(0, 1e6), rnd.random(), -0.0, 0.0, 5e-324, 1e300, -1e300]),
             float(rnd.randint(0, 3)) if i % 5 else None) for i in range(3000)] + [("c", None, 1.0), ("d", None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        got = quantiles_of(df, {"x1": ("x", 0.25), "x9": ("x", 0.9), "y5": ("y", 0.5)}, ["g"]).collect()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    want = df.groupBy("g").agg(F.percentile("x", 0.25).alias("x1"), F.percentile("x", 0.9).alias("x9"), F.percentile("y", 0.5).alias("y5")).collect()
    want = {r.g: r for r in want if any(r[c] is not None for c in ("x1", "y5"))}
    assert {r.g for r in got} == set(want)
    for r in got:
        for c in ("x1", "x9", "y5"):
            assert (r[c] is None) == (want[r.g][c] is None)
            assert r[c] is None or r[c] == pytest.approx(want[r.g][c], rel=1e-12, abs=1e-300)
    assert quantiles_of(df.limit(0), {"q": ("x", 0.5)}).collect()[0].q is None


def test_null_group_keys_keep_their_statistics(spark):
    from orrery.operators.aggregates import group_mode
    from orrery.operators.geo import distance_to_centroid
    df = spark.createDataFrame([(None, 1.0, "u"), (None, 3.0, "u"), ("k", 2.0, "v")], "g string, v double, m string")
    assert {(r.g, r.v): r.share_pct for r in W.share_within(df, ["g"], "v").collect()} == {(None, 1.0): 25.0, (None, 3.0): 75.0, ("k", 2.0): 100.0}
    assert {r.g: r.mode_m for r in group_mode(df, ["g"], "m").collect()} == {None: "u", "k": "v"}
    assert {(r.g, r.v): r.n for r in W.minmax_normalize(df, "v", "n", keys=["g"]).collect()}[(None, 3.0)] == 1.0
    near = distance_to_centroid(df.withColumn("lat", F.col("v")).withColumn("lon", F.col("v")), ["g"])
    assert all(r.dist_km is not None for r in near.collect())


def test_impute_needs_no_window(tables):
    from orrery.bindings import registry
    plan = registry.queries()["w1_impute_hierarchical"](tables.spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_lodging_imputation_order_by_hand(spark):
    """Full key first, then the place, then the country, then all."""
    rows = [("C", "P", 1, "A", "1 mes", None), ("C", "P", 1, "A", "3 meses", 10.0), ("C", "Q", 1, "A", "1 mes", 50.0),
            ("C", "Q", 2, "A", "1 mes", None), ("C", "P", 2, "A", "1 mes", 30.0), ("D", "R", 5, "B", "1 mes", None)]
    df = spark.createDataFrame(rows, "country_id string, province_id string, month int, category string, lead_time string, v double")
    keys = ["country_id", "province_id", "month", "category", "lead_time"]
    got = W.impute_hierarchical(df, "v", [keys, keys[:4], ["country_id", "month", "category"]]).collect()
    # The first row has its place's 10 of the month, not its country's; the fourth its country's month; the last the mean of all filled.
    assert {(r.province_id, r.month, r.lead_time): r.v for r in got} == {
        ("P", 1, "1 mes"): 10.0, ("P", 1, "3 meses"): 10.0, ("Q", 1, "1 mes"): 50.0, ("Q", 2, "1 mes"): 30.0, ("P", 2, "1 mes"): 30.0,
        ("R", 5, "1 mes"): 26.0}


def test_duplicate_mapping_key_takes_the_smallest_value(spark):
    m = spark.createDataFrame([("a", "z"), ("a", "y"), ("b", None)], "key string, value string")
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    assert {r.c: r.o for r in J.map_values(df, "c", m, output="o").collect()} == {"a": "y", "b": None, "c": None}


def test_stream_batch_run_twice_gives_the_same_table(spark, tmp_path):
    from orrery.streaming.incremental import merge_batch, read_latest
    target = str(tmp_path / "t")
    batch = lambda rows: spark.createDataFrame(rows, "k string, ts int, v int")
    merge_batch(batch([("a", 1, 1), ("b", 1, 1)]), 0, target, ["k"], ["ts"])
    merge_batch(batch([("a", 2, 2)]), 1, target, ["k"], ["ts"])
    for _ in range(2):  # the second time as after a crash: its own version is there already
        merge_batch(batch([("b", 5, 9)]), 2, target, ["k"], ["ts"])
        assert sorted(map(tuple, read_latest(spark, target).collect())) == [("a", 2, 2), ("b", 5, 9)]


def test_profile_counts_decimals_of_small_doubles(spark):
    from orrery.operators.quality import column_profile
    df = spark.createDataFrame([(1e-5,), (2.5,)], "x double")
    assert column_profile(df).collect()[0].max_decimals == 5


def test_cluster_without_checkpoint_folder_raises():
    from types import SimpleNamespace as N

    from orrery.session import ensure_checkpoint_dir
    sc = N(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(N(sparkContext=sc, conf=N(get=lambda k, d=None: None)))


def test_fixed_values_by_hand():
    """Some literals whose oracles are made from the same constants."""
    from orrery.functions.text import LEAD_TIME_MAP, REGION_KEY_RULES
    from orrery.plans.planning import CHECKLIST_ITEMS
    assert LEAD_TIME_MAP["2 - 3 meses"] == "2-3 meses" and LEAD_TIME_MAP["1 semana"] == "1 semana"
    assert (("balears", "illes"), "balears") in REGION_KEY_RULES and (("rioja",), "rioja") in REGION_KEY_RULES
    assert CHECKLIST_ITEMS[0] == ("Importante", "Pasaporte / documento de identidad", None)
    assert ("Importante", "Seguro de viaje", None) in CHECKLIST_ITEMS
