"""View catalog, all-or-nothing loads, partitioned cache, schema-wide key
checks, replay of mixed changes, box index and named files."""

import os
import random

import pytest
from pyspark.sql import functions as F

from orrery.operators import geo as G
from orrery.operators.keychecks import ForeignKey, foreign_key_report, unique_key_report, unique_key_summary
from orrery.operators.quality import QualityError
from orrery.plans.changes import ChangeError, Entity, replay
from orrery.plans.views import View, ViewCatalog, ViewError, model_views
from orrery.sources import cache, publish


def sets(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- views ------------------------------------------------------------------

def test_views_are_registered_parents_first(spark):
    c = ViewCatalog([View("v_top", ("v_mid", "base_a"), "SELECT m.k, m.n + a.x AS y FROM v_mid m JOIN base_a a ON m.k = a.k"),
                     View("v_mid", ("base_a",), lambda a: a.groupBy("k").agg(F.count("*").alias("n"))),
                     View("v_other", ("base_b",), "SELECT * FROM base_b")])
    tables = {"base_a": spark.createDataFrame([(1, 10), (2, 20)], "k int, x int"), "base_b": spark.range(1)}
    assert c.register(spark, tables, ["v_top"]) == ["v_mid", "v_top"]
    assert sets(spark.sql("SELECT * FROM v_top")) == [(1, 11), (2, 21)]
    assert not spark.catalog.tableExists("v_other")


def test_cycles_missing_parents_and_double_names_raise(spark):
    loop = ViewCatalog([View("a", ("b",), "SELECT 1"), View("b", ("c", "t"), "SELECT 1"), View("c", ("a",), "SELECT 1")])
    with pytest.raises(ViewError, match="a -> b -> c -> a"):
        loop.order(["t"])
    with pytest.raises(ViewError, match="b reads nowhere"):
        ViewCatalog([View("b", ("nowhere",), "SELECT 1")]).order(["t"])
    with pytest.raises(ViewError, match="twice"):
        ViewCatalog([View("b", (), "SELECT 1"), View("b", (), "SELECT 2")])
    with pytest.raises(ViewError, match="name of a table"):
        ViewCatalog([View("t", (), "SELECT 1")]).order(["t"])
    with pytest.raises(ViewError, match="the query reads x"):
        loop.order(["t"], ["x"])


def test_all_model_views_resolve_and_prune(spark, tables):
    from orrery.bindings.views import VIEWS, base_tables
    frames = base_tables(tables)
    assert set(VIEWS.register(spark, frames)) == set(model_views().names())
    for name in VIEWS.names():
        assert spark.table(name).columns
    plan = spark.sql("SELECT plan_id FROM plan_summary")._jdf.queryExecution().optimizedPlan().toString()
    assert "p_type" not in plan  # the preference text is not computed


# --- all-or-nothing loads ---------------------------------------------------

@pytest.fixture
def table(spark):
    name = f"t_{random.randrange(10 ** 9)}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_failed_load_leaves_the_old_rows(spark, table, tmp_path):
    at = str(tmp_path / "t")
    old = spark.range(100).select("id", F.lit("old").alias("v"))
    publish.publish_table(old, table, at)
    broken = spark.range(100).repartition(4).select("id", F.when(F.col("id") == 77, F.raise_error(F.lit("mid-write"))).otherwise(F.lit("new")).alias("v"))
    before = publish.current_location(spark, table)
    with pytest.raises(Exception, match="mid-write"):
        publish.publish_table(broken, table, at)
    assert publish.current_location(spark, table) == before
    assert sets(spark.table(table)) == sets(old)
    assert len(os.listdir(at)) == 1  # nothing is left of the failed load
    publish.publish_table(old.withColumn("v", F.lit("new")), table, at)
    assert spark.table(table).filter("v = 'new'").count() == 100


def test_blocking_rules_stop_the_load_before_it_shows(spark, table, tmp_path):
    at = str(tmp_path / "t")
    publish.publish_table(spark.range(5), table, at)
    rows = spark.range(10).select(F.when(F.col("id") != 3, F.col("id")).alias("id"))
    with pytest.raises(QualityError, match="'known': 1"):
        publish.publish_table(rows, table, at, rules={"known": F.col("id").isNotNull()})
    assert spark.table(table).count() == 5
    found = publish.publish_table(rows, table, at, rules={"small": F.coalesce(F.col("id"), F.lit(0)) < 10},
                                  reported={"known": F.col("id").isNotNull()}, counts={"most": F.max("id")})
    assert found == {"n_rows": 10, "small": 0, "known": 1, "most": 9} and spark.table(table).count() == 10


def test_checks_and_write_are_one_job(spark, tmp_path):
    seen_rows = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen_rows.add(b.num_rows)
            yield b
    rows, seen = publish.observed(spark.range(50).mapInArrow(count, "id long"), {"small": F.col("id") < 40}, {"sum": F.sum("id")})
    rows.write.parquet(str(tmp_path / "o"))
    assert dict(seen.get) == {"n_rows": 50, "small": 10, "sum": 1225}
    assert seen_rows.value == 50


def test_old_loads_go_and_a_new_schema_is_taken(spark, table, tmp_path):
    at = str(tmp_path / "t")
    for n in range(4):
        publish.publish_table(spark.range(n + 1), table, at)
        assert spark.table(table).count() == n + 1
    assert len(os.listdir(at)) == 2
    publish.publish_table(spark.range(2).select(F.col("id").cast("string").alias("name")), table, at, keep=0)
    assert spark.table(table).columns == ["name"] and spark.table(table).count() == 2
    publish.publish_table(spark.range(0).select(F.col("id").cast("string").alias("name")), table, at)
    assert spark.table(table).count() == 0


# --- partitioned cache ------------------------------------------------------

def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_untouched_folders_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "c")
    rows = lambda ids, v: spark.createDataFrame([(i, v, v) for i in ids], "k long, ts int, v int")
    assert cache.read_cache(spark, path) is None
    cache.upsert(rows(range(200), 1), path, ["k"], ["ts"], buckets=16)
    before = files_of(path)
    assert cache.upsert(rows([7], 2), path, ["k"], ["ts"], buckets=16) == 1
    after = files_of(path)
    changed = {os.path.dirname(f) for f in before.keys() ^ after.keys()}
    assert len(changed) == 1 and all(after[f] == t for f, t in before.items() if os.path.dirname(f) not in changed)
    want = sorted([(k, 1, 1) for k in range(200) if k != 7] + [(7, 2, 2)])
    assert sorted(map(tuple, cache.read_cache(spark, path).collect())) == want
    cache.upsert(rows([7], 2), path, ["k"], ["ts"], buckets=16)
    cache.upsert(rows([7], 1), path, ["k"], ["ts"], buckets=16)  # an older row does not win
    assert cache.upsert(rows([], 1), path, ["k"], ["ts"], buckets=16) == 0
    assert sorted(map(tuple, cache.read_cache(spark, path).collect())) == want


def test_an_interrupted_update_is_finished_or_dropped(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "c")
    rows = lambda ids, v: spark.createDataFrame([(i, v) for i in ids], "k long, ts int")
    cache.upsert(rows(range(50), 1), path, ["k"], ["ts"], buckets=4)
    with monkeypatch.context() as m:
        m.setattr(cache, "_place", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            cache.upsert(rows([3, 60], 2), path, ["k"], ["ts"], buckets=4)
    got = {r.k: r.ts for r in cache.read_cache(spark, path).collect()}
    assert got == {**dict.fromkeys(range(50), 1), 3: 2, 60: 2}
    failing = rows([1, 2], 3).withColumn("ts", F.when(F.col("k") == 2, F.raise_error(F.lit("stop")).cast("int")).otherwise(F.col("ts")))
    with pytest.raises(Exception, match="stop"):
        cache.upsert(failing, path, ["k"], ["ts"], buckets=4)
    assert {r.k: r.ts for r in cache.read_cache(spark, path).collect()} == got


def test_batches_resume_and_cost_nothing_when_done(spark, tmp_path):
    path, calls = str(tmp_path / "c"), []
    keys = spark.createDataFrame([(i,) for i in [5, 3, 1, 4, 2, 3, None]], "k int")

    def look_up(todo):
        calls.append(sorted(r.k for r in todo.collect()))
        return todo.filter("k <> 4").select("k", (F.col("k") * 10).alias("v"))
    one = cache.update_cache(path, keys, ["k"], look_up, ["v"], batch=2, buckets=4)
    assert sorted(r.k for r in one.remainder.collect()) == [3, 4, 5]
    two = cache.update_cache(path, one.remainder, ["k"], look_up, ["v"], buckets=4)
    assert sorted(r.k for r in two.remainder.collect()) == [4]  # no row for it
    before = files_of(path)
    again = cache.update_cache(path, keys.filter("k <> 4"), ["k"], look_up, ["v"], buckets=4)
    assert calls == [[1, 2], [3, 4, 5], []] and again.written == 0 and files_of(path) == before


def test_a_damaged_table_raises(spark, tmp_path):
    from orrery.streaming.incremental import read_latest
    path = str(tmp_path / "c")
    cache.upsert(spark.createDataFrame([(1, 1)], "k long, ts int"), path, ["k"], ["ts"], buckets=2)
    for f in files_of(path):
        with open(f, "wb") as out:
            out.write(b"no parquet")
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.unlink(crc)
    with pytest.raises(Exception):
        read_latest(spark, path).collect()


# --- keys of a schema -------------------------------------------------------

def test_foreign_keys_of_a_schema(spark):
    tables = {"p": spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (1, "a")], "id long, code string"),
              "c": spark.createDataFrame([(1, "a", 2), (1, "b", None), (9, "z", 9), (9, "z", 9), (None, "a", 1)], "pid int, pcode string, other int")}
    keys = [ForeignKey("c", ("pid",), "p", ("id",)), ForeignKey("c", ("other",), "p", ("id",), optional=True),
            ForeignKey("c", ("pid", "pcode"), "p", ("id", "code"), name="pair")]
    assert sets(foreign_key_report(tables, keys)) == sorted([
        ("c", "c(pid) -> p", "9", 2), ("c", "c(pid) -> p", "NULL", 1), ("c", "c(other) -> p", "9", 2),
        ("c", "pair", "1|b", 1), ("c", "pair", "9|z", 2), ("c", "pair", "NULL|a", 1)], key=repr)
    clean = {"p": tables["p"], "c": tables["c"].limit(0)}
    assert foreign_key_report(clean, keys).count() == 0
    with pytest.raises(ValueError):
        foreign_key_report(tables, [])


def test_schema_report_scans_each_table_once_per_role(spark, tables):
    from orrery.bindings.keychecks import SCHEMA_KEYS, LINE_KEYS
    names = {n for k in SCHEMA_KEYS for n in (k.child, k.parent)}
    report = foreign_key_report({n: getattr(tables, n) for n in names}, SCHEMA_KEYS)
    physical = report._jdf.queryExecution().executedPlan().toString()
    assert physical.count("lineitem.parquet") == 1 and "Cartesian" not in physical and "NestedLoop" not in physical
    unique = unique_key_report(tables.lineitem, LINE_KEYS)._jdf.queryExecution().executedPlan().toString()
    assert unique.count("lineitem.parquet") == 1 and unique.count("Exchange hashpartitioning") == 1 and "Expand" in unique


def test_unique_keys_with_nulls_and_shared_sets(spark):
    df = spark.createDataFrame([(1, "a", " "), (1, "a", "x"), (None, "a", "x"), (None, "a", None), (2, None, "y")], "i int, s string, b string")
    ks = {"i": ("i",), "si": ("s", "i"), "is": ("i", "s"), "b": ("b",)}
    assert sets(unique_key_report(df, ks)) == sorted([("i", "1", 2), ("i", "NULL", 2), ("si", "a|1", 2), ("is", "1|a", 2), ("si", "a|NULL", 2),
                                                      ("is", "NULL|a", 2), ("b", "x", 2)], key=repr)
    assert sets(unique_key_summary(df, {"i": ("i",), "is": ("i", "s"), "b": ("b",)})) == [("b", 5, 1, 1, 3, 1), ("i", 5, 2, 0, 2, 1), ("is", 5, 3, 0, 1, 1)]


# --- mixed changes ----------------------------------------------------------

ENTITIES = {"plans": Entity(("p",)), "prefs": Entity(("p", "c"), "plans", ("p",)), "ledger": Entity(("e",), "plans", ("p",), appends=True)}
SCHEMAS = {"plans": "p long, v int", "prefs": "p long, c string, v int", "ledger": "e long, p long, v int"}


def brute_replay(tables, changes):
    state = {"plans": {r[:1]: r for r in tables["plans"]}, "prefs": {r[:2]: r for r in tables["prefs"]}}
    ledger = list(tables["ledger"])
    for name, row, op in [(n, r, op) for _, op, n, r in sorted((seq, op, n, r) for n, rows in changes.items() for seq, op, r in rows)]:
        if name == "ledger":
            if op == "append":
                ledger.append(row)
            else:
                ledger = [x for x in ledger if x[0] != row[0]]
            continue
        key = row[:1] if name == "plans" else row[:2]
        if op == "delete":
            state[name].pop(key, None)
            if name == "plans":
                state["prefs"] = {k: r for k, r in state["prefs"].items() if k[0] != key[0]}
                ledger = [x for x in ledger if x[1] != key[0]]
        elif op == "upsert" or key not in state[name]:
            state[name][key] = row
    return {"plans": sorted(state["plans"].values()), "prefs": sorted(state["prefs"].values()), "ledger": sorted(ledger)}


@pytest.mark.parametrize("seed", range(3))
def test_replay_equals_row_by_row(spark, seed):
    r = random.Random(seed)
    tables = {"plans": [(p, 0) for p in range(0, 20, 2)], "prefs": [(p, c, 0) for p in range(0, 24, 3) for c in "ab"],
              "ledger": [(e, e % 20, e) for e in range(15)]}
    seqs = list(range(1, 301))
    r.shuffle(seqs)
    changes = {"plans": [(seqs.pop(), r.choice(["insert", "upsert", "delete"]), (r.randrange(20), r.randrange(99))) for _ in range(60)],
               "prefs": [(seqs.pop(), r.choice(["insert", "upsert", "delete"]), (r.randrange(24), r.choice("abc"), r.randrange(99))) for _ in range(150)],
               "ledger": [(seqs.pop(), r.choice(["append"] * 4 + ["delete"]), (r.randrange(40), r.randrange(20), r.randrange(99))) for _ in range(60)]}
    frames = {n: spark.createDataFrame(rows, SCHEMAS[n]) for n, rows in tables.items()}
    deltas = {n: spark.createDataFrame([(s, op, *row) for s, op, row in rows], "seq long, op string, " + SCHEMAS[n]) for n, rows in changes.items()}
    got = {n: sorted(map(tuple, df.collect())) for n, df in replay(frames, deltas, ENTITIES).items()}
    assert got == brute_replay(tables, changes)


def test_replay_checks_its_input(spark):
    frames = {n: spark.createDataFrame([], s) for n, s in SCHEMAS.items()}
    same = replay(frames, {}, ENTITIES)
    assert all(df.count() == 0 for df in same.values())
    with pytest.raises(ChangeError, match="no entity"):
        replay(frames, {"x": frames["plans"]}, ENTITIES)
    with pytest.raises(ChangeError, match="parent in its key"):
        replay(frames, {}, {**ENTITIES, "prefs": Entity(("c",), "plans", ("p",))})
    odd = spark.createDataFrame([(1, "append", 1, 1)], "seq long, op string, p long, v int")
    with pytest.raises(Exception, match="plans takes no change append"):
        replay(frames, {"plans": odd}, ENTITIES)["plans"].collect()
    null = spark.createDataFrame([(1, "insert", None, 1), (2, "upsert", None, 2)], "seq long, op string, p long, v int")
    assert sets(replay(frames, {"plans": null}, ENTITIES)["plans"]) == [(None, 2)]


# --- many boxes -------------------------------------------------------------

def test_box_index_equals_all_pairs(spark):
    r = random.Random(5)
    pts = [(i, r.uniform(-5, 5) if r.random() > 0.05 else None, r.uniform(-5, 5)) for i in range(300)] + [(1000, 1.0, 2.0), (1001, -3.0, 0.0)]
    boxes = [(b, *sorted((r.uniform(-5, 5), r.uniform(-5, 5))), *sorted((r.uniform(-5, 5), r.uniform(-5, 5)))) for b in range(40)]
    boxes += [(100, 1.0, 1.0, 2.0, 2.0), (101, -3.0, 0.0, 0.0, 0.0), (102, 2.0, 1.0, 0.0, 1.0), (103, None, 1.0, 0.0, 1.0)]
    p, b = spark.createDataFrame(pts, "i int, lat double, lon double"), spark.createDataFrame(boxes, "box_id int, lat_min double, lat_max double, lon_min double, lon_max double")
    want = sorted((i, n) for i, y, x in pts for n, a, z, c, d in boxes if y is not None and a is not None and a <= y <= z and c <= x <= d)
    for cell in (0.3, 1.0, 20.0):
        assert sorted((r.i, r.box_id) for r in G.match_boxes(p, b, cell=cell).collect()) == want
    assert {r.i for r in G.match_boxes(p, b, how="left_anti").collect()} == {i for i, *_ in pts} - {i for i, _ in want}
    plan = G.match_boxes(p, b)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


# --- named files ------------------------------------------------------------

def test_one_file_a_key_with_a_byte_order_mark(spark, tmp_path):
    path = str(tmp_path / "x")
    df = spark.createDataFrame([("07", 1, "á"), ("08", 2, None), ("07", 3, 'q"x'), ("a/b c", 4, "z"), (None, 5, "n")], "k string, v int, s string")
    names = publish.write_file_per_key(df, path, "k", "clima_prov_{key}.csv", bom=True)
    assert names == ["clima_prov_07.csv", "clima_prov_08.csv", "clima_prov_a%2Fb c.csv", "clima_prov_null.csv"]
    assert {f for f in os.listdir(path) if not f.startswith((".", "_"))} == set(names)
    for n in names:
        with open(os.path.join(path, n), "rb") as f:
            assert f.read(3) == b"\xef\xbb\xbf"
    from orrery.sources.io import clean_headers
    back = clean_headers(publish.read_files_by_name(spark, path, r"^clima_prov_(.+)\.csv$", "k", pathGlobFilter="clima_prov_*.csv", escape='"'))
    assert sorted(map(tuple, back.select("k", "v").collect())) == [("07", "1"), ("07", "3"), ("08", "2"), ("a%2Fb c", "4"), ("null", "5")]


def test_csv_export_begins_with_the_mark(spark, tmp_path):
    path = str(tmp_path / "x")
    publish.write_csv_with_bom(spark.range(20).repartition(3), path)
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) == 3 and all(open(os.path.join(path, f), "rb").read(5) == b"\xef\xbb\xbfid" for f in parts)


# --- co-located plan tables -------------------------------------------------

def test_stored_cost_chain_moves_no_plan(spark, tables, tmp_path):
    from orrery.bindings import planning as B
    from orrery.bindings import standins as S
    from orrery.plans import colocated
    from orrery.plans import planning as P
    core = P.plan_core(S.plans(tables), S.stops(tables), S.countries(tables), S.provinces(tables))
    prefix = f"stored_{random.randrange(10 ** 9)}"
    colocated.store_plan_tables(core, S.prefs(tables), B._lodging_rec(tables), B._activity_rec(tables), prefix, str(tmp_path), buckets=4)
    # Above one file's size, so that the plan tables themselves are not broadcast.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "6k")
    try:
        got = colocated.stored_estimate(spark, prefix, S.FOOD_CATEGORY, S.COST_GROUPS)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(plan_id" not in plan and plan.count("SortMergeJoin [plan_id") == 2 and "lineitem.parquet" not in plan
        rows = sets(got)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for n in ("core", "prefs", "lodging", "activities"):
            spark.sql(f"DROP TABLE {prefix}_{n}")
    assert rows == sets(B.estimate(tables)) and len(rows) == 1500
