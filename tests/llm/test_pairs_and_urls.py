"""Near duplicates of documents and vectors, URL rules and the pipeline against
brute force; the dependence of the rest of the library on none of them."""

import math
import random

import brute
import numpy as np
import pytest
from brute import SF_SMALL

import corpus_pipeline
from orrery.llm import components, lattice, neardup, queries, urls
from orrery.tables import read_table


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


# --- components -----------------------------------------------------------------

def test_components_brute_force(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(110)] + [(500 + i, 501 + i) for i in range(40)] + [(900, i) for i in range(901, 960)]
    edges += [(None, 3), (7, None), (8, 8), edges[0], edges[0][::-1]]
    got = {r["node"]: r["component"] for r in rows(components.connected_components(spark.createDataFrame(edges, "a long, b long")))}
    want = brute.components(1000, [e for e in edges if None not in e])
    nodes = {x for e in edges if None not in e and e[0] != e[1] for x in e}
    assert got == {x: want[x] for x in nodes}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- documents --------------------------------------------------------------------

def edited(rng, words, n):
    w = list(words)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(w)


def test_near_duplicates_small_table(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    want = brute.near_duplicate_components(sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(neardup.near_duplicates(docs))}
    assert got == want


def test_near_duplicates_families_and_chains(spark, docs_of):
    """A family of near copies whose members are partly out of reach of each other, a chain of small edits, copies, unrelated texts."""
    rng = random.Random(8)
    text = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    base, texts = text(220), []
    texts += [edited(rng, base, rng.randrange(1, 6)) for _ in range(120)]
    link = text(300)
    for _ in range(25):
        link = edited(rng, link, 6).split()
        texts.append(" ".join(link))
    texts += [" ".join(base)] * 30 + [" ".join(text(80)) for _ in range(60)] + ["short one", "Short ONE", "a b c d", "a b c e"]
    rng.shuffle(texts)
    want = brute.near_duplicate_components(list(enumerate(texts)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(neardup.near_duplicates(docs_of(texts)))}
    assert got == want


def test_pairs_by_changes_are_linked_pairs(spark):
    """Members that share changes without being linked make no pairs to verify."""
    rng = random.Random(5)
    number = lambda: rng.randrange(1, 1 << 62)
    base = [number() for _ in range(200)]
    common, sets, members = [number() for _ in range(10)], {1: set(base)}, []
    for i in range(40):
        gone = 3 if i < 8 else 30  # the first eight are linked with each other, the others with none
        sets[100 + i] = set(base[10:]) - set(rng.sample(base[10:], gone)) | set(rng.sample(common, 5)) | {number() for _ in range(gone)}
        members.append((1, 100 + i, 100 + i))
    table = spark.createDataFrame([(k, np.array(sorted(v), np.uint64).tobytes()) for k, v in sets.items()], "node long, shingles binary")
    pairs = neardup._across(spark.createDataFrame(members, "leader long, node long, component long"), table, 85)
    found = [(r.a, r.b) for r in pairs.collect()]
    assert len(found) == len(set(found))
    linked = {(a, b) for a in sets for b in sets if 1 < a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    assert linked and set(found) <= linked
    assert brute.components(200, found) == brute.components(200, list(linked))


def test_a_hub_of_many_parts_is_verified_with_all_partners(spark):
    sets = spark.createDataFrame([(k, np.array([7, 8, 9, *([] if k % 3 else [k + 10])], np.uint64).tobytes()) for k in range(30)], "node long, shingles binary")
    pairs = spark.createDataFrame([(0 if b % 2 else 1, b) for b in range(2, 30)], "a long, b long")
    got = sorted((r.a, r.b) for r in neardup._verified(pairs, sets, 100, group=2).collect())
    assert got == sorted((1, b) for b in range(2, 30) if b % 2 == 0 and b % 3)


def test_pairs_by_changes_join_what_all_pairs_join(spark):
    """Members of one leader's group: pairs by shared rare changes and by the
    group's core lead to the components that all linked pairs give."""
    rng = random.Random(21)
    percent, sets, members = 85, {}, []
    number = lambda: rng.randrange(1, 1 << 62)
    for leader in (1, 2, 3):
        base = {number() for _ in range((40, 100, 400)[leader - 1])}
        variants = [(rng.sample(sorted(base), len(base) // 5), [number() for _ in range(len(base) // 5)]) for _ in range(3)]
        sets[leader] = base
        for i in range(90):
            gone, come = rng.choice([([], []), *variants])
            n = rng.choice((0, 1, 3, 8, 15)) * len(base) // 100
            own = (base - set(gone) | set(come)) - set(rng.sample(sorted(base), n)) | {number() for _ in range(n)}
            node = leader * 1000 + i
            sets[node] = own
            members.append((leader, node, node))
    table = spark.createDataFrame([(k, np.array(sorted(v), np.uint64).tobytes()) for k, v in sets.items()], "node long, shingles binary")
    pairs = neardup._across(spark.createDataFrame(members, "leader long, node long, component long"), table, percent).distinct()
    linked = lambda a, b: 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    every = [(a, b) for l, a, _ in members for m, b, _ in members if l == m and a < b and linked(a, b)]
    found = [(r.a, r.b) for r in pairs.collect()]
    some = [x for x in found if linked(*x)]
    assert brute.components(4000, some) == brute.components(4000, every)
    assert len(every) > 500 and len(found) < len(members) * 90 / 4  # far from all pairs


def test_near_duplicates_odd_rows(spark, docs_of, odd):
    got = rows(neardup.near_duplicates(docs_of(odd + odd)))
    want = brute.near_duplicate_components(list(enumerate(odd + odd)))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    got = rows(neardup.near_duplicates(docs_of(["a b c d e", "a b c d e", "x y z", None, None], ids=[None, 5, None, None, 1])))
    assert sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in got), key=repr) == sorted(
        [(None, 5, False), (5, 5, True), (None, None, True), (None, None, True), (1, 1, True)], key=repr)
    assert neardup.near_duplicates(docs_of([])).count() == 0


def test_sketch_estimates_jaccard():
    rng = np.random.default_rng(1)
    for n, changed in ((2000, 160), (2000, 600), (700, 60)):
        errors = []
        for _ in range(60):
            a = np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64))
            b = np.unique(np.concatenate([a[changed:], rng.integers(0, 2 ** 64, changed, dtype=np.uint64)]))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            est = neardup.estimate(neardup.sketch(a)[None], neardup.sketch(b)[None], np.array([len(a)]), np.array([len(b)]))[0]
            errors.append(est - true)
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 1.6 * math.sqrt(0.25 / neardup.REGISTERS)


# --- vectors ------------------------------------------------------------------------

def check_vectors(spark, data, exact=True):
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    got = sorted(rows(lattice.near_vectors(df)), key=lambda r: r["vec_id"])
    x, ok = [], []
    for _, e, _ in data:
        a = np.array([np.nan if v is None else v for v in e], np.float32).astype(float) if e else np.zeros(1)
        ok.append(bool(np.isfinite(a).all() and a.any()))
        x.append(a / np.linalg.norm(a) if ok[-1] else a)
    links = [(i, j) for i in range(len(x)) for j in range(i) if ok[i] and ok[j] and len(x[i]) == len(x[j]) and x[i] @ x[j] >= 0.95]
    n = np.bincount([k for p in links for k in p], minlength=len(x))
    c = brute.components(len(x), links)
    if exact:
        assert [(r["n_links"], r["component_id"]) for r in got] == [(int(n[i]), c[i]) for i in range(len(x))]
    found = sum(r["n_links"] for r in got)
    return found, 2 * len(links), sum(r["component_id"] == k for r, k in zip(got, c)) / max(1, len(c))


def test_vectors_brute_force(spark):
    rng = np.random.default_rng(5)
    data = []
    for _ in range(40):
        center = rng.normal(size=64)
        data += [(center + rng.normal(size=64) * rng.choice([0.05, 0.12, 0.3])).astype(np.float32).tolist() for _ in range(rng.integers(1, 9))]
    data += [data[0]] * 20 + [data[3]] * 2
    found, all_, right = check_vectors(spark, [(i, e, 0) for i, e in enumerate(data)], exact=False)
    assert 0.995 * all_ <= found <= all_ and right > 0.99


def test_vectors_at_the_limit_recall(spark):
    rng = np.random.default_rng(6)
    data = []
    for _ in range(300):
        a = rng.normal(size=64)
        a /= np.linalg.norm(a)
        b = rng.normal(size=64)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        data += [a.tolist(), (0.951 * a + math.sqrt(1 - 0.951 ** 2) * b).tolist()]
    found, all_, _ = check_vectors(spark, [(i, e, 0) for i, e in enumerate(data)], exact=False)
    assert found >= 0.99 * all_


def test_vectors_odd_rows(spark):
    one = [1.0] + [0.0] * 63
    data = [one, one, None, [0.0] * 64, [float("nan")] + one[1:], [None] + one[1:], [float("inf")] + one[1:], [2.0] + [0.0] * 63,
            [1.0, 0.0], [3.0, 0.1], [], [-1.0] + [0.0] * 63, [-0.0, 1.0] + [0.0] * 62, [0.0, 1.0] + [0.0] * 62]
    check_vectors(spark, [(i, e, i) for i, e in enumerate(data)])
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert lattice.near_vectors(empty).count() == 0


def test_vectors_of_a_large_group_are_not_written_pair_by_pair(spark, monkeypatch):
    rng = np.random.default_rng(8)
    center = rng.normal(size=64)
    data = [(i, (center + rng.normal(size=64) * 0.02).tolist(), 0) for i in range(300)]
    made, write = {}, lattice.written

    def watched(df, what, *a, **k):
        out = write(df, what, *a, **k)
        made[what] = made.get(what, 0) + out.count()
        return out

    monkeypatch.setattr(lattice, "written", watched)
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    assert {(r["n_links"], r["component_id"]) for r in rows(lattice.near_vectors(df))} == {(299, 0)}
    assert sum(made.values()) < 12 * len(data)  # of 44,850 pairs


def test_vectors_in_many_regions_and_rounds(spark):
    rng = np.random.default_rng(9)
    data = []
    for _ in range(120):
        center = rng.normal(size=16)
        data += [center + rng.normal(size=16) * rng.choice([0.02, 0.08, 0.2]) for _ in range(rng.integers(1, 9))]
    # every other row holds numbers that 32 bits hold exactly; lengths differ
    data = [x.astype(np.float32).astype(float) if k % 2 else x for k, x in enumerate(data)] + [rng.normal(size=3) for _ in range(30)]
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(data)], "vec_id long, embedding array<double>")
    dealt = lattice.Regions(np.zeros((0, 4, 8), np.int16), 1)
    assert dealt.of(np.ones((5, 4, 8), np.int16)).tolist() == [[0] * 4] * 5
    whole = sorted(rows(lattice.near_vectors(df, tables=4)), key=lambda r: r["vec_id"])
    parts = sorted(rows(lattice.near_vectors(df, tables=4, region_bytes=15_000, round_bytes=0)), key=lambda r: r["vec_id"])
    assert parts == whole
    unit = [x / np.linalg.norm(x) for x in data]
    links = [(i, j) for i in range(len(data)) for j in range(i) if len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.95]
    found = sum(r["n_links"] for r in whole)
    assert 500 < 0.95 * 2 * len(links) <= found <= 2 * len(links)


def test_e8_decoder_is_nearest():
    rng = np.random.default_rng(2)
    y = rng.normal(size=(300, 8)) * 2
    best = lattice.nearest_e8(y)
    assert np.allclose(best * 2, np.rint(best * 2)) and (best.sum(axis=1) % 2 == 0).all()
    roots = lattice.e8_roots()
    assert len(roots) == 240 and np.allclose((roots ** 2).sum(axis=1), 2)
    d = ((y - best) ** 2).sum(axis=1)
    for r in roots:
        assert (((y - best - r) ** 2).sum(axis=1) >= d - 1e-9).all()
    assert (d <= 1 + 1e-9).all()  # the covering radius of E8 is 1


# --- URLs ---------------------------------------------------------------------------

def judge(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:cut].translate(brute.LOWER), rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


def check_urls(spark, texts, rules):
    pages = spark.createDataFrame([(i, t, "x", "h") for i, t in enumerate(texts)], "page_id long, url string, key string, suffix string")
    table = spark.createDataFrame(list(rules), "verdict string, host string, path string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows(urls.match_rules(pages, table))}
    assert got == {i: judge(t, rules) for i, t in enumerate(texts)}


def test_urls_odd_rows(spark):
    texts = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/A?x=/en/", "http://example.com", "http://example.com/", "http://example.com/en",
             "http://example.com/en/", "http://notexample.com/en/", "http://a.b.example.com/en/1#://x", "x://net/es/", "x://y.net/fr/", "x://y.net/fr?/fr/",
             "http://u://v.net/es/", "http://com/", "http://É.com/", "http://a..com//", "//example.com/en/", "http://example.com/en/", "http://a\nb.net/es/\nx",
             "http://net" + "/es" * 3000 + "/"]
    check_urls(spark, texts, urls.RULES)
    check_urls(spark, texts, [])
    check_urls(spark, [], urls.RULES)


def test_urls_long_list(spark):
    rng = random.Random(7)
    hosts = [f"h{i}.{d}" for i in range(60) for d in ("com", "net")]
    rules = [(rng.choice(["allow", "block"]), h, p) for h in hosts[:50] for p in ("/", "/a/", "/a/b/") if rng.random() < 0.6]
    texts = [f"http://{rng.choice(['', 'www.', 'x.y.'])}{rng.choice(hosts)}/{rng.choice(['', 'a/', 'a/b/', 'ab', 'c/'])}" for _ in range(600)]
    check_urls(spark, texts, rules)


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    from pyspark.sql import functions as F
    listed = spark.range(4000).select(F.col("id").cast("string").alias("key"))
    words = urls.build_filter(listed)
    assert words.nbytes == -(-4000 * 16 // 512) * 64
    test = urls.possible(spark, words)
    assert listed.filter(test(F.xxhash64("key"))).count() == 4000
    others = spark.range(10_000, 30_000).select(F.col("id").cast("string").alias("key"))
    assert others.filter(test(F.xxhash64("key"))).count() < 400


# --- the pipeline ---------------------------------------------------------------------

def test_pipeline_small_table(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "language_id", "near_duplicates", "source_mixing", "packing"]
    sf = SF_SMALL.replace("sf0.001", "sf0.01")
    quality = corpus_pipeline.written(stages["quality_classifier"](spark, read_table(spark, sf, "documents"), sf), "test")
    assert quality.columns == docs.columns
    hand = {r.doc_id: (r.quality, r.toxic) for r in read_table(spark, sf, "labels").collect()}
    kept = {r.doc_id for r in quality.select("doc_id").collect()}
    clean = [i for i, h in hand.items() if h == (1, 0)]
    assert sum(i in kept for i in clean) / len(clean) > 0.95
    tagged = corpus_pipeline.written(stages["language_id"](spark, docs, SF_SMALL), "test")
    assert tagged.columns == docs.columns and tagged.count() >= 0.97 * docs.count()
    alone = corpus_pipeline.written(stages["near_duplicates"](spark, tagged, SF_SMALL), "test")
    groups = brute.near_duplicate_components(sorted((r.doc_id, r.text) for r in tagged.collect()), 5, 80)
    assert {r.doc_id for r in alone.collect()} == {d for d, (_, c) in groups.items() if d == c}
    mixed = corpus_pipeline.written(stages["source_mixing"](spark, alone, SF_SMALL), "test")
    assert mixed.columns == docs.columns
    sizes, taken = {}, {}
    for r in alone.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(brute.words(r.text))
    texts = {r.doc_id: r.text for r in alone.collect()}
    for r in mixed.collect():
        taken[r.source] = taken.get(r.source, 0) + len(brute.words(r.text))
        w, whole = brute.words(r.text), brute.words(texts[r.doc_id])
        assert r.text == texts[r.doc_id] or any(whole[i:i + len(w)] == w for i in range(len(whole)))
        assert r.n_chars == len(r.text)
    for s, t in brute.targets(sizes).items():
        assert abs(taken.get(s, 0) - t) <= 0.5 + 1e-6
    packed = stages["packing"](spark, mixed, SF_SMALL)
    from collections import Counter
    assert Counter(r.doc_id for r in mixed.collect()) == Counter(r.doc_id for r in packed.filter("start = 0").collect())


def test_pipeline_stages_take_odd_rows(spark, docs_of, odd):
    clean = [f"A plain sentence about thing {i}, with words enough for a document, and a second clause. Then it ends." for i in range(30)]
    texts = odd + clean + clean[:3]
    ids = [None, 1, 1, *range(3, len(odd) + 33)]
    docs = docs_of(texts, ids=[*ids[:len(odd) + 30], ids[len(odd)], None, 900], langs=["en"] * len(texts))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.written(stage(spark, docs, SF_SMALL), "test")
        assert out.columns == docs.columns and out.schema == docs.schema, name
        empty = stage(spark, docs_of([]), SF_SMALL)
        assert empty.columns == docs.columns and empty.count() == 0, name
    near = corpus_pipeline.written(dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF_SMALL), "test")
    assert near.filter(near.doc_id == ids[len(odd)]).count() == 1  # a repeated row is one document
    assert corpus_pipeline.STAGES[-1][1](spark, docs_of([]), SF_SMALL).count() == 0


def test_queries_are_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
    assert set(queries.ORACLES) <= set(names) and set(queries.ORACLES) <= set(entry.oracle_sql())


def test_nothing_else_imports_this_package():
    import pathlib
    import re
    root = pathlib.Path(__file__).parents[2]
    for p in [*root.glob("orrery/**/*.py"), *root.glob("tests/*.py"), *root.glob("tools/*.py"), root / "bench.py"]:
        if "llm" not in p.relative_to(root).parts:
            assert not re.search(r"\b(orrery\.llm|from \.+llm|import llm|corpus_pipeline)\b", p.read_text()), p


@pytest.mark.parametrize("name", ["op8_url_filter"])
def test_oracles(spark, name):
    import duckdb
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF_SMALL}/pages.parquet')")
    cur = con.execute(queries.ORACLES[name])
    names = [d[0] for d in cur.description]
    df = queries.QUERIES[name](spark, SF_SMALL)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(repr, (tuple(r[c] for c in names) for r in df.collect()))) == sorted(map(repr, cur.fetchall()))


def test_url_rules_replace_columns_of_their_names(spark):
    table = spark.createDataFrame([(1, "http://a.example.com/en/x", "r", "h", "p", "v", 7)], "page_id long, url string, rule string, host string, path string, verdict string, rule_verdict int")
    rules = spark.createDataFrame([("block", "example.com", "/en/")], "verdict string, host string, path string")
    assert rows(urls.match_rules(table, rules)) == [
        {"page_id": 1, "url": "http://a.example.com/en/x", "host": "a.example.com", "path": "/en/x", "rule": "example.com/en/", "verdict": "block"}]
    assert urls.match_rules(table.limit(0), rules).count() == 0
