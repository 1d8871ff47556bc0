"""Near-duplicate documents by HyperMinHash.

The 64-bit hashes of a document's shingles fall into buckets; a register
keeps the smallest hash of its bucket as a leading-zero count and a few
mantissa bits. Bands of registers bring candidates together, the registers
estimate their Jaccard similarity (corrected for accidental equality), and
the full shingle sets decide.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Hashes, binary_texts, mix64, portions, remove, shingle_hashes, written
from .components import connected_components

REGISTERS, ROWS, MANTISSA = 128, 5, 10
BANDS = REGISTERS // ROWS
_EMPTY = np.uint16(0xFFFF)


def _register(h: np.ndarray) -> np.ndarray:
    """Leading zeros (6 bits) and the 10 bits after the first one of 57-bit values."""
    h = h & np.uint64((1 << 57) - 1)
    top = np.frexp(h.astype(np.float64))[1].astype(np.int64)  # bits in use
    rounded_up = (top > 0) & ((h >> np.maximum(top - 1, 0).astype(np.uint64)) == 0)
    top -= rounded_up
    zeros = np.minimum(57 - top, 62)
    left = np.where(top > 0, h << (np.maximum(57 - top + 1, 0)).astype(np.uint64), 0) & np.uint64((1 << 57) - 1)
    return ((zeros.astype(np.uint64) << np.uint64(MANTISSA)) | (left >> np.uint64(57 - MANTISSA))).astype(np.uint16)


# Where an empty bucket borrows from: for each bucket a fixed random order of the others.
_ORDER = np.argsort(mix64(np.arange(REGISTERS * REGISTERS, dtype=np.uint64) + np.uint64(77)).reshape(REGISTERS, REGISTERS), axis=1)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Registers of a sorted set of distinct shingle hashes (not empty). An
    empty bucket takes the register of the first filled one in its own fixed
    order, so equal registers keep the probability of the Jaccard similarity."""
    bucket = (shingles >> np.uint64(57)).astype(np.int64)  # 128 buckets: the top 7 bits
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    out = np.full(REGISTERS, _EMPTY, np.uint16)
    out[bucket[first]] = _register(shingles[first])
    empty = np.flatnonzero(out == _EMPTY)
    if len(empty):
        filled = out != _EMPTY
        order = _ORDER[empty]
        out[empty] = out[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    """(documents, 128) registers -> (documents, bands) keys."""
    r = registers[:, :BANDS * ROWS].reshape(len(registers), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), r.shape[:2]).copy()
    for j in range(ROWS):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + r[..., j])
    return key.view(np.int64)


def chance(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Probability that registers of different shingles are equal, for sets of these sizes."""
    edge = 2.0 ** -np.arange(0, 56)
    def cells(n):
        per = np.maximum(n / REGISTERS, 1.0)[:, None]
        return np.diff(-np.exp(-per * edge[None, :]) + 1.0, axis=1) * -1.0
    return (cells(n_a) * cells(n_b)).sum(axis=1) / 2 ** MANTISSA


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from registers, corrected for chance equality."""
    c = chance(n_a, n_b)
    return ((a == b).mean(axis=1) - c) / (1 - c)


def shingle_set(text: bytes | None, hashes: Hashes, width: int) -> np.ndarray:
    words = text.lower().split() if text else []
    return np.unique(shingle_hashes(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)), width))


def _node(s: np.ndarray) -> int:
    """The name of a shingle set: a 64-bit hash of all of it."""
    import xxhash
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def _sketches(docs: DataFrame, width: int) -> DataFrame:
    def look(batches):
        hashes = Hashes()
        for batch in portions(batches, 1):
            sizes, nodes, regs = [], [], []
            for text in binary_texts(batch.column(1)):
                s = shingle_set(text, hashes, width)
                sizes.append(len(s))
                nodes.append(_node(s) if len(s) else None)
                regs.append(sketch(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                                              pa.array(regs, pa.binary())], names=["doc_id", "n_shingles", "node", "registers"])

    return docs.mapInArrow(look, "doc_id long, n_shingles long, node long, registers binary")


def _sets(docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """(node, set) of the given classes, from the texts of their first documents."""
    def look(batches):
        hashes = Hashes()
        for batch in portions(batches, 0):
            sets = [shingle_set(t, hashes, width) for t in binary_texts(batch.column(0))]
            sets = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([_node(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                                             names=["node", "shingles"])

    firsts = classes.select(F.col("low").alias("doc_id")).distinct()
    text = docs.select("doc_id", "text").join(firsts.hint("shuffle_hash"), "doc_id", "left_semi").select("text")
    found = text.mapInArrow(look, "node long, shingles binary")
    # A repeated id may bring in other texts; a class may come from several rows.
    return found.join(classes.select("node"), "node", "left_semi").dropDuplicates(["node"])


def _close(pairs: DataFrame, classes: DataFrame, least: float, margin: float) -> DataFrame:
    """Pairs (a, b) whose registers do not rule out a similarity of ``least``.

    ``margin`` is five standard deviations of the estimate; sets of few
    shingles, whose registers depend on each other, always pass.
    """
    @F.pandas_udf("boolean")
    def near(ra: pd.Series, rb: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
        a = np.frombuffer(b"".join(ra), np.uint16).reshape(-1, REGISTERS)
        b = np.frombuffer(b"".join(rb), np.uint16).reshape(-1, REGISTERS)
        n_a, n_b = na.to_numpy(float), nb.to_numpy(float)
        small = np.minimum(n_a, n_b) < 4 * REGISTERS
        possible = 100 * np.minimum(n_a, n_b) >= 100 * least * np.maximum(n_a, n_b) - 1e-6
        return pd.Series(possible & (small | (estimate(a, b, n_a, n_b) >= least - margin)))

    r = classes.select("node", "registers", "n_shingles")
    both = pairs.join(r.toDF("a", "ra", "na"), "a").join(r.toDF("b", "rb", "nb"), "b")
    return both.filter(near("ra", "rb", "na", "nb")).select("a", "b")


def _dealt(pairs: DataFrame, sets: DataFrame, group: int) -> DataFrame:
    """(a, part, b, shingles) of pairs (a, b), in tasks by a and part, each
    part opened by a row of a itself (b = a).

    The partners of a node are dealt into groups of about ``group``; the
    node's own set travels once a group, so a hub is split over many tasks.
    """
    size = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / group).cast("long").alias("parts"))
    many = size.filter("parts > 1")  # few: only these are joined to the pairs
    dealt = pairs.join(many, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1))).alias("part"))
    members = dealt.join(sets.toDF("b", "shingles"), "b").select("a", "part", "b", "shingles")
    hubs = size.join(sets.toDF("a", "shingles"), "a").select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("a").alias("b"), "shingles")
    return hubs.union(members).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b") != F.col("a"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, group: int = 256) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union, on the full sets."""
    def verify(batches):
        hub, mine = None, None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            keep = []
            for i, s in enumerate(batch.column(3).to_pylist()):
                s = np.frombuffer(s, np.uint64)
                if a[i] == b[i]:
                    hub, mine = a[i], s
                elif a[i] == hub:
                    common = len(mine) + len(s) - len(np.union1d(mine, s))
                    if 100 * common >= percent * (len(mine) + len(s) - common):
                        keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], names=["a", "b"])

    return _dealt(pairs, sets, group).mapInArrow(verify, "a long, b long")


def _changes(members: DataFrame, sets: DataFrame, group: int = 256) -> DataFrame:
    """(leader, node) -> (leader, node, changes, n): the shingles that only one
    of the two has, as an array, and the size of the node's set."""
    def look(batches):
        hub, mine = None, None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            found = []
            for i, s in enumerate(batch.column(3).to_pylist()):
                s = np.frombuffer(s, np.uint64)
                if a[i] == b[i]:
                    hub, mine = a[i], s
                elif a[i] == hub:
                    found.append((a[i], b[i], np.setxor1d(mine, s, assume_unique=True).view(np.int64), len(s)))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()),
                                              pa.array([x[2] for x in found], pa.list_(pa.int64())), pa.array([x[3] for x in found], pa.int64())],
                                             names=["leader", "node", "changes", "n"])

    return _dealt(members.toDF("a", "b"), sets, group).mapInArrow(look, "leader long, node long, changes array<long>, n long")


def _across(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Linked pairs (a, b) from (leader, node, component): of one leader and two
    components or with the group's core; none is left out but for those that
    other pairs given here join anyway.

    D: a node's changes against the centre of the group, the shingles that more
    than half of it have (so what is odd about the leader counts for nobody):
    its changes against the leader, but with those that most have turned
    round. A pair at a similarity of s or more differs in at most d = (1 - s) / (1 + s) of the two sizes, and
    its difference is that of the two D. So either the D share a shingle, and
    one of the (1 - s) / s * size + 1 rarest of each D is shared (rarest within
    the leader's group, one order for all); or |D| - d * size of the two add
    up to 0 at most, and then the group's node that has the least of
    it is linked with both.
    """
    s = percent / 100
    led = written(_changes(members.select("leader", "node"), sets).join(members, ["leader", "node"]), "changes", gathered=True)
    often = led.select("leader", F.explode("changes").alias("shingle")).groupBy("leader", "shingle").agg(F.count(F.lit(1)).alias("often"))
    most = often.join(led.groupBy("leader").agg(F.count(F.lit(1)).alias("members")), "leader").filter("2 * often > members")
    turned = most.groupBy("leader").agg(F.collect_list("shingle").alias("turned"))  # at most twice the mean number of changes
    turned = led.join(turned, "leader", "left").withColumn("turned", F.coalesce("turned", F.array().cast("array<long>")))
    each = written(turned.withColumn("changes", F.array_union(F.array_except("changes", "turned"), F.array_except("turned", "changes"))).drop("turned"), "centred-changes", gathered=True)
    remove(led)
    excess = F.size("changes") - F.col("n") * ((1 - s) / (1 + s))
    core = each.groupBy("leader").agg(F.min_by("node", F.struct(excess, "node")).alias("core"), F.min(excess).alias("least"))
    near_core = each.join(core, "leader").filter((excess + F.col("least") <= 1e-6) & (F.col("node") != F.col("core"))).select("leader", F.col("core").alias("a"), F.col("node").alias("b"))
    single = each.select("leader", "node", "component", "n", (F.floor(F.col("n") * ((1 - s) / s) + 1e-6) + 1).alias("most"), F.size("changes").alias("size"), F.explode("changes").alias("shingle"))
    shared = single.groupBy("leader", "shingle").agg(F.count(F.lit(1)).alias("often"), F.min("component").alias("lo"), F.max("component").alias("hi")).filter("often > 1")
    rows = single.join(shared, ["leader", "shingle"])
    of_node = Window.partitionBy("leader", "node")
    # The shingles that no other node of the group has are the rarest and bring no pair.
    rows = rows.withColumn("common", F.count(F.lit(1)).over(of_node)).withColumn("own", F.col("size") - F.col("common"))
    rows = rows.withColumn("rank", F.row_number().over(of_node.orderBy("often", "shingle")))
    rows = rows.filter("rank <= most - own and lo <> hi").select("leader", "shingle", "node", "component", "n", (F.col("own") + F.col("rank") - 1).alias("before"), (F.col("common") - F.col("rank")).alias("after"))
    rows = written(rows, "rare-changes", gathered=True)
    mixed = rows.groupBy("leader", "shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("leader", "shingle")
    rows = rows.join(mixed, ["leader", "shingle"])
    left = rows.toDF("leader", "shingle", "a", "ca", "na", "xa", "za")
    right = rows.toDF("leader", "shingle", "b", "cb", "nb", "xb", "zb")
    # At the rarest shingle that two D share, all rarer ones are differences, and what one has more of the others.
    least = F.col("xa") + F.col("xb") + F.abs(F.col("za") - F.col("zb"))
    met = left.join(right, ["leader", "shingle"]).filter("a < b and ca <> cb").filter(least <= (F.col("na") + F.col("nb")) * ((1 - s) / (1 + s)) + 1e-6)
    found = near_core.select("leader", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).union(met.select("leader", "a", "b"))
    # Any leader's D tell how much the two sets differ, so one is enough to leave out what is too far apart.
    found = written(found.groupBy("a", "b").agg(F.min("leader").alias("leader")), "met", gathered=True)
    of_both = found.join(each.select("leader", F.col("node").alias("a"), F.col("n").alias("na"), F.col("changes").alias("da")), ["leader", "a"])
    of_both = of_both.join(each.select("leader", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("changes").alias("db")), ["leader", "b"])
    differ = F.size("da") + F.size("db") - 2 * F.size(F.array_intersect("da", "db"))
    return of_both.filter(differ <= (F.col("na") + F.col("nb")) * ((1 - s) / (1 + s)) + 1e-6).select("a", "b")


def near_duplicates(docs: DataFrame, width: int = 3, percent: int = 85) -> DataFrame:
    """(doc_id, text) -> one row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * intersection >= ``percent`` * union of their
    sets of distinct ``width``-word shingles (words at ASCII white space, A-Z
    lower-cased; a shorter text is one shingle; null, empty and white texts
    have none and link with nothing). component_id is the smallest doc_id
    reachable by links; kept = (doc_id = component_id).

    Equal sets form a class; only classes are compared. In every band bucket
    all classes are compared with two leaders: the first by name, the same in
    all the bands it is in, and the first of one of four random orders. Where
    a bucket still joins several components, its classes are compared across
    the components, each by its changes against the bucket's first: only pairs
    that share one of their rarest changes, or changed little, can be linked
    (``_across``), and their changes tell which of them are. So members of a large family of copies that each changed much in a
    way of its own are not compared with each other. No component is left apart
    that links between members of one bucket would join. With 25 bands of 5
    registers a pair at 0.85 shares no bucket with probability 4e-7.

    Repeated rows are documents of their own; a null doc_id is never the
    smallest id, and a class with null ids only is its own component, null.
    """
    docs = docs.select("doc_id", "text")
    rows = written(_sketches(docs, width), "sketches")
    classes = written(rows.filter("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("low"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers")), "classes", gathered=True)

    def keys(batches):
        for batch in batches:
            regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, REGISTERS)
            yield pa.RecordBatch.from_arrays([pa.array(band_keys(regs).ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))], names=["key", "node"])

    bands = classes.filter("low is not null").select("node", "registers").mapInArrow(keys, "key long, node long")
    firsts = bands.groupBy("key").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n"),
                                      F.min_by("node", F.xxhash64("node", F.pmod("key", F.lit(4)))).alias("other")).filter("n > 1")
    buckets = written(bands.join(firsts, "key"), "buckets", gathered=True)  # only buckets of two classes or more
    met = classes.join(buckets.select("node").distinct(), "node", "left_semi")
    sets = written(_sets(docs, met, width), "shingle-sets", gathered=True)
    margin = 5 * (percent / 100 * (1 - percent / 100) / REGISTERS) ** 0.5

    def links(pairs):
        # Written once: the verification reads the pairs several times.
        return _verified(written(_close(pairs.distinct(), classes, percent / 100, margin), "close-pairs", gathered=True), sets, percent)

    led = buckets.select(F.explode(F.array("first", "other")).alias("lead"), "node").filter("node <> lead")
    edges = written(links(led.select(F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b"))), "links", gathered=True)
    component = written(connected_components(edges), "components", gathered=True)
    labelled = buckets.filter("n > 2").join(component, "node", "left").select("key", "first", "node", F.coalesce("component", "node").alias("component"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("key")
    open_ = labelled.join(mixed, "key").filter("node <> first").select(F.col("first").alias("leader"), "node", "component").distinct()
    rest = _across(written(open_, "open-buckets", gathered=True), sets, percent)
    more = written(links(rest), "links", gathered=True)
    if not more.isEmpty():
        component = connected_components(component.toDF("a", "b").union(more))

    info = classes.select("node", "low").join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = info.groupBy("component").agg(F.min("low").alias("component_id"))
    info = info.join(smallest, "component").select("node", "component_id")
    out = rows.filter("node is not null").select("doc_id", "n_shingles", "node").join(info, "node").drop("node")
    out = out.union(rows.filter("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op7(spark, sf_dir) -> DataFrame:
    from ..tables import read_table
    return near_duplicates(read_table(spark, sf_dir, "documents"))
