"""Near-duplicate vectors by lattice hashing.

Random projections to 8 dimensions are decoded to the nearest point of the
E8 lattice, in several tables. A vector's home cell is probed together with
the neighbouring cells nearest to it; vectors that meet in a cell are
candidates, and the cosine in double precision decides (products in single
precision tell those that are far from the limit).
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, remove, written
from .components import connected_components


def _nearest_d8(y: np.ndarray) -> np.ndarray:
    """Nearest point of D8 (whole coordinates of even sum): round, and where
    the sum is odd round the worst coordinate the other way."""
    f = np.rint(y)
    odd = np.flatnonzero(f.sum(axis=1) % 2 != 0)
    rest = y[odd] - f[odd]
    worst = np.abs(rest).argmax(axis=1)
    at = np.arange(len(odd))
    f[odd, worst] += np.where(rest[at, worst] >= 0, 1.0, -1.0)
    return f


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """Nearest point of E8, the union of D8 and D8 shifted by one half."""
    a, b = _nearest_d8(y), _nearest_d8(y - 0.5) + 0.5
    closer = ((y - a) ** 2).sum(axis=1) <= ((y - b) ** 2).sum(axis=1)
    return np.where(closer[:, None], a, b)


def e8_roots() -> np.ndarray:
    """The 240 shortest vectors of E8: steps to the neighbouring cells."""
    whole = []
    for i, j in combinations(range(8), 2):
        for s, t in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            whole.append(v)
    half = [np.array(v) for v in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(whole + half)


#: Doubled coordinates of a lattice point as the digits of one number: codes add up as points do.
_DIGITS = 256 ** np.arange(8, dtype=np.int64)


def _codes(doubled: np.ndarray) -> np.ndarray:
    return (doubled.astype(np.int64) * _DIGITS).sum(axis=-1)


def _unit(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.float64)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Cells:
    """Home cells and probed neighbours of unit vectors, table by table."""

    def __init__(self, tables: int, probes: int, scale: float, seed: int):
        self.tables, self.probes, self.scale, self.seed = tables, probes, scale, seed
        self.roots = e8_roots()
        self.steps = (2 * self.roots).astype(np.int16)
        self.step_codes = _codes(self.steps)
        self.by_code = np.argsort(self.step_codes)
        self.projections: dict[int, np.ndarray] = {}

    def of(self, x: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """The home cells' doubled coordinates and the roots that lead to the probed cells."""
        dim = x.shape[1]
        if dim not in self.projections:
            self.projections[dim] = np.random.default_rng([self.seed, dim]).normal(size=(self.tables, dim, 8)) * self.scale
        home, near = [], []
        for s in range(0, len(x), 500):
            y = x[s:s + 500] @ self.projections[dim][table]
            point = nearest_e8(y)
            rest = y - point
            # |rest - root|^2 without the part that all roots share
            far = (self.roots * self.roots).sum(axis=1)[None, :] - 2 * rest @ self.roots.T
            near.append(np.argpartition(far, self.probes, axis=1)[:, :self.probes].astype(np.uint8))
            home.append((2 * point).astype(np.int16))
        return np.concatenate(home), np.concatenate(near)

    def root(self, step: np.ndarray) -> np.ndarray:
        """The root with the code ``step``, or 255."""
        k = self.by_code[np.minimum(np.searchsorted(self.step_codes, step, sorter=self.by_code), len(self.roots) - 1)]
        return np.where(self.step_codes[k] == step, k, 255).astype(np.uint8)

    def points(self, home: np.ndarray, near: np.ndarray) -> np.ndarray:
        """All cells a vector is looked for in, its home first."""
        return np.concatenate([home[:, None, :], home[:, None, :] + self.steps[near]], axis=1)


class Regions:
    """Cells of a table in regions of neighbouring cells, so that a vector's
    cells lie in few of them: halved, the fullest first, until none holds more
    than ``most`` of the vectors given (or halving leaves most of them in both)."""

    def __init__(self, points: np.ndarray, most: float):
        n = len(points)
        axis, cut, low, high, depth = [0], [0], [0], [0], [0]
        cells = np.zeros(points.shape[:2], np.int32)
        held, open_ = {0: n}, {0}
        while open_ and held[at := max(open_, key=held.__getitem__)] > most:
            open_.discard(at)
            rows = np.flatnonzero((cells == at).any(axis=1))
            there, inside = points[rows], cells[rows] == at
            best = None
            for a in range(8):
                middle = int(np.median(there[:, :, a][inside]))
                for c in (middle - 1, middle):
                    up = there[:, :, a] > c
                    sizes = [int((inside & ~up).any(axis=1).sum()), int((inside & up).any(axis=1).sum())]
                    if best is None or max(sizes) + sum(sizes) / 2 < best[0]:
                        best = max(sizes) + sum(sizes) / 2, a, c, sizes
            _, a, c, sizes = best
            if max(sizes) > 0.9 * held[at]:
                continue
            new = len(axis)
            axis[at], cut[at], low[at], high[at] = a, c, new, new + 1
            for k in (new, new + 1):
                axis.append(0), cut.append(0), low.append(k), high.append(k), depth.append(depth[at] + 1)
            up = there[:, :, a] > c
            cells[rows] = np.where(inside, np.where(up, new + 1, new), cells[rows])
            del held[at]
            held |= {new: sizes[0], new + 1: sizes[1]}
            open_ |= {new, new + 1}
        self.axis, self.cut, self.low, self.high = (np.array(x, np.int32) for x in (axis, cut, low, high))
        self.depth = max(depth)
        #: region -> share of the vectors that have a cell in it
        self.share = {k: v / max(1, n) for k, v in held.items()}

    def of(self, points: np.ndarray) -> np.ndarray:
        flat, at = points.ravel(), np.zeros(points.shape[0] * points.shape[1], np.int32)
        first = np.arange(0, len(flat), 8, dtype=np.int32)
        for _ in range(self.depth):
            at = np.where(flat.take(first + self.axis.take(at)) > self.cut.take(at), self.high.take(at), self.low.take(at))
        return at.reshape(points.shape[:2])


def _record(probes: int, size: int) -> np.dtype:
    """What a region is told of a vector: which of its cells are inside (bits), and its numbers."""
    return np.dtype([("node", "<i8"), ("n", "<i8"), ("home", "<i8"), ("near", "u1", (probes,)), ("inside", "u1", (probes // 8 + 1,)), ("x", f"V{size}")])


def _deal(cells: Cells, regions: dict[int, Regions], wanted: dict[int, list[int]], together: int = 500_000):
    """Vector classes -> their records for each wanted region, many in a row."""

    def run(batches):
        held: dict[tuple[int, int, int], list[bytes]] = {}
        size: dict[tuple[int, int, int], int] = {}

        def flush(which):
            for k in which:
                yield pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in k), pa.array([b"".join(held.pop(k))], pa.binary())], names=["key", "dim", "width", "records"])
                del size[k]

        for batch in batches:
            node, n, dims = (batch.column(i).to_numpy() for i in range(3))
            raw = batch.column(3).to_pylist()
            widths = np.array([len(x) for x in raw]) // np.maximum(dims, 1)
            for dim, width in sorted(set(zip(dims.tolist(), widths.tolist()))):
                pick = np.flatnonzero((dims == dim) & (widths == width))
                for part in np.array_split(pick, max(1, -(-len(pick) * dim // 200_000))):
                    if not len(part):
                        continue
                    told = np.zeros(len(part), _record(cells.probes, dim * width))
                    told["node"], told["n"] = node[part], n[part]
                    numbers = np.frombuffer(b"".join(raw[i] for i in part), f"<f{width}").reshape(-1, dim)
                    told["x"] = numbers.view(f"V{dim * width}").ravel()
                    x = _unit(numbers)
                    for t, some in wanted.items():
                        home, told["near"] = cells.of(x, t)
                        told["home"] = _codes(home)
                        at = regions[t].of(cells.points(home, told["near"])).T.copy()
                        for region in some:
                            inside = at == region
                            rows = np.flatnonzero(inside.any(axis=0))
                            if len(rows):
                                k, own = (t << 32 | region, dim, width), told[rows]
                                own["inside"] = np.packbits(inside[:, rows].T, axis=1)
                                held.setdefault(k, []).append(own.tobytes())
                                size[k] = size.get(k, 0) + own.nbytes
                    yield from flush([k for k, v in size.items() if v >= together])
                    if sum(size.values()) > 32 * together:
                        yield from flush(list(held))
        yield from flush(list(held))

    return run


class Region:
    """The vectors of one length that have cells in a region; finds their links."""

    def __init__(self, cells: Cells, table: int, dim: int, least: float, parts: list[tuple[int, bytes]]):
        self.cells, self.table, self.least = cells, table, least
        told = [np.frombuffer(b, _record(cells.probes, dim * width)) for width, b in parts]
        field = lambda name: np.concatenate([r[name] for r in told])
        self.node, self.n, self.home, self.near = (field(c) for c in ("node", "n", "home", "near"))
        self.inside = np.unpackbits(field("inside"), axis=1, count=cells.probes + 1).astype(bool)
        wide = f"<f{max(width for width, _ in parts)}"
        self.raw = np.concatenate([np.ascontiguousarray(r["x"]).view(f"<f{width}").reshape(-1, dim).astype(wide, copy=False) for r, (width, _) in zip(told, parts)])
        self.u = np.empty(self.raw.shape, np.float32)
        for s in range(0, len(self.u), 4000):
            x = self.raw[s:s + 4000].astype(np.float64)
            self.u[s:s + 4000] = x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
        # What products of 32-bit numbers can be off by.
        self.margin = 1.2e-7 * (dim + 16)
        self.others = np.zeros(len(self.node))
        self.up = np.arange(len(self.node))
        self.known: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def candidates(self, most: int = 1 << 18):
        """(i, j, cosine in 32 bits) of the vectors that meet in a cell at home
        to i, and may be near enough. A pair of two homes comes up once there."""
        rows = np.flatnonzero(self.inside[:, 0])
        rows = rows[np.argsort(self.home[rows], kind="stable")]
        cell, first, homes = np.unique(self.home[rows], return_index=True, return_counts=True)
        if not len(cell):
            return
        guest, k = np.nonzero(self.inside[:, 1:])
        code = self.home[guest] + self.cells.step_codes[self.near[guest, k]]
        place = np.minimum(np.searchsorted(cell, code), len(cell) - 1)
        there = cell[place] == code
        guest, place = guest[there], place[there]
        guest = guest[np.argsort(place.astype(np.uint16) if len(cell) < 1 << 16 else place, kind="stable")]
        guests = np.bincount(place, minlength=len(cell))
        last = np.cumsum(guests)
        limit = np.float32(self.least - self.margin)
        some = np.flatnonzero((homes > 1) | (guests > 0))
        for a, m, z, k in zip(*(x[some].tolist() for x in (first, homes, last, guests))):
            here = rows[a:a + m]
            other = np.concatenate((here, guest[z - k:z])) if m > 1 else guest[z - k:z]
            after = 0 if m > 1 else -m
            for q in range(0, len(other), 1 << 16):
                there = other[q:q + (1 << 16)]
                x, n = self.u[there].T, len(there)
                step = max(1, most // n)
                for s in range(0, m, step):
                    g = (self.u[here[s:s + step]] @ x).ravel()
                    hit = np.flatnonzero(g >= limit)
                    if len(hit):
                        i = hit // n
                        j = hit - i * n
                        later = np.flatnonzero(j + q > i + (s + after))
                        if len(later):
                            yield here[i[later] + s], there[j[later]], g[hit[later]]

    def _probes(self, near: np.ndarray, step: np.ndarray) -> np.ndarray:
        return (near == self.cells.root(step)[:, None]).any(axis=1)

    def _cells(self, table: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Home codes and probed roots in another table, of all rows; those of the given ones are filled in."""
        if table not in self.known:
            self.known[table] = np.zeros(len(self.node), bool), np.zeros(len(self.node), np.int64), np.zeros(self.near.shape, np.uint8)
        have, home, near = self.known[table]
        asked = np.zeros(len(have), bool)
        asked[rows] = True
        new = np.flatnonzero(asked & ~have)
        for part in np.array_split(new, max(1, -(-len(new) // 4000))):
            if len(part):
                point, near[part] = self.cells.of(_unit(self.raw[part]), table)
                home[part] = _codes(point)
        have[new] = True
        return home, near

    def settle(self, i: np.ndarray, j: np.ndarray, g: np.ndarray) -> None:
        """Count the links among candidates, each pair of vectors once: in the
        first table where it meets, and there in the smaller of two cells."""
        keep = g >= self.least + self.margin
        at = np.flatnonzero(~keep)
        p, q = self.raw[i[at]].astype(np.float64), self.raw[j[at]].astype(np.float64)
        keep[at] = (p * q).sum(axis=1) / (np.sqrt((p * p).sum(axis=1)) * np.sqrt((q * q).sum(axis=1))) >= self.least
        step = self.home[j] - self.home[i]
        at = np.flatnonzero(keep & (step != 0) & (self.home[i] > self.home[j]))
        keep[at] = ~self._probes(self.near[i[at]], step[at])
        i, j = i[keep], j[keep]
        for t in range(self.table):
            if not len(i):
                return
            home, near = self._cells(t, np.concatenate([i, j]))
            step = home[j] - home[i]
            left = np.flatnonzero(step)
            left = left[~self._probes(near[i[left]], step[left])]
            left = left[~self._probes(near[j[left]], -step[left])]
            i, j = i[left], j[left]
        self.others += np.bincount(i, self.n[j], len(self.n)) + np.bincount(j, self.n[i], len(self.n))
        while len(i):
            a, b = self.up[i], self.up[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.up, np.maximum(a, b), np.minimum(a, b))
            while (self.up[self.up] != self.up).any():
                self.up = self.up[self.up]

    def links(self, together: int = 200_000) -> pa.RecordBatch:
        """(node, other, n): how many vectors a node has links with, and edges that join what links join."""
        held, size = [], 0
        for found in self.candidates():
            held.append(found)
            size += len(found[0])
            if size >= together:
                self.settle(*map(np.concatenate, zip(*held)))
                held, size = [], 0
        if held:
            self.settle(*map(np.concatenate, zip(*held)))
        linked, below = np.flatnonzero(self.others), np.flatnonzero(self.up != np.arange(len(self.up)))
        none = lambda n: pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([self.node[linked], self.node[below]])),
            pa.concat_arrays([none(len(linked)), pa.array(self.node[self.up[below]])]),
            pa.concat_arrays([pa.array(np.rint(self.others[linked]).astype(np.int64)), none(len(below))])], names=["node", "other", "n"])


def _meet(cells: Cells, least: float):
    """Records of regions, ordered by region -> counts and edges of the links found there."""

    def run(batches):
        now, held = None, {}

        def done():
            for dim in list(held):
                yield Region(cells, now >> 32, dim, least, held.pop(dim)).links()

        for batch in batches:
            for key, dim, width, records in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("key", "dim", "width", "records"))):
                if key != now:
                    yield from done()
                    now = key
                held.setdefault(dim, []).append((width, records))
        yield from done()

    return run


def _links(classes: DataFrame, cells: Cells, least: float, region_bytes: int, round_bytes: int, sample_bytes: int = 4 << 20) -> list[DataFrame]:
    """Written tables (node, other, n) of all tables' regions.

    Round by round, as many regions as ``round_bytes`` of records and 2.5 times
    the classes' own bytes allow: shuffled records go with their round."""
    total = classes.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("x") + 38 + cells.probes).alias("size")).first()
    if not total.n:
        return []
    regions = {t: Regions(np.zeros((0, cells.probes + 1, 8), np.int16), 1) for t in range(cells.tables)}
    if total.size > region_bytes:
        # Regions are laid by a sample: it shapes the deal, not the result.
        every = -(-total.size // sample_bytes)
        some = classes.filter(F.expr(f"pmod(node, {every}) = 0")).select("dim", "x").collect()
        most = region_bytes / total.size * len(some)
        for t in regions if some else ():
            seen = []
            for kind in {(r.dim, len(r.x)) for r in some}:
                x = np.frombuffer(b"".join(r.x for r in some if (r.dim, len(r.x)) == kind), f"<f{kind[1] // kind[0]}").reshape(-1, kind[0])
                seen.append(cells.points(*cells.of(_unit(x), t)))
            regions[t] = Regions(np.concatenate(seen), most)
    rounds, room = [], round_bytes + 2.5 * total.size
    for t, r in regions.items():
        sizes = {k: v * total.size for k, v in r.share.items()} if r.depth else {0: total.size}
        whole = sum(sizes.values())
        for k, (region, size) in enumerate(sizes.items()):
            # A table's cells are found once a round, so what fits into one stays together.
            if not rounds or rounds[-1][1] + (size if k or whole > room else whole) > room:
                rounds.append([{}, 0])
            rounds[-1][0].setdefault(t, []).append(region)
            rounds[-1][1] += size
    out = []
    for wanted, size in rounds:
        keys = sum(map(len, wanted.values()))
        dealt = classes.select("node", "n", "dim", "x").mapInArrow(
            _deal(cells, {t: regions[t] for t in wanted}, wanted), "key long, dim long, width long, records binary")
        dealt = dealt.repartition(min(2 * keys, 1 + int(size) // (1 << 20)), "key").sortWithinPartitions("key")
        out.append(written(dealt.mapInArrow(_meet(cells, least), "node long, other long, n long"), "vector-links"))
    return out


def near_vectors(vectors: DataFrame, least: float = 0.95, tables: int = 12, probes: int = 12, scale: float = 1.1,
                 seed: int = 9, vec_id: str = "vec_id", embedding: str = "embedding",
                 region_bytes: int = 32 << 20, round_bytes: int = 64 << 20) -> DataFrame:
    """(vec_id, embedding) -> one row per vector: vec_id, n_links, component_id, kept.

    Equal vectors form one class, so copies are never expanded into pairs;
    two classes of equal length are linked if some table brings them into one
    cell and their cosine in double precision is at least ``least``. With the
    given settings a pair at the limit is missed with probability below 1e-3,
    a closer one far more rarely. Vectors that are null, zero or hold null or
    non-finite components link with nothing and are their own component;
    vectors of different lengths never link. A repeated vec_id with other
    numbers is another vector; null ids are never the smallest id. The
    embedding column's type is any array of numbers.

    Candidates are never written: a class goes once to each region of cells
    (about ``region_bytes`` of classes) that one of its cells is in, and a
    region multiplies the vectors of a cell with those that probe it. A region
    gives sums and joining edges, not pairs. Numbers travel in 32 bits where
    these hold them exactly.
    """
    v = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("x"))

    def look(batches):
        import xxhash
        for batch in batches:
            nodes, dims, raw = [], [], []
            for x in batch.column(1):
                row = a = None
                if x.is_valid:
                    a = x.values.to_numpy(zero_copy_only=False) + 0.0
                    if len(a) and np.isfinite(a).all() and a.any():
                        a = a / np.abs(a).max() if np.abs(a).max() > 1e100 or np.abs(a).max() < 1e-100 else a
                        row = a.tobytes()
                nodes.append(None if row is None else xxhash.xxh3_64_intdigest(row) - (1 << 63))
                dims.append(None if row is None else len(a))
                if row is not None:
                    with np.errstate(over="ignore"):
                        short = a.astype("<f4")
                    row = short.tobytes() if (short == a).all() else row
                raw.append(row)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.int64()), pa.array(dims, pa.int32()), pa.array(raw, pa.binary())],
                                             names=["vec_id", "node", "dim", "x"])

    whole = written(v.mapInArrow(look, "vec_id long, node long, dim int, x binary"), "vectors")
    classes = written(whole.filter("node is not null").groupBy("node").agg(
        F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("n"), F.first("dim").alias("dim"), F.first("x").alias("x")), "vector-classes")
    rows = written(whole.select("vec_id", "node"), "vector-nodes")
    remove(whole)
    with arrow_batches(vectors.sparkSession):
        found = _links(classes, Cells(tables, probes, scale, seed), least, region_bytes, round_bytes)
    if found:
        found = reduce(DataFrame.union, found)
    else:
        found = classes.select("node", F.lit(None).cast("long").alias("other"), "n").limit(0)
    linked = found.filter("n is not null").groupBy("node").agg(F.sum("n").alias("others"))
    component = connected_components(found.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    info = classes.select("node", "low", "n").join(linked, "node", "left").join(component, "node", "left")
    info = info.withColumn("component", F.coalesce("component", "node"))
    smallest = info.groupBy("component").agg(F.min("low").alias("component_id"))
    info = info.join(smallest, "component").select("node", "component_id", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    alone = rows.filter("node is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = rows.filter("node is not null").select("vec_id", "node").join(info, "node").select("vec_id", "n_links", "component_id").union(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op9(spark, sf_dir) -> DataFrame:
    from ..tables import read_table
    return near_vectors(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
