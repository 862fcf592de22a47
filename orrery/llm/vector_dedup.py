"""Near-duplicate vectors: cells of spherical k-means, blocked cosine products within cells.

Equal vectors become one node with its number of rows. Centroids come from a bounded sample
of the nodes (``sample_each`` for each of at most ``max_cells`` cells); every node goes to the
cell of its nearest centroid, its home, and also, as a guest, to each cell whose border is so
near that a link can cross it. For a node v of home a and a cell c no link crosses unless
v.a - v.c <= |a - c| * sin(angle of the threshold); a link changes the difference in one direction
only as far as chance brings it there, so in d dimensions ``reach`` standard deviations of
that, |a - c| * sin * reach / sqrt(d - 1), are taken. ``reach`` = inf is exact for any data.
A link is missed only if neither end is a guest of the other's home: at exactly the
threshold about one in a thousand where links point anywhere, fewer above it (measured
in the tests).

Nodes within half the threshold's angle of their centroid are its core. They are all
linked with one another by the triangle inequality, so a group of close copies, however
large, costs one sum instead of its square. All other pairs of a cell (home nodes outside
the core and guests, against home nodes) are compared in blocks of bounded size, one task
each; tasks give the number of links per node and the connected nodes, never pairs.
Every pair is counted in one cell only. Cosines are double products of unit vectors; those
within 1e-9 of the threshold are decided by the exactly rounded cosine.

A representative per component, the smallest id reachable, is kept.

Vectors that are null, zero or hold null or non-finite components link with nothing and are
kept, as is an empty one. Shorter vectors are padded with zeros. Repeated rows are copies: each has
its row and links with the others. Ids may repeat, and a row is kept if its id is its component's. Null ids
link like others; a component id is null only where all its ids are. Ties need no rule, as all
links count. An empty table gives no rows. Only the id and the vector column are read, so
other columns may have any names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import connected
from .tables import written
from .vectors import matrix, usable

_CHUNK = 512
_TIE = 1e-9


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two, so that their squares neither overflow nor vanish."""
    _, exponent = np.frexp(np.abs(x).max(axis=1))
    return np.ldexp(x.astype(np.float64), -exponent[:, None])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def exact_cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of pairs of rows, rounded once to double."""
    x, y = scaled(x).astype(np.longdouble), scaled(y).astype(np.longdouble)
    return ((x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1))).astype(np.float64)


def spherical_kmeans(x: np.ndarray, k: int, apart: float, rounds: int = 8) -> np.ndarray:
    """Unit centroids of the unit rows ``x``, none with a cosine of ``apart`` or more to another."""
    centre = x[:k]
    for r in range(rounds + 1):
        own = np.concatenate([(x[a:a + 4096] @ centre.T).argmax(1) for a in range(0, len(x), 4096)])
        if r == rounds:
            break
        total = np.zeros_like(centre)
        np.add.at(total, own, x)
        size = np.sqrt((total ** 2).sum(1))
        centre = np.where(size[:, None] > 1e-12, total / np.maximum(size, 1e-300)[:, None], centre)
    kept: list[int] = []
    for c in np.argsort(-np.bincount(own, minlength=len(centre)), kind="stable"):
        if not kept or (centre[kept] @ centre[c]).max() < apart:
            kept.append(int(c))
    return centre[kept]


def components_of(link: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Component numbers of the rows and of the columns of a table of links; -1 without a link."""
    left, right = np.full(link.shape[0], -1), np.full(link.shape[1], -1)
    for start in np.flatnonzero(link.any(axis=1)):
        if left[start] >= 0:
            continue
        fresh = np.array([start])
        left[start] = start
        while len(fresh):
            seen = np.flatnonzero(link[fresh].any(axis=0) & (right < 0))
            right[seen] = start
            fresh = np.flatnonzero(link[:, seen].any(axis=1) & (left < 0)) if len(seen) else seen
            left[fresh] = start
    return left, right


class VectorDuplicates:
    """``documents()``: one row per input row with its number of links, component and verdict."""

    def __init__(self, rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", cosine: float = 0.9,
                 cell_rows: int = 512, max_cells: int = 4096, sample_each: int = 32, reach: float = 1.75, block_rows: int = 4096):
        self.spark = rows.sparkSession
        self.cosine, self.cell_rows, self.max_cells, self.sample_each = cosine, cell_rows, max_cells, sample_each
        self.reach, self.block_rows = reach, block_rows
        kind = rows.select(F.col(f"`{vector}`").alias("v")).schema["v"].dataType
        single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
        self.type, self.dtype = ("array<float>", "<f4") if single else ("array<double>", "<f8")
        taken = rows.select(F.col(f"`{id_column}`").alias("vec_id"), F.col(f"`{vector}`").cast(self.type).alias("v"))
        self.rows = taken.withColumn("v", F.when(usable(F.col("v")) & F.exists("v", lambda x: x != 0), F.col("v")))

    def documents(self) -> DataFrame:
        """vec_id, n_links, component_id, kept."""
        whole = self.rows.filter(F.col("v").isNotNull())
        alone = self.rows.filter(F.col("v").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        nodes = written(whole.groupBy("v").agg(F.count("*").alias("mult"), F.min("vec_id").alias("least"))
                        .withColumn("node", F.monotonically_increasing_id()), "vectors")
        sums = nodes.agg(F.count("*").alias("n"), F.sum("mult").alias("rows"), F.max(F.size("v")).alias("dims")).first()
        found = alone
        if sums["n"]:
            solved = written(self._solved(nodes, sums["n"], sums["dims"]), "vector-links")
            # a vector that holds over a thousandth of all rows is one of fewer than a thousand
            hot = F.col("mult") * 1000 > sums["rows"]
            for part in (solved.filter(~hot), F.broadcast(solved.filter(hot))):
                found = found.unionAll(whole.join(part, "v").select("vec_id", "n_links", "component_id"))
        return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

    def _centroids(self, nodes: DataFrame, n: int, dims: int) -> np.ndarray:
        cells = max(1, min(self.max_cells, n // self.cell_rows))
        share = min(1.0, cells * self.sample_each / n)
        order = F.xxhash64("v", F.lit(1))
        drawn = nodes.select("v").filter(F.pmod(order, F.lit(1 << 30)) < int(share * (1 << 30)) + 1).orderBy(order, "v").toArrow()
        if not len(drawn):
            drawn = nodes.select("v").limit(1).toArrow()
        x = unit(matrix(drawn["v"], dims))
        return spherical_kmeans(x, min(cells, len(x)), math.cos(math.acos(self.cosine) * 0.8))

    def _solved(self, nodes: DataFrame, n: int, dims: int) -> DataFrame:
        """v, mult, n_links, component_id of every node."""
        centre, theta, dtype, cosine = self._centroids(nodes, n, dims), math.acos(self.cosine), self.dtype, self.cosine
        share = math.sin(theta) * min(1.0, self.reach / math.sqrt(max(dims - 1, 1)))
        core_from = math.cos(theta / 2 - 1e-6)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, b.num_rows, _CHUNK):
                    part = b.slice(at, _CHUNK)
                    x = matrix(part["v"], dims)
                    dots = unit(x) @ centre.T
                    home = dots.argmax(1)
                    best = dots[np.arange(len(x)), home]
                    border = np.sqrt(np.maximum(2 - 2 * (centre[home] @ centre.T), 0)) * share + 1e-9
                    near = best[:, None] - dots <= border
                    near[np.arange(len(x)), home] = False
                    of, cell = np.nonzero(near)
                    first = np.searchsorted(of, np.arange(len(x) + 1))
                    guests = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(cell, pa.int32()))
                    raw = pa.array([r.tobytes() for r in x.astype(dtype)], pa.binary())
                    yield pa.RecordBatch.from_arrays([part["node"], part["mult"], part["least"], raw, pa.array(home, pa.int32()),
                                                      pa.array(best >= core_from), guests],
                                                     ["node", "mult", "least", "x", "home", "core", "near"])

        least = nodes.schema["least"].dataType.simpleString()
        placed = written(nodes.mapInArrow(place, f"node long, mult long, least {least}, x binary, home int, core boolean, near array<int>"), "vector-cells")
        cores = placed.filter("core").groupBy("home").agg(F.min("node").alias("rep"), F.sum("mult").alias("inside"))
        reps = np.full(len(centre), -1)
        for r in cores.collect():  # at most one row a cell, as below
            reps[r["home"]] = r["rep"]
        homes, guests = np.zeros(len(centre), np.int64), np.zeros(len(centre), np.int64)
        for r in placed.groupBy("home").agg(F.count("*").alias("n"), F.count_if(~F.col("core")).alias("loose")).collect():
            homes[r["home"]], guests[r["home"]] = r["n"], r["loose"]
        for r in placed.select(F.explode("near").alias("cell")).groupBy("cell").count().collect():
            guests[r["cell"]] += r["count"]
        rights, lefts = -(-homes // self.block_rows), -(-guests // self.block_rows)
        rights[guests == 0] = 0

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """A copy of each node for every pair of blocks it takes part in; role 1: left, 2: right, 3: both."""
            def spread(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                of = np.repeat(np.arange(len(count)), count)
                return of, np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)

            for b in batches:
                node, home = b["node"].to_numpy(), b["home"].to_numpy()
                loose = ~b["core"].to_numpy(zero_copy_only=False)
                mixed = node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                draw = (mixed >> np.uint64(33)).astype(np.int64)
                near = b["near"]
                guest_of = np.repeat(np.arange(len(node)), near.value_lengths().to_numpy(zero_copy_only=False))
                who = np.concatenate([np.flatnonzero(loose), guest_of])
                cell = np.concatenate([home[loose], near.flatten().to_numpy().astype(home.dtype)])
                of, right = spread(rights[cell])
                l_who, l_cell = who[of], cell[of]
                left = draw[l_who] % np.maximum(lefts[l_cell], 1)
                own = draw % np.maximum(rights[home], 1)
                both = (l_cell == home[l_who]) & (right == own[l_who])
                r_who, r_left = spread(np.where(rights[home] > 0, lefts[home], 0))
                once = ~(loose[r_who] & (r_left == draw[r_who] % np.maximum(lefts[home[r_who]], 1)))
                r_who, r_left = r_who[once], r_left[once]
                take = pa.array(np.concatenate([l_who, r_who]))
                keys = [np.concatenate([l_cell, home[r_who]]), np.concatenate([left, r_left]), np.concatenate([right, own[r_who]]),
                        np.concatenate([np.where(both, 3, 1), np.full(len(r_who), 2)])]
                for at in range(0, len(take), 4096):
                    part = take.slice(at, 4096)
                    yield pa.RecordBatch.from_arrays([pa.array(k[at:at + 4096].astype(np.int32)) for k in keys]
                                                     + [b[c].take(part) for c in ("node", "mult", "x", "home", "core", "near")],
                                                     ["cell", "i", "j", "role", "node", "mult", "x", "home", "core", "near"])

        def solve(group: pa.Table) -> pa.Table:
            g = group.combine_chunks().to_batches()[0]
            cell, role = g["cell"][0].as_py(), g["role"].to_numpy()
            left, right = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
            out = {"node": [], "n": [], "member": [], "root": []}
            if len(left) and len(right):
                node, mult, home = g["node"].to_numpy(), g["mult"].to_numpy().astype(np.float64), g["home"].to_numpy()
                core = g["core"].to_numpy(zero_copy_only=False)
                x = np.frombuffer(b"".join(g["x"].to_pylist()), dtype).reshape(len(node), dims)
                u = unit(x)
                # of a pair with homes c < q the cell c counts it, if q's node is its guest; otherwise q does
                lower = np.unique(home[left][home[left] < cell])
                place_of = np.searchsorted(lower, np.arange(cell + 1))
                visits = np.zeros((len(lower) + 1, len(node)), bool)
                if len(lower):
                    sizes = g["near"].value_lengths().to_numpy(zero_copy_only=False)
                    who, cells = np.repeat(np.arange(len(node)), sizes), g["near"].flatten().to_numpy()
                    known = np.isin(cells, lower)
                    visits[np.searchsorted(lower, cells[known]), who[known]] = True
                visits = visits[:, right]
                link = np.zeros((len(left), len(right)), bool)
                for at in range(0, len(left), _CHUNK):
                    own = left[at:at + _CHUNK]
                    c = u[own] @ u[right].T
                    hit = c >= cosine
                    tie = np.abs(c - cosine) < _TIE
                    if tie.any():
                        a, b = np.nonzero(tie)
                        for s in range(0, len(a), 65536):
                            hit[a[s:s + 65536], b[s:s + 65536]] = exact_cosines(x[own[a[s:s + 65536]]], x[right[b[s:s + 65536]]]) >= cosine
                    hit &= node[own][:, None] != node[right]
                    before = np.flatnonzero(home[own] < cell)
                    hit[before] &= ~visits[place_of[home[own][before]]]
                    link[at:at + _CHUNK] = hit
                counts = np.zeros(len(node))
                here = home[left] == cell
                for at in range(0, len(left), _CHUNK):
                    part, guest = link[at:at + _CHUNK].astype(np.float64), ~here[at:at + _CHUNK]
                    weight = mult[left[at:at + _CHUNK]]
                    counts[left[at:at + _CHUNK]] += part @ mult[right]
                    # home nodes outside the core are left to each other once in both orders
                    counts[right] += (weight * guest) @ part + ((weight * ~guest) @ part) * core[right]
                lc, rc = components_of(link)
                member = np.where(core, reps[home], node)
                label = np.full(len(node), -1)
                label[left] = lc
                # a node that is left and right may have two labels: both are of one component
                as_left = label[right]
                edges = np.unique(np.stack([as_left, rc])[:, (as_left >= 0) & (rc >= 0) & (as_left != rc)], axis=1).T
                label[right] = np.maximum(rc, as_left)
                parent: dict[int, int] = {}

                def find(k: int) -> int:
                    while parent.get(k, k) != k:
                        k = parent[k]
                    return k

                for a, b in edges:
                    a, b = find(int(a)), find(int(b))
                    parent[max(a, b)] = min(a, b)
                linked = np.flatnonzero(label >= 0)
                top = np.array([find(int(k)) for k in label[linked]], np.int64)
                least = np.full(len(left), np.iinfo(np.int64).max)
                np.minimum.at(least, top, member[linked])
                out = {"node": node[linked], "n": counts[linked].astype(np.int64), "member": member[linked], "root": least[top]}
            return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})

        dealt = placed.select("node", "mult", "x", "home", "core", "near").mapInArrow(
            deal, "cell int, i int, j int, role int, node long, mult long, x binary, home int, core boolean, near array<int>")
        links = written(dealt.groupBy("cell", "i", "j").applyInArrow(solve, "node long, n long, member long, root long"), "vector-links")
        roots = connected(links.filter("member <> root").select(F.col("member").alias("u"), F.col("root").alias("v")))

        # cores: one row a cell, at most max_cells; their nodes follow the representative
        counted = links.groupBy("node").agg(F.sum("n").alias("n"))
        each = (placed.select("node", "mult", "least", "home", "core").join(F.broadcast(cores), "home", "left").join(counted, "node", "left")
                .withColumn("member", F.when(F.col("core"), F.col("rep")).otherwise(F.col("node")))
                .withColumn("n_links", F.col("mult") - 1 + F.coalesce("n", F.lit(0)) + F.when(F.col("core"), F.col("inside") - F.col("mult")).otherwise(0)))
        each = written(each.select("node", "mult", "least", "member", "n_links"), "vector-nodes")
        least = each.groupBy("member").agg(F.min("least").alias("least"))
        least = least.join(roots.select(F.col("node").alias("member"), "root"), "member", "left").withColumn("root", F.coalesce("root", "member"))
        ids = least.groupBy("root").agg(F.min("least").alias("component_id"))
        # members of one component meet its single row; few are left, as cores count as one member
        ids = least.filter("root <> member").select("member", "root").join(ids, "root").select("member", "component_id").unionAll(
            ids.select(F.col("root").alias("member"), "component_id"))
        several = each.join(F.broadcast(cores.select(F.col("rep").alias("member")).join(ids, "member")), "member", "left")
        single = ids.withColumnRenamed("component_id", "own").withColumnRenamed("member", "node")
        out = several.join(single, "node", "left").select("node", "mult", "n_links", F.coalesce("component_id", "own").alias("component_id"))
        return nodes.select("node", "v").join(out, "node").select("v", "mult", "n_links", "component_id")
