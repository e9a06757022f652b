"""Exact near-duplicate vectors by dual traversal of cover trees.

On unit vectors, cosine >= t is distance <= sqrt(2 - 2 t), a metric. Equal vectors are one point with a
weight. Points go to the nearest of a few sampled centres, and each such cell is cut into blocks of
bounded size; a block becomes a cover tree with nested levels of halving radii, built in one task.
Pairs of blocks are dropped by the covering radii of their cells. For every other pair one task walks
both trees together: a node pair is dropped if its centres are further apart than both covering radii
and the threshold, taken whole if even its furthest points are near enough, and opened otherwise; at
the leaves the cosine decides, in double precision. Tasks return a number of links for each point and a
spanning forest, never the pairs.

Vectors without structure (all distances alike) cannot be pruned by any covering radius: then all block
pairs are compared, as matrix products, and the work grows with the square of the number of distinct
vectors, as an exact join must here.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with
nothing; vectors of different length do not link; null ids are ignored when the smallest id of a class
is sought (a class of null ids alone has a null id and is not kept).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import store
from parcelflow.llm.components import components, merge_links

THRESHOLD = 0.95
#: Points of a block at least and at most; between them a twelfth of all, so that tasks stay even.
BLOCK, LARGEST_BLOCK, BLOCKS = 4096, 65_536, 12
#: Components of a block at most, whatever the number of its points; a task holds two blocks.
COMPONENTS = 1 << 23
#: Sampled centres at most; they are sent to all tasks (some MB).
CENTRES = 4096
#: Covering radii of the nested levels below the root. A wider first level prunes nothing that its actual radii do not:
#: two nodes of radius 1 are never far enough apart, and on vectors without structure most of its node pairs are opened one by one.
RADII = (0.5, 0.25, 0.125)
#: Slack of bounds against rounding; within it the cosine itself decides.
SLACK = 1e-4
_PAIRS = 1 << 17
#: Nodes on either side of a product of the first level.
TILE = 2048


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 (by their largest component first, so nothing overflows)."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def net(u: np.ndarray, radius: float) -> np.ndarray:
    """For each row its centre: rows further than ``radius`` from all earlier centres are centres themselves.

    In single precision: any net will do, as covering radii are measured afterwards.
    """
    u, least = u.astype(np.float32), np.float32(1 - radius * radius / 2)
    centre = np.empty(len(u), np.int64)
    centres, vectors = np.empty(len(u), np.int64), np.empty_like(u)
    known = 0
    for start in range(0, len(u), 256):
        part = np.arange(start, min(start + 256, len(u)))
        at = np.full(len(part), -1)
        if known:
            cosine = u[part] @ vectors[:known].T
            k = cosine.argmax(axis=1)
            at = np.where(cosine[np.arange(len(part)), k] >= least, centres[k], -1)
        inner = u[part] @ u[part].T
        new: list[int] = []
        for i in np.flatnonzero(at < 0).tolist():
            near = inner[i, new] if new else ()
            k = int(np.argmax(near)) if new else -1
            if new and near[k] >= least:
                at[i] = part[new[k]]
            else:
                new.append(i)
                at[i] = part[i]
        centre[part] = at
        centres[known : known + len(new)], vectors[known : known + len(new)] = part[new], u[part[new]]
        known += len(new)
    return centre


def build(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tree order of rows and, per level, the number of each row's node (numbers ascend in that order)."""
    node = np.zeros(len(u), np.int64)
    levels = []
    for radius in RADII:
        inner = np.empty(len(u), np.int64)
        for members in np.split(np.argsort(node, kind="stable"), np.flatnonzero(np.diff(np.sort(node))) + 1):
            inner[members] = members[net(u[members], radius)] if len(members) > 1 else members
        _, node = np.unique(np.stack([node, inner]), axis=1, return_inverse=True)
        node = node.reshape(-1)
        levels.append(node)
    order = np.lexsort([np.arange(len(u)), *reversed(levels)])
    return order, np.stack(levels)[:, order]


class Tree:
    """A block in tree order: per level the start and end of each node, its first row as centre, its covering radius."""

    def __init__(self, u: np.ndarray, weight: np.ndarray, levels: np.ndarray):
        self.u, self.weight = u, weight
        self.sums = np.concatenate([[0], np.cumsum(weight)])
        self.starts, self.ends, self.radii = [], [], []
        for row in levels:
            start = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            end = np.append(start[1:], len(row))
            centre = np.repeat(start, end - start)
            d = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", u, u[centre])))
            d[start] = 0
            self.starts.append(start)
            self.ends.append(end)
            self.radii.append(np.maximum.reduceat(d, start))

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-last node of the next level inside each node."""
        return (
            np.searchsorted(self.starts[level + 1], self.starts[level][nodes]),
            np.searchsorted(self.starts[level + 1], self.ends[level][nodes]),
        )


def _cross(al, ah, bl, bh):
    n, wide = (ah - al) * (bh - bl), bh - bl
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    w = np.repeat(wide, n)
    return np.repeat(al, n) + at // w, np.repeat(bl, n) + at % w


class Walk:
    """Counts links and joins linked points of two trees (or of one with itself)."""

    def __init__(self, a: Tree, b: Tree | None, threshold: float):
        self.a, self.b, self.same, self.threshold = a, a if b is None else b, b is None, threshold
        self.reach = float(np.sqrt(2 - 2 * threshold))
        self.shift = 0 if self.same else len(a.u)
        self.links = np.zeros(self.shift + len(self.b.u), np.int64)
        self.parent = np.arange(len(self.links))

    def run(self) -> None:
        """Node pairs of the first level by matrix products in single precision, with slack for its rounding.

        Lone points, which are nearly all nodes where vectors have no structure, come first: among them the bound is one number.
        """
        a, b = self.a, self.b
        slack = SLACK + (a.u.shape[1] + 8) * 2.0**-23
        nodes, vectors, lone = [], [], []
        for t in (a, b):
            wide = t.radii[0] > 0
            order = np.concatenate([np.flatnonzero(~wide), np.flatnonzero(wide)])
            nodes.append(order)
            vectors.append(t.u[t.starts[0][order]].astype(np.float32))
            lone.append(int((~wide).sum()))
        for rows, columns in self._tiles(lone, [len(n) for n in nodes]):
            x, y = nodes[0][rows], nodes[1][columns]
            cosine = vectors[0][rows] @ vectors[1][columns].T
            if rows.start < lone[0] and columns.start < lone[1]:
                bound = np.float32(1 - (self.reach + SLACK) ** 2 / 2 - slack)
            else:
                far = (a.radii[0][x] + np.float32(self.reach + SLACK)).astype(np.float32)[:, None] + b.radii[0][y].astype(np.float32)
                bound = 1 - np.minimum(far, 2) ** 2 / 2 - np.float32(slack)
            i, j = np.divmod(np.flatnonzero(cosine >= bound), len(y))
            if self.same and rows == columns:
                i, j = i[i <= j], j[i <= j]
            i, j = x[i], y[j]
            if self.same:
                i, j = np.minimum(i, j), np.maximum(i, j)
            if len(i):
                self._nodes(0, i, j)

    def _tiles(self, lone: list[int], total: list[int]):
        """Rows and columns of the products: parts of the lone or of the wide nodes. Of a tree with itself each node pair once."""
        parts = [
            [slice(s, min(s + TILE, end)) for low, end in ((0, n), (n, of)) for s in range(low, end, TILE)]
            for n, of in zip(lone, total, strict=True)
        ]
        for k, rows in enumerate(parts[0]):
            for columns in parts[1][k if self.same else 0 :]:
                yield rows, columns

    def _nodes(self, level: int, i: np.ndarray, j: np.ndarray) -> None:
        if len(i) > _PAIRS:
            for s in range(0, len(i), _PAIRS):
                self._nodes(level, i[s : s + _PAIRS], j[s : s + _PAIRS])
            return
        a, b = self.a, self.b
        cosine = np.einsum("ij,ij->i", a.u[a.starts[level][i]], b.u[b.starts[level][j]])
        d = np.sqrt(np.maximum(0, 2 - 2 * cosine))
        radii = a.radii[level][i] + b.radii[level][j]
        twin = (i == j) if self.same else np.zeros(len(i), bool)
        lone = twin & (a.ends[level][i] - a.starts[level][i] == 1)
        near = (d - radii <= self.reach + SLACK) & ~lone
        whole = near & (d + radii <= self.reach - SLACK)
        for x, y in zip(i[whole].tolist(), j[whole].tolist(), strict=True):
            self._whole(level, x, y)
        i, j, twin = (x[near & ~whole] for x in (i, j, twin))
        if not len(i):
            return
        if level + 1 == len(RADII):
            self._points(a.starts[level][i], a.ends[level][i], b.starts[level][j], b.ends[level][j], twin)
            return
        (al, ah), (bl, bh) = a.children(level, i), b.children(level, j)
        k = np.arange(len(i))
        for part in np.array_split(k, len(k) // 4096 + 1):
            x, y = _cross(al[part], ah[part], bl[part], bh[part])
            if self.same:
                keep = ~np.repeat(twin[part], ((ah - al) * (bh - bl))[part]) | (x <= y)
                x, y = x[keep], y[keep]
            self._nodes(level + 1, x, y)

    def _whole(self, level: int, x: int, y: int) -> None:
        a, b = self.a, self.b
        p, q, r, s = a.starts[level][x], a.ends[level][x], b.starts[level][y], b.ends[level][y]
        self.links[p:q] += b.sums[s] - b.sums[r]
        if self.same and x == y:
            self.links[p:q] -= a.weight[p:q]
        else:
            self.links[self.shift + r : self.shift + s] += a.sums[q] - a.sums[p]
        members = np.concatenate([np.arange(p, q), self.shift + np.arange(r, s)])
        self.parent = merge_links(self.parent, members, np.full(len(members), members[0]))

    def _points(self, al, ah, bl, bh, twin) -> None:
        """Compares the points of leaf nodes: many small pairs at once, large ones as a matrix product."""
        large = (ah - al) * (bh - bl) > 1024
        for p, q, r, s, t in zip(*(x[large].tolist() for x in (al, ah, bl, bh, twin)), strict=True):
            for m in range(p, q, 1024):
                self._product(m, min(m + 1024, q), r, s, t)
        al, ah, bl, bh, twin = (x[~large] for x in (al, ah, bl, bh, twin))
        for part in np.array_split(np.arange(len(al)), int(((ah - al) * (bh - bl)).sum()) // _PAIRS + 1):
            i, j = _cross(al[part], ah[part], bl[part], bh[part])
            if self.same:
                keep = ~np.repeat(twin[part], ((ah - al) * (bh - bl))[part]) | (i < j)
                i, j = i[keep], j[keep]
            if len(i):
                linked = np.einsum("ij,ij->i", self.a.u[i], self.b.u[j]) >= self.threshold
                self._link(i[linked], j[linked])

    def _product(self, p: int, q: int, r: int, s: int, twin: bool) -> None:
        linked = self.a.u[p:q] @ self.b.u[r:s].T >= self.threshold
        if twin:  # each unordered pair of a node with itself once
            linked &= np.arange(p, q)[:, None] < np.arange(r, s)[None, :]
        i, j = np.nonzero(linked)
        self._link(i + p, j + r)

    def _link(self, i: np.ndarray, j: np.ndarray) -> None:
        if len(i):
            np.add.at(self.links, i, self.b.weight[j])
            np.add.at(self.links, j + self.shift, self.a.weight[i])
            self.parent = merge_links(self.parent, i, j + self.shift)


def _vector_type(frame: DataFrame) -> str:
    return frame.schema["vector"].dataType.simpleString()


def _blocks(points: DataFrame) -> tuple[DataFrame, list[tuple[int, int]]]:
    """``points`` with a ``block``, and the pairs of blocks that can hold links."""
    total = points.count()
    sizes = [r[0] for r in points.select(F.size("vector")).distinct().collect()]
    largest = min(LARGEST_BLOCK, max(BLOCK, COMPONENTS // max(sizes, default=1)))
    size = min(largest, max(BLOCK, total // BLOCKS))
    wanted = min(CENTRES, total // size + 1)
    centres: dict[int, np.ndarray] = {}
    first: dict[int, int] = {}
    for dim in sorted(sizes):
        rows = points.where(F.size("vector") == dim).orderBy(F.xxhash64("point"), "point").limit(wanted).collect()
        first[dim] = sum(map(len, centres.values()))
        centres[dim] = unit(np.array([r["vector"] for r in rows], float))

    def assign(batches):
        for batch in batches:
            dims = np.diff(batch.column("vector").offsets.to_numpy())
            cell, far = np.empty(len(dims), np.int64), np.empty(len(dims))
            for dim in np.unique(dims).tolist():
                on = np.flatnonzero(dims == dim)
                d = _distances(unit(_matrix(batch.column("vector").take(pa.array(on)))), centres[dim])
                k = d.argmin(axis=1)
                cell[on], far[on] = first[dim] + k, d[np.arange(len(on)), k]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], [*names, "cell", "far"])

    names = ["point", "weight", "vector"]
    dealt = points.select(*names).mapInArrow(
        assign, f"point long, weight long, vector {_vector_type(points)}, cell long, far double"
    )
    dealt = store(dealt, "cells")
    cells = dealt.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).orderBy("cell").collect()
    parts, number, block_of = {}, 0, []
    for r in cells:
        parts[r["cell"]] = (number, r["n"] // size + 1)
        block_of += [r["cell"]] * parts[r["cell"]][1]
        number += parts[r["cell"]][1]
    radius = {r["cell"]: r["far"] for r in cells}
    reach = float(np.sqrt(2 - 2 * THRESHOLD))
    dim_of = {first[d] + k: d for d in centres for k in range(len(centres[d]))}
    far = {}
    for dim, c in centres.items():
        d = _distances(c, c)
        for x in (k for k in parts if dim_of[k] == dim):
            for y in (k for k in parts if dim_of[k] == dim and k >= x):
                far[x, y] = d[x - first[dim], y - first[dim]] > radius[x] + radius[y] + reach + SLACK and x != y
    pairs = [
        (p, q) for p in range(number) for q in range(p, number) if not far.get((block_of[p], block_of[q]), True)
    ]
    places = points.sparkSession.createDataFrame(
        [(k, start, n) for k, (start, n) in parts.items()], "cell long, start long, parts long"
    )
    placed = dealt.join(F.broadcast(places), "cell")  # CENTRES rows at most
    block = F.col("start") + F.pmod(F.xxhash64("point"), F.col("parts"))
    return placed.select(*names, block.alias("block")), pairs


def links(points: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(a, b, n)`` for ``points(point, weight, vector)``: partial numbers of links of ``a`` (``b`` null) and forest edges."""
    blocked, pairs = _blocks(points)
    kind = _vector_type(points)
    levels = [f"level{i}" for i in range(len(RADII))]

    def plant(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        order, nodes = build(unit(_matrix(rows.column("vector"))))
        out = rows.take(pa.array(order)).append_column("position", pa.array(np.arange(len(order))))
        for name, row in zip(levels, nodes, strict=True):
            out = out.append_column(name, pa.array(row.astype(np.int32)))
        return out

    fields = f"point long, weight long, vector {kind}, block long, position long, " + ", ".join(f"{n} int" for n in levels)
    trees = store(blocked.groupBy("block").applyInArrow(plant, fields), "trees")
    tasks: dict[int, list[tuple[int, bool]]] = {}
    for k, (p, q) in enumerate(pairs):
        tasks.setdefault(p, []).append((k, False))
        if p != q:
            tasks.setdefault(q, []).append((k, True))
    alone = [p == q for p, q in pairs]

    def deal(batches):
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            for block in np.unique(blocks).tolist():
                own = batch.filter(pa.array(blocks == block))
                for k, second in tasks[block]:
                    n = own.num_rows
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, k)), pa.array(np.full(n, second)), *own.columns],
                        ["pair", "second", *own.schema.names],
                    )

    def walk(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by([("second", "ascending"), ("position", "ascending")])
        second = rows.column("second").to_numpy(zero_copy_only=False)
        halves = [rows.filter(pa.array(second == s)) for s in (False, True)]
        made = [
            Tree(
                unit(_matrix(h.column("vector"))),
                h.column("weight").to_numpy(),
                np.stack([h.column(n).to_numpy() for n in levels]),
            )
            if h.num_rows
            else None
            for h in halves
        ]
        same = alone[rows.column("pair")[0].as_py()]
        task = Walk(made[0], None if same else made[1], threshold)
        task.run()
        point = rows.column("point").to_numpy()
        counted, child = np.flatnonzero(task.links), np.flatnonzero(task.parent != np.arange(len(task.parent)))
        nothing = [None] * len(counted)
        return pa.table(
            {
                "a": pa.array(np.concatenate([point[counted], point[child]])),
                "b": pa.array([*nothing, *point[task.parent[child]].tolist()], pa.int64()),
                "n": pa.array([*task.links[counted].tolist(), *[None] * len(child)], pa.int64()),
            }
        )

    dealt = trees.mapInArrow(deal, f"pair long, second boolean, {fields}")
    return dealt.groupBy("pair").applyInArrow(walk, "a long, b long, n long")


def usable(vector) -> F.Column:
    """True for vectors that can link: not null, not empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def vector_classes(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row of ``embeddings(vec_id, embedding)``."""
    rows = embeddings.select("vec_id", F.col("embedding").alias("vector")).withColumn("usable", usable(F.col("vector")))
    good = rows.where("usable").select("vec_id", "vector")
    points = store(
        good.groupBy("vector")
        .agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
        .withColumn("point", F.monotonically_increasing_id()),
        "points",
    )
    found = store(links(points, threshold), "links")
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "point")
    joined = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "point")
    rooted = store(
        points.join(joined, "point", "left")
        .join(counts, "point", "left")
        .select(
            "vector",
            "least",
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("root", "point").alias("root"),
        ),
        "rooted",
    )
    ids = store(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    classes = store(rooted.join(ids, "root").select("vector", "n_links", "component_id"), "classes")
    linked = good.join(classes, "vector").select("vec_id", "n_links", "component_id")
    single = rows.where(~F.col("usable")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    out = linked.union(single)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
