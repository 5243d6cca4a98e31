"""Exact pairs of vectors above a cosine, by dual traversal of cover trees.

Vectors are scaled to length one, where a cosine is a distance.  They are dealt to the
nearest of a bounded number of pivots.  Cells near each other make groups of bounded size,
and each block of a cell in a group becomes a cover tree: nested levels whose radii halve.
Two cells, two tiles of nodes or two nodes are left out if their distance exceeds the
threshold by more than their covering radii, and taken as a whole if it stays below it by
as much; what is left goes down a level, to single vectors at last.

Groups are written once and read by the tasks that compare them, not shuffled: disk follows
the input, however many pairs of groups there are to compare.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.support import Scratch, components, configured

THRESHOLD = 0.9
#: Vectors of a block, and pivots at most; they are all vectors that the driver gets.
BLOCK, MAX_PIVOTS = 4096, 512
#: Blocks and bytes of a group at most.  A job compares so many groups with those after them
#: at most, and begins with no further one after so many pairs.
_GROUP_BLOCKS, _GROUP_BYTES = 4, 16_000_000
_JOB_GROUPS, _JOB_PAIRS = 32, 2048
#: Radii of the levels.  The traversal begins at the level of ``CUT``.
_RADII = (1.0, 0.5, 0.25, 0.125, 0.0625, 0.03125)
_CUT = 2
#: Nodes of a tile, tiles multiplied at once, and pairs of nodes that go down together.
_TILE, _TILES, _PAIRS = 512, 2, 65536
#: Nodes of at most this radius are compared by the first coordinates of a basis.
_NARROW = 1e-3
#: Bounds are only trusted beyond rounding errors.
_EPS = 1e-9


def unit(vectors: np.ndarray) -> np.ndarray:
    x = vectors.astype(np.float64)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def chord(cosine: np.ndarray | float) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * np.asarray(cosine), 0.0))


def _net(x: np.ndarray, points: np.ndarray, radius: float) -> list[np.ndarray]:
    """Points in groups, each within ``radius`` of its first point.

    No group's first point lies within the radius of an earlier one.
    """
    least = 1.0 - radius * radius / 2.0
    centres: list[int] = []
    owner = np.full(len(points), -1)
    for low in range(0, len(points), 512):
        part = x[points[low : low + 512]]
        of = owner[low : low + 512]
        if centres:
            near = part @ x[centres].T
            best = near.argmax(axis=1)
            inside = near[np.arange(len(part)), best] >= least
            of[inside] = best[inside]
        mutual = part @ part.T >= least
        for i in np.flatnonzero(of < 0).tolist():
            if of[i] < 0:
                of[mutual[i] & (of < 0)] = len(centres)
                of[i] = len(centres)
                centres.append(int(points[low + i]))
    order = np.argsort(owner, kind="stable")
    groups = np.split(points[order], np.cumsum(np.bincount(owner))[:-1])
    return [np.concatenate([[c], g[g != c]]) for c, g in zip(centres, groups, strict=True)]


class CoverTree:
    """Nested levels of nodes over the rows of ``vectors``.

    ``order`` lists the rows so that every node is a stretch ``lo`` to ``hi``, whose
    first row is its centre; ``radius`` is the largest distance from it.  ``child`` and
    the next entry delimit a node's children in the next level.
    """

    def __init__(self, vectors: np.ndarray) -> None:
        x = unit(vectors)
        level = [np.arange(len(x))]
        members: list[list[np.ndarray]] = []
        self.child: list[np.ndarray] = []
        for radius in _RADII:
            parts, counts = [], []
            for points in level:
                split = [points] if len(points) == 1 else _net(x, points, radius)
                parts += split
                counts.append(len(split))
            self.child.append(np.concatenate([[0], np.cumsum(counts)]))
            members.append(parts)
            level = parts
        self.order = np.concatenate(level)
        sizes = np.array([len(p) for p in level])
        self.child = self.child[1:]
        # Leaves are the rows themselves.
        self.child.append(np.concatenate([[0], np.cumsum(sizes)]))
        self.lo, self.hi, self.radius = [], [], []
        x = x[self.order]
        for parts in members:
            hi = np.cumsum([len(p) for p in parts])
            lo = np.concatenate([[0], hi[:-1]])
            centre = np.repeat(lo, hi - lo)
            far = chord((x * x[centre]).sum(axis=1))
            radius = np.maximum.reduceat(far, lo)
            radius[hi - lo == 1] = 0.0
            self._add(lo, hi, radius)
        rows = np.arange(len(x))
        self._add(rows, rows + 1, np.zeros(len(x)))

    def _add(self, lo: np.ndarray, hi: np.ndarray, radius: np.ndarray) -> None:
        self.lo.append(lo)
        self.hi.append(hi)
        self.radius.append(radius)


class Forest:
    """Cover trees as one, from the level of ``_CUT`` on, over their rows in a row.

    ``lo`` has an entry more than nodes: a node ends where the next one begins.  Levels
    after the first one of nothing but single rows are left out.
    """

    def __init__(self, trees: list[CoverTree]) -> None:
        self.lo, self.radius, self.child = [], [], []
        rows = np.cumsum([0] + [len(t.order) for t in trees])
        for level in range(_CUT, len(_RADII) + 1):
            lo = [t.lo[level] + base for t, base in zip(trees, rows, strict=False)]
            self.lo.append(np.concatenate([*lo, rows[-1:]]).astype(np.int32))
            self.radius.append(np.concatenate([t.radius[level] for t in trees]))
            if level == len(_RADII) or len(self.radius[-1]) == rows[-1]:
                break
            nodes = np.cumsum([0] + [len(t.lo[level + 1]) for t in trees])
            child = [t.child[level][:-1] + base for t, base in zip(trees, nodes, strict=False)]
            self.child.append(np.concatenate([*child, nodes[-1:]]).astype(np.int32))
        self.child.append(np.arange(rows[-1] + 1, dtype=np.int32))

    def level(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``lo``, ``radius`` and ``child`` of a level, counted from that of ``_CUT``."""
        at = min(level, len(self.lo) - 1)
        return self.lo[at], self.radius[at], self.child[at]


class _Nodes:
    """Some nodes of the first level of a forest, in tiles, with what bounds them."""

    def __init__(self, forest: Forest, x: np.ndarray, nodes: np.ndarray,
                 basis: np.ndarray | None) -> None:
        lo, radius, _ = forest.level(0)
        self.nodes = nodes
        centres = x[lo[nodes]]
        self.radius = float(radius[nodes].max(initial=0.0))
        self.whole = centres.astype(np.float32)
        self.short = None
        if basis is not None:
            first = centres @ basis
            rest = np.sqrt(np.maximum(1.0 - (first * first).sum(axis=1, keepdims=True), 0.0))
            self.short = np.hstack([first, rest]).astype(np.float32)
        self.starts = np.arange(0, len(nodes), _TILE)
        middles = [centres[i : i + _TILE].mean(axis=0) for i in self.starts]
        self.middles = np.array(middles).reshape(-1, x.shape[1])
        self.far = np.array([
            (np.sqrt(((centres[i : i + _TILE] - m) ** 2).sum(axis=1))
             + radius[nodes[i : i + _TILE]]).max()
            for i, m in zip(self.starts, self.middles, strict=True)
        ])


class Side:
    """The vectors of a forest, of length one, and its nodes: narrow ones and others."""

    def __init__(self, forest: Forest, x: np.ndarray, basis: np.ndarray | None) -> None:
        self.forest, self.x = forest, x
        narrow = forest.level(0)[1] <= _NARROW
        self.parts = [_Nodes(forest, x, np.flatnonzero(narrow), basis),
                      _Nodes(forest, x, np.flatnonzero(~narrow), None)]


class _Links:
    """Numbers of links and connected rows that a traversal finds on one side each."""

    def __init__(self, sizes: list[int]) -> None:
        self.counts = [np.zeros(n + 1, dtype=np.int64) for n in sizes]
        self.joined = [np.zeros(n + 1, dtype=np.int64) for n in sizes]
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.label = np.arange(sum(sizes))
        self.held = 0

    def add(self, side: int, lo: np.ndarray, hi: np.ndarray, links: np.ndarray) -> None:
        """Every row of the stretches has so many links more, and they are connected."""
        np.add.at(self.counts[side], lo, links)
        np.add.at(self.counts[side], hi, -links)
        np.add.at(self.joined[side], lo, 1)
        np.add.at(self.joined[side], hi - 1, -1)

    def connect(self, u: np.ndarray, v: np.ndarray) -> None:
        """Rows, counted over both sides, are connected; few edges are held at once."""
        self.edges.append((u, v))
        self.held += len(u)
        if self.held > len(self.label) + _PAIRS:
            self.settle()

    def settle(self) -> None:
        if self.edges:
            u, v = (np.concatenate(e) for e in zip(*self.edges, strict=True))
            self.label = _connected(self.label, u, v)
            self.edges, self.held = [], 0


class Dual:
    """Links between two sides, or within one if ``b`` is None."""

    def __init__(self, a: Side, b: Side | None, threshold: float) -> None:
        self.one = b is None
        self.sides = [a, a if b is None else b]
        self.x = [side.x for side in self.sides]
        self.threshold, self.r = threshold, float(chord(threshold))
        self.links = _Links([len(a.x)] if self.one else [len(a.x), len(b.x)])
        if self.one:
            lo = a.forest.level(0)[0]
            own = np.flatnonzero(np.diff(lo) > 1)
            self._descend(own, own)
        for i, na in enumerate(a.parts):
            for j, nb in enumerate(self.sides[1].parts):
                if not (self.one and j < i):
                    self._compare(na, nb, self.one and i == j)

    def _compare(self, na: _Nodes, nb: _Nodes, same: bool) -> None:
        """Send down the pairs of nodes that may have links, by products in single precision.

        With narrow nodes on both sides their first coordinates in the basis do, and the
        lengths of the rest: two rests have no larger product than that of their lengths.
        """
        reach = self.r + na.radius + nb.radius + _EPS
        short = na.short is not None and nb.short is not None
        left, right = (na.short, nb.short) if short else (na.whole, nb.whole)
        # Chord d <= reach is the same as cosine >= 1 - reach ** 2 / 2.
        least = np.float32(1.0 - reach * reach / 2.0 - 3e-7 * (self.x[0].shape[1] + 16))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for tile, start in enumerate(na.starts.tolist()):
            gap = np.sqrt(((nb.middles - na.middles[tile]) ** 2).sum(axis=1))
            near = np.flatnonzero(gap <= self.r + na.far[tile] + nb.far + _EPS)
            if same:
                near = near[near >= tile]
            rows = left[start : start + _TILE]
            while len(near):
                many = min(_TILES, len(near))
                # Tiles that follow each other are multiplied at once.
                many = int((near[:many] == near[0] + np.arange(many)).sum())
                begin = int(near[0]) * _TILE
                near = near[many:]
                cosine = rows @ right[begin : begin + many * _TILE].T
                hit = np.flatnonzero(cosine.max(axis=1) >= least)
                if not len(hit):
                    continue
                i, j = np.nonzero(cosine[hit] >= least)
                i, j = hit[i] + start, j + begin
                if same:
                    i, j = i[i < j], j[i < j]
                found.append((na.nodes[i], nb.nodes[j]))
                if sum(len(i) for i, _ in found) >= _PAIRS:
                    self._down(found)
        self._down(found)

    def _down(self, found: list[tuple[np.ndarray, np.ndarray]]) -> None:
        if found:
            a, b = (np.concatenate(nodes) for nodes in zip(*found, strict=True))
            found.clear()
            for k in range(0, len(a), _PAIRS):
                self._descend(a[k : k + _PAIRS], b[k : k + _PAIRS])

    def _cosine(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Cosines of rows, in double precision."""
        if not len(i):
            return np.empty(0)
        return np.concatenate([
            (self.x[0][i[k : k + 8192]] * self.x[1][j[k : k + 8192]]).sum(axis=1)
            for k in range(0, len(i), 8192)
        ])

    def _descend(self, a: np.ndarray, b: np.ndarray, level: int = 0) -> None:
        """Settle pairs of nodes of a level, counted from that of ``_CUT``."""
        (alo, aradius, achild), (blo, bradius, bchild) = (
            side.forest.level(level) for side in self.sides
        )
        la, ha, lb, hb = alo[a], alo[a + 1], blo[b], blo[b + 1]
        ra, rb = aradius[a], bradius[b]
        own = (a == b) if self.one else np.zeros(len(a), dtype=bool)
        cosine = self._cosine(la, lb)
        d = np.where(own, 0.0, chord(cosine))
        single = (ra == 0) & (rb == 0) & (ha - la == 1) & (hb - lb == 1)
        whole = np.where(single, cosine >= self.threshold, d + ra + rb + _EPS <= self.r)
        open_pairs = np.where(single, False, d <= self.r + ra + rb + _EPS) & ~whole
        whole &= ~(own & single)
        self._accept(la[whole], ha[whole], lb[whole], hb[whole], own[whole])
        a, b, own = a[open_pairs], b[open_pairs], own[open_pairs]
        sa, sb = achild[a].astype(np.int64), bchild[b].astype(np.int64)
        wide = bchild[b + 1] - sb
        ends = np.cumsum((achild[a + 1] - sa) * wide)
        for low in range(0, int(ends[-1]) if len(a) else 0, _PAIRS):
            at = np.arange(low, min(low + _PAIRS, int(ends[-1])))
            pair = np.searchsorted(ends, at, side="right")
            at -= np.where(pair > 0, ends[pair - 1], 0)
            na, nb = sa[pair] + at // wide[pair], sb[pair] + at % wide[pair]
            keep = ~own[pair] | (na <= nb)
            self._descend(na[keep], nb[keep], level + 1)

    def _accept(self, alo, ahi, blo, bhi, own: np.ndarray) -> None:
        side = 0 if self.one else 1
        self.links.add(0, alo[own], ahi[own], (ahi - alo - 1)[own])
        other = ~own
        self.links.add(0, alo[other], ahi[other], (bhi - blo)[other])
        self.links.add(side, blo[other], bhi[other], (ahi - alo)[other])
        if other.any():
            self.links.connect(alo[other], blo[other] + side * len(self.x[0]))

    def result(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per side: links of each row, and the first row (over both sides, side after
        side) that it is connected with."""
        counts = [np.cumsum(c)[:-1] for c in self.links.counts]
        sizes = [len(c) for c in counts]
        for side, joined in enumerate(self.links.joined):
            base = sum(sizes[:side])
            at = np.flatnonzero(np.cumsum(joined)[:-1] > 0)
            self.links.connect(base + at, base + at + 1)
        self.links.settle()
        return counts, np.split(self.links.label, np.cumsum(sizes)[:-1])


def _connected(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    while True:
        before = label
        least = np.minimum(label[u], label[v])
        label = label.copy()
        np.minimum.at(label, before[u], least)
        np.minimum.at(label, before[v], least)
        while (label != label[label]).any():
            label = label[label]
        if (label == before).all():
            return label


def _read_task(float32: bool):
    """Tasks that turn lists into bytes; what can't be compared becomes null."""
    kind = np.float32 if float32 else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, dims = [], []
            for v in batch.column(2):
                x = None
                if v.is_valid and len(v) and v.values.null_count == 0:
                    x = v.values.to_numpy(zero_copy_only=False).astype(kind)
                    square = float((x.astype(np.float64) ** 2).sum())
                    if not np.isfinite(square) or square == 0:
                        x = _rescaled(x)
                out.append(None if x is None else x.tobytes())
                dims.append(0 if x is None else len(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(dims, pa.int32()),
                 pa.array(out, pa.binary())],
                ["k", "id", "dim", "vector"],
            )

    return run


def _rescaled(x: np.ndarray) -> np.ndarray | None:
    """A vector whose squares overflow or vanish, by its largest component; else None."""
    most = float(np.abs(x).max()) if np.isfinite(x).all() else 0.0
    return (x / most).astype(x.dtype) if most > 0 else None


def _cell_task(shared, max_pivots: int, float32: bool):
    """Tasks that name the cell of each vector.

    Vectors of a length without pivot share a cell below 0 that bounds nothing.
    """
    kind = np.float32 if float32 else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            cell = (-1 - dims % max_pivots).astype(np.int32)
            far = np.full(len(dims), 2.0)
            raw = batch.column(2).to_pylist()
            for dim, (numbers, pivots) in shared.value.items():
                here = np.flatnonzero(dims == dim)
                if not len(here):
                    continue
                x = unit(np.frombuffer(b"".join(raw[i] for i in here), kind).reshape(-1, dim))
                cosine = x @ pivots.T
                best = cosine.argmax(axis=1)
                cell[here] = numbers[best]
                far[here] = chord(cosine[np.arange(len(here)), best])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cell), pa.array(far), *batch.columns[1:3]],
                ["k", "cell", "far", "dim", "vector"],
            )

    return run


def _group_task(float32: bool, block: int):
    """Tasks that make one row of a group: its cells with the largest distances from their
    pivots, and for each length its keys, vectors and forest."""
    kind = np.float32 if float32 else np.float64

    def run(key: tuple, table: pa.Table) -> pa.Table:
        cell, dims, far, k = (
            table.column(c).to_numpy() for c in ("cell", "dim", "far", "k")
        )
        raw = table.column("vector").to_pylist()
        order = np.lexsort((k, cell, dims))
        payload = {}
        for of in np.split(order, np.flatnonzero(np.diff(dims[order])) + 1):
            keys, vectors, trees = [], [], []
            for rows in np.split(of, np.flatnonzero(np.diff(cell[of])) + 1):
                # Blocks of about the same size.
                for part in np.array_split(rows, -(-len(rows) // block)):
                    x = np.frombuffer(b"".join(raw[i] for i in part), kind).reshape(len(part), -1)
                    trees.append(CoverTree(x))
                    vectors.append(x[trees[-1].order])
                    keys.append(k[part][trees[-1].order])
            payload[int(dims[of[0]])] = (
                np.concatenate(keys), np.concatenate(vectors), Forest(trees)
            )
        cells = np.unique(cell)
        return pa.table({
            "cells": pa.array([cells.tolist()], pa.list_(pa.int32())),
            "fars": pa.array([[float(far[cell == c].max()) for c in cells]],
                             pa.list_(pa.float64())),
            "payload": pa.array([pickle.dumps(payload, protocol=5)], pa.binary()),
            "grp": pa.array([key[0].as_py()], pa.int32()),
        })

    return run


def _pair_task(shared, threshold: float):
    """Tasks that find the links between two groups, or within one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, dict]] = [(None, {}), (None, {})]

        def sides(at: int, group: int, payload: pa.Scalar) -> dict:
            if held[at][0] != group:
                found = pickle.loads(payload.as_buffer())
                held[at] = group, {
                    dim: (keys, Side(forest, unit(vectors), shared.value.get(dim)))
                    for dim, (keys, vectors, forest) in found.items()
                }
            return held[at][1]

        for batch in batches:
            for a, left, b, right in zip(*batch.columns, strict=True):
                a, b = a.as_py(), b.as_py()
                first = sides(0, a, left)
                second = first if a == b else sides(1, b, right)
                for dim in sorted(first.keys() & second.keys()):
                    ka, xa = first[dim]
                    kb, xb = second[dim]
                    every, xb = (ka, None) if a == b else (np.concatenate([ka, kb]), xb)
                    counts, labels = Dual(xa, xb, threshold).result()
                    count, label = np.concatenate(counts), np.concatenate(labels)
                    at = np.flatnonzero(count)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(every[at]), pa.array(count[at]), pa.array(every[label[at]])],
                        ["k", "links", "label"],
                    )

    return run


def _basis(x: np.ndarray, threshold: float) -> np.ndarray | None:
    """Few directions that tell these unit vectors apart, or none if few do not suffice.

    A pair is dropped by its first coordinates and the lengths of the rest, which bound its
    cosine; costs are those of the product, and of pairs that have to be looked at again.
    """
    dim = x.shape[1]
    # Directions are tried on other vectors than those that they come from.
    x, tried = x[::2], x[1::2]
    if not len(tried):
        return None
    directions = np.linalg.svd(x, full_matrices=False)[2].T
    turned = tried @ directions
    apart = np.triu(tried @ tried.T < threshold, 1)
    best, least = None, float(dim)
    # With the rest they are a multiple of four, which products are fastest with.
    for few in range(3, min(dim, directions.shape[1] + 1), 4):
        first = turned[:, :few]
        rest = np.sqrt(np.maximum(1.0 - (first * first).sum(axis=1), 0.0))
        passed = apart & (first @ first.T + np.outer(rest, rest) >= threshold)
        cost = few + 50_000.0 * (passed.sum() + 1) / (apart.sum() + 1)
        if cost < least:
            best, least = np.ascontiguousarray(directions[:, :few]), cost
    return best


def _near_cells(
    by_dim: dict[int, tuple[np.ndarray, np.ndarray]], entries: list[tuple[int, int, float]],
    reach: float, groups: int,
) -> np.ndarray:
    """Which groups may have links with which, from their cells and the cells' radii.

    A cell with a pivot has links with cells of pivots of the same length, one below 0 with
    itself.
    """
    near = np.zeros((groups, groups), dtype=bool)
    grp, cell, far = (np.array(c) for c in zip(*entries, strict=True))
    for below in np.unique(cell[cell < 0]):
        of = grp[cell == below]
        near[np.ix_(of, of)] = True
    for numbers, x in by_dim.values():
        here = np.flatnonzero(np.isin(cell, numbers))
        at = np.searchsorted(numbers, cell[here])
        distance = chord(x @ x.T)
        np.fill_diagonal(distance, 0.0)
        for i, row in zip(here, at, strict=True):
            meets = distance[row, at] <= reach + far[i] + far[here]
            near[grp[i], grp[here[meets]]] = True
    return near


def _in_order(by_dim: dict[int, tuple[np.ndarray, np.ndarray]]) -> list[int]:
    """The cells of pivots, those near each other in a row: halves of halves, by the
    direction in which they differ most."""
    out: list[int] = []
    for numbers, x in by_dim.values():
        left = [np.arange(len(numbers))]
        while left:
            part = left.pop()
            if len(part) == 1:
                out.append(int(numbers[part[0]]))
                continue
            y = x[part] - x[part].mean(axis=0)
            part = part[np.argsort(y @ np.linalg.svd(y, full_matrices=False)[2][0], kind="stable")]
            left += [part[len(part) // 2 :], part[: len(part) // 2]]
    return out


def _layout(
    share: dict[int, float], in_order: list[int]
) -> tuple[dict[int, tuple[int, int]], int]:
    """For each cell its first group and its number of groups, and how many groups there are.

    ``share`` is how many groups a cell fills.  It has one or several of its own, or is in
    one with the cells before it.
    """
    layout, filled, groups = {}, 1.0, 0
    for cell in [*in_order, *sorted(c for c in share if c < 0)]:
        if filled + share[cell] <= 1.0:
            layout[cell] = groups - 1, 1
            filled += share[cell]
        else:
            parts = int(np.ceil(share[cell]))
            layout[cell] = groups, parts
            groups += parts
            filled = min(share[cell], 1.0)
    return layout, groups


def _compared(
    scratch: Scratch, table: DataFrame, by_dim: dict, bases: dict, threshold: float, groups: int
) -> DataFrame:
    """The links of all pairs of groups that may have some, as a written table.

    A task reads one group and some of those after it from the files of the table; nothing
    is shuffled.  Only the numbers of cells and their radii reach the driver.
    """
    spark = scratch.spark
    entries = [
        (r["grp"], cell, far) for r in table.select("grp", "cells", "fars").collect()
        for cell, far in zip(r["cells"], r["fars"], strict=True)
    ]
    pair = _pair_task(spark.sparkContext.broadcast(bases), threshold)
    schema = "k long, links long, label long"
    if not entries:
        return spark.createDataFrame([], schema)
    near = _near_cells(by_dim, entries, float(chord(threshold)) + _EPS, groups)
    written = []
    with configured(spark, {
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1",
        "spark.sql.files.maxPartitionBytes": str(_GROUP_BYTES),
    }):
        parts, n_pairs = [], 0
        for i in range(groups):
            others = [str(j) for j in np.flatnonzero(near[i]) if j >= i]
            if others:
                # In a cartesian product each task holds its part of the right side.
                one = table.where(f"grp = {i}").select("grp", "payload").coalesce(1)
                many = table.where(f"grp IN ({','.join(others)})").select("grp", "payload")
                parts.append(many.crossJoin(one.hint("shuffle_replicate_nl")))
                n_pairs += len(others)
            if parts and (i == groups - 1 or len(parts) == _JOB_GROUPS or n_pairs >= _JOB_PAIRS):
                pairs = reduce(DataFrame.union, parts).toDF("a", "left", "b", "right")
                written.append(scratch.store(pairs.mapInArrow(pair, schema)))
                parts, n_pairs = [], 0
    return reduce(DataFrame.union, written)


def near_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block: int = BLOCK,
    max_pivots: int = MAX_PIVOTS,
) -> DataFrame:
    """For each row: its id, ``n_links``, ``component_id`` and ``kept``.

    Rows are linked if their cosine, in double precision, is at least ``threshold``
    (over 0).  Vectors that are null, empty or zero or that hold null or non-finite
    components link with nothing, nor do vectors of different lengths.  ``component_id``
    is the smallest id reachable by links.  Repeated rows and equal ids are rows of
    their own; null ids count for no smallest id.  Other columns are not read; no rows
    give no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    float32 = vectors.schema[vector_col].dataType.elementType.simpleString() == "float"
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = scratch.store(
        vectors.select(
            F.monotonically_increasing_id().alias("k"), F.col(id_col).alias("id"),
            F.col(vector_col).alias("vector"),
        ).mapInArrow(_read_task(float32), f"k long, id {kind}, dim int, vector binary")
    )
    good = rows.where("vector IS NOT NULL")
    n = good.count()
    order = F.xxhash64("vector", "k")
    sample = good.orderBy(order).limit(max_pivots).select("dim", "vector").collect()
    first = sample[: min(max_pivots, max(1, n // block))]
    pivots = list(dict.fromkeys((r["dim"], bytes(r["vector"])) for r in first))
    number_type = np.float32 if float32 else np.float64
    by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    bases: dict[int, np.ndarray] = {}
    for dim in sorted({dim for dim, _ in pivots}):
        numbers = [i for i, (of, _) in enumerate(pivots) if of == dim]
        raw = b"".join(pivots[i][1] for i in numbers)
        by_dim[dim] = (
            np.array(numbers, dtype=np.int32), unit(np.frombuffer(raw, number_type).reshape(-1, dim))
        )
        raw = b"".join(bytes(r["vector"]) for r in sample if r["dim"] == dim)
        basis = _basis(unit(np.frombuffer(raw, number_type).reshape(-1, dim)), threshold)
        if basis is not None:
            bases[dim] = basis
    # Found twice, since written they would be a second copy of all vectors.
    cells = good.select("k", "dim", "vector").mapInArrow(
        _cell_task(spark.sparkContext.broadcast(by_dim), max_pivots, float32),
        "k long, cell int, far double, dim int, vector binary",
    )
    sizes = cells.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("vector").cast("long")).alias("size")
    )
    share = {
        r["cell"]: max(r["n"] / (_GROUP_BLOCKS * block), r["size"] / _GROUP_BYTES)
        for r in sizes.collect()
    }
    layout, n_groups = _layout(share, [c for c in _in_order(by_dim) if c in share])
    place = F.create_map(*(
        x for cell, (first, parts) in layout.items()
        for x in (F.lit(cell), F.struct(F.lit(first).alias("first"), F.lit(parts).alias("parts")))
    )) if layout else F.lit(None).cast("map<int,struct<first:int,parts:int>>")
    place = place[F.col("cell")]
    grp = F.coalesce(place["first"] + F.pmod(F.xxhash64("k"), place["parts"]), F.lit(0))
    table = scratch.store(
        cells.withColumn("grp", grp.cast("int")).groupBy("grp").applyInArrow(
            _group_task(float32, block),
            "cells array<int>, fars array<double>, payload binary, grp int",
        ),
        by="grp",
    )
    found = _compared(scratch, table, by_dim, bases, threshold, n_groups)
    counts = found.groupBy("k").agg(F.sum("links").alias("links"))
    groups = components(scratch, found, "k", "label")
    smallest = (
        groups.join(rows.select(F.col("k").alias("node"), "id"), "node")
        .groupBy("label").agg(F.min("id").alias("least"))
    )
    placed = groups.join(smallest, "label").select(F.col("node").alias("k"), "least")
    return (
        rows.select("k", "id").join(counts, "k", "left").join(placed, "k", "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("least", "id").alias("component_id"),
        )
        .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
    )
