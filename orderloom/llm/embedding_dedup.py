"""Embedding near-dedup: exact threshold pairs by dual traversal of cover trees.

Vectors of one label are normalised, so cosine c is the chord sqrt(2 - 2c). Equal vectors are one node. A tree has nested levels with
halving radii: the centres of a level lie more than its radius apart, every point lies within it of its centre, and a centre stays one on all finer
levels. A pair of nodes is dropped when its centres are farther apart than the threshold chord plus both covering radii; what is left at
the finest level is checked in double precision on the vectors as given.

A label has as many trees as its size asks for: its points are dealt to pivots, those of a crowded pivot to new pivots among them, and so on, until a
cell is of bounded size. These top levels are walked in pairs on the cluster, level by level: only pairs of nodes that pass the test on pivots and
radii go down to their children, so the pairs grow with what lies near, not with the square of the label. A cell is a tree of its own, and a pair of cells that is left
a task. A task returns how many links each node has and a forest of them, not all pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import cut_lineage
from orderloom.llm.components import components

CELL = 2048
PIVOTS = 32
#: A cell that keeps more than this share of its points at one pivot is not split on: they lie too close together.
STUCK = 0.9
BLOCK = 256
SLACK = 1e-7


def _net(points: np.ndarray, centres: np.ndarray, radius: float) -> np.ndarray:
    """``centres`` and more rows, each farther than ``radius`` from all others, until every point is within it of one."""
    close = 1 - radius * radius / 2
    added: list[int] = []
    for begin in range(0, len(points), BLOCK):
        block = points[begin : begin + BLOCK]
        covered = (block @ points[centres].T).max(1) >= close
        if added:
            covered |= (block @ points[added].T).max(1) >= close
        within = block @ block.T >= close
        for i in range(len(block)):
            if not covered[i]:
                added.append(begin + i)
                covered |= within[i]
    return np.concatenate([centres, np.array(added, np.int64)])


def levels(points: np.ndarray, least: float) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """Per level, from one centre over radius 1 down: centres (rows), covering radii, and for each finer centre its parent's place.

    The last level has every point as its own centre with radius 0; levels between stop at radius ``least`` or when all points are centres.
    """
    centres, parents, radius = [np.array([0])], [], 2.0
    while radius > least and centres[-1].size < len(points):
        radius /= 2
        centres.append(_net(points, centres[-1], radius))
    if centres[-1].size == len(points):
        centres.pop()
    centres.append(np.arange(len(points)))
    for coarse, fine in zip(centres[:-1], centres[1:], strict=True):
        near = np.empty(fine.size, np.int64)
        for i in range(0, fine.size, BLOCK):
            near[i : i + BLOCK] = (points[fine[i : i + BLOCK]] @ points[coarse].T).argmax(1)
        place = np.full(len(points), -1)
        place[coarse] = np.arange(coarse.size)
        parents.append(np.where(place[fine] >= 0, place[fine], near))
    # Covering radii of whole subtrees, from the points up.
    own, covers = np.arange(len(points)), [np.zeros(len(points))]
    for coarse, up in zip(centres[-2::-1], parents[::-1], strict=True):
        own = up[own]
        reach = np.zeros(coarse.size)
        np.maximum.at(reach, own, np.sqrt(((points - points[coarse[own]]) ** 2).sum(1)))
        covers.append(reach)
    return centres, covers[::-1], parents


def near_pairs(a: np.ndarray, b: np.ndarray | None, chord: float) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of ``a`` and ``b`` (None: of ``a`` with itself, each once) that may be within the chord, as two arrays."""
    one = b is None
    tree_a = levels(a, chord / 2)
    tree_b = tree_a if one else levels(b, chord / 2)
    b = a if one else b
    last_a, last_b = len(tree_a[0]) - 1, len(tree_b[0]) - 1
    left, right = np.array([0]), np.array([0])
    for level in range(max(last_a, last_b) + 1):
        at_a, at_b = min(level, last_a), min(level, last_b)
        centres_a, centres_b = tree_a[0][at_a], tree_b[0][at_b]
        cover_a, cover_b = tree_a[1][at_a], tree_b[1][at_b]
        if level and left.size == 1:
            # One pair of nodes over all others: its children are compared block by block.
            found = []
            for i in range(0, centres_a.size, BLOCK):
                gap = np.sqrt(np.maximum(2 - 2 * (a[centres_a[i : i + BLOCK]] @ b[centres_b].T), 0))
                x, y = np.nonzero(gap <= chord + cover_a[i : i + BLOCK, None] + cover_b[None] + SLACK)
                x = x + i
                found.append((x[x <= y], y[x <= y]) if one else (x, y))
            left, right = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            continue
        if level:
            up_a = tree_a[2][level - 1] if level <= last_a else np.arange(len(a))
            up_b = tree_b[2][level - 1] if level <= last_b else np.arange(len(b))
            left, right = _children(left, right, up_a, up_b, one)
        gap = _gaps(a, b, centres_a[left], centres_b[right])
        keep = gap <= chord + cover_a[left] + cover_b[right] + SLACK
        left, right = left[keep], right[keep]
    return left, right


def _gaps(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Chords between rows x of a and y of b: by one product where most pairs are wanted, else pair by pair."""
    rows, at = np.unique(x, return_inverse=True)
    columns, to = np.unique(y, return_inverse=True)
    if rows.size * columns.size <= 4 * x.size:
        dots = (a[rows] @ b[columns].T)[at, to]
    else:
        dots = np.empty(x.size)
        for i in range(0, x.size, 65536):
            dots[i : i + 65536] = np.einsum("ij,ij->i", a[x[i : i + 65536]], b[y[i : i + 65536]])
    return np.sqrt(np.maximum(2 - 2 * dots, 0))


def _children(left: np.ndarray, right: np.ndarray, up_a: np.ndarray, up_b: np.ndarray, one: bool) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of children of the node pairs."""
    order_a, order_b = np.argsort(up_a, kind="stable"), np.argsort(up_b, kind="stable")
    size_a, size_b = np.bincount(up_a, minlength=left.max(initial=-1) + 1), np.bincount(up_b, minlength=right.max(initial=-1) + 1)
    begin_a, begin_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    count = size_a[left] * size_b[right]
    pair = np.repeat(np.arange(left.size), count)
    inside = np.arange(pair.size) - np.repeat(np.cumsum(count) - count, count)
    wide = size_b[right][pair]
    x = order_a[begin_a[left][pair] + inside // wide]
    y = order_b[begin_b[right][pair] + inside % wide]
    if one:  # each unordered pair once; a node with itself stays, for its children
        keep = (left[pair] != right[pair]) | (x <= y)
        x, y = x[keep], y[keep]
    return x, y


def _dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _chord(x, y):
    return F.sqrt(F.greatest(2 - 2 * _dot(x, y), F.lit(0.0)))


def _levels(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``nodes`` with their ``cell``, a path of pivots; and per level the balls: label, parent, cell, centre, radius and whether it is split on.

    A round deals the points of the cells that are still crowded to PIVOTS new pivots each, chosen by hash. It ends as every round makes cells
    smaller than STUCK of what they were or leaves them.
    """
    opened = nodes.withColumn("cell", F.lit("0"))
    done, levels = [], []
    while True:
        picks = [F.min_by("unit", F.xxhash64("node", "cell", F.lit(i))) for i in range(PIVOTS)]
        counted = opened.groupBy("label", "cell").agg(F.count("*").alias("_rows"), F.array(*picks).alias("_pivots"))
        wanted = F.least(F.ceil(F.col("_rows") / CELL), F.lit(PIVOTS)).cast("int")
        chosen = cut_lineage(counted.select("label", "cell", "_rows", F.slice("_pivots", 1, wanted).alias("_pivots")), "pivots")
        near = F.transform("_pivots", lambda p: _dot(p, F.col("unit")))
        placed = opened.join(chosen, ["label", "cell"]).select(*opened.columns, "_rows", "_pivots", near.alias("_near"))
        pivot = F.array_position("_near", F.array_max("_near")).cast("int")
        placed = placed.select(*nodes.columns, "_rows", F.col("cell").alias("parent"), F.concat_ws(".", "cell", pivot.cast("string")).alias("cell"), F.element_at("_pivots", pivot).alias("centre"))
        placed = cut_lineage(placed, "cells")
        balls = placed.groupBy("label", "parent", "cell").agg(
            F.any_value("centre").alias("centre"), F.max(_chord(F.col("centre"), F.col("unit"))).alias("radius"), F.count("*").alias("_now"), F.any_value("_rows").alias("_rows")
        )
        split = (F.col("_now") > CELL) & (F.col("_now") < STUCK * F.col("_rows"))
        balls = cut_lineage(balls.select("label", "parent", "cell", "centre", "radius", split.alias("split")), "balls")
        levels.append(balls)
        crowded = balls.where("split").select("label", "cell")
        done.append(placed.join(crowded, ["label", "cell"], "left_anti").select(*nodes.columns, "cell"))
        if crowded.isEmpty():
            break
        opened = placed.join(crowded, ["label", "cell"], "left_semi").select(*nodes.columns, "cell")
    cells = done[0]
    for more in done[1:]:
        cells = cells.union(more)
    return cells, levels


def _near_cells(levels: list[DataFrame], chord: float) -> DataFrame:
    """Pairs of cells (label, a, b) whose balls may hold a link, each once, from the top level down."""
    items = levels[0]
    a, b = items.alias("a"), items.alias("b")
    near = _chord(F.col("a.centre"), F.col("b.centre")) <= chord + F.col("a.radius") + F.col("b.radius") + SLACK
    columns = [F.col("a.label").alias("label"), F.col("a.cell").alias("a"), F.col("b.cell").alias("b")]
    pairs = a.join(b, (F.col("a.label") == F.col("b.label")) & (F.col("a.cell") <= F.col("b.cell")) & near).select(*columns)
    for level in levels[1:]:
        # Cells that were not split go on as their own only child.
        ended = items.where("not split").withColumn("parent", F.col("cell"))
        items = cut_lineage(ended.unionByName(level), "balls")
        pairs = cut_lineage(pairs, "pairs").alias("p")
        a, b = items.alias("a"), items.alias("b")
        left = (F.col("p.label") == F.col("a.label")) & (F.col("p.a") == F.col("a.parent"))
        right = (F.col("p.label") == F.col("b.label")) & (F.col("p.b") == F.col("b.parent"))
        once = (F.col("p.a") != F.col("p.b")) | (F.col("a.cell") <= F.col("b.cell"))
        pairs = pairs.join(a, left).join(b, right & once & near).select(*columns)
    return pairs


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.98) -> DataFrame:
    """Per row: the key, ``n_links``, ``component_id`` and ``kept``.

    Rows link when their labels are equal and not null and the cosine of their vectors, in double precision, is ``threshold`` or more. Null or
    zero vectors, those with null or non-finite components, of another length, or with a null label link with nothing: no links, their own
    component. Equal vectors of a label link with each other and share all other links, without their pairs being made. Repeated keys are rows of their
    own for ``n_links``; ``kept`` is whether the key is the smallest of its component. A null key is larger than any other. An empty table stays empty.
    """
    spark, chord = vectors.sparkSession, float(np.sqrt(max(2 - 2 * threshold, 0.0)))
    raw = F.col(vector).cast("array<double>")
    base = vectors.select(F.col(key).alias("key"), F.col(label).alias("label"), raw.alias("v"))
    # Scaled by the largest component first, so that no square overflows or vanishes.
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    top = F.aggregate("v", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x)))
    usable = F.coalesce(F.col("label").isNotNull() & (F.size("v") > 0) & finite & (top > 0), F.lit(False))
    scaled = base.select("key", "label", F.when(usable, F.transform("v", lambda x: x / top)).alias("v"))
    size = F.sqrt(_dot(F.col("v"), F.col("v")))
    unit = F.transform("v", lambda x: x / F.col("_size"))
    rows = scaled.withColumn("_size", size).select("key", "label", unit.alias("unit"))
    rows = cut_lineage(rows.withColumn("node", F.when(F.col("unit").isNotNull(), F.concat_ws("/", *[F.hex(F.xxhash64(F.lit(salt), "label", "unit")) for salt in (1, 2)]))), "vectors")

    some = rows.where("node is not null")
    nodes = some.groupBy("node").agg(F.min("key").alias("first"), F.count("*").alias("copies"), F.any_value("label").alias("label"), F.any_value("unit").alias("unit"))
    nodes = cut_lineage(nodes.withColumn("label", F.struct("label", F.size("unit"))), "nodes")
    cells, levels = _levels(nodes.select("node", "label", "unit", "copies"))
    # What no pivots part is dealt on by hash; such parts share a ball.
    parts = cut_lineage(cells.groupBy("label", "cell").agg(F.ceil(F.count("*") / CELL).cast("int").alias("_parts")), "parts")
    cells = cells.join(parts, ["label", "cell"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("_parts").cast("long"))).drop("_parts")
    cells = cut_lineage(cells, "cells")
    pairs = _near_cells(levels, chord)
    each = parts.select("label", F.col("cell").alias("_cell"), F.explode(F.sequence(F.lit(0).cast("long"), (F.col("_parts") - 1).cast("long"))).alias("part"))
    side_a, side_b = (each.select(F.col("label").alias(f"_l{s}"), F.col("_cell").alias(f"_c{s}"), F.col("part").alias(f"{s}_part")) for s in "ab")
    pairs = pairs.join(side_a, (F.col("label") == F.col("_la")) & (F.col("a") == F.col("_ca"))).join(side_b, (F.col("label") == F.col("_lb")) & (F.col("b") == F.col("_cb")))
    pairs = pairs.where("a != b or a_part <= b_part").select("label", F.struct(F.col("a").alias("cell"), F.col("a_part").alias("part")).alias("a"), F.struct(F.col("b").alias("cell"), F.col("b_part").alias("part")).alias("b"))
    pairs = cut_lineage(pairs, "pairs")
    sides = pairs.select("label", "a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("side"))
    sides = sides.select("label", "a", "b", F.col("side.cell").alias("cell"), F.col("side.part").alias("part"))
    tasks = cells.join(sides, ["label", "cell", "part"])
    name = {c: F.concat_ws("#", f"{c}.cell", f"{c}.part") for c in "ab"}
    tasks = tasks.select("label", name["a"].alias("a"), name["b"].alias("b"), F.concat_ws("#", "cell", "part").alias("cell"), "node", "unit", "copies")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        """Of a label and a pair of cells: one row per node with links (a, its links) and one per edge of the forest (a, b)."""
        one = group["a"].iloc[0] == group["b"].iloc[0]
        left = group[group["cell"] == group["a"].iloc[0]]
        right = left if one else group[group["cell"] == group["b"].iloc[0]]
        p, q = np.stack(left["unit"].to_numpy()), np.stack(right["unit"].to_numpy())
        links_left, links_right = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)
        copies_left, copies_right = left["copies"].to_numpy(), right["copies"].to_numpy()
        parent = np.arange(len(left) + (0 if one else len(right)))

        def top(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        edges = []
        x, y = near_pairs(p, None if one else q, chord)
        if one:
            x, y = x[x != y], y[x != y]
        close = np.concatenate([np.einsum("ij,ij->i", p[x[i : i + 65536]], q[y[i : i + 65536]]) for i in range(0, x.size, 65536)] or [np.zeros(0)]) >= threshold
        x, y = x[close], y[close]
        np.add.at(links_left, x, copies_right[y])
        np.add.at(links_left if one else links_right, y, copies_left[x])
        for i, j in zip(x.tolist(), (y if one else y + len(left)).tolist(), strict=True):
            root_i, root_j = top(i), top(j)
            if root_i != root_j:
                parent[root_i] = root_j
                edges.append((i, j))
        names = left["node"].to_list() + ([] if one else right["node"].to_list())
        links = links_left if one else np.concatenate([links_left, links_right])
        linked = np.flatnonzero(links)
        return pd.DataFrame(
            {
                "a": pd.Series([names[i] for i in linked] + [names[i] for i, _ in edges], dtype=object),
                "b": pd.Series([None] * linked.size + [names[j] for _, j in edges], dtype=object),
                "links": pd.Series(links[linked].tolist() + [0] * len(edges), dtype=np.int64),
            }
        )

    found = cut_lineage(tasks.groupBy("label", "a", "b").applyInPandas(run, "a string, b string, links long"), "links")
    links = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    roots = components(found.where("b is not null"), "a", "b")
    known = nodes.select("node", "first", "copies").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = known.groupBy("root").agg(F.min("first").alias("component_id"))
    named = known.join(smallest, "root").join(links.withColumnRenamed("a", "node"), "node", "left")
    named = named.select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.select("key", "node").join(named, "node", "left")
    own = F.when(F.col("node").isNotNull(), F.col("component_id")).otherwise(F.col("key"))
    return out.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(own == F.col("key"), own.isNull()).alias("kept"))
