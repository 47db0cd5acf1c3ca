"""N-gram Jaccard join by a count-vector R-tree: near duplicates on word shingles, exactly.

Each text is a set of hashed shingles. Shingles are hashed into groups; the counts per group are a point. For two points the sum of coordinate
minima bounds the overlap of the sets, and for two boxes of points the sum of the minima of their upper corners does, so an R-tree
of such boxes drops pairs of nodes, then pairs of points, that cannot reach the threshold; the pairs left are verified on the sets.

In many dimensions boxes of unrelated texts overlap, so one tree over all rows compares nearly all pairs of like size. The rows are
therefore parted first, without loss: sets within the threshold differ in at most D shingles (D by size class), so if a size class uses more than D
groups, two such sets agree in all members of some group. Sets that share a group's content are a bucket; equal buckets count once. A tree over the
points of each bucket leaves the pairs that may link; what these connect is a block, most often one group of near duplicates. Then each block has a tree
of its own and the pairs it leaves are verified on the sets. Equal sets are one node, however many texts have them. A large bucket or block is cut into tiles,
leaves at the top of its tree, of bounded size; pairs of tiles that pass the box test are separate tasks, and a task returns a forest, not all its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import cut_lineage, partitions
from orderloom.llm.components import components
from orderloom.llm.shingles import digest, mix, shingle_set

DIMENSIONS = 64
GROWTH = 1.6
SPREAD = 1.5
TILE = 1024
MET = 1_000_000
LEAF = 16
#: Stands for any count as high: bounds stay bounds.
FULL = 32767
ENDLESS = 1 << 24


def _classes(largest: int) -> np.ndarray:
    """Lower ends of the size classes, beyond ``largest``."""
    ends = [1]
    while ends[-1] <= largest:
        ends.append(max(ends[-1] + 1, int(ends[-1] * GROWTH)))
    return np.array(ends)


def signatures(members: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of the group contents of a set, one family of groups per size class it can meet a partner in.

    A pair belongs to the class of its larger set. A set that differs from any partner in D members at most keeps its D + 1 largest groups and
    those of the same size as the last of them. Of two partners take the one whose smallest kept group is the larger: one of its kept groups is equal in
    both, so the other keeps it, too. Only where that group would be empty in both this fails; such rare sets share a mark of their own.
    """
    n = members.size
    if not n:
        return np.zeros(0, dtype=np.int64)
    most = n * 100 // percent
    ends, out = _classes(most), []
    first, last = np.searchsorted(ends, [n, most], side="right") - 1
    for band in range(first, last + 1):
        top = int(ends[band + 1]) - 1
        if not (100 - percent) * 2 * top // (100 + percent):
            continue  # only equal sets are that close
        differ = (100 - percent) * (n + min(most, top)) // (100 + percent)
        groups = int(SPREAD * ((100 - percent) * 2 * top // (100 + percent) + 1)) + 3
        salted = mix(members + np.uint64((int(band) + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        group = (salted >> np.uint64(32)) % np.uint64(groups)
        order = np.argsort(group, kind="stable")
        begin = np.flatnonzero(np.concatenate([[True], np.diff(group[order]) > 0]))
        content = np.add.reduceat(salted[order], begin)
        sizes = np.diff(np.append(begin, n))
        least = np.sort(sizes)[-differ - 1] if sizes.size > differ else 0
        out.append(mix(content + (group[order][begin] + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))[sizes >= least])
        if not least:
            out.append(np.array([int(band) << 16], dtype=np.uint64))
    # 48 bits: a chance agreement only makes a bucket larger.
    return (np.concatenate(out) >> np.uint64(16)).view(np.int64) if out else np.zeros(0, dtype=np.int64)


def counts(members: np.ndarray) -> np.ndarray:
    """The point of a set: members per group, FULL for that many or more."""
    group = (mix(members ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(58)).astype(np.int64)
    return np.minimum(np.bincount(group, minlength=DIMENSIONS), FULL).astype(np.int16)


def text_hash(text: str = "text") -> Column:
    """What tells texts under one key apart, the first 16 bytes of their SHA-256; null for null."""
    return F.substring(F.unhex(F.sha2(F.col(text).cast("binary"), 256)), 1, 16)


def _sets(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """Per row: key, hash of its text, set size, digest and point of the set."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("_text"), text_hash(text).alias("hash"))
    own = ["key", "hash"]
    schema = rows.select(*own, F.lit(0).cast("long").alias("n"), F.lit(b"").alias("node"), F.array().cast("array<smallint>").alias("point")).schema

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in parts:
            for start in range(0, whole.num_rows, 512):
                part = whole.slice(start, 512)
                sets = [shingle_set(body, words) for body in part.column("_text").to_pylist()]
                points = pa.array(np.concatenate([counts(x) for x in sets]), pa.int16())
                offsets = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * DIMENSIONS)
                arrays = [pa.array([x.size for x in sets], pa.int64()), pa.array([digest(x) for x in sets], pa.binary()), pa.ListArray.from_arrays(offsets, points)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in own), *arrays], names=[*own, "n", "node", "point"])

    return rows.mapInArrow(run, schema)


def _marks(docs: DataFrame, text: str, words: int, percent: int) -> DataFrame:
    """Digest and signatures of the sets; a set that a task has met before is skipped, so copies leave it once."""

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa

        met: set[bytes] = set()
        for whole in parts:
            for start in range(0, whole.num_rows, 512):
                nodes, marks = [], []
                for body in whole.column(0).slice(start, 512).to_pylist():
                    members = shingle_set(body, words)
                    node = digest(members)
                    if members.size and node not in met:
                        if len(met) >= MET:
                            met.clear()
                        met.add(node)
                        nodes.append(node)
                        marks.append(signatures(members, percent))
                offsets = np.concatenate([[0], np.cumsum([m.size for m in marks])]).astype(np.int32)
                flat = np.concatenate([*marks, np.zeros(0, np.int64)])
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["node", "marks"])

    return docs.select(F.col(text).alias("_text")).mapInArrow(run, "node binary, marks array<long>")


def _members(docs: DataFrame, wanted: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """``wanted`` (key and hash of one of its texts, node and more) with the sets of the nodes; keys may be shared or null."""
    texts = docs.select(F.col(key).alias("_key"), text_hash(text).alias("_hash"), F.col(text).alias("_text"))
    # Merged at every size: below the broadcast threshold a small run would not show what a large one moves.
    carried = wanted.columns
    texts = texts.hint("merge").join(wanted, (F.col("_hash") == F.col("hash")) & F.col("_key").eqNullSafe(F.col("key"))).select(*carried, "_text")

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in parts:
            for start in range(0, whole.num_rows, 512):
                part = whole.slice(start, 512)
                sets = [shingle_set(body, words).tobytes() for body in part.column("_text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carried), pa.array(sets, pa.binary())], names=[*carried, "members"])

    return texts.mapInArrow(run, wanted.select("*", F.lit(b"").alias("members")).schema)


def _tiles(members: DataFrame) -> DataFrame:
    """``members`` with ``tile``: 0 in small blocks; in others ranges of ``rank`` with about TILE members each."""
    sizes = members.groupBy("block").agg(F.count("*").alias("_rows"), F.percentile_approx("rank", [i / 256 for i in range(1, 256)], 10000).alias("_cuts"))
    sizes = sizes.where(F.col("_rows") > TILE)
    tiles = F.ceil(F.col("_rows") / TILE)
    # Ranges between 255 quantiles, each dealt further by hash where a block has more tiles than that.
    span = F.size(F.filter("_cuts", lambda c: c < F.col("rank")))
    coarse = F.when(tiles <= 256, F.floor(span * tiles / 256)).otherwise(
        span * F.ceil(tiles / 256) + F.pmod(F.xxhash64("node"), F.ceil(tiles / 256))
    )
    return members.join(sizes, "block", "left").withColumn("tile", F.coalesce(coarse, F.lit(0)).cast("long")).drop("_rows", "_cuts")


def _tile_pairs(tiled: DataFrame, percent: int) -> DataFrame:
    """Pairs of tiles of a block whose boxes can hold a link: block, a, b (a <= b)."""
    top = [F.max(F.col("point")[g]).cast("long") for g in range(DIMENSIONS)]
    corner = [F.when(c == FULL, F.lit(ENDLESS)).otherwise(c).alias(f"c{g}") for g, c in enumerate(top)]
    boxes = tiled.groupBy("block", "tile").agg(F.min("n").alias("least"), F.max("n").alias("most"), *corner)
    boxes = cut_lineage(boxes.select("block", "tile", "least", "most", F.array(*[f"c{g}" for g in range(DIMENSIONS)]).alias("corner")), "boxes")
    a, b = boxes.alias("a"), boxes.alias("b")
    bound = F.aggregate(F.zip_with("a.corner", "b.corner", lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda s, x: s + x)
    near = (
        (F.col("a.block") == F.col("b.block"))
        & (F.col("a.tile") <= F.col("b.tile"))
        & (100 * F.col("a.most") >= percent * F.col("b.least"))
        & (100 * F.col("b.most") >= percent * F.col("a.least"))
        & ((100 + percent) * bound >= percent * (F.col("a.least") + F.col("b.least")))
    )
    return a.join(b, near).select(F.col("a.block").alias("block"), F.col("a.tile").alias("a"), F.col("b.tile").alias("b"))


def link(nodes: list, sizes: np.ndarray, points: np.ndarray, sets: list[np.ndarray] | None, left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple]:
    """A forest of the links between the rows ``left`` and ``right`` (equal for one tile), by dual traversal of two trees.

    Without ``sets`` the pairs that the bound leaves count as links.
    """
    parent = list(range(len(nodes)))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def leaves(rows: np.ndarray) -> list[np.ndarray]:
        order = rows[np.lexsort((points[rows, : DIMENSIONS // 2].sum(1), sizes[rows]))]
        return [order[i : i + LEAF] for i in range(0, order.size, LEAF)]

    one = left is right
    a, b = leaves(left), leaves(left if one else right)
    tops_a, tops_b = np.stack([points[x].max(0) for x in a]), np.stack([points[x].max(0) for x in b])
    least_a, least_b = np.array([sizes[x].min() for x in a]), np.array([sizes[x].min() for x in b])
    forest = []
    for i, own in enumerate(a):
        bound = np.minimum(tops_a[i], tops_b).sum(1)
        for j in np.flatnonzero((100 + percent) * bound >= percent * (least_a[i] + least_b)):
            if one and j < i:
                continue
            other = b[j]
            overlap = np.minimum(points[own][:, None], points[other][None]).sum(2)
            both = sizes[own][:, None] + sizes[other][None]
            for x, y in zip(*np.nonzero((100 + percent) * overlap >= percent * both), strict=True):
                p, q = int(own[x]), int(other[y])
                if p == q or (root_p := top(p)) == (root_q := top(q)):
                    continue
                common = int(overlap[x, y]) if sets is None else np.intersect1d(sets[p], sets[q], assume_unique=True).size
                if 100 * common >= percent * (int(both[x, y]) - common):
                    parent[root_p] = root_q
                    forest.append((nodes[p], nodes[q]))
    return forest


def _links(members: DataFrame, percent: int, sets: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Links (a, b) between the nodes of each block, by points or, given how to fetch them, by sets.

    Tiles that may hold a link are joined with their members and streamed in order of block and tile pair; a task holds one pair at a time.
    """
    spark, verified = members.sparkSession, sets is not None
    tiled = cut_lineage(_tiles(members), "tiles")
    large = tiled.join(tiled.where("tile > 0").select("block").distinct(), "block", "left_semi")
    pairs = cut_lineage(_tile_pairs(large, percent), "pairs")
    sides = pairs.select("block", "a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("tile"))
    columns = ["block", "a", "b", "tile", "node", "n", "point", *(["key", "hash"] if verified else [])]
    zero = F.lit(0).cast("long")
    single = tiled.join(large.select("block").distinct(), "block", "left_anti").select("*", zero.alias("a"), zero.alias("b"))
    rows = single.select(*columns).union(large.join(sides, ["block", "tile"]).select(*columns))
    rows = sets(rows) if sets else rows
    dealt = rows.repartition(partitions(spark), "block", "a", "b").sortWithinPartitions("block", "a", "b")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list = []

        def done() -> list[tuple]:
            # Rows of docs that are repeated whole bring their set as often.
            group = (pd.concat(held) if len(held) > 1 else held[0]).drop_duplicates(["tile", "node"])
            tile, a, b = group["tile"].to_numpy(), group["a"].iloc[0], group["b"].iloc[0]
            left = np.flatnonzero(tile == a)
            right = left if a == b else np.flatnonzero(tile == b)
            points = np.stack(group["point"].to_numpy()).astype(np.int32)
            points[points == FULL] = ENDLESS
            whole = [np.frombuffer(x, np.uint64) for x in group["members"]] if verified else None
            return link(group["node"].tolist(), group["n"].to_numpy(), points, whole, left, right, percent)

        key, forest = None, []
        for part in parts:
            ids = part[["block", "a", "b"]].to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]).any(1)])) if len(part) else []
            for start, stop in zip(cuts, [*cuts[1:], len(part)], strict=True):
                if held and tuple(ids[start]) != key:
                    forest += done()
                    held.clear()
                key = tuple(ids[start])
                held.append(part.iloc[start:stop])
            if len(forest) > 10_000:
                yield pd.DataFrame(forest, columns=["a", "b"], dtype=object)
                forest = []
        if held:
            forest += done()
        yield pd.DataFrame(forest, columns=["a", "b"], dtype=object)

    kind = members.schema["node"].dataType.simpleString()
    return dealt.mapInPandas(run, f"a {kind}, b {kind}")


def _roots(docs: DataFrame, nodes: DataFrame, key: str, text: str, words: int, percent: int) -> DataFrame:
    """``root`` of the component per node, with the other columns of ``nodes`` (node, key, hash, n, point and more)."""
    # Along the rank: size, then members in half the groups, then chance; distinct for distinct sets.
    half = F.aggregate(F.slice("point", 1, DIMENSIONS // 2), F.lit(0), lambda s, x: s + x.cast("int"))
    chance = F.pmod(F.xxhash64("node"), F.lit(1 << 20)) / (1 << 20)
    own = [c for c in nodes.columns if c not in ("n", "point")]
    nodes = cut_lineage(nodes.select(*own, "n", "point", (F.col("n") + (half + chance) / (F.col("n") + 1)).alias("rank"), F.xxhash64("node").alias("short")), "nodes")

    marks = _marks(docs, text, words, percent).select(F.xxhash64("node").alias("short"), F.explode("marks").alias("mark")).where("mark is not null")
    dealt = marks.repartition(partitions(docs.sparkSession), "mark")
    buckets = dealt.groupBy("mark").agg(F.min("short").alias("_low"), F.max("short").alias("_high"), F.sum(F.col("short").cast("decimal(38,0)")).alias("_sum"), F.count("*").alias("_rows"))
    buckets = buckets.where("_low != _high").groupBy("_low", "_high", "_sum", "_rows").agg(F.min("mark").alias("mark")).select("mark")
    shared = cut_lineage(dealt.join(buckets, "mark").distinct(), "buckets")
    lean = shared.join(nodes.select("short", "n", "point", "rank"), "short").select(F.col("mark").alias("block"), F.col("short").alias("node"), "n", "rank", "point")
    maybe = components(_links(lean, percent), "a", "b")
    plain = nodes.select("node", "key", "hash", "n", "point", "rank", "short")
    wanted = plain.join(maybe.select(F.col("node").alias("short"), F.col("root").alias("block")), "short").drop("short")
    wanted = cut_lineage(wanted, "wanted")

    # Only now, and only for candidates, the sets: made from the texts where these meet their tiles.
    found = components(_links(wanted, percent, lambda rows: _members(docs, rows, key, text, words)), "a", "b")
    return nodes.select(*own).join(found, "node", "left").select(*own, F.coalesce("root", "node").alias("root"))


def _nodes(table: DataFrame) -> DataFrame:
    """A row per distinct set, with the key and hash of the first text that has it."""
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "hash")).alias("first")
    nodes = table.where("n > 0").groupBy("node").agg(first, F.min("n").alias("n"), F.any_value("point").alias("point"))
    return nodes.select("node", "first.key", "first.hash", "n", "point", "first")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, percent: int = 90) -> DataFrame:
    """Per row of ``docs``: the key, ``n_shingles`` and ``component_id``, the smallest key reachable by links, its own included.

    Two texts link when 100 * overlap >= percent * union of their shingle sets. Null and empty texts, and those without words, have no shingles and
    no links; their component is their own key. Repeated rows and texts with equal sets share a component. A null key counts as larger than any
    other; a component of null keys only has a null id. Texts are read whole; an empty table stays empty; other columns play no part.
    """
    table = cut_lineage(_sets(docs, key, text, words), "sets")
    roots = _roots(docs, _nodes(table), key, text, words, percent)
    smallest = roots.groupBy("root").agg(F.min("key").alias("component_id"))
    named = roots.join(smallest, "root").select("node", "component_id")
    out = table.select("key", "n", "node").join(named, "node", "left")
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"))


def jaccard_firsts(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, percent: int = 90) -> DataFrame:
    """Per component of :func:`jaccard_components` the key and the ``text_hash`` of one row: the smallest key, null last, then the smallest hash.

    Components are told apart by their sets, not by their ids, so keys may be shared or null. Texts without shingles are each a component of their own,
    those under equal keys with equal texts once.
    """
    table = cut_lineage(_sets(docs, key, text, words), "sets")
    roots = _roots(docs, _nodes(table), key, text, words, percent)
    firsts = roots.groupBy("root").agg(F.min("first").alias("first")).select("first.key", "first.hash")
    alone = table.where("n = 0").select("key", "hash").distinct()
    return firsts.union(alone).select(F.col("key").alias(key), F.col("hash").alias("text_hash"))
