"""Suffix-array dedup: remove every byte that a repeated string of ``width`` bytes covers.

A dense suffix array holds one suffix per byte. This one is sparse but loses nothing: each window of ``width`` bytes is filed under its anchor, the
place in it whose gram has the smallest hash, so equal windows are filed under equal grams at equal distances. Consecutive windows with
one anchor form a run; the array holds one suffix per run, about one for 80 bytes.

The suffixes are range-partitioned by their leading bytes, gram and content at splitters that Spark samples, so equal ones are neighbours. A task sorts its
bucket by multikey quicksort: by the first word, then ties by the next, dropping what is alone. Suffixes that touch the end of a
bucket are compared with those beyond it. A run whose whole content recurs is repeated. A run that shares only its gram may still be repeated in part:
the windows of such runs, one run per content, go through the same array once more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import cut_lineage, partitions

GRAM = 40
_TABLE = np.random.Generator(np.random.PCG64(20260101)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
SAMPLE = 20_000
MANY = 20_000
SUFFIX = "part int, key long, content long, doc long, at long, upto long"
SORTED = "key long, content long, doc long, at long, upto long, whole boolean, first boolean, kinds long, edge boolean"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Prints:
    """Hashes of any substring of ``data`` in constant time each, from sums of byte values times powers of an odd base."""

    def __init__(self, data: np.ndarray, base: int):
        self.back = np.full(data.size + 1, pow(base, -1, 1 << 64), dtype=np.uint64)
        powers = np.full(data.size + 1, base, dtype=np.uint64)
        powers[0] = self.back[0] = 1
        powers, self.back = np.multiply.accumulate(powers), np.multiply.accumulate(self.back)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * powers[:-1], dtype=np.uint64)])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mix((self.sums[stop] - self.sums[start]) * self.back[start])


def _sliding_least(values: np.ndarray, span: int) -> np.ndarray:
    """Minimum of each ``span`` neighbours, from running minima of blocks of that length in both directions."""
    count = values.size - span + 1
    padded = np.full(-(-values.size // span) * span, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: values.size] = values
    blocks = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[span - 1 : span - 1 + count])


def _leading(data: np.ndarray, at: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Sort key of the suffixes at the anchors: their first three bytes, then 40 bits of their gram's hash, in order as signed numbers."""
    head = (data[at].astype(np.uint64) << np.uint64(56)) | (data[at + 1].astype(np.uint64) << np.uint64(48)) | (data[at + 2].astype(np.uint64) << np.uint64(40))
    return ((head | (hashes >> np.uint64(24))) ^ np.uint64(1 << 63)).view(np.int64)


def runs(data: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Sort key, content, first window and last window of each run."""
    if data.size < width:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    gram = min(GRAM, width)
    places = np.arange(data.size - gram + 1)
    prints = Prints(data, _BASES[0])
    hashes = prints.of(places, places + gram)
    mask = np.uint64((1 << int(data.size).bit_length()) - 1)
    least = _sliding_least((hashes & ~mask) | (mask - places.astype(np.uint64)), width - gram + 1)
    anchor = (mask - (least & mask)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    last = np.append(first[1:], anchor.size) - 1
    anchor = anchor[first]
    content = Prints(data, _BASES[1]).of(first, last + width) + (anchor - first).astype(np.uint64) * np.uint64(_BASES[0]) + (last - first).astype(np.uint64)
    return _leading(data, anchor, hashes[anchor]), _mix(content).view(np.int64), first, last


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8"), dtype=np.uint8)


def tied(*words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey sort: the rows that agree with another in all words, in order, and where a new group begins.

    Sorts by the first word, then what is tied by the next one; rows that are alone leave at once.
    """
    rows, group = np.arange(words[0].size), np.zeros(words[0].size, np.int64)
    for word in words:
        order = np.lexsort((word[rows], group))
        rows, group = rows[order], group[order]
        value = word[rows]
        new = np.ones(rows.size, bool)
        new[1:] = (group[1:] != group[:-1]) | (value[1:] != value[:-1])
        group = np.cumsum(new)
        alone = new.copy()
        alone[:-1] &= new[1:]
        rows, group = rows[~alone], group[~alone]
    new = np.ones(rows.size, bool)
    new[1:] = group[1:] != group[:-1]
    return rows, new


def _part(splitters: list[np.ndarray], words: list[np.ndarray]) -> np.ndarray:
    """Bucket of each row: how many splitters are not above it, compared word by word."""
    low, high = np.searchsorted(splitters[0], words[0], "left"), np.searchsorted(splitters[0], words[0], "right")
    if len(words) > 1:
        for begin, end in {(int(a), int(b)) for a, b in zip(low[low < high], high[low < high], strict=True)}:
            rows = np.flatnonzero((low == begin) & (high == end))
            high[rows] = begin + _part([s[begin:end] for s in splitters[1:]], [w[rows] for w in words[1:]])
    return high


def _salt(doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Order among equal suffixes, so that very common ones spread over buckets."""
    return _mix(doc.astype(np.int64).view(np.uint64) + at.astype(np.uint64) * np.uint64(_BASES[1])).view(np.int64)


def _suffixes(rows: DataFrame, width: int, splitters: list[np.ndarray]) -> DataFrame:
    """One row per run of each text, with its bucket."""
    shared = rows.sparkSession.sparkContext.broadcast(splitters)

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa

        names = [c.split()[0] for c in SUFFIX.split(", ")]
        for whole in parts:
            for start in range(0, whole.num_rows, 256):
                part = whole.slice(start, 256)
                docs = part.column(0).to_numpy(zero_copy_only=False)
                found = [runs(_bytes(t), width) for t in part.column(1).to_pylist()]
                key, content, at, upto = (np.concatenate([f[i] for f in found]) for i in range(4))
                doc = np.repeat(docs, [f[0].size for f in found])
                bucket = _part(shared.value, [key, content, _salt(doc, at)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (bucket, key, content, doc, at, upto)], names=names)

    return rows.select("doc", "_text").mapInArrow(run, SUFFIX)


def _splitters(rows: DataFrame, width: int, buckets: int) -> list[np.ndarray]:
    """Bucket borders from the suffixes of about SAMPLE texts; they balance the buckets and do not change the result."""
    share = min(1.0, SAMPLE / max(rows.count(), 1))
    some = rows.where(F.pmod("doc", F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    none = [np.zeros(0, np.int64)] * 3
    thin = _suffixes(some, width, none).where(F.pmod(F.xxhash64("doc", "at"), F.lit(64)) == 0).limit(10 * SAMPLE)
    sample = thin.select("key", "content", "doc", "at").toPandas()
    words = [sample["key"].to_numpy(), sample["content"].to_numpy(), _salt(sample["doc"].to_numpy(np.int64), sample["at"].to_numpy(np.int64))]
    order = np.lexsort(words[::-1])
    picks = order[np.linspace(0, order.size, buckets + 1).astype(int)[1:-1]] if order.size else order
    return [w[picks].astype(np.int64) for w in words]


def _sorted(suffixes: DataFrame, buckets: int) -> DataFrame:
    """What is not alone with its key, per bucket: whether its whole content recurs, whether it is the first with its content, and how many
    contents the key has. Of keys that touch the end of a bucket each content comes once, marked ``edge``, with its number of rows as ``kinds``.
    """

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa

        held = [p for p in parts if p.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        key, content, doc, at, upto = (table.column(c).to_numpy() for c in ("key", "content", "doc", "at", "upto"))
        rows, new = tied(key)
        inner = rows[(key[rows] != key.min()) & (key[rows] != key.max())]
        ends = np.flatnonzero((key == key.min()) | (key == key.max()))
        ends = ends[np.lexsort((at[ends], doc[ends], content[ends], key[ends]))]
        # Of the suffixes equal in content at the ends one stands for all, with their number; the others are repeated by it.
        stands = np.ones(ends.size, bool)
        stands[1:] = (key[ends][1:] != key[ends][:-1]) | (content[ends][1:] != content[ends][:-1])
        number = np.diff(np.append(np.flatnonzero(stands), ends.size))
        others, ends = ends[~stands], ends[stands]
        whole = np.zeros(key.size, bool)
        same, _ = tied(key, content)
        whole[same] = True
        order = inner[np.lexsort((at[inner], doc[inner], content[inner], key[inner]))]
        first = np.ones(order.size, bool)
        first[1:] = (key[order][1:] != key[order][:-1]) | (content[order][1:] != content[order][:-1])
        group = np.cumsum(np.concatenate([[True], key[order][1:] != key[order][:-1]])) - 1 if order.size else np.zeros(0, np.int64)
        kinds = np.bincount(group, weights=first)[group].astype(np.int64) if order.size else np.zeros(0, np.int64)
        no, none = np.zeros(key.size, bool), np.zeros(key.size, np.int64)
        for pick, w, f, k, edge in ((order, whole[order], first, kinds, False), (others, ~no[others], no[others], none[others], False), (ends, no[ends], no[ends], number, True)):
            arrays = [key[pick], content[pick], doc[pick], at[pick], upto[pick], w, f, k, np.full(pick.size, edge)]
            for start in range(0, pick.size, 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(a[start : start + 100_000]) for a in arrays], names=[c.split()[0] for c in SORTED.split(", ")])

    return suffixes.repartitionById(buckets, "part").mapInArrow(run, SORTED)


def _across(edges: DataFrame) -> DataFrame:
    """Decide the suffixes at bucket ends by counts over all buckets."""
    contents = edges.groupBy("key", "content").agg(F.sum("kinds").alias("_n"), F.min(F.struct("doc", "at")).alias("_first"))
    keys = contents.groupBy("key").agg(F.sum("_n").alias("_all"), F.count("*").alias("_kinds")).where("_all > 1")
    known = contents.join(keys, "key")
    out = edges.select("key", "content", "doc", "at", "upto").join(known, ["key", "content"])
    return out.select(
        "key", "content", "doc", "at", "upto", (F.col("_n") > 1).alias("whole"), ((F.col("doc") == F.col("_first.doc")) & (F.col("at") == F.col("_first.at"))).alias("first"),
        F.col("_kinds").alias("kinds"), F.lit(False).alias("edge"),
    )


def _windows(data: np.ndarray, at: np.ndarray, count: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``count`` windows from each place on, and the run each belongs to."""
    run = np.repeat(np.arange(at.size), count)
    start = np.repeat(at - np.cumsum(count) + count, count) + np.arange(run.size)
    return Prints(data, _BASES[1]).of(start, start + width).view(np.int64), run


def _partly(rows: DataFrame, runs_left: DataFrame, width: int) -> DataFrame:
    """Repeated windows (doc, at, upto) of the runs of ``runs_left`` whose content is single: they recur in a run of the same key."""
    spark = rows.sparkSession
    wanted = runs_left.groupBy("doc").agg(F.collect_set(F.struct("key", "at", "upto", "whole", "kinds")).alias("runs"))
    texts = rows.join(wanted, "doc")

    def contents(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for start in range(0, len(part), 64):
                out = []
                for doc, text, found in part.iloc[start : start + 64][["doc", "_text", "runs"]].itertuples(index=False):
                    data = _bytes(text)
                    out += [(r["key"], doc, r["at"], r["upto"], not r["whole"], r["kinds"], data[r["at"] : r["upto"] + width].tobytes()) for r in found]
                yield pd.DataFrame(out, columns=["key", "doc", "at", "upto", "open", "kinds", "data"])

    runs_of = cut_lineage(texts.mapInPandas(contents, "key long, doc long, at long, upto long, open boolean, kinds long, data binary"), "contents")

    def local(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [p for p in parts if len(p)]
        if not held:
            return
        group = pd.concat(held)
        sizes = np.array([len(d) for d in group["data"]])
        count, begin = sizes - width + 1, np.concatenate([[0], np.cumsum(sizes)[:-1]])
        prints, run = _windows(np.frombuffer(b"".join(group["data"]), np.uint8), begin, count, width)
        hits, _ = tied(group["key"].to_numpy()[run], prints)
        hits = np.sort(hits[group["open"].to_numpy(bool)[run[hits]]])
        place = group["at"].to_numpy()[run] + np.arange(run.size) - np.repeat(np.cumsum(count) - count, count)
        yield _merged(group["doc"].to_numpy()[run[hits]], place[hits], width)

    def spread(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            sizes = np.array([len(d) for d in part["data"]])
            count, begin = sizes - width + 1, np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
            if not len(part):
                continue
            prints, run = _windows(np.frombuffer(b"".join(part["data"]), np.uint8), begin, count, width)
            place = part["at"].to_numpy()[run] + np.arange(run.size) - np.repeat(np.cumsum(count) - count, count)
            yield pd.DataFrame({"key": part["key"].to_numpy()[run], "print": prints, "doc": part["doc"].to_numpy()[run], "at": place, "open": part["open"].to_numpy()[run]})

    few = runs_of.where(F.col("kinds") <= MANY).repartition(partitions(spark), "key").mapInPandas(local, "doc long, at long, upto long")
    # Keys with very many contents: counted window by window with partial sums, so that no task holds them all.
    wide = runs_of.where(F.col("kinds") > MANY).mapInPandas(spread, "key long, print long, doc long, at long, open boolean")
    again = wide.groupBy("key", "print").agg(F.count("*").alias("_n")).where("_n > 1").select("key", "print")
    many = wide.join(again, ["key", "print"], "left_semi").where("open").select("doc", "at", (F.col("at") + width).alias("upto"))
    return few.union(many)


def _merged(doc: np.ndarray, at: np.ndarray, width: int) -> pd.DataFrame:
    """Windows as spans, neighbours joined."""
    order = np.lexsort((at, doc))
    doc, at = doc[order], at[order]
    new = np.ones(at.size, bool)
    new[1:] = (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + 1)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], at.size) - 1 if at.size else begin
    return pd.DataFrame({"doc": doc[begin], "at": at[begin], "upto": at[end] + width})


def repeated_spans(docs: DataFrame, row: str, text: str = "text", width: int = 200) -> DataFrame:
    """``doc`` (the column ``row``, a whole number that tells rows apart) with the array ``spans`` of places (at, upto) that repeated strings cover.

    Spans may overlap. Rows without any are absent.
    """
    buckets = partitions(docs.sparkSession)
    rows = docs.select(F.col(row).alias("doc"), F.col(text).alias("_text"))
    suffixes = _suffixes(rows, width, _splitters(rows, width, buckets))
    array = cut_lineage(_sorted(suffixes, buckets), "suffixes")
    edges = cut_lineage(_across(array.where("edge")), "edges")
    found = array.where("not edge").unionByName(edges)
    whole = found.where("whole").select("doc", "at", (F.col("upto") + width).alias("upto"))
    left = found.where("kinds > 1 and first")
    spans = whole.union(_partly(rows, left, width))
    return spans.groupBy("doc").agg(F.collect_set(F.struct("at", "upto")).alias("spans"))


def suffix_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 200, as_text: bool = False) -> DataFrame:
    """``docs`` with ``n_bytes``, ``spans`` (maximal removed runs of bytes, start and end), ``n_removed`` and ``kept`` (bytes left, joined).

    With ``as_text`` what is left is a string, without the parts of characters that a border cut through.

    Null and empty texts have no bytes and none are removed. Repeated rows repeat each other: all their windows go. Rows are told apart by a
    64-bit hash of key and text; rows equal in both are treated alike. Strings never cross texts, are judged on the input, and texts of any
    length are read whole. An empty table stays empty. Columns named like an output are replaced.
    """
    made = (("n_bytes", "long"), ("spans", "array<struct<start:long,end:long>>"), ("n_removed", "long"), ("kept", "string" if as_text else "binary"))
    own = [c for c in docs.columns if c not in dict(made)]
    named = docs.select(*own, F.xxhash64(F.col(key).cast("string"), F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("_row"))
    spans = repeated_spans(named, "_row", text, width).withColumnRenamed("doc", "_row")
    schema = docs.select(*own, *[F.lit(None).cast(kind).alias(name) for name, kind in made]).schema

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in parts:
            for begin in range(0, whole.num_rows, 256):
                part = whole.slice(begin, 256)
                sizes, lists, removed, kept = [], [], [], []
                for body, found in zip(part.column(text).to_pylist(), part.column("_spans").to_pylist(), strict=True):
                    data = (body or "").encode("utf-8")
                    runs_out, left, done = [], [], 0
                    for span in sorted(found or [], key=lambda s: s["at"]):
                        if runs_out and span["at"] <= runs_out[-1]["end"]:
                            runs_out[-1]["end"] = max(runs_out[-1]["end"], span["upto"])
                        else:
                            runs_out.append({"start": span["at"], "end": span["upto"]})
                    for r in runs_out:
                        left.append(data[done : r["start"]])
                        done = r["end"]
                    left.append(data[done:])
                    sizes.append(len(data))
                    lists.append(runs_out)
                    rest = b"".join(left)
                    kept.append(rest.decode("utf-8", "ignore") if as_text else rest)
                    removed.append(len(data) - len(rest))
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                arrays = [pa.array(sizes, pa.int64()), pa.array(lists, kind), pa.array(removed, pa.int64()), pa.array(kept, pa.string() if as_text else pa.binary())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in own), *arrays], names=[*own, *dict(made)])

    joined = named.join(spans.withColumnRenamed("spans", "_spans"), "_row", "left")
    return joined.select(*own, "_spans").mapInArrow(run, schema)
