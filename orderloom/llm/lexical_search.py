"""Ranked lexical search over an index by length: the best documents for each query, by whole-number term weights.

A document's normaliser ``m`` is a whole number made of its length. Documents of equal m form a stratum, cut into blocks; in a block a
term's postings lie by falling tf. As a posting's impact hangs on tf and m alone, a block computes it once per tf, and a term's first posting
bounds what the term can give anywhere in the block. A query visits blocks by falling bound and leaves out those whose bound is below
its worst result so far. Every text is read whole and every row with a term is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from orderloom.llm.common import cut_large_rows, cut_lineage, partitions, small_batches
from orderloom.llm.words import LOWER, span_hashes, spans

#: The normaliser of a document of average length, and how many hundredths of it follow the length.
NORM, SLOPE = 100, 25
#: Documents and postings of a block; a longer document is a block of its own.
DOCS, POSTINGS = 4096, 1 << 19
#: Bytes of blocks that a task looks at together; the results so far go on to the next ones.
SLAB = 16 << 20
#: Terms of the queries that are searched at once.
QUERY_TERMS = 1 << 18
#: Bytes of texts that are tokenized at once.
TEXTS = 1 << 20

# Letters and digits of ASCII, and every byte of a longer character.
_INSIDE = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def _counted(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct term hashes and their counts, per text."""
    begin = 0
    while begin < len(texts):
        size, end = 0, begin
        while end < len(texts) and (end == begin or size + len(texts[end] or b"") <= TEXTS):
            size, end = size + len(texts[end] or b""), end + 1
        some = [(t or b"").translate(LOWER) for t in texts[begin:end]]
        body = b" ".join(some)
        starts, ends = spans(np.frombuffer(body, np.uint8), _INSIDE)
        hashes = span_hashes(body, starts, ends).view(np.int64)
        bounds = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in some]))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield np.unique(hashes[a:b], return_counts=True)
        begin = end


class Strata(NamedTuple):
    """Documents with a term, their terms in all, and the lengths at which the next shard begins."""

    documents: int
    length: int
    begins: np.ndarray

    def normalisers(self, n: np.ndarray) -> np.ndarray:
        return NORM - SLOPE + (SLOPE * n * self.documents) // max(self.length, 1)

    def shards(self, n: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Ranges of lengths; where a length begins several shards, its documents are dealt to all of them."""
        low, high = np.searchsorted(self.begins, n, side="left"), np.searchsorted(self.begins, n, side="right")
        return low + number % (high - low + 1)


def _lengths(rows: DataFrame) -> DataFrame:
    """``n``, the terms of each text that has any."""

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa

        for part in parts:
            n = np.array([int(spans(np.frombuffer(t.as_py() or b"", np.uint8), _INSIDE)[0].size) for t in part.column("_text")], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(n[n > 0])], names=["n"])

    return rows.select("_text").mapInArrow(run, "n long")


def _strata(rows: DataFrame, shards: int) -> Strata:
    """One pass over the texts; the shards hold about as many terms each, whatever the lengths."""
    cuts = [i / shards for i in range(1, shards)] or [0.5]
    measured = _lengths(rows).agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.percentile("n", cuts, F.col("n"))).first()
    return Strata(measured[0], measured[1], np.array(measured[2] if measured[2] and shards > 1 else [], np.float64))


def _tokenized(rows: DataFrame, strata: Strata | None = None) -> DataFrame:
    """``_key``, a ``number``, distinct ``terms`` (64-bit hashes) and ``tfs`` of every text that has a term; with strata ``m`` and ``shard``."""
    types = {"number": "long", "terms": "binary", "tfs": "binary"} | ({"m": "long", "shard": "int"} if strata else {})
    schema = rows.select("_key", *[F.lit(None).cast(kind).alias(name) for name, kind in types.items()]).schema

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        next_number = TaskContext.get().partitionId() << 33
        for part in parts:
            for begin in range(0, part.num_rows, 1024):
                some = part.slice(begin, 1024)
                found = list(_counted(some.column("_text").to_pylist()))
                n = np.array([int(c.sum()) for _, c in found], np.int64)
                own = np.flatnonzero(n)
                number = np.arange(next_number, next_number + own.size)
                next_number += own.size
                data = [pa.array([found[i][0].tobytes() for i in own], pa.binary()), pa.array([_narrow(found[i][1]) for i in own], pa.binary())]
                arrays = [some.column("_key").take(pa.array(own)), pa.array(number), *data]
                if strata:
                    arrays += [pa.array(strata.normalisers(n[own]), pa.int64()), pa.array(strata.shards(n[own], number), pa.int32())]
                yield pa.RecordBatch.from_arrays(arrays, names=["_key", *types])

    return rows.mapInArrow(run, schema)


def _narrow(numbers: np.ndarray) -> bytes:
    """One byte each if that holds them, else four; the number of bytes tells."""
    return numbers.astype(np.uint8 if numbers.max(initial=0) < 256 else np.uint32).tobytes()


def _widened(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8 if len(data) == count else np.uint32)


def _rows(batch, columns: Sequence[str], some: int = 128) -> Iterator[tuple]:
    """Rows of an Arrow batch, a few at a time, so that large values are not held twice."""
    for begin in range(0, batch.num_rows, some):
        part = batch.slice(begin, some)
        yield from zip(*(part.column(c).to_pylist() for c in columns), strict=True)


def _frequencies(blocks: DataFrame) -> DataFrame:
    """Documents per term: the lengths of its postings in all blocks."""

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa

        for part in parts:
            for terms, ends in _rows(part, ("terms", "ends"), 1):
                counts = np.diff(np.frombuffer(ends, np.uint32).astype(np.int64), prepend=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(terms, np.int64)), pa.array(counts)], names=["term", "df"])

    return blocks.select("terms", "ends").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


class Block(NamedTuple):
    """Documents of one stratum: ``terms`` with the end of their postings; per posting the document's place and its level in ``tfs``."""

    m: int
    docs: list
    terms: np.ndarray
    ends: np.ndarray
    tfs: np.ndarray
    level: np.ndarray
    place: np.ndarray

    def impacts(self) -> np.ndarray:
        """What a posting of each tf gives per unit of weight."""
        return (1_000_000_000 * self.tfs) // (1000 * self.tfs + 12 * self.m)


def _blocks(strata: DataFrame) -> DataFrame:
    """Strata in blocks, one row each; the rows of a task come by ``m``."""
    kind = strata.schema["_key"].dataType
    schema = T.StructType([T.StructField("m", T.LongType()), T.StructField("docs", T.ArrayType(kind))] + [T.StructField(c, T.BinaryType()) for c in ("terms", "ends", "tfs", "level", "place")])

    def block(m: int, docs: list, rows: list[tuple[np.ndarray, np.ndarray]]):
        import pyarrow as pa

        term = np.concatenate([t for t, _ in rows])
        tf = np.concatenate([c for _, c in rows]).astype(np.int64)
        place = np.repeat(np.arange(len(rows)), [t.size for t, _ in rows])
        order = np.lexsort((place, -tf, term))
        term, tf, place = term[order], tf[order], place[order]
        terms, first = np.unique(term, return_index=True)
        tfs, level = np.unique(tf, return_inverse=True)
        ends = np.append(first[1:], term.size).astype(np.uint32)
        level = level.astype(np.uint16 if tfs.size <= 1 << 16 else np.uint32)
        width = np.uint16 if len(rows) <= 1 << 16 else np.uint32
        data = [terms.tobytes(), ends.tobytes(), tfs.tobytes(), level.tobytes(), place.astype(width).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([m], pa.int64()), pa.array([docs], pa.list_(docs_type)), *(pa.array([d], pa.binary()) for d in data)], names=[f.name for f in schema])

    from pyspark.sql.pandas.types import to_arrow_type

    docs_type = to_arrow_type(kind)

    def run(parts: Iterator) -> Iterator:
        now, docs, rows, size = None, [], [], 0
        for whole in parts:
            for m, doc, terms, tfs in _rows(whole, ("m", "_key", "terms", "tfs")):
                if docs and (m != now or len(docs) >= DOCS or size + len(terms) // 8 > POSTINGS):
                    yield block(now, docs, rows)
                    docs, rows, size = [], [], 0
                now = m
                docs.append(doc)
                rows.append((np.frombuffer(terms, np.int64), _widened(tfs, len(terms) // 8)))
                size += len(terms) // 8
        if docs:
            yield block(now, docs, rows)

    return strata.mapInArrow(run, schema)


class Index(NamedTuple):
    """``blocks`` of postings, ``frequencies`` of terms, documents with a term and their terms in all."""

    blocks: DataFrame
    frequencies: DataFrame
    documents: int
    length: int


def build(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Index:
    """Index of every row of ``docs`` whose text has a term; null and empty texts have none, repeated rows are documents of their own.

    Terms are known by 64-bit hashes. Written tables; a stratum of any size is dealt over tasks.
    """
    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").cast("binary").alias("_text"))
    shards = partitions(docs.sparkSession)
    with small_batches(docs.sparkSession):
        strata = _strata(rows, shards)
        dealt = _tokenized(rows, strata).repartitionById(shards, "shard")
        blocks = cut_large_rows(_blocks(dealt.sortWithinPartitions(F.col("m"), F.col("_key").asc_nulls_last())), "index")
        return Index(blocks, cut_lineage(_frequencies(blocks), "frequencies"), strata.documents, strata.length)


class Queries(NamedTuple):
    """Distinct ``terms``, and one entry per query and term: the term's place there and its weight times its repeats."""

    numbers: list[int]
    terms: np.ndarray
    query: np.ndarray
    term: np.ndarray
    weight: np.ndarray


def _packed(rows: list[tuple[int, int, int]]) -> Queries:
    numbers = sorted({q for q, _, _ in rows})
    place = {q: i for i, q in enumerate(numbers)}
    terms, term = np.unique(np.array([t for _, t, _ in rows], np.int64), return_inverse=True)
    return Queries(numbers, terms, np.array([place[q] for q, _, _ in rows]), term, np.array([w for _, _, w in rows], np.int64))


def _in_turn(weighted: DataFrame) -> Iterator[Queries]:
    """The queries in groups of about QUERY_TERMS terms: what the driver holds at a time does not grow with their number."""
    rows: list[tuple[int, int, int]] = []
    for r in weighted.orderBy("query", "term").toLocalIterator():
        if len(rows) >= QUERY_TERMS and rows[-1][0] != r["query"]:
            yield _packed(rows)
            rows = []
        rows.append((r["query"], r["term"], r["weight"]))
    if rows:
        yield _packed(rows)


def _best(found: list[tuple[int, object]], first: int) -> list[tuple[int, object]]:
    return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0))[:first]


def _visit(block: Block, queries: Queries, entry: np.ndarray, begin: np.ndarray, end: np.ndarray, first: int) -> list[tuple[int, object]]:
    """The best documents of a block for the query of the entries; documents lie by key, so the first of equal scores are right."""
    scores, impacts = np.zeros(len(block.docs), np.int64), block.impacts()
    for e in entry:
        a, b = begin[queries.term[e]], end[queries.term[e]]
        scores[block.place[a:b]] += queries.weight[e] * impacts[block.level[a:b]]
    if (more := np.count_nonzero(scores)) > first:
        least = np.partition(scores, scores.size - first)[scores.size - first]
        places = np.concatenate([np.flatnonzero(scores > least), np.flatnonzero(scores == least)])[:first]
    else:
        places = np.flatnonzero(scores)[:more]
    return [(int(scores[p]), block.docs[p]) for p in places]


def _look(blocks: list[Block], queries: Queries, best: list[list], first: int) -> None:
    """Search a slab: per query by falling bound, until no block can give anything that would be kept."""
    count = len(queries.numbers)
    ranges, bounds = [], np.zeros((len(blocks), count), np.int64)
    for i, block in enumerate(blocks):
        at = np.minimum(np.searchsorted(block.terms, queries.terms), block.terms.size - 1)
        there = block.terms[at] == queries.terms
        begin = np.where(there, np.where(at > 0, block.ends[at - 1], 0), 0).astype(np.int64)
        end = np.where(there, block.ends[at], 0).astype(np.int64)
        top = np.where(there, block.impacts()[block.level[np.minimum(begin, block.level.size - 1)]], 0)
        np.add.at(bounds[i], queries.query, queries.weight * top[queries.term])
        ranges.append((begin, end, there))
    order = np.argsort(queries.query, kind="stable")
    edges = np.searchsorted(queries.query[order], np.arange(count + 1))
    for q in range(count):
        entries = order[edges[q] : edges[q + 1]]
        for i in np.argsort(-bounds[:, q], kind="stable"):
            if bounds[i, q] <= 0 or (len(best[q]) == first and bounds[i, q] < best[q][-1][0]):
                break
            begin, end, there = ranges[i]
            best[q] = _best(best[q] + _visit(blocks[i], queries, entries[there[queries.term[entries]]], begin, end, first), first)


def _searched(index: Index, queries: Queries, first: int) -> DataFrame:
    """Each task's best documents for every query: ``query``, ``_key``, ``score``."""
    spark = index.blocks.sparkSession
    shared = spark.sparkContext.broadcast(tuple(queries))
    kind = index.blocks.schema["docs"].dataType.elementType
    schema = T.StructType([T.StructField("query", T.LongType()), T.StructField("_key", kind), T.StructField("score", T.LongType())])
    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(kind)

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa

        asked = Queries(*shared.value)
        best: list[list] = [[] for _ in asked.numbers]
        slab, size = [], 0
        for part in parts:
            for row in (dict(zip(part.schema.names, values, strict=True)) for values in _rows(part, part.schema.names, 1)):
                documents, tfs = len(row["docs"]), np.frombuffer(row["tfs"], np.int64)
                ends = np.frombuffer(row["ends"], np.uint32)
                level = np.frombuffer(row["level"], np.uint16 if tfs.size <= 1 << 16 else np.uint32)
                place = np.frombuffer(row["place"], np.uint16 if documents <= 1 << 16 else np.uint32)
                slab.append(Block(row["m"], row["docs"], np.frombuffer(row["terms"], np.int64), ends, tfs, level, place))
                size += sum(len(row[c]) for c in ("terms", "ends", "level", "place"))
                if size >= SLAB:
                    _look(slab, asked, best, first)
                    slab, size = [], 0
        if slab:
            _look(slab, asked, best, first)
        found = [(asked.numbers[q], doc, score) for q, rows in enumerate(best) for score, doc in rows]
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], key_type), pa.array(columns[2], pa.int64())], names=["query", "_key", "score"])

    return index.blocks.mapInArrow(run, schema)


def search(spark: SparkSession, index: Index, items: DataFrame, item_key: str = "item_id", text: str = "text", key: str = "doc_id", first: int = 20) -> DataFrame:
    """The ``first`` best documents for each row of ``items``: ``item_key``, ``rank`` (int, from 1), ``key`` and ``score``.

    Documents without a term of the item are no results; equal scores go by ascending key, null keys last. A row of ``items`` that is
    repeated whole counts once, other rows of equal keys are items of their own; null and empty items find nothing. Empty tables give an empty frame.
    """
    asked = items.select(F.col(item_key).alias("_key"), F.col(text).cast("string").cast("binary").alias("_text")).distinct()
    asked = cut_lineage(_tokenized(asked), "items")

    def spread(parts: Iterator) -> Iterator:
        import pyarrow as pa

        for part in parts:
            for number, terms, tfs in _rows(part, ("number", "terms", "tfs")):
                term = np.frombuffer(terms, np.int64)
                repeats = _widened(tfs, term.size).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(term.size, number)), pa.array(term), pa.array(repeats)], names=["query", "term", "repeats"])

    terms = asked.select("number", "terms", "tfs").mapInArrow(spread, "query long, term long, repeats long")
    weight = F.floor(1000 * F.log((2 * F.lit(index.documents) + 2).cast("double") / (2 * F.col("df") + 1).cast("double")))
    weighted = terms.join(index.frequencies, "term").select("query", "term", (weight * F.col("repeats")).cast("long").alias("weight"))
    results = None
    for queries in _in_turn(cut_lineage(weighted, "queries")):
        with small_batches(spark):
            part = cut_lineage(_searched(index, queries, first), "results")
        results = part if results is None else results.union(part)
    if results is None:
        kind = index.blocks.schema["docs"].dataType.elementType
        results = spark.createDataFrame([], T.StructType([T.StructField("query", T.LongType()), T.StructField("_key", kind), T.StructField("score", T.LongType())]))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("_key").asc_nulls_last())
    ranked = results.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return ranked.join(asked.select(F.col("number").alias("query"), F.col("_key").alias("_item")), "query").select(F.col("_item").alias(item_key), "rank", F.col("_key").alias(key), "score")
