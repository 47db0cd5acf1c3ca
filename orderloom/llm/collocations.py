"""Phrase collocations: words that stand together more often than their parts would let expect.

Counting every n-gram of a corpus needs a table of all of them, nearly all rare. Instead, texts are dealt into blocks of one language; a
block's n-grams, with their counts, go to hash partitions. There the blocks' summaries merge into one Misra-Gries summary whose
capacity exceeds the partition's mass over the threshold, so an n-gram that occurs ``least`` times or more has a counter left. What
survives goes back to its blocks; a second pass over their texts counts survivors by their words, exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.llm.common import cut_large_rows, cut_lineage, partitions, small_batches
from orderloom.llm.words import LOWER, sequence_hash, span_hashes, spans, text_hash

#: The bytes that end a piece, and those that part its words.
MARKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
LONGEST = 3
#: Bytes of text in a block; a longer text is a block of its own.
BLOCK = 1 << 20
#: Words numbered at once: three numbers fit one 64-bit code.
SLICE = 1 << 19
#: A summary loses at most a part in so many of the threshold, so what it keeps is nearly what is frequent.
SLACK = 4
#: Bits of an n-gram's key in its hash partition.
KEY = 24
#: Parts of a language that are ranked by themselves first.
DEALT = 16
#: Bytes of text per hash partition, so that a task's part of the n-grams stays of one size at any size of the corpus.
PART = 4 << 20

_INSIDE = np.array([b not in MARKS + BLANKS for b in range(256)])
_MARK = np.array([b in MARKS for b in range(256)])


class Summary:
    """Misra-Gries: counters that miss at most ``lost`` occurrences of a key each; ``lost`` <= mass / (capacity + 1)."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = max(capacity, 1), 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._rows = 0

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Another summary that lost nothing."""
        self._waiting.append((keys, counts))
        self._rows += keys.size
        if self._rows > self.capacity:
            self.settle()

    def settle(self) -> None:
        """Add up the counters of equal keys; beyond the capacity take the largest that does not fit off all of them."""
        keys = np.concatenate([self.keys, *(k for k, _ in self._waiting)])
        counts = np.concatenate([self.counts, *(c.astype(np.int64) for _, c in self._waiting)])
        self._waiting, self._rows = [], 0
        if not keys.size:
            return
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, counts = keys[first], np.add.reduceat(counts[order], first)
        if (over := keys.size - self.capacity) > 0:
            cut = int(np.partition(counts, over - 1)[over - 1])
            keys, counts, self.lost = keys[counts > cut], counts[counts > cut] - cut, self.lost + cut
        self.keys, self.counts = keys, counts

    def survivors(self, least: int) -> np.ndarray:
        """Keys, sorted, that may occur ``least`` times: all that do are among them."""
        self.settle()
        return self.keys[self.counts + self.lost >= least]


class Grams(NamedTuple):
    """Distinct n-grams of one length in a slice: hash, numbers of their words, count; and the bytes where each number's word lies."""

    hashes: np.ndarray
    words: list[np.ndarray]
    counts: np.ndarray
    places: np.ndarray


def _grams(text: bytes, seed: np.uint64, longest: int) -> Iterator[Grams]:
    """The n-grams of a block, by slices and lengths; those that begin in a slice are counted with it.

    Numbers of words are exact up to equal 64-bit hashes of different words of one slice.
    """
    data = np.frombuffer(text, np.uint8)
    starts, ends = spans(data, _INSIDE)
    hashes = span_hashes(text, starts, ends)
    piece = np.searchsorted(np.flatnonzero(_MARK[data]), starts)
    for at in range(0, starts.size, SLICE):
        upto = min(at + SLICE, starts.size)
        part = slice(at, min(upto + longest - 1, starts.size))
        values, numbers = np.unique(hashes[part], return_inverse=True)
        places = np.zeros((values.size, 2), np.int64)
        places[numbers, 0], places[numbers, 1] = starts[part], ends[part]
        own, base = piece[part], np.int64(values.size)
        code = np.zeros(upto - at, np.int64)
        for k in range(1, longest + 1):
            heads = min(upto - at, own.size - k + 1)
            if heads <= 0:
                break
            code = code[:heads] * base + numbers[k - 1 : k - 1 + heads]
            codes, counts = np.unique(code[own[:heads] == own[k - 1 : k - 1 + heads]], return_counts=True)
            words = []
            for _ in range(k):
                words.insert(0, codes % base)
                codes = codes // base
            yield Grams(sequence_hash([values[w] for w in words], seed), words, counts, places)


def _blocks(parts: Iterator, size: int) -> Iterator[tuple[str, bytes]]:
    """Texts of a task as blocks of one language, joined by a mark."""
    waiting: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for part in parts:
        for lang, text in zip(part.column("lang").to_pylist(), part.column("text"), strict=True):
            body = (text.as_py() or b"").translate(LOWER)
            waiting.setdefault(lang, []).append(body)
            sizes[lang] = sizes.get(lang, 0) + len(body) + 1
            while sizes and (sizes.get(lang, 0) > size or sum(sizes.values()) > 4 * size):
                full = max(sizes, key=sizes.get)
                del sizes[full]
                yield full, b"\n".join(waiting.pop(full))
    for lang, texts in waiting.items():
        yield lang, b"\n".join(texts)


def _numbered(hashes: np.ndarray, deal: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash partition of each n-gram, by the upper half of its hash, and its key there, KEY bits of the lower half.

    Counts of different n-grams with equal keys add up in a summary: a few more survive, none is lost.
    """
    return ((hashes >> np.uint64(32)) * np.uint64(deal) >> np.uint64(32)).astype(np.int32), (hashes & np.uint64((1 << KEY) - 1)).astype(np.uint32)


def _packed(keys: np.ndarray) -> bytes:
    """Three bytes a key."""
    return keys.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    keys = np.zeros((len(data) // 3, 4), np.uint8)
    keys[:, :3] = np.frombuffer(data, np.uint8).reshape(-1, 3)
    return keys.view("<u4")[:, 0]


def _gathered(texts: DataFrame, size: int) -> DataFrame:
    """``block``, ``lang`` and ``text`` of the blocks."""

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for lang, text in _blocks(parts, size):
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([lang]), pa.array([text], pa.binary())], names=["block", "lang", "text"])
            number += 1

    return texts.mapInArrow(run, "block long, lang string, text binary")


def _dealt(blocks: DataFrame, deal: int, longest: int) -> DataFrame:
    """Per block and hash partition the block's n-grams with their counts: a summary that lost nothing."""

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
        for batch in parts:
            for block, lang, text in zip(batch.column("block").to_pylist(), batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                found = list(_grams(text.as_py(), text_hash(lang), longest))
                if not found:
                    continue
                part, keys = _numbered(np.concatenate([f.hashes for f in found]), deal)
                counts = np.concatenate([f.counts for f in found]).astype(np.uint32)
                order = np.argsort(part, kind="stable")
                part, keys, counts = part[order], keys[order], counts[order]
                first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
                rows = [(block, int(part[a]), _packed(keys[a:b]), counts[a:b].tobytes()) for a, b in zip(first, [*first[1:], part.size], strict=True)]
                for begin in range(0, len(rows), 256):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[begin : begin + 256], strict=True), schema, strict=True)], schema=schema)

    return blocks.mapInArrow(run, "block long, part int, keys binary, counts binary")


def _surviving(dealt: DataFrame, deal: int, least: int) -> DataFrame:
    """Per block and hash partition the keys of the block's n-grams that survive in the partition's summary."""

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa

        held: dict[int, list[tuple[int, bytes, bytes]]] = {}
        for batch in parts:
            for begin in range(0, batch.num_rows, 64):
                for block, part, keys, counts in zip(*(batch.column(c).slice(begin, 64).to_pylist() for c in ("block", "part", "keys", "counts")), strict=True):
                    held.setdefault(part, []).append((block, keys, counts))
        survives = np.zeros(1 << KEY, bool)
        while held:
            part, rows = held.popitem()
            mass = sum(int(np.frombuffer(c, np.uint32).sum()) for _, _, c in rows)
            summary = Summary(SLACK * mass // least + 1)
            for _, keys, counts in rows:
                summary.merge(_unpacked(keys), np.frombuffer(counts, np.uint32))
            kept = summary.survivors(least)
            survives[kept] = True
            for block, data, _ in rows:
                keys = _unpacked(data)
                if (own := keys[survives[keys]]).size:
                    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([part], pa.int32()), pa.array([_packed(own)], pa.binary())], names=["block", "part", "keys"])
            survives[kept] = False

    return dealt.repartitionById(deal, "part").mapInArrow(run, "block long, part int, keys binary")


def _recount(blocks: DataFrame, deal: int, longest: int) -> DataFrame:
    """Occurrences, in each block, of the n-grams that survive, by their words; and the block's words, as those of a phrase of no words."""

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        def out(lang, words, phrases, counts):
            size = len(phrases)
            arrays = [pa.repeat(pa.scalar(lang, pa.string()), size), pa.repeat(pa.scalar(words, pa.int32()), size), phrases, pa.array(counts, pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["lang", "words", "phrase", "f"])

        for batch in parts:
            for lang, text, kept in zip(batch.column("lang").to_pylist(), batch.column("text"), batch.column("kept"), strict=True):
                body, total = text.as_py(), 0
                keys = [_unpacked(k["keys"]).astype(np.uint64) | np.uint64(k["part"] << KEY) for k in kept.as_py() or []]
                wanted = np.sort(np.concatenate([*keys, np.zeros(0, np.uint64)]))
                for found in _grams(body, text_hash(lang), longest):
                    total += int(found.counts.sum()) if len(found.words) == 1 else 0
                    part, keys = _numbered(found.hashes, deal)
                    own = part.astype(np.uint64) << np.uint64(KEY) | keys
                    at = np.searchsorted(wanted, own)
                    mine = np.flatnonzero((at < wanted.size) & (wanted[np.minimum(at, wanted.size - 1)] == own)) if wanted.size else np.zeros(0, np.int64)
                    used = np.unique(np.concatenate([w[mine] for w in found.words]))
                    names = pa.array([body[a:b] for a, b in found.places[used].tolist()], pa.binary())
                    for begin in range(0, mine.size, 1 << 16):
                        some = mine[begin : begin + (1 << 16)]
                        phrases = pc.binary_join_element_wise(*(names.take(pa.array(np.searchsorted(used, w[some]))) for w in found.words), b" ")
                        yield out(lang, len(found.words), phrases, found.counts[some])
                yield out(lang, 0, pa.array([b""], pa.binary()), [total])

    found = blocks.mapInArrow(run, "lang string, words int, phrase binary, f long")
    return found.select("lang", "words", F.col("phrase").cast("string").alias("phrase"), "f")


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10, longest: int = LONGEST, size: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``longest`` words that occur ``least`` times or more in a language, and every language's words.

    The first frame has ``lang``, ``words`` (of the phrase), ``phrase`` and ``f``; the second ``lang`` and ``n``. Both read one written
    table. Null texts are empty, null languages are ``und``, texts are read whole, repeated rows count as often as they come.
    An empty table gives empty frames.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").cast("binary").alias("text"))
    volume = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    deal = max(partitions(spark), -(-volume // PART))
    with small_batches(spark):
        blocks = cut_large_rows(_gathered(texts, size), "blocks")
    kept = _surviving(_dealt(blocks, deal, longest), deal, least).groupBy("block").agg(F.collect_list(F.struct("part", "keys")).alias("kept"))
    again = blocks.join(kept.hint("merge"), "block", "left").select("lang", "text", "kept")
    counted = _recount(again, deal, longest).groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))
    with small_batches(spark):
        counted = cut_lineage(counted.where((F.col("words") == 0) | (F.col("f") >= least)), "phrases")
    return counted.where("words > 0"), counted.where("words = 0").select("lang", F.col("f").alias("n"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10, share: int = 50, first: int = 2000) -> DataFrame:
    """Each language's ``first`` phrases of two or three words: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    ``a`` is the phrase's count, ``l`` and ``r`` those of the parts of its worst cut, ``n`` the language's words and ``score`` a million
    times a * a / (l * r), rounded down. A phrase goes if a longer one that holds it has ``share`` percent of its count. Ranks follow score, count, then the
    phrase in byte order, so ties have one order. See :func:`frequent_phrases` for nulls, repeated rows and empty tables.
    """
    counted, totals = frequent_phrases(docs, text, lang, least)
    parts = counted.where(F.col("words") < LONGEST)
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = counted.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"), cut)
    cuts = cuts.select("*", F.expr("substring_index(phrase, ' ', k)").alias("left"), F.expr("substring_index(phrase, ' ', k - words)").alias("right"))
    left = parts.select(F.col("lang").alias("_ll"), F.col("phrase").alias("_lp"), F.col("f").alias("l"))
    right = parts.select(F.col("lang").alias("_rl"), F.col("phrase").alias("_rp"), F.col("f").alias("r"))
    found = cuts.join(left, (F.col("lang") == F.col("_ll")) & (F.col("left") == F.col("_lp"))).join(right, (F.col("lang") == F.col("_rl")) & (F.col("right") == F.col("_rp")))
    wide = "decimal(38,0)"
    score = F.expr(f"cast(cast(1000000 as {wide}) * cast(cast(a as {wide}) * a as {wide}) as {wide}) div cast(cast(l as {wide}) * r as {wide})")
    worst = found.select("*", score.alias("score")).groupBy("lang", "words", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("worst"))
    held = cuts.where(F.col("words") == LONGEST).select("lang", F.when(F.col("k") == 1, F.col("right")).otherwise(F.col("left")).alias("phrase"), "a")
    held = held.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = worst.join(held, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    # First in DEALT parts of each language, so that the last step sees no more rows than these keep, however many tasks there are.
    order = [F.desc("worst.score"), F.desc("a"), F.asc("phrase")]
    part = Window.partitionBy("lang", "dealt").orderBy(*order)
    few = kept.select("lang", "phrase", "a", "worst", F.pmod(F.xxhash64("phrase"), F.lit(DEALT)).alias("dealt"))
    few = few.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= first)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "worst.l", "worst.r", "n", "worst.score")
