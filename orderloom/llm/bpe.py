"""Exact byte-level BPE, linear in the text: longest tokens first, backing up where two neighbours would have merged otherwise.

A row of tokens is what the merges give exactly if each token comes out of its own bytes and each two neighbours come out of
their joined bytes. So the encoder walks a piece with the longest token at each place (an Aho-Corasick automaton over the bytes
as Latin-1 finds them all in one pass), asks whether it may stand after the token before it (answers are kept), falls back
to the token's longest prefix that is a token, and marks places from which nothing fits so that none is tried twice.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAIRS_KEPT = 1_000_000
PIECES_KEPT = 500_000
LONGEST_KEPT = 64
SLICE = 256


def load_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Token bytes to rank from a rank file of the driver or, with a scheme, of any store that Spark reads."""
    if "://" in path:
        lines = [row.value for row in spark.read.text(path).toLocalIterator()]
    else:
        with open(path, encoding="ascii") as file:
            lines = list(file)
    return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


class Encoder:
    """Encodes pieces of text; what it remembers is bounded by the constants above."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.token = {rank: token for token, rank in ranks.items()}
        self.size = {rank: len(token) for token, rank in ranks.items()}
        self.found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in ranks.items():
            self.found.add_word(token.decode("latin-1"), rank)
        self.found.make_automaton()
        self.shorter: dict[int, int] = {}
        self.fits: dict[int, bool] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}

    def merged(self, data: bytes) -> list[int]:
        """The merges done one by one: the definition, used on one or two tokens at a time."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], sys.maxsize))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[p] for p in parts]

    def follows(self, left: int, right: int) -> bool:
        """Whether ``right`` may stand after ``left`` (-1: at the start)."""
        want = [right] if left < 0 else [left, right]
        known = self.merged(b"".join([self.token[t] for t in want])) == want
        if len(self.fits) >= PAIRS_KEPT:
            self.fits.clear()
        self.fits[left << 32 | right] = known
        return known

    def prefix(self, rank: int) -> int:
        """The longest proper prefix of a token that is a token; -1 if there is none."""
        token = self.token[rank]
        cuts = (self.ranks.get(token[:n], -1) for n in range(len(token) - 1, 0, -1))
        self.shorter[rank] = found = next((r for r in cuts if r >= 0), -1)
        return found

    def piece(self, text: str) -> tuple[int, ...]:
        data = text.encode("utf-8")
        whole = self.ranks.get(data)
        if whole is not None:
            return (whole,)
        size, fits, shorter, total = self.size, self.fits, self.shorter, len(data)
        longest = [-1] * (total + 1)
        for end, rank in self.found.iter(data.decode("latin-1")):
            longest[end + 1 - size[rank]] = rank  # of the matches from one place, the longest ends last
        shut: set[int] = set()
        out: list[int] = []
        at, candidate, left = 0, longest[0], -1
        while at < total:
            while candidate >= 0:
                end = at + size[candidate]
                if end not in shut:
                    fit = fits.get(left << 32 | candidate)
                    if fit or (fit is None and self.follows(left, candidate)):
                        break
                step = shorter.get(candidate)
                candidate = self.prefix(candidate) if step is None else step
            if candidate >= 0:
                out.append(candidate)
                at, left, candidate = end, candidate, longest[end]
            else:
                shut.add(at)
                candidate = out.pop()
                at -= size[candidate]
                left = out[-1] if out else -1
        return tuple(out)

    def ids(self, text: str) -> array:
        out, known = array("i"), self.pieces
        for piece in self.pattern.findall(text):
            tokens = known.get(piece)
            if tokens is None:
                tokens = self.piece(piece)
                if len(piece) <= LONGEST_KEPT:
                    if len(known) >= PIECES_KEPT:
                        known.clear()
                    known[piece] = tokens
            out.extend(tokens)
        return out

    def text(self, ids) -> bytes:
        return b"".join([self.token[i] for i in ids])


def _worker(key: tuple, make):
    """One instance per Python worker process, whatever the number of its tasks."""
    kept = sys.__dict__.setdefault("_orderloom_kept", {})
    if key not in kept:
        kept.clear()
        kept[key] = make()
    return kept[key]


def round_trip(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = "decoded", keep_text: bool = True
) -> DataFrame:
    """``docs`` with the token ids of each text and, unless ``decoded`` is None, the bytes these decode to.

    Null and empty texts give an empty list and empty bytes. Rows are encoded one by one and whole; repeated rows give
    the same ids; an empty table stays empty. Columns named like an output are replaced. The ranks, whose size is that
    of the vocabulary, are broadcast.
    """
    session = docs.sparkSession
    made = [c for c in (ids, decoded) if c]
    own = [c for c in docs.columns if c not in made and (keep_text or c != text)]
    shared = session.sparkContext.broadcast((ranks, pattern))
    key = ("bpe", pattern, len(ranks), hash(frozenset(ranks.items())))
    extra = [F.array().cast("array<int>").alias(ids), *([F.lit(b"").cast("binary").alias(decoded)] if decoded else [])]

    def run(parts: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        encoder = _worker(key, lambda: Encoder(*shared.value))
        for whole in parts:
            for start in range(0, whole.num_rows, SLICE):
                part = whole.slice(start, SLICE)
                lists = [encoder.ids(t or "") for t in part.column(text).to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
                flat = np.concatenate([np.frombuffer(x, np.int32) for x in lists]) if lists else np.zeros(0, np.int32)
                columns = [part.column(c) for c in own] + [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]
                if decoded:
                    columns.append(pa.array([encoder.text(x) for x in lists], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[*own, *made])

    needed = list(dict.fromkeys([*own, text]))
    return docs.select(*needed).mapInArrow(run, docs.select(*own, *extra).schema)
