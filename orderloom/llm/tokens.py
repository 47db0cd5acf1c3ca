"""Texts to pieces of token ids, in one pass over the texts."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.bpe import SLICE, _worker


class Vocabulary(NamedTuple):
    """Token bytes to id, and the literals that are one token wherever a text holds them."""

    ranks: dict[bytes, int]
    added: dict[str, int]


def _added(path: str, entries: list[dict]) -> dict[str, int]:
    """Added tokens of a tokenizer file; those that the library and tiktoken find in other places raise ValueError."""
    added = {entry["content"]: entry["id"] for entry in entries if entry["content"]}
    if flags := {flag for entry in entries for flag in ("lstrip", "rstrip", "single_word", "normalized") if entry.get(flag)}:
        raise ValueError(f"{path}: added tokens with {', '.join(sorted(flags))}")
    # Of two that begin at one place the library takes the longer, tiktoken any.
    if any(a != b and b.startswith(a) for a in added for b in added):
        raise ValueError(f"{path}: an added token begins with another")
    return added


def ranks_of(spark: SparkSession, path: str) -> Vocabulary:
    """Tokens of a byte-level BPE tokenizer file (JSON of the tokenizers library), its added tokens included.

    Its merges must be in the order of the ids they make, as rank files require; else the ids would differ: ValueError.
    """
    if "://" in path:
        text = spark.read.text(path, wholetext=True).first()[0]
    else:
        with open(path, encoding="utf-8") as file:
            text = file.read()
    spec = json.loads(text)
    model = spec["model"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"][a + b] for a, b in merges]
    if made != sorted(made):
        raise ValueError(f"{path}: the merges are not in the order of their ids")
    # Printable Latin-1 characters stand for themselves, the other bytes for the characters from 256 on, in order.
    plain = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    others = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    parts = {token for merge in merges for token in merge} | {a + b for a, b in merges} | set(byte)
    return Vocabulary({bytes(byte[c] for c in token): model["vocab"][token] for token in parts}, _added(path, spec.get("added_tokens") or []))


def token_pieces(
    docs: DataFrame, ranks: Vocabulary, pattern: str, longest: int = 1024, end_id: int | None = 2, text: str = "text", width: int = 4
) -> DataFrame:
    """One row per piece of at most ``longest`` tokens: the other columns of ``docs``, ``piece``, ``start``, ``length``, ``ids``.

    ``ids`` are little-endian unsigned numbers of ``width`` bytes. Only texts of more tokens are cut; then all pieces but the first are
    full. Null and empty texts have the end id alone, and no piece if there is none. An added token is found inside texts, too. Texts are read whole,
    rows one by one; repeated rows give equal pieces. Columns named like an output are replaced.
    """
    made = ["piece", "start", "length", "ids"]
    own = [c for c in docs.columns if c not in (*made, text)]
    shared = docs.sparkSession.sparkContext.broadcast((*ranks, pattern))
    key = ("tokens", pattern, *(hash(frozenset(ids.items())) for ids in ranks))
    types = (("piece", "int"), ("start", "long"), ("length", "long"), ("ids", "binary"))
    schema = docs.select(*own, *[F.lit(None).cast(kind).alias(name) for name, kind in types]).schema

    def build():
        import tiktoken

        ranks, added, pattern = shared.value
        return tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)

    def run(parts: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        encoding = _worker(key, build)
        for whole in parts:
            for begin in range(0, whole.num_rows, SLICE):
                part = whole.slice(begin, SLICE)
                rows, piece, start, length, ids = [], [], [], [], []
                for row, body in enumerate(part.column(text).to_pylist()):
                    tokens = encoding.encode(body or "", allowed_special="all", disallowed_special=())
                    if end_id is not None:
                        tokens.append(end_id)
                    data, cut = np.array(tokens, dtype=f"<u{width}"), 0
                    while cut < data.size:
                        stop = cut + ((data.size - cut - 1) % longest + 1)
                        rows.append(row)
                        piece.append(piece[-1] + 1 if cut else 0)
                        start.append(cut)
                        length.append(stop - cut)
                        ids.append(data[cut:stop].tobytes())
                        cut = stop
                taken = part.take(pa.array(rows, pa.int32()))
                arrays = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays([*(taken.column(c) for c in own), *arrays], names=[*own, *made])

    return docs.select(*dict.fromkeys([*own, text])).mapInArrow(run, schema)
