"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A feature is the presence of an n-gram of 3 to 7 characters in the lower-cased text, white space runs as one blank,
hashed to 2**20 places. Training takes a bounded sample of labelled rows (``max_rows``, by hash of the key), counts in how many
texts of either class each feature occurs, keeps the ``max_features`` that tell the classes apart best, scales each by its
log-count ratio and fits a logistic regression on them. Texts are read whole, long ones in blocks with overlap.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import cut_lineage

BITS = 20
LENGTHS = (3, 4, 5, 6, 7)
BLOCK = 1 << 20
SAMPLE_TASKS = 8
#: Rows of a batch that are scored and sent on at once.
SLICE = 512


@dataclass(frozen=True)
class Model:
    """``places`` of the features kept, their weight (log-count ratio times coefficient) and the intercept."""

    places: np.ndarray
    weights: np.ndarray
    intercept: float


def _distinct(places: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each value once, in linear time: the last to write its place stays."""
    order = np.arange(places.size, dtype=np.int32)
    at[places] = order
    return places[at[places] == order]


def features(text: str | None, at: np.ndarray) -> np.ndarray:
    """Distinct places of the text's n-grams; ``at`` is scratch space of 2**BITS numbers."""
    body = " " + " ".join((text or "").lower().split()) + " "
    points = np.frombuffer(body.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    found = []
    for start in range(0, max(points.size - min(LENGTHS) + 1, 0), BLOCK):
        part = points[start : start + BLOCK + max(LENGTHS) - 1].astype(np.uint64)
        rolling, grams = np.zeros(part.size, dtype=np.uint64), []
        for k in range(min(max(LENGTHS), part.size)):
            head = part.size - k
            rolling = rolling[:head] * np.uint64(0x9E3779B97F4A7C15) + part[k:]
            if k + 1 in LENGTHS:
                salted = (rolling ^ (rolling >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * k)
                grams.append((salted >> np.uint64(64 - BITS)).astype(np.int32)[:BLOCK])
        found.append(_distinct(np.concatenate(grams), at))
    if not found:
        return np.zeros(0, dtype=np.int32)
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def _sample(labels: DataFrame, key: str, label: str, max_rows: int) -> DataFrame:
    """About ``max_rows`` labelled rows at most, those with the smallest hash of the key."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).select(
        F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")
    )
    total = max(known.count(), 1)
    slot = F.pmod(F.xxhash64(F.col("_key").cast("string"), F.lit(77)), F.lit(1 << 30))
    return known.where(slot < int((1 << 30) * min(1.0, 0.9 * max_rows / total) + 1)).limit(max_rows)


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", max_rows: int = 6000, max_features: int = 1500
) -> Model:
    """Train on the rows of ``labels`` (key, label) whose texts are in ``docs``.

    Rows with a null key or label are left out; repeated rows count as often as they come. Without rows of both classes
    the model has no features and a neutral intercept of the class share (0.5 for an empty table).
    """
    sample = cut_lineage(_sample(labels, key, label, max_rows), "toxicity-labels")
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(sample, "_key")
    texts = cut_lineage(texts.select("_text", "_label"), "toxicity-sample").repartition(SAMPLE_TASKS)

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, seen, rows = np.zeros(1 << BITS, np.int32), np.zeros((2, 1 << BITS), np.float32), [0, 0]
        for part in parts:
            for body, kind in zip(part["_text"], part["_label"] > 0, strict=True):
                seen[int(kind), features(body, at)] += 1
                rows[int(kind)] += 1
        # Nearly all counts are 0 or 1: packed, a task's answer is some hundred kilobytes.
        packed = [zlib.compress(s.astype(np.uint32).tobytes(), 1) for s in seen]
        yield pd.DataFrame({"clean": [packed[0]], "toxic": [packed[1]], "n_clean": [rows[0]], "n_toxic": [rows[1]]})

    counts, n = np.zeros((2, 1 << BITS), np.float32), np.zeros(2)
    for row in texts.mapInPandas(count, "clean binary, toxic binary, n_clean long, n_toxic long").toLocalIterator():
        for kind, name in enumerate(("clean", "toxic")):
            counts[kind] += np.frombuffer(zlib.decompress(row[name]), np.uint32)
        n += (row["n_clean"], row["n_toxic"])
    if not n.all():
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log((n[1] + 1) / (n[0] + 1))))

    share = (counts + 1) / (n[:, None] + 2).astype(np.float32)
    ratio = np.log(share[1] / (1 - share[1])) - np.log(share[0] / (1 - share[0]))
    both = (counts.sum(0) + 1) / (n.sum() + 2)
    contrast = np.abs(share[1] - share[0]) / np.sqrt(both * (1 - both) * (1 / n).sum())
    contrast[counts.sum(0) < 3] = 0
    places = np.sort(np.argsort(-contrast, kind="stable")[:max_features])
    places = places[contrast[places] > 3.0]

    def chosen(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, rank = np.zeros(1 << BITS, np.int32), np.full(1 << BITS, -1, np.int16)
        rank[places] = np.arange(places.size)
        for part in parts:
            kept = [rank[features(body, at)] for body in part["_text"]]
            yield pd.DataFrame({"ranks": [np.sort(k[k >= 0]).tobytes() for k in kept], "label": (part["_label"] > 0).astype(int)})

    del counts, share, both, contrast
    rows = texts.mapInPandas(chosen, "ranks binary, label int").collect()
    x, y = np.zeros((len(rows), places.size), np.float32), np.array([r["label"] for r in rows], np.float64)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["ranks"], np.int16)] = 1
    scale = ratio[places].astype(np.float32)
    x *= scale
    coefficients, intercept = _regression(x, y)
    return Model(places, coefficients * scale, intercept)


def _regression(x: np.ndarray, y: np.ndarray, ridge: float = 2e-4, steps: int = 250) -> tuple[np.ndarray, float]:
    """Logistic regression by Adam on the whole sample, classes weighted towards balance by the root of their odds."""
    weight = np.where(y > 0, np.sqrt((y < 1).sum() / max(y.sum(), 1)), 1.0)
    weight /= weight.sum()
    w, b = np.zeros(x.shape[1]), 0.0
    m, v = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    for t in range(1, steps + 1):
        gap = (1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32) + b, -40, 40))) - y) * weight
        slope = np.append(gap.astype(np.float32) @ x + ridge * w, gap.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        move = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` with a double column ``into`` from 0 to 1; replaces a column of that name.

    Null and empty texts get the score of the intercept. Every row is scored by its text alone, so repeated rows score
    alike; an empty table stays empty. The model is sent to the tasks once; its size is bound by ``max_features``.
    """
    session, own = docs.sparkSession, [c for c in docs.columns if c != into]
    shared = session.sparkContext.broadcast((model.places, model.weights, model.intercept))
    schema = docs.select(*own, F.lit(0.0).alias(into)).schema

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa

        places, weights, intercept = shared.value
        table, at = np.zeros(1 << BITS), np.zeros(1 << BITS, np.int32)
        table[places] = weights
        for whole in parts:
            for begin in range(0, whole.num_rows, SLICE):
                part = whole.slice(begin, SLICE)
                sums = np.array([table[features(body, at)].sum() for body in part.column(text).to_pylist()], dtype=np.float64)
                values = 1 / (1 + np.exp(-np.clip(sums + intercept, -700, 700)))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in own), pa.array(values)], names=[*own, into])

    return docs.select(*dict.fromkeys([*own, text])).mapInArrow(run, schema)


def held_out(key: str = "doc_id"):
    """Whether a row is kept from training: crc32 of the key as text leaves 0 modulo 5. Null keys are not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))
