"""Quality by naive Bayes support vectors: n-gram indicators scaled by log-count ratios under a linear hinge-loss model.

Features are indicators, hashed to 2**18 places: n-grams of 1 to 4 bytes of the text (case kept, white space runs as one blank), of
one and two lower-cased words, and of the marks that tell whether a word was among the few before it. Each is scaled by the log ratio of its
smoothed shares in the two classes, each text to length one. The model is fitted by dual coordinate descent on a bounded sample of labelled rows;
margins of models that did not see a row turn into chances by a logistic curve. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import cut_lineage
from orderloom.llm.words import LOWER, span_hashes, spans

BITS = 18
#: Longest run of bytes, of words and of marks.
BYTES, WORDS, MARKS = 4, 2, 3
#: How many words before it a word is compared with.
BACK = 4
#: Bytes of a text that are looked at together; runs over the border are counted with the bytes before it.
BLOCK = 1 << 20
FOLDS = 3

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.array([b in b" \t\n\x0b\x0c\r" for b in range(256)])


@dataclass(frozen=True)
class Model:
    """``places`` of the features kept and their weights, and the curve from margin to chance: 1 / (1 + exp(-(slope * margin + shift)))."""

    places: np.ndarray
    weights: np.ndarray
    slope: float
    shift: float


def _place(value: np.ndarray, salt: int) -> np.ndarray:
    mixed = (value + np.uint64(salt)) * _ODD
    return ((mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BITS)).astype(np.int32)


def features(text: bytes | None, seen: np.ndarray) -> np.ndarray:
    """Distinct places of a text's features, sorted; ``seen`` is scratch space of 2**BITS times false, left as it was."""
    body = text or b""
    data = np.frombuffer(body, np.uint8)
    gap = _BLANK[data]
    # Of a run of white space its first byte stays, as a blank.
    kept = np.where(gap, np.uint8(32), data)[~gap | np.concatenate([[True], ~gap[:-1]])[: gap.size]]
    for start in range(0, kept.size, BLOCK):
        part = kept[start : start + BLOCK + BYTES - 1].astype(np.uint64)
        run = np.zeros(part.size, np.uint64)
        for n in range(1, min(BYTES, part.size) + 1):
            run = (run[: part.size - n + 1] << np.uint64(8)) | part[n - 1 :]
            seen[_place(run[:BLOCK], n << 40)] = True
    lowered = body.translate(LOWER)
    starts, ends = spans(np.frombuffer(lowered, np.uint8), ~_BLANK)
    word = span_hashes(lowered, starts, ends)
    run = np.zeros(word.size, np.uint64)
    for n in range(1, min(WORDS, word.size) + 1):
        run = run[: word.size - n + 1] * _ODD + word[n - 1 :]
        seen[_place(run, (BYTES + n) << 40)] = True
    again = np.zeros(word.size, np.uint64)
    for back in range(min(BACK, word.size - 1), 0, -1):
        again[back:][word[back:] == word[:-back]] = 1 + (back > 1)
    run = np.zeros(word.size, np.uint64)
    for n in range(1, min(MARKS, word.size) + 1):
        run = run[: word.size - n + 1] * np.uint64(3) + again[n - 1 :]
        seen[_place(run, (BYTES + WORDS + n) << 40)] = True
    found = np.flatnonzero(seen).astype(np.int32)
    seen[found] = False
    return found


def _sample(labels: DataFrame, key: str, label: str, max_rows: int) -> DataFrame:
    """The ``max_rows`` labelled rows with the smallest hash of the key."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).select(F.col(key).alias("_key"), (F.col(label) > 0).cast("int").alias("_label"))
    return known.orderBy(F.xxhash64(F.col("_key").cast("string"), F.lit(11)), "_key", "_label").limit(max_rows)


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = 5000, max_features: int = 1 << 16
) -> Model:
    """Train on the rows of ``labels`` (key, label) whose texts are in ``docs``.

    Of the labelled rows the ``max_rows`` with the smallest hash of the key are read; null keys and labels are left out, repeated rows of
    ``docs`` count as often as they come. Without rows of both classes the model has no features and gives the share of label 1 (0.5 for an empty table).
    """
    sample = cut_lineage(_sample(labels, key, label, max_rows), "quality-labels")
    texts = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").cast("binary").alias("_text")).join(sample, "_key")

    def places(parts: Iterator) -> Iterator:
        import pyarrow as pa

        seen = np.zeros(1 << BITS, bool)
        for part in parts:
            for body, kind in zip(part.column("_text"), part.column("_label").to_pylist(), strict=True):
                data = features(body.as_py(), seen)
                yield pa.RecordBatch.from_arrays([pa.array([data.tobytes()], pa.binary()), pa.array([kind], pa.int32())], names=["places", "label"])

    found = cut_lineage(texts.select("_text", "_label").mapInArrow(places, "places binary, label int"), "quality-sample")

    def train(parts: Iterator) -> Iterator:
        import pyarrow as pa

        rows, kinds = [], []
        for part in parts:
            rows += [np.frombuffer(x, np.int32) for x in part.column("places").to_pylist()]
            kinds += part.column("label").to_pylist()
        model = _trained(rows, np.array(kinds) > 0, max_features)
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (model.places, model.weights, np.array([model.slope, model.shift]))], names=["places", "weights", "curve"])

    # At most ``max_rows`` rows of hash places: a table of one size, whatever the corpus; the driver gets the model alone.
    ordered = found.coalesce(1).sortWithinPartitions("places", "label")
    model = ordered.mapInArrow(train, "places binary, weights binary, curve binary").first()
    if model is None:
        return Model(np.zeros(0, np.int32), np.zeros(0), 1.0, 0.0)
    slope, shift = np.frombuffer(model["curve"])
    return Model(np.frombuffer(model["places"], np.int32), np.frombuffer(model["weights"]), float(slope), float(shift))


def _trained(rows: list[np.ndarray], good: np.ndarray, max_features: int) -> Model:
    if not len(rows) or good.all() or not good.any():
        share = (good.sum() + 1) / (good.size + 2)
        return Model(np.zeros(0, np.int32), np.zeros(0), 1.0, float(np.log(share / (1 - share))))
    order = np.random.default_rng(11).permutation(len(rows))
    margins = np.zeros(len(rows))
    for fold in range(FOLDS):
        held = np.zeros(len(rows), bool)
        held[order[fold::FOLDS]] = True
        if good[~held].all() or not good[~held].any():
            continue
        places, weights = _support_vectors([rows[i] for i in np.flatnonzero(~held)], good[~held], max_features)
        table, norms = _tables(places, weights)
        margins[held] = [margin(rows[i], table, norms) for i in np.flatnonzero(held)]
    places, weights = _support_vectors(rows, good, max_features)
    return Model(places, weights, *_curve(margins, good))


def _ratios(rows: list[np.ndarray], good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-count ratio of every place, and in how many texts it is."""
    counts = np.zeros((2, 1 << BITS))
    for row, kind in zip(rows, good, strict=True):
        counts[int(kind), row] += 1
    ratio = np.log((counts[1] + 1) / (good.sum() + 2)) - np.log((counts[0] + 1) / ((~good).sum() + 2))
    return ratio, counts.sum(0)


def _support_vectors(rows: list[np.ndarray], good: np.ndarray, max_features: int, cost: float = 1.0, passes: int = 40, enough: float = 0.01) -> tuple[np.ndarray, np.ndarray]:
    """Places and ratio times weight of a squared-hinge model, by coordinate descent on the dual, rows in a new random order each pass.

    Rows are scaled to length one, so the curvature of every coordinate is the same; classes weigh towards balance by the root of their odds.
    The last place is a feature that all texts have.
    """
    ratio, count = _ratios(rows, good)
    worth = np.where(count >= 2, np.abs(ratio) * np.sqrt(count), 0)
    places = np.sort(np.argsort(-worth, kind="stable")[:max_features])
    places = places[worth[places] > 0].astype(np.int32)
    rank = np.full(1 << BITS, -1, np.int32)
    rank[places] = np.arange(places.size)
    scale = ratio[places]
    columns, values = [], []
    for row in rows:
        own = rank[row]
        own = own[own >= 0]
        norm = np.sqrt((scale[own] ** 2).sum()) or 1.0
        columns.append(np.append(own, places.size))
        values.append(np.append(scale[own] / norm, 1.0))
    sign = np.where(good, 1.0, -1.0)
    bound = cost * np.where(good, 1.0, np.sqrt(good.sum() / max((~good).sum(), 1)))
    slack = 1 / (2 * bound)
    square = np.array([float(v @ v) for v in values]) + slack
    alpha, weights = np.zeros(len(rows)), np.zeros(places.size + 1)
    chance = np.random.default_rng(7)
    for _ in range(passes):
        worst = 0.0
        for i in chance.permutation(len(rows)):
            slope = sign[i] * float(weights[columns[i]] @ values[i]) - 1 + slack[i] * alpha[i]
            if alpha[i] == 0 and slope >= 0:
                continue
            worst = max(worst, abs(slope))
            new = max(alpha[i] - slope / square[i], 0.0)
            weights[columns[i]] += (new - alpha[i]) * sign[i] * values[i]
            alpha[i] = new
        if worst < enough:
            break
    # The last entry is the weight of the feature that all texts have.
    return np.append(places, np.int32(1 << BITS)), np.stack([np.append(scale * weights[:-1], weights[-1]), np.append(scale, 0.0)])


def _tables(places: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weight and squared scale of every place; the last entry is the constant."""
    table, norms = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    table[places], norms[places] = weights[0], weights[1] ** 2
    return table, norms


def margin(row: np.ndarray, table: np.ndarray, norms: np.ndarray) -> float:
    return float(table[row].sum() / (np.sqrt(norms[row].sum()) or 1.0) + table[-1])


def _curve(margins: np.ndarray, good: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of the logistic curve that fits the margins best, by Newton's method, targets drawn in a little from 0 and 1."""
    target = np.where(good, (good.sum() + 1) / (good.sum() + 2), 1 / ((~good).sum() + 2))
    x = np.stack([margins, np.ones(margins.size)])
    theta = np.array([1.0, 0.0])
    for _ in range(steps):
        chance = 1 / (1 + np.exp(-np.clip(theta @ x, -40, 40)))
        slope = x @ (chance - target) + 1e-6 * theta
        bend = (x * (chance * (1 - chance))) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        theta = theta - step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(theta[0], 0.0)), float(theta[1])


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "quality_score") -> DataFrame:
    """``docs`` with a double column ``into`` from 0 to 1, higher for likelier label 1; replaces a column of that name.

    Null and empty texts get the score of the constant. Every row is scored by its text alone, so repeated rows score alike; an empty
    table stays empty. The model is sent to the tasks once; its size is bound by ``max_features``.
    """
    own = [c for c in docs.columns if c != into]
    shared = docs.sparkSession.sparkContext.broadcast((model.places, model.weights, model.slope, model.shift))
    body = "_text" + "_" * sum(c.startswith("_text") for c in own)
    schema = docs.select(*own, F.lit(0.0).alias(into)).schema

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa

        places, weights, slope, shift = shared.value
        table, norms = _tables(places, np.frombuffer(weights).reshape(2, -1) if places.size else np.zeros((2, 0)))
        seen = np.zeros(1 << BITS, bool)
        for part in parts:
            margins = np.array([margin(features(t.as_py(), seen), table, norms) for t in part.column(body)], dtype=np.float64)
            values = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -700, 700)))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in own), pa.array(values)], names=[*own, into])

    return docs.select(*own, F.col(text).cast("string").cast("binary").alias(body)).mapInArrow(run, schema)
