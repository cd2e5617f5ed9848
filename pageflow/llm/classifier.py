"""A softmax classifier of texts, fitted on a bounded sample of labelled rows.

Features are the distinct words of a text, their first four and last three bytes, and how often words
repeat, hashed to a fixed number of slots; slots that tell no class apart in the sample are left out,
so that a few telling words count alike in short and long texts. The sample (the first
``SAMPLE_ROWS`` labelled rows in hash order of their ids) is the only data that reaches the driver; the
bound does not depend on the table. The fitted weights have a fixed size and are sent to the tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageflow.llm.common import bytes_of, release, slices, text_of
from pageflow.llm.words import LOWER, mix, word_hashes, word_spans

SAMPLE_ROWS = 12_000
SLOTS = 1 << 17
EPOCHS = 6
LEARNING_RATE = 0.3
LEAST_TEXTS = 4
CLEAR = 5.0
REPEAT_LEVELS = 8
LENGTH_LEVELS = 24


def _features(data: np.ndarray, ends: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all texts end to end, and the offsets of the texts."""
    starts, lengths, before = word_spans(data, ends)
    counts = np.diff(before)
    texts = np.arange(len(counts)) * slots
    owner = np.repeat(texts, counts)
    room = np.uint64(slots - REPEAT_LEVELS - LENGTH_LEVELS)
    parts = (word_hashes(data, ends)[0], _ends_of(data, starts, lengths, range(4)), _ends_of(data, starts, lengths, range(-1, -4, -1)))
    pairs = [owner + (part % room).astype(np.int64) for part in parts]
    pairs[0] = _distinct(pairs[0])
    distinct = np.diff(np.searchsorted(pairs[0], np.append(texts, len(counts) * slots)))
    repeat = np.where(counts > 0, (REPEAT_LEVELS - 1) * distinct // np.maximum(counts, 1), REPEAT_LEVELS - 1)
    length = np.minimum(np.ceil(np.log2(counts + 1)), LENGTH_LEVELS - 1).astype(np.int64)
    pairs += [texts + slots - 1 - repeat, texts + slots - 1 - REPEAT_LEVELS - length]
    keyed = _distinct(np.concatenate(pairs))
    return (keyed % slots).astype(np.int32), np.searchsorted(keyed, np.append(texts, len(counts) * slots))


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _ends_of(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, places: range) -> np.ndarray:
    """Hash of the bytes of every word at some places, counted from its start or, if negative, its end."""
    total = np.full(len(starts), len(places), np.uint64)
    for k in places:
        inside = lengths > (k if k >= 0 else -k - 1)
        at = np.where(inside, starts + k + (lengths if k < 0 else 0), 0)
        total = total * np.uint64(256) + np.where(inside, LOWER[data[at]], 0).astype(np.uint64)
    return mix(total + np.uint64(7 if places.step < 0 else 0)) if len(total) else total


@dataclass
class Model:
    classes: Sequence[str]
    weights: np.ndarray  # (slots, classes)
    bias: np.ndarray

    def posteriors(self, slots: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Class probabilities, one row for each text."""
        n, sums = len(offsets) - 1, np.diff(offsets)
        scores = np.zeros((n, len(self.classes)))
        full = np.flatnonzero(sums)
        if len(full):
            scores[full] = np.add.reduceat(self.weights[slots].astype(np.float64), offsets[full], axis=0)
        scores += self.bias
        scores -= scores.max(axis=1, keepdims=True)
        e = np.exp(scores)
        return e / e.sum(axis=1, keepdims=True)


def telling(rows: list[tuple[np.ndarray, int]], classes: int, slots: int) -> np.ndarray:
    """Slots whose share of some class among the texts that have them differs clearly from the class's own share."""
    seen = np.zeros((classes, slots))
    for at, c in rows:
        seen[c, at] += 1
    n = seen.sum(axis=0)
    share = np.bincount([c for _, c in rows], minlength=classes)[:, None] / max(len(rows), 1)
    spread = np.sqrt(np.maximum(n * share * (1 - share), 1e-9))
    return (n >= LEAST_TEXTS) & ((np.abs(seen - n * share) / spread) > CLEAR).any(axis=0)


def fit_rows(rows: list[tuple[np.ndarray, int]], classes: Sequence[str], slots: int = SLOTS, seed: int = 7) -> Model:
    """Adaptive stochastic gradient steps over (slots, class) rows; a class without rows keeps a small prior."""
    weights = np.zeros((slots, len(classes)))
    steps = np.full((slots, 1), 1.0)
    share = np.bincount([c for _, c in rows], minlength=len(classes)) + 1.0
    bias = np.log(share / share.sum())
    bias_steps = 1.0
    used = telling(rows, len(classes), slots)
    rows = [(at[used[at]], c) for at, c in rows]
    order = np.random.default_rng(seed)
    for epoch in range(EPOCHS if rows else 0):
        for i in order.permutation(len(rows)):
            at, target = rows[i]
            scores = weights[at].sum(axis=0) + bias
            p = np.exp(scores - scores.max())
            p /= p.sum()
            p[target] -= 1
            steps[at] += (p**2).sum()
            weights[at] -= LEARNING_RATE * p / np.sqrt(steps[at])
            bias_steps += (p**2).sum()
            bias = bias - LEARNING_RATE * p / np.sqrt(bias_steps)
    return Model(list(classes), weights.astype(np.float32), bias)


def _featured(docs: DataFrame, text: str, keep: dict[str, str], slots: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                data, ends = bytes_of(part.column(text))
                at, offsets = _features(data, ends, slots)
                packed = [at[a:b].astype("<i4").tobytes() for a, b in zip(offsets, offsets[1:])]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(packed, pa.binary())], [*keep, "slots"])

    return docs.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in keep.items()) + ", slots binary")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    classes: Sequence[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    class_col: str = "class",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Fits on at most ``sample_rows`` labelled documents; rows with a NULL or unknown class are left out.

    Of rows with one id, that with the smallest text by hash counts; the others are dropped before any row reaches the driver.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(class_col).isin(list(classes)))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.min(class_col).alias("_class"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
    texts = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    sample = texts.join(F.broadcast(chosen), "_id")  # at most sample_rows short rows
    sample = sample.groupBy("_id", "_class").agg(F.min_by("_text", F.struct(F.xxhash64("_text"), "_text")).alias("_text"))
    # As Arrow batches, of which the rows are views: objects for all rows would stay in the memory of the driver's Python.
    place = {c: k for k, c in enumerate(classes)}
    rows = []
    for batch in _featured(sample, "_text", {"_id": "long", "_class": "string"}, SLOTS).toArrow().to_batches():
        data, ends = bytes_of(batch.column("slots"))
        for k, (row_id, kind) in enumerate(zip(batch.column("_id").to_pylist(), batch.column("_class").to_pylist())):
            rows.append((row_id, data[ends[k] : ends[k + 1]].view("<i4"), place[kind]))
    rows.sort(key=lambda r: r[0])
    model = fit_rows([r[1:] for r in rows], classes)
    rows.clear()
    release(docs.sparkSession)
    return model


def predict(docs: DataFrame, model: Model, text: str, keep: dict[str, str], prefix: str = "p_") -> DataFrame:
    """The kept columns (name to type), the number of words as ``words`` and one probability per class for each row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = sent.value
        for batch in batches:
            for part in slices(batch, text):
                data, ends = bytes_of(part.column(text))
                p = own.posteriors(*_features(data, ends, len(own.weights)))
                words = np.diff(word_spans(data, ends)[2])
                arrays = [*[part.column(c) for c in keep], pa.array(words, pa.int64()), *[pa.array(p[:, k]) for k in range(p.shape[1])]]
                yield pa.RecordBatch.from_arrays(arrays, [*keep, "words", *[prefix + c for c in own.classes]])

    schema = [f"`{c}` {t}" for c, t in keep.items()] + ["words long"] + [f"`{prefix}{c}` double" for c in model.classes]
    return docs.mapInArrow(run, ", ".join(schema))
