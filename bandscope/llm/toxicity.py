"""Toxicity scores: logistic regression on hashed word n-grams and skip-grams, learned by FTRL-proximal.

Features of a text are its distinct words, its distinct pairs of neighbouring words and its distinct
pairs one word apart, hashed into `2 ** bits` slots. FTRL-proximal gives every slot its own learning
rate and sets the weights of uninformative slots to exactly zero, so that what is broadcast is a short
list of (slot, weight) rows; the shrunken margins are then calibrated on the training rows. The model
is fitted on a bounded sample of labelled rows, about `SAMPLE` of them, chosen by a hash of their id.
Scoring reads every whole text once, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandscope.llm import words as W
from bandscope.llm.columns import put_back, set_aside

SAMPLE = 8000
BITS = 20
THRESHOLD = 0.3
SKIPS = ((), (1,), (2,))


@dataclass(frozen=True)
class Ftrl:
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 20.0
    l2: float = 0.1
    epochs: int = 6


@dataclass
class Model:
    """Sorted slots with a weight other than zero, their weights, and the intercept."""

    slots: np.ndarray
    weights: np.ndarray
    bias: float
    bits: int


def features(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Distinct slots of one text."""
    kinds = [W.mix(W.grams(hashes, steps) + np.uint64(k)) for k, steps in enumerate(SKIPS)]
    return np.unique(np.concatenate(kinds) >> np.uint64(64 - bits)).astype(np.int64)


def fit(rows: list[np.ndarray], labels: np.ndarray, bits: int, how: Ftrl) -> tuple[np.ndarray, float]:
    """Weights by slot and the intercept. Rows are visited in the order given, `epochs` times."""
    z, n, w = (np.zeros((1 << bits) + 1) for _ in range(3))
    for _ in range(how.epochs):
        for slots, label in zip(rows, labels, strict=True):
            at = np.append(slots, 1 << bits)
            rate = (how.beta + np.sqrt(n[at])) / how.alpha + how.l2
            # The intercept, the last slot, is not shrunk.
            l1 = np.full(len(at), how.l1)
            l1[-1] = 0.0
            w[at] = np.where(np.abs(z[at]) <= l1, 0.0, -(z[at] - np.sign(z[at]) * l1) / rate)
            error = 1 / (1 + np.exp(-np.clip(w[at].sum(), -35, 35))) - label
            step = (np.sqrt(n[at] + error * error) - np.sqrt(n[at])) / how.alpha
            z[at] += error - step * w[at]
            n[at] += error * error
    rate = (how.beta + np.sqrt(n)) / how.alpha + how.l2
    w = np.where(np.abs(z) <= how.l1, 0.0, -(z - np.sign(z) * how.l1) / rate)
    return w[:-1], float(-z[-1] / rate[-1])


def calibrate(margins: np.ndarray, labels: np.ndarray, pull: float = 0.01) -> tuple[float, float]:
    """Scale and shift that turn margins into log odds, by Newton's method; the scale is pulled towards 1.

    The targets are those of Platt: a little inside 0 and 1, by the number of rows of each label.
    """
    ones = labels.sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    scale, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(scale * margins + shift, -35, 35)))
        w = p * (1 - p)
        slope = np.array([((p - target) * margins).sum() + pull * (scale - 1), (p - target).sum()])
        bend = np.array([[(w * margins * margins).sum() + pull, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(bend, slope), -1, 1)
        scale, shift = max(0.0, scale - step[0]), shift - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(scale), float(shift)


def held_out_fold(doc_id: str, folds: int = 4) -> Column:
    """crc32 of the id as text, modulo `folds`. A null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds, F.lit(0))


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """About `size` rows (text, label, order) of documents with a label 0 or 1 outside the held-out fold.

    The rows are those whose hash of the id is lowest, so the choice does not depend on row order. An id
    with several labels has the largest, one with several texts the smallest text.
    """
    known = (
        labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (held_out_fold("doc_id") != 2))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("label"))
        .withColumn("order", F.xxhash64("doc_id", F.lit("sample")))
    )
    n = known.count()
    limit = int(-(2**63) + 2**64 * min(1.0, size / n)) - 1 if n else 0
    # About `size` short rows, whatever the input: small enough to broadcast.
    few = F.broadcast(known.filter(F.col("order") <= limit))
    return docs.select("doc_id", "text").join(few, "doc_id").groupBy("doc_id", "label", "order").agg(F.min("text").alias("text"))


def train(examples: DataFrame, bits: int = BITS, how: Ftrl = Ftrl()) -> Model:
    """Fit on all of `examples` (text, label 0 or 1, order), a bounded sample, in one task, sorted by order.

    Without examples every score is 0.5.
    """
    both = examples.select("text", "label", "order")

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels, order = [], [], []
        for batch in batches:
            for part in W.slices(batch, "text"):
                _, _, hashes, first = W.words(W.column(part.column("text")))
                rows += [features(hashes[a:b], bits).astype(np.int32) for a, b in zip(first[:-1], first[1:], strict=True)]
                labels += part.column("label").to_pylist()
                order += part.column("order").to_pylist()
        turn = np.lexsort((np.array([len(r) for r in rows], np.int64), np.array(order, np.int64)))
        w, bias = fit([rows[i] for i in turn], np.array(labels, float)[turn], bits, how)
        scale, shift = calibrate(np.array([w[r].sum() + bias for r in rows]), np.array(labels, float)) if rows else (1.0, 0.0)
        slots = np.flatnonzero(w)
        yield pa.record_batch(
            {
                "slot": np.append(slots, -1).astype(np.int64),
                "weight": np.append(w[slots] * scale, bias * scale + shift if rows else 0.0),
            }
        )

    found = both.coalesce(1).mapInArrow(W.tidy(fitted), "slot long, weight double").collect()
    table = sorted((r.slot, r.weight) for r in found)
    return Model(
        np.array([s for s, _ in table[1:]], np.int64),
        np.array([w for _, w in table[1:]]),
        table[0][1] if table else 0.0,
        bits,
    )


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """`docs` with a column `out`: the probability of label 1, from 0 to 1. Null and empty texts get the intercept's.

    Only the text decides. A column named `out` before is replaced. Repeated rows get equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != out]
    schema = docs.select(*kept).schema.add(out, "double")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        dense = np.zeros(1 << model.bits, np.float32)
        dense[model.slots] = model.weights
        shift = np.uint64(64 - model.bits)
        for batch in batches:
            for part in W.slices(batch, text):
                _, _, hashes, first = W.words(W.column(part.column(text)))
                doc = np.repeat(np.arange(part.num_rows), np.diff(first))
                total = np.full(part.num_rows, model.bias)
                hit_doc, hit_slot = [], []
                for k, steps in enumerate(SKIPS):
                    made = W.grams(hashes, steps)
                    slot = (W.mix(made + np.uint64(k)) >> shift).astype(np.int64)
                    reach = max(steps, default=0)
                    live = (dense[slot] != 0) & (doc[: len(slot)] == doc[reach : reach + len(slot)])
                    hit_doc.append(doc[: len(slot)][live])
                    hit_slot.append(slot[live])
                key = np.unique((np.concatenate(hit_doc).astype(np.int64) << model.bits) | np.concatenate(hit_slot))
                np.add.at(total, key >> model.bits, dense[key & ((1 << model.bits) - 1)])
                value = pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(c)) for c in kept] + [value], [*kept, out])

    return docs.select(*kept, *([] if text in kept else [text])).mapInArrow(W.tidy(scored), schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every row of `docs` with `score` and `predicted` (1 where the score reaches the threshold)."""
    scored = score(docs, train(sample(docs, labels)))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` whose score stays below the threshold, with the columns of `docs`."""
    rows, other = set_aside(docs, ("score", "predicted"))
    return put_back(toxicity(rows, labels, threshold).filter("predicted = 0"), docs.columns, other)
