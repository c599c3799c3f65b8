"""Toxicity: FTRL-proximal logistic regression over hashed n-grams and skip-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shopstar.llm.text import joined
from shopstar.llm.training import held_out, sample


@dataclass(frozen=True)
class Ftrl:
    """rows_per_class bounds the labelled sample that is fitted, per class.

    bits: log2 of the number of coordinates. alpha, beta: learning rate of a
    coordinate; l1 keeps coordinates with little evidence at 0, l2 shrinks. Where
    the bound cuts a class, scores are brought back to the mix of all labels.
    """

    rows_per_class: int = 8_000
    bits: int = 20
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.0
    epochs: int = 10
    folds: int = 5
    out: int = 0


WORD_RUN = re.compile(r"\w+")


def features(text: str | None, bits: int) -> np.ndarray:
    """Coordinates of the words, neighbours and words one apart of a whole text; the first is the bias."""
    words = WORD_RUN.findall((text or "").lower())
    h = np.fromiter(
        (xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
    skip = joined(h[:-2] ^ np.uint64(0x5BD1E995), h[2:]) if len(h) > 2 else h[:0]
    grams = np.concatenate([joined(h), joined(h[:-1], h[1:]) if len(h) > 1 else h[:0], skip])
    places = (grams >> np.uint64(64 - bits)).astype(np.int64)
    return np.concatenate([[0], places[places > 0]])


def fit(examples: list[tuple[np.ndarray, int]], rule: Ftrl) -> np.ndarray:
    """Weights after the epochs; every coordinate has its own rate, from its own gradients."""
    z, n = np.zeros(1 << rule.bits), np.zeros(1 << rule.bits)
    order = np.random.default_rng(7)

    def weights(at):
        zi, ni = z[at], n[at]
        w = -(zi - np.sign(zi) * rule.l1) / ((rule.beta + np.sqrt(ni)) / rule.alpha + rule.l2)
        return np.where(np.abs(zi) <= rule.l1, 0.0, w)

    for _ in range(rule.epochs):
        for i in order.permutation(len(examples)):
            at, y = examples[i]
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            before = n[at]
            after = before + g * g
            z[at] += g - (np.sqrt(after) - np.sqrt(before)) / rule.alpha * w
            n[at] = after
    return weights(np.arange(1 << rule.bits)).astype(np.float32)


def train(docs: DataFrame, chosen: DataFrame, rule: Ftrl) -> tuple[np.ndarray, np.ndarray, float]:
    """Places and values of the weights that are not 0, and the share of label 1.

    Texts are turned into coordinates where they are; the bounded sample then
    meets in one task, which returns the sparse weights.
    """
    bits = rule.bits

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({
                "one": np.zeros(batch.num_rows, np.int32), "doc_id": batch["doc_id"], "y": batch["y"],
                "at": pa.array([np.unique(features(t.as_py(), bits)).astype("<i4").tobytes()
                                for t in batch["text"]], pa.binary())})

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("at", "ascending")])
        ys = table["y"].to_pylist()
        examples = [(np.frombuffer(a.as_py(), "<i4"), y) for a, y in zip(table["at"], ys, strict=True)]
        w = fit(examples, rule)
        at = np.flatnonzero(w)
        return pa.table({
            "places": pa.array([at.astype("<i4").tobytes()], pa.binary()),
            "values": pa.array([w[at].astype("<f4").tobytes()], pa.binary()),
            "share": pa.array([float(np.mean(ys))], pa.float64())})

    rows = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .mapInArrow(encode, "one int, doc_id long, y int, at binary")
        .groupBy("one").applyInArrow(learn, "places binary, values binary, share double").collect())
    if not rows:
        return np.zeros(0, np.int32), np.zeros(0, np.float32), 0.5
    row = rows[0]
    return np.frombuffer(row["places"], "<i4"), np.frombuffer(row["values"], "<f4"), row["share"]


def score_toxicity(docs: DataFrame, labels: DataFrame, rule: Ftrl = Ftrl()) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text, from its words alone.

    Labels are learnt from rows outside the held-out fold only. Null and empty
    texts get the score of the bias. A row without an id is not held out and
    never learnt from. Without labels, with one class only, or with no evidence,
    every score is the share of label 1 (0.5 for none). Repeated rows are scored
    alike.
    """
    chosen, correction = sample(labels, "toxic", rule.folds, rule.out, rule.rows_per_class)
    places, values, share = train(docs, chosen, rule)
    if share in (0.0, 1.0) or not len(places):
        odds = np.exp(correction)
        score = F.lit(float(share * odds / (share * odds + 1 - share)))
        return docs.select(
            "doc_id", held_out(rule.folds, rule.out).alias("held_out"), score.alias("score"),
            (score >= 0.5).cast("int").alias("predicted"))
    bits = rule.bits
    model = docs.sparkSession.sparkContext.broadcast((places, values))

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(1 << bits, np.float32)
        weights[model.value[0]] = model.value[1]
        for batch in batches:
            out = []
            for text in batch["text"]:
                at = features(text.as_py(), bits)
                at = np.unique(at[weights[at] != 0])
                out.append(float(weights[at].sum(dtype=np.float64)))
            p = 1 / (1 + np.exp(-np.clip(np.array(out) + correction, -35, 35)))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"], "score": p, "predicted": (p >= 0.5).astype(np.int32)})

    return docs.select("doc_id", "text").mapInArrow(
        scores, "doc_id long, score double, predicted int").select(
        "doc_id", held_out(rule.folds, rule.out).alias("held_out"), "score", "predicted")
