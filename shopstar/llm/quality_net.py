"""Quality classifier: a convolutional network over the bytes of a text, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shopstar.llm.training import held_out, sample

Params = dict[str, np.ndarray]


@dataclass(frozen=True)
class ByteNet:
    """rows_per_class bounds the labelled sample that is fitted, per class.

    width: bytes that a filter sees; it moves by `step`. block: bytes whose
    strongest response is kept. chunk, stride: blocks of a chunk and between the
    starts of chunks, so that chunks overlap and together cover the text.
    """

    rows_per_class: int = 1_500
    filters: int = 24
    width: int = 6
    step: int = 2
    block: int = 64
    chunk: int = 8
    stride: int = 7
    hidden: int = 16
    epochs: int = 6
    batch: int = 16
    rate: float = 0.01
    folds: int = 3
    out: int = 1


def start(net: ByteNet) -> Params:
    draw = np.random.default_rng(11)
    normal = lambda scale, *shape: (draw.standard_normal(shape) * scale).astype(np.float32)
    return {
        "taps": normal(0.3, net.width, 256, net.filters), "tap_bias": np.zeros(net.filters, np.float32),
        "w1": normal(0.2, net.filters + 1, net.hidden), "b1": np.zeros(net.hidden, np.float32),
        "w2": normal(0.3, net.hidden), "b2": np.zeros(1, np.float32),
        "mix": np.array([0.7, 0.3], np.float32), "bias": np.zeros(1, np.float32)}


def padded(text: str | None, net: ByteNet) -> np.ndarray:
    """The bytes, filled up with 0 to whole blocks and the width of a filter."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    size = max(1, -(-len(raw) // net.block)) * net.block
    out = np.zeros(size + net.width, np.uint8)
    out[:len(raw)] = raw
    return out


def responses(raw: np.ndarray, p: Params, net: ByteNet) -> np.ndarray:
    """What every filter says at every position of a padded text."""
    n = len(raw) - net.width
    out = p["taps"][0][raw[0:n:net.step]]
    for j in range(1, net.width):
        out += p["taps"][j][raw[j:j + n:net.step]]
    out += p["tap_bias"]
    return out


def chunk_starts(blocks: int, net: ByteNet) -> range:
    return range(0, max(1, blocks - net.chunk + net.stride), net.stride)


def chunk_features(best: np.ndarray, size: int, net: ByteNet) -> np.ndarray:
    """Strongest responses by chunk, from those by block, and how long the chunk is."""
    rows = []
    for first in chunk_starts(len(best), net):
        part = best[first:first + net.chunk]
        length = min(size - first * net.block, net.chunk * net.block)
        rows.append(np.append(np.maximum(part.max(0), 0), np.log1p(max(length, 0)) / 6))
    return np.array(rows, np.float32)


def combine(features: np.ndarray, p: Params) -> tuple[float, np.ndarray, np.ndarray]:
    """Logit of the text, hidden values and logits of its chunks."""
    hidden = np.maximum(features @ p["w1"] + p["b1"], 0)
    logits = hidden @ p["w2"] + p["b2"][0]
    return float(p["mix"][0] * logits.mean() + p["mix"][1] * logits.min() + p["bias"][0]), hidden, logits


def text_size(text: str | None) -> int:
    return len((text or "").encode("utf-8", "surrogatepass"))


def logit(text: str | None, p: Params, net: ByteNet, most: int = 1 << 18) -> float:
    """Logit of a whole text; long ones are read `most` bytes at a time."""
    raw = padded(text, net)
    size = text_size(text)
    best = []
    for first in range(0, len(raw) - net.width, most):
        part = responses(raw[first:first + most + net.width], p, net)
        best.append(part.reshape(-1, net.block // net.step, net.filters).max(1))
    return combine(chunk_features(np.concatenate(best), size, net), p)[0]


def gradients(text: str | None, y: int, p: Params, net: ByteNet, into: Params) -> None:
    """Adds the gradients of the log loss; a maximum passes its own on to where it was reached."""
    raw, size = padded(text, net), text_size(text)
    out = responses(raw, p, net)
    per_block = net.block // net.step
    best = out.reshape(-1, per_block, net.filters).max(1)
    features = chunk_features(best, size, net)
    value, hidden, logits = combine(features, p)
    g = 1 / (1 + np.exp(-np.clip(value, -35, 35))) - y
    d = np.full(len(logits), g * p["mix"][0] / len(logits), np.float32)
    d[logits.argmin()] += g * p["mix"][1]
    into["bias"] += g
    into["mix"] += np.array([g * logits.mean(), g * logits.min()], np.float32)
    into["w2"] += hidden.T @ d
    into["b2"] += d.sum()
    d_hidden = np.outer(d, p["w2"]) * (hidden > 0)
    into["w1"] += features.T @ d_hidden
    into["b1"] += d_hidden.sum(0)
    d_features = d_hidden @ p["w1"].T
    lanes = np.arange(net.filters)
    for row, first in enumerate(chunk_starts(len(best), net)):
        begin = first * per_block
        at = begin + out[begin:begin + net.chunk * per_block].argmax(0)
        pull = d_features[row, :-1] * (features[row, :-1] > 0)
        into["tap_bias"] += pull
        for j in range(net.width):
            np.add.at(into["taps"][j], (raw[at * net.step + j], lanes), pull)


def fit(texts: list[str | None], ys: list[int], net: ByteNet) -> Params:
    """Adam over shuffled batches, from a fixed start."""
    p = start(net)
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    order, t = np.random.default_rng(5), 0
    for epoch in range(net.epochs):
        places = order.permutation(len(texts))
        rate = net.rate * (0.5 ** max(0, epoch - 2))
        for begin in range(0, len(places), net.batch):
            some = places[begin:begin + net.batch]
            grad = {k: np.zeros_like(v) for k, v in p.items()}
            for i in some:
                gradients(texts[i], ys[i], p, net, grad)
            t += 1
            for k in p:
                g = grad[k] / len(some)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] -= rate * (first[k] / (1 - 0.9 ** t)) / (np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)
    return p


def packed(p: Params) -> bytes:
    return b"".join(p[k].astype("<f4").tobytes() for k in sorted(p))


def unpacked(raw: bytes, net: ByteNet) -> Params:
    out, at, flat = {}, 0, np.frombuffer(raw, "<f4")
    for k, v in sorted(start(net).items()):
        out[k] = flat[at:at + v.size].reshape(v.shape).copy()
        at += v.size
    return out


def train(docs: DataFrame, chosen: DataFrame, net: ByteNet) -> tuple[bytes | None, float]:
    """The parameters, whose size is fixed, and the share of label 1; fitted in one task."""

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        texts, ys = table["text"].to_pylist(), table["y"].to_pylist()
        both = 0 < sum(ys) < len(ys)
        return pa.table({
            "params": pa.array([packed(fit(texts, ys, net) if both else start(net))], pa.binary()),
            "share": pa.array([float(np.mean(ys))], pa.float64())})

    rows = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .select(F.pmod("y", F.lit(1)).alias("one"), "doc_id", "text", "y")
        .groupBy("one").applyInArrow(learn, "params binary, share double").collect())
    return (bytes(rows[0]["params"]), rows[0]["share"]) if rows else (None, 0.5)


def score_quality(docs: DataFrame, labels: DataFrame, net: ByteNet = ByteNet()) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text, from its bytes alone.

    Labels are learnt from rows outside the held-out fold only. Null and empty
    texts are one block of zero bytes. A row without an id is not held out and
    never learnt from. Without labels, or with one class only, every score is
    the share of label 1 (0.5 for none). Repeated rows are scored alike.
    """
    chosen, correction = sample(labels, "quality", net.folds, net.out, net.rows_per_class)
    params, share = train(docs, chosen, net)
    if params is None or share in (0.0, 1.0):
        score = F.lit(float(share))
        return docs.select(
            "doc_id", held_out(net.folds, net.out).alias("held_out"), score.alias("score"),
            (score >= 0.5).cast("int").alias("predicted"))
    model = docs.sparkSession.sparkContext.broadcast(params)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = unpacked(model.value, net)
        for batch in batches:
            z = np.array([logit(t.as_py(), p, net) for t in batch["text"]]) + correction
            s = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"], "score": s, "predicted": (s >= 0.5).astype(np.int32)})

    return docs.select("doc_id", "text").mapInArrow(
        scores, "doc_id long, score double, predicted int").select(
        "doc_id", held_out(net.folds, net.out).alias("held_out"), "score", "predicted")
