"""Quality classifier by gated attention over passages.

A document is a bag of passages. Each passage is encoded from counts of its characters
and words; gated attention (Ilse et al., 2018) weighs the encoded passages, and their
weighted sum is scored. Only labels of whole documents are needed to learn all of it.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _text
from ._sample import labelled_texts

PASSAGE_WORDS = 50
#: Byte classes whose shares describe a passage; every other byte is in the last.
CLASSES = (
    b" ", b"\n", b"\t\r\x0b\x0c", b"etaoinsr", b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:", b"!", b"?", b"'\"-()",
    b"#", b"*", b"$", b"%", b"&", b"|", b"<>", b"/\\_=+@{}[]~^`", bytes(range(128, 256)),
)
WIDTH = len(CLASSES) + 1 + 5


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str,
    text: str,
    label: str,
    per_label: int = 3000,
    steps: int = 600,
    hidden: int = 24,
    gates: int = 12,
    seed: int = 11,
) -> Model:
    """Learn from at most ``per_label`` documents of each label (0 and 1).

    Only the passage features of these go to the driver. Without rows of both labels
    the model scores every text by the labels it has seen, 0.5 without any.
    """
    sample = labelled_texts(docs, labels, key, text, label, per_label)
    named = sample.select(
        F.col("key").cast("string").alias("key"), F.col("label").cast("int").alias("label"), "text"
    )
    rows = _text.extended(
        named, "text", "passages", T.BinaryType(), _feature_task, ["key", "label"]
    ).collect()
    rows.sort(key=lambda r: (r.key, r.label, bytes(r.passages)))
    bags = [np.frombuffer(bytes(r.passages), np.float32).reshape(-1, WIDTH) for r in rows]
    truth = np.array([r.label for r in rows], np.float64)
    return _train(bags, truth, steps, hidden, gates, seed)


def with_score(
    df: DataFrame,
    text: str,
    model: Model,
    score: str = "score",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``df``, or its columns ``keep``, with the score (0 to 1) of each text.

    Whole texts are read. Null, empty and blank texts are one empty passage and get
    its score; equal texts get equal scores. Nothing is shuffled; a column named like
    ``score`` is replaced.
    """

    def task():
        return lambda data, offsets: pa.array(_forward(model, *features(data, offsets))[0])

    return _text.extended(df, text, score, T.DoubleType(), task, keep)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages, and the first passage of each text."""
    words = _text.split_words(data, offsets)
    rows = len(offsets) - 1
    counts = np.diff(words.first)
    bags = np.maximum(1, -(-counts // PASSAGE_WORDS))
    first = np.concatenate([[0], np.cumsum(bags)[:-1]])
    # Where passages begin in the bytes: at their first word, or where the text begins.
    begin = np.repeat(offsets[:-1], bags)
    inner = np.arange(len(begin)) - np.repeat(first, bags)
    later = inner > 0
    word_at = np.repeat(words.first[:-1], bags) + inner * PASSAGE_WORDS
    begin[later] = words.start[word_at[later]]
    end = np.append(begin[1:], len(data))
    kinds = np.full(256, len(CLASSES), np.uint8)
    for i, members in reversed(list(enumerate(CLASSES))):
        kinds[list(members)] = i
    kind = kinds[data]
    n = len(begin)
    passage = np.repeat(np.arange(n), end - begin)
    width = len(CLASSES) + 1
    shares = np.bincount(passage * width + kind, minlength=n * width).reshape(n, width)
    length = (end - begin).astype(np.float64)
    out = np.zeros((n, WIDTH))
    out[:, :width] = shares / np.maximum(length, 1)[:, None]

    row = words.row()
    word_passage = first[row] + (np.arange(len(row)) - words.first[row]) // PASSAGE_WORDS
    hashes = _text.Hasher().ranges(data, words.start, words.end)
    n_words = np.bincount(word_passage, minlength=n)
    own = hashes ^ _text.scramble(word_passage.astype(np.uint64) + np.uint64(1))
    seen = np.unique(own, return_index=True)[1]
    echo = np.flatnonzero((hashes[1:] == hashes[:-1]) & (word_passage[1:] == word_passage[:-1])) + 1
    some = np.maximum(n_words, 1)
    sizes = (words.end - words.start).astype(np.float64)
    total = np.bincount(word_passage, weights=sizes, minlength=n)
    out[:, width] = np.bincount(word_passage[seen], minlength=n) / some
    out[:, width + 1] = np.bincount(word_passage[echo], minlength=n) / some
    out[:, width + 2] = total / some
    out[:, width + 3] = np.log1p(n_words)
    spread = np.bincount(word_passage, weights=sizes**2, minlength=n) / some
    out[:, width + 4] = np.sqrt(np.maximum(spread - (total / some) ** 2, 0))
    assert len(first) == rows
    return out, first


def _feature_task():
    def make(data, offsets):
        x, first = features(data, offsets)
        bags = np.split(x.astype(np.float32), first[1:])
        return pa.array([b.tobytes() for b in bags], pa.binary())

    return make


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def _forward(model: Model, x: np.ndarray, first: np.ndarray):
    """Scores of the bags whose passages begin at ``first``, and what led to them."""
    w = model.weights
    z = (x - model.mean) / model.scale
    code = np.tanh(z @ w["encode"] + w["encode0"])
    value, gate = np.tanh(code @ w["value"]), _sigmoid(code @ w["gate"])
    logit = (value * gate) @ w["attend"]
    bag = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(x))))
    # An exact maximum per bag keeps the exponentials in range.
    e = np.exp(logit - np.maximum.reduceat(logit, first)[bag])
    share = e / np.add.reduceat(e, first)[bag]
    pooled = np.add.reduceat(share[:, None] * code, first, axis=0)
    out = _sigmoid(pooled @ w["score"] + w["score0"][0])
    return out, (z, code, value, gate, share, pooled, bag)


def _train(bags, truth, steps, hidden, gates, seed) -> Model:
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags).astype(np.float64) if bags else np.zeros((1, WIDTH))
    mean, scale = every.mean(0), every.std(0) + 1e-3
    w = {
        "encode": rng.normal(0, WIDTH**-0.5, (WIDTH, hidden)),
        "encode0": np.zeros(hidden),
        "value": rng.normal(0, hidden**-0.5, (hidden, gates)),
        "gate": rng.normal(0, hidden**-0.5, (hidden, gates)),
        "attend": rng.normal(0, gates**-0.5, gates),
        "score": np.zeros(hidden),
        "score0": np.zeros(1),
    }
    model = Model(mean, scale, w)
    kinds = [np.flatnonzero(truth == y) for y in (0, 1)]
    if not all(map(len, kinds)):
        if len(truth):
            w["score0"][0] = 4.0 if truth[0] else -4.0
        return model
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    for step in range(1, steps + 1):
        # Half of every batch from each label.
        chosen = np.concatenate([rng.choice(k, 64) for k in kinds])
        x = np.concatenate([bags[i] for i in chosen]).astype(np.float64)
        first = np.concatenate([[0], np.cumsum([len(bags[i]) for i in chosen])[:-1]])
        grads = _gradients(model, x, first, truth[chosen])
        rate = 0.01 * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            m, v = moment[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g**2 - v)
            step_by = (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            w[k] -= rate * (step_by + 1e-3 * w[k])
    return model


def _gradients(model, x, first, truth):
    w = model.weights
    out, (z, code, value, gate, share, pooled, bag) = _forward(model, x, first)
    d_out = (out - truth) / len(truth)
    d_pooled = d_out[:, None] * w["score"]
    d_code = share[:, None] * d_pooled[bag]
    d_share = (d_pooled[bag] * code).sum(1)
    mean_d = np.add.reduceat(share * d_share, first)
    d_logit = share * (d_share - mean_d[bag])
    d_mix = d_logit[:, None] * w["attend"]
    d_value, d_gate = d_mix * gate * (1 - value**2), d_mix * value * gate * (1 - gate)
    d_code = d_code + d_value @ w["value"].T + d_gate @ w["gate"].T
    d_pre = d_code * (1 - code**2)
    return {
        "score": pooled.T @ d_out,
        "score0": np.array([d_out.sum()]),
        "attend": (value * gate).T @ d_logit,
        "value": code.T @ d_value,
        "gate": code.T @ d_gate,
        "encode": z.T @ d_pre,
        "encode0": d_pre.sum(0),
    }
