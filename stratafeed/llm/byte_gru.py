"""Language of texts by a bidirectional gated recurrent network over bytes.

Every byte of every word gets a distribution over languages from a forward and a
backward recurrence over the word; a document pools the distributions of all its
positions. The state starts anew at each word (long words: each piece of
``PIECE_BYTES``), so equal words get equal labels and each distinct word of a slice of
text is run once. Trained in numpy by backpropagation through time.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text
from ._sample import labelled_texts

PIECE_BYTES = 24
UNKNOWN = "und"
_SLICE = 2 << 20


class Model(NamedTuple):
    languages: tuple[str, ...]
    weights: dict[str, np.ndarray]


def fit(
    docs: DataFrame,
    key: str,
    text: str,
    lang: str,
    per_language: int = 1000,
    words_per_text: int = 40,
    steps: int = 900,
    hidden: int = 12,
    seed: int = 8,
) -> Model:
    """Learn from the rows of ``docs`` that have a text and a language.

    At most ``per_language`` documents of each language are used, and of each at most
    ``words_per_text`` different words, drawn from its whole text by a hash. Without
    rows the model knows no language.
    """
    known = docs.where(F.col(text).isNotNull())
    sample = labelled_texts(known, known, key, text, lang, per_language)

    def draw(batches):
        hasher = _text.Hasher(21)
        for batch in batches:
            for part, data, offsets in _text.slices(batch, "text"):
                words = _pieces(data, offsets)
                hashes = hasher.ranges(data, words.start, words.end)
                drawn = []
                for a, b in zip(words.first[:-1], words.first[1:], strict=True):
                    at = a + np.unique(hashes[a:b], return_index=True)[1][:words_per_text]
                    drawn.append([data[words.start[i] : words.end[i]].tobytes() for i in at])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(part.schema.get_field_index("label")),
                        pa.array(drawn, pa.list_(pa.binary())),
                    ],
                    ["label", "words"],
                )

    rows = sample.select(F.col("label").cast("string").alias("label"), "text").mapInArrow(
        draw, "label string, words array<binary>"
    ).collect()
    pairs = sorted((bytes(w), r.label) for r in rows for w in r.words)
    languages = tuple(sorted({r.label for r in rows}))
    return Model(languages, _train(pairs, languages, steps, hidden, seed))


def predict(df: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """``key``, ``lang_pred``, ``score`` and ``n_positions`` of every row.

    Whole texts are read. Null texts and texts without a letter are ``und`` with score
    0, and so is everything if the model knows no language. Equal texts get equal
    results. The score is the pooled probability of the predicted language. Other
    columns are not read.
    """
    rows = df.select(
        F.col(key).alias("key"),
        F.col(text).alias("text"),
        F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letter"),
    )
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches):
        hasher = _text.Hasher()
        for batch in batches:
            for part, data, offsets in _text.slices(batch, "text", _SLICE):
                letter = part.column(part.schema.get_field_index("letter"))
                pooled, positions = _pool(model, data, offsets, hasher)
                known = letter.to_numpy(zero_copy_only=False) & (positions > 0)
                known &= bool(model.languages)
                best = pooled.argmax(1) if model.languages else np.zeros(len(known), int)
                names = np.array([*model.languages, UNKNOWN], object)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(part.schema.get_field_index("key")),
                        pa.array(names[np.where(known, best, len(names) - 1)], pa.string()),
                        pa.array(np.where(known, pooled.max(1, initial=0.0), 0.0)),
                        pa.array(positions.astype(np.int64)),
                    ],
                    ["key", "lang_pred", "score", "n_positions"],
                )

    out = rows.mapInArrow(
        run, f"key {kind}, lang_pred string, score double, n_positions long"
    )
    return out.withColumnRenamed("key", key)


def _pieces(data: np.ndarray, offsets: np.ndarray) -> _text.Words:
    """The words, with long ones cut into pieces."""
    words = _text.split_words(data, offsets)
    n = -(-(words.end - words.start) // PIECE_BYTES)
    word = np.repeat(np.arange(len(n)), n)
    upto = np.concatenate([[0], np.cumsum(n)])
    start = words.start[word] + (np.arange(len(word)) - upto[word]) * PIECE_BYTES
    end = np.minimum(start + PIECE_BYTES, words.end[word])
    return _text.Words(start, end, upto[words.first])


def _pool(model: Model, data, offsets, hasher):
    """Pooled probabilities and the number of positions of each text."""
    words = _pieces(data, offsets)
    rows, size = len(offsets) - 1, len(model.languages)
    row = words.row()
    lengths = words.end - words.start
    positions = np.bincount(row, weights=lengths, minlength=rows)
    if not size or not len(row):
        return np.zeros((rows, size)), positions
    hashes = hasher.ranges(data, words.start, words.end)
    _, at, which = np.unique(hashes, return_index=True, return_inverse=True)
    matrix = _matrix(data, words.start[at], lengths[at])
    logs = label_positions(model, matrix, lengths[at])
    sums = np.zeros((rows, size))
    for j in range(size):
        sums[:, j] = np.bincount(row, weights=logs[which, j], minlength=rows)
    mean = sums / np.maximum(positions, 1)[:, None]
    e = np.exp(mean - mean.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True), positions


def _matrix(data, start, lengths) -> np.ndarray:
    width = int(lengths.max())
    at = start[:, None] + np.arange(width)
    return data[np.minimum(at, len(data) - 1)]


def label_positions(model: Model, matrix, lengths) -> np.ndarray:
    """Sum over the positions of each word of the log probabilities of the languages."""
    order = np.argsort(-lengths, kind="stable")
    x, n = matrix[order], lengths[order]
    w = model.weights
    ahead = [h for h, _ in _recur(x, n, w, "f", range(x.shape[1]))]
    back = [h for h, _ in _recur(x, n, w, "b", range(x.shape[1] - 1, -1, -1))][::-1]
    sums = np.zeros((len(x), len(model.languages)))
    for f, b in zip(ahead, back, strict=True):
        sums[: len(f)] += _log_softmax(f @ w["of"] + b @ w["ob"] + w["o0"])
    out = np.empty_like(sums)
    out[order] = sums
    return out


def _recur(x, n, w, way: str, times):
    """States of one direction, step by step. Rows are sorted by falling length, so
    those that have a byte at t come first; each step has only these."""
    state = np.zeros((len(x), w["r" + way].shape[0]), np.float32)
    for t in times:
        live = int(np.searchsorted(-n, -t, "left"))
        seen = _step(x[:live, t], state[:live].copy(), w, way)
        state[:live] = seen[0]
        yield seen[0], seen


def _step(byte, before, w, way: str):
    hidden = before.shape[1]
    given, kept = w["x" + way][byte], before @ w["r" + way]
    gates = 0.5 * (1 + np.tanh(0.5 * (given[:, : 2 * hidden] + kept[:, : 2 * hidden])))
    update, reset = gates[:, :hidden], gates[:, hidden:]
    new = np.tanh(given[:, 2 * hidden :] + reset * kept[:, 2 * hidden :])
    return before + update * (new - before), (byte, before, update, reset, new, kept)


def _log_softmax(z):
    z = z - z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def _train(pairs, languages, steps, hidden, seed) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    size = len(languages)

    def init(*shape, by=1.0):
        return (rng.normal(0, by, shape)).astype(np.float32)

    w = {"o0": np.zeros(size, np.float32)}
    for way in "fb":
        w["x" + way] = init(256, 3 * hidden, by=0.3)
        w["r" + way] = init(hidden, 3 * hidden, by=hidden**-0.5)
        w["o" + way] = init(hidden, size, by=hidden**-0.5)
    if not pairs or size < 2:
        return w
    texts = [p for p, _ in pairs]
    lengths = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    start = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    number = {name: i for i, name in enumerate(languages)}
    truth = np.array([number[name] for _, name in pairs])
    kinds = [np.flatnonzero(truth == i) for i in range(size)]
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    for step in range(1, steps + 1):
        # As many words of every language.
        chosen = np.concatenate([rng.choice(k, max(1, 256 // size)) for k in kinds])
        chosen = chosen[np.argsort(-lengths[chosen], kind="stable")]
        matrix = _matrix(data, start[chosen], lengths[chosen])
        grads = gradients(w, matrix, lengths[chosen], truth[chosen])[1]
        rate = 0.01 * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            m, v = moment[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g**2 - v)
            w[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w


def gradients(w, x, n, truth):
    """Loss and gradients over all positions of words sorted by falling length."""
    width, total = x.shape[1], float(n.sum())
    runs = {
        "f": [s for _, s in _recur(x, n, w, "f", range(width))],
        "b": [s for _, s in _recur(x, n, w, "b", range(width - 1, -1, -1))][::-1],
    }
    grads = {k: np.zeros_like(v) for k, v in w.items()}
    loss, above = 0.0, {"f": [], "b": []}
    for t in range(width):
        f, b = runs["f"][t][0], runs["b"][t][0]
        logs = _log_softmax(f @ w["of"] + b @ w["ob"] + w["o0"])
        rows = np.arange(len(logs))
        loss -= logs[rows, truth[: len(logs)]].sum() / total
        d = np.exp(logs)
        d[rows, truth[: len(logs)]] -= 1
        d /= total
        grads["of"] += f.T @ d
        grads["ob"] += b.T @ d
        grads["o0"] += d.sum(0)
        above["f"].append(d @ w["of"].T)
        above["b"].append(d @ w["ob"].T)
    hidden = w["rf"].shape[0]
    for way, times in (("f", range(width - 1, -1, -1)), ("b", range(width))):
        down = np.zeros((len(x), hidden), x.dtype if x.dtype.kind == "f" else w["rf"].dtype)
        for t in times:
            byte, before, update, reset, new, kept = runs[way][t][1]
            live = len(before)
            d = down[:live] + above[way][t]
            d_new = d * update * (1 - new**2)
            d_update = d * (new - before) * update * (1 - update)
            d_reset = d_new * kept[:, 2 * hidden :] * reset * (1 - reset)
            d_given = np.concatenate([d_update, d_reset, d_new], 1)
            d_kept = np.concatenate([d_update, d_reset, d_new * reset], 1)
            np.add.at(grads["x" + way], byte, d_given)
            grads["r" + way] += before.T @ d_kept
            down[:live] = d * (1 - update) + d_kept @ w["r" + way].T
    return loss, grads
