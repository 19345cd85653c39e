"""Quality rules: text statistics and a learned list of threshold rules.

The list is learned by sequential covering: a rule is a conjunction of thresholds, grown
condition by condition on two thirds of the labelled rows, pruned from its end on the
other third, and kept if it is precise there; what it covers is set aside and the next
rule is sought. The result is an ordered chain of Spark conditions.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _text
from ._sample import labelled_texts

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_distinct_words",
    "n_upper",
    "n_marks",
    "n_echoes",
)
#: Statistics that rules may test: their names and the counts they divide.
RATIOS = {
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_lines_per_word": ("n_dup_lines", "n_words"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
    "echo_share": ("n_echoes", "n_words"),
}

REPEAT_WINDOW = 8
LEAST_WORDS = 20
MOST_REPEAT_PERCENT = 30


class Condition(NamedTuple):
    ratio: str
    above: bool
    threshold: float


class DecisionList(NamedTuple):
    """Rules in order; a row that meets all conditions of one is rejected."""

    rules: tuple[tuple[Condition, ...], ...]

    def rejected_by(self, counts: str = "counts") -> Column:
        """Number of the first rule that rejects a row, null if none does."""
        chain = F.lit(None).cast("int")
        for i, rule in reversed(list(enumerate(self.rules))):
            met = F.lit(True)
            for ratio, above, threshold in rule:
                value = _ratio(ratio, counts)
                met &= (value > threshold) if above else (value <= threshold)
            chain = F.when(met, F.lit(i)).otherwise(chain)
        return chain


def _ratio(name: str, counts: str) -> Column:
    part, whole = (F.col(f"{counts}.{c}").cast("double") for c in RATIOS[name])
    return F.when(whole > 0, part / whole).otherwise(0.0)


def with_counts(
    df: DataFrame, text: str, counts: str = "counts", keep: Sequence[str] | None = None
) -> DataFrame:
    """``df``, or its columns ``keep``, with a struct of the counts of each text.

    Null and empty texts have zeros; a row is counted by itself, so repeated rows have
    equal counts. Nothing is shuffled; a column named like ``counts`` is replaced.

    * ``n_words``, ``word_chars``: words and the code points in them
    * ``n_symbols``: characters of ``#*$%&|<>``
    * ``n_dup_lines``: lines with a word that equal an earlier line
    * ``n_repeat_words``: words within 8-word windows that the text has more than once
    * ``n_distinct_words``; ``n_upper``: A-Z; ``n_marks``: ``!`` and ``?``;
      ``n_echoes``: words equal to the word before
    """
    kind = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])
    return _text.extended(df, text, counts, kind, _count_task, keep)


def base_failed(counts: str = "counts") -> Column:
    """The fixed rules: too short, or mostly repetition."""
    n, repeated = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (n < LEAST_WORDS) | (100 * repeated > MOST_REPEAT_PERCENT * n)


def kept(rules: DecisionList, counts: str = "counts") -> Column:
    """Whether neither the fixed rules nor the list reject a row."""
    return ~base_failed(counts) & rules.rejected_by(counts).isNull()


def learn(
    docs: DataFrame,
    labels: DataFrame,
    key: str,
    text: str,
    label: str,
    per_label: int = 10_000,
    least_precision: float = 0.95,
    most_rules: int = 12,
) -> DecisionList:
    """A list that rejects what resembles label 0, from a bounded sample of labels.

    At most ``per_label`` rows of each label are used. Without rows of both labels the
    list is empty and rejects nothing.
    """
    sample = labelled_texts(docs, labels, key, text, label, per_label)
    drawn = with_counts(sample, "text", keep=["key", "label"]).select(
        F.col("key").cast("string").alias("key"),
        "label",
        *[_ratio(r, "counts").alias(r) for r in RATIOS],
    ).toPandas()
    drawn = drawn.sort_values(["key", *RATIOS], ignore_index=True)
    x = drawn[list(RATIOS)].to_numpy(np.float64)
    bad = drawn["label"].to_numpy() == 0
    return DecisionList(tuple(_cover(x, bad, least_precision, most_rules)))


def _cover(x, bad, least_precision, most_rules):
    held = np.arange(len(bad)) % 3 == 2
    left = np.ones(len(bad), bool)
    for _ in range(most_rules):
        grow, prune = left & ~held, left & held
        if bad[grow].sum() < 5 or (~bad[grow]).sum() == 0:
            return
        rule = _pruned(_grown(x[grow], bad[grow]), x[prune], bad[prune])
        covered = _covers(rule, x)
        n = (covered & prune).sum()
        if not rule or n == 0 or (bad & covered & prune).sum() < least_precision * n:
            return
        yield tuple(Condition(list(RATIOS)[j], up, float(t)) for j, up, t in rule)
        left &= ~covered


def _grown(x, bad, most: int = 4):
    """Conditions that each raise the share of bad rows most (FOIL gain)."""
    rule, live = [], np.ones(len(bad), bool)
    while len(rule) < most and not bad[live].all():
        p, n = bad[live].sum(), (~bad[live]).sum()
        best = (1e-9, None)
        for j in range(x.shape[1]):
            order = np.argsort(x[live, j], kind="stable")
            v, b = x[live, j][order], bad[live][order]
            cut = np.flatnonzero(v[1:] > v[:-1])
            if not len(cut):
                continue
            pos, neg = np.cumsum(b)[cut], np.cumsum(~b)[cut]
            for up, tp, tn in ((False, pos, neg), (True, p - pos, n - neg)):
                gain = tp * (np.log((tp + 1e-9) / (tp + tn)) - np.log(p / (p + n)))
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (gain[i], (j, up, (v[cut[i]] + v[cut[i] + 1]) / 2))
        if best[1] is None:
            break
        rule.append(best[1])
        live &= _covers([best[1]], x)
    return rule


def _pruned(rule, x, bad):
    """The shortest start of the rule that does as well on the other rows."""

    def worth(k):
        covered = _covers(rule[:k], x)
        p, n = (bad & covered).sum(), (~bad & covered).sum()
        return (p - n) / max(p + n, 1)

    return rule[: max(range(1, len(rule) + 1), key=lambda k: (worth(k), -k))] if rule else rule


def _covers(rule, x):
    out = np.ones(len(x), bool)
    for j, up, t in rule:
        out &= (x[:, j] > t) if up else (x[:, j] <= t)
    return out


def _count_task():
    hasher = _text.Hasher()
    symbol, upper, mark, gap = (np.zeros(256, bool) for _ in range(4))
    symbol[list(b"#*$%&|<>")] = True
    upper[65:91] = True
    mark[list(b"!?")] = True
    gap[[9, 10, 11, 12, 13, 32]] = True

    def count(data, offsets):
        counts = _counts(data, offsets, hasher, symbol, upper, mark, gap)
        return pa.StructArray.from_arrays(
            [pa.array(counts[c].astype(np.int64)) for c in COUNTS], COUNTS
        )

    return count


def _counts(data, offsets, hasher, symbol, upper, mark, gap) -> dict[str, np.ndarray]:
    rows = len(offsets) - 1

    def per_row(flags):
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    words = _text.split_words(data, offsets)
    row = words.row()
    hashes = hasher.ranges(data, words.start, words.end)
    own = hashes ^ _text.scramble(row.astype(np.uint64) + np.uint64(1))
    first_seen = np.unique(own, return_index=True)[1]
    echo = np.flatnonzero((hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])) + 1

    grams, at = hasher.windows(hashes, words.first, REPEAT_WINDOW)
    grams = grams ^ _text.scramble(row[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(grams)
    same = grams[order][1:] == grams[order][:-1]
    again = np.zeros(len(grams), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    cover = np.zeros(len(row) + 1, np.int64)
    np.add.at(cover, at[again], 1)
    np.add.at(cover, at[again] + REPEAT_WINDOW, -1)
    repeated = np.flatnonzero(np.cumsum(cover)[:-1] > 0)

    return {
        "n_words": np.diff(words.first),
        "word_chars": per_row(((data & 0xC0) != 0x80) & ~gap[data]),
        "n_symbols": per_row(symbol[data]),
        "n_dup_lines": _repeated_lines(data, offsets, words, hasher),
        "n_repeat_words": np.bincount(row[repeated], minlength=rows),
        "n_distinct_words": np.bincount(row[first_seen], minlength=rows),
        "n_upper": per_row(upper[data]),
        "n_marks": per_row(mark[data]),
        "n_echoes": np.bincount(row[echo], minlength=rows),
    }


def _repeated_lines(data, offsets, words, hasher) -> np.ndarray:
    rows = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    start = start[start < len(data)]
    if not len(start):
        return np.zeros(rows, np.int64)
    # A line ends at its break or where the next text begins.
    stop = np.append(start[1:], len(data))
    end = np.where(data[stop - 1] == 10, stop - 1, stop)
    full = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    start, end = start[full], end[full]
    row = np.searchsorted(offsets, start, "right") - 1
    lines = hasher.ranges(data, start, end)
    lines = lines ^ _text.scramble(row.astype(np.uint64) + np.uint64(1))
    seen = np.unique(lines, return_index=True)[1]
    return np.bincount(row, minlength=rows) - np.bincount(row[seen], minlength=rows)
