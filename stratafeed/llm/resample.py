"""Importance resampling towards a target by hashed n-grams.

A text is normalised to words with one space between them and scanned once; the CRC up to
each word's end is kept. As the CRC of a joined string is the first part's CRC, moved on
by the length of the second, plus (in GF(2)) the second part's CRC, the CRC of any words
in a row follows from two of these prefix values. It is the n-gram's bucket.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import _text
from .graph import stored

# Fixed value: the reversed polynomial of the usual 32-bit CRC.
_POLYNOMIAL = 0xEDB88320
#: Scores of one range are ranked together; ranges are counted first.
_RANGE_BITS = 8


def _separators() -> bytes:
    """Lower-cases A-Z; ASCII other than letters and digits becomes a space."""
    table = bytearray(range(256))
    for b in range(128):
        letter = bytes([b]).decode()
        table[b] = ord(letter.lower()) if letter.isalnum() else 32
    return bytes(table)


class Shift:
    """Moves CRC values on by numbers of zero bytes: c(AB) = shift(c(A), |B|) ^ c(B)."""

    def __init__(self) -> None:
        byte = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            byte = (byte >> np.uint32(1)) ^ (byte & np.uint32(1)) * np.uint32(_POLYNOMIAL)
        basis = np.uint32(1) << np.arange(32, dtype=np.uint32)
        #: Per power of two of bytes, the images of all values of each of four bytes.
        self.tables = [self._expanded(byte[basis & np.uint32(255)] ^ (basis >> np.uint32(8)))]

    @staticmethod
    def _expanded(images: np.ndarray) -> np.ndarray:
        """Tables of the linear map that takes bit i to ``images[i]``."""
        out = np.zeros((4, 256), np.uint32)
        values = np.arange(256)
        for j in range(4):
            for bit in range(8):
                out[j] ^= np.where(values >> bit & 1, images[8 * j + bit], np.uint32(0))
        return out

    @staticmethod
    def _apply(table: np.ndarray, c: np.ndarray) -> np.ndarray:
        out = table[0][c & np.uint32(255)]
        for j in (1, 2, 3):
            out ^= table[j][(c >> np.uint32(8 * j)) & np.uint32(255)]
        return out

    def __call__(self, c: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
        out, left, k = c.copy(), n_bytes.copy(), 0
        while left.any():
            if k == len(self.tables):
                once = self._apply(self.tables[-1], np.uint32(1) << np.arange(32, dtype=np.uint32))
                self.tables.append(self._expanded(self._apply(self.tables[-1], once)))
            odd = np.flatnonzero(left & 1)
            out[odd] = self._apply(self.tables[k], out[odd])
            left >>= 1
            k += 1
        return out


class Scanner:
    """Buckets of all n-grams of a text."""

    def __init__(self, most_words: int, buckets: int) -> None:
        self.most_words, self.buckets = most_words, buckets
        self.table, self.shift = _separators(), Shift()

    def __call__(self, raw: bytes) -> tuple[int, np.ndarray]:
        """Number of words, and the bucket of each n-gram, shorter ones first."""
        words = raw.translate(self.table).split()
        n = len(words)
        if not n:
            return 0, np.zeros(0, np.int32)
        # CRC and length of the normalised text up to the end of each word.
        spaced = [words[0], *(b" " + w for w in words[1:])]
        ends = np.fromiter(
            accumulate(spaced, lambda c, w: crc32(w, c), initial=0), np.uint32, n + 1
        )
        upto = np.cumsum(np.fromiter(map(len, spaced), np.int64, n))
        # The same before each word: one space behind the word before it.
        begins = np.zeros(n, np.uint32)
        begins[1:] = self.space(ends[1:-1])
        starts = np.zeros(n, np.int64)
        starts[1:] = upto[:-1] + 1
        grams = []
        for k in range(1, min(self.most_words, n) + 1):
            last = ends[k:]
            grams.append(last ^ self.shift(begins[: n - k + 1], upto[k - 1 :] - starts[: n - k + 1]))
        return n, (np.concatenate(grams) % np.uint32(self.buckets)).astype(np.int32)

    def space(self, c: np.ndarray) -> np.ndarray:
        """CRC of each string with a space behind it."""
        one = np.ones(len(c), np.int64)
        return self.shift(c, one) ^ np.uint32(crc32(b" "))


def features(
    df: DataFrame, text: str, keep: Sequence[str], most_words: int, buckets: int
) -> DataFrame:
    """Columns ``keep``, ``n_words``, and ``buckets``, one per run of 1 to ``most_words``
    words. A null text has none. Nothing is shuffled."""
    rows = df.select(*[df[c] for c in keep], df[text].alias("__dsir_text"))
    schema = T.StructType(
        [
            *df.select(*keep).schema,
            T.StructField("n_words", T.LongType()),
            T.StructField("buckets", T.ArrayType(T.IntegerType(), False)),
        ]
    )
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(most_words, buckets)
        for batch in batches:
            for part, data, offsets in _text.slices(batch, "__dsir_text"):
                raw = data.tobytes()
                found = [scan(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                ends = np.cumsum([0, *(len(b) for _, b in found)])
                lists = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(np.concatenate([b for _, b in found]))
                )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n_keep], pa.array([n for n, _ in found], pa.int64()), lists],
                    [*keep, "n_words", "buckets"],
                )

    return rows.mapInArrow(run, schema)


def bucket_counts(found: DataFrame) -> DataFrame:
    """``bucket`` and ``n``: how often each occurs. Counted within tasks first, so at most
    one row per bucket and task is shuffled."""
    return (
        found.select(F.explode("buckets").alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("n"))
    )


def gains(source: DataFrame, target: DataFrame, buckets: int) -> list[int]:
    """Per bucket floor(1000 ln) of its smoothed share in the target over the source's.

    Counts of ``buckets`` rows, a parameter, come to the driver.
    """
    counts = np.zeros((2, buckets))
    for row, found in zip(counts, (source, target), strict=True):
        for r in bucket_counts(found).collect():
            row[r.bucket] = r.n
    (s, t), (s_all, t_all) = counts, counts.sum(axis=1) + buckets
    return np.floor(1000 * np.log((t + 1) * s_all / ((s + 1) * t_all))).astype(int).tolist()


def _weighted(found: DataFrame, gain: Sequence[int]) -> DataFrame:
    """``n_features`` and ``weight``, the floored mean gain, in place of the buckets."""
    keep = [c for c in found.columns if c != "buckets"]
    at = found.columns.index("buckets")
    schema = T.StructType(
        [
            *found.select(*keep).schema,
            T.StructField("n_features", T.LongType()),
            T.StructField("weight", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = np.array(gain, np.int64)
        for batch in batches:
            lists = batch.column(at)
            n = lists.value_lengths().to_numpy()
            upto = np.concatenate([[0], np.cumsum(values[lists.flatten().to_numpy()])])
            ends = np.concatenate([[0], np.cumsum(n)])
            weight = (upto[ends[1:]] - upto[ends[:-1]]) // np.maximum(n, 1)
            others = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*others, pa.array(n, pa.int64()), pa.array(weight)],
                [*keep, "n_features", "weight"],
            )

    return found.mapInArrow(run, schema)


def noise(key: Column, seed: int) -> Column:
    """floor(1000 g) of a Gumbel draw g from a hash of the seed and the key's text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    key: str,
    text: str,
    target_text: str,
    percent: int = 10,
    least_words: int = 20,
    most_words: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
) -> DataFrame:
    """``key``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row.

    The weight is the mean gain of a text's n-grams, the score adds a Gumbel draw, so that
    the highest scores are a sample without replacement in proportion to the weights.
    Drawn are ``percent`` of the rows with ``least_words`` words or more, by falling score
    and rising key, null keys first; they are ranked from 1, the others have no rank.
    Texts without words, null ones too, weigh 0; null keys share a draw. Rows with the
    same key and score are told apart by their number of features and words only, so
    equal rows swap ranks freely. Without rows, or with an empty target, nothing fails.

    Texts are scanned once; numbers of buckets are written to the shared folder, as they
    are counted first and weighed then.
    """
    named = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    wanted = target.select(F.col(target_text).alias("__text"))
    found = stored(features(named, "__text", ["__key"], most_words, buckets), "buckets")
    gain = gains(found, features(wanted, "__text", [], most_words, buckets), buckets)
    scored = _weighted(found, gain).withColumn("score", F.col("weight") + noise(F.col("__key"), seed))
    # Ranked twice over: the scores of each range, then the rows of each score.
    scored = stored(scored, "scores")
    ranked = _ranked(scored, F.col("n_words") >= least_words, percent)
    return ranked.select(F.col("__key").alias(key), "n_features", "weight", "score", "rank")


def _ranked(scored: DataFrame, fit: Column, percent: int) -> DataFrame:
    """Scores are whole thousandths within some tens of thousands, whatever the number of
    rows, so rows per score are counted, the counts added up from the highest, and rows
    are only sorted within one score. Ranges of scores keep the adding up short."""
    band = F.shiftright("score", _RANGE_BITS)
    per_score = (
        scored.groupBy("score")
        .agg(F.count_if(fit).alias("__n"))
        .withColumn("__band", band)
    )
    above = Window.orderBy(F.col("__band").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    bands = (
        per_score.groupBy("__band")
        .agg(F.sum("__n").alias("__in_band"))
        .withColumn("__above", F.coalesce(F.sum("__in_band").over(above), F.lit(0)))
        .withColumn("__drawn", F.floor(percent * F.sum("__in_band").over(everything) / 100))
        .drop("__in_band")
    )
    higher = (
        Window.partitionBy("__band")
        .orderBy(F.col("score").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = per_score.join(bands, "__band").select(
        "score",
        "__drawn",
        (F.col("__above") + F.coalesce(F.sum("__n").over(higher), F.lit(0))).alias("__before"),
    )
    within = Window.partitionBy("score").orderBy(fit.desc(), "__key", "n_features", "n_words")
    place = F.col("__before") + F.col("__within")
    return (
        scored.join(before, "score")
        .withColumn("__within", F.row_number().over(within))
        .withColumn("rank", F.when(fit & (place <= F.col("__drawn")), place).cast("long"))
    )
