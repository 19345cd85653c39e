"""Bytes and words of Arrow text columns as flat numpy arrays.

Words are the runs of bytes other than ``\\x20`` and ``\\x09-\\x0D``. In UTF-8 these
separators never occur inside a character, so bytes can be cut without decoding.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text held by numpy at a time; a longer text is held alone.
SLICE_BYTES = 1 << 20

WORD = r"[^\x20\x09-\x0D]+"

#: The two largest primes below 2**31.
_PRIMES = (np.uint64(2**31 - 1), np.uint64(2**31 - 19))


def n_words(text: Column) -> Column:
    """Number of words; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


class Words(NamedTuple):
    """``start`` and ``end`` in the bytes; the words of row i are first[i]:first[i+1]."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def slices(
    batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of a batch in slices of bounded text, each with its bytes and offsets.

    Null text counts as empty.
    """
    column = batch.column(batch.schema.get_field_index(text))
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1]
    whole = np.frombuffer(buffers[2] or b"", np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        to = min(n, max(to, at + 1))
        data = whole[offsets[at] : offsets[to]]
        yield batch.slice(at, to - at), data, offsets[at : to + 1] - offsets[at]
        at = to


def lower_ascii(data: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def split_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    separator = np.zeros(256, bool)
    separator[[9, 10, 11, 12, 13, 32]] = True
    n = len(data)
    inside = ~separator[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:n]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(start, end, np.searchsorted(start, offsets))


class Hasher:
    """64-bit hashes of byte ranges, equal in every process.

    Two polynomials over random values of the bytes, modulo primes and at random points,
    each taken from prefix sums, and scrambled together with the length. A polynomial of
    degree n has n roots at most, so two different ranges of n bytes share a value with a
    chance of about (n / 2**31)**2, and of 2**-64 at best.
    """

    def __init__(self, seed: int = 7) -> None:
        raw = np.random.PCG64(seed).random_raw(2 * 256 + 2)
        self.steps = np.random.PCG64(seed + 1).random_raw(64) | np.uint64(1)
        self.tables = [raw[256 * i : 256 * (i + 1)] % p for i, p in enumerate(_PRIMES)]
        self.points = [int(x) % int(p) for x, p in zip(raw[512:], _PRIMES, strict=True)]
        self.powers = [(np.ones(1, np.uint64), np.ones(1, np.uint64))] * len(_PRIMES)

    def ranges(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        n = len(data)
        if len(self.powers[0][0]) < n + 1:
            self.powers = [
                (_powers(x, n + 1, int(p)), _powers(pow(x, -1, int(p)), n + 1, int(p)))
                for x, p in zip(self.points, _PRIMES, strict=True)
            ]
        out = (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for i, p in enumerate(_PRIMES):
            up, down = self.powers[i]
            sums = np.zeros(n + 1, np.uint64)
            sums[1:] = self.tables[i][data]
            sums[1:] *= up[:n]
            sums[1:] %= p
            # Below 2**31 each, so that 2**33 bytes could be added up.
            np.cumsum(sums[1:], out=sums[1:])
            own = (sums[end] - sums[start]) % p * down[start] % p
            out = scramble(out ^ own << np.uint64(32 * i))
        return out

    def windows(self, words: np.ndarray, first: np.ndarray, k: int):
        """Hash of every k words in a row within one text, and where each begins."""
        n = len(words) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        total = np.zeros(n, np.uint64)
        for j in range(k):
            total += words[j : j + n] * self.steps[j]
        at = np.flatnonzero(row[:n] == row[k - 1 :])
        return scramble(total[at]), at


def scramble(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int, prime: int) -> np.ndarray:
    """``base ** i`` modulo a prime below 2**31, for i below ``n``."""
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, prime)) % np.uint64(prime)
        done += more
    return out


def extended(df: DataFrame, text: str, column: str, kind, task, keep=None) -> DataFrame:
    """``df``, or its columns ``keep``, with one more column that a task makes.

    ``task()`` gives a function of (bytes, offsets) that returns one Arrow value per
    text. Nothing is shuffled; a column named like the new one is replaced.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c != column]
    read = "__text"
    rows = df.select(*[df[c] for c in keep], df[text].alias(read))
    own = df.select(*keep).schema
    schema = T.StructType([*own.fields, T.StructField(column, kind)])

    def run(batches):
        make = task()
        for batch in batches:
            for part, data, offsets in slices(batch, read):
                columns = [part.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, make(data, offsets)], [*keep, column]
                )

    return rows.mapInArrow(run, schema)
