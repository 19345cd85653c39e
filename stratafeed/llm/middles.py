"""Fill-in-middle transformation by repeated-capture matching.

One ``fullmatch`` of ``(unit)*`` keeps every repetition of its group: the number of ends
is the number of tokens, and the ends themselves are the places where a text is cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _text

#: White space and the word behind it, or white space alone. A text is covered by the
#: leftmost units in one way only, so nothing is ever given back.
UNIT = r"(?>[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)"

FORM = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
    ]
)


class Markers(NamedTuple):
    """Before prefix, suffix and middle. None may begin as another one ends."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def transform(
    df: DataFrame,
    key: str,
    text: str,
    rate: int = 50,
    spm_rate: int = 80,
    seed: int = 42,
    markers: Markers = Markers(),
    unit: str = UNIT,
    column: str = "fim",
) -> DataFrame:
    """``df`` with a struct ``n, form, prefix_chars, middle_chars, output`` per row.

    A text of ``n`` units is cut before its middle and behind it; where, and which form
    it takes, is drawn from a hash of the seed and the key's text, so runs agree and equal
    keys with equal texts have equal outputs. ``rate`` percent of texts are cut, of them
    ``spm_rate`` percent have the suffix in front. Empty texts and texts that hold a
    marker stay plain, their lengths are null. A null text counts as empty, a null key
    as an empty one; a column named like the new one is replaced. Rows are neither
    dropped nor shuffled, and a text is matched whole and alone.
    """
    own = [c for c in df.columns if c != column]
    draw = F.sha2(
        F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256
    )
    rows = df.select(*[df[c] for c in own], draw.alias("__draw"), df[text].alias("__fim_text"))
    schema = T.StructType([*df.select(*own).schema, T.StructField(column, FORM)])
    n_own = len(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Cutter(unit, rate, spm_rate, markers)
        kind = pa.struct(
            [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
             ("middle_chars", pa.int64()), ("output", pa.string())]
        )
        for batch in batches:
            for part, _, _ in _text.slices(batch, "__fim_text"):
                texts = part.column(n_own + 1)
                made = [
                    cut(text.as_py() or "", drawn.as_py())
                    for text, drawn in zip(texts, part.column(n_own), strict=True)
                ]
                fields = [pa.array(x, t.type) for x, t in zip(zip(*made, strict=True), kind)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n_own], pa.StructArray.from_arrays(fields, fields=list(kind))],
                    [*own, column],
                )

    return rows.mapInArrow(run, schema)


class Cutter:
    """Cuts one text; the pattern is compiled once per task."""

    def __init__(self, unit: str, rate: int, spm_rate: int, markers: Markers) -> None:
        self.units = regex.compile(f"({unit})*+")
        self.rate, self.spm_rate, self.markers = rate, spm_rate, markers

    def __call__(self, text: str, draw: str):
        """``n``, form, characters of prefix and middle, and output."""
        match = self.units.fullmatch(text)
        if match is None:
            raise ValueError("the units do not cover a text")
        ends = match.ends(1)
        n = len(ends)
        h1, h2, h3, h4 = (int(draw[i : i + 8], 16) for i in (0, 8, 16, 24))
        if not text or any(m in text for m in self.markers) or h3 % 100 >= self.rate:
            return n, "plain", None, None, text
        first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
        a = ends[first - 1] if first else 0
        b = ends[last - 1] if last else 0
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        p, s, m = self.markers
        if h4 % 100 < self.spm_rate:
            return n, "spm", a, b - a, f"{s}{suffix}{p}{prefix}{m}{middle}"
        return n, "psm", a, b - a, f"{p}{prefix}{s}{suffix}{m}{middle}"


def restored(output: Column, form: Column, markers: Markers = Markers()) -> Column:
    """The text an output was made of, as an expression; null for an unknown form.

    A cut text holds no marker, so the output holds each once, and splitting at them
    gives the three parts.
    """
    if len({len(m) for m in markers}) != 1:
        raise ValueError("markers of one length are needed")
    body = F.substr(output, F.lit(len(markers.prefix) + 1), F.length(output))
    parts = F.split(body, "|".join(rf"\Q{m}\E" for m in markers))
    first, second, middle = (F.get(parts, F.lit(i)) for i in range(3))
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(first, middle, second))
        .when(form == "spm", F.concat(second, middle, first))
    )
