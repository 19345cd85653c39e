"""Mixing sources to target weights by weighted sampling without replacement.

Every document draws an exponential key, divided by its quality weight (Efraimidis and
Spirakis, 2006); ascending keys are a weighted random order. A source's budget of words
is served in complete epochs first; what remains goes to the documents that come first
in this order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Weights of the sources in the order of their names, repeating.
CYCLE = (5, 2, 1)


def targets(
    sources: DataFrame, source: str, size: str, cycle=CYCLE, most_epochs: int = 3
) -> DataFrame:
    """Target size of each source, from one row per source.

    Sources in code point order, null last, weigh ``cycle``, repeating. Together they
    get the sum of all sizes in proportion to their weights; none gets more than
    ``most_epochs`` times its own size, and the excess goes to the others by weight.

    A source is at its bound if, of all sources with a smaller or equal bound per
    weight, what the rest would get per weight is more than that. So the bounds are
    found with running sums in that order instead of repeated sharing.
    """
    # One row per source meets in one task here; these are counts, not documents.
    ordered = Window.orderBy(F.col(source).asc_nulls_last())
    turn = (F.row_number().over(ordered) - 1) % len(cycle)
    weigh = F.array(*[F.lit(float(w)) for w in cycle])[turn]
    total, cap = F.col("__total"), F.col("__cap")
    by_bound = (
        Window.orderBy(cap / F.col("weight"), F.col(source).asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    capped_sum = F.coalesce(F.sum(cap).over(by_bound), F.lit(0.0))
    capped_weight = F.coalesce(F.sum("weight").over(by_bound), F.lit(0.0))
    everything = Window.partitionBy()
    at_bound = cap * F.col("__weight_left") <= F.col("__left") * F.col("weight")
    free = ~F.col("__at_bound")
    return (
        sources.withColumn("weight", weigh)
        .withColumn("__cap", most_epochs * F.col(size).cast("double"))
        .withColumn("__total", F.sum(F.col(size).cast("double")).over(everything))
        .withColumn("__weights", F.sum("weight").over(everything))
        .withColumn("__left", total - capped_sum)
        .withColumn("__weight_left", F.col("__weights") - capped_weight)
        .withColumn("__at_bound", at_bound)
        .withColumn(
            "__rest",
            total
            - F.sum(F.when(~free, cap).otherwise(0.0)).over(everything),
        )
        .withColumn(
            "__rest_weight",
            F.sum(F.when(free, F.col("weight")).otherwise(0.0)).over(everything),
        )
        .withColumn(
            "target",
            F.when(free, F.col("__rest") * F.col("weight") / F.col("__rest_weight"))
            .otherwise(cap),
        )
        .select(source, "weight", "target")
    )


def sampling_key(key: Column, weight: Column, seed: int) -> Column:
    """-ln(u) / weight with u in (0, 1) from a hash of the key; weight must be > 0."""
    bits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 12)
    u = (F.conv(bits, 16, 10).cast("double") + 0.5) / float(1 << 48)
    return -F.log(u) / weight


def mix(
    df: DataFrame,
    key: str,
    source: str,
    size: str,
    weight: str,
    cycle=CYCLE,
    most_epochs: int = 3,
    seed: int = 9,
    parts: int = 256,
    ties: Sequence[str] = (),
) -> DataFrame:
    """``df`` with ``source_size``, ``target`` and ``copies`` per row.

    ``copies`` is how often the mix takes the row, at most ``most_epochs``. The row that
    crosses the budget is taken if that brings its source nearer to the target, so a
    source misses its target by half a row at most. Rows of size 0 are never taken more
    than the complete epochs; if a source has only such rows, its target is 0 and no
    copy is taken. Null sizes and negative ones count 0, null or non-positive weights
    count as the least positive weight; a null source is a source of its own. Equal
    keys share a random draw and are ordered by size and ``ties``.

    A source's rows are spread over ranges of their draw, ``parts`` for each doubling of
    it: exponential draws of any weight cover several doublings. Range sums are added up
    per source, and only a range is sorted, so many tasks share a source of any size.
    All columns of ``df`` are shuffled once; leave the texts out where they are not
    needed.
    """
    own = [c for c in df.columns if c not in ("source_size", "target", "copies")]
    s, w, draw, part = "__source", "__weight", "__draw", "__part"
    rows = (
        df.select(*own)
        .withColumn("__size", F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("long"))
        .withColumn(w, F.when(F.col(weight) > 1e-6, F.col(weight)).otherwise(1e-6))
        .withColumn(s, F.struct(F.col(source).isNull().alias("none"), F.coalesce(F.col(source), F.lit("")).alias("name")))
        .withColumn(draw, sampling_key(F.coalesce(F.col(key).cast("string"), F.lit("")), F.col(w), seed))
        .withColumn(part, F.floor(F.log2(draw) * parts).cast("int"))
    )
    ranges = rows.groupBy(s, part).agg(F.sum("__size").alias("__words"))
    sizes = ranges.groupBy(s).agg(F.sum("__words").alias("source_size"))
    aims = (
        targets(
            sizes.select(s, "source_size", F.when(~F.col(f"{s}.none"), F.col(f"{s}.name")).alias("__name")),
            "__name", "source_size", cycle, most_epochs,
        )
        .select(
            F.struct(F.col("__name").isNull().alias("none"), F.coalesce("__name", F.lit("")).alias("name")).alias(s),
            "target",
        )
        .join(sizes, s)
    )
    upto = Window.partitionBy(s).orderBy(part)
    begins = (
        ranges.withColumn("__before", F.sum("__words").over(upto) - F.col("__words"))
        .drop("__words")
        .join(aims, s)
    )
    inside = Window.partitionBy(s, part).orderBy(draw, key, "__size", *ties).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    epochs = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    budget = F.col("target") - F.col("__epochs") * F.col("source_size")
    middle = F.col("__upto") - F.col("__size") / 2
    more = (F.col("__size") > 0) & (F.col("__epochs") < most_epochs) & (middle <= F.col("__budget"))
    return (
        rows.withColumn("__inside", F.sum("__size").over(inside))
        .join(begins, [s, part])
        .withColumn("__upto", F.col("__before") + F.col("__inside"))
        .withColumn("__epochs", epochs.cast("int"))
        .withColumn("__budget", budget)
        .withColumn("copies", F.col("__epochs") + more.cast("int"))
        .select(*own, "source_size", "target", "copies")
    )


def repeat(df: DataFrame, copies: str = "copies") -> DataFrame:
    """Every row as often as its ``copies`` say, without that column."""
    return (
        df.where(F.col(copies) > 0)
        .withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies))))
        .drop(copies)
    )
