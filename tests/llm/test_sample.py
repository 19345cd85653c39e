"""The bounded sample against a plain ranking."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratafeed.llm._sample import labelled_texts


def brute(labels, per_label):
    order = Window.partitionBy("label").orderBy(F.xxhash64("id", F.lit(3)), "id")
    ranked = labels.withColumn("rank", F.row_number().over(order))
    return {(r.id, r.label) for r in ranked.where(F.col("rank") <= per_label).collect()}


@pytest.mark.parametrize("per_label", [1, 40, 700, 100_000])
def test_one_label_may_hold_most_rows(spark, per_label):
    label = F.when(F.col("id") % 50 == 0, 2).when(F.col("id") % 7 == 0, 1).otherwise(0)
    labels = spark.range(9000).withColumn("label", label)
    docs = spark.range(9000).withColumn("text", F.lit("a b"))
    drawn = labelled_texts(docs, labels, "id", "text", "label", per_label)
    assert {(r.key, r.label) for r in drawn.collect()} == brute(labels, per_label)


def test_nulls_repeats_and_no_rows(spark):
    labels = spark.createDataFrame(
        [(None, 1), (1, None), (2, 1), (2, 0), (2, 0), (3, 1)], "id long, label int"
    )
    docs = spark.createDataFrame([(2, None), (2, "b"), (9, "c")], "id long, text string")
    drawn = labelled_texts(docs, labels, "id", "text", "label", 5)
    # One row per key, so that the bound holds for rows.
    rows = [(r.key, r.text, r.label) for r in drawn.collect()]
    assert len(rows) == 1 and rows[0] in {(2, None, 0), (2, "b", 0)}
    assert labelled_texts(docs, labels.limit(0), "id", "text", "label", 5).count() == 0


def complements(rounds=10):
    """A word of 2**rounds letters and its complement, which agree in every polynomial
    modulo a power of two with an odd point."""
    word, swap = "a", str.maketrans("ab", "ba")
    for _ in range(rounds):
        word += word.translate(swap)
    return word, word.translate(swap)


def test_long_words_that_hash_alike_modulo_powers_of_two():
    import numpy as np
    import pytest
    from sentencepiece import SentencePieceProcessor

    from stratafeed.llm import _text, pieces
    from stratafeed.llm.queries import PIECE_MODEL

    one, other = complements()
    data = np.frombuffer((one + other).encode(), np.uint8)
    n = len(one)
    for seed in range(5):
        hashes = _text.Hasher(seed).ranges(data, np.array([0, n]), np.array([n, 2 * n]))
        assert hashes[0] != hashes[1]
    if not Path(PIECE_MODEL).exists():
        pytest.skip("no model")
    model = SentencePieceProcessor(model_file=PIECE_MODEL)
    encoder = pieces.Encoder(pieces.load(PIECE_MODEL))
    offsets = np.array([0, n, 2 * n])
    for _ in range(2):
        ids, ends = encoder.encode(data, offsets)
        found = [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        assert found == [model.encode(one), model.encode(other)]


def test_hashes_of_ranges_follow_the_bytes():
    import numpy as np

    from stratafeed.llm import _text

    raw = b"some words, some other words and some words again"
    cuts = [(i, j) for i in range(len(raw)) for j in range(i + 1, len(raw) + 1)]
    start, end = (np.array(x) for x in zip(*cuts, strict=True))
    hashes = _text.Hasher().ranges(np.frombuffer(raw, np.uint8), start, end)
    by_bytes = {}
    for (i, j), value in zip(cuts, hashes.tolist(), strict=True):
        assert by_bytes.setdefault(raw[i:j], value) == value
    assert len(set(by_bytes.values())) == len(by_bytes)


def test_a_key_that_repeats_is_one_row_of_the_sample(spark):
    docs = spark.range(5000).select(
        F.lit(1).alias("k"), F.concat(F.lit("text "), F.col("id") % 40).alias("t"), F.lit("x").alias("label")
    )
    docs = docs.unionByName(spark.createDataFrame([(2, None, "x"), (2, "b", "x"), (3, None, "x")], docs.schema))
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (3, 1), (3, 1)], "k int, label int")
    for parts in (1, 7):
        got = labelled_texts(docs.repartition(parts), labels, "k", "t", "label", 10).collect()
        assert sorted((r.key, r.label) for r in got) == [(1, 0), (2, 1), (3, 1)]
        texts = {r.key: r.text for r in got}
        assert texts[1].startswith("text ") and texts[3] is None
        first = texts if parts == 1 else first
        assert texts == first


def test_a_large_group_around_the_threshold(spark):
    """Texts a few edits away from one another, most pairs just below the threshold, with
    copies, and shorter and longer ones; components equal those of all pairs."""
    import random

    from stratafeed.llm import overlap

    draw = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(400):
        words = list(base)
        for _ in range(draw.choice([1, 2, 2, 3, 3, 4, 5])):
            words[draw.randrange(len(words))] = f"x{draw.random()}"
        texts.append(" ".join(words[: draw.choice([150, 150, 150, 140, 125])]))
    texts += texts[:20] + [" ".join(base) + f" tail{i}" * 3 for i in range(5)]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= 80 * len(a | b) and find(i) != find(j):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    assert 20 < len({find(i) for i in range(len(texts))}) < 380
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(5)
    for rounds in (4, 0):
        got = overlap.join(docs, "id", "text", star_rounds=rounds).documents.collect()
        assert {r.id: r.component_id for r in got} == {i: find(i) for i in range(len(texts))}


def shuffled_bytes(spark, run):
    """Bytes that the stages of ``run`` write to shuffles."""
    sc = spark.sparkContext._jsc.sc()
    none = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)

    def written():
        sc.listenerBus().waitUntilEmpty(30_000)
        stages = sc.statusStore().stageList(None, False, False, none, None)
        done = [stages.apply(i) for i in range(stages.size())]
        return {(s.stageId(), s.attemptId()): s.shuffleWriteBytes() for s in done}

    before = written()
    run()
    return sum(n for stage, n in written().items() if stage not in before)


def near_copies(groups, size):
    """Groups of texts of 300 words of which each has a word of its own."""
    rows = []
    for g in range(groups):
        words = [f"g{g}w{i}" for i in range(300)]
        for c in range(size):
            own = list(words)
            own[(37 * c) % 300] = f"own{g}x{c}"
            rows.append((g * size + c, " ".join(own)))
    return rows


def test_texts_and_columns_are_shuffled_few_times(spark):
    """10.8 MB when each round shuffled all columns and every text went twice; 5.9 MB now."""
    from stratafeed.llm import overlap

    docs = spark.createDataFrame(near_copies(60, 12), "id long, text string").repartition(5)
    got = []
    moved = shuffled_bytes(spark, lambda: got.extend(overlap.join(docs, "id", "text").documents.collect()))
    assert {r.id: r.component_id for r in got} == {i: i // 12 * 12 for i in range(720)}
    assert moved < 8_000_000


def test_places_beyond_the_last_and_repeated_rows(spark):
    """Long texts that differ at columns behind the last place of an entry, and rows that
    are repeated as a whole."""
    from stratafeed.llm import overlap

    words = [f"w{i}" for i in range(400_000)]
    # Its own columns, and those before the first that both have, fill more than 2**16 places.
    other = [f"x{i}" if i < 75_000 else w for i, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:330_000])), (3, " ".join(other))]
    rows += near_copies(1, 3)[:2] * 2
    docs = spark.createDataFrame(rows, "id long, text string").repartition(3)
    got = overlap.join(docs, "id", "text").documents.collect()
    assert sorted((r.id, r.component_id) for r in got) == [(0, 0), (0, 0), (1, 0), (1, 0), (1, 1), (2, 1), (3, 3)]
