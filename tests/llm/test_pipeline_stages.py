"""Each stage of the pipeline on a small fixture against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict
from pathlib import Path

import pytest

import corpus_pipeline
from stratafeed.llm import passages, rules
from stratafeed.llm.queries import LEAST_QUALITY, PIECE_MODEL, quality_model, table

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    """Given documents with copies, near copies, junk, nulls and empty texts beside them."""
    draw = random.Random(4)
    given = [tuple(r) for r in table(spark, SF_DIR, "documents").orderBy("doc_id").limit(120).collect()]
    made = []
    for i, row in enumerate(given[:25]):
        words = (row[1] or "").split(" ")
        if len(words) > 40:
            words[draw.randrange(len(words))] = "changed"
        made.append((10_000 + i, " ".join(words), row[2], row[3], 0))
        made.append((20_000 + i, row[1], row[2], f"s{i % 2}", 0))
    odd = [(30_000, None, None, None, None), (30_001, "", "en", "s0", 0), (30_002, "### $$$ " * 50, "en", "s1", 0)]
    return spark.createDataFrame(given + made + odd, SCHEMA).repartition(3)


def ids(df):
    return sorted(r.doc_id for r in df.collect())


def test_classifier_stage(spark, docs):
    """The threshold splits the documents by the score each of them has alone."""
    model = quality_model(table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels"))
    scores = {r.doc_id: r.score for r in passages.with_score(docs, "text", model, keep=["doc_id"]).collect()}
    kept = ids(corpus_pipeline.quality_classifier(spark, docs, SF_DIR))
    assert kept == sorted(i for i, s in scores.items() if s >= LEAST_QUALITY)
    assert 0 < len(kept) < len(scores)


def test_rules_stage(spark, docs):
    """Documents go by the fixed limits, or by the first condition of the list that holds."""
    learned = rules.learn(
        table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels"), "doc_id", "text", "quality"
    )
    kept = set(ids(corpus_pipeline.quality_rules(spark, docs, SF_DIR)))
    shown = rules.with_counts(docs, "text", keep=["doc_id", "text"])
    rows = shown.select("doc_id", "text", "counts", learned.rejected_by().alias("by")).collect()
    for r in rows:
        words = (r.text or "").replace("\x0b", " ").replace("\x0c", " ").split()
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        within = {
            i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)
        }
        assert (r.counts.n_words, r.counts.n_repeat_words) == (len(words), len(within))
        base_failed = len(words) < 20 or 100 * len(within) > 30 * len(words)
        assert (r.doc_id in kept) == (not base_failed and r.by is None)
    assert 0 < len(kept) < len(rows)


def shingles(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_near_copies_stage(spark, docs):
    """The smallest id of each component of all pairs stays."""
    rows = [(r.doc_id, shingles(r.text)) for r in docs.collect()]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a) in enumerate(rows):
        for j, b in rows[:n]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    expected = sorted({find(i) for i in root})
    assert ids(corpus_pipeline.one_per_group(spark, docs, SF_DIR)) == expected
    assert len(expected) < len(rows) - 20


def test_mixing_stage(spark, docs):
    """Copies follow the draws: whole epochs first, then by rising key up to the budget."""
    got = Counter(r.doc_id for r in corpus_pipeline.weighted_mix(spark, docs, SF_DIR).collect())
    by_source = defaultdict(list)
    for r in docs.collect():
        text = r.text or ""
        symbols = sum(c in "#*$%&|<>" for c in text)
        bits = hashlib.md5(f"9:{r.doc_id}".encode()).hexdigest()[:12]
        draw = -math.log((int(bits, 16) + 0.5) / 2**48) * (1 + symbols)
        by_source[r.source].append((draw, r.doc_id, len(text.split())))
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    sizes = {s: sum(n for *_, n in by_source[s]) for s in names}
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    targets, open_, left = {}, set(names), float(sum(sizes.values()))
    while True:
        share = {s: left * weights[s] / sum(weights[o] for o in open_) for s in open_}
        full = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not full:
            targets |= share
            break
        for s in full:
            targets[s] = 3.0 * sizes[s]
        left, open_ = left - sum(targets[s] for s in full), open_ - full
    expected = Counter()
    for s in names:
        epochs = math.floor(targets[s] / sizes[s]) if sizes[s] else 0
        budget, upto = targets[s] - epochs * sizes[s], 0
        for _, doc_id, n in sorted(by_source[s]):
            upto += n
            more = n > 0 and epochs < 3 and upto - n / 2 <= budget
            expected[doc_id] += epochs + more
    assert got == +expected


def test_pieces_stage(spark, docs):
    if not Path(PIECE_MODEL).exists():
        pytest.skip("no model")
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=PIECE_MODEL)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = corpus_pipeline.encode_pieces(spark, docs, SF_DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        assert list(r.ids) == model.encode(texts[r.doc_id]) and r.n_pieces == len(r.ids)
