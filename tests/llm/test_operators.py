"""Operators on rows that are odd in every way, and against plain versions of them."""

from __future__ import annotations

import hashlib
import re
import textwrap
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from stratafeed.llm import (
    _text,
    byte_gru,
    chat,
    edits,
    graph,
    licences,
    mixing,
    overlap,
    passages,
    pieces,
    rules,
    shards,
)

from .conftest import ODD, PROSE

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def plain_components(rows):
    """(key, size, component) of (key, text) rows, pair by pair."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = root[i], root[j]
                root = [y if r == x else r for r in root]
    least = {}
    for (key, _), r in zip(rows, root, strict=True):
        if key is not None:
            least[r] = min(key, least.get(r, key))
    return Counter(
        (key, len(s), least.get(r) if s else key)
        for (key, _), s, r in zip(rows, sets, root, strict=True)
    )


def test_overlap(spark, odd):
    got = overlap.join(odd, "doc_id", "text").documents
    assert Counter(map(tuple, got.collect())) == plain_components([r[:2] for r in ODD])


def test_overlap_finds_chains_at_the_exact_bound(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(400)]
    rows, text = [], words[:120]
    for i in range(60):
        # Each differs a little from one before it, some just too much.
        text = list(text)
        for at in rng.choice(120, rng.integers(1, 6), replace=False):
            text[at] = words[rng.integers(0, 400)]
        if i % 15 == 14:
            text = [words[k] for k in rng.integers(0, 400, 120)]
        rows.append((100 - i, " ".join(text)))
    rows += [(200 + i, "one two three four five six seven eight nine " + "ten" * (i % 2)) for i in range(4)]
    got = overlap.join(spark.createDataFrame(rows, "k long, t string"), "k", "t")
    assert Counter(map(tuple, got.documents.collect())) == plain_components(rows)
    texts = dict(rows)
    for a, b in got.links.collect():
        x, y = shingles(texts[a]), shingles(texts[b])
        assert 100 * len(x & y) >= 80 * len(x | y)


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 7), (50, 51), (51, 52)]
    got = graph.components(spark.createDataFrame(links, "a long, b long"))
    roots = dict(map(tuple, got.collect()))
    assert {roots[i] for i in (*range(41), 100)} == {0}
    assert {roots[i] for i in (50, 51, 52)} == {50}


def test_empty_tables(spark, none):
    joined = overlap.join(none, "doc_id", "text")
    assert joined.documents.isEmpty() and joined.links.isEmpty()
    assert edits.edited(none, "doc_id", "text").isEmpty()
    assert licences.scan(none, "doc_id", "text").isEmpty()
    assert rules.with_counts(none, "text").isEmpty()
    assert rules.learn(none, none, "doc_id", "text", "size").rules == ()
    model = byte_gru.fit(none, "doc_id", "text", "lang")
    assert model.languages == () and byte_gru.predict(none, "doc_id", "text", model).isEmpty()
    quality = passages.fit(none, none, "doc_id", "text", "size")
    assert passages.with_score(none, "text", quality).isEmpty()
    sized = none.selectExpr("doc_id", "source", "size", "1.0D AS w")
    assert mixing.mix(sized, "doc_id", "source", "size", "w").isEmpty()
    assert shards.with_slots(shards.place(none, "doc_id", 8), "shard", "doc_id").isEmpty()
    empty_chat = spark.createDataFrame([], "c long, t long, r string, x string")
    assert chat.link_quotes(empty_chat, "c", "t", "r", "x").isEmpty()
    assert pieces.encode(none, "text", pieces.load(MODEL)).isEmpty()


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {
        i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)
    }
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_counts(odd):
    extra = ["a\na\n\n \n \nb\na", "x y z a b c d e " * 3 + "end", "\nq\nq"]
    texts = odd.sparkSession.createDataFrame([(t,) for t in extra], "text string")
    for df in (odd, texts):
        for row in rules.with_counts(df, "text").collect():
            got = tuple(row["counts"][c] for c in rules.COUNTS[:5])
            assert got == plain_counts(row["text"]), row["text"]


def test_decision_list_learns_what_labels_mark(spark):
    rows = [(i, f"{PROSE} {i} " + ("## " * 150 if i % 5 == 0 else ""), int(i % 5 != 0)) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    learned = rules.learn(df, df.select("doc_id", "quality"), "doc_id", "text", "quality")
    assert learned.rules
    counted = rules.with_counts(df, "text").withColumn("kept", rules.kept(learned))
    assert all(r["kept"] == (r["quality"] == 1) for r in counted.collect())


def test_attention_classifier(spark, odd):
    rows = [(i, f"{PROSE} {i}\n" + ("| x | y |" * 40 if i % 3 == 0 else PROSE), int(i % 3 != 0)) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = passages.fit(df.where("doc_id < 60"), df.select("doc_id", "quality"), "doc_id", "text", "quality", steps=150)
    scored = passages.with_score(df, "text", model).where("doc_id >= 60").collect()
    assert all((r["score"] >= 0.3) == (r["quality"] == 1) for r in scored)
    got = passages.with_score(odd, "text", model).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    by_text = {}
    for r in got:
        assert by_text.setdefault(r["text"] or "", r["score"]) == pytest.approx(r["score"], abs=1e-9)


def test_attention_gradients():
    rng = np.random.default_rng(0)
    bags = [rng.random((n, passages.WIDTH)) for n in (1, 3, 2)]
    model = passages._train(bags, np.ones(3), 1, 6, 4, 0)
    for k, v in model.weights.items():
        model.weights[k] = v + rng.normal(0, 0.3, v.shape)
    x, first, truth = np.concatenate(bags), np.array([0, 1, 4]), np.array([0.0, 1.0, 1.0])

    def loss():
        out = passages._forward(model, x, first)[0]
        return -(truth * np.log(out) + (1 - truth) * np.log(1 - out)).mean()

    check_gradients(passages._gradients(model, x, first, truth), model.weights, loss, rng, 1e-6)


def check_gradients(grads, weights, loss, rng, by):
    for k, g in grads.items():
        at = tuple(rng.integers(0, n) for n in g.shape)
        kept = weights[k][at]
        weights[k][at] = kept + by
        more = loss()
        weights[k][at] = kept - by
        less = loss()
        weights[k][at] = kept
        assert g[at] == pytest.approx((more - less) / (2 * by), abs=1e-5, rel=1e-3), k


def test_byte_network_gradients():
    rng = np.random.default_rng(0)
    weights = byte_gru._train([], ("a", "b", "c"), 1, 5, 3)
    weights = {k: v.astype(np.float64) for k, v in weights.items()}
    x = rng.integers(97, 101, (4, 5)).astype(np.uint8)
    n, truth = np.array([5, 4, 4, 1]), np.array([0, 2, 1, 1])
    # float64 states for the comparison
    recur = byte_gru._recur

    def wide(x, n, w, way, times):
        state = np.zeros((len(x), w["r" + way].shape[0]))
        for t in times:
            live = int((n > t).sum())
            seen = byte_gru._step(x[:live, t], state[:live].copy(), w, way)
            state[:live] = seen[0]
            yield seen[0], seen

    byte_gru._recur = wide
    try:
        grads = byte_gru.gradients(weights, x, n, truth)[1]
        for k in ("xf", "xb"):
            grads[k] = grads[k][97:101]
        views = {k: (v[97:101] if k in ("xf", "xb") else v) for k, v in weights.items()}
        check_gradients(grads, views, lambda: byte_gru.gradients(weights, x, n, truth)[0], rng, 1e-6)
    finally:
        byte_gru._recur = recur


def test_byte_network(spark, odd):
    rng = np.random.default_rng(2)
    heads = {"x": ["kra", "zol", "mik"], "y": ["eau", "ion", "les"]}
    rows = [
        (i, " ".join("".join(rng.choice(heads[lang], 2)) for _ in range(30)), lang)
        for i in range(60)
        for lang in [("x", "y")[i % 2]]
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = byte_gru.fit(df.where("doc_id < 40"), "doc_id", "text", "lang", steps=80)
    got = byte_gru.predict(df, "doc_id", "text", model).join(df, "doc_id").collect()
    assert all(r["lang_pred"] == r["lang"] for r in got)
    strange = byte_gru.predict(odd.select("text"), "text", "text", model).collect()
    assert len(strange) == len(ODD)
    for r in strange:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters), r["text"]


def test_pieces_equal_the_models_own(odd):
    from sentencepiece import SentencePieceProcessor

    own = SentencePieceProcessor(model_file=MODEL)
    vocabulary = pieces.load(MODEL)
    got = pieces.decode(pieces.encode(odd, "text", vocabulary), "ids", vocabulary).collect()
    assert len(got) == len(ODD)
    for r in got:
        assert r["ids"] == own.encode(r["text"] or "")
        assert r["decoded"] == (r["text"] or "")
    encoder = pieces.Encoder(vocabulary)
    texts = ["  a  b ", "▁▁x", "the" * 90 + " " * 77 + "end", "\n\n \n", "ab" * 60 + "日本" * 40, "\x00"]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    _, data, offsets = next(_text.slices(batch, "text"))
    flat, ends = encoder.encode(data, offsets)
    for i, t in enumerate(texts):
        assert flat[ends[i] : ends[i + 1]].tolist() == own.encode(t)


def test_edits(odd):
    got = edits.edited(odd, "doc_id", "text", least_block=2).collect()
    assert len(got) == len(ODD)
    key = lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode())
    rows = sorted((r[:2] for r in ODD), key=key)
    want = Counter()
    for i, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        n = len(text) // 4
        changed = text[: len(text) - n] + after[:n]
        want[doc, len(text), hashlib.sha256(changed.encode()).hexdigest()] += 1
    assert Counter((r[0], r[1], r[2]) for r in got) == want
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_likeness_follows_edits(spark):
    walker = edits.Walker()
    rng = np.random.default_rng(4)
    base = bytes(rng.integers(97, 123, 3000).astype(np.uint8))
    few = base[:500] + b"zz" + base[500:2000] + base[2003:]
    half = base[:1500] + bytes(rng.integers(97, 123, 1500).astype(np.uint8))
    other = bytes(rng.integers(97, 123, 3000).astype(np.uint8))
    prints = edits.fingerprints([base, few, half, other, base], walker)
    near = [edits.likeness(prints[0], p, walker) for p in prints]
    assert near[0] == near[4] == 1
    assert near[1] > 0.8 > near[2] > 0.4 > 0.25 > near[3]
    rows = [(i, p.text()) for i, p in enumerate(prints)]
    pairs = edits.near_pairs(spark.createDataFrame(rows, "k long, fingerprint string"), "k")
    assert {(r.a, r.b) for r in pairs.collect()} == {(0, 1), (0, 4)}

def test_near_pairs_against_brute_force(spark):
    rng = np.random.default_rng(7)
    letters = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8))
    walker, texts = edits.Walker(), []
    for size in (60, 300, 1000, 2040, 5000) * 6:
        base, cut = letters(size), size // 8
        start = letters(cut) + base[cut:]
        middle = base[: size // 2] + letters(cut) + base[size // 2 + cut :]
        texts += [base, start, middle, base[:-cut] + letters(cut), base + b"more", base]
    prints = edits.fingerprints(texts, walker)
    near = {
        (i, j)
        for j, y in enumerate(prints)
        for i, x in enumerate(prints[:j])
        if edits.likeness(x, y, walker) >= 0.8
    }
    df = spark.createDataFrame([(i, p.text()) for i, p in enumerate(prints)], "k long, fingerprint string")

    def roots(pairs):
        root = list(range(len(prints)))
        for a, b in pairs:
            x, y = sorted((root[a], root[b]))
            root = [x if r == y else r for r in root]
        return root

    got = {(r.a, r.b) for r in edits.near_pairs(df, "k").collect()}
    assert got <= near and roots(got) == roots(near)
    # In wide bands of one position, pivots are mostly unrelated to the others.
    got = {(r.a, r.b) for r in edits.near_pairs(df, "k", bands=3, per_band=1).collect()}
    lost = sum(x != y for x, y in zip(roots(got), roots(near), strict=True))
    assert got <= near and lost <= 0.05 * len(prints)


def test_near_pairs_that_no_band_holds(spark):
    """Differences that hit every band, in fewer than a fifth of the symbols."""
    rng = np.random.default_rng(11)
    task = edits._band_task(0.8, 24, 6)

    def banded(prints):
        batch = pa.RecordBatch.from_pydict({"node": list(range(len(prints))), "fingerprint": prints})
        out = [set() for _ in prints]
        for got in task([batch]):
            for node, band in zip(*(c.to_pylist() for c in got.columns), strict=True):
                out[node].add(band)
        return out

    symbols = "".join("0123456789abcdef"[i] for i in rng.integers(0, 16, 300))
    changed, other = "0:" + symbols, lambda c: "1" if c == "0" else "0"
    own = banded([changed])[0]
    while own & banded([changed])[0]:
        tries = [changed[:i] + other(symbols[i - 2]) + changed[i + 1 :] for i in range(2, 302)]
        changed = min(zip((len(own & b) for b in banded(tries)), tries, strict=True))[1]
    prints = ["0:" + symbols, changed]
    like = edits.likeness(*(edits.parse(p) for p in prints), edits.Walker())
    assert 0.8 <= like < 1
    df = spark.createDataFrame(list(enumerate(prints)), "k long, fingerprint string")
    assert [(r.a, r.b) for r in edits.near_pairs(df, "k").collect()] == [(0, 1)]


def test_blocks_hold_every_pair_of_lengths():
    rng = np.random.default_rng(12)
    for n in [*range(1, 40), 77, 96, 127, 128, 161, 250, 300, 511]:
        for shorter in {max(1, -(-4 * n // 5)), n}:
            long = rng.integers(0, 16, n).astype(np.uint8)
            short = long[:shorter].copy()
            wrong = int(shorter - 0.8 * n + 1e-6)
            at = np.linspace(0, shorter - 1, wrong).astype(int) if wrong else []
            short[at] = (short[at] + 1) % 16
            keys = [
                {k for b in edits._blocks(len(s), 0.8) for k in edits._block_keys(s, 0, b).tolist()}
                for s in (long, short)
            ]
            assert keys[0] & keys[1], (n, shorter)


def test_licences(spark, odd):
    mit = ". ".join(licences.SENTENCES[s] for s in ("mit-grant", "mit-notice", "as-is")) + "."
    rows = [
        (1, "Intro here.\n" + mit.upper()),
        (2, "x. Licensed under CC BY-NC 4.0.\nReleased under the MIT License."),
        (2, "x. Licensed under CC BY-NC 4.0.\nReleased under the MIT License."),
        (3, "permission"),
    ]
    got = licences.scan(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    assert sorted(map(tuple, got.collect())) == [
        (1, "MIT", 0, 1, 3),
        (2, "CC-BY-NC-4.0", 17, 1, 1),
        (2, "MIT", 9, 2, 1),
    ]
    assert licences.scan(odd, "doc_id", "text").isEmpty()

def _commented(text, mark):
    return "\n".join(f"{mark} {line}".rstrip() for line in text.split("\n"))


def test_licences_wrapped_commented_and_within(spark):
    said = licences.SENTENCES | licences.MORE_SENTENCES
    wrap = lambda *ids: "\n\n".join(textwrap.fill(said[i].capitalize() + ".", 76) for i in ids)
    mit = wrap("mit-grant", "mit-notice", "as-is")
    bsd = (
        textwrap.fill(said["bsd-use"].capitalize() + ":", 60)
        + "".join(
            f"\n\n{n}. " + textwrap.fill(said[i].capitalize() + ".", 60, subsequent_indent="   ")
            for n, i in enumerate(("bsd-source", "bsd-binary"), 1)
        )
    )
    apache = (
        'Licensed under the Apache License, Version 2.0 (the "License");\n'
        "you may not use this file except in compliance with the License.\n"
        "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n"
    )
    texts = {
        1: (mit, ["MIT 0 3"]),
        2: (_commented(mit, " *"), ["MIT 0 3"]),
        3: (apache, ["Apache-2.0 4 3"]),
        4: (_commented(apache, "#"), ["Apache-2.0 4 3"]),
        5: (" ".join(apache.split()), ["Apache-2.0 4 3"]),
        6: ("This project is released under the MIT License.", ["MIT 9 1"]),
        7: (bsd + "\n\n3. Neither the name of Acme Inc. nor the names of", ["BSD-3-Clause 22 4"]),
        8: (bsd, ["BSD-2-Clause 3 3"]),
        9: ("// SPDX-License-Identifier: GPL-2.0-or-later", ["GPL-2.0-or-later"]),
        10: ("# SPDX-License-Identifier: GPL-2.0+", ["GPL-2.0-or-later"]),
        11: ("/* SPDX-License-Identifier: GPL-2.0 */", ["GPL-2.0-only"]),
        12: ("-- SPDX-License-Identifier: MIT-0\n-- x", ["MIT-0"]),
        13: (wrap("gpl2-free"), ["GPL-2.0-or-later"]),
        14: (_commented(wrap("agpl3-free"), "dnl"), ["AGPL-3.0-or-later"]),
        15: (wrap("lgpl3-free"), ["LGPL-3.0-or-later"]),
        16: ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If", ["MPL-2.0"]),
        17: ("I want all. Rights reserved. Released under\n\nthe MIT license. All rights\n#\n# reserved", []),
        18: ("released under the\nMIT license and all rights reserved", ["MIT 9 1", "all-rights-reserved 21 1"]),
        19: (wrap("isc-grant") + "\n" + wrap("cc0"), ["ISC", "CC0-1.0"]),
        20: (wrap("gpl-free", "gpl-hope"), ["GPL-3.0-or-later 6 2"]),
    }
    rows = [(i, t) for i, (t, _) in texts.items()] * 2
    got = licences.scan(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()
    for i, (_, want) in texts.items():
        found = sorted(f"{r.licence} {r.rule} {r.n_sentences}" for r in got if r.doc_id == i)
        want = sorted(want)
        assert len(found) == len(want), (i, found)
        assert all(f == w or f.rsplit(" ", 2)[0] == w for f, w in zip(found, want, strict=True)), (i, found)


def test_quotes(spark):
    rows = [
        (1, 0, "user", "How are you?\nI am Ann."),
        (1, 1, "assistant", "Weather is fine."),
        (1, 2, "user", "Ann wrote:\n> How ARE  you?\nFine."),
        (1, 3, "assistant", ">> how are you?\n> Fine.\nGood"),
        (1, 4, "user", "> nothing like this\nhello"),
        (1, 5, "user", None),
        (1, None, "user", "> Fine."),
        (None, 0, "user", "lost"),
        (None, 1, "user", "> lost\nfound"),
        (1, 1, "assistant", "Weather is fine."),
    ]
    df = spark.createDataFrame(rows, "c long, t long, r string, x string")
    got = chat.link_quotes(df, "c", "t", "r", "x")
    found = {(r.c, r.t): r for r in got.collect()}
    assert got.count() == 9
    assert [found[1, t].reply_to for t in range(6)] == [None, None, 0, 2, None, None]
    assert [found[1, t].thread for t in range(6)] == [0, 1, 0, 0, 4, 5]
    assert found[1, 3].depth == 2 and found[1, 3].n_linked == 2
    assert found[1, 2].body == "Fine." and found[1, 4].n_quoted == 1 and found[1, 4].n_linked == 0
    order = [r.t for r in sorted(found.values(), key=lambda r: r.position) if r.c == 1]
    assert order == [None, 0, 2, 3, 1, 4, 5]
    assert found[None, 1].reply_to == 0
    texts = {r.c: r.chat for r in chat.conversations(got, "c", "r").collect()}
    assert texts[None] == "user: lost\n\nuser: found"

def test_quotes_of_sentences_paragraphs_and_parts(spark):
    long = "One two three four\nfive six, seven eight.\n\nThe second paragraph is\nwrapped at a\nfew words here.\n\nEnd."
    rows = [
        (1, 0, "u", "The first one. The second sentence. And a third, with more words, is here."),
        (1, 1, "u", long),
        (1, 2, "u", "> The second sentence.\nYes"),
        (1, 3, "u", "> The second paragraph is wrapped\n> at a few words here.\nNo"),
        (1, 4, "u", "> with more words\nWhich"),
        (1, 5, "u", "> three four five\n> six seven\nWhy"),
        (1, 6, "u", "> more wor\nx"),
        (1, 7, "u", "> words with more\ny"),
        (None, 0, "u", "alpha beta gamma delta epsilon"),
        (None, 1, "u", "> beta gamma delta\nz"),
        (2, 0, "u", "> with more words\nelsewhere"),
    ]
    df = spark.createDataFrame(rows, "c long, t long, r string, x string")
    got = {(r.c, r.t): r for r in chat.link_quotes(df, "c", "t", "r", "x").collect()}
    assert [got[1, t].reply_to for t in range(8)] == [None, None, 0, 1, 0, 1, None, None]
    assert [got[1, t].n_linked for t in range(2, 8)] == [1, 1, 1, 1, 0, 0]
    assert got[None, 1].reply_to == 0 and got[2, 0].reply_to is None


def test_mixing(spark):
    rng = np.random.default_rng(5)
    rows = [
        (i, s, int(rng.integers(0, 90)), float(rng.random()))
        for s, n in (("a", 400), ("b", 900), ("c", 30), (None, 70), ("d", 0))
        for i in range(n)
    ] + [(None, "a", None, None)]
    df = spark.createDataFrame(rows, "k long, s string, n long, w double")
    got = mixing.mix(df, "k", "s", "n", "w").collect()
    assert len(got) == len(rows)
    total = sum(r[2] or 0 for r in rows)
    by = {}
    for r in got:
        by.setdefault(r["s"], []).append(r)
    assert sum(v[0]["target"] for v in by.values()) == pytest.approx(total)
    for name, own in by.items():
        taken = sum((r["n"] or 0) * r["copies"] for r in own)
        assert abs(taken - own[0]["target"]) <= 45, name
        assert own[0]["target"] <= 3 * own[0]["source_size"]
        assert {r["copies"] for r in own} <= {0, 1, 2, 3}
    again = mixing.mix(df.repartition(7), "k", "s", "n", "w").collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert mixing.repeat(spark.createDataFrame([(1, 2), (2, 0)], "k long, copies int")).count() == 2


def test_jump_hash():
    def plain(key, shards):
        b, j = -1, 0
        while j < shards:
            b = j
            key = (key * 2862933555777941757 + 1) % (1 << 64)
            j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
        return b

    keys = np.array([0, 1, 2, 10**12, -1, -(1 << 63)], np.int64)
    for n in (1, 2, 8, 9, 1000):
        assert shards.jump_hash(keys, n).tolist() == [plain(int(k) % (1 << 64), n) for k in keys]
    many = np.arange(20_000)
    eight, nine = shards.jump_hash(many, 8), shards.jump_hash(many, 9)
    assert set(nine[eight != nine]) == {8}
    assert np.bincount(eight).min() > 0.9 * 2500


def test_slots_have_no_gaps(odd, folder):
    placed = shards.with_slots(shards.place(odd, "doc_id", 3), "shard", "doc_id", ["text"], parts=2)
    by = {}
    for r in placed.collect():
        by.setdefault(r["shard"], []).append(r["slot"])
    assert sum(map(len, by.values())) == len(ODD)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    shards.write_shards(odd, f"{folder}/out", "doc_id", 3, 2)
    assert odd.sparkSession.read.parquet(f"{folder}/out").count() == len(ODD)
