"""Licence scans: known sentences, then rules over their sequences.

A text is normalised to its words of letters a-z and digits, and known sentences are
found as sequences of these words: line breaks and comment marks within them do not
matter, and other words may stand around them. A rule is a sequence of identifiers of
sentences that follow each other. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .chat import _let

# Sentences of public licence texts and notices, normalised.
SENTENCES = {
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-notice-long": "licensed under the apache license version 2 0 the license",
    "apache-compliance": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "mit-released": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "bsd-use": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "mpl2-form": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "cc-by-nc-4": "licensed under cc by nc 4 0",
    "cc-by-4": "licensed under cc by 4 0",
    "cc-by-sa-4": "licensed under cc by sa 4 0",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "reserved": "all rights reserved",
}

#: (licence, sentences): earlier rules go first.
RULES = (
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("BSD-3-Clause", ("bsd-use", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-use", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-notice-long", "apache-compliance", "apache-copy")),
    ("Apache-2.0", ("apache-notice", "apache-compliance")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    ("Apache-2.0", ("apache-notice",)),
    ("Apache-2.0", ("apache-notice-long",)),
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("mit-grant",)),
    ("GPL-3.0-only", ("gpl3-work",)),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("LGPL-2.1-or-later", ("lgpl-free",)),
    ("MPL-2.0", ("mpl2-form",)),
    ("ISC", ("isc-grant",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC0-1.0", ("cc0",)),
    ("all-rights-reserved", ("reserved",)),
)



def _gnu(work: str, licence: str, version: str) -> str:
    return (
        f"this {work} is free software you can redistribute it and or modify it under the terms of the gnu {licence} "
        f"as published by the free software foundation either version {version} of the license or at your option any later version"
    )


def _only(licence: str, version: str) -> str:
    return f"under the terms of the gnu {licence} version {version} as published by the free software foundation"


_LESSER, _AFFERO, _GENERAL = (f"{k}general public license" for k in ("lesser ", "affero ", ""))

#: Sentences and licences that ``scan_sql`` does not know.
MORE_SENTENCES = {
    "bsd-neither": "neither the name of",
    "gpl2-free": _gnu("program", _GENERAL, "2"),
    "gpl2-free-software": _gnu("software", _GENERAL, "2"),
    "gpl3-free-software": _gnu("software", _GENERAL, "3"),
    "agpl3-free": _gnu("program", _AFFERO, "3"),
    "lgpl2-free": _gnu("library", _LESSER, "2"),
    "lgpl3-free": _gnu("library", _LESSER, "3"),
    "lgpl21-free-program": _gnu("program", _LESSER, "2 1"),
    "lgpl3-free-program": _gnu("program", _LESSER, "3"),
    "gpl2-only": _only(_GENERAL, "2"),
    "gpl3-only": _only(_GENERAL, "3"),
    "agpl3-only": _only(_AFFERO, "3"),
    "lgpl21-only": _only(_LESSER, "2 1"),
    "lgpl3-only": _only(_LESSER, "3"),
    "gpl2-work": "licensed under the gnu general public license version 2",
    "gpl3-licensed": "licensed under the gnu general public license version 3",
    "agpl3-work": "licensed under the gnu affero general public license version 3",
    "lgpl21-work": "licensed under the gnu lesser general public license version 2 1",
    "lgpl3-work": "licensed under the gnu lesser general public license version 3",
    "apache-released": "released under the apache license version 2 0",
    "mit-terms": "under the terms of the mit license",
    "epl2-terms": "under the terms of the eclipse public license 2 0",
    "epl2-terms-v": "under the terms of the eclipse public license v 2 0",
    "boost": "distributed under the boost software license version 1 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
}

MORE_RULES = (
    ("BSD-3-Clause", ("bsd-use", "bsd-source", "bsd-binary", "bsd-neither")),
    ("GPL-2.0-or-later", ("gpl2-free",)),
    ("GPL-2.0-or-later", ("gpl2-free-software",)),
    ("GPL-3.0-or-later", ("gpl3-free-software",)),
    ("AGPL-3.0-or-later", ("agpl3-free",)),
    ("LGPL-2.0-or-later", ("lgpl2-free",)),
    ("LGPL-3.0-or-later", ("lgpl3-free",)),
    ("LGPL-2.1-or-later", ("lgpl21-free-program",)),
    ("LGPL-3.0-or-later", ("lgpl3-free-program",)),
    ("GPL-2.0-only", ("gpl2-only",)),
    ("GPL-3.0-only", ("gpl3-only",)),
    ("AGPL-3.0-only", ("agpl3-only",)),
    ("LGPL-2.1-only", ("lgpl21-only",)),
    ("LGPL-3.0-only", ("lgpl3-only",)),
    ("GPL-2.0-only", ("gpl2-work",)),
    ("GPL-3.0-only", ("gpl3-licensed",)),
    ("AGPL-3.0-only", ("agpl3-work",)),
    ("LGPL-2.1-only", ("lgpl21-work",)),
    ("LGPL-3.0-only", ("lgpl3-work",)),
    ("Apache-2.0", ("apache-released",)),
    ("MIT", ("mit-terms",)),
    ("EPL-2.0", ("epl2-terms",)),
    ("EPL-2.0", ("epl2-terms-v",)),
    ("BSL-1.0", ("boost",)),
    ("Unlicense", ("unlicense",)),
)

# Longer identifiers are told from their beginnings only if both are here.
_SPDX = (
    "0BSD AFL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-2-Clause-Patent "
    "BSD-3-Clause BSD-3-Clause-Clear BSD-3-Clause-LBNL BSD-4-Clause BSL-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 "
    "CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 EPL-1.0 EPL-2.0 "
    "EUPL-1.2 GPL-1.0-or-later GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.0-only "
    "LGPL-2.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 MIT-Modern-Variant "
    "MPL-1.1 MPL-2.0 MPL-2.0-no-copyleft-exception MS-PL NCSA OFL-1.1 OpenSSL PostgreSQL PSF-2.0 Python-2.0 "
    "Unicode-3.0 Unlicense Vim WTFPL X11 Zlib ZPL-2.1"
).split()


def _with_spdx() -> None:
    """Lines with an identifier; GNU identifiers without an ending are the older form of -only."""
    global MORE_RULES
    for name in _SPDX:
        forms = [name] + ([name[: -len("-only")]] if name.endswith("-only") else [])
        for form in forms:
            words = form.lower().replace("-", " ").replace(".", " ")
            MORE_SENTENCES[f"spdx-{form}"] = f"spdx license identifier {words}"
            MORE_RULES += ((name, (f"spdx-{form}",)),)


_with_spdx()

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Between two sentences of a rule: so many numbers or letters of lists and ends of sentences.
_MARKS = 6
_MARK = r"^(?:\.|[0-9]{1,2}|[a-z]|i{2,3}|iv|vi{1,3}|ix)$"


def words_of(low: Column) -> Column:
    """Words of a text in lower case: array of (piece, word).

    ``piece`` counts the ends of lines and sentences before the word. A word ``.`` stands
    where no known sentence goes on: at the end of a sentence and at a blank line, also
    one that holds only a comment mark. A mark before a number ("v. 2.0") ends nothing.
    """
    plain = F.translate(low, "\1", " ")
    for found, told in (
        (r"(?m)^[ \t]*(?:dnl|rem)[ \t]", ""),
        (r"[.!?]+[ \t\r\n]++(?![0-9])", "\1"),
        (r"\n[^a-z0-9\n\x01]*(?=\n)", "\1"),
        (r"[.!?:]+[ \t\r\n]+|\n+", "\n"),
        (r"(gpl-[0-9.]+)\+", "$1 or later "),
        (r"[^a-z0-9\n\x01]+", " "),
        (r"(?<![ \n])[ \n]*+\x01[ \n\x01]*", "\1"),
        (r" *\n[ \n]*", "\n"),
        (r"\x01", "\n. "),
    ):
        plain = F.regexp_replace(plain, found, told)
    pieces = F.transform(
        F.split(plain, "\n"),
        lambda p, k: F.transform(
            F.filter(F.split(p, " "), lambda x: x != ""),
            lambda x: F.struct(k.alias("piece"), x.alias("word")),
        ),
    )
    return F.flatten(pieces)


def _cover(sentences: list[str]) -> list[str]:
    """Words so that each sentence holds one of them."""
    left, out = list(sentences), []
    while left:
        words = {w for s in left for w in s.split()}
        best = max(words, key=lambda w: (sum(w in s for s in left) * min(len(w), 7), len(w), w))
        out.append(best)
        left = [s for s in left if best not in s]
    return out


def scan(
    df: DataFrame, key: str, text: str, sentences=None, rules=None
) -> DataFrame:
    """One row per licence found: ``key``, ``licence``, ``rule``, ``sentence`` (where it
    begins: ends of lines and sentences before it) and ``n_sentences``.

    A known sentence is found wherever its words follow each other in one sentence of the
    text; within a longer known one it is none of its own. A rule fits where its sentences
    follow each other directly, numbers and letters of lists aside. Where several fit, the
    first in the list wins, and a fit that overlaps one of an earlier rule is dropped.
    Null, empty and other texts without known sentences give no rows; rows with equal
    key and text are one; equal keys with different texts are scanned apart; a null key
    is kept. Other columns are not read. The sentences are a fixed list, which is
    broadcast; only texts with one of a few words that each of them holds are cut up.
    """
    ranked = [(r, *rule) for r, rule in enumerate(rules or RULES)]
    if rules is None:
        # Numbers of rules stay; the longer form of BSD goes before the shorter one.
        longer = next(n for n, (name, _) in enumerate(RULES) if name == "BSD-2-Clause") - 0.5
        ranked += [
            (longer if len(ids) > 1 else len(RULES) + r, name, ids)
            for r, (name, ids) in enumerate(MORE_RULES)
        ]
    if sentences is None:
        sentences = SENTENCES | MORE_SENTENCES
    spark = df.sparkSession
    split = {i: s.split() for i, s in sentences.items()}
    opening = min(map(len, split.values()))
    opening = min(opening, 3)
    openers = sorted({" ".join(s[:opening]) for s in split.values()})
    firsts = sorted({s[0] for s in split.values()})
    known = spark.createDataFrame(
        [(" ".join(s[:opening]), i, len(s), " ".join(s)) for i, s in split.items()],
        "opener string, id string, n int, known string",
    )
    told = spark.createDataFrame(
        [(i, float(rank), name, len(ids), " ".join(ids)) for i, (rank, name, ids) in enumerate(ranked)],
        "rule int, rank double, licence string, n_sentences int, ids string",
    )
    longest = max(len(ids) for _, _, ids in ranked)
    most = max(map(len, split.values()))
    reach = longest * (most + _MARKS)

    def text_at(words: Column, i: Column, n: int) -> Column:
        return F.array_join(F.transform(F.slice(words, i + 1, n), lambda x: x["word"]), " ")

    def found(words: Column) -> Column:
        at = F.filter(
            F.sequence(F.lit(0), F.size(words)),
            lambda i: F.coalesce(F.get(words, i)["word"].isin(firsts), F.lit(False))
            & text_at(words, i, opening).isin(openers),
        )
        return F.transform(
            at,
            lambda i: F.struct(
                i.alias("start"),
                F.get(words, i)["piece"].alias("at"),
                text_at(words, i, opening).alias("opener"),
                F.transform(F.slice(words, i + 1, most + _MARKS), lambda x: x["word"]).alias("ahead"),
            ),
        )

    low = F.translate(F.col(text), _UPPER, _LOWER)
    some = None
    for word in _cover([" ".join(s) for s in split.values()]):
        has = F.contains("low", F.lit(word))
        some = has if some is None else some | has
    places = (
        df.select(F.col(key).alias("key"), F.xxhash64(text).alias("row"), low.alias("low"))
        .where(some)
        .select("key", "row", F.explode(_let(words_of(F.col("low")), found)).alias("p"))
        .select("key", "row", "p.*")
    )

    def marks(after: Column) -> Column:
        """How many words at the begin of ``after`` are marks."""
        others = F.transform(after, lambda x: ~x.rlike(_MARK))
        first = F.array_position(others, F.lit(True))
        return F.when(first == 0, F.size(after)).otherwise(first - 1).cast("int")

    hits = (
        places.join(F.broadcast(known), "opener")
        .where(F.array_join(F.slice("ahead", F.lit(1), F.col("n")), " ") == F.col("known"))
        .select(
            "key", "row", "start", "at", "id",
            (F.col("start") + F.col("n")).alias("end"),
            marks(F.slice("ahead", F.col("n") + 1, F.lit(_MARKS))).alias("marks"),
        )
        .distinct()
    )

    def around(low: int, high: int, *columns: str) -> Column:
        window = Window.partitionBy("key", "row").orderBy("start").rangeBetween(low, high)
        return F.collect_list(F.struct(*columns)).over(window)

    def following(one: Column) -> Column:
        """The first known sentence directly after ``one``; null if there is none."""
        upto = one["end"] + one["marks"]
        return F.array_min(
            F.filter("ahead", lambda o: (o["start"] >= one["end"]) & (o["start"] <= upto))
        )

    inside = F.exists(
        "others",
        lambda o: (o["start"] <= F.col("start"))
        & (F.col("end") <= o["end"])
        & (o["end"] - o["start"] > F.col("end") - F.col("start")),
    )
    hits = hits.withColumn("others", around(-most, most, "start", "end")).where(~inside).drop("others")
    hits = hits.withColumn("ahead", around(0, reach, "start", "end", "marks", "id"))
    last, chain, chains = F.struct("start", "end", "marks", "id"), F.col("id"), []
    for n in range(1, longest + 1):
        hits = hits.withColumns({f"last{n}": last, f"ids{n}": chain})
        end = F.col(f"last{n}")
        chains.append(
            F.struct(F.lit(n).alias("n_sentences"), F.col(f"ids{n}").alias("ids"), end["end"].alias("end"))
        )
        last = following(end)
        chain = F.when(last.isNotNull(), F.concat_ws(" ", f"ids{n}", last["id"]))
    fits = (
        hits.select("key", "row", "at", "start", F.explode(F.array(*chains)).alias("c"))
        .select("key", "row", "at", "start", "c.*")
        .join(F.broadcast(told), ["n_sentences", "ids"])
        .select("key", "row", "at", "start", "end", "rule", "rank", "licence", "n_sentences")
    )
    # A fit that overlaps another begins at most the length of one from it.
    beaten = F.exists(
        "others",
        lambda o: (o["rank"] < F.col("rank"))
        & (o["start"] < F.col("end"))
        & (F.col("start") < o["end"]),
    )
    return (
        fits.withColumn("others", around(-reach, reach, "start", "end", "rank"))
        .where(~beaten)
        .select(
            F.col("key").alias(key),
            "licence",
            "rule",
            F.col("at").alias("sentence"),
            "n_sentences",
        )
    )


def scan_sql(documents: str = "documents") -> str:
    """The scan of ``doc_id`` and ``text`` in SQL."""
    known = ", ".join(f"('{i}', '{s}')" for i, s in SENTENCES.items())
    told = ", ".join(
        f"({n}, '{name}', {len(ids)}, '{' '.join(ids)}')" for n, (name, ids) in enumerate(RULES)
    )
    longest = max(len(ids) for _, ids in RULES)
    chains = []
    for n in range(1, longest + 1):
        parts = ["id"] + [f"lead(id, {k}) OVER w" for k in range(1, n)]
        direct = [f"lead(place, {k}) OVER w = place + {k}" for k in range(1, n)]
        window = " WINDOW w AS (PARTITION BY doc_id, whole ORDER BY place) QUALIFY "
        chains.append(
            f"SELECT doc_id, whole, place, {n} AS n_sentences, {' || chr(32) || '.join(parts)} AS ids"
            f" FROM hits{window + ' AND '.join(direct) if direct else ''}"
        )
    return rf"""
    WITH known(id, sentence) AS (VALUES {known}),
    told(rule, licence, n_sentences, ids) AS (VALUES {told}),
    plain AS (
        SELECT doc_id, md5(text) AS whole, string_split(regexp_replace(regexp_replace(
            regexp_replace(translate(text, '{_UPPER}', '{_LOWER}'),
                '[.!?:]+[ \t\r\n]+|\n+', chr(10), 'g'),
            '[^a-z0-9\n]+', ' ', 'g'), ' *\n[ \n]*', chr(10), 'g'), chr(10)) AS lines
        FROM {documents}
    ), lines AS (
        SELECT doc_id, whole, unnest(range(len(lines))) AS place, trim(unnest(lines)) AS sentence
        FROM plain
    ), hits AS (
        SELECT DISTINCT doc_id, whole, place, id FROM lines JOIN known USING (sentence)
    ), chains AS ({' UNION ALL '.join(chains)}
    ), fits AS (
        SELECT doc_id, whole, place, rule, licence, n_sentences
        FROM chains JOIN told USING (n_sentences, ids)
    )
    SELECT doc_id, licence, rule, place::INT AS sentence, n_sentences
    FROM fits f WHERE NOT EXISTS (
        SELECT 1 FROM fits o WHERE o.doc_id IS NOT DISTINCT FROM f.doc_id AND o.whole = f.whole
        AND o.rule < f.rule AND o.place < f.place + f.n_sentences AND f.place < o.place + o.n_sentences)
    """
