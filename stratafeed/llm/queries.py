"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    blocks,
    byte_gru,
    chat,
    edits,
    licences,
    middles,
    mixing,
    overlap,
    passages,
    pieces,
    resample,
    rules,
    shards,
)
from ._sample import key_crc
from ._text import n_words
from .graph import stored

SHARDS = 8


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = Query(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORDS_SQL = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"


def symbol_free(text):
    """Quality weight of a document: the fewer symbols, the higher; 1 without any."""
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    return 1 / (1 + F.coalesce(symbols, F.lit(0)))


@query(rf"""
    WITH d AS (
        SELECT doc_id, source, {WORDS_SQL} AS size,
               1.0::DOUBLE / (1 + coalesce(length(text) - length(
                   translate(text, '#*$%&|<>', '')), 0)) AS weight,
               substr(md5('9:' || coalesce(doc_id::VARCHAR, '')), 1, 12) AS bits
        FROM documents
    ), e AS (
        SELECT *, -ln((('0x' || bits)::BIGINT::DOUBLE + 0.5) / 281474976710656.0::DOUBLE)
                  / weight AS draw
        FROM d
    ), s AS (
        SELECT source, sum(size)::DOUBLE AS source_size, 3 * sum(size)::DOUBLE AS cap,
               [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][
                   (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
        FROM d GROUP BY source
    ), l AS (
        SELECT *, sum(source_size) OVER () AS total,
               cap * (sum(w) OVER () - coalesce(sum(w) OVER before, 0))
               <= (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)) * w
                  AS bound
        FROM s
        WINDOW before AS (ORDER BY cap / w, source NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), t AS (
        SELECT source, source_size, CASE WHEN bound THEN cap ELSE
                   (total - sum(CASE WHEN bound THEN cap ELSE 0 END) OVER ()) * w
                   / sum(CASE WHEN bound THEN 0 ELSE w END) OVER () END AS target
        FROM l
    ), u AS (
        SELECT e.*, t.source_size, t.target,
               CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)
                    ELSE 0 END AS epochs,
               sum(e.size) OVER (PARTITION BY e.source ORDER BY e.draw, e.doc_id, e.size
                                 ROWS UNBOUNDED PRECEDING) AS upto
        FROM e JOIN t ON e.source IS NOT DISTINCT FROM t.source
    )
    SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
           (size * (epochs + CASE WHEN size > 0 AND epochs < 3
               AND upto - size / 2.0 <= target - epochs * source_size
               THEN 1 ELSE 0 END))::BIGINT AS taken
    FROM u
""")
def op9_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        n_words(F.col("text")).alias("size"),
        symbol_free(F.col("text")).alias("weight"),
    )
    # The mix reads its rows twice; the words of a text are counted once.
    sized = stored(docs, "sizes")
    mixed = mixing.mix(sized, "doc_id", "source", "size", "weight")
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


@query()
def op10_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = shards.place(docs, "doc_id", SHARDS).withColumn(
        "grown_shard", shards.shard_of(F.col("doc_id"), SHARDS + 1)
    )
    return shards.with_slots(placed, "shard", "doc_id", ["text_crc32", "size"])


@query(r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x20\x09-\x0D]+') AS words
        FROM documents
    ), s AS (
        SELECT doc_id, list_distinct(CASE
                   WHEN len(words) = 0 THEN []
                   WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                   ELSE list_transform(range(1, len(words) - 3),
                            lambda i: array_to_string(words[i:i + 4], ' '))
                   END) AS grams
        FROM w
    ), e AS (
        SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s
    ), links AS (
        SELECT a.doc_id AS a, b.doc_id AS b
        FROM e a JOIN e b ON a.gram = b.gram AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n
        HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
    ), reach AS (
        SELECT doc_id, doc_id AS other FROM s
        UNION
        SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
    )
    SELECT s.doc_id, len(grams)::BIGINT AS n_shingles, r.component_id
    FROM s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r
         USING (doc_id)
""")
def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return overlap.join(docs, "doc_id", "text").documents


@query()
def op4_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = rules.learn(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "quality")
    counted = rules.with_counts(docs, "text", keep=["doc_id"])
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return counted.select(
        "doc_id",
        *[F.col(f"counts.{c}") for c in counts],
        rules.base_failed().alias("base_failed"),
        rules.kept(learned).alias("kept"),
        learned.rejected_by().alias("rejected_by"),
    )


def quality_model(docs: DataFrame, labels: DataFrame) -> passages.Model:
    shown = labels.where(key_crc(F.col("doc_id")) % 5 != 0)
    return passages.fit(docs, shown, "doc_id", "text", "quality")


LEAST_QUALITY = 0.3


@query()
def op5_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return passages.with_score(docs, "text", model, keep=["doc_id"]).select(
        "doc_id",
        (key_crc(F.col("doc_id")) % 5 == 0).alias("held_out"),
        "score",
        (F.col("score") >= LEAST_QUALITY).cast("int").alias("predicted"),
    )


@query()
def op8_byte_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = key_crc(F.col("doc_id")) % 3 == 1
    model = byte_gru.fit(docs.where(~held_out), "doc_id", "text", "lang")
    return byte_gru.predict(docs, "doc_id", "text", model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "n_positions"
    )


@query()
def op6_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edits.edited(table(spark, sf_dir, "documents"), "doc_id", "text")


@query()
def op6_near_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return edits.near_pairs(edits.fingerprint(docs, "doc_id", "text"), "doc_id")


PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@query()
def op2_pieces(spark: SparkSession, sf_dir: str, model: str = PIECE_MODEL) -> DataFrame:
    """Per document: its pieces, a digest of their ids, and whether they decode to it."""
    vocabulary = pieces.load(model)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = pieces.decode(pieces.encode(docs, "text", vocabulary), "ids", vocabulary)
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), "▁", " ")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.crc32(F.array_join("ids", " ").cast("binary")).alias("ids_crc32"),
        (F.col("decoded") == text).alias("decodes"),
    )


@query(licences.scan_sql())
def op7_licence_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"), "doc_id", "text")


@query()
def op1_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return chat.link_quotes(turns, "conv_id", "turn", "role", "text")


@query()
def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return blocks.extract(pages, "html").select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


@query(r"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''),
                   '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
               sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS draw
        FROM documents
    ), h AS (
        SELECT doc_id, text, units, len(units)::BIGINT AS n,
               [('0x' || substr(draw, 8 * i + 1, 8))::BIGINT FOR i IN range(4)] AS h
        FROM d
    ), c AS (
        SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a,
               greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                         OR contains(text, '<M>') OR h[3] % 100 >= 50 THEN 'plain'
                    WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
        FROM h
    ), p AS (
        SELECT doc_id, text, n, form,
               coalesce(array_to_string(units[1:a], ''), '') AS prefix,
               coalesce(array_to_string(units[a + 1:b], ''), '') AS middle,
               coalesce(array_to_string(units[b + 1:], ''), '') AS suffix
        FROM c
    )
    SELECT doc_id, n, form,
           CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
           sha256(CASE form
               WHEN 'plain' THEN text
               WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
               ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END)
               AS output_sha256,
           sha256(text) AS restored_sha256
    FROM p
""")
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = middles.transform(docs, "doc_id", "text")
    output, form = F.col("fim.output"), F.col("fim.form")
    return cut.select(
        "doc_id",
        *[F.col(f"fim.{c}") for c in ("n", "form", "prefix_chars", "middle_chars")],
        F.sha2(output, 256).alias("output_sha256"),
        F.sha2(middles.restored(output, form), 256).alias("restored_sha256"),
    )


@query(r"""
    WITH byte_table AS (
        SELECT list(list_reduce(list_prepend(b, range(8)),
                    lambda c, i: xor(c // 2, (c % 2) * 3988292384)) ORDER BY b) AS t
        FROM range(256) r(b)
    ), texts AS (
        SELECT doc_id, 's' AS side, text FROM documents
        UNION ALL SELECT NULL, 't', text FROM benchmark
    ), words AS (
        SELECT doc_id, side, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM texts
    ), each AS (
        SELECT doc_id, side, unnest(words) AS word FROM words
    ), crcs AS (
        SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295,
                   [('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT
                    FOR i IN range(octet_length(encode(word)))]),
                   lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]))) % 10000 AS bucket
        FROM (SELECT DISTINCT word FROM each), byte_table
    ), counts AS (
        SELECT bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t
        FROM each JOIN crcs USING (word) GROUP BY bucket
    ), gains AS (
        SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)
                   / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)))) AS gain
        FROM counts
    ), weights AS (
        SELECT doc_id, count(*) AS n, floor(sum(gain) / count(*)) AS weight
        FROM each JOIN crcs USING (word) JOIN gains USING (bucket)
        WHERE side = 's' GROUP BY doc_id
    ), scored AS (
        SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_features,
               coalesce(weight, 0)::BIGINT AS weight,
               coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((
                   ('0x' || substr(sha256('2024:' || w.doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE)
                   / 4294967296.0::DOUBLE)))::BIGINT AS score
        FROM words w LEFT JOIN weights USING (doc_id) WHERE w.side = 's'
    ), ranked AS (
        SELECT *, n_features >= 20 AS fit,
               row_number() OVER (PARTITION BY n_features >= 20
                                  ORDER BY score DESC, doc_id) AS place,
               count(*) FILTER (n_features >= 20) OVER () AS n
        FROM scored
    )
    SELECT doc_id, n_features, weight, score,
           CASE WHEN fit AND place <= 10 * n // 100 THEN place END::BIGINT AS rank
    FROM ranked
""")
def op13_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return resample.resample(docs, benchmark, "doc_id", "text", "text")
