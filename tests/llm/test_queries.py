"""Registered queries against their SQL or a plain version, and the pipeline."""

from __future__ import annotations

import zlib
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from stratafeed.llm.queries import QUERIES
from stratafeed.llm.shards import jump_hash

from .conftest import SCHEMA

SF_DIR = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_agrees_with_sql(spark, duck, name):
    result = QUERIES[name].run(spark, str(SF_DIR))
    columns = sorted(result.columns)
    twin = duck.sql(QUERIES[name].sql)
    assert sorted(twin.columns) == columns
    expected = Counter(twin.select(*columns).fetchall())
    assert Counter(map(tuple, result.select(*columns).collect())) == expected


def test_shards(spark, duck):
    got = QUERIES["op10_jump_shards"].run(spark, str(SF_DIR)).collect()
    texts = dict(duck.sql("SELECT doc_id, text FROM documents").fetchall())
    assert len(got) == len(texts)
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        import numpy as np

        assert [r.shard, r.grown_shard] == [jump_hash(np.array([r.doc_id]), n)[0] for n in (8, 9)]


def test_held_out_accuracy(spark, duck):
    got = QUERIES["op8_byte_gru"].run(spark, str(SF_DIR)).collect()
    truth = dict(duck.sql("SELECT doc_id, lang FROM documents").fetchall())
    held = [r for r in got if r.held_out]
    assert held and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.9 * len(held)
    got = QUERIES["op5_attention_quality"].run(spark, str(SF_DIR)).collect()
    truth = dict(duck.sql("SELECT doc_id, quality FROM labels").fetchall())
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.9 * len(held)


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, str(SF_DIR))
        assert docs.columns == before.columns
        docs.write.parquet(path := f"{folder}/{stage.__name__}")
        docs = spark.read.parquet(path)
    last = corpus_pipeline.encode_pieces(spark, docs, str(SF_DIR))
    assert last.count() == docs.count() > 0
    alone = spark.read.parquet(f"{folder}/one_per_group")
    assert alone.count() == alone.select("doc_id").distinct().count()


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES], ids=lambda s: s.__name__)
def test_stages_take_odd_rows(spark, odd, none, stage):
    for docs in (odd, none):
        got = stage(spark, docs, str(SF_DIR))
        if stage is not corpus_pipeline.encode_pieces:
            assert got.columns == [f.name for f in SCHEMA]
        rows = got.count()
        assert rows == 0 if docs is none else rows > 0
