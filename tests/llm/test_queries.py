"""Registered queries: their columns, on the whole small tables."""

from __future__ import annotations

import hashlib
import re

import duckdb
import pytest

import __spark_entry__
from tidebook.llm.common import table
from tidebook.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_byte_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op2_html_text": {"page_id", "text"},
    "op3_quality": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op4_pii": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    "op5_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op6_suffix_dedup": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op7_embedding_itq": {"vec_id", "n_links", "component_id", "kept"},
    "op8_warc": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op9_simhash": {"doc_id", "fingerprint", "component_id"},
    "op10_toxicity": {"doc_id", "p_toxic", "p_strong", "p_severe", "toxic", "kept"},
    "op11_bag_search": {"item_id", "rank", "doc_id", "score"},
    "op12_config_packing": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op13_importance": {"doc_id", "n_features", "weight", "score", "rank"},
}
OF = {"op2_html_text": "pages", "op7_embedding_itq": "embeddings", "op8_warc": "pages"}


def test_all_are_registered():
    assert set(QUERIES) == set(COLUMNS)
    assert set(COLUMNS) | {"pipeline"} <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", [n for n in COLUMNS if n not in ("op5_packing", "op11_bag_search", "op12_config_packing")])
def test_a_row_per_row(spark, name):
    out = QUERIES[name](spark, SF)
    assert set(out.columns) == COLUMNS[name]
    assert out.count() == table(spark, SF, OF.get(name, "documents")).count()


def test_digests(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, SF, "documents").collect()}
    for r in QUERIES["op1_byte_bpe"](spark, SF).collect():
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    for r in QUERIES["op9_simhash"](spark, SF).collect():
        assert re.fullmatch("[0-9a-f]{16}", r["fingerprint"])


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rel = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF)
    at = [got.columns.index(c) for c in rel.columns]
    key = lambda row: tuple((v is not None, v) for v in row)
    ours = sorted((tuple(r[i] for i in at) for r in got.collect()), key=key)
    assert ours and ours == sorted(map(tuple, rel.fetchall()), key=key)
