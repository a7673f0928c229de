"""Registered operators on the smallest test tables: against SQL where SQL can express them."""

import os

import check
import duckdb
import pytest

from cdcstrata.llm import registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = registry.queries()[name](spark, FOLDER)
    found = con.execute(registry.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(names)
    assert check.rows(df.columns, [tuple(r) for r in df.collect()]) == check.rows(names, found.fetchall())


CONTRACT = {
    "op1_syncmers": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op3_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op4_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op6_near_vectors": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op7_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op8_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op9_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op10_shards": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op11_merkle": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    "op13_line_dedup": "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns_and_rows(spark, name):
    df = registry.queries()[name](spark, FOLDER)
    kinds = dict(df.dtypes)
    for column in CONTRACT[name].split(", "):
        key, kind = column.split(" ")
        assert kinds[key] == kind
    source = "embeddings" if name.startswith("op6") else "documents"
    assert df.count() == spark.read.parquet(f"{FOLDER}/{source}.parquet").count()
