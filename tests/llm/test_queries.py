"""The registered queries give their agreed columns for every row of their tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_winnowing": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op2_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op3_pq": "vec_id n_links component_id kept",
    "op4_simhash": "doc_id fingerprint component_id",
    "op5_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op6_quality": "doc_id score kept",
    "op7_host_trust": "page_id host path rule verdict",
    "op8_hilbert": "doc_id size text_crc32 law shard slot grown_shard",
    "op9_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op10_mixing": "doc_id size source_size target taken",
    "op11_whitening": "vec_id component n deviation whitened explained identity_error",
    "op12_nnls_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op13_alignment": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
}
TABLES = {"op3_pq": "embeddings", "op7_host_trust": "pages", "op11_whitening": "embeddings"}
#: Rows for each row of the table, where it is not one; 0 is any number.
ROWS = {"op5_packing": 0, "op11_whitening": 16, "op12_nnls_packing": 0}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, name):
    found = contract.queries()[name](spark, FOLDER)
    assert set(COLUMNS[name].split()) <= set(found.columns)
    rows = spark.read.parquet(f"{FOLDER}/{TABLES.get(name, 'documents')}.parquet").count()
    ids = found.select(found.columns[0])
    times = ROWS.get(name, 1)
    assert ids.distinct().count() == rows and (not times or ids.count() == times * rows)


def test_the_pipeline_is_registered():
    assert "pipeline" in contract.queries()
