"""Every registered query with SQL against it; all queries return the columns they owe."""

import pytest
from tests.compare import connect, differences

from spendgrid.llm.queries import QUERIES, SQL

OWED = {
    "op1_quality_ranking": "doc_id held_out score predicted",
    "op2_ngram_jaccard": "doc_id n_shingles component_id",
    "op3_mixing": "doc_id size source_size target taken",
    "op4_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op5_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op6_exact_topk": "query_id rank vec_id score",
    "op7_language_id": "doc_id held_out lang_pred score",
    "op8_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op9_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op10_token_files": "doc_id start n_tokens ids_crc32",
    "op11_bpe_words": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op12_fill_in_middle": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
    "op13_hard_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, folder, name):
    assert differences(QUERIES[name](spark, folder), connect(folder), SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_has_its_columns(spark, folder, name):
    out = QUERIES[name](spark, folder)
    assert set(OWED[name].split()) <= set(out.columns)
    assert set(QUERIES) == set(OWED)
