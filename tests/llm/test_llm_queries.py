"""The registered queries over the supplied tables, with SQL where there is any."""

import re

import pytest

from __spark_entry__ import oracle_sql, queries
from carepulse.llm.queries import LLM_QUERIES, LLM_SQL
from compare import connect, difference

COLUMNS = {
    "op1_": "doc_id piece start length ids_crc32 sequence_id offset",
    "op2_": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op3_": "doc_id held_out score predicted",
    "op4_": "doc_id held_out lang_pred score",
    "op5_": "doc_id start n_tokens ids_crc32",
    "op6_": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op7_": "doc_id item_id",
    "op8_": "conv_id first_line role rendered",
    "op9_": "doc_id fingerprint component_id",
    "op10_": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op11_": "page_id host path rule verdict",
    "op12_": "doc_id n_features weight score rank",
    "op13_": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    "pipeline": "doc_id sequence_id offset ids",
}


def test_one_query_for_each_operator_and_the_pipeline():
    assert sorted(re.match(r"op\d+_|pipeline", k)[0] for k in LLM_QUERIES) == sorted(COLUMNS)
    assert set(LLM_QUERIES) <= set(queries()) and set(LLM_SQL) <= set(oracle_sql())


@pytest.mark.parametrize("key", list(LLM_QUERIES))
def test_columns_and_rows(spark, sf_dir, key):
    out = queries()[key](spark, sf_dir)
    wanted = COLUMNS[re.match(r"op\d+_|pipeline", key)[0]].split()
    assert set(wanted) <= set(out.columns)
    rows = out.select(*wanted).cache()
    n = rows.count()
    if key[:4] in ("op2_", "op3_", "op4_", "op5_", "op6_", "op9_", "op10", "op12"):
        assert n == spark.read.parquet(f"{sf_dir}/documents.parquet").count() == rows.select("doc_id").distinct().count()
    else:
        assert n > 0


@pytest.mark.parametrize("key", list(LLM_SQL))
def test_sql_gives_the_same_rows(spark, sf_dir, key):
    assert difference(queries()[key](spark, sf_dir), connect(sf_dir), LLM_SQL[key]) is None
