"""Every query of the numbered operators on the smallest tables: against SQL where there is a twin, else its contract."""

import pytest

import __spark_entry__ as entry
from reviewlake.llm import QUERIES, SQL
from tests.oracle import compare, connect

BASE = "/root/testdata/sf0.001"

COLUMNS = {"op4_toxicity": ["doc_id", "held_out", "score", "predicted"], "op5_html_extraction": ["page_id", "url", "text", "n_chars"],
           "op7_simhash_near_dedup": ["doc_id", "fingerprint", "component_id"],
           "op8_language_id": ["doc_id", "held_out", "lang_pred", "score"],
           "op10_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
           "op12_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]}
TABLES = {"op5_html_extraction": "pages"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    assert compare(spark, connect(BASE), BASE, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_for_each_row(spark, name):
    rows = QUERIES[name](spark, BASE)
    assert rows.columns == COLUMNS[name]
    assert rows.count() == spark.read.parquet(f"{BASE}/{TABLES.get(name, 'documents')}.parquet").count()


def test_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
