"""Registered queries: names, and rows against their SQL on the smallest tables.

``python tests/compare.py sf0.01`` runs all of them; here a few of each kind stand in.
"""

import os

import pytest
from compare import difference, duck, duck_rows, spark_rows

import __spark_entry__ as entry

NAMES = [
    "stratified_split_rows",
    "kfold_assign",
    "classification_report",
    "leakage_audit",
    "dataset_digest",
    "expectation_suite",
    "credential_literals",
    "secret_fingerprints",
    "manifest_verify",
    "run_ledger",
    "relabelled",
    "vector_match",
    "instant_lookback_grid",
    "counter_rate",
    "counter_increase_grid",
    "alert_transitions",
    "latest_run_stage_status",
    "stream_sliding_max",
]


@pytest.fixture(scope="module")
def con(sf):
    pytest.importorskip("duckdb")
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    return duck(sf)


@pytest.mark.parametrize("name", NAMES)
def test_rows_agree_with_sql(spark, con, sf, name):
    got = spark_rows(entry.queries()[name](spark, sf))
    assert difference(got, duck_rows(con, entry.oracle_sql()[name])) is None


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_predictions_over_copies_of_two_texts(spark, tmp_path):
    docs = spark.range(60).selectExpr("id as doc_id", "if(id % 2 = 0, 'one text', 'another, longer text.') as text", "'en' as lang", "'s' as source", "8L as n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(60).selectExpr("id as doc_id", "cast(id % 3 % 2 as int) as quality", "0 as toxic").write.parquet(f"{tmp_path}/labels.parquet")
    rows = entry.queries()["batch_predict_rows"](spark, str(tmp_path)).collect()
    assert len(rows) == 12 and all(r["known_class"] for r in rows)
