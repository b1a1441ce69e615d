"""The registered queries: names, and a cross-section against their SQL."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, compare

CROSS_SECTION = ["clean_pipeline", "placeholder_counts", "scan_conllu", "cooccurrence", "top_words_per_label", "tfidf",
                 "stratified_split", "embed_lookup", "keyword_index", "lreg_optimum", "predict_at_least_one", "classification_report", "metrics_by_length_quantile", "knn"]


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"label", "n"}


@pytest.mark.parametrize("name", CROSS_SECTION)
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    note = compare(entry.queries()[name](spark, sf), con, entry.oracle_sql()[name])
    assert note.startswith("ok") and "TYPES" not in note, note
