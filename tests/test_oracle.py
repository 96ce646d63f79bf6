"""Registered queries against their DuckDB oracle SQL at sf0.001."""

import os

import duckdb
import pytest

from scripts.oracle_check import TABLES, digest
from tests.conftest import SF_SMALL

NAMES = ["a1_null_ratios", "a3_outlier_profile", "a4_unique_ratios", "a5_quality", "a6_report_rows",
         "a7_describe", "a8_correlations", "o3_top_correlations", "a11_histogram", "a15_psi_clamp",
         "a15_psi_density", "a16_psi_categorical", "a17_drift", "w1_dedup", "w2_row_index", "o2_split",
         "s4_slice_rows", "s11_contiguous_batches", "e1_impute_median", "e3_dictionary", "e7_prepare_a",
         "a20_inflation", "m4_gradient_step", "m5_knn", "t4_stream_profile", "e8_serving_prep",
         "e9_retrain_prep"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as entry
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert len(rows) == len(drows)
    assert sorted(df.columns) == sorted(dcols)
    assert digest(df.columns, rows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(df.columns) >= {"batch_id", "quality_score", "issue_count"}


def test_every_oracle_has_a_query():
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())
