"""Every operator's query agrees with its SQL on the smallest tables, or has a test against a plain form."""

from importlib import import_module

import duckdb
import pytest

import __spark_entry__ as entry
from sorigil.llm.oracle import ORACLE
from sorigil.llm.queries import QUERIES
from tools.check_oracle import TABLES, digest, type_mismatches

SMALL = "/root/testdata/sf0.001"

#: Queries that SQL cannot express, and the tests that hold them against plain Python.
WITHOUT_SQL = {
    "op2_host_suffix_array": ("test_pages", "test_repeats_are_found_over_the_whole_host"),
    "op5_bayesian_fusion": ("test_pages", "test_language_fusion"),
    "op6_assignment_secrets": ("test_secrets_licences", "test_query_matches_plain_reading"),
    "op8_best_fit_decreasing": ("test_benchmark_packing", "test_packing_of_the_small_table"),
    "op10_factorization_machine": ("test_quality_toxicity", "test_pairs_of_terms_are_learnt_and_held_out_rows_are_right"),
}


def test_every_query_has_a_twin_or_a_plain_test():
    assert set(QUERIES) - set(ORACLE) == set(WITHOUT_SQL) and set(ORACLE) <= set(QUERIES)
    assert "pipeline" in entry.queries()  # its stages are held against plain forms in test_pipeline
    for module, name in WITHOUT_SQL.values():
        assert hasattr(import_module(f"tests.llm.{module}"), name)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    columns, want = list(rel.columns), rel.fetchall()
    assert sorted(df.columns) == sorted(columns) and type_mismatches(df, rel) == {}
    assert len(rows) == len(want) and digest(rows, df.columns)[0] == digest(want, columns)[0]
