"""Every registered query with a SQL twin agrees with DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
import sorigil.plans.file_queries  # noqa: F401 (registers its queries)
from sorigil.plans.catalog import QUERIES
from sorigil.plans.oracle import ORACLE
from tools.check_oracle import TABLES, digest, type_mismatches

SMALL = "/root/testdata/sf0.001"
NAMES = sorted(ORACLE)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(entry.oracle_sql()[name])
    ocols = list(rel.columns)
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert type_mismatches(df, rel) == {}
    assert len(rows) == len(orows)
    assert digest(rows, df.columns)[0] == digest(orows, ocols)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["word", "n"]


#: Queries that SQL cannot express, and the tests that hold them against plain Python.
WITHOUT_SQL = {
    "train_vocab": ("test_encode_vocab", ["test_train_vocab_invariants", "test_native_em_and_prune_match_broadcast_forms", "test_spark_m_step_and_prune_match_python"]),
    "trained_token_stats": ("test_encode_vocab", ["test_turns_are_counted_with_the_vocabulary_trained_on_them"]),
}


def test_every_query_has_a_twin_or_a_plain_test():
    from importlib import import_module

    assert set(QUERIES) - set(ORACLE) == set(WITHOUT_SQL) and set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    for module, names in WITHOUT_SQL.values():
        assert all(hasattr(import_module(f"tests.{module}"), n) for n in names)
