"""Every query against its SQL in DuckDB."""

import pytest

from __spark_entry__ import entry, oracle_sql
from check import compare, connect
from laborlake.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    verdict = compare(spark, con, name, SF_DIR)
    assert verdict.startswith("same"), verdict


def test_all_have_sql():
    assert set(QUERIES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).columns == ["ano", "setor", "vinculos", "ativos_31dez", "remun_media"]
