"""What holds for all queries: empty tables, SQL, and what the plans of native ones are made of."""

from __future__ import annotations

import pytest

from __spark_entry__ import oracle_sql, queries
from check import compare, connect
from laborlake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_no_rows(spark, bare, name):
    assert queries()[name](spark, bare).collect() == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n in oracle_sql()])
def test_sql(spark, name):
    assert compare(spark, connect(SF_DIR), name, SF_DIR).startswith("same")


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ("op3_warc", "op6_html_extraction", "op10_packing", "op11_prefix_trie")])
def test_one_row_per_document(spark, odd, name):
    rows = queries()[name](spark, odd).select("doc_id").collect()
    want = spark.read.parquet(f"{odd}/documents.parquet").select("doc_id").collect()
    key = lambda r: (r.doc_id is not None, r.doc_id)
    assert sorted(rows, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("name", ["op4_line_dedup", "op5_sharding", "op8_quality_rules", "op13_secret_scan"])
def test_native(spark, odd, name):
    plan = queries()[name](spark, odd)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))
