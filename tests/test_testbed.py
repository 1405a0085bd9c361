"""How source text is made from the sales tables, on rows of its own."""

import gzip
from datetime import datetime
from pathlib import Path

import pytest

from laborlake import catalog
from laborlake import testbed as tb

LINES = """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,
    l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"""


#: Name, type and value of the columns by a row's number.
FLAT = [
    *((c, "bigint", "id") for c in ("l_orderkey", "l_partkey", "l_suppkey")), ("l_linenumber", "int", "1 + id % 5"),
    *((c, "double", "id % 50") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
    ("l_returnflag", "string", "substring('ANR', 1 + id % 3, 1)"), ("l_linestatus", "string", "'O'"),
    ("l_shipdate", "timestamp_ntz", "DATE '1996-03-01'"),
]


def rows(keys, year, supplier, flag):
    return [(k, k, supplier, 1 + k % 5, 3.0, 10.5, 0.0, 0.0, flag, "O", datetime(year, 3, 1)) for k in keys]


@pytest.fixture()
def sf_dir(spark, tmp_path):
    """Three files; of 1996, one supplier's rows go and few others stay."""
    parts = [
        rows(range(1, 40), 1996, 2, "N") + rows(range(40, 60), 1997, 3, "A"),
        rows(range(60, 90), 1996, 10, "R") + rows(range(90, 99), 1995, 2, "R"),
        rows([100, 101, 103], 1996, 5, "N") + rows(range(110, 120), 1998, 2, "N"),
    ]
    for part in parts:
        spark.createDataFrame(part, LINES).coalesce(1).write.mode("append").parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_source_text_has_settings_of_its_own(spark, sf_dir):
    conf = tb.text_source(spark, sf_dir, "lineitem").sparkSession.conf
    # Files of seven years and three regions are open at a time, and no rows are sorted for them.
    assert int(conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 21
    assert conf.get("spark.sql.codegen.wholeStage") == "false" and spark.conf.get("spark.sql.codegen.wholeStage") == "true"


def test_a_tree_holds_every_row_once(spark, sf_dir):
    base = tb.job_link_tree(spark, sf_dir, "mixed")
    lines = spark.read.text(base, recursiveFileLookup=True).where("NOT value LIKE '%PIS%'")
    assert lines.count() == tb.read_table(spark, sf_dir, "lineitem").count()


def files_below(base):
    return [p for p in Path(base).rglob("*.txt*") if not p.name.startswith(".")]


def test_trees_that_queries_load_are_compressed(spark, sf_dir, monkeypatch):
    many = {"lineitem": spark.range(30_000).selectExpr(*[f"CAST({x} AS {t}) AS {c}" for c, t, x in FLAT])}
    monkeypatch.setattr(tb, "read_table", lambda spark, sf_dir, name: many[name])
    plain, packed = files_below(tb.job_link_tree(spark, sf_dir, "mixed")), files_below(catalog.tree("mixed")(spark, f"{sf_dir}/"))
    assert {p.suffix for p in plain} == {".txt"} and {p.name for p in packed} == {f"{p.name}.gz" for p in plain}
    assert 2 * sum(p.stat().st_size for p in packed) < sum(p.stat().st_size for p in plain)
    lines = lambda files: sorted(line for p in files for line in (gzip.open if p.suffix == ".gz" else open)(p, "rb"))
    assert lines(plain) == lines(packed)


def test_files_of_one_task_have_names_of_their_own(spark, sf_dir, monkeypatch):
    monkeypatch.setitem(tb.COMPRESSION, "maxRecordsPerFile", 7)
    files = files_below(tb.job_link_tree(spark, sf_dir, "mixed", compressed=True))
    rows = [len(gzip.open(p).read().splitlines()) - 1 for p in files]
    assert max(rows) == 7 and sum(rows) == tb.read_table(spark, sf_dir, "lineitem").count()


@pytest.mark.parametrize("query", ["ingest_historic", "stream_rows", "incremental_run", "force_run", "incremental_stream"])
def test_queries_load_compressed_files(spark, sf_dir, monkeypatch, query):
    seen, write = [], tb.write_lines
    monkeypatch.setattr(tb, "write_lines", lambda lines, head, folder, compressed=False: (seen.append(compressed), write(lines, head, folder, compressed)))
    found = getattr(catalog, query)(spark, sf_dir)
    assert seen and all(seen)
    years = {1995: 9, 1996: 72, 1997: 20, 1998: 10}
    if query not in ("ingest_historic", "stream_rows"):
        years |= {1996: 2} if query == "force_run" else {}
        assert {r.ano: r.stored_rows for r in found.collect() if r.ano < 2003} == years
    else:
        assert {r.ano: r["count"] for r in found.groupBy("ano").count().collect()} == years


def test_both_layouts_are_cleaned_by_short_methods(spark, sf_dir):
    found = catalog.canonicalize_mixed(spark, sf_dir)
    assert "*(" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == tb.read_table(spark, sf_dir, "lineitem").count()


def test_a_changing_year_is_written_by_many_tasks(spark, sf_dir, monkeypatch):
    tasks, write = [], tb.write_job_links
    monkeypatch.setattr(tb, "write_job_links", lambda spark, rows, *a, **k: (tasks.append(rows.rdd.getNumPartitions()), write(spark, rows, *a, **k)))
    found = {r.ano: (r.stored_rows, r.listed_rows, r.loads) for r in catalog.force_run(spark, sf_dir).collect()}
    assert min(tasks) > 1
    # Of 1996 three rows are no supplier's that goes, and two of them are among the first three of their order.
    assert found == {1995: (9, 9, 1), 1996: (2, 2, 2), 1997: (20, 20, 1), 1998: (10, 10, 1)}
