import pytest
from registry_files import job_link_file, put

from pyspark.sql import functions as F

from laborlake.model import DATASETS
from laborlake.operators.ledger import Ledger
from laborlake.operators.canonical import conform
from laborlake.plans import reports
from laborlake.plans.load import load
from laborlake.sources import store as tables
from laborlake.sources.delimited import Layout, scan
from laborlake.sources.headers import own_session

LINKS = DATASETS["vinculos"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("plans")
    header = "Município;PIS;CNAE 2.0 Subclasse;Vl Remun Média Nom;Vínculo Ativo 31/12"
    for year in (2021, 2022):
        rows = [f"{m};{i};{i % 100:02d}00000;{i},5;{i % 2}" for i in range(200) for m in ("430543", "350000")]
        put(job_link_file(folder / "in", year, f"RAIS_VINC_ID_{year}.txt"), [header, *rows])
    out = str(folder / "out")
    load(spark, str(folder / "in"), out)
    return out


def test_sector_summary_reads_little(spark, store):
    df = reports.sector_summary(tables.read(spark, store, LINKS), years=[2021], state="43", municipality="430543")
    plan = plan_of(df)
    scan_line = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "PartitionFilters: [isnotnull(uf" in scan_line and "ano" in scan_line.split("PartitionFilters")[1]
    assert "EqualTo(municipio,430543)" in scan_line
    assert scan_line.split("ReadSchema: ")[1].count(":") == 4
    assert "partial_count" in plan and plan.count("Exchange hashpartitioning") == 1
    rows = df.collect()
    assert sum(r.vinculos for r in rows) == 200 and {r.ano for r in rows} == {2021}


def test_sector_values(spark, store):
    rows = {r.setor: r for r in reports.one_year(reports.sector_summary(tables.read(spark, store, LINKS)), 2022).collect()}
    assert len(rows) == 19 and sum(r.vinculos for r in rows.values()) == 400
    farming = rows["Agropecuaria"]
    assert (farming.vinculos, farming.ativos_31dez, farming.remun_media) == (12, 8, 52.5)


def test_counting_reads_no_column(spark, store):
    line = next(x for x in plan_of(tables.rows_per_file(spark, store, LINKS)).splitlines() if "FileScan" in x)
    assert line.rstrip().endswith("ReadSchema: struct<>")


def test_scan_is_splittable_and_stays_in_the_engine(spark, store, tmp_path):
    path = put(tmp_path / "a.txt", ["PIS;CPF", *["1;2"] * 2_000_000])
    df = scan(spark, [f"file:{path}"], Layout(";", ("PIS", "CPF")))
    assert df.rdd.getNumPartitions() > 1
    assert "Python" not in plan_of(df) and "Exchange" not in plan_of(df)
    assert df.count() == 2_000_000


def test_spread_is_a_rebalance_that_can_be_cut(spark, store):
    rows = tables.read(spark, store, LINKS, lineage=True)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of(tables.spread(rows))


def test_a_hot_state_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 200_000, 1, 16).selectExpr(
        "2020 AS ano", "CAST(id AS STRING) AS pis", "IF(id % 10 < 8, '35', '12') AS uf", "'F.txt' AS arquivo"
    )
    full = conform(rows, LINKS).withColumn("arquivo", F.lit("F.txt"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        tables.write(tables.spread(full), str(tmp_path), LINKS, "a load")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    entry = spark.createDataFrame([("vinculos", 2020, "F.txt", 200_000, 1)], "dataset string, ano int, filename string, rows bigint, size_bytes bigint")
    Ledger(spark, str(tmp_path)).mark_done(entry.withColumn("version", tables.version("a load", name="filename")))
    files = tables.stored_files(spark, str(tmp_path))
    assert files.where("path LIKE '%uf=35%'").count() > 1
    assert tables.read(spark, str(tmp_path), LINKS).selectExpr("count(DISTINCT pis)", "count(*)").first() == (200_000, 200_000)


def test_counting_a_batch_looks_at_its_folders_alone(spark, store):
    some = Ledger(spark, store).list_done(year=2021).first()
    counted = tables.rows_of_versions(spark, store, LINKS, [(2021, some.filename, some.version)])
    assert "Join" not in plan_of(counted) and "ano=2022" not in plan_of(counted)
    assert counted.first().rows == some.rows
    assert tables.rows_of_versions(spark, store, LINKS, [(2021, "nothing.txt", 1)]).count() == 0


def test_many_versions_are_joined(spark, store, monkeypatch):
    whole = tables.read(spark, store, LINKS).count()
    monkeypatch.setattr(tables, "PRUNED", 0)
    assert "LeftSemi" in plan_of(tables.read(spark, store, LINKS)) and tables.read(spark, store, LINKS).count() == whole


def test_settings_of_a_load_are_its_own(spark):
    own = own_session(spark, {"spark.sql.codegen.wholeStage": "false"})
    assert own.conf.get("spark.sql.codegen.wholeStage") == "false"
    assert spark.conf.get("spark.sql.codegen.wholeStage") == "true"
    assert own.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")


def test_reconcile(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "ano int")
    right = spark.createDataFrame([(1,), (1,), (3,)], "ano int")
    rows = {r.ano: tuple(r)[1:] for r in reports.reconcile(left, right, ["ano"]).collect()}
    assert rows == {1: (2, 2, True), 2: (1, 0, False), 3: (0, 1, False)}
