import os
import time

import pytest
from registry_files import HISTORIC, HISTORIC_ROW, NEW, NEW_ROW, job_link_file, put, quote

from laborlake.model import DATASETS
from laborlake.operators.ledger import Ledger
from laborlake.sources import store as tables
from laborlake.sources.delimited import Layout
from laborlake.streaming.arrivals import arrivals_path, arrived, follow, follow_rows, load_arrivals, load_stream

LINKS = DATASETS["vinculos"]


def add(base, year, name, pis):
    put(job_link_file(base, year, name), ["Município;PIS", f"120040;{pis}"])


def test_files_load_once_as_they_arrive(spark, tmp_path):
    base, store = tmp_path / "source", str(tmp_path / "store")
    add(base, 2014, "AC2014ID.txt", "A")
    put(job_link_file(base, 2014, "SP2014ID.txt"), [])
    put(job_link_file(base, 2014, "layout.xls"), ["x"])
    first = load_arrivals(spark, str(base), store)
    assert sorted(first.rows.values()) == [0, 1]
    add(base, 2015, "RAIS_VINC_ID_X [1].COMT", "B")
    second = load_arrivals(spark, str(base), store)
    assert [s.filename for s in second.rows] == ["RAIS_VINC_ID_X [1].COMT"]
    assert load_arrivals(spark, str(base), store).found == 0
    assert sorted(r.pis for r in tables.read(spark, store, LINKS).collect()) == ["A", "B"]
    assert Ledger(spark, store).count() == 3


@pytest.mark.parametrize("take", [load_arrivals, lambda *a: load_stream(*a).awaitTermination()])
def test_compressed_files_are_picked_up(spark, tmp_path, take):
    base, store = tmp_path / "source", str(tmp_path / "store")
    add(base, 2014, "AC2014ID.tXt.gz", "A")
    take(spark, str(base), store)
    take(spark, str(base), store)
    assert [(r.pis, r.arquivo) for r in tables.read(spark, store, LINKS, lineage=True).collect()] == [("A", "AC2014ID.tXt")]


def test_a_second_look_starts_no_batch(spark, tmp_path):
    base, store = tmp_path / "source", str(tmp_path / "store")
    add(base, 2014, "AC2014ID.txt", "A")
    follow(spark, str(base), store).awaitTermination()
    again = follow(spark, str(base), store)
    again.awaitTermination()
    assert sum(p.numInputRows for p in again.recentProgress) == 0
    assert spark.read.parquet(arrivals_path(store)).count() == 1
    assert arrived(spark, str(base), store).first().filename == "AC2014ID.txt"


def test_rows_of_one_layout_as_a_stream(spark, tmp_path):
    put(tmp_path / "in" / "AC2014ID.txt", [";".join(HISTORIC), ";".join(HISTORIC_ROW), ";".join([*HISTORIC_ROW, "x"])])
    rows = follow_rows(spark, str(tmp_path / "in"), Layout(";", tuple(HISTORIC)), LINKS, 2014)
    out = str(tmp_path / "out")
    query = (
        rows.writeStream.format("parquet").partitionBy("ano", "uf").option("path", out)
        .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.read.schema(tables.stored_struct(LINKS)).parquet(out).collect()
    assert [(r.ano, r.uf, r.idade, r.arquivo) for r in got] == [(2014, "12", 49, "AC2014ID.txt")]


def test_old_files_in_odd_case_are_picked_up(spark, tmp_path):
    base, store = tmp_path / "source", str(tmp_path / "store")
    add(base, 2014, "AC2014ID.txt", "A")
    load_arrivals(spark, str(base), store)
    add(base, 2015, "AC2015ID.tXt", "B")
    then = time.time() - 400 * 86400
    os.utime(job_link_file(base, 2015, "AC2015ID.tXt"), (then, then))
    assert [s.filename for s in load_arrivals(spark, str(base), store).rows] == ["AC2015ID.tXt"]


def test_layouts_and_years_are_one_stream_and_a_restart_repeats_nothing(spark, tmp_path):
    base, store = tmp_path / "source", str(tmp_path / "store")
    put(job_link_file(base, 2014, "AC2014ID.txt"), [";".join(HISTORIC), ";".join(HISTORIC_ROW), ";".join([*HISTORIC_ROW, "x"])])
    put(job_link_file(base, 2024, "RAIS_VINC_ID_SUL.txt"), [quote(NEW), quote(NEW_ROW)])
    add(base, 2015, "SP2015ID.txt", "B")
    batches = []
    follow_all = lambda: load_stream(spark, str(base), store, files_per_batch=2, on_batch=lambda n, r: batches.append((n, sorted(s.ano for s in r.rows)))).awaitTermination()
    follow_all()
    assert [n for n, _ in batches] == [0, 1] and sorted(y for _, years in batches for y in years) == [2014, 2015, 2024]
    rows = lambda: sorted((r.ano, r.uf, r.pis) for r in tables.read(spark, store, LINKS).collect())
    assert rows() == [(2014, "12", "11111111111"), (2015, "12", "B"), (2024, "43", "22222222222")]
    follow_all()
    assert len(batches) == 2 and len(rows()) == 3
    add(base, 2016, "SP2016ID.txt", "C")
    follow_all()
    assert batches[2:] == [(2, [2016])] and len(rows()) == 4


def test_a_batch_that_runs_again_stores_nothing_twice(spark, tmp_path, monkeypatch):
    """The stream is lost after the ledger has published a batch and before the checkpoint knows."""
    base, store = tmp_path / "source", str(tmp_path / "store")
    add(base, 2014, "AC2014ID.txt", "A")

    def lost(*_):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        load_stream(spark, str(base), store, on_batch=lost).awaitTermination()
    assert tables.read(spark, store, LINKS).count() == 1
    found = []
    load_stream(spark, str(base), store, on_batch=lambda n, r: found.append((n, r.found))).awaitTermination()
    assert found == [(0, 0)]
    assert tables.read(spark, store, LINKS).count() == 1 and Ledger(spark, store).count() == 1


def test_a_file_that_fails_does_not_stop_the_stream(spark, tmp_path):
    base, store, failed = tmp_path / "source", str(tmp_path / "store"), []
    put(job_link_file(base, 2013, "AC2013ID.txt"), ["", "x"])
    add(base, 2014, "AC2014ID.txt", "A")
    load_stream(spark, str(base), store, on_batch=lambda _, r: failed.extend(s.filename for s in r.failed)).awaitTermination()
    assert failed == ["AC2013ID.txt"] and tables.read(spark, store, LINKS).count() == 1
