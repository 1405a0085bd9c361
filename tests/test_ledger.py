import json
import time

import pytest

from laborlake.operators import ledger
from laborlake.operators.ledger import Ledger
from laborlake.sources.headers import own_session

COLUMNS = "dataset string, ano int, filename string, rows bigint, size_bytes bigint"
AC14 = ("vinculos", 2014, "AC2014ID.txt", 1000, 72000000)
AC15 = ("vinculos", 2015, "AC2014ID.txt", 10, 20)
ESTB = ("estabelecimentos", 2014, "Estb2014ID.txt", 5, 0)


@pytest.fixture()
def table(spark, tmp_path):
    return Ledger(spark, str(tmp_path))


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), COLUMNS)


def test_nothing_yet(table):
    assert table.count() == 0 and not table.is_done("vinculos", 2014, "AC2014ID.txt")


def test_rows_stay(spark, table, tmp_path):
    table.mark_done(frame(spark, AC14))
    again = Ledger(spark, str(tmp_path))
    assert again.is_done(*AC14[:3]) and again.entry(*AC14[:3]).first()[:5] == AC14
    assert again.entry(*AC14[:3]).first().processed_at is not None


def test_year_is_part_of_the_key(spark, table):
    table.mark_done(frame(spark, AC14))
    assert not table.is_done(*AC15[:3])
    table.mark_done(frame(spark, AC15))
    assert table.count() == 2


def test_last_write_wins(spark, table):
    table.mark_done(frame(spark, AC14))
    first = table.entry(*AC14[:3]).first().processed_at
    time.sleep(0.01)
    table.mark_done(frame(spark, (*AC14[:3], 7, 8)))
    row = table.entry(*AC14[:3]).first()
    assert table.count() == 1 and (row.rows, row.size_bytes) == (7, 8) and row.processed_at > first


def test_remove_and_redo(spark, table):
    table.mark_done(frame(spark, AC14, AC15))
    table.remove(frame(spark, AC14))
    assert not table.is_done(*AC14[:3]) and table.count() == 1
    table.mark_done(frame(spark, AC14))
    assert table.is_done(*AC14[:3])


def test_filters(spark, table):
    table.mark_done(frame(spark, AC14, AC15, ESTB))
    assert table.list_done(dataset="vinculos").count() == 2
    assert table.list_done(year=2014).count() == 2
    assert table.list_done("vinculos", 2014).count() == 1


def test_pending_and_loaded(spark):
    files, done = frame(spark, AC14, AC15, ESTB), frame(spark, AC14)
    assert {r.ano for r in ledger.pending(files, done).collect()} == {2015, 2014}
    assert [r.filename for r in ledger.loaded(files, done).collect()] == ["AC2014ID.txt"]


def test_status_and_totals(spark):
    done = frame(spark, AC14, AC15, ESTB, ("vinculos", 2014, "SP2014ID.txt", 1, 28000000))
    status = [tuple(r) for r in ledger.status(done).collect()]
    assert status == [
        ("estabelecimentos", 2014, 1, 5, 0, 0.0),
        ("vinculos", 2014, 2, 1001, 100000000, 0.1),
        ("vinculos", 2015, 1, 10, 20, 0.0),
    ]
    totals = [tuple(r) for r in ledger.status_with_total(done).collect()]
    assert totals == [*status, (None, None, 4, 1016, 100000020, 0.1)]


def test_compression(spark):
    stored = spark.createDataFrame([("a", 25000000), ("b", 25000000)], "path string, length bigint")
    row = ledger.compression(frame(spark, AC14, (*ESTB[:4], 28000000)), stored).first()
    assert (row.source_bytes, row.parquet_bytes, row.ratio, row.percent) == (100000000, 50000000, 0.5, "50.0%")
    assert (row.source_gb, row.parquet_gb) == (0.1, 0.05)
    nothing = ledger.compression(frame(spark, ESTB), stored.limit(0)).first()
    assert nothing.ratio is None and nothing.parquet_bytes == 0


def test_versions_are_reduced_before_the_shuffle(spark, table):
    table.mark_done(frame(spark, AC14))
    plan = table.current()._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_a_json_ledger_can_be_adopted(spark, table, tmp_path):
    entry = {"dataset": "vinculos", "ano": 2014, "filename": "AC2014ID.txt", "rows": 1000, "size_bytes": 72000000,
             "processed_at": "2026-01-02T03:04:05.678901+00:00"}
    path = tmp_path / "ledger.json"
    path.write_text(json.dumps([entry, {**entry, "ano": 2015}], indent=2), encoding="utf-8")
    table.adopt(ledger.read_json(spark, str(path)))
    row = table.entry("vinculos", 2014, "AC2014ID.txt").first()
    assert row[:5] == AC14 and str(row.processed_at)[-15:] == "03:04:05.678901"
    assert table.count() == 2


def test_compaction_keeps_the_newest_rows(spark, tmp_path):
    table = Ledger(spark, str(tmp_path))
    table.compact()
    files = lambda n: spark.createDataFrame([("vinculos", 2014, f"F{i}.txt", 10 * n, 5) for i in range(4)], "dataset string, ano int, filename string, rows bigint, size_bytes bigint")
    for n in (1, 2, 3):
        table.mark_done(files(n))
    table.remove(files(1).limit(1))
    before = table.current().orderBy("filename").collect()
    table.compact()
    assert table.current().orderBy("filename").collect() == before and table.entries().count() == 3
    assert {r.rows for r in before} == {30}


def entries_of(path):
    return sorted(p.name for p in (path / "_ledger" / "log").iterdir())


@pytest.mark.parametrize("clock", ["equal", "reversed"])
def test_the_order_of_entries_decides_whatever_the_clocks_say(spark, tmp_path, monkeypatch, clock):
    table = Ledger(spark, str(tmp_path))
    times = iter({"equal": [5, 5, 5], "reversed": [9, 6, 3]}[clock])
    monkeypatch.setattr(ledger.F, "current_timestamp", lambda: ledger.F.timestamp_seconds(ledger.F.lit(next(times))))
    table.mark_done(frame(spark, (*AC14[:3], 1, 1)))
    table.remove(frame(spark, AC14))
    assert table.count() == 0
    table.mark_done(frame(spark, (*AC14[:3], 3, 3)))
    assert table.entry(*AC14[:3]).first().rows == 3
    table.compact()
    assert table.entry(*AC14[:3]).first().rows == 3


def test_a_number_is_taken_once(spark, tmp_path, monkeypatch):
    """Another writer publishes while this one is writing: both entries count, one after the other."""
    table, other = Ledger(spark, str(tmp_path)), Ledger(spark, str(tmp_path))
    make, calls = ledger.create_once, []

    def other_first(session, path, text):
        calls.append(path[-25:])
        if len(calls) == 1:
            other.mark_done(frame(spark, (*AC14[:3], 1, 1), AC15))
        return make(session, path, text)

    monkeypatch.setattr(ledger, "create_once", other_first)
    table.mark_done(frame(spark, (*AC14[:3], 2, 2)))
    assert [c[:20] for c in calls] == [f"{n:020d}" for n in (1, 1, 2)] and len(entries_of(tmp_path)) == 2
    assert table.count() == 2 and table.entry(*AC14[:3]).first().rows == 2


def test_many_writers_lose_no_entry(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    write = lambda i: Ledger(spark, str(tmp_path)).mark_done(frame(spark, ("vinculos", i, "F.txt", i, 1)))
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(write, range(16)))
    assert len(entries_of(tmp_path)) == 16 and Ledger(spark, str(tmp_path)).count() == 16


def test_an_entry_published_during_a_compaction_still_counts(spark, tmp_path, monkeypatch):
    table = Ledger(spark, str(tmp_path))
    table.mark_done(frame(spark, AC14, AC15))
    make, calls = ledger.create_once, []

    def other_first(session, path, text):
        calls.append(path)
        if len(calls) == 1:
            Ledger(spark, str(tmp_path)).mark_done(frame(spark, (*AC14[:3], 7, 7), ESTB))
            Ledger(spark, str(tmp_path)).remove(frame(spark, AC15))
        return make(session, path, text)

    monkeypatch.setattr(ledger, "create_once", other_first)
    table.compact()
    assert {(r.filename, r.rows) for r in table.current().collect()} == {("AC2014ID.txt", 7), ("Estb2014ID.txt", 5)}
    table.compact()
    assert {(r.filename, r.rows) for r in table.current().collect()} == {("AC2014ID.txt", 7), ("Estb2014ID.txt", 5)}
    assert len(entries_of(tmp_path)) == 1


def test_rows_that_were_never_published_count_nowhere(spark, tmp_path, monkeypatch):
    table = Ledger(spark, str(tmp_path))
    table.mark_done(frame(spark, AC14))
    with monkeypatch.context() as broken, pytest.raises(OSError, match="lost"):
        broken.setattr(ledger, "create_once", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        table.mark_done(frame(spark, AC15))
    assert table.count() == 1


def test_a_ledger_without_numbers_is_read_and_goes_on(spark, tmp_path):
    old = frame(spark, AC14, AC15).selectExpr("*", "timestamp_seconds(4000000000) AS processed_at", "false AS deleted")
    old.write.parquet(str(tmp_path / "_ledger"))
    table = Ledger(spark, str(tmp_path))
    assert table.count() == 2
    table.remove(frame(spark, AC15))
    assert table.count() == 1
    table.compact()
    assert table.count() == 1 and list((tmp_path / "_ledger").glob("*.parquet")) == []


def test_later_entries_are_not_replaced_by_adopted_ones(spark, table):
    table.mark_done(frame(spark, AC14))
    table.adopt(frame(spark, (*AC14[:3], 1, 1), AC15).selectExpr("*", "timestamp_seconds(1000) AS processed_at", "false AS deleted"))
    assert {(r.ano, r.rows) for r in table.current().collect()} == {(2014, 1000), (2015, 10)}


def test_rows_of_one_entry_do_not_meet_in_one_task(spark, tmp_path):
    table = Ledger(own_session(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}), str(tmp_path))
    table.mark_done(frame(spark, AC14, AC15, ESTB))
    plan = table.entries()._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert table.count() == 3
