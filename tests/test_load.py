import struct
import zlib
from datetime import date

import pytest
from registry_files import HISTORIC, HISTORIC_ROW, NEW, NEW_ROW, job_link_file, put, quote

from laborlake.model import DATASETS
from laborlake.operators.ledger import Ledger
from laborlake.plans.load import Source, load, named_in, write_session
from laborlake.sources import store as tables

LINKS = DATASETS["vinculos"]
HEADER = ["Município", "PIS", "Idade"]


@pytest.fixture()
def base(tmp_path):
    return tmp_path / "source"


@pytest.fixture()
def store(tmp_path):
    return str(tmp_path / "store")


def small(base, year, name, rows, header=HEADER):
    return put(job_link_file(base, year, name), [";".join(header), *rows])


def stored(spark, store, **options):
    return tables.read(spark, store, LINKS, **options)


def pairs(spark, store):
    return sorted((r.pis, r.idade) for r in stored(spark, store).collect())


def folders(store):
    from pathlib import Path

    return sorted(str(p.relative_to(f"{store}/vinculos")) for p in Path(store, "vinculos").glob("ano=*/uf=*/arquivo=*"))


def test_both_layouts_end_to_end(spark, base, store):
    put(job_link_file(base, 2014, "AC2014ID.txt"), [";".join(HISTORIC), ";".join(HISTORIC_ROW)])
    put(job_link_file(base, 2024, "RAIS_VINC_ID_SUL.txt"), [quote(NEW), quote(NEW_ROW)])
    result = load(spark, str(base), store)
    assert (result.found, result.total_rows, result.failed) == (2, 2, {})
    df = stored(spark, store)
    assert df.columns == LINKS.columns and df.schema["uf"].dataType.simpleString() == "string"
    assert df.schema["vl_remun_media_nom"].dataType.simpleString() == "double"
    old, new = df.orderBy("ano").collect()
    assert (old.ano, old.uf, old.data_admissao, old.vl_remun_media_nom) == (2014, "12", date(2014, 6, 2), 1125.29)
    assert (new.ano, new.uf, new.data_admissao, new.municipio) == (2024, "43", date(2024, 6, 2), "430543")
    assert folders(store) == [
        "ano=2014/uf=12/arquivo=AC2014ID.txt",
        "ano=2024/uf=43/arquivo=RAIS_VINC_ID_SUL.txt",
    ]
    assert tables.stored_files(spark, store).where("path LIKE '%.zstd.parquet'").count() == 2


def test_establishments(spark, base, store):
    fields = DATASETS["estabelecimentos"].fields
    row = ["355030" if f.name == "municipio" else "01022003" if f.dtype == "date" else "7" for f in fields]
    put(base / "RAIS Estabelecimentos" / "Estb2014ID.txt", [";".join(f.aliases[0] for f in fields), ";".join(row)])
    assert load(spark, str(base), store).total_rows == 1
    got = tables.read(spark, store, DATASETS["estabelecimentos"]).first()
    assert (got.ano, got.uf, got.data_baixa, got.qtd_vinculos_clt) == (2014, "35", date(2003, 2, 1), 7)


def test_row_shapes(spark, base, store):
    small(base, 2014, "AC2014ID.txt", [
        "120040;A;1", "120040;B", "120040;C;3;x", "120040;D;4;", "", "   ", '"120;040";E;5', "NA;F;nan", '"";G;"7"',
        "120040;H;8", '120040;"I;x";9;y', "350000;J",
    ])
    result = load(spark, str(base), store)
    assert result.failed == {}
    rows = {r.pis: (r.municipio, r.uf, r.idade) for r in stored(spark, store).collect()}
    assert rows == {
        "A": ("120040", "12", 1), "B": ("120040", "12", None), "E": ("120;040", "12", 5), "F": (None, "00", None),
        "G": (None, "00", 7), "H": ("120040", "12", 8), "J": ("350000", "35", None),
    }
    assert result.total_rows == 7


def test_running_again_changes_nothing(spark, base, store):
    small(base, 2014, "AC2014ID.txt", ["120040;A;1"])
    load(spark, str(base), store)
    before = (folders(store), Ledger(spark, store).current().collect())
    again = load(spark, str(base), store)
    assert (again.found, again.total_rows) == (0, 0)
    assert (folders(store), Ledger(spark, store).current().collect()) == before


def test_only_new_files_load(spark, base, store):
    small(base, 2014, "AC2014ID.txt", ["120040;A;1"])
    load(spark, str(base), store)
    small(base, 2015, "AC2014ID.txt", ["120040;B;2"])
    result = load(spark, str(base), store)
    assert [s.ano for s in result.rows] == [2015]
    assert pairs(spark, store) == [("A", 1), ("B", 2)]


def test_filters(spark, base, store):
    small(base, 2014, "AC2014ID.txt", ["120040;A;1"])
    small(base, 2014, "SP2014ID.txt", ["350040;B;2"])
    small(base, 2015, "SP2015ID.txt", ["350040;C;3"])
    load(spark, str(base), store, year=2014, state="sp")
    assert pairs(spark, store) == [("B", 2)]


def test_force_replaces_rows_and_states(spark, base, store):
    small(base, 2014, "AC2014ID.txt", ["120040;A;1", "350000;B;2"])
    small(base, 2014, "SP2014ID.txt", ["350000;C;3"])
    load(spark, str(base), store)
    first = Ledger(spark, store).entry("vinculos", 2014, "AC2014ID.txt").first()
    small(base, 2014, "AC2014ID.txt", ["120040;A;9"])
    load(spark, str(base), store, state="AC", force=True)
    assert pairs(spark, store) == [("A", 9), ("C", 3)]
    assert {r.uf for r in stored(spark, store).where("pis = 'A'").collect()} == {"12"}
    second = Ledger(spark, store).entry("vinculos", 2014, "AC2014ID.txt").first()
    assert second.processed_at > first.processed_at and second.rows == 1


def test_rows_left_by_an_interrupted_run_are_replaced(spark, base, store):
    small(base, 2014, "AC2014ID.txt", ["120040;A;1"])
    load(spark, str(base), store)
    ledger = Ledger(spark, store)
    ledger.remove(ledger.current())
    load(spark, str(base), store)
    assert pairs(spark, store) == [("A", 1)]


def test_empty_and_header_only_files_are_done(spark, base, store):
    put(job_link_file(base, 2014, "AC2014ID.txt"), [])
    small(base, 2014, "SP2014ID.txt", [])
    small(base, 2014, "RAIS_VINC_ID_SUL.txt", [])
    result = load(spark, str(base), store)
    assert result.failed == {} and sorted(result.rows.values()) == [0, 0, 0]
    assert Ledger(spark, store).count() == 3
    assert load(spark, str(base), store).found == 0
    assert stored(spark, store).count() == 0


def test_same_name_in_two_folders_is_refused(spark, base, store):
    small(base, 2014, "AC2014ID.txt", ["120040;A;1"])
    small(base, 2014, "x/AC2014ID.txt", ["120040;B;1"])
    with pytest.raises(ValueError, match="two files"):
        load(spark, str(base), store)


def test_odd_file_names(spark, base, store):
    name = "RAIS_VINC_ID_X [1] + %20.txt"
    small(base, 2014, name, ["120040;A;1"])
    for _ in range(2):
        result = load(spark, str(base), store, force=True)
        assert {s.filename: n for s, n in result.rows.items()} == {name: 1}
    assert [r.arquivo for r in stored(spark, store, lineage=True).collect()] == [name]


def test_good_rows_stay_beside_long_ones(spark, base, store):
    small(base, 2014, "AC2014ID.txt", ["120040;A;1;x", "120040;B;2;x", "120040;C;3"])
    small(base, 2014, "SP2014ID.txt", ["350000;D;1;x", "350000;E;2", "350000;F;3"])
    small(base, 2014, "RJ2014ID.txt", ["330000;G;1;", "330000;H;2;"])
    small(base, 2014, "RS2014ID.txt", ["430000;I;1"])
    result = load(spark, str(base), store)
    assert result.failed == {} and pairs(spark, store) == [("C", 3), ("E", 2), ("F", 3), ("I", 1)]
    assert {r.filename: r.dropped_rows for r in result.dropped.collect()} == {"AC2014ID.txt": 2, "SP2014ID.txt": 1, "RJ2014ID.txt": 2}
    assert load(spark, str(base), store).found == 0


def test_strict_refuses_long_rows(spark, base, store):
    header = [a.aliases[0] for a in LINKS.fields]
    row = ";".join(["120040"] * len(header))
    put(job_link_file(base, 2014, "AC2014ID.txt"), [";".join(header), row, row + ";x"])
    put(job_link_file(base, 2014, "SP2014ID.txt"), [";".join(header), row])
    result = load(spark, str(base), store, strict=True)
    assert [s.filename for s in result.failed] == ["AC2014ID.txt"]
    assert "more fields" in result.errors.first().error and stored(spark, store).count() == 1


def test_quotes_are_read_as_pandas_reads_them(spark, base, store):
    import pandas as pd

    header = '"PIS","Razão Social","Município - Código","Qtd Hora Contr"'
    rows = [r'"1","BAR ""DO ZE"" LTDA","120040","40"', r'"2","BACK \","120040","41"', r'"3","x ""q"", y","120040","42"',
            r'"4","""all""","120040","43"', r'"5","a\"", b","120040","44"', r'"6","","120040","45"', r'7,plain \ text,120040,46']
    path = put(job_link_file(base, 2024, "RAIS_VINC_ID_SUL.txt"), [header, *rows])
    assert load(spark, str(base), store).failed == {}
    want = pd.read_csv(path, encoding="latin-1", dtype=str)
    got = {r.pis: (r.razao_social, r.municipio, r.qtd_hora_contr) for r in stored(spark, store).collect()}
    assert got == {
        p: (None if pd.isna(n) else n, m, int(h)) for p, n, m, h in want.itertuples(index=False)
    }


def test_quoted_line_breaks_are_noticed(spark, base, store):
    head = '"PIS","Nome Trabalhador"'
    put(job_link_file(base, 2024, "RAIS_VINC_ID_SUL.txt"), [head, '"A","X', 'Y"', '"B","Z"'])
    put(job_link_file(base, 2024, "RAIS_VINC_ID_SP.txt"), [head, '"C","W"'])
    result = load(spark, str(base), store)
    assert result.failed == {} and result.total_rows == 3
    assert {r.pis: r.nome_trabalhador for r in stored(spark, store).collect()} == {"A": "X\nY", "B": "Z", "C": "W"}


def count_writes(monkeypatch):
    write, calls = tables.write, []
    monkeypatch.setattr(tables, "write", lambda *a: (calls.append(1), write(*a)))
    return calls


def test_files_with_line_breaks_are_written_once(spark, base, store, monkeypatch):
    calls = count_writes(monkeypatch)
    put(job_link_file(base, 2024, "RAIS_VINC_ID_SUL.txt"), ['"PIS","Nome Trabalhador"', '"A","X', 'Y"', '"B","JOSÉ"', '"C","Ã', 'É"'])
    assert load(spark, str(base), store).total_rows == 3 and len(calls) == 1
    assert {r.pis: r.nome_trabalhador for r in stored(spark, store).collect()} == {"A": "X\nY", "B": "JOSÉ", "C": "Ã\nÉ"}


def test_line_breaks_far_from_the_start_are_noticed(spark, base, store, monkeypatch):
    calls = count_writes(monkeypatch)
    put(job_link_file(base, 2024, "RAIS_VINC_ID_SUL.txt"), ['"PIS","Nome Trabalhador"', *['"A","JOSÉ"'] * 3000, '"B","X', 'Y"'])
    assert load(spark, str(base), store).total_rows == 3001 and len(calls) == 2
    assert [r.nome_trabalhador for r in stored(spark, store).where("pis = 'B'").collect()] == ["X\nY"]


def test_odd_quotes_alone_are_no_line_breaks(spark, base, store, monkeypatch):
    calls = count_writes(monkeypatch)
    put(job_link_file(base, 2014, "AC2014ID.txt"), ["PIS;Razão Social", 'A;BAR 5" LTDA', "B;X", 'C;BAR 7" LTDA'])
    assert load(spark, str(base), store).total_rows == 3 and len(calls) == 1
    assert {r.pis: r.razao_social for r in stored(spark, store).collect()} == {"A": 'BAR 5" LTDA', "B": "X", "C": 'BAR 7" LTDA'}


def test_compressed_files_load_as_others_do(spark, base, store):
    put(job_link_file(base, 2014, "AC2014ID.txt"), [";".join(HISTORIC), ";".join(HISTORIC_ROW)])
    put(job_link_file(base, 2014, "SP2014ID.txt.gz"), [";".join(HISTORIC), ";".join(HISTORIC_ROW), ";".join([*HISTORIC_ROW, "x"])])
    put(job_link_file(base, 2024, "RAIS_VINC_ID_X [1].txt.gz"), ['"PIS","Nome Trabalhador"', '"A","X', 'Y"', '"B","JOSÉ"'])
    bad = put(job_link_file(base, 2024, "RAIS_VINC_ID_BAD.txt.gz"), ["PIS;Município", *[f"{i};120040" for i in range(50_000)]])
    bad.write_bytes(bad.read_bytes()[:60_000])
    result = load(spark, str(base), store)
    assert [s.filename for s in result.failed] == ["RAIS_VINC_ID_BAD.txt"]
    assert {s.filename: n for s, n in result.rows.items()} == {"AC2014ID.txt": 1, "SP2014ID.txt": 1, "RAIS_VINC_ID_X [1].txt": 2}
    assert {s.filename: n for s, n in result.long_rows.items()} == {"SP2014ID.txt": 1}
    rows = stored(spark, store, lineage=True).collect()
    assert sorted((r.arquivo, r.nome_trabalhador) for r in rows) == [
        ("AC2014ID.txt", "PESSOA TESTE"), ("RAIS_VINC_ID_X [1].txt", "JOSÉ"), ("RAIS_VINC_ID_X [1].txt", "X\nY"), ("SP2014ID.txt", "PESSOA TESTE"),
    ]
    bad.unlink()
    assert load(spark, str(base), store).found == 0
    put(job_link_file(base, 2014, "SP2014ID.txt"), [";".join(HISTORIC), ";".join(HISTORIC_ROW)])
    with pytest.raises(ValueError, match="two files"):
        load(spark, str(base), store, force=True)


def test_a_task_takes_as_much_text_of_compressed_files(spark):
    plain, packed = (write_session(spark, sources_at(f"/data/AC2014ID.txt{end}")) for end in ("", ".gz"))
    most = [int(own.conf.get("spark.sql.files.maxPartitionBytes").removesuffix("b")) for own in (plain, packed)]
    assert most[0] == 4 * most[1]


def test_quotes_that_never_close_fail_their_file(spark, base, store):
    head = '"PIS","Nome Trabalhador"'
    put(job_link_file(base, 2024, "RAIS_VINC_ID_SUL.txt"), [head, '"A', '"B","Z"', '"C","Y"'])
    put(job_link_file(base, 2024, "RAIS_VINC_ID_SP.txt"), [head, '"C","W"'])
    result = load(spark, str(base), store)
    assert [(s.filename, e) for s, e in result.failed.items()] == [("RAIS_VINC_ID_SUL.txt", "layout: quotes that never close")]
    assert [r.pis for r in stored(spark, store).collect()] == ["C"] and Ledger(spark, store).count() == 1


def test_two_loads_at_a_time_double_nothing(spark, base, store, monkeypatch):
    small(base, 2014, "AC2014ID.txt", [f"120040;P{i};{i}" for i in range(5)])
    write, inside = tables.write, []

    def other_load_first(df, *where):
        if not inside:
            inside.append(None)
            inside[0] = load(spark, str(base), store)
        write(df, *where)

    monkeypatch.setattr(tables, "write", other_load_first)
    load(spark, str(base), store)
    assert inside[0].total_rows == 5 and stored(spark, store).count() == 5


class EngineError(Exception):
    """An error as the engine's are seen here: a condition and its parameters."""

    def __init__(self, condition, path, text="No space left on device"):
        super().__init__(text)
        self.condition, self.path = condition, path

    def getCondition(self):  # noqa: N802
        return self.condition

    def getMessageParameters(self):  # noqa: N802
        return {"path": self.path}


def sources_at(*paths):
    return [Source("vinculos", 2014, path.rpartition("/")[2], path, 1, None) for path in paths]


def test_files_are_blamed_by_the_engine_s_parameter_alone():
    some = sources_at("/data/part-1", "/data/part-10", "file:/data/a b%20.txt", "viewfs://store/in/part-1")
    blamed = lambda *what: [s.path for s in named_in(EngineError(*what), some)]
    assert blamed("FAILED_READ_FILE.NO_HINT", "/data/part-10") == ["/data/part-10"]
    assert blamed("FAILED_READ_FILE.NO_HINT", "file:///data/a%20b%2520.txt") == ["file:/data/a b%20.txt"]
    assert blamed("PATH_NOT_FOUND", "viewfs://store/in/part-1") == ["viewfs://store/in/part-1"]
    assert blamed("FAILED_READ_FILE.NO_HINT", "") == [] and blamed("OTHER", "/data/part-1") == []
    assert named_in(OSError("No space left on device"), some) == []
    assert named_in(RuntimeError("task lost while it read /data/part-1"), some) == []


def test_a_failure_after_the_write_leaves_no_rows(spark, base, store, monkeypatch):
    bad = small(base, 2014, "AC2014ID.txt", ["120040;A;1"])
    small(base, 2014, "SP2014ID.txt", ["350000;B;2"])
    write, calls = tables.write, []

    def fails_once(df, *where):
        write(df, *where)
        calls.append(1)
        if len(calls) == 1:
            raise EngineError("FAILED_READ_FILE.NO_HINT", f"file://{bad}")

    monkeypatch.setattr(tables, "write", fails_once)
    result = load(spark, str(base), store)
    assert [s.filename for s in result.failed] == ["AC2014ID.txt"] and len(calls) == 2
    assert pairs(spark, store) == [("B", 2)]


def test_what_is_no_file_s_fault_ends_the_load(spark, base, store, monkeypatch):
    for i in range(6):
        small(base, 2014, f"RAIS_VINC_ID_{i}.txt", ["120040;A;1"])
    calls = []

    def full(*_):
        calls.append(1)
        raise OSError("No space left on device")

    monkeypatch.setattr(tables, "write", full)
    with pytest.raises(OSError, match="space"):
        load(spark, str(base), store)
    assert len(calls) == 1 and Ledger(spark, store).count() == 0


def damage(path):
    """Checksums of a local file of which the last is wrong, so that reading it to the end fails."""
    data = path.read_bytes()
    sums = [zlib.crc32(data[i : i + 512]) for i in range(0, len(data), 512)]
    sums[-1] ^= 1
    path.with_name(f".{path.name}.crc").write_bytes(b"crc\0" + struct.pack(f">i{len(sums)}I", 512, *sums))


def test_an_unreadable_file_does_not_stop_the_others(spark, base, store):
    for i in range(5):
        small(base, 2014, f"RAIS_VINC_ID_{i}.txt", [f"120040;P{i};{i}"])
    damage(small(base, 2014, "RAIS_VINC_ID_BAD.txt", ["120040;Z;1"] * 400_000))
    result = load(spark, str(base), store)
    assert [s.filename for s in result.failed] == ["RAIS_VINC_ID_BAD.txt"]
    assert pairs(spark, store) == [(f"P{i}", i) for i in range(5)]
    assert sum(result.rows.values()) == 5 and Ledger(spark, store).count() == 5


def test_missing_required_columns(spark, base, store):
    small(base, 2014, "AC2014ID.txt", ["120040;A;1"])
    result = load(spark, str(base), store, strict=True)
    assert [e[:25] for e in result.failed.values()] == ["required columns missing:"]
    assert load(spark, str(base), store).total_rows == 1


def test_no_header(spark, base, store):
    put(job_link_file(base, 2014, "AC2014ID.txt"), ["", "x"])
    assert list(load(spark, str(base), store).failed.values()) == ["no header"]


def test_quoted_line_breaks_on_request(spark, base, store):
    put(job_link_file(base, 2024, "RAIS_VINC_ID_SUL.txt"), ['"PIS","Nome Trabalhador"', '"A","X', 'Y"', '"B","Z"'])
    load(spark, str(base), store, multiline=True)
    assert {r.pis: r.nome_trabalhador for r in stored(spark, store).collect()} == {"A": "X\nY", "B": "Z"}


@pytest.mark.parametrize("shape", ["direct", "spread"])
def test_write_shapes_store_the_same(spark, base, store, shape):
    small(base, 2014, "AC2014ID.txt", [f"{11 + i % 9}0000;{i};{i % 90}" for i in range(5000)])
    small(base, 2014, "RAIS_VINC_ID_SUL.txt", [f"{11 + i % 9}0000;{i};{i % 90}" for i in range(5000)])
    assert load(spark, str(base), store, shape=shape).total_rows == 10000
    ages = 2 * sum(i % 90 for i in range(5000))
    assert stored(spark, store).selectExpr("count(*)", "count(DISTINCT uf)", "sum(idade)").first() == (10000, 9, ages)


def test_small_batches(spark, base, store):
    for state in ("AC", "SP", "RJ"):
        small(base, 2014, f"{state}2014ID.txt", [f"120040;{state};1"])
    assert load(spark, str(base), store, batch_bytes=10).total_rows == 3
    assert Ledger(spark, store).entries().select("processed_at").distinct().count() == 3


def test_unknown_shape(spark, base, store):
    with pytest.raises(ValueError, match="shape"):
        load(spark, str(base), store, shape="other")


def test_reading_part_of_a_store(spark, base, store):
    small(base, 2014, "AC2014ID.txt", ["120040;A;1", "350000;B;2"])
    small(base, 2015, "AC2015ID.txt", ["120040;C;3"])
    load(spark, str(base), store)
    assert stored(spark, store, years=[2014]).count() == 2
    assert stored(spark, store, states=["12"]).count() == 2
    assert stored(spark, store, years=[2014, 2015], states=["35"]).count() == 1
    assert stored(spark, store, years=[1999]).count() == 0
    assert stored(spark, store).where("uf = '12' AND ano = 2015").count() == 1


def test_tables_without_file_folders_read_the_same(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for state in ("00", "12"):
        path = tmp_path / "vinculos" / "ano=2014" / f"uf={state}" / "AC2014ID.parquet"
        path.parent.mkdir(parents=True)
        pq.write_table(pa.table({"ano": pa.array([2014], pa.int32()), "pis": [state], "uf": [state]}), path)
    rows = stored(spark, str(tmp_path), lineage=True).collect()
    assert sorted((r.ano, r.uf, r.pis, r.cpf, r.arquivo) for r in rows) == [
        (2014, "00", "00", None, None),
        (2014, "12", "12", None, None),
    ]
    assert stored(spark, str(tmp_path), states=["00"]).count() == 1


def test_tables_without_versions_are_not_loaded_into(spark, base, tmp_path):
    (tmp_path / "old" / "vinculos" / "ano=2014" / "uf=12" / "arquivo=AC2014ID.txt").mkdir(parents=True)
    small(base, 2014, "AC2014ID.txt", ["120040;A;1"])
    with pytest.raises(ValueError, match="versions"):
        load(spark, str(base), str(tmp_path / "old"))


def test_readers_see_old_rows_or_new_ones(spark, base, store, monkeypatch):
    small(base, 2014, "AC2014ID.txt", ["120040;A;1", "350000;B;2"])
    small(base, 2014, "SP2014ID.txt", ["350000;C;3"])
    load(spark, str(base), store)
    before, planned = pairs(spark, store), stored(spark, store)
    small(base, 2014, "AC2014ID.txt", ["120040;A;9"])
    small(base, 2014, "SP2014ID.txt", ["350000;C;8"])
    write, publish, seen = tables.write, Ledger.mark_done, []

    def look_after(call):
        def looked(*args, **named):
            call(*args, **named)
            seen.append(pairs(spark, store))

        return looked

    monkeypatch.setattr(tables, "write", look_after(write))
    monkeypatch.setattr(Ledger, "mark_done", look_after(publish))
    load(spark, str(base), store, force=True)
    assert seen == [before, [("A", 9), ("C", 8)]]
    # A query planned before still finds what it read; the next load of the file takes it away.
    assert sorted((r.pis, r.idade) for r in planned.collect()) == before
    versions = lambda: {r.path.split("carga=")[1].split("/")[0] for r in tables._listed(spark, store).collect()}
    assert len(versions()) == 4
    load(spark, str(base), store, force=True)
    assert len(versions()) == 4 and pairs(spark, store) == [("A", 9), ("C", 8)]


def test_a_failed_reload_leaves_the_old_rows(spark, base, store):
    path = small(base, 2014, "AC2014ID.txt", ["120040;A;1"])
    load(spark, str(base), store)
    put(path, ["", "x"])
    assert list(load(spark, str(base), store, force=True).failed.values()) == ["no header"]
    assert pairs(spark, store) == [("A", 1)]


def test_an_interrupted_load_is_not_read_and_vacuum_removes_it(spark, base, store, monkeypatch):
    small(base, 2014, "AC2014ID.txt", ["120040;A;1"])
    with monkeypatch.context() as broken, pytest.raises(OSError, match="lost"):
        broken.setattr(Ledger, "mark_done", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        load(spark, str(base), store)
    assert stored(spark, store).count() == 0 and tables.stored_files(spark, store).count() == 0
    load(spark, str(base), store)
    assert tables._listed(spark, store).count() == 2 and tables.vacuum(spark, store) == 0
    assert tables.vacuum(spark, store, hours=0) == 1
    assert pairs(spark, store) == [("A", 1)] and tables._listed(spark, store).count() == tables.stored_files(spark, store).count() == 1


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_line_breaks_in_many_tasks_as_pandas_reads_them(spark, base, store, ending):
    import random

    import pandas as pd

    rng = random.Random(ending)
    cells = ["plain", '"two\nlines"', '"a ""b"" , \n\n c"', '""', '"x,y"', '"end \r\n"', '"' + "long\n" * 300 + '."', '"\\"']
    rows = [f'{i},{rng.choice(cells)},"120040",{i % 90}' for i in range(3000)]
    path = job_link_file(base, 2024, "RAIS_VINC_ID_SUL [1] +%20.txt")
    path.parent.mkdir(parents=True)
    path.write_bytes(ending.join(['"PIS","Razão\nSocial","Município - Código","Idade"', *rows]).replace("Razão\nSocial", "Razão Social").encode("latin-1"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        result = load(spark, str(base), store)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert result.failed == {} and result.total_rows == 3000
    want = pd.read_csv(path, encoding="latin-1", dtype=str, keep_default_na=False)
    got = {r.pis: (r.razao_social, r.idade) for r in stored(spark, store).collect()}
    assert got == {p: (n.strip() if n else None, int(i)) for p, n, _, i in want.itertuples(index=False)}


@pytest.fixture()
def mounted(spark, tmp_path):
    """A folder under a scheme that the engine's file systems know and Python does not."""
    (tmp_path / "in").mkdir()
    conf = spark._jsc.hadoopConfiguration()
    conf.set(f"fs.viewfs.mounttable.{tmp_path.name}.link./in", f"file:{tmp_path}/in")
    return f"viewfs://{tmp_path.name}/in"


def test_any_store_that_the_engine_opens(spark, mounted, tmp_path):
    base = tmp_path / "in" / "source"
    small(base, 2014, "AC2014ID.txt", ["120040;A;1"])
    small(base, 2014, "RAIS_VINC_ID_X [1] +%20.txt", ['120040;"B\nB";2'])
    put(job_link_file(base, 2015, "SP2015ID.txt"), [])
    result = load(spark, f"{mounted}/source", f"{mounted}/store")
    assert result.failed == {} and sorted(result.rows.values()) == [0, 1, 1]
    assert pairs(spark, f"{mounted}/store") == [("A", 1), ("B\nB", 2)]
    assert load(spark, f"{mounted}/source", f"{mounted}/store").found == 0
    load(spark, f"{mounted}/source", f"{mounted}/store", force=True)
    assert pairs(spark, f"{mounted}/store") == [("A", 1), ("B\nB", 2)]


def test_a_header_costs_no_more_in_a_large_file(spark, tmp_path):
    from laborlake.sources.headers import first_line

    path = put(tmp_path / "large.txt", ["PIS;CPF", *["1;2"] * 3_000_000])
    read = lambda: sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())
    before = read()
    assert first_line(spark, str(path)) == b"PIS;CPF" and read() - before < 1 << 20
    long = put(tmp_path / "wide.txt", [";".join(f"column {i}" for i in range(5000)), "1"])
    assert len(first_line(spark, f"file:{long}")) > 1 << 15


def test_rows_are_shuffled_only_if_asked_to(spark, base, store, monkeypatch):
    asked = []
    monkeypatch.setattr(tables, "spread", lambda df: asked.append(True) or df)
    small(base, 2020, "RAIS_VINC_ID_SUL.txt", ["430543;1;30", "420543;2;40", "430543;3;50"])
    assert load(spark, str(base), store).total_rows == 3 and not asked
    assert load(spark, str(base), store, force=True, shape="spread").total_rows == 3 and asked
    assert pairs(spark, store) == [("1", 30), ("2", 40), ("3", 50)] and len(folders(store)) == 2
