from pathlib import Path

import pytest
from registry_files import HISTORIC, NEW, job_link_file, put, quote

from laborlake.sources.files import discover, filter_files
from laborlake.sources.headers import describe_headers, with_headers


@pytest.fixture()
def tree(tmp_path: Path) -> Path:
    for name in ("Estb2014ID.txt", "Estb2022ID.txt"):
        put(tmp_path / "RAIS Estabelecimentos" / name, ["header"])
    for year in (2014, 2015):
        for state in ("AC", "SP"):
            put(job_link_file(tmp_path, year, f"{state}{year}ID.txt"), ["header"])
    for region in ("NORTE", "SUL", "SP"):
        put(job_link_file(tmp_path, 2018, f"RAIS_VINC_ID_{region}.txt"), ["header"])
    put(job_link_file(tmp_path, 2014, "layout.xls"), ["header"])
    return tmp_path


def test_published_tree(spark, tree):
    files = discover(spark, str(tree)).collect()
    estabs = [f for f in files if f.dataset == "estabelecimentos"]
    links = [f for f in files if f.dataset == "vinculos"]
    assert {f.ano for f in estabs} == {2014, 2022} and all(f.uf_hint is None for f in estabs)
    assert len(links) == 7 and len({f.path for f in files}) == 9
    assert [(f.ano, f.filename, f.uf_hint) for f in links][:2] == [(2014, "AC2014ID.txt", "AC"), (2014, "SP2014ID.txt", "SP")]
    assert {f.uf_hint for f in links if f.ano == 2018} == {None}
    assert all(f.size_bytes == 7 for f in files)


def test_unusual_places_and_names(spark, tmp_path):
    put(job_link_file(tmp_path, 2024, "a/b/sp2023id.COMT"), ["x"])
    put(tmp_path / "RAIS Vínculos" / "rais   2025" / "rais_vinc_id_x [1] + %20.TXT", ["x"])
    put(job_link_file(tmp_path, 2024, "EMPTY.txt"), [])
    put(job_link_file(tmp_path, 2024, "AC2024ID.txt"), [])
    put(tmp_path / "RAIS Vínculos" / "Outros 2024" / "AC2024ID.txt", ["x"])
    put(tmp_path / "RAIS Vínculos" / "AC2024ID.txt", ["x"])
    put(tmp_path / "RAIS Estabelecimentos" / "antigos" / "Estb2014ID.txt", ["x"])
    put(tmp_path / "RAIS Estabelecimentos" / "estb2025id.comt", ["x"])
    found = [(f.dataset, f.ano, f.filename, f.uf_hint, f.size_bytes) for f in discover(spark, str(tmp_path)).collect()]
    assert found == [
        ("estabelecimentos", 2025, "estb2025id.comt", None, 2),
        ("vinculos", 2024, "AC2024ID.txt", "AC", 0),
        ("vinculos", 2024, "sp2023id.COMT", "SP", 2),
        ("vinculos", 2025, "rais_vinc_id_x [1] + %20.TXT", None, 2),
    ]


def test_compressed_files_go_by_the_names_of_the_files_in_them(spark, tmp_path):
    put(job_link_file(tmp_path, 2014, "sp2014id.TXT.gz"), [";".join(HISTORIC), "1;2"])
    put(job_link_file(tmp_path, 2014, "RAIS_VINC_ID_SUL.comt.gz"), [quote(NEW), '"a', 'b"'])
    put(job_link_file(tmp_path, 2014, "layout.gz"), ["x"])
    files = discover(spark, str(tmp_path))
    assert [(f.ano, f.filename, f.uf_hint) for f in files.collect()] == [(2014, "RAIS_VINC_ID_SUL.comt", None), (2014, "sp2014id.TXT", "SP")]
    rows = {r.filename: (r.sep, r.headers, r.odd) for r in with_headers(files, odd=True).collect()}
    assert rows == {"sp2014id.TXT": (";", HISTORIC, False), "RAIS_VINC_ID_SUL.comt": (",", NEW, True)}


def test_missing_folders_are_no_error(spark, tmp_path):
    assert discover(spark, str(tmp_path)).columns == ["dataset", "ano", "filename", "path", "size_bytes", "uf_hint"]
    assert discover(spark, str(tmp_path / "nowhere")).count() == 0


def test_filters(spark, tree):
    files = discover(spark, str(tree))
    assert filter_files(files, dataset="estabelecimentos").count() == 2
    assert filter_files(files, year=2014).count() == 3
    assert filter_files(files, state="sp").count() == 2
    assert filter_files(files, "vinculos", 2014, "AC").count() == 1
    assert filter_files(files).count() == 9


def test_first_lines(spark, tmp_path):
    old = put(job_link_file(tmp_path, 2014, "AC2014ID.txt"), [";".join(HISTORIC), *["1;2"] * 50_000])
    new = put(job_link_file(tmp_path, 2024, "RAIS_VINC_ID_SUL [1] + %.txt"), [quote(NEW), "x"])
    gone = f"file:{tmp_path}/gone.txt"
    paths = spark.createDataFrame([(f"file:{old}", 9), (f"file:{new}", 9), (gone, 9)], "path string, size_bytes bigint")
    rows = {r.path: r for r in with_headers(paths).collect()}
    assert rows[f"file:{old}"].sep == ";" and rows[f"file:{old}"].headers == HISTORIC
    assert rows[f"file:{new}"].sep == "," and rows[f"file:{new}"].headers == NEW
    assert rows[gone].headers == [] and "FileNotFound" in rows[gone].error and rows[f"file:{old}"].error is None


def bytes_read(spark) -> dict[int, int]:
    """What each Python worker has read so far."""

    def look(batches):
        import os

        import pandas as pd

        for _ in batches:
            pass
        with open("/proc/self/io") as f:
            yield pd.DataFrame({"pid": [os.getpid()], "n": [int(f.readline().split()[1])]})

    found = spark.range(0, 64, 1, 64).mapInPandas(look, "pid long, n long").collect()
    return {r.pid: max(x.n for x in found if x.pid == r.pid) for r in found}


def test_first_lines_of_large_files_read_little(spark, tmp_path):
    names = [tmp_path / f"{i}.txt" for i in range(3)]
    for name in names:
        put(name, ["a;b"])
        with open(name, "ab") as f:
            f.truncate(200 << 20)
    paths = spark.createDataFrame([(f"file:{n}", 200 << 20) for n in names], "path string, size_bytes bigint")
    with_headers(paths).collect()  # imports
    before = bytes_read(spark)
    assert [r.headers for r in with_headers(paths).collect()] == [["a", "b"]] * 3
    after = bytes_read(spark)
    assert sum(n - before.get(pid, n) for pid, n in after.items()) < 3 << 20


def test_empty_files_have_no_headers(spark, tmp_path):
    put(job_link_file(tmp_path, 2014, "AC2014ID.txt"), [])
    assert with_headers(discover(spark, str(tmp_path))).first().headers == []


def test_header_tokens(spark):
    lines = {
        "a;b;c": ["a", "b", "c"],
        '"a","b, c","d ""e"""': ["a", "b, c", 'd "e"'],
        "one": ["one"],
        "a;;c": ["a", "", "c"],
        " a , b\r": [" a ", " b"],
        "": [],
    }
    df = describe_headers(spark.createDataFrame([(x,) for x in lines], "line string"))
    assert [r.headers for r in df.collect()] == list(lines.values())
