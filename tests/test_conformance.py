from registry_files import HISTORIC, job_link_file, put, quote

from laborlake.model import DATASETS
from laborlake.operators.canonical import resolve_aliases
from laborlake.operators.conformance import check_headers, verdict_counts, verdicts
from laborlake.plans.verify import verify

LINKS = DATASETS["vinculos"]
FULL_2014 = [f.aliases[0] for f in LINKS.fields if not f.optional] + ["CNAE 95 Classe", "Número CTPS"]
FULL_2018 = [*FULL_2014, "Razão Social", "Vl Rem Janeiro CC"]
FULL_2024 = [f.aliases[-1] for f in LINKS.fields]


def files(spark, *headers, dataset="vinculos"):
    return spark.createDataFrame(
        [(i, dataset, h) for i, h in enumerate(headers)], "id int, dataset string, headers array<string>"
    )


def test_reports(spark):
    rows = check_headers(files(spark, FULL_2014, FULL_2018, FULL_2024, ["CPF", " Município "])).orderBy("id").collect()
    assert rows[0].missing_optional == ["Razão Social"] and rows[0].is_ok
    assert rows[0].unknown == ["CNAE 95 Classe", "Número CTPS"]
    assert rows[1].missing_optional == [] and "Vl Rem Janeiro CC" in rows[1].unknown
    assert rows[2].missing_required == [] and rows[2].unknown == []
    assert not rows[3].is_ok and "PIS" in rows[3].missing_required and len(rows[3].missing_required) == 47
    assert "Município" not in rows[3].missing_required


def test_unknown_keeps_order_and_repetitions(spark):
    row = check_headers(files(spark, ["Z", "PIS", "A", " Z "]), LINKS).first()
    assert row.unknown == ["Z", "A", "Z"]


def test_verdicts(spark):
    odd = [f"Nova {i}" for i in range(12)]
    judged = verdicts(check_headers(files(spark, FULL_2014, FULL_2018, [*FULL_2024, *odd], ["PIS"], [])))
    rows = judged.orderBy("id").collect()
    assert [r.verdict for r in rows] == ["AVISO", "OK", "OK", "ERRO", "ERRO"]
    assert rows[0].new_columns == [] and rows[1].new_columns == ["Vl Rem Janeiro CC"]
    assert rows[2].new_columns == odd and rows[2].shown_columns == odd[:10] and rows[2].n_columns == 62
    assert {r.verdict: r.files for r in verdict_counts(judged).collect()} == {"AVISO": 1, "OK": 2, "ERRO": 2}


def test_establishments_have_no_optional_column(spark):
    every = [f.aliases[0] for f in DATASETS["estabelecimentos"].fields]
    row = check_headers(files(spark, every[:-1], dataset="estabelecimentos")).first()
    assert row.missing_required == ["Ind Simples"] and row.missing_optional == []


def test_aliases_as_rows(spark):
    rows = resolve_aliases(files(spark, HISTORIC), LINKS).collect()
    assert len(rows) == 11
    assert {(r.name, r.alias, r.position) for r in rows} >= {("municipio", "Município", 0), ("idade", "Idade", 5)}


def test_files_on_disk(spark, tmp_path):
    put(job_link_file(tmp_path, 2014, "AC2014ID.txt"), [";".join(FULL_2014), "x"])
    put(job_link_file(tmp_path, 2014, "SP2014ID.txt"), [])
    put(job_link_file(tmp_path, 2024, "RAIS_VINC_ID_SUL.txt"), [quote(FULL_2024), "x"])
    report = verify(spark, str(tmp_path))
    assert [(r.filename, r.verdict, r.n_columns) for r in report.collect()] == [
        ("AC2014ID.txt", "AVISO", 51), ("SP2014ID.txt", "ERRO", 0), ("RAIS_VINC_ID_SUL.txt", "OK", 50),
    ]
    assert verdict_counts(report).count() == 3
    assert verify(spark, str(tmp_path), year=2014, state="ac").count() == 1
