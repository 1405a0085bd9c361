from datetime import date

from registry_files import HISTORIC, HISTORIC_ROW, NEW, NEW_ROW

from laborlake.model import DATASETS
from laborlake.operators.canonical import canonicalize, canonicalize_named, conform

LINKS, ESTABS = DATASETS["vinculos"], DATASETS["estabelecimentos"]


def named(spark, headers, row):
    return spark.createDataFrame([tuple(row)], ", ".join(f"`{h}` string" for h in headers))


def test_historic_layout(spark):
    df = canonicalize_named(named(spark, HISTORIC, HISTORIC_ROW), LINKS, 2014)
    assert df.columns == LINKS.columns
    assert [f.dataType for f in df.schema] == [f.dataType for f in LINKS.struct]
    row = df.first()
    assert (row.ano, row.uf, row.municipio) == (2014, "12", "120040")
    assert row.nome_trabalhador == "PESSOA TESTE" and row.vinculo_ativo_3112 == "0"
    assert row.data_nascimento == date(1965, 5, 31) and row.data_admissao == date(2014, 6, 2)
    assert (row.idade, row.qtd_hora_contr, row.tempo_emprego, row.vl_remun_media_nom) == (49, 44, 5.9, 1125.29)
    assert row.razao_social is None and row.causa_afast_1 is None and row.qtd_dias_afast is None


def test_newer_layout(spark):
    row = canonicalize_named(named(spark, NEW, NEW_ROW), LINKS, 2024).first()
    assert (row.ano, row.uf, row.data_admissao) == (2024, "43", date(2024, 6, 2))
    assert (row.vl_remun_media_nom, row.vinculo_ativo_3112, row.cnae20_subclasse) == (1125.29, "1", "4313400")


def test_oldest_header_and_first_occurrence_win(spark):
    raw = spark.createDataFrame([("430543", "120040", "A", "B")], "_c0 string, _c1 string, _c2 string, _c3 string")
    row = canonicalize(raw, LINKS, ["Município - Código", " Município ", "PIS", "PIS"], 2020).first()
    assert (row.municipio, row.pis) == ("120040", "A")


def test_missing_text(spark):
    raw = spark.createDataFrame([("NA", "   ", "nan"), (None, "x\xa0", " NA ")], "_c0 string, _c1 string, _c2 string")
    rows = canonicalize(raw, LINKS, ["Município", "PIS", "CPF"], 2020).collect()
    assert [(r.municipio, r.uf, r.pis, r.cpf) for r in rows] == [(None, "00", "", None), (None, "00", "x", "NA")]


def test_nothing_known(spark):
    raw = spark.createDataFrame([("x",)], "_c0 string")
    row = canonicalize(raw, ESTABS, ["Outra"], 2020).first()
    assert row.uf == "00" and [v for v in row[1:-1] if v is not None] == []


def test_establishments(spark):
    raw = {"Município - Código": "355030", "Num Logradouro": "3.92", "Data Abertura": "01/02/2003",
           "Qtd Vínculos CLT": "000000007", "Bairros - Nome": " SÉ "}
    row = canonicalize_named(named(spark, raw, raw.values()), ESTABS, 2025).first()
    assert (row.uf, row.numero_logradouro, row.qtd_vinculos_clt, row.nome_bairro) == ("35", None, 7, "SÉ")
    assert row.data_abertura == date(2003, 2, 1)


def test_conform_fills_with_typed_nulls(spark):
    df = conform(spark.createDataFrame([(2020, "12")], "ano long, uf string"), LINKS)
    assert [f.dataType for f in df.schema] == [f.dataType for f in LINKS.struct]
    assert df.first().asDict() == {**dict.fromkeys(LINKS.columns), "ano": 2020, "uf": "12"}


def test_one_pass_in_the_engine(spark):
    raw = spark.createDataFrame([tuple(HISTORIC_ROW)], ", ".join(f"_c{i} string" for i in range(len(HISTORIC))))
    plan = canonicalize(raw, LINKS, HISTORIC, 2014)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
