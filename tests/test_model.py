import pytest

from laborlake.model import DATASETS, dataset

LINKS, ESTABS = DATASETS["vinculos"], DATASETS["estabelecimentos"]


def by_type(d):
    return {t: [f.name for f in d.fields if f.dtype == t] for t in ("str", "int", "double", "date")}


def test_column_counts_and_types():
    links, estabs = by_type(LINKS), by_type(ESTABS)
    assert {t: len(n) for t, n in links.items()} == {"str": 41, "int": 3, "double": 4, "date": 2}
    assert {t: len(n) for t, n in estabs.items()} == {"str": 16, "int": 4, "double": 0, "date": 3}
    assert links["int"] == ["idade", "qtd_hora_contr", "qtd_dias_afast"]


def test_alias_counts():
    assert sum(len(f.aliases) for f in LINKS.fields) == 50 + 38
    assert sum(len(f.aliases) for f in ESTABS.fields) == 23 + 12
    for d in DATASETS.values():
        every = [a for f in d.fields for a in f.aliases]
        assert len(every) == len(set(every))


def test_only_the_company_name_of_job_links_is_optional():
    assert [f.name for f in LINKS.fields if f.optional] == ["razao_social"]
    assert not any(f.optional for f in ESTABS.fields)


def test_output_order_and_width():
    assert LINKS.columns[0] == "ano" and LINKS.columns[-1] == "uf"
    assert len(LINKS.columns) == len(set(LINKS.columns)) == 52
    assert len(ESTABS.columns) == 25
    assert LINKS.struct.names == LINKS.columns
    assert LINKS.struct["cpf"].metadata == {"aliases": ["CPF"], "optional": False}


def test_headers_resolve_with_blanks_around():
    assert LINKS.field("  Município ").name == "municipio"
    assert LINKS.field("CNAE 2.0 Subclasse - Codigo").name == "cnae20_subclasse"
    assert ESTABS.field("Num Logradouro").name == "numero_logradouro"
    for dropped in ("Vl Rem Janeiro CC", "Ind Trab Intermitente", "Ind Simples"):
        assert LINKS.field(dropped) is None


def test_first_known_header_then_first_occurrence_wins():
    where = LINKS.positions(["Município - Código", " Município ", "Município", "PIS", "PIS"])
    assert where["municipio"] == 1 and where["pis"] == 3 and where["cpf"] is None


def test_unknown_dataset():
    with pytest.raises(ValueError, match="unknown dataset"):
        dataset("outros")
