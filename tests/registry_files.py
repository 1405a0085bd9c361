"""Headers, rows and folders of small source files for the tests."""

from __future__ import annotations

import gzip
from pathlib import Path

HISTORIC = ["Município", "PIS", "Nome Trabalhador", "Data de Nascimento", "Data Admissão Declarada", "Idade",
            "Qtd Hora Contr", "Tempo Emprego", "Vl Remun Média Nom", "Vínculo Ativo 31/12", "CNAE 2.0 Subclasse",
            "CNAE 95 Classe"]
HISTORIC_ROW = ["120040", "11111111111", "PESSOA TESTE       ", "31051965", "02062014", "049", "44", "0005,9",
                "0000001125,29", " 0", "4313400", "45217"]
NEW = ["Município - Código", "PIS", "Nome Trabalhador", "Data Nascimento", "Data Admissão", "Idade",
       "Qtd Hora Contr", "Tempo Emprego", "Vl Rem Média Nom", "Ind Vínculo Ativo 31/12 - Código",
       "CNAE 2.0 Subclasse - Codigo", "Município Trab - Código"]
NEW_ROW = ["430543", "22222222222", "PESSOA TESTE", "31/05/1965", "02/06/2024", "049", "44", "5.9", "1125.29", "1",
           "4313400", "430543"]


def put(path: Path, lines: list[str]) -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    text = "".join(f"{line}\n" for line in lines).encode("latin-1")
    path.write_bytes(gzip.compress(text) if path.suffix == ".gz" else text)
    return path


def quote(values: list[str]) -> str:
    return ",".join(f'"{v}"' for v in values)


def job_link_file(base: Path, year: int, name: str) -> Path:
    return base / "RAIS Vínculos" / f"RAIS {year}" / name
