"""The two canonical datasets: columns, types and the headers each column has been published under."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

SPARK_TYPES = {
    "str": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
}

@dataclass(frozen=True)
class Field:
    name: str
    dtype: str
    aliases: tuple[str, ...]
    optional: bool = False

    @property
    def spark_type(self) -> T.DataType:
        return SPARK_TYPES[self.dtype]


@dataclass(frozen=True)
class Dataset:
    name: str
    fields: tuple[Field, ...]

    @property
    def columns(self) -> list[str]:
        """Public output columns: the year, the canonical columns, the state."""
        return ["ano", *(f.name for f in self.fields), "uf"]

    @property
    def struct(self) -> T.StructType:
        inner = [
            T.StructField(f.name, f.spark_type, True, {"aliases": list(f.aliases), "optional": f.optional})
            for f in self.fields
        ]
        return T.StructType(
            [T.StructField("ano", T.IntegerType()), *inner, T.StructField("uf", T.StringType())]
        )

    def field(self, header: str) -> Field | None:
        """The canonical column a source header stands for (surrounding blanks ignored), if any."""
        wanted = header.strip()
        return next((f for f in self.fields if wanted in f.aliases), None)

    def positions(self, headers: list[str]) -> dict[str, int | None]:
        """Where each canonical column sits in a file: its oldest header wins, then the first occurrence."""
        trimmed = [h.strip() for h in headers]
        return {
            f.name: next((trimmed.index(a) for a in f.aliases if a in trimmed), None)
            for f in self.fields
        }


# One line per output column, in output order: canonical name, type, first published header and, where it
# changed, the header since 2024. Some years do not have optional columns.
JOB_LINKS = (
    Field("pis", "str", ("PIS",)),
    Field("cpf", "str", ("CPF",)),
    Field("nome_trabalhador", "str", ("Nome Trabalhador",)),
    Field("data_nascimento", "date", ("Data de Nascimento", "Data Nascimento")),
    Field("cnpj_cei", "str", ("CNPJ / CEI",)),
    Field("cnpj_raiz", "str", ("CNPJ Raiz",)),
    Field("cei_vinculado", "str", ("CEI Vinculado",)),
    Field("razao_social", "str", ("Razão Social",), optional=True),
    Field("sexo", "str", ("Sexo Trabalhador", "Sexo - Código")),
    Field("idade", "int", ("Idade",)),
    Field("raca_cor", "str", ("Raça Cor", "Raça Cor - Código")),
    Field("nacionalidade", "str", ("Nacionalidade", "Nacionalidade - Código")),
    Field("escolaridade", "str", ("Escolaridade após 2005", "Escolaridade Após 2005 - Código")),
    Field("ind_portador_defic", "str", ("Ind Portador Defic", "Ind Portador Defic - Código")),
    Field("tipo_defic", "str", ("Tipo Defic", "Tipo Deficiência - Código")),
    Field("vinculo_ativo_3112", "str", ("Vínculo Ativo 31/12", "Ind Vínculo Ativo 31/12 - Código")),
    Field("tipo_vinculo", "str", ("Tipo Vínculo", "Tipo Vínculo - Código")),
    Field("tipo_admissao", "str", ("Tipo Admissão", "Tipo Admissão Trabalhador - Código")),
    Field("data_admissao", "date", ("Data Admissão Declarada", "Data Admissão")),
    Field("tempo_emprego", "double", ("Tempo Emprego",)),
    Field("motivo_desligamento", "str", ("Motivo Desligamento", "Motivo Desligamento - Código")),
    Field("mes_desligamento", "str", ("Mês Desligamento", "Mês Desligamento - Código")),
    Field("dia_desligamento", "str", ("Dia de Desligamento", "Dia Desligamento - Código")),
    Field("qtd_hora_contr", "int", ("Qtd Hora Contr",)),
    Field("cbo_2002", "str", ("CBO Ocupação 2002", "CBO 2002 Ocupação - Código")),
    Field("municipio", "str", ("Município", "Município - Código")),
    Field("natureza_juridica", "str", ("Natureza Jurídica", "Natureza Jurídica - Código")),
    Field("tamanho_estab", "str", ("Tamanho Estabelecimento", "Tamanho Estabelecimento - Código")),
    Field("tipo_estab", "str", ("Tipo Estab", "Tipo Estabelecimento - Código")),
    Field("cnae20_classe", "str", ("CNAE 2.0 Classe", "CNAE 2.0 Classe - Código")),
    Field("cnae20_subclasse", "str", ("CNAE 2.0 Subclasse", "CNAE 2.0 Subclasse - Codigo")),
    Field("vl_remun_media_nom", "double", ("Vl Remun Média Nom", "Vl Rem Média Nom")),
    Field("vl_salario_contratual", "double", ("Vl Salário Contratual",)),
    Field("vl_ultima_remun_ano", "double", ("Vl Última Remuneração Ano", "Vl Últ Rem Ano")),
    Field("causa_afast_1", "str", ("Causa Afastamento 1", "Causa Afastamento 1 - Código")),
    Field("dia_ini_af1", "str", ("Dia Ini AF1", "Dia Início Afastamento 1 - Código")),
    Field("mes_ini_af1", "str", ("Mês Ini AF1", "Mês Início Afastamento 1 - Código")),
    Field("dia_fim_af1", "str", ("Dia Fim AF1", "Dia Fim Afastamento 1 - Código")),
    Field("mes_fim_af1", "str", ("Mês Fim AF1", "Mês Fim Afastamento 1 - Código")),
    Field("causa_afast_2", "str", ("Causa Afastamento 2", "Causa Afastamento 2 - Código")),
    Field("dia_ini_af2", "str", ("Dia Ini AF2", "Dia Início Afastamento 2 - Código")),
    Field("mes_ini_af2", "str", ("Mês Ini AF2", "Mês Início Afastamento 2 - Código")),
    Field("dia_fim_af2", "str", ("Dia Fim AF2", "Dia Fim Afastamento 2 - Código")),
    Field("mes_fim_af2", "str", ("Mês Fim AF2", "Mês Fim Afastamento 2 - Código")),
    Field("causa_afast_3", "str", ("Causa Afastamento 3", "Causa Afastamento 3 - Código")),
    Field("dia_ini_af3", "str", ("Dia Ini AF3", "Dia Início Afastamento 3 - Código")),
    Field("mes_ini_af3", "str", ("Mês Ini AF3", "Mês Início Afastamento 3 - Código")),
    Field("dia_fim_af3", "str", ("Dia Fim AF3", "Dia Fim Afastamento 3 - Código")),
    Field("mes_fim_af3", "str", ("Mês Fim AF3", "Mês Fim Afastamento 3 - Código")),
    Field("qtd_dias_afast", "int", ("Qtd Dias Afastamento",)),
)

ESTABLISHMENTS = (
    Field("cnpj_cei", "str", ("CNPJ / CEI",)),
    Field("cnpj_raiz", "str", ("CNPJ Raiz",)),
    Field("cei_vinculado", "str", ("CEI Vinculado",)),
    Field("razao_social", "str", ("Razão Social",)),
    Field("municipio", "str", ("Município", "Município - Código")),
    Field("cep_estab", "str", ("CEP Estab",)),
    Field("nome_logradouro", "str", ("Nome Logradouro", "Logradouro do Estab")),
    Field("numero_logradouro", "int", ("Número Logradouro", "Num Logradouro")),
    Field("nome_bairro", "str", ("Nome Bairro", "Bairros - Nome")),
    Field("cnae20_classe", "str", ("CNAE 2.0 Classe", "CNAE 2.0 Classe - Código")),
    Field("cnae20_subclasse", "str", ("CNAE 2.0 Subclasse", "CNAE 2.0 Subclasse - Codigo")),
    Field("ibge_subsetor", "str", ("IBGE Subsetor", "IBGE Subsetor - Código")),
    Field("natureza_juridica", "str", ("Natureza Jurídica", "Natureza Jurídica - Código")),
    Field("tamanho_estab", "str", ("Tamanho Estabelecimento", "Tamanho Estabelecimento - Código")),
    Field("tipo_estab", "str", ("Tipo Estab", "Tipo Estabelecimento - Código")),
    Field("data_abertura", "date", ("Data Abertura",)),
    Field("data_baixa", "date", ("Data Baixa",)),
    Field("data_encerramento", "date", ("Data Encerramento",)),
    Field("ind_rais_negativa", "str", ("Ind Rais Negativa", "Ind RAIS Negativa - Código")),
    Field("qtd_vinculos_ativos", "int", ("Qtd Vínculos Ativos",)),
    Field("qtd_vinculos_clt", "int", ("Qtd Vínculos CLT",)),
    Field("qtd_vinculos_estat", "int", ("Qtd Vínculos Estatutários",)),
    Field("ind_simples", "str", ("Ind Simples", "Ind Estab Participante SIMPLES - Código")),
)
# End of the fixed values.

DATASETS = {
    "vinculos": Dataset("vinculos", JOB_LINKS),
    "estabelecimentos": Dataset("estabelecimentos", ESTABLISHMENTS),
}


def dataset(name: str) -> Dataset:
    try:
        return DATASETS[name]
    except KeyError:
        raise ValueError(f"unknown dataset {name!r}; expected one of {sorted(DATASETS)}") from None
