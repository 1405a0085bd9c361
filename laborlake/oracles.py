"""The expected result of each query as plain SQL over the sales tables, stating the rules on their own."""

from __future__ import annotations

from laborlake.model import DATASETS


def text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def texts(items: list[str]) -> str:
    return "[" + ", ".join(map(text, items)) + "]"


MUNICIPALITY = "lpad(CAST((11 + l_suppkey % 8) * 10000 + l_linenumber * 37 AS VARCHAR), 6, '0')"

# Raw text of the columns with rules, then the rules.
RAW = f"""
raw AS (
  SELECT *,
    CASE WHEN l_orderkey % 11 = 0 THEN '000000' WHEN l_orderkey % 13 = 0 THEN ''
         WHEN l_orderkey % 17 = 0 THEN '  ' || {MUNICIPALITY} || '  ' ELSE {MUNICIPALITY} END AS raw_place,
    CASE WHEN l_orderkey % 10 = 0 THEN '00000000' WHEN l_orderkey % 19 = 0 THEN '99999999'
         WHEN l_orderkey % 2 = 0 THEN strftime(l_shipdate, '%d%m%Y')
         ELSE strftime(l_shipdate, '%d/%m/%Y') END AS raw_hired,
    CASE WHEN l_orderkey % 29 = 0 THEN '3.92' WHEN l_orderkey % 31 = 0 THEN '9.5e108'
         WHEN l_orderkey % 37 = 0 THEN '-99999999999'
         ELSE lpad(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 3, '0') END AS raw_hours,
    CASE WHEN l_orderkey % 23 = 0 THEN ''
         ELSE lpad(replace(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR), '.', ','), 13, '0') END AS raw_pay
  FROM lineitem
),
ruled AS (
  SELECT *,
    CAST(year(l_shipdate) AS INTEGER) AS ano,
    nullif(trim(raw_place), '') AS municipio,
    CASE WHEN length(trim(raw_place)) < 2 OR regexp_full_match(trim(raw_place), '0*') THEN '00'
         ELSE substr(trim(raw_place), 1, 2) END AS uf,
    CAST(CAST(coalesce(try_strptime(raw_hired, '%d%m%Y'), try_strptime(raw_hired, '%d/%m/%Y')) AS DATE) AS VARCHAR)
      AS data_admissao,
    CASE WHEN try_cast(raw_hours AS DOUBLE) BETWEEN -2147483648 AND 2147483647
          AND try_cast(raw_hours AS DOUBLE) = round(try_cast(raw_hours AS DOUBLE))
         THEN CAST(try_cast(raw_hours AS DOUBLE) AS INTEGER) END AS qtd_hora_contr,
    try_cast(replace(raw_pay, ',', '.') AS DOUBLE) AS vl_remun_media_nom,
    CASE WHEN l_returnflag = 'N' THEN '1' ELSE '0' END AS vinculo_ativo_3112,
    lpad(CAST(l_partkey % 100 AS VARCHAR), 2, '0') || '13400' AS cnae20_subclasse,
    lpad(CAST(l_orderkey AS VARCHAR), 11, '0') AS pis
  FROM raw
)"""


MEAN_PAY = "round(avg(vl_remun_media_nom), 2)"


def company(key: str) -> str:
    return f"""CASE {key} % 4 WHEN 0 THEN 'BAR "DO ZÉ" LTDA ' || {key} WHEN 1 THEN '"' || {key} || '", S/A'
    WHEN 2 THEN 'EMPRESA ' || {key} || ' \\' ELSE 'EMPRESA ' || {key} || ', LTDA' END"""


def links(new: str, breaks: bool = False) -> str:
    """All shown columns; ``new`` is the condition under which a row is in the newer layout, ``breaks`` puts some names on two lines."""
    name = company("l_suppkey")
    if breaks:
        name = f"CASE WHEN l_orderkey % 41 = 0 THEN concat('EMPRESA', chr(10), l_suppkey, chr(10), 'FILIAL') ELSE {name} END"
    return f"""
SELECT ano, uf, pis, 'PESSOA JOSÉ ' || CAST(l_orderkey AS VARCHAR) AS nome_trabalhador,
  CASE WHEN {new} THEN {name} END AS razao_social,
  municipio, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS data_nascimento, data_admissao,
  CAST(18 + l_orderkey % 50 AS INTEGER) AS idade, qtd_hora_contr, CAST(l_linenumber AS INTEGER) AS qtd_dias_afast,
  CAST(CAST(l_quantity AS DECIMAL(6,1)) AS DOUBLE) AS tempo_emprego, vl_remun_media_nom,
  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS vl_salario_contratual,
  CAST(CAST(l_quantity AS DECIMAL(12,2)) AS DOUBLE) AS vl_ultima_remun_ano,
  vinculo_ativo_3112, cnae20_subclasse,
  lpad(CAST((l_orderkey + CASE WHEN {new} THEN 48 ELSE 47 END) % 97 AS VARCHAR), 2, '0') AS mes_fim_af3
FROM ruled"""


# The sectors as published, not as the library holds them.
SECTOR = """CASE
    WHEN cnae20_subclasse[1:2] BETWEEN '01' AND '03' THEN 'Agropecuaria'
    WHEN cnae20_subclasse[1:2] BETWEEN '05' AND '09' THEN 'Ind. Extrativa'
    WHEN cnae20_subclasse[1:2] BETWEEN '10' AND '33' THEN 'Ind. Transformacao'
    WHEN cnae20_subclasse[1:2] BETWEEN '35' AND '39' THEN 'Energia/Saneamento'
    WHEN cnae20_subclasse[1:2] BETWEEN '41' AND '43' THEN 'Construcao'
    WHEN cnae20_subclasse[1:2] BETWEEN '45' AND '47' THEN 'Comercio'
    WHEN cnae20_subclasse[1:2] BETWEEN '49' AND '53' THEN 'Transporte'
    WHEN cnae20_subclasse[1:2] BETWEEN '55' AND '56' THEN 'Alojamento/Alimentacao'
    WHEN cnae20_subclasse[1:2] BETWEEN '58' AND '63' THEN 'Info/Comunicacao'
    WHEN cnae20_subclasse[1:2] BETWEEN '64' AND '66' THEN 'Financeiro'
    WHEN cnae20_subclasse[1:2] = '68' THEN 'Imobiliario'
    WHEN cnae20_subclasse[1:2] BETWEEN '69' AND '75' THEN 'Prof/Tecnico/Cientifico'
    WHEN cnae20_subclasse[1:2] BETWEEN '77' AND '82' THEN 'Adm. e Servicos'
    WHEN cnae20_subclasse[1:2] = '84' THEN 'Adm. Publica'
    WHEN cnae20_subclasse[1:2] = '85' THEN 'Educacao'
    WHEN cnae20_subclasse[1:2] BETWEEN '86' AND '88' THEN 'Saude'
    WHEN cnae20_subclasse[1:2] BETWEEN '90' AND '93' THEN 'Arte/Cultura/Esporte'
    WHEN cnae20_subclasse[1:2] BETWEEN '94' AND '96' THEN 'Outros Servicos'
    ELSE 'Outros' END"""


def sectors(where: str = "true") -> str:
    return f"""
SELECT ano, {SECTOR} AS setor, count(*) AS vinculos,
  CAST(sum(CASE WHEN vinculo_ativo_3112 = '1' THEN 1 ELSE 0 END) AS BIGINT) AS ativos_31dez,
  {MEAN_PAY} AS remun_media
FROM ruled WHERE {where} GROUP BY ALL"""


def with_ruled(query: str) -> str:
    return f"WITH {RAW.strip()}\n{query.strip()}"


def _columns(dataset: str, new: bool) -> str:
    return texts([f.aliases[-1 if new else 0] for f in DATASETS[dataset].fields])


# One header per order, then its trimmed names.
HEADERS = f"""
heads AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN 'vinculos' ELSE 'estabelecimentos' END AS dataset,
    CASE WHEN o_orderkey % 2 = 1 THEN ',' ELSE ';' END AS sep,
    list_concat(
      list_transform(
        list_filter(
          CASE o_orderkey % 4 WHEN 0 THEN {_columns('vinculos', False)} WHEN 1 THEN {_columns('vinculos', True)}
               WHEN 2 THEN {_columns('estabelecimentos', False)} ELSE {_columns('estabelecimentos', True)} END,
          lambda h, i: i - 1 <> o_orderkey % 70),
        lambda h: CASE WHEN o_orderkey % 5 = 0 THEN ' ' || h || ' ' ELSE h END),
      CASE WHEN o_orderkey % 3 = 0 THEN ['CNAE 95 Classe', 'Coluna Nova', 'Coluna Nova']
        WHEN o_orderkey % 7 = 0 THEN list_transform(generate_series(1, 14), lambda i: 'Coluna ' || i)
        ELSE CAST([] AS VARCHAR[]) END
    ) AS headers
  FROM orders
),
trimmed AS (SELECT *, list_transform(headers, lambda h: trim(h)) AS h FROM heads)"""


def _aliases(dataset: str, optional: bool) -> str:
    lists = [texts(list(f.aliases)) for f in DATASETS[dataset].fields if f.optional == optional]
    return f"[{', '.join(lists)}]" if lists else "CAST([] AS VARCHAR[][])"


def _per_dataset(make) -> str:
    return f"CASE dataset WHEN 'vinculos' THEN {make('vinculos')} ELSE {make('estabelecimentos')} END"


def _missing(optional: bool) -> str:
    lists = _per_dataset(lambda d: _aliases(d, optional))
    return f"list_transform(list_filter({lists}, lambda c: NOT list_has_any(c, h)), lambda c: c[1])"


_KNOWN = _per_dataset(lambda d: texts([a for f in DATASETS[d].fields for a in f.aliases]))

CHECKED = f"""{HEADERS},
checked AS (
  SELECT *, {_missing(False)} AS missing_required, {_missing(True)} AS missing_optional,
    list_filter(h, lambda x: NOT list_contains({_KNOWN}, x)) AS unknown
  FROM trimmed
),
judged AS (
  SELECT *, CASE WHEN len(missing_required) > 0 THEN 'ERRO' WHEN len(missing_optional) > 0 THEN 'AVISO' ELSE 'OK' END
    AS verdict
  FROM checked
)"""

# Columns that are known to be dropped, as published.
LEGACY = """['CNAE 95 Classe', 'CBO 94 Ocupação', 'Número CTPS', 'PIS', 'Vl Remun Média (SM)', 'Vl Remun Dezembro Nom',
  'Vl Remun Dezembro (SM)', 'Ind Vínculo Alvará', 'Tipo Salário', 'Ind CEI Vinculado', 'Ind Estab Participa PAT',
  'Ind Atividade Ano']"""

_ALIAS_ROWS = ", ".join(
    f"({text(d.name)}, {text(f.name)}, {texts(list(f.aliases))})" for d in DATASETS.values() for f in d.fields
)

ALIAS_RESOLVE = f"""
WITH {HEADERS.strip()},
cols AS (SELECT * FROM (VALUES {_ALIAS_ROWS}) AS t(dataset, name, aliases)),
found AS (
  SELECT o_orderkey, name, h, list_filter(aliases, lambda a: list_contains(h, a))[1] AS alias
  FROM trimmed JOIN cols USING (dataset)
)
SELECT o_orderkey, name, alias, CAST(list_position(h, alias) - 1 AS INTEGER) AS position
FROM found WHERE alias IS NOT NULL"""

LISTING = """
listing AS (
  SELECT o_orderkey, CAST(1995 + o_orderkey % 8 AS INTEGER) AS y, o_orderkey % 9 AS kind,
    (['AC', 'sp', 'Rj', 'RS'])[1 + o_custkey % 4] AS state,
    (['NORTE', 'SUL', 'SP'])[1 + o_custkey % 3] AS region,
    CAST(o_custkey * 1000 AS BIGINT) AS size_bytes
  FROM orders
),
found AS (
  SELECT o_orderkey, CASE WHEN kind < 3 THEN 'vinculos' ELSE 'estabelecimentos' END AS dataset, y AS ano,
    CASE kind WHEN 0 THEN state || y || 'ID.txt' WHEN 1 THEN state || '2014id.TXT'
      WHEN 2 THEN 'RAIS_VINC_ID_' || region || '_' || o_orderkey || '.COMT'
      WHEN 3 THEN 'Estb' || y || 'ID.txt' ELSE 'estb' || y || 'id.comt' END AS filename,
    CASE WHEN kind < 2 THEN upper(state) END AS uf_hint, size_bytes
  FROM listing WHERE kind IN (0, 1, 2, 3, 8)
)"""


def entries(removals: bool) -> str:
    deleted = "o_orderkey % 5 = 0" if removals else "false"
    return f"""
entries AS (
  SELECT CASE WHEN o_custkey % 3 = 0 THEN 'estabelecimentos' ELSE 'vinculos' END AS dataset,
    CAST(year(o_orderdate) AS INTEGER) AS ano, 'F' || o_custkey || '.txt' AS filename,
    CAST(floor(o_totalprice) AS BIGINT) AS rows, CAST(o_orderkey * 10 AS BIGINT) AS size_bytes,
    o_orderkey, {deleted} AS deleted
  FROM orders
),
live AS (
  SELECT dataset, ano, filename, rows, size_bytes, o_orderkey FROM entries
  QUALIFY row_number() OVER (PARTITION BY dataset, ano, filename ORDER BY o_orderkey DESC) = 1 AND NOT deleted
)"""


FILES_OF_CUSTOMERS = """
files AS (
  SELECT CASE WHEN c_custkey % 3 = 0 THEN 'estabelecimentos' ELSE 'vinculos' END AS dataset,
    CAST(unnest([1995, 1996, 1997, 1998]) AS INTEGER) AS ano, 'F' || c_custkey || '.txt' AS filename
  FROM customer
)"""

_SAME_FILE = "l.dataset = f.dataset AND l.ano = f.ano AND l.filename = f.filename"

_TOTALS = """count(*) AS files, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(size_bytes) AS BIGINT) AS size_bytes,
  round(CAST(sum(size_bytes) AS DOUBLE) / 1e9, 1) AS source_gb"""

_PER_YEAR = """
SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, count(*) AS stored_rows, count(*) AS listed_rows, CAST(1 AS BIGINT) AS loads
FROM lineitem GROUP BY ALL"""

_LONG = "l_orderkey % 10 < ([0, 3, 6, 10])[1 + year(l_shipdate) % 4]"

NA = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null", " NA", "NaN ", "nil", "N/a", "-", "0",
]

# Canonical columns of an establishment that canonical_schema fills, and what it fills them with.
_FILLED = {"ano": "o_orderdate", "cnpj_cei": "o_orderkey", "qtd_vinculos_ativos": "o_custkey"}
_TYPES = {"str": "string", "int": "int", "double": "double", "date": "date"}


def _canonical_schema() -> str:
    columns = [("ano", "int")] + [(f.name, _TYPES[f.dtype]) for f in DATASETS["estabelecimentos"].fields]
    rows = [
        f"SELECT o_orderstatus AS uf, {i} AS position, '{name}' AS name, '{dtype}' AS type, "
        f"count({_FILLED.get(name, 'NULL')}) AS filled FROM orders GROUP BY ALL"
        for i, (name, dtype) in enumerate(columns)
    ]
    return "\nUNION ALL ".join(rows)


def oracles() -> dict[str, str]:
    return {
        "cast_string": "SELECT c_custkey, c_name AS name FROM customer",
        "cast_int": with_ruled("SELECT l_orderkey, l_linenumber, qtd_hora_contr AS hours FROM ruled"),
        "cast_double": with_ruled("""
SELECT l_orderkey, l_linenumber, vl_remun_media_nom AS pay FROM ruled
UNION ALL SELECT l_orderkey, l_linenumber, vl_remun_media_nom AS pay FROM ruled"""),
        "cast_date": with_ruled("SELECT l_orderkey, l_linenumber, data_admissao AS hired FROM ruled"),
        "na_tokens": f"""
SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN event_type
  WHEN event_id % {len(NA)} < {len(NA) - 6} THEN NULL
  ELSE ({texts(NA)})[1 + event_id % {len(NA)}] END AS value FROM events""",
        "derive_state": with_ruled("SELECT l_orderkey, l_linenumber, uf FROM ruled"),
        "canonical_schema": _canonical_schema(),
        "canonicalize_mixed": with_ruled(links("l_returnflag = 'R'")),
        "header_sniff": f"""WITH {HEADERS.strip()}
SELECT o_orderkey, sep, CAST(len(headers) AS INTEGER) AS n_columns, array_to_string(headers, '|') AS names FROM heads""",
        "header_files_on_disk": """
SELECT DISTINCT true AS complete, CAST(year(l_shipdate) AS INTEGER) AS ano,
  CASE l_returnflag WHEN 'A' THEN 'NORTE' WHEN 'N' THEN 'SUL' ELSE 'SP' END AS region,
  CASE WHEN l_returnflag = 'R' THEN ',' ELSE ';' END AS sep, 52 AS n_columns,
  CASE WHEN l_returnflag = 'R' THEN 'Data Nascimento' ELSE 'Data de Nascimento' END AS fourth
FROM lineitem""",
        "verify_files": """
SELECT DISTINCT true AS complete, 'vinculos' AS dataset, CAST(year(l_shipdate) AS INTEGER) AS ano,
  CASE l_returnflag WHEN 'A' THEN 'NORTE' WHEN 'N' THEN 'SUL' ELSE 'SP' END AS region,
  CASE WHEN l_returnflag = 'R' THEN 'OK' ELSE 'AVISO' END AS verdict, 52 AS n_columns,
  CASE WHEN l_returnflag = 'R' THEN '' ELSE 'Razão Social' END AS missing_optional,
  CASE WHEN l_returnflag = 'R' THEN 'Município Trab - Código|Ano Chegada Brasil' ELSE '' END AS new_columns
FROM lineitem""",
        "alias_resolve": ALIAS_RESOLVE,
        "schema_check": f"""WITH {CHECKED.strip()}
SELECT o_orderkey, array_to_string(missing_required, '|') AS missing_required,
  array_to_string(missing_optional, '|') AS missing_optional, array_to_string(unknown, '|') AS unknown,
  len(missing_required) = 0 AS is_ok FROM judged""",
        "schema_verdict": f"""WITH {CHECKED.strip()}
SELECT o_orderkey, dataset, verdict, CAST(len(headers) AS INTEGER) AS n_columns,
  array_to_string(new, '|') AS new_columns, array_to_string(new[1:10], '|') AS shown_columns
FROM (SELECT *, list_filter(unknown, lambda x: NOT list_contains({LEGACY}, x)) AS new FROM judged)""",
        "schema_verdict_counts": f"WITH {CHECKED.strip()}\nSELECT verdict, count(*) AS files FROM judged GROUP BY ALL",
        "discover_files": f"WITH {LISTING.strip()}\nSELECT o_orderkey, dataset, ano, filename, uf_hint, size_bytes FROM found",
        "filter_files": f"""WITH {LISTING.strip()}
SELECT o_orderkey, ano, filename, uf_hint FROM found WHERE dataset = 'vinculos' AND ano = 1999 AND uf_hint = 'SP'""",
        "manifest_upsert": f"WITH {entries(False).strip()}\nSELECT dataset, ano, filename, rows, size_bytes, CAST(1577836800 + o_orderkey AS BIGINT) AS processed_at FROM live",
        "manifest_remove": f"""WITH {entries(True).strip()}
SELECT dataset, ano, filename, rows, size_bytes FROM live WHERE ano <> 1997""",
        "pending_files": f"""WITH {entries(True).strip()}, {FILES_OF_CUSTOMERS.strip()}
SELECT dataset, ano, filename FROM files f WHERE NOT EXISTS (SELECT 1 FROM live l WHERE {_SAME_FILE})""",
        "done_files": f"""WITH {entries(True).strip()}, {FILES_OF_CUSTOMERS.strip()}
SELECT dataset, ano, filename FROM files f WHERE EXISTS (SELECT 1 FROM live l WHERE {_SAME_FILE})""",
        "manifest_status": f"""WITH {entries(False).strip()}
SELECT dataset, ano, {_TOTALS} FROM live WHERE dataset = 'vinculos' GROUP BY dataset, ano""",
        "manifest_totals": f"""WITH {entries(False).strip()}
SELECT dataset, ano, {_TOTALS} FROM live GROUP BY GROUPING SETS ((dataset, ano), ())""",
        "ingest_historic": with_ruled(links("false")),
        "ingest_2024": with_ruled(links("true", breaks=True)),
        "ingest_establishments": f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS ano,
  CASE WHEN o_orderkey % 9 = 0 THEN '00' ELSE CAST(11 + o_custkey % 17 AS VARCHAR) END AS uf,
  lpad(CAST(o_orderkey AS VARCHAR), 14, '0') AS cnpj_cei, {company("o_custkey")} AS razao_social,
  CASE WHEN o_orderkey % 9 = 0 THEN '0'
    ELSE lpad(CAST((11 + o_custkey % 17) * 10000 + o_orderkey % 997 AS VARCHAR), 6, '0') END AS municipio,
  CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 4000 AS INTEGER) END AS numero_logradouro,
  'VILA SÃO ' || o_orderstatus AS nome_bairro,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS data_abertura, CAST(NULL AS VARCHAR) AS data_baixa,
  CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS data_encerramento,
  CAST(o_custkey % 500 AS INTEGER) AS qtd_vinculos_ativos, CAST(o_custkey % 300 AS INTEGER) AS qtd_vinculos_clt,
  0 AS qtd_vinculos_estat, lpad(CAST((o_orderkey + 22) % 97 AS VARCHAR), 2, '0') AS ind_simples
FROM orders""",
        "lineage_counts": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS ano,
  CASE l_returnflag WHEN 'A' THEN 'NORTE' WHEN 'N' THEN 'SUL' ELSE 'SP' END AS region, count(*) AS rows, true AS zstd
FROM lineitem GROUP BY ALL""",
        "reconcile_counts": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, count(*) AS source_rows, count(*) AS stored_rows, true AS agree
FROM lineitem GROUP BY ALL""",
        "distinct_states": with_ruled("SELECT DISTINCT uf FROM ruled"),
        "skip_long_rows": f"""
SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, '12' AS uf, lpad(CAST(l_orderkey AS VARCHAR), 11, '0') AS pis,
  '120040' AS municipio, CASE WHEN l_orderkey % 3 <> 0 THEN CAST(l_linenumber AS INTEGER) END AS qtd_hora_contr,
  CASE WHEN l_orderkey % 3 <> 0 THEN CAST(5.9 AS DOUBLE) END AS tempo_emprego
FROM lineitem WHERE l_orderkey % 17 <> 0 AND NOT {_LONG}""",
        "dropped_rows": f"""
SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, count(*) AS dropped_rows
FROM lineitem WHERE l_orderkey % 17 <> 0 AND {_LONG} GROUP BY ALL""",
        "incremental_run": f"{_PER_YEAR} UNION ALL SELECT 2003, NULL, 0, 1",
        "force_run": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, count(*) AS stored_rows, count(*) AS listed_rows,
  CAST(CASE WHEN year(l_shipdate) = 1996 THEN 2 ELSE 1 END AS BIGINT) AS loads,
  count(*) FILTER (l_suppkey % 8 = 2 AND l_orderkey % 11 <> 0 AND l_orderkey % 13 <> 0) AS of_state_13
FROM lineitem WHERE year(l_shipdate) <> 1996 OR l_suppkey % 8 <> 2 AND l_linenumber <= 3 GROUP BY ALL""",
        "failure_isolation": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, 'loaded' AS outcome, count(*) AS rows FROM lineitem GROUP BY ALL
UNION ALL SELECT 1998, 'part-headerless', 0 UNION ALL SELECT 1998, 'part-gone', 0""",
        "incremental_stream": f"{_PER_YEAR} UNION ALL SELECT 2003, 2, 2, 1",
        "stream_rows": with_ruled(links("l_returnflag = 'R'")),
        "compression_ratio": f"""WITH {entries(False).strip()},
sums AS (
  SELECT (SELECT CAST(sum(size_bytes) AS BIGINT) FROM live) AS source_bytes,
    (SELECT CAST(sum(l_orderkey + l_linenumber) AS BIGINT) FROM lineitem) AS parquet_bytes)
SELECT source_bytes, parquet_bytes, round(CAST(source_bytes AS DOUBLE) / 1e9, 1) AS source_gb,
  round(CAST(parquet_bytes AS DOUBLE) / 1e9, 2) AS parquet_gb,
  CAST(parquet_bytes AS DOUBLE) / CAST(source_bytes AS DOUBLE) AS ratio,
  format('{{:.1f}}%', CAST(parquet_bytes AS DOUBLE) / CAST(source_bytes AS DOUBLE) * 100) AS percent FROM sums""",
        "partition_scan": with_ruled(
            "SELECT ano, uf, pis, municipio, vl_remun_media_nom FROM ruled WHERE uf = '13' AND ano IN (1996, 1997)"
        ),
        "count_by_year": with_ruled("SELECT ano, count(*) AS vinculos FROM ruled WHERE uf = '13' GROUP BY ano ORDER BY ano"),
        "global_count_avg": with_ruled(f"SELECT count(*) AS n, {MEAN_PAY} AS remun_media FROM ruled"),
        "sector_summary": with_ruled(f"{sectors()} ORDER BY ano, vinculos DESC, setor"),
        "sector_summary_filtered": with_ruled(
            f"{sectors("uf = '13' AND municipio = '130074' AND ano IN (1996, 1997, 1998)")} ORDER BY ano, vinculos DESC, setor"
        ),
        "sector_one_year": with_ruled(
            f"SELECT setor, vinculos, ativos_31dez, remun_media FROM ({sectors()}) WHERE ano = 1998 ORDER BY vinculos DESC, setor"
        ),
    }
