"""Every operator as a query over the sales tables, for the correctness gate and the benchmark.

Each function takes (spark, sf_dir) and returns a frame. What is written goes to a fresh folder of the
shared folder; trees and stores that several queries read are made once per session.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlake import testbed as tb
from laborlake.functions import cleaning
from laborlake.model import DATASETS
from laborlake.operators import ledger
from laborlake.operators.canonical import canonicalize, conform, resolve_aliases
from laborlake.operators.conformance import check_headers, verdict_counts, verdicts
from laborlake.operators.ledger import Ledger
from laborlake.plans import reports
from laborlake.plans.load import LoadResult, load, load_files
from laborlake.plans.verify import verify
from laborlake.session import new_folder
from laborlake.sources import store as tables
from laborlake.sources.files import JOB_LINK_FOLDER, classify, discover, filter_files, hadoop_fs, list_files
from laborlake.sources.headers import describe_headers, own_session, with_headers
from laborlake.streaming.arrivals import load_arrivals, load_stream

Query = Callable[[SparkSession, str], DataFrame]

JOB_LINKS = DATASETS["vinculos"]
ESTABLISHMENTS = DATASETS["estabelecimentos"]

_made: dict[tuple, str] = {}


def once(kind: str, make: Callable[[SparkSession, str], str]) -> Callable[[SparkSession, str], str]:
    def get(spark: SparkSession, sf_dir: str) -> str:
        key = (spark.sparkContext.applicationId, sf_dir, kind)
        if key not in _made:
            _made[key] = make(spark, sf_dir)
        return _made[key]

    return get


def tree(layouts: str) -> Callable[[SparkSession, str], str]:
    # Files with line breaks inside quotes are read in byte ranges, which compressed files have not got.
    compressed = layouts != "breaks"
    return once(f"tree-{layouts}", lambda spark, sf_dir: tb.job_link_tree(spark, sf_dir, layouts, compressed))


def _loaded(layouts: str) -> Callable[[SparkSession, str], str]:
    def make(spark: SparkSession, sf_dir: str) -> str:
        store = new_folder(spark, f"store-{layouts}")
        load(spark, tree(layouts)(spark, sf_dir), store)
        return store

    return once(f"store-{layouts}", make)


historic_store, broken_store, mixed_store = _loaded("historic"), _loaded("breaks"), _loaded("mixed")


def job_links(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return tables.read(spark, mixed_store(spark, sf_dir), JOB_LINKS, **options)


# Columns the ingest queries show: every type, and every rule that changes a value.
SHOWN = [
    "ano", "uf", "pis", "nome_trabalhador", "razao_social", "municipio", "data_nascimento", "data_admissao", "idade",
    "qtd_hora_contr", "qtd_dias_afast", "tempo_emprego", "vl_remun_media_nom", "vl_salario_contratual",
    "vl_ultima_remun_ano", "vinculo_ativo_3112", "cnae20_subclasse", "mes_fim_af3",
]


def shown(df: DataFrame, columns: list[str]) -> DataFrame:
    """Dates as text, so that both engines spell them alike."""
    dates = {f.name for d in DATASETS.values() for f in d.fields if f.dtype == "date"}
    return df.selectExpr(*[f"CAST({c} AS STRING) AS {c}" if c in dates else c for c in columns])


# ---- cleaning rules -------------------------------------------------------------------------------------


def raw_job_links(spark: SparkSession, sf_dir: str, new: bool = False) -> DataFrame:
    """Raw text by canonical name, with the keys of the row it came from."""
    text = tb.job_link_text(new)
    rows = tb.read_table(spark, sf_dir, "lineitem")
    return rows.selectExpr("l_orderkey", "l_linenumber", *[f"{sql} AS {name}" for name, sql in text.items()])


def cast_string(spark, sf_dir):
    """Names wrapped in spaces, tabs or no-break spaces."""
    wrapped = """CASE c_custkey % 3 WHEN 0 THEN concat('  ', c_name, ' ') WHEN 1 THEN concat('\t', c_name, '\t ')
        ELSE concat(' ', c_name, '  ') END"""
    rows = tb.read_table(spark, sf_dir, "customer").selectExpr("c_custkey", f"{wrapped} AS raw")
    return rows.selectExpr("c_custkey", f"{cleaning.cast_text('raw', 'str')} AS name")


def cast_int(spark, sf_dir):
    rows = raw_job_links(spark, sf_dir)
    return rows.selectExpr("l_orderkey", "l_linenumber", f"{cleaning.cast_text('qtd_hora_contr', 'int')} AS hours")


def cast_double(spark, sf_dir):
    historic = raw_job_links(spark, sf_dir).select("l_orderkey", "l_linenumber", "vl_remun_media_nom")
    new = raw_job_links(spark, sf_dir, new=True).select("l_orderkey", "l_linenumber", "vl_remun_media_nom")
    return historic.unionByName(new).selectExpr(
        "l_orderkey", "l_linenumber", f"{cleaning.cast_text('vl_remun_media_nom', 'double')} AS pay"
    )


def cast_date(spark, sf_dir):
    rows = raw_job_links(spark, sf_dir)
    return rows.selectExpr(
        "l_orderkey", "l_linenumber", f"CAST({cleaning.cast_text('data_admissao', 'date')} AS STRING) AS hired"
    )


def na_tokens(spark, sf_dir):
    """A third of the comments of an event is a missing token, some only look like one."""
    tokens = ", ".join(cleaning.quoted(t) for t in [*cleaning.NA_TOKENS, " NA", "NaN ", "nil", "N/a", "-", "0"])
    size = len(cleaning.NA_TOKENS) + 6
    rows = tb.read_table(spark, sf_dir, "events").selectExpr(
        "event_id", f"CASE WHEN event_id % 3 = 0 THEN element_at(array({tokens}), 1 + CAST(event_id % {size} AS INT)) "
        "ELSE event_type END AS raw"
    )
    return rows.selectExpr("event_id", f"{cleaning.na_to_null('raw')} AS value")


def derive_state(spark, sf_dir):
    rows = raw_job_links(spark, sf_dir)
    return rows.selectExpr(
        "l_orderkey", "l_linenumber", f"{cleaning.state_code(cleaning.na_to_null('municipio'))} AS uf"
    )


# ---- model, headers, conformance ------------------------------------------------------------------------


def canonical_schema(spark, sf_dir):
    """Parts of establishments brought to the full canonical schema: one row per column and order status."""
    rows = tb.read_table(spark, sf_dir, "orders").selectExpr(
        "year(o_orderdate) AS ano",
        "CAST(o_orderkey AS STRING) AS cnpj_cei",
        "CAST(o_custkey AS STRING) AS qtd_vinculos_ativos",
        "o_orderstatus AS uf",
    )
    full = conform(rows, ESTABLISHMENTS)
    counts = full.groupBy("uf").agg(*[F.count(c).alias(f"n_{c}") for c in full.columns if c != "uf"])
    names = [c for c in full.columns if c != "uf"]
    types = {f.name: f.dataType.simpleString() for f in full.schema}
    stack = ", ".join(f"{i}, '{c}', '{types[c]}', n_{c}" for i, c in enumerate(names))
    return counts.selectExpr("uf", f"stack({len(names)}, {stack}) AS (position, name, type, filled)")


def canonicalize_mixed(spark, sf_dir):
    """Both layouts, cleaned without a file in between, as one table."""
    rows = tb.text_source(spark, sf_dir, "lineitem")
    is_new = F.col("l_returnflag") == "R"
    frames = []
    for new, part in ((False, rows.where(~is_new)), (True, rows.where(is_new))):
        raw = tb.raw_rows(part, JOB_LINKS, new, [F.year("l_shipdate").alias("_year")])
        frames.append(canonicalize(raw, JOB_LINKS, tb.header(JOB_LINKS, new), "_year"))
    return shown(frames[0].unionByName(frames[1]), SHOWN)


def header_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One header line per order: either dataset and layout, a column missing, names padded, columns added."""

    def names(dataset: str, new: bool) -> str:
        target = DATASETS[dataset]
        columns = [f.aliases[-1 if new else 0] for f in target.fields]
        return f"array({', '.join(cleaning.quoted(c) for c in columns)})"

    choice = f"""CASE o_orderkey % 4
        WHEN 0 THEN {names('vinculos', False)} WHEN 1 THEN {names('vinculos', True)}
        WHEN 2 THEN {names('estabelecimentos', False)} ELSE {names('estabelecimentos', True)} END"""
    many = "transform(sequence(1, 14), i -> concat('Coluna ', i))"
    extra = f"""CASE WHEN o_orderkey % 3 = 0 THEN array('CNAE 95 Classe', 'Coluna Nova', 'Coluna Nova')
        WHEN o_orderkey % 7 = 0 THEN {many}
        ELSE CAST(array() AS ARRAY<STRING>) END"""
    return (
        tb.read_table(spark, sf_dir, "orders")
        .selectExpr("o_orderkey", f"{choice} AS complete", f"{extra} AS extra")
        .selectExpr(
            "o_orderkey",
            "IF(o_orderkey % 4 < 2, 'vinculos', 'estabelecimentos') AS dataset",
            "o_orderkey % 2 = 1 AS quoted",
            """concat(transform(filter(complete, (h, i) -> i <> o_orderkey % 70),
                h -> IF(o_orderkey % 5 = 0, concat(' ', h, ' '), h)), extra) AS names""",
        )
        .selectExpr(
            "o_orderkey",
            "dataset",
            """IF(quoted, concat('"', array_join(names, '","'), '"'), array_join(names, ';')) AS line""",
        )
    )


def described(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe_headers(header_files(spark, sf_dir)).drop("line")


def header_sniff(spark, sf_dir):
    return described(spark, sf_dir).selectExpr(
        "o_orderkey", "sep", "size(headers) AS n_columns", "array_join(headers, '|') AS names"
    )


REGION = "regexp_extract(filename, 'ID_([A-Z]+)_', 1) AS region"


def with_all_listed(spark: SparkSession, found: DataFrame, source: str) -> DataFrame:
    """Rows of (ano, region, ...) that files agree in, and whether these are all files listed there."""
    keys = found.columns
    listed = list_files(spark, source).selectExpr("regexp_extract(path, 'RAIS (\\\\d{4})/', 1) AS y", "regexp_extract(path, '([^/]+)$', 1) AS filename")
    listed = listed.selectExpr("CAST(y AS INT) AS ano", REGION).groupBy("ano", "region").agg(F.count(F.lit(1)).alias("listed"))
    counted = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("files"))
    return counted.join(listed, ["ano", "region"], "full_outer").selectExpr(*keys, "files <=> listed AS complete")


def header_files_on_disk(spark, sf_dir):
    """Headers read back from the first line of every file of a source tree."""
    source = tree("mixed")(spark, sf_dir)
    headers = with_headers(discover(spark, source)).selectExpr(
        "ano", REGION, "sep", "size(headers) AS n_columns", "headers[3] AS fourth"
    )
    return with_all_listed(spark, headers, source)


def verify_files(spark, sf_dir):
    """Verdicts on every file of a source tree."""
    source = tree("mixed")(spark, sf_dir)
    judged = verify(spark, source).selectExpr(
        "dataset", "ano", REGION, "verdict", "n_columns", "array_join(missing_optional, '|') AS missing_optional",
        "array_join(new_columns, '|') AS new_columns",
    )
    return with_all_listed(spark, judged, source)


def alias_resolve(spark, sf_dir):
    files = described(spark, sf_dir)
    parts = [
        resolve_aliases(files.where(F.col("dataset") == name), target).select("o_orderkey", "name", "alias", "position")
        for name, target in DATASETS.items()
    ]
    return parts[0].unionByName(parts[1])


def schema_check(spark, sf_dir):
    return check_headers(described(spark, sf_dir)).selectExpr(
        "o_orderkey",
        "array_join(missing_required, '|') AS missing_required",
        "array_join(missing_optional, '|') AS missing_optional",
        "array_join(unknown, '|') AS unknown",
        "is_ok",
    )


def schema_verdict(spark, sf_dir):
    return verdicts(check_headers(described(spark, sf_dir))).selectExpr(
        "o_orderkey", "dataset", "verdict", "n_columns", "array_join(new_columns, '|') AS new_columns",
        "array_join(shown_columns, '|') AS shown_columns",
    )


def schema_verdict_counts(spark, sf_dir):
    return verdict_counts(verdicts(check_headers(described(spark, sf_dir))))


# ---- files ----------------------------------------------------------------------------------------------


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One path per order: state, regional and establishment files, misplaced and unrelated ones."""
    year = "CAST(1995 + o_orderkey % 8 AS STRING)"
    state = "element_at(array('AC', 'sp', 'Rj', 'RS'), 1 + CAST(o_custkey % 4 AS INT))"
    region = "element_at(array('NORTE', 'SUL', 'SP'), 1 + CAST(o_custkey % 3 AS INT))"
    path = f"""CASE o_orderkey % 9
        WHEN 0 THEN concat('RAIS Vínculos/RAIS ', {year}, '/', {state}, {year}, 'ID.txt')
        WHEN 1 THEN concat('RAIS Vínculos/rais  ', {year}, '/parte/', {state}, '2014id.TXT')
        WHEN 2 THEN concat('RAIS Vínculos/RAIS ', {year}, '/RAIS_VINC_ID_', {region}, '_', o_orderkey, '.COMT')
        WHEN 3 THEN concat('RAIS Estabelecimentos/Estb', {year}, 'ID.txt')
        WHEN 4 THEN concat('RAIS Estabelecimentos/antigos/Estb', {year}, 'ID.txt')
        WHEN 5 THEN concat('RAIS Vínculos/RAIS ', {year}, '/layout', o_orderkey, '.xls')
        WHEN 6 THEN concat('RAIS Vínculos/Notas ', {year}, '/', {state}, {year}, 'ID.txt')
        WHEN 7 THEN concat('RAIS Vínculos/RAIS ', {year}, '/', {state}, {year}, 'ID.csv')
        ELSE concat('RAIS Estabelecimentos/estb', {year}, 'id.comt') END"""
    return tb.read_table(spark, sf_dir, "orders").selectExpr(
        f"concat('/registry/', {path}) AS path", "CAST(o_custkey * 1000 AS BIGINT) AS size_bytes", "o_orderkey"
    )


def discover_files(spark, sf_dir):
    files = classify(listing(spark, sf_dir), "/registry")
    return files.select("o_orderkey", "dataset", "ano", "filename", "uf_hint", "size_bytes")


def filter_files_query(spark, sf_dir):
    files = classify(listing(spark, sf_dir), "/registry")
    return filter_files(files, "vinculos", 1999, "sp").select("o_orderkey", "ano", "filename", "uf_hint")


# ---- ledger ---------------------------------------------------------------------------------------------


def ledger_entries(spark: SparkSession, sf_dir: str, removals: bool = False) -> DataFrame:
    """Every order as a ledger row; a customer's orders of a year are versions of one file's row."""
    deleted = "o_orderkey % 5 = 0" if removals else "false"
    return tb.read_table(own_session(spark, ledger.SETTINGS), sf_dir, "orders").selectExpr(
        "IF(o_custkey % 3 = 0, 'estabelecimentos', 'vinculos') AS dataset",
        "year(o_orderdate) AS ano",
        "concat('F', o_custkey, '.txt') AS filename",
        f"IF({deleted}, NULL, CAST(floor(o_totalprice) AS BIGINT)) AS rows",
        f"IF({deleted}, NULL, o_orderkey * 10) AS size_bytes",
        "timestamp_seconds(1577836800 + o_orderkey) AS processed_at",
        f"{deleted} AS deleted",
    )


def customer_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per customer and year 1995 to 1998, some loaded and some not."""
    return tb.read_table(spark, sf_dir, "customer").selectExpr(
        "IF(c_custkey % 3 = 0, 'estabelecimentos', 'vinculos') AS dataset",
        "explode(sequence(1995, 1998)) AS ano",
        "concat('F', c_custkey, '.txt') AS filename",
    )


def stored_ledger(spark: SparkSession, sf_dir: str) -> Ledger:
    """The orders' rows written as a ledger table, through the table's own append."""

    def make(spark: SparkSession, sf_dir: str) -> str:
        store = new_folder(spark, "ledger")
        entries = ledger.current(ledger_entries(spark, sf_dir))
        Ledger(spark, store).mark_done(entries)
        return store

    return Ledger(spark, once("ledger", make)(spark, sf_dir))


def manifest_upsert(spark, sf_dir):
    newest = ledger.current(ledger_entries(spark, sf_dir))
    return newest.select("dataset", "ano", "filename", "rows", "size_bytes", F.unix_seconds("processed_at").alias("processed_at"))


def manifest_remove(spark, sf_dir):
    """Newest rows win, removals included; then every file of 1997 is removed through the table, which is compacted."""
    store = new_folder(spark, "ledger")
    table = Ledger(spark, store)
    table.mark_done(ledger.current(ledger_entries(spark, sf_dir, removals=True)))
    table.remove(table.list_done(year=1997))
    table.compact()
    return table.current().select("dataset", "ano", "filename", "rows", "size_bytes")


def pending_files(spark, sf_dir):
    done = ledger.current(ledger_entries(spark, sf_dir, removals=True))
    return ledger.pending(customer_files(spark, sf_dir), done)


def done_files(spark, sf_dir):
    done = ledger.current(ledger_entries(spark, sf_dir, removals=True))
    return ledger.loaded(customer_files(spark, sf_dir), done)


def manifest_status(spark, sf_dir):
    return ledger.status(stored_ledger(spark, sf_dir).list_done(dataset="vinculos"))


def manifest_totals(spark, sf_dir):
    return ledger.status_with_total(stored_ledger(spark, sf_dir).current())


# ---- loading --------------------------------------------------------------------------------------------


def ingest_historic(spark, sf_dir):
    return shown(tables.read(spark, historic_store(spark, sf_dir), JOB_LINKS), SHOWN)


def ingest_2024(spark, sf_dir):
    """Files of the newer layout, in which some quoted names hold line breaks."""
    return shown(tables.read(spark, broken_store(spark, sf_dir), JOB_LINKS), SHOWN)


ESTABLISHMENT_SHOWN = [
    "ano", "uf", "cnpj_cei", "razao_social", "municipio", "numero_logradouro", "nome_bairro", "data_abertura",
    "data_baixa", "data_encerramento", "qtd_vinculos_ativos", "qtd_vinculos_clt", "qtd_vinculos_estat", "ind_simples",
]


def ingest_establishments(spark, sf_dir):
    """Both layouts, from a real folder."""
    store = new_folder(spark, "store-establishments")
    load(spark, tb.establishment_tree(spark, sf_dir), store)
    return shown(tables.read(spark, store, ESTABLISHMENTS), ESTABLISHMENT_SHOWN)


def lineage_counts(spark, sf_dir):
    """Rows per year and region of the file they came from, and whether all are in files of the codec."""
    rows = job_links(spark, sf_dir, lineage=True).withColumn("zstd", F.input_file_name().endswith(".zstd.parquet"))
    return rows.groupBy("ano", F.regexp_extract("arquivo", "ID_([A-Z]+)_", 1).alias("region")).agg(
        F.count(F.lit(1)).alias("rows"), F.every("zstd").alias("zstd")
    )


def reconcile_counts(spark, sf_dir):
    """Rows per year in the tables the source was made from and in the store."""
    source = tb.read_table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("ano"))
    return reports.reconcile(source, job_links(spark, sf_dir), ["ano"])


def distinct_states(spark, sf_dir):
    return reports.states(job_links(spark, sf_dir))


SHAPE_HEADER = ["PIS", "Município", "Qtd Hora Contr", "Tempo Emprego"]


SHAPE_FIELDS = "concat_ws(';', lpad(cast(l_orderkey as string), 11, '0'), '120040', cast(l_linenumber as string), '0005,9')"
# None, three, six and all ten of ten rows, by year.
IS_LONG = "l_orderkey % 10 < element_at(array(0, 3, 6, 10), 1 + year(l_shipdate) % 4)"


def load_shapes(spark: SparkSession, sf_dir: str) -> tuple[LoadResult, str]:
    """Blank lines, rows cut short, rows with a field too many (empty or not) and rows of the right length."""
    text = f"""CASE WHEN l_orderkey % 17 = 0 THEN ''
        WHEN {IS_LONG} THEN concat({SHAPE_FIELDS}, IF(l_linenumber % 2 = 0, ';x', ';'))
        WHEN l_orderkey % 3 = 0 THEN substring_index({SHAPE_FIELDS}, ';', 2) ELSE {SHAPE_FIELDS} END"""
    rows = tb.text_source(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("ano"), F.lit("BR").alias("regiao"), F.expr(text).alias("line")
    )
    staged, store = new_folder(spark, "shapes"), new_folder(spark, "store-shapes")
    tb.write_lines(rows, tb.header_line(SHAPE_HEADER, False), staged)
    return load_files(spark, tb.staged_files(spark, staged, JOB_LINKS), store), store


def skip_long_rows(spark, sf_dir):
    """Every row of a length that fits is kept, however many others its file has."""
    _, store = load_shapes(spark, sf_dir)
    stored = tables.read(spark, store, JOB_LINKS)
    return stored.select("ano", "uf", "pis", "municipio", "qtd_hora_contr", "tempo_emprego")


def dropped_rows(spark, sf_dir):
    result, _ = load_shapes(spark, sf_dir)
    return result.dropped.groupBy("ano").agg(F.sum("dropped_rows").alias("dropped_rows"))


def outcome(spark: SparkSession, store: str) -> DataFrame:
    """Rows stored and rows in the ledger, per year, and how often a file was loaded at most."""
    stored = tables.rows_per_file(spark, store, JOB_LINKS).groupBy("ano").agg(F.sum("rows").alias("stored_rows"))
    table = Ledger(spark, store)
    listed = table.current().groupBy("ano").agg(F.sum("rows").alias("listed_rows"))
    loads = table.entries().where("NOT deleted").groupBy("ano", "filename").agg(F.count(F.lit(1)).alias("n"))
    loads = loads.groupBy("ano").agg(F.max("n").alias("loads"))
    return stored.join(listed, "ano", "full_outer").join(loads, "ano", "full_outer")


def incremental_run(spark, sf_dir):
    """Years up to 1997 first, then all, then all again: every file is loaded exactly once, empty ones as well."""
    base, store = new_folder(spark, "source-growing"), new_folder(spark, "store-growing")
    rows = tb.text_source(spark, sf_dir, "lineitem")
    early = F.year("l_shipdate") <= 1997
    tb.write_job_links(spark, rows.where(early), base, new=False, compressed=True)
    load(spark, base, store)
    tb.write_job_links(spark, rows.where(~early), base, new=False, compressed=True)
    tb.put_text(spark, f"{base}/{JOB_LINK_FOLDER}/RAIS 2003/SP2003ID.txt", [])
    tb.put_text(spark, f"{base}/{JOB_LINK_FOLDER}/RAIS 2003/AC2003ID.txt", [tb.header_line(SHAPE_HEADER, False)])
    load(spark, base, store)
    load(spark, base, store)
    return outcome(spark, store)


def force_run(spark, sf_dir):
    """A source file changes and one of its states goes. Loading again does nothing, loading by force replaces it."""
    base, store = new_folder(spark, "source-changing"), new_folder(spark, "store-forced")
    rows = tb.text_source(spark, sf_dir, "lineitem")
    changing = rows.where(F.year("l_shipdate") == 1996)
    # Rows keep their task, and with it the number in the name of their file, also when others are gone.
    changing = changing.repartition(max(1, changing.rdd.getNumPartitions()), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    tb.write_job_links(spark, rows.where(F.year("l_shipdate") != 1996), base, new=False, compressed=True)
    tb.write_job_links(spark, changing, base, new=False, compressed=True)
    load(spark, base, store)
    fs, folder = hadoop_fs(spark, f"{base}/{JOB_LINK_FOLDER}/RAIS 1996")
    names = [status.getPath() for status in fs.listStatus(folder)] if fs.exists(folder) else []
    fs.delete(folder, True)
    tb.write_job_links(spark, changing.where("l_suppkey % 8 <> 2 AND l_linenumber <= 3"), base, new=False, compressed=True)
    for path in names:
        if not fs.exists(path):  # all its rows are gone
            tb.put_text(spark, path.toString(), [tb.header_line(tb.header(JOB_LINKS, False), False)])
    load(spark, base, store)
    load(spark, base, store, dataset="vinculos", year=1996, force=True)
    states = tables.read(spark, store, JOB_LINKS).groupBy("ano").agg(F.count_if(F.col("uf") == "13").alias("of_state_13"))
    return outcome(spark, store).join(states, "ano")


def failure_isolation(spark, sf_dir):
    """A file that is not there and one without a header fail, in a year whose other files load."""
    rows = tb.text_source(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("ano"), F.lit("BR").alias("regiao"), F.expr(SHAPE_FIELDS).alias("line")
    )
    staged, store = new_folder(spark, "broken"), new_folder(spark, "store-broken")
    tb.write_lines(rows, tb.header_line(SHAPE_HEADER, False), staged)
    tb.put_text(spark, f"{staged}/ano=1998/regiao=BR/part-headerless", ["", "1;120040;3;4"])
    tb.put_text(spark, f"{staged}/ano=1998/regiao=BR/part-gone", ["1;120040;3;4"])
    files = tb.staged_files(spark, staged, JOB_LINKS)
    files = spark.createDataFrame(files.collect(), files.schema)
    fs, gone = hadoop_fs(spark, f"{staged}/ano=1998/regiao=BR/part-gone")
    fs.delete(gone, False)
    result = load_files(spark, files, store)
    failed = result.errors.select("ano", F.col("filename").alias("outcome"), F.lit(0).cast("long").alias("rows"))
    stored = tables.read(spark, store, JOB_LINKS).groupBy("ano").agg(F.count(F.lit(1)).alias("rows"))
    return stored.select("ano", F.lit("loaded").alias("outcome"), "rows").unionByName(failed)


def stream_rows(spark, sf_dir):
    """The rows of all years' files, of both layouts, as one stream in several batches, which is then started again."""
    store = new_folder(spark, "store-streamed")
    source = tree("mixed")(spark, sf_dir)
    for _ in range(2):
        load_stream(spark, source, store, files_per_batch=100).awaitTermination()
    return shown(tables.read(spark, store, JOB_LINKS), SHOWN)


def incremental_stream(spark, sf_dir):
    """The same with files picked up by a stream; one is older than those seen and has an extension in odd case."""
    base, store = new_folder(spark, "source-stream"), new_folder(spark, "store-stream")
    rows = tb.text_source(spark, sf_dir, "lineitem")
    early = F.year("l_shipdate") <= 1997
    tb.write_job_links(spark, rows.where(early), base, new=True, compressed=True)
    load_arrivals(spark, base, store)
    tb.write_job_links(spark, rows.where(~early), base, new=True, compressed=True)
    lines = [tb.header_line(SHAPE_HEADER, False), "A;120040;1;0005,9", "B;120040;2;0005,9"]
    tb.put_text(spark, f"{base}/{JOB_LINK_FOLDER}/RAIS 2003/AC2003ID.tXt", lines, age_days=400)
    load_arrivals(spark, base, store)
    load_arrivals(spark, base, store)
    return outcome(spark, store)


# ---- reports --------------------------------------------------------------------------------------------


def partition_scan(spark, sf_dir):
    """One state of two years, read from its partitions only."""
    part = job_links(spark, sf_dir, years=[1996, 1997], states=["13"])
    return part.select("ano", "uf", "pis", "municipio", "vl_remun_media_nom")


def count_by_year(spark, sf_dir):
    return reports.count_by_year(job_links(spark, sf_dir).where("uf = '13'"))


def global_count_avg(spark, sf_dir):
    totals = reports.count_and_mean_pay(job_links(spark, sf_dir))
    return totals.selectExpr("n", f"{cleaning.round_cents('remun_media')} AS remun_media")


def sector_summary(spark, sf_dir):
    return reports.sector_summary(job_links(spark, sf_dir))


def sector_summary_filtered(spark, sf_dir):
    """State, years and municipality named, as in the published example."""
    return reports.sector_summary(
        job_links(spark, sf_dir), years=[1996, 1997, 1998], state="13", municipality="130074"
    )


def sector_one_year(spark, sf_dir):
    return reports.one_year(reports.sector_summary(job_links(spark, sf_dir)), 1998)


def compression_ratio(spark, sf_dir):
    """Ledger rows of the orders against files of given lengths."""
    files = tb.read_table(spark, sf_dir, "lineitem").selectExpr(
        "concat(l_orderkey, '-', l_linenumber) AS path", "l_orderkey + l_linenumber AS length"
    )
    return ledger.compression(stored_ledger(spark, sf_dir).current(), files)


QUERIES: dict[str, Query] = {
    "cast_string": cast_string,
    "cast_int": cast_int,
    "cast_double": cast_double,
    "cast_date": cast_date,
    "na_tokens": na_tokens,
    "derive_state": derive_state,
    "canonical_schema": canonical_schema,
    "canonicalize_mixed": canonicalize_mixed,
    "header_sniff": header_sniff,
    "header_files_on_disk": header_files_on_disk,
    "verify_files": verify_files,
    "alias_resolve": alias_resolve,
    "schema_check": schema_check,
    "schema_verdict": schema_verdict,
    "schema_verdict_counts": schema_verdict_counts,
    "discover_files": discover_files,
    "filter_files": filter_files_query,
    "manifest_upsert": manifest_upsert,
    "manifest_remove": manifest_remove,
    "pending_files": pending_files,
    "done_files": done_files,
    "manifest_status": manifest_status,
    "manifest_totals": manifest_totals,
    "ingest_historic": ingest_historic,
    "ingest_2024": ingest_2024,
    "ingest_establishments": ingest_establishments,
    "lineage_counts": lineage_counts,
    "reconcile_counts": reconcile_counts,
    "distinct_states": distinct_states,
    "skip_long_rows": skip_long_rows,
    "dropped_rows": dropped_rows,
    "incremental_run": incremental_run,
    "force_run": force_run,
    "failure_isolation": failure_isolation,
    "incremental_stream": incremental_stream,
    "stream_rows": stream_rows,
    "partition_scan": partition_scan,
    "count_by_year": count_by_year,
    "global_count_avg": global_count_avg,
    "sector_summary": sector_summary,
    "sector_summary_filtered": sector_summary_filtered,
    "sector_one_year": sector_one_year,
    "compression_ratio": compression_ratio,
}
