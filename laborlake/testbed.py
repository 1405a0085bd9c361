"""Registry-style source text derived from the generic sales tables, for queries, tests and benchmarks.

The sales tables hold no registry extracts. Each ``lineitem`` row becomes one job link and each ``orders``
row one establishment, one source file name or one ledger entry. Dirt is put in by fixed rules on the keys,
so that the expected result can be stated in plain SQL over the same tables.
"""

from __future__ import annotations

import gzip
import re
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlake.model import DATASETS, Dataset
from laborlake.session import new_folder
from laborlake.sources.files import ESTABLISHMENT_FOLDER, JOB_LINK_FOLDER, RAW_LISTING, hadoop_fs
from laborlake.sources.headers import COMPRESSED, ENCODING, own_session

# Source columns that stand for nothing canonical.
HISTORIC_EXTRAS = ["CNAE 95 Classe", "Vl Remun Dezembro Nom", "Número CTPS"]
NEW_EXTRAS = ["Município Trab - Código", "Ano Chegada Brasil"]

# Company names with what a reader of delimited text may stumble over: quotes, a separator inside them, a last backslash.
COMPANY = r"""CASE {key} % 4 WHEN 0 THEN concat('BAR "DO ZÉ" LTDA ', cast({key} as string))
    WHEN 1 THEN concat('"', cast({key} as string), '", S/A') WHEN 2 THEN concat('EMPRESA ', cast({key} as string), ' \\')
    ELSE concat('EMPRESA ', cast({key} as string), ', LTDA') END"""

MUNICIPALITY = "lpad(cast((11 + l_suppkey % 8) * 10000 + l_linenumber * 37 as string), 6, '0')"


# Fifty text columns and a line of them make one generated method too long for the JVM to compile, as in loading. A task keeps the
# files of all years and regions open, so that rows, many times longer as text, need no sort before the write.
TEXT_SETTINGS = {"spark.sql.codegen.wholeStage": "false", "spark.sql.maxConcurrentOutputFileWriters": "64"}
# Where lines are sorted all the same, a task takes few rows.
SORTED_TEXT_SETTINGS = TEXT_SETTINGS | {"spark.sql.files.maxPartitionBytes": "32m"}
# Compressed files are read by one task each and so hold few lines. A quick pass takes a third of the text's room.
COMPRESSION = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 500_000}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_source(spark: SparkSession, sf_dir: str, name: str, in_order: bool = False) -> DataFrame:
    """The table's rows, to be made into source text; ``in_order`` if its lines are to be sorted."""
    return read_table(own_session(spark, SORTED_TEXT_SETTINGS if in_order else TEXT_SETTINGS), sf_dir, name)


def job_link_text(new: bool) -> dict[str, str]:
    """Raw text of the canonical columns with a meaning of their own, in the historic or the newer layout."""

    def number(value: str, width: int) -> str:
        text = f"cast({value} as string)"
        return text if new else f"lpad(replace({text}, '.', ','), {width}, '0')"

    pay = number("cast(l_extendedprice as decimal(12,2))", 13)
    return {
        "pis": "lpad(cast(l_orderkey as string), 11, '0')",
        "cpf": "lpad(cast(l_partkey as string), 11, '0')",
        "nome_trabalhador": "concat('  PESSOA JOSÉ ', cast(l_orderkey as string), '   ')",
        "data_nascimento": f"date_format(l_shipdate, '{'dd/MM/yyyy' if new else 'ddMMyyyy'}')",
        "cnpj_cei": "lpad(cast(l_suppkey as string), 14, '0')",
        "cnpj_raiz": "lpad(cast(l_suppkey as string), 8, '0')",
        "cei_vinculado": "'000000000000'",
        "razao_social": COMPANY.format(key="l_suppkey"),
        "idade": "lpad(cast(18 + l_orderkey % 50 as string), 3, '0')",
        "vinculo_ativo_3112": "case when l_returnflag = 'N' then ' 1' else ' 0' end",
        "data_admissao": """case
            when l_orderkey % 10 = 0 then '00000000'
            when l_orderkey % 19 = 0 then '99999999'
            when l_orderkey % 2 = 0 then date_format(l_shipdate, 'ddMMyyyy')
            else date_format(l_shipdate, 'dd/MM/yyyy') end""",
        "tempo_emprego": number("cast(l_quantity as decimal(6,1))", 6),
        "qtd_hora_contr": """case
            when l_orderkey % 29 = 0 then '3.92'
            when l_orderkey % 31 = 0 then '9.5e108'
            when l_orderkey % 37 = 0 then '-99999999999'
            else lpad(cast(cast(l_quantity as int) as string), 3, '0') end""",
        "municipio": f"""case
            when l_orderkey % 11 = 0 then '000000'
            when l_orderkey % 13 = 0 then ''
            when l_orderkey % 17 = 0 then concat('  ', {MUNICIPALITY}, '  ')
            else {MUNICIPALITY} end""",
        "cnae20_subclasse": "concat(lpad(cast(l_partkey % 100 as string), 2, '0'), '13400')",
        "vl_remun_media_nom": f"case when l_orderkey % 23 = 0 then '' else {pay} end",
        "vl_salario_contratual": number("cast(l_extendedprice as decimal(12,2))", 10),
        "vl_ultima_remun_ano": number("cast(l_quantity as decimal(12,2))", 10),
        "qtd_dias_afast": "lpad(cast(l_linenumber as string), 3, '0')",
    }


def establishment_text(new: bool) -> dict[str, str]:
    day = "dd/MM/yyyy" if new else "ddMMyyyy"
    return {
        "cnpj_cei": "lpad(cast(o_orderkey as string), 14, '0')",
        "cnpj_raiz": "lpad(cast(o_custkey as string), 8, '0')",
        "cei_vinculado": "'000000000000'",
        "razao_social": COMPANY.format(key="o_custkey"),
        "municipio": """case when o_orderkey % 9 = 0 then '0'
            else lpad(cast((11 + o_custkey % 17) * 10000 + o_orderkey % 997 as string), 6, '0') end""",
        "numero_logradouro": """case when o_orderkey % 7 = 0 then '9.5e108' when o_orderkey % 5 = 0 then '3.92'
            else cast(o_orderkey % 4000 as string) end""",
        "nome_bairro": "concat('VILA SÃO ', o_orderstatus)",
        "data_abertura": f"date_format(o_orderdate, '{day}')",
        "data_baixa": "'00000000'",
        "data_encerramento": f"case when o_orderstatus = 'F' then date_format(o_orderdate, '{day}') else '0' end",
        "qtd_vinculos_ativos": "lpad(cast(o_custkey % 500 as string), 9, '0')",
        "qtd_vinculos_clt": "lpad(cast(o_custkey % 300 as string), 9, '0')",
        "qtd_vinculos_estat": "'000000000'",
    }


def header(target: Dataset, new: bool) -> list[str]:
    """Headers of a full file: the last known name of each column since 2024, the first one before."""
    columns = [f.aliases[-1 if new else 0] for f in target.fields if new or not f.optional]
    return columns + (NEW_EXTRAS if new else HISTORIC_EXTRAS)


def text_columns(target: Dataset, new: bool) -> list[Column]:
    """One raw text column per header."""
    job_links = target.name == "vinculos"
    key = "l_orderkey" if job_links else "o_orderkey"
    known = job_link_text(new) if job_links else establishment_text(new)
    names = [f.name for f in target.fields if new or not f.optional]
    extras = [f"_extra{i}" for i in range(len(NEW_EXTRAS if new else HISTORIC_EXTRAS))]
    return [
        F.expr(known.get(name, f"lpad(cast(({key} + {i}) % 97 as string), 2, '0')")).alias(f"_c{i}")
        for i, name in enumerate(names + extras)
    ]


def raw_rows(df: DataFrame, target: Dataset, new: bool, keep: list[Column]) -> DataFrame:
    """Raw text by position, as a scan of such files would give it."""
    return df.select(*text_columns(target, new), *keep)


def line(columns: list[str], new: bool) -> Column:
    """One line of a file. The newer layout quotes all fields, the historic one those with a quote or separator in them."""
    doubled = [F.replace(F.col(c), F.lit('"'), F.lit('""')) for c in columns]
    if new:
        return F.concat(F.lit('"'), F.concat_ws('","', *doubled), F.lit('"'))
    odd = [F.contains(F.col(c), F.lit('"')) | F.contains(F.col(c), F.lit(";")) for c in columns]
    quoted = [F.concat(F.lit('"'), d, F.lit('"')) for d in doubled]
    return F.concat_ws(";", *[F.when(o, q).otherwise(F.col(c)) for o, q, c in zip(odd, quoted, columns, strict=True)])


def header_line(names: list[str], new: bool) -> str:
    return ",".join(f'"{n}"' for n in names) if new else ";".join(names)


def write_lines(lines: DataFrame, head: str, folder: str, compressed: bool = False) -> None:
    """Write (ano, regiao, line) as latin-1 text with a header line, a folder per year and region."""
    (
        lines.select("ano", "regiao", F.col("line").alias(head))
        .write.partitionBy("ano", "regiao")
        .options(header=True, encoding=ENCODING, sep="\x01", quote="", escapeQuotes=False, emptyValue="")
        .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **(COMPRESSION if compressed else {}))
        .csv(folder)
    )


def publish(spark: SparkSession, staged: str, base: str) -> None:
    """Move staged files to the names the registry publishes job-link files under.

    Every part file becomes a regional file of its year, so that nothing is gathered into one task for the
    sake of a name. Renames only, as many as a Spark commit makes.
    """
    fs, root = hadoop_fs(spark, staged)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    moves = []
    for part in fs.globStatus(path_of(root, "ano=*/regiao=*/part-*")) or []:
        path = part.getPath()
        region = path.getParent().getName().split("=")[1]
        year = path.getParent().getParent().getName().split("=")[1]
        number, nth = re.match(r"part-(\d+)-.*[.-]c(\d+)\.", path.getName()).groups()
        number += f"_{nth}" if int(nth) else ""
        folder = f"{base}/{JOB_LINK_FOLDER}/RAIS {year}"
        end = COMPRESSED if path.getName().endswith(COMPRESSED) else ""
        moves.append((path, folder, f"RAIS_VINC_ID_{region}_{number}.txt{end}"))
    for folder in {folder for _, folder, _ in moves}:
        fs.mkdirs(path_of(folder))
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda m: fs.rename(m[0], path_of(m[1], m[2])), moves))


def region() -> Column:
    flag = F.col("l_returnflag")
    return F.when(flag == "A", "NORTE").when(flag == "N", "SUL").otherwise("SP").alias("regiao")


#: Company names over two lines, in the newer layout, whose fields are quoted.
TWO_LINES = "CASE WHEN l_orderkey % 41 = 0 THEN concat('EMPRESA\\n', cast(l_suppkey as string), '\\nFILIAL') ELSE {company} END"


def write_job_links(
    spark: SparkSession, rows: DataFrame, base: str, new: bool, breaks: bool = False, compressed: bool = False
) -> None:
    """Add job-link files of one layout below ``base``; ``rows`` are ``lineitem`` rows. ``breaks`` puts line breaks in names."""
    target = DATASETS["vinculos"]
    names = header(target, new)
    kept = [F.year("l_shipdate").alias("ano"), region()]
    raw = raw_rows(rows, target, new, [*kept, "l_orderkey", "l_suppkey"])
    if breaks:
        at = f"_c{[f.name for f in target.fields].index('razao_social')}"
        raw = raw.withColumn(at, F.expr(TWO_LINES.format(company=at)))
    lines = raw.select("ano", "regiao", line([f"_c{i}" for i in range(len(names))], new).alias("line"))
    if breaks:
        # The writer would quote a value with a line break, so its lines are rows of their own, in order.
        one_by_one = lines.withColumn("_row", F.monotonically_increasing_id()).select("*", F.posexplode(F.split("line", "\n")).alias("_at", "_line"))
        lines = one_by_one.sortWithinPartitions("ano", "regiao", "_row", "_at").select("ano", "regiao", F.col("_line").alias("line"))
    staged = new_folder(spark, "staged")
    write_lines(lines, header_line(names, new), staged, compressed)
    publish(spark, staged, base)


def job_link_tree(spark: SparkSession, sf_dir: str, layouts: str, compressed: bool = False) -> str:
    """A source tree holding every ``lineitem`` row once: "historic", "new", "breaks" (new, with line breaks inside quotes),
    or "mixed" (region SP new)."""
    base = new_folder(spark, f"source-{layouts}")
    rows = text_source(spark, sf_dir, "lineitem", in_order=layouts == "breaks")
    is_new = F.col("l_returnflag") == "R"
    if layouts in ("historic", "mixed"):
        write_job_links(spark, rows if layouts == "historic" else rows.where(~is_new), base, False, compressed=compressed)
    if layouts in ("new", "breaks", "mixed"):
        part = rows if layouts != "mixed" else rows.where(is_new)
        write_job_links(spark, part, base, True, breaks=layouts == "breaks", compressed=compressed)
    return base


def put_text(spark: SparkSession, path: str, lines: list[str], age_days: int = 0) -> None:
    """One small file of the given lines, dated back, compressed if its name says so."""
    fs, place = hadoop_fs(spark, path)
    out = fs.create(place, True)
    text = "".join(f"{x}\n" for x in lines).encode(ENCODING)
    out.write(bytearray(gzip.compress(text) if path.endswith(COMPRESSED) else text))
    out.close()
    if age_days:
        then = int((time.time() - 86400 * age_days) * 1000)
        fs.setTimes(place, then, then)


FIRST_NEW_YEAR = 1996


def establishment_tree(spark: SparkSession, sf_dir: str) -> str:
    """A source tree holding every ``orders`` row once, one file a year, the newer layout from FIRST_NEW_YEAR on.

    The published name allows one file a year, so each is written by one task.
    """
    target, base = DATASETS["estabelecimentos"], new_folder(spark, "source-establishments")
    rows = text_source(spark, sf_dir, "orders")
    is_new = F.year("o_orderdate") >= FIRST_NEW_YEAR
    fs, root = hadoop_fs(spark, base)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(path_of(f"{base}/{ESTABLISHMENT_FOLDER}"))
    for new, part in ((False, rows.where(~is_new)), (True, rows.where(is_new))):
        names = header(target, new)
        raw = raw_rows(part, target, new, [F.year("o_orderdate").alias("ano"), F.lit("BR").alias("regiao")])
        lines = raw.select("ano", "regiao", line([f"_c{i}" for i in range(len(names))], new).alias("line"))
        staged = new_folder(spark, "establishments")
        write_lines(lines.repartition("ano"), header_line(names, new), staged)
        for status in fs.globStatus(path_of(f"{staged}/ano=*/regiao=*/part-*")) or []:
            path = status.getPath()
            year = path.getParent().getParent().getName().split("=")[1]
            name = f"Estb{year}ID.txt" if new else f"estb{year}id.TXT"
            fs.rename(path, path_of(f"{base}/{ESTABLISHMENT_FOLDER}/{name}"))
    return base


def staged_files(spark: SparkSession, staged: str, target: Dataset) -> DataFrame:
    """Files as written, with year from their folder, in the form ``load_files`` takes."""
    fs, root = hadoop_fs(spark, staged)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    found = fs.globStatus(path_of(root, "ano=*/regiao=*/part-*")) or []
    listing = spark.createDataFrame([(s.getPath().toString(), s.getLen()) for s in found], RAW_LISTING)
    return listing.select(
        F.lit(target.name).alias("dataset"),
        F.regexp_extract("path", r"/ano=(\d{4})/", 1).cast("int").alias("ano"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"),
        "path",
        "size_bytes",
        F.lit(None).cast("string").alias("uf_hint"),
    )
