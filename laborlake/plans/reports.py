"""Questions answered over the stored tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborlake.functions.cleaning import round_cents

# Ranges of the first two characters of the activity code, compared as text, and their sector.
SECTORS = [
    ("01", "03", "Agropecuaria"),
    ("05", "09", "Ind. Extrativa"),
    ("10", "33", "Ind. Transformacao"),
    ("35", "39", "Energia/Saneamento"),
    ("41", "43", "Construcao"),
    ("45", "47", "Comercio"),
    ("49", "53", "Transporte"),
    ("55", "56", "Alojamento/Alimentacao"),
    ("58", "63", "Info/Comunicacao"),
    ("64", "66", "Financeiro"),
    ("68", "68", "Imobiliario"),
    ("69", "75", "Prof/Tecnico/Cientifico"),
    ("77", "82", "Adm. e Servicos"),
    ("84", "84", "Adm. Publica"),
    ("85", "85", "Educacao"),
    ("86", "88", "Saude"),
    ("90", "93", "Arte/Cultura/Esporte"),
    ("94", "96", "Outros Servicos"),
]
OTHER_SECTOR = "Outros"


def sector(activity: Column) -> Column:
    """Economic sector of an activity code."""
    division = F.substring(activity, 1, 2)
    named = [F.when(division.between(low, high), name) for low, high, name in SECTORS]
    return F.coalesce(*named, F.lit(OTHER_SECTOR))


def sector_summary(
    job_links: DataFrame,
    *,
    years: Iterable[int] | None = None,
    state: str | None = None,
    municipality: str | None = None,
) -> DataFrame:
    """Job links, those active at year end and mean pay per year and sector.

    ``years`` and ``state`` prune partitions, ``municipality`` is pushed to the Parquet scan; five columns are
    read.
    """
    if state is not None:
        job_links = job_links.where(F.col("uf") == state)
    if years is not None:
        job_links = job_links.where(F.col("ano").isin([int(y) for y in years]))
    if municipality is not None:
        job_links = job_links.where(F.col("municipio") == municipality)
    active = F.when(F.col("vinculo_ativo_3112") == "1", 1).otherwise(0)
    return (
        job_links.groupBy("ano", sector(F.col("cnae20_subclasse")).alias("setor"))
        .agg(
            F.count(F.lit(1)).alias("vinculos"),
            F.sum(active).alias("ativos_31dez"),
            F.expr("avg(try_cast(vl_remun_media_nom AS DOUBLE))").alias("remun_media"),
        )
        .withColumn("remun_media", F.expr(round_cents("remun_media")))
        .orderBy("ano", F.desc("vinculos"), "setor")
    )


def one_year(summary: DataFrame, year: int) -> DataFrame:
    """One year of a sector summary, without the year."""
    return summary.where(F.col("ano") == year).select("setor", "vinculos", "ativos_31dez", "remun_media")


def count_by_year(table: DataFrame) -> DataFrame:
    return table.groupBy("ano").agg(F.count(F.lit(1)).alias("vinculos")).orderBy("ano")


def count_and_mean_pay(job_links: DataFrame) -> DataFrame:
    return job_links.agg(
        F.count(F.lit(1)).alias("n"), F.avg("vl_remun_media_nom").alias("remun_media")
    )


def states(table: DataFrame) -> DataFrame:
    return table.select("uf").distinct()


def reconcile(source_rows: DataFrame, stored_rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key in the source and in the store, side by side, and whether they agree.

    Both sides are reduced before they meet.
    """
    source = source_rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("source_rows"))
    stored = stored_rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("stored_rows"))
    zero = F.lit(0).cast("long")
    return (
        source.join(stored, keys, "full_outer")
        .withColumn("source_rows", F.coalesce("source_rows", zero))
        .withColumn("stored_rows", F.coalesce("stored_rows", zero))
        .withColumn("agree", F.col("source_rows") == F.col("stored_rows"))
    )
