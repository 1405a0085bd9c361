"""Checking file headers against the canonical columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborlake.functions.headers import trimmed_names
from laborlake.model import DATASETS, Dataset

# Dropped columns that every reader knows about and no report lists.
KNOWN_LEGACY = [
    "CNAE 95 Classe", "CBO 94 Ocupação", "Número CTPS", "PIS", "Vl Remun Média (SM)", "Vl Remun Dezembro Nom",
    "Vl Remun Dezembro (SM)", "Ind Vínculo Alvará", "Tipo Salário", "Ind CEI Vinculado",
    "Ind Estab Participa PAT", "Ind Atividade Ano",
]

#: So many new columns are shown beside the whole list.
SHOWN = 10


def _missing(names: Column, target: Dataset, optional: bool) -> Column:
    """First headers of the canonical columns that a file has under none of their headers."""
    columns = [f for f in target.fields if f.optional == optional]
    if not columns:
        return F.array().cast("array<string>")
    aliases = F.array(*[F.array(*[F.lit(a) for a in f.aliases]) for f in columns])
    absent = F.filter(aliases, lambda a: ~F.arrays_overlap(a, names))
    return F.transform(absent, lambda a: F.get(a, F.lit(0)))


def _unknown(names: Column, target: Dataset) -> Column:
    """Headers that stand for no canonical column, in file order and with repetitions."""
    known = F.array(*[F.lit(a) for f in target.fields for a in f.aliases])
    return F.filter(names, lambda h: ~F.array_contains(known, h))


def check_headers(files: DataFrame, target: Dataset | None = None) -> DataFrame:
    """Add ``missing_required``, ``missing_optional``, ``unknown`` and ``is_ok`` to files with ``headers``.

    Without a target each file is checked against the dataset its ``dataset`` column names. Array
    expressions over one row per file: no join, no shuffle.
    """
    names = F.col("_names")
    named = files.withColumn("_names", trimmed_names(F.col("headers")))

    def per_dataset(make):
        if target is not None:
            return make(target)
        choice = None
        for d in DATASETS.values():
            matches = F.col("dataset") == d.name
            choice = F.when(matches, make(d)) if choice is None else choice.when(matches, make(d))
        return choice

    return (
        named.withColumn("missing_required", per_dataset(lambda d: _missing(names, d, False)))
        .withColumn("missing_optional", per_dataset(lambda d: _missing(names, d, True)))
        .withColumn("unknown", per_dataset(lambda d: _unknown(names, d)))
        .withColumn("is_ok", F.size("missing_required") == 0)
        .drop("_names")
    )


def verdicts(checked: DataFrame) -> DataFrame:
    """Add the verdict on each file, the new columns worth reporting, and the first of them for display."""
    verdict = (
        F.when(~F.col("is_ok"), "ERRO").when(F.size("missing_optional") > 0, "AVISO").otherwise("OK")
    )
    new = F.filter("unknown", lambda h: ~h.isin(KNOWN_LEGACY))
    return (
        checked.withColumn("verdict", verdict)
        .withColumn("n_columns", F.size("headers"))
        .withColumn("new_columns", new)
        .withColumn("shown_columns", F.slice("new_columns", 1, SHOWN))
    )


def verdict_counts(judged: DataFrame) -> DataFrame:
    return judged.groupBy("verdict").agg(F.count(F.lit(1)).alias("files"))
