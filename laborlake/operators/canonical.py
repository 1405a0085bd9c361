"""From source columns to the canonical columns of a dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlake.functions import cleaning
from laborlake.functions.headers import trimmed_names
from laborlake.model import Dataset


def bind(raw: DataFrame, target: Dataset, headers: list[str], ano: int | str, keep: list[str] = ()) -> DataFrame:
    """Give the fields of one layout their canonical names, still as text, and add the year.

    ``raw`` holds the file's fields by position (``_c0``, ``_c1``, …). Columns the file does not have become
    NULL, unknown ones are dropped. ``ano`` is a year or SQL text for it, ``keep`` names columns to carry along.
    """
    positions = target.positions(headers)
    return raw.selectExpr(
        f"CAST({ano} AS INT) AS ano",
        *[
            f"{'CAST(NULL AS STRING)' if positions[f.name] is None else f'_c{positions[f.name]}'} AS {f.name}"
            for f in target.fields
        ],
        *keep,
    )


def clean(text: DataFrame, target: Dataset, keep: list[str] = ()) -> DataFrame:
    """Clean and type bound columns and add the state.

    Two projections: the first drops missing tokens and plain spaces and looks once at the row for rarer
    blanks, the second finishes and types each value from that short text.
    """
    names = [f.name for f in target.fields]
    short = text.selectExpr(
        "ano",
        *[f"{cleaning.na_to_null(n, f'trim({n})')} AS {n}" for n in names],
        f"{cleaning.only_plain_blanks(names)} AS _plain",
        *keep,
    )
    stripped = {n: cleaning.strip_rest("_plain", n) for n in names}
    typed = [
        f"{cleaning.PARSERS[f.dtype](stripped[f.name]) if f.dtype in cleaning.PARSERS else stripped[f.name]} AS {f.name}"
        for f in target.fields
    ]
    return short.selectExpr("ano", *typed, f"{cleaning.state_of(stripped['municipio'])} AS uf", *keep)


def canonicalize(raw: DataFrame, target: Dataset, headers: list[str], ano: int | str, keep: list[str] = ()) -> DataFrame:
    """Select, rename, clean and type the columns of one layout; add the year and the state."""
    return clean(bind(raw, target, headers, ano, keep), target, keep)


def canonicalize_named(raw: DataFrame, target: Dataset, ano: int | str, keep: list[str] = ()) -> DataFrame:
    """The same for a frame whose columns carry the source headers as names."""
    headers = [c for c in raw.columns if c not in keep]
    by_position = raw.toDF(*[c if c in keep else f"_c{headers.index(c)}" for c in raw.columns])
    return canonicalize(by_position, target, headers, ano, keep)


def conform(df: DataFrame, target: Dataset) -> DataFrame:
    """Exactly the dataset's columns in order: cast the ones there are, typed NULLs for the rest."""
    have = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({field.name if field.name in have else 'NULL'} AS {field.dataType.simpleString()}) AS {field.name}"
            for field in target.struct
        ]
    )


def resolve_aliases(files: DataFrame, target: Dataset) -> DataFrame:
    """For each file and canonical column it has: the header used and its place in the file.

    ``files`` carries an array column ``headers``; its other columns are kept. No join and no shuffle: the
    canonical columns are a constant array of at most fifty entries.
    """
    columns = ", ".join(
        f"struct({cleaning.quoted(f.name)} AS name, array({', '.join(map(cleaning.quoted, f.aliases))}) AS aliases)"
        for f in target.fields
    )
    chosen = f"""filter(
        transform(array({columns}), c -> struct(
            c.name AS name, get(filter(c.aliases, a -> array_contains(_names, a)), 0) AS alias)),
        c -> c.alias IS NOT NULL)"""
    return (
        files.withColumn("_names", trimmed_names(F.col("headers")))
        .selectExpr("*", f"explode({chosen}) AS _c")
        .selectExpr(
            *files.columns,
            "_c.name AS name",
            "_c.alias AS alias",
            "CAST(array_position(_names, _c.alias) - 1 AS INT) AS position",
        )
    )
