"""Reporting whether source files have the columns their dataset needs, before anything is loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from laborlake.operators.conformance import check_headers, verdicts
from laborlake.sources.files import discover, filter_files
from laborlake.sources.headers import with_headers

REPORT = ["dataset", "ano", "filename", "verdict", "n_columns", "missing_required", "missing_optional", "new_columns", "shown_columns"]


def verify(
    spark: SparkSession, source: str, *, dataset: str | None = None, year: int | None = None, state: str | None = None
) -> DataFrame:
    """The verdict on every file below ``source``; reads one line of each. An empty file is an error here."""
    files = filter_files(discover(spark, source), dataset, year, state)
    return verdicts(check_headers(with_headers(files))).select(*REPORT).orderBy("dataset", "ano", "filename")

