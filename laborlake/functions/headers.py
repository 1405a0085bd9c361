"""Column expressions over a file's header line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from laborlake.functions.cleaning import BLANKS


def delimiter(line: Column) -> Column:
    """Historic files separate by ";", newer ones by ","; one ";" in the header decides."""
    return F.when(line.contains(";"), ";").otherwise(",")


def _tokens(line: Column, sep: str) -> Column:
    """Fields of a line, a quoted one with its quotes. One pass: each match ends at its separator."""
    field = f'("(?:[^"]|"")*"[^{sep}]*|[^{sep}]*){sep}'
    quoted = F.regexp_extract_all(F.concat(line, F.lit(sep)), F.lit(field), 1)
    return F.when(line.contains('"'), quoted).otherwise(F.split(line, sep))


def header_names(line: Column) -> Column:
    """Array of header names: split outside quotes, outer quotes removed, doubled quotes undone."""
    tokens = F.when(line.contains(";"), _tokens(line, ";")).otherwise(_tokens(line, ","))
    is_quoted = lambda t: F.startswith(t, F.lit('"')) & F.endswith(t, F.lit('"')) & (F.length(t) > 1)
    inner = lambda t: F.replace(F.substr(t, F.lit(2), F.length(t) - 2), F.lit('""'), F.lit('"'))
    return F.when(line == "", F.array().cast("array<string>")).otherwise(
        F.transform(tokens, lambda t: F.when(is_quoted(t), inner(t)).otherwise(t))
    )


def trimmed_names(names: Column) -> Column:
    return F.transform(names, lambda h: F.btrim(h, F.lit(BLANKS)))
