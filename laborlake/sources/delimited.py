"""Scanning delimited source files that share one layout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laborlake.sources.files import escape_glob
from laborlake.sources.headers import COMPRESSED, ENCODING, decoded_uri
from laborlake.sources.quoted import records_of

BROKEN = "_broken"
TOO_LONG = "_too_long"
CUT = "_cut"
FILE = "arquivo"


@dataclass(frozen=True)
class Layout:
    """What files must share to be read by one scan: fields are bound to headers by position."""

    sep: str
    headers: tuple[str, ...]

    @property
    def struct(self) -> T.StructType:
        fields = [T.StructField(f"_c{i}", T.StringType()) for i in range(len(self.headers))]
        return T.StructType([*fields, T.StructField(BROKEN, T.StringType())])

    def options(self, breaks: bool = False) -> dict[str, object]:
        """Of the reader; with `breaks` of the parser of one record, which may hold line breaks."""
        # With column pruning the reader would no longer notice rows of the wrong length.
        return {
            "sep": self.sep,
            # Quotes are doubled inside quotes; a backslash is an ordinary character.
            "escape": '"',
            "header": True,
            "encoding": ENCODING,
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": BROKEN,
            "columnPruning": False,
            "multiLine": breaks,
        }


def too_long(layout: Layout) -> str:
    """Whether a row has more fields than the header. Short rows are fine: their missing tail is NULL.

    The reader reports both kinds; separators outside quotes tell them apart.
    """
    bare = f"""regexp_replace({BROKEN}, '"[^"]*"', '')"""
    separators = f"length({bare}) - length(replace({bare}, '{layout.sep}', ''))"
    return f"CASE WHEN {BROKEN} IS NULL THEN false ELSE {separators} >= {len(layout.headers)} END"


def cut_in_two() -> str:
    """Whether a row is half of one that a quoted line break cuts: a quote opens or closes on no other side.

    Of the two halves, the later one has too few fields, or a quote that the reader cannot place, and is reported.
    """
    quotes = f"""length({BROKEN}) - length(replace({BROKEN}, '"', ''))"""
    return f"CASE WHEN {BROKEN} IS NULL THEN false ELSE ({quotes}) % 2 = 1 END"


def scan(
    spark: SparkSession, paths: list[str], layout: Layout, *, quoted_breaks: bool = False, plain_names: bool = False
) -> DataFrame:
    """All rows of the files as text by position, with the file name and marks on over-long and cut rows.

    ``quoted_breaks`` reads files with line breaks inside quotes; a row that it marks as cut has quotes that never close.
    ``plain_names`` promises that no file name needs percent-encoding, which saves decoding it per row.
    """
    compressed = any(p.endswith(COMPRESSED) for p in paths)
    if quoted_breaks:
        records = records_of(spark, paths)
        parsed = F.from_csv("record", layout.struct.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), layout.options(True))
        rows = records.select(parsed.alias("row"), "path", "open").select("row.*", "path", "open")
        return marked(rows, layout, plain_names, compressed, path="path", cut="open")
    df = spark.read.schema(layout.struct).options(**layout.options()).csv([escape_glob(p) for p in paths])
    return marked(df, layout, plain_names, compressed)


def marked(
    df: DataFrame, layout: Layout, plain_names: bool, compressed: bool = True, path: str = "input_file_name()", cut: str | None = None
) -> DataFrame:
    """``compressed`` tells whether some files may be, which go by the names of the files in them."""
    # The scan's metadata column would carry the same name, but copies every row once more to add it.
    name = f"substring_index({path}, '/', -1)"
    if compressed:
        name = f"IF(endswith({name}, '{COMPRESSED}'), left({name}, length({name}) - {len(COMPRESSED)}), {name})"
    return df.selectExpr(
        *[f"_c{i}" for i in range(len(layout.headers))],
        f"{name if plain_names else decoded_uri(name)} AS {FILE}",
        f"{too_long(layout)} AS {TOO_LONG}",
        f"{cut or cut_in_two()} AS {CUT}",
    )


def rows_of(df: DataFrame) -> DataFrame:
    """The rows to keep of a scan."""
    return df.where(~F.col(TOO_LONG)).drop(TOO_LONG, CUT)
