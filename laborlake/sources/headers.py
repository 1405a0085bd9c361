"""Reading the first line of many files at once."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlake.functions.headers import delimiter, header_names

ENCODING = "ISO-8859-1"
#: What the names of compressed files end in, which the engine's readers and `first_piece` undo.
COMPRESSED = ".gz"
#: Bytes read at a time until the first line ends.
PIECE = 1 << 13
#: Files open at a time, and files whose names wait for that.
READERS, FILES_AT_ONCE = 32, 4096


def decoded_uri(c: str) -> str:
    """Plain text of a percent-encoded path or file name, as the file metadata columns carry it."""
    return f"url_decode(replace({c}, '+', '%2B'))"


def own_session(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session like this one but for some settings, so that other queries of this one are not planned under them."""
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    for key, value in settings.items():
        own.conf.set(key, value)
    return own


def describe_headers(lines: DataFrame) -> DataFrame:
    """Add the separator and the header names to rows that carry a file's first ``line``."""
    text = F.coalesce(F.regexp_replace("line", r"[\r\n]+$", ""), F.lit(""))
    return lines.withColumn("sep", delimiter(text)).withColumn("headers", header_names(text))


def first_piece(spark: SparkSession, path: str) -> bytes:
    """The start of a file on any store that the engine opens, read piece by piece until its first line ends."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    try:
        if path.endswith(COMPRESSED):
            stream = spark._jvm.java.util.zip.GZIPInputStream(stream)
        piece = b""
        while more := stream.readNBytes(PIECE):
            piece += more
            if b"\n" in more:
                break
        return piece
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> bytes:
    return first_piece(spark, path).partition(b"\n")[0]


def has_odd_line(piece: bytes) -> bool:
    """Whether a whole line after the first one has an odd number of quotes, as lines have that a quoted line break ends."""
    return any(line.count(b'"') % 2 for line in piece.split(b"\n")[1:-1])


def read_headers(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(path, number, odd, error) of each file that is not empty, and (number, line) of the few different first lines.

    Threads of the driver open one file after the other through the engine's own file systems, so whatever it can scan
    has a header, and what is read does not depend on how large a file is. A file that can't be read does not stop the
    others. A name and a number stay of each file; lines are kept once, however many files share them. ``odd`` tells whether
    a line that was read along has an odd number of quotes.
    """
    spark = files.sparkSession

    def look(path: str) -> tuple[str, bytes | None, bool, str | None]:
        try:
            piece = first_piece(spark, path)
            return path, piece.partition(b"\n")[0], has_odd_line(piece), None
        except Py4JJavaError as error:
            return path, None, False, str(error.java_exception.toString())

    numbers: dict[bytes, int] = {}
    rows: list[tuple[str, int | None, bool, str | None]] = []
    paths = (r.path for r in files.where("size_bytes > 0").select("path").toLocalIterator())
    with ThreadPoolExecutor(READERS) as pool:
        while some := list(islice(paths, FILES_AT_ONCE)):
            for path, line, odd, error in pool.map(look, some):
                rows.append((path, None if line is None else numbers.setdefault(line, len(numbers)), odd, error))
    lines = spark.createDataFrame([(n, bytearray(line)) for line, n in numbers.items()], "number int, raw binary")
    return spark.createDataFrame(rows, "path string, number int, odd boolean, error string"), lines.select("number", F.decode("raw", ENCODING).alias("line"))


def with_headers(files: DataFrame, odd: bool = False) -> DataFrame:
    """Files plus ``line``, ``error``, ``sep`` and ``headers``, and ``odd`` if asked for; an empty or unreadable file has no
    header names."""
    found, lines = read_headers(files)
    described = files.join(found, "path", "left").join(describe_headers(lines), "number", "left").drop("number")
    none = F.array().cast("array<string>")
    return described.withColumns({"sep": F.coalesce("sep", F.lit(",")), "headers": F.coalesce("headers", none)}).select(
        *files.columns, "line", "error", "sep", "headers", *(["odd"] if odd else [])
    )
