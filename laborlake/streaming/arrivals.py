"""Picking up new source files with Structured Streaming.

The stream's rows are files, not their lines: layouts differ between files, and a stream has one schema. `load_stream` loads
the files of each micro-batch as they come, grouped by layout as in a batch run. `load_arrivals` records each
file that appears under the source folder in an arrivals table exactly once, and loads what that table lists beyond the ledger.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from laborlake.model import Dataset
from laborlake.operators.canonical import canonicalize
from laborlake.plans.load import LoadResult, load_files
from laborlake.sources.delimited import FILE, Layout, marked, rows_of
from laborlake.sources.files import classify, escape_glob, hadoop_fs, list_files, qualify

#: Source files by extension, in any case.
ANY_SOURCE = "*.{[tT][xX][tT],[cC][oO][mM][tT],[tT][xX][tT].gz,[cC][oO][mM][tT].gz}"
#: No file is too old to be picked up: copies of archives keep the dates of the originals.
NEVER = "1000000d"


def arrivals_path(store: str) -> str:
    return f"{store.rstrip('/')}/_arrivals"


def new_files(spark: SparkSession, source: str, files_per_batch: int | None = None) -> DataFrame:
    """(path, size_bytes) of files below ``source`` as a stream; lengths only, as the file format reads contents on demand."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", ANY_SOURCE)
        .option("maxFileAge", NEVER)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(escape_glob(source)).selectExpr("path", "length AS size_bytes")


def follow(spark: SparkSession, source: str, store: str, **trigger) -> StreamingQuery:
    """Start recording new files below ``source``; by default what is there now, then stop."""
    path = arrivals_path(store)
    return (
        new_files(spark, source).writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", f"{path}_checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def arrived(spark: SparkSession, source: str, store: str) -> DataFrame:
    """Source files recorded so far, and the empty ones, which no file stream reports."""
    base = qualify(spark, source)
    path = arrivals_path(store)
    fs, root = hadoop_fs(spark, path)
    empty = list_files(spark, source).where("size_bytes = 0")
    if not fs.exists(root):
        return classify(empty, base)
    recorded = spark.read.schema("path string, size_bytes long").parquet(path)
    return classify(recorded.unionByName(empty), base)


def load_arrivals(spark: SparkSession, source: str, store: str, **options) -> LoadResult:
    """Record what is new, then load what is not in the ledger. Run it again and only newer files load."""
    query = follow(spark, source, store)
    query.awaitTermination()
    return load_files(spark, arrived(spark, source, store), store, **options)


def load_stream(
    spark: SparkSession,
    source: str,
    store: str,
    *,
    files_per_batch: int | None = None,
    trigger: dict[str, object] | None = None,
    on_batch: Callable[[int, LoadResult], None] | None = None,
    **options,
) -> StreamingQuery:
    """Load the rows of new files below ``source`` as a stream, whatever their layouts and years; by default what is there now.

    A micro-batch is a load: its files are grouped by layout, one scan each, and the ledger publishes them together. A batch
    that runs again after an interruption finds in the ledger what it had published, and what it had only written
    is in no ledger, so nothing is stored twice. A file that fails does not stop the stream; ``on_batch`` is told, and a
    later `load` takes it up again, as empty files, which no file stream reports.
    """
    base = qualify(spark, source)

    def load_batch(batch: DataFrame, number: int) -> None:
        result = load_files(batch.sparkSession, classify(batch, base), store, **options)
        if on_batch:
            on_batch(number, result)

    stream = new_files(spark, source, files_per_batch).writeStream.foreachBatch(load_batch)
    return stream.option("checkpointLocation", f"{store.rstrip('/')}/_stream_checkpoint").trigger(**(trigger or {"availableNow": True})).start()


def follow_rows(
    spark: SparkSession, folder: str, layout: Layout, target: Dataset, ano: int, pattern: str = ANY_SOURCE
) -> DataFrame:
    """The canonical rows of one layout as a stream, for a sink of the caller's choice.

    All files below ``folder`` must share the layout: fields are bound to headers by position.
    """
    raw = (
        spark.readStream.schema(layout.struct)
        .options(**layout.options())
        .option("pathGlobFilter", pattern)
        .option("maxFileAge", NEVER)
        .option("recursiveFileLookup", True)
        .csv(escape_glob(folder))
    )
    rows = rows_of(marked(raw, layout, plain_names=False))
    return canonicalize(rows, target, list(layout.headers), ano, keep=[FILE])
