"""The ledger of loaded files: an append-only table whose newest row per file counts.

Every change is an entry with a number of its own. Its rows are written first, then a small file named by the number
publishes them; the number is taken by whoever makes that file first, and others go on to the next. So the order of
entries, not the writers' clocks, says what is newest, and rows that were never published count nowhere.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laborlake.functions.cleaning import gigabytes
from laborlake.sources.files import create_once, escape_glob, hadoop_fs
from laborlake.sources.headers import own_session

KEY = ["dataset", "ano", "filename"]

STRUCT = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("ano", T.IntegerType()),
        T.StructField("filename", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("size_bytes", T.LongType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("deleted", T.BooleanType()),
        T.StructField("version", T.LongType()),
    ]
)
#: Ledger rows take a few bytes in files and shuffles, and a hundred times as many where they are sorted by file to find the newest.
SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "8m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}
#: Of a published entry: its number, the folder of its rows, and the entries it stands for if it is a compaction.
LOG = "entry bigint, data string, upto bigint"


def current(entries: DataFrame) -> DataFrame:
    """Newest row per file, without files whose newest row is a removal.

    A maximum over a struct, so each task reduces its own rows before the shuffle; a window would send
    every version of a file to one task. Rows without a number of their entry are ordered by time.
    """
    order = [c for c in ("entry", "processed_at") if c in entries.columns]
    version = ["version"] if "version" in entries.columns else []
    newest = F.max(F.struct(*order, (~F.col("deleted")).alias("live"), "rows", "size_bytes", *version)).alias("n")
    return (
        entries.groupBy(*KEY)
        .agg(newest)
        .where("n.live")
        .select(*KEY, "n.rows", "n.size_bytes", "n.processed_at", *[f"n.{v}" for v in version])
    )


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """Ledger rows from a JSON array of entries, as other tools over the same sources keep them."""
    fields = [f for f in STRUCT if f.name not in ("deleted", "version")]
    return (
        spark.read.schema(T.StructType(fields))
        .option("multiLine", True)
        .json(path)
        .withColumn("deleted", F.lit(False))
    )


def pending(files: DataFrame, done: DataFrame) -> DataFrame:
    """Files that are not in the ledger. The engine picks the join: it broadcasts the ledger while small."""
    return files.join(done.select(*KEY), KEY, "left_anti")


def loaded(files: DataFrame, done: DataFrame) -> DataFrame:
    """Files that are in the ledger."""
    return files.join(done.select(*KEY), KEY, "left_semi")


def filter_done(done: DataFrame, dataset: str | None = None, year: int | None = None) -> DataFrame:
    if dataset is not None:
        done = done.where(F.col("dataset") == dataset)
    if year is not None:
        done = done.where(F.col("ano") == year)
    return done


def _totals() -> list:
    return [
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("size_bytes"),
    ]


def status(done: DataFrame) -> DataFrame:
    """Files, rows and source bytes per dataset and year."""
    return (
        done.groupBy("dataset", "ano")
        .agg(*_totals())
        .withColumn("source_gb", F.expr(gigabytes("size_bytes", 1)))
        .orderBy("dataset", "ano")
    )


def status_with_total(done: DataFrame) -> DataFrame:
    """The same with one more row, without dataset and year, for the grand total."""
    return (
        done.groupingSets([["dataset", "ano"], []], "dataset", "ano")
        .agg(*_totals())
        .withColumn("source_gb", F.expr(gigabytes("size_bytes", 1)))
        .orderBy(F.col("dataset").asc_nulls_last(), F.col("ano").asc_nulls_last())
    )


def compression(done: DataFrame, stored: DataFrame) -> DataFrame:
    """Source and Parquet bytes and their ratio, which is NULL while there is no source."""
    both = done.select(F.col("size_bytes").alias("source"), F.lit(0).cast("long").alias("parquet")).unionByName(
        stored.select(F.lit(0).cast("long").alias("source"), F.col("length").alias("parquet"))
    )
    return (
        both.agg(
            F.coalesce(F.sum("source"), F.lit(0)).alias("source_bytes"),
            F.coalesce(F.sum("parquet"), F.lit(0)).alias("parquet_bytes"),
        )
        .withColumn("source_gb", F.expr(gigabytes("source_bytes", 1)))
        .withColumn("parquet_gb", F.expr(gigabytes("parquet_bytes", 2)))
        .withColumn("ratio", F.try_divide("parquet_bytes", "source_bytes"))
        .withColumn("percent", F.concat(F.format_number(F.col("ratio") * 100, 1), F.lit("%")))
    )


class Ledger:
    """The ledger table of one store."""

    def __init__(self, spark: SparkSession, store: str) -> None:
        self.spark = own_session(spark, SETTINGS)
        self.path = f"{store.rstrip('/')}/_ledger"

    def log(self) -> list[Row]:
        """What is published: a row for each load, removal or compaction since the last compaction."""
        fs, folder = hadoop_fs(self.spark, f"{self.path}/log")
        if not fs.exists(folder):
            return []
        found = self.spark.read.schema(LOG).json(f"{self.path}/log").collect()
        upto = max((r.upto for r in found if r.upto is not None), default=0)
        return [r for r in found if r.entry > upto and (r.upto is None or r.upto == upto)]

    def entries(self) -> DataFrame:
        """All rows with the number of their entry; 0 for those of a ledger without numbers."""
        parts = []
        if found := self.log():
            rows = self.spark.read.schema(STRUCT).parquet(*[f"{self.path}/data/{r.data}" for r in found])
            # A compaction has the rank of the last entry that it stands for.
            numbers = [(r.data, r.entry if r.upto is None else r.upto) for r in found]
            folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
            # Joined by a shuffle, all rows of an entry would meet in one task.
            known = F.broadcast(self.spark.createDataFrame(numbers, "data string, entry bigint"))
            parts.append(rows.withColumn("data", folder).join(known, "data").drop("data"))
        fs, root = hadoop_fs(self.spark, self.path)
        if fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(root, "*.parquet")):
            plain = self.spark.read.schema(STRUCT).parquet(f"{escape_glob(root.toString())}/*.parquet")
            parts.append(plain.withColumn("entry", F.lit(0).cast("long")))
        if not parts:
            return self.spark.createDataFrame([], T.StructType([*STRUCT, T.StructField("entry", T.LongType())]))
        return reduce(DataFrame.unionByName, parts)

    def current(self) -> DataFrame:
        return current(self.entries())

    def live_versions(self, dataset: str | None = None) -> DataFrame:
        """(version) of what readers may see."""
        return filter_done(self.current(), dataset).where("version IS NOT NULL").select("version")

    def list_done(self, dataset: str | None = None, year: int | None = None) -> DataFrame:
        return filter_done(self.current(), dataset, year)

    def entry(self, dataset: str, ano: int, filename: str) -> DataFrame:
        """The row of one file, if it is done."""
        return self.list_done(dataset, ano).where(F.col("filename") == filename)

    def is_done(self, dataset: str, ano: int, filename: str) -> bool:
        return not self.entry(dataset, ano, filename).isEmpty()

    def count(self) -> int:
        return self.current().count()

    def mark_done(self, files: DataFrame) -> None:
        """Record files with their ``rows`` and ``size_bytes``, and the ``version`` of their rows in the tables, if any."""
        version = F.col("version") if "version" in files.columns else F.lit(None)
        self._append(files.select(*KEY, "rows", "size_bytes", version.cast("long").alias("version")), deleted=False)

    def remove(self, files: DataFrame) -> None:
        """Record that files are no longer done."""
        nothing = F.lit(None).cast("long")
        self._append(files.select(*KEY, *[nothing.alias(c) for c in ("rows", "size_bytes", "version")]), deleted=True)

    def adopt(self, entries: DataFrame) -> None:
        """Take over entries with the time they carry, but for files of which a later one is listed."""
        listed = self.current().select(*KEY, F.col("processed_at").alias("_at"))
        late = entries.join(listed, KEY, "left").where("_at IS NULL OR processed_at >= _at").drop("_at")
        self._publish(late.withColumn("version", F.lit(None)))

    def _append(self, rows: DataFrame, deleted: bool) -> None:
        self._publish(rows.select("*", F.current_timestamp().alias("processed_at"), F.lit(deleted).alias("deleted")))

    def compact(self) -> None:
        """Put the newest row per file in place of all rows so far.

        The new entry says up to which number it stands for others, so what another writer publishes meanwhile still counts
        after it. The old files go when it is published; an interruption leaves files that nothing refers to.
        """
        old = self.log()
        fs, root = hadoop_fs(self.spark, self.path)
        path_of = self.spark._jvm.org.apache.hadoop.fs.Path
        plain = [status.getPath() for status in fs.globStatus(path_of(root, "*.parquet")) or []]
        if not old and not plain:
            return
        upto = max((r.entry for r in old), default=0)
        self._publish(self.current().withColumn("deleted", F.lit(False)), upto)
        for path in plain:
            fs.delete(path, False)
        for r in old:
            fs.delete(path_of(root, f"log/{r.entry:020d}.json"), False)
            fs.delete(path_of(root, f"data/{r.data}"), True)

    def _publish(self, entries: DataFrame, upto: int | None = None) -> None:
        """Write rows, in few files, and publish them under the next number that nobody has."""
        rows = entries.select(*[F.col(f.name).cast(f.dataType) for f in STRUCT])
        data = uuid.uuid4().hex
        rows.hint("rebalance").write.parquet(f"{self.path}/data/{data}")
        fs, folder = hadoop_fs(self.spark, f"{self.path}/log")
        taken = [status.getPath().getName() for status in fs.listStatus(folder)] if fs.exists(folder) else []
        number = max((int(n[:20]) for n in taken if n[:20].isdigit()), default=0) + 1
        while not create_once(self.spark, f"{self.path}/log/{number:020d}.json", json.dumps({"entry": number, "data": data, "upto": upto})):
            number += 1
