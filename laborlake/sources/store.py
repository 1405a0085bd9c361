"""The output tables: Parquet partitioned by year, state, source file and version.

Every load of a file writes a version of its rows, which nobody sees until the ledger names it; from then on readers see it
instead of the one before, which stays where it is until a later load or `vacuum`. So a reader sees the rows of one
load or of the other, never both or none, and a load that was interrupted leaves nothing that anyone reads.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laborlake.model import DATASETS, Dataset
from laborlake.operators.ledger import Ledger
from laborlake.sources.delimited import FILE
from laborlake.sources.files import escape_glob, hadoop_fs

#: Folder of one load of one file.
VERSION = "carga"
PARTITIONS = ["ano", "uf", FILE, VERSION]
#: Versions that a read names in a filter, which prunes folders; more are joined.
PRUNED = 10_000


def table_path(store: str, target: Dataset) -> str:
    return f"{store.rstrip('/')}/{target.name}"


def stored_struct(target: Dataset, versioned: bool = False) -> T.StructType:
    """Canonical columns plus the source file, all declared: the state "00" must not be read as a number."""
    number = [T.StructField(VERSION, T.LongType())] if versioned else []
    return T.StructType([*target.struct.fields, T.StructField(FILE, T.StringType()), *number])


def spread(df: DataFrame) -> DataFrame:
    """Bring rows of one year, state and file together before a write, to get few and full output files.

    A rebalance rather than a plain repartition: the runtime cuts a state that holds a third of all rows
    into several tasks and joins small ones. Without adaptive execution nothing would cut it, so rows then
    stay where they are.
    """
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true") == "true"
    return df.hint("rebalance", "ano", "uf", FILE) if adaptive else df


def version(load: str, ano: str = "ano", name: str = FILE) -> Column:
    """The number of a file's rows of one load."""
    return F.xxhash64(F.lit(load), F.col(ano), F.col(name))


def write(df: DataFrame, store: str, target: Dataset, load: str) -> None:
    """Add canonical rows as versions of their own, which are not read before the ledger names them."""
    (
        df.select(*target.columns, FILE, version(load).alias(VERSION))
        .write.mode("append")
        .partitionBy(*PARTITIONS)
        .option("compression", "zstd")
        .parquet(table_path(store, target))
    )


def folders(spark: SparkSession, store: str, target: Dataset, versions: Iterable[tuple[int, str, int]]) -> list:
    """The partitions of the given (year, file name, version). Looks for these alone, whatever else is stored."""
    fs, root = hadoop_fs(spark, table_path(store, target))
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName

    def found(key: tuple[int, str, int]) -> list:
        ano, name, number = key
        return fs.globStatus(path_of(root, f"ano={int(ano)}/uf=*/{FILE}={escape_glob(escape(name))}/{VERSION}={int(number)}")) or []

    with ThreadPoolExecutor(16) as pool:
        return [status.getPath() for some in pool.map(found, sorted(set(versions))) for status in some]


def remove(spark: SparkSession, store: str, target: Dataset, versions: Iterable[tuple[int, str, int]]) -> int:
    """Delete every partition of the given (year, file name, version); returns how many there were."""
    fs, _ = hadoop_fs(spark, table_path(store, target))
    old = folders(spark, store, target, versions)
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(lambda path: fs.delete(path, True), old))
    return len(old)


def depth(spark: SparkSession, store: str, target: Dataset) -> int:
    """How many levels of folders a table has: none, 2 (state), 3 (source file) or 4 (version)."""
    fs, root = hadoop_fs(spark, table_path(store, target))

    def below(folder, level: int) -> int:
        if level == len(PARTITIONS):
            return level
        inner = [s.getPath() for s in fs.listStatus(folder) if s.isDirectory() and s.getPath().getName().startswith(f"{PARTITIONS[level]}=")]
        return max((below(inner[0], level + 1), level + 1)) if inner else level

    found = below(root, 0) if fs.exists(root) else 0
    return found if found >= 2 else 0


def read(
    spark: SparkSession,
    store: str,
    target: Dataset,
    *,
    years: Iterable[int] | None = None,
    states: Iterable[str] | None = None,
    lineage: bool = False,
) -> DataFrame:
    """The table, with its declared types; the source file only with ``lineage``.

    Only what the ledger names is read. Tables of other tools, without folders of versions or of source files, are read
    as they are; the source file is then NULL if there is no folder for it. Filters on ``ano`` and ``uf`` prune partitions
    anyway. Naming them here also saves listing the folders of other years and states, which counts on a store with very
    many partitions.
    """
    base = table_path(store, target)
    years = None if years is None else list(years)
    fs, root = hadoop_fs(spark, base)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    year_part = "ano=" + ("{" + ",".join(str(int(y)) for y in years) + "}" if years is not None else "*")
    state_part = "uf=" + ("{" + ",".join(states) + "}" if states is not None else "*")
    narrowed = years is not None or states is not None
    columns = [*target.columns, FILE] if lineage else target.columns
    if not fs.globStatus(path_of(root, f"{year_part}/{state_part}")):
        return spark.createDataFrame([], stored_struct(target)).select(*columns)
    versioned = depth(spark, store, target) == len(PARTITIONS)
    # Read before folders are listed: what is named by now is there, and stays when a later load is published.
    live = live_versions(spark, store, target, years) if versioned else []
    reader = spark.read.schema(stored_struct(target, versioned))
    if narrowed:
        df = reader.option("basePath", base).parquet(f"{base}/{year_part}/{state_part}")
    else:
        df = reader.parquet(base)
    if versioned and len(live) <= PRUNED:
        df = df.where(f"{VERSION} IN ({', '.join(map(str, live))})" if live else "false")
    elif versioned:
        df = df.join(spark.createDataFrame([(v,) for v in live], f"{VERSION} bigint"), VERSION, "left_semi")
    return df.select(*columns)


def live_versions(spark: SparkSession, store: str, target: Dataset, years: Iterable[int] | None = None) -> list[int]:
    """What the ledger names now: a number for each file."""
    done = Ledger(spark, store).list_done(target.name).where("version IS NOT NULL")
    if years is not None:
        done = done.where(F.col("ano").isin([int(y) for y in years]))
    return [r.version for r in done.select("version").collect()]


def rows_per_file(spark: SparkSession, store: str, target: Dataset, years: Iterable[int] | None = None) -> DataFrame:
    """(ano, arquivo, rows) of what is stored; reads Parquet footers only."""
    return (
        read(spark, store, target, years=years, lineage=True)
        .groupBy("ano", FILE)
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def rows_of_versions(
    spark: SparkSession, store: str, target: Dataset, versions: Iterable[tuple[int, str, int]]
) -> DataFrame:
    """The same of some versions, read or not, whose folders alone are listed and read."""
    paths = [path.toString() for path in folders(spark, store, target, versions)]
    if not paths:
        return spark.createDataFrame([], f"ano int, {FILE} string, rows bigint")
    base, reader = table_path(store, target), spark.read.schema(stored_struct(target, True))
    some = reader.option("basePath", base).parquet(*[escape_glob(p) for p in paths])
    return some.groupBy("ano", FILE).agg(F.count(F.lit(1)).alias("rows"))


def _listed(spark: SparkSession, store: str) -> DataFrame:
    """(path, length, modificationTime, version) of every Parquet file of the tables; lists, reads no content."""
    number = F.expr(f"try_cast(regexp_extract(path, '/{VERSION}=(-?[0-9]+)/', 1) AS BIGINT)")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load([path for d in DATASETS.values() if (path := _existing(spark, table_path(store, d)))])
        .select("path", "length", "modificationTime", number.alias("version"))
    )


def _existing(spark: SparkSession, path: str) -> str | None:
    fs, folder = hadoop_fs(spark, path)
    return escape_glob(folder.toString()) if fs.exists(folder) else None


def stored_files(spark: SparkSession, store: str) -> DataFrame:
    """(path, length) of every Parquet file of the tables that is read."""
    if not any(_existing(spark, table_path(store, d)) for d in DATASETS.values()):
        return spark.createDataFrame([], "path string, length bigint")
    live = Ledger(spark, store).live_versions().withColumn("live", F.lit(True))
    return _listed(spark, store).join(live, "version", "left").where("version IS NULL OR live").select("path", "length")


def vacuum(spark: SparkSession, store: str, hours: float = 7 * 24) -> int:
    """Delete versions that nobody reads and that are older than so many hours; returns how many folders.

    They are what later loads replaced and what interrupted ones left. The age must exceed the longest load, whose rows
    are not named yet, and the longest query, which may still read what was replaced.
    """
    if not any(_existing(spark, table_path(store, d)) for d in DATASETS.values()):
        return 0
    old = F.max("modificationTime") < F.current_timestamp() - F.expr(f"INTERVAL '{int(hours * 3600)}' SECOND")
    folder = F.regexp_extract("path", f"^(.*/{VERSION}=[^/]+)/", 1).alias("folder")
    files = _listed(spark, store).where("version IS NOT NULL").join(Ledger(spark, store).live_versions(), "version", "left_anti")
    dead = [r.folder for r in files.groupBy(folder).agg(old.alias("old")).where("old").select("folder").collect()]
    fs, _ = hadoop_fs(spark, store)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(lambda path: fs.delete(path_of(path), True), dead))
    return len(dead)
