"""Finding source files and reading their attributes from their paths."""

from __future__ import annotations

import os
import re
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laborlake.sources.headers import decoded_uri, own_session

# Folder and file names under which the yearly extracts are published.
ESTABLISHMENT_FOLDER = "RAIS Estabelecimentos"
JOB_LINK_FOLDER = "RAIS Vínculos"
YEAR_FOLDER = r"(?i:RAIS\s+(\d{4}))"
EXTENSION = r"\.(?i:txt|comt)(?:\.gz)?"
ESTABLISHMENT_FILE = r"(?i:Estb(\d{4})ID)" + EXTENSION
STATE_FILE = r"(?i:([A-Z]{2})\d{4}ID)" + EXTENSION
REGION_FILE = r"(?i:RAIS_VINC_ID_)[^/]+" + EXTENSION

RAW_LISTING = T.StructType([T.StructField("path", T.StringType()), T.StructField("size_bytes", T.LongType())])


def escape_glob(path: str) -> str:
    """Spark's readers treat paths as glob patterns; quote what a file name may hold."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def hadoop_fs(spark: SparkSession, path: str):
    """The file system of ``path`` and its qualified form."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with this content; False if there is one already, which then stays as it is.

    Of several writers one succeeds, whatever their clocks say. Locally a hard link decides, elsewhere a rename, which must
    not replace a file, as on HDFS.
    """
    fs, target = hadoop_fs(spark, path)
    name = f".{target.getName()}-{uuid.uuid4().hex}"
    if fs.getUri().getScheme() == "file":
        folder = Path(target.getParent().toUri().getPath())
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(text, encoding="utf-8")
        try:
            os.link(folder / name, folder / target.getName())
        except FileExistsError:
            return False
        finally:
            (folder / name).unlink()
        return True
    part = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), name)
    with_text = fs.create(part, False)
    try:
        with_text.write(bytearray(text, "utf-8"))
    finally:
        with_text.close()
    made = not fs.exists(target) and fs.rename(part, target)
    if not made:
        fs.delete(part, False)
    return made


def qualify(spark: SparkSession, path: str) -> str:
    return hadoop_fs(spark, path)[1].toString()


def list_files(spark: SparkSession, base: str) -> DataFrame:
    """(path, size_bytes) of every file below the two dataset folders, empty ones included.

    The engine lists folders in tasks, as for any scan. Its reader leaves out empty files, and its index, whose names
    stay in the JVM, has them too. As everywhere in the engine, names that start with "_" or "." are hidden.
    """
    fs, root = hadoop_fs(spark, base)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    tops = [path_of(root, folder) for folder in (ESTABLISHMENT_FOLDER, JOB_LINK_FOLDER)]
    tops = [escape_glob(top.toString()) for top in tops if fs.exists(top) and fs.getFileStatus(top).isDirectory()]
    if not tops:
        return spark.createDataFrame([], RAW_LISTING)
    own = own_session(spark, {"spark.sql.sources.parallelPartitionDiscovery.threshold": "0"})
    found = own.read.format("binaryFile").option("recursiveFileLookup", True).load(tops)
    jvm = spark._jvm
    index = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(found._jdf.inputFiles())
    every = own._jsparkSession.createDataset(index, jvm.org.apache.spark.sql.Encoders.STRING())
    # Names are URIs there; without a host these have two slashes more than the engine's paths.
    name = F.regexp_replace(F.expr(decoded_uri("value")), "^([^:/]+):///", "$1:/")
    names = DataFrame(every.toDF(), own).select(name.alias("path"))
    return names.join(found.select("path", "length"), "path", "left").select("path", F.coalesce("length", F.lit(0)).cast("long").alias("size_bytes"))


def _fully(c: Column, pattern: str) -> Column:
    return c.rlike(f"^{pattern}$")


def classify(listing: DataFrame, base: str) -> DataFrame:
    """Source files among (path, size_bytes), with what their paths say; other paths are left out.

    Establishment files sit directly in their folder and carry the year in their name. Job-link files may
    sit at any depth below a year folder, whose year counts even if the name has another one. A compressed file goes by the
    name of the file in it.
    """
    root = base.rstrip("/") + "/"
    relative = F.substring(F.col("path"), len(root) + 1, 2**31 - 1)
    establishment = f"{ESTABLISHMENT_FOLDER}/{ESTABLISHMENT_FILE}"
    below_year = f"{JOB_LINK_FOLDER}/{YEAR_FOLDER}/(?:.*/)?"
    known = listing.where(F.startswith(F.col("path"), F.lit(root))).withColumn("_relative", relative)
    r = F.col("_relative")
    is_establishment = _fully(r, establishment)
    is_job_link = _fully(r, below_year + STATE_FILE) | _fully(r, below_year + REGION_FILE)
    state = F.upper(F.regexp_extract(r, f"^{below_year}{STATE_FILE}$", 2))
    return (
        known.where(is_establishment | is_job_link)
        .select(
            F.when(is_establishment, "estabelecimentos").otherwise("vinculos").alias("dataset"),
            F.when(is_establishment, F.regexp_extract(r, f"^{establishment}$", 1))
            .otherwise(F.regexp_extract(r, f"^{below_year}", 1))
            .cast("int")
            .alias("ano"),
            F.regexp_extract(r, r"([^/]+?)(?:\.gz)?$", 1).alias("filename"),
            "path",
            "size_bytes",
            F.when(~is_establishment & (state != ""), state).alias("uf_hint"),
            *[c for c in listing.columns if c not in ("path", "size_bytes")],
        )
    )


def discover(spark: SparkSession, base: str) -> DataFrame:
    """One row per source file below ``base``; none if the folders are missing."""
    return classify(list_files(spark, base), qualify(spark, base)).orderBy("dataset", "ano", "filename")


def filter_files(
    files: DataFrame, dataset: str | None = None, year: int | None = None, state: str | None = None
) -> DataFrame:
    """Keep one dataset, year or state. Regional and establishment files have no state and never match one."""
    if dataset:
        files = files.where(F.col("dataset") == dataset)
    if year:
        files = files.where(F.col("ano") == int(year))
    if state:
        files = files.where(F.col("uf_hint") == state.upper())
    return files
