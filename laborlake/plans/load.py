"""Loading source files into a store: only what is new, or again on demand, one bad file not stopping the rest."""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from laborlake.model import Dataset, dataset
from laborlake.operators.canonical import bind, clean
from laborlake.operators.conformance import check_headers
from laborlake.operators.ledger import KEY, Ledger, pending
from laborlake.sources import store as tables
from laborlake.sources.delimited import CUT, FILE, TOO_LONG, Layout, scan
from laborlake.sources.files import discover, filter_files
from laborlake.sources.headers import COMPRESSED, own_session, with_headers

LOADED = "dataset string, ano int, filename string, rows bigint, size_bytes bigint"
ERRORS = "dataset string, ano int, filename string, error string"
DROPPED = "dataset string, ano int, filename string, dropped_rows bigint"
BATCH_BYTES = 4 * 2**40

# Fifty cleaned columns make one generated method too long for the JVM to compile, and interpreted it runs
# at a third of the speed. Without whole-stage generation the projection is split into short methods.
# Rebalanced rows are cut into pieces of the second size, so that files come out neither tiny nor huge.
WRITE_SETTINGS = {
    "spark.sql.codegen.wholeStage": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}
#: So many bytes of text are taken to be in a byte of a compressed file, when tasks are given their files.
UNPACKED = 4


@dataclass(frozen=True)
class Source:
    """One file to load."""

    dataset: str
    ano: int
    filename: str
    path: str
    size_bytes: int
    uf_hint: str | None

    @property
    def key(self) -> tuple[str, int, str]:
        return self.dataset, self.ano, self.filename


@dataclass
class LoadResult:
    """What a run did, file by file; rows of the tables themselves never come here."""

    spark: SparkSession
    found: int = 0
    rows: dict[Source, int] = field(default_factory=dict)
    failed: dict[Source, str] = field(default_factory=dict)
    long_rows: dict[Source, int] = field(default_factory=dict)

    @property
    def total_rows(self) -> int:
        return sum(self.rows.values())

    @property
    def loaded(self) -> DataFrame:
        return self.spark.createDataFrame([(*s.key, n, s.size_bytes) for s, n in self.rows.items()], LOADED)

    @property
    def errors(self) -> DataFrame:
        return self.spark.createDataFrame([(*s.key, e) for s, e in self.failed.items()], ERRORS)

    @property
    def dropped(self) -> DataFrame:
        """Rows with more fields than their header, which are not stored, by file."""
        return self.spark.createDataFrame([(*s.key, n) for s, n in self.long_rows.items()], DROPPED)


@dataclass(frozen=True)
class Options:
    force: bool = False
    strict: bool = False
    shape: str = "auto"
    multiline: bool = False
    batch_bytes: int = BATCH_BYTES

    def __post_init__(self) -> None:
        if self.shape not in ("auto", "direct", "spread"):
            raise ValueError(f"shape must be auto, direct or spread, not {self.shape!r}")


def load(
    spark: SparkSession,
    source: str,
    store: str,
    *,
    dataset: str | None = None,
    year: int | None = None,
    state: str | None = None,
    **options,
) -> LoadResult:
    """Load the files below ``source`` that the store's ledger does not list yet.

    ``force`` loads listed files again and replaces their rows, which readers see until the new ones are complete.
    ``strict`` refuses files that lack a required column instead of filling it with NULL, and files with rows longer than
    the header instead of dropping these. Files with line breaks inside quotes are noticed and read again as such;
    ``multiline`` takes all files for such from the start. ``shape`` says how rows are brought together before the write:
    "direct" and "auto" not at all, "spread" by year, state and file, which gives fewer files for a shuffle of all rows.
    """
    files = filter_files(discover(spark, source), dataset, year, state)
    return load_files(spark, files, store, **options)


def load_files(spark: SparkSession, files: DataFrame, store: str, **options) -> LoadResult:
    """The same for files given as a frame (dataset, ano, filename, path, size_bytes, uf_hint)."""
    opts = Options(**options)
    ledger = Ledger(spark, store)
    files = files.select(*KEY, "path", "size_bytes", "uf_hint")
    todo = files if opts.force else pending(files, ledger.current())
    # File names only: what the engine's own scan planning brings to the driver as well.
    plan = [Source(**r.asDict()) for r in todo.orderBy(*KEY).collect()]
    refuse_collisions(plan)
    result = LoadResult(spark, found=len(plan))
    for batch in batches(plan, opts.batch_bytes):
        load_batch(spark, batch, store, ledger, opts, result)
    return result


def refuse_collisions(plan: Iterable[Source]) -> None:
    """A file is known by dataset, year and name; two such files would replace each other's rows."""
    seen: dict[tuple, Source] = {}
    for s in plan:
        other = seen.setdefault(s.key, s)
        if other is not s:
            raise ValueError(f"two files for {s.key}: {other.path} and {s.path}")


def batches(plan: list[Source], limit: int) -> Iterable[list[Source]]:
    """Runs of files of a bounded total size. Each becomes durable on its own, so an interrupted load
    repeats at most one batch."""
    batch: list[Source] = []
    size = 0
    for s in plan:
        if batch and size + s.size_bytes > limit:
            yield batch
            batch, size = [], 0
        batch.append(s)
        size += s.size_bytes
    if batch:
        yield batch


def load_batch(
    spark: SparkSession, batch: list[Source], store: str, ledger: Ledger, opts: Options, result: LoadResult
) -> None:
    """Write new versions of the files, count what was written, and publish all that succeeded by one entry of the ledger.

    Until then readers see what they saw before, and so they do after an interruption anywhere. Versions that earlier
    loads replaced are deleted first; the one replaced now stays for those who are reading it.
    """
    by_dataset: dict[str, list[Source]] = defaultdict(list)
    for s in batch:
        by_dataset[s.dataset].append(s)

    done: dict[Source, Stored] = {}
    for name, sources in by_dataset.items():
        target = dataset(name)
        if tables.depth(spark, store, target) not in (0, len(tables.PARTITIONS)):
            raise ValueError(f"{tables.table_path(store, target)} has no folders of versions; load into another store")
        remove_replaced(spark, sources, store, target, ledger)
        done.update({s: Stored(0, "") for s in sources if s.size_bytes == 0})
        layouts, odd = layouts_of(spark, [s for s in sources if s.size_bytes > 0], target, opts, result.failed)
        breaks = set(layouts) if opts.multiline else cut_files(spark, [s for s in layouts if layouts[s] in odd], layouts)
        done.update(write_group(spark, list(layouts), layouts, target, store, opts.shape == "spread", opts, result, breaks))

    if done:
        result.rows.update({s: stored.rows for s, stored in done.items()})
        rows = [(*s.key, stored.rows, s.size_bytes, stored.load) for s, stored in done.items()]
        entry = spark.createDataFrame(rows, f"{LOADED}, load string")
        ledger.mark_done(entry.withColumn("version", F.xxhash64("load", "ano", "filename")))


def remove_replaced(spark: SparkSession, sources: list[Source], store: str, target: Dataset, ledger: Ledger) -> None:
    """Delete versions of the files that the ledger named once and names no more."""
    entries = ledger.entries().where("version IS NOT NULL").where(F.col("dataset") == target.name)
    keys = spark.createDataFrame([s.key for s in sources], "dataset string, ano int, filename string")
    old = entries.join(keys, KEY, "left_semi").join(ledger.live_versions(target.name), "version", "left_anti")
    named = {(r.ano, r.filename, r.version) for r in old.select("ano", "filename", "version").distinct().collect()}
    if named:
        tables.remove(spark, store, target, named)


#: Errors of the engine that say which file could not be read.
READ_ERRORS = ("FAILED_READ_FILE", "PATH_NOT_FOUND")


def _causes(error: BaseException) -> Iterator[tuple[str | None, dict[str, str]]]:
    """Condition and parameters of an error of the engine and of what caused it."""
    if hasattr(error, "getCondition"):
        yield error.getCondition(), dict(error.getMessageParameters() or {})
    thrown = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while thrown is not None:
        if thrown.getClass().getName().startswith("org.apache.spark") and hasattr(thrown, "getCondition"):
            try:
                yield thrown.getCondition(), dict(thrown.getMessageParameters())
            except Py4JError:  # an exception without conditions
                pass
        thrown = thrown.getCause()


def plain_path(path: str) -> str:
    """A path without the slashes that stand for no host."""
    return re.sub("^([^:/]+):/+(?=/[^/])", r"\1:", path)


def named_in(error: BaseException, sources: list[Source]) -> list[Source]:
    """The file that the engine could not read, by the error's own parameter. None if the error is about no file.

    Its message, in which other names may stand, says nothing here.
    """
    paths = set()
    for condition, parameters in _causes(error):
        if condition and condition.startswith(READ_ERRORS) and parameters.get("path"):
            path = parameters["path"]
            paths |= {plain_path(path), plain_path(unquote(path))}
    return [s for s in sources if plain_path(s.path) in paths]


def message(error: Exception) -> str:
    text = str(error).strip()
    return text.splitlines()[0] if text else type(error).__name__


def layouts_of(
    spark: SparkSession, sources: list[Source], target: Dataset, opts: Options, failed: dict[Source, str]
) -> tuple[dict[Source, Layout], set[Layout]]:
    """The layout of each file, from its header, and layouts of which a file has odd quotes in a line read along with it.

    Files without a usable header fail here.
    """
    by_path = {s.path: s for s in sources}
    if not by_path:
        return {}, set()
    paths = spark.createDataFrame([(s.path, s.size_bytes) for s in sources], "path string, size_bytes bigint")
    found = with_headers(paths, odd=True).withColumn("layout", F.xxhash64("sep", "headers")).cache()
    # Layouts are few, however many files share them; of a file only its layout's number comes here.
    few = found.groupBy("layout", "sep", "headers").agg(F.bool_or("odd").alias("odd")).collect()
    known = {r.layout: Layout(r.sep, tuple(r.headers)) for r in few}
    odd = {known[r.layout] for r in few if r.odd}
    layouts: dict[Source, Layout] = {}
    for r in found.select("path", "error", "layout").collect():
        if r.error is None:
            layouts[by_path[r.path]] = known[r.layout]
        else:
            failed[by_path[r.path]] = r.error
    found.unpersist()
    for s in [s for s, layout in layouts.items() if not layout.headers]:
        failed[s] = "no header"
        del layouts[s]
    if opts.strict and layouts:
        headers = {layout.headers for layout in layouts.values()}
        checked = check_headers(spark.createDataFrame([(list(h),) for h in headers], "headers array<string>"), target)
        missing = {tuple(r.headers): r.missing_required for r in checked.where(~F.col("is_ok")).collect()}
        for s in [s for s, layout in layouts.items() if layout.headers in missing]:
            failed[s] = f"required columns missing: {', '.join(missing[layouts[s].headers])}"
            del layouts[s]
    return layouts, odd


def write_session(spark: SparkSession, sources: list[Source]) -> SparkSession:
    """A session to write these files in, whose tasks take as much text of compressed files as of others."""
    settings = dict(WRITE_SETTINGS)
    if any(s.path.endswith(COMPRESSED) for s in sources):
        most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
        settings["spark.sql.files.maxPartitionBytes"] = str(max(1, most // UNPACKED))
    return own_session(spark, settings)


def cut_files(spark: SparkSession, suspects: list[Source], layouts: dict[Source, Layout]) -> set[Source]:
    """The files among these that hold line breaks inside quotes, by the marks that the plain scan gives their rows.

    Known before the write, such files need not be written twice. Files that are not asked about are noticed by the write.
    """
    try:
        counts = count_marked(write_session(spark, suspects), suspects, layouts, False)
    except Exception as error:
        if not named_in(error, suspects):
            raise
        return set()  # the write meets that file again and sets it aside
    return {s for s, (_, n_cut) in counts.items() if n_cut}


def scans(
    spark: SparkSession, sources: list[Source], layouts: dict[Source, Layout], breaks: bool
) -> Iterable[tuple[int, Layout, DataFrame]]:
    """One scan per layout and year: fields are bound to headers by position, and the year is then a literal."""
    groups: dict[tuple[int, Layout], list[Source]] = defaultdict(list)
    for s in sources:
        groups[s.ano, layouts[s]].append(s)
    for (ano, layout), members in groups.items():
        plain = all(is_plain(s.filename) for s in members)
        yield ano, layout, scan(spark, [s.path for s in members], layout, quoted_breaks=breaks, plain_names=plain)


def text_rows(
    spark: SparkSession, sources: list[Source], layouts: dict[Source, Layout], target: Dataset, breaks: bool = False
) -> DataFrame:
    """All rows of the files under canonical names, still as text, with file name and marks."""
    frames = [
        bind(raw, target, list(layout.headers), ano, keep=[FILE, TOO_LONG, CUT])
        for ano, layout, raw in scans(spark, sources, layouts, breaks)
    ]
    return reduce(DataFrame.unionByName, frames)


def is_plain(name: str) -> bool:
    """Whether a file name reads the same percent-encoded."""
    return name.isascii() and all(ch.isalnum() or ch in "-_.~" for ch in name)


@dataclass(frozen=True)
class Stored:
    """Rows of a file in the tables, and the load that wrote them."""

    rows: int
    load: str


def write_group(
    spark: SparkSession,
    sources: list[Source],
    layouts: dict[Source, Layout],
    target: Dataset,
    store: str,
    spread: bool,
    opts: Options,
    result: LoadResult,
    breaks: set[Source],
) -> dict[Source, Stored]:
    """Write files in one job, those with line breaks inside quotes in another; returns what is stored of each.

    A file that the engine cannot read is set aside, and the others are tried again. Any other error says nothing about a
    file and ends the load; what it has left is in no ledger.
    """
    left = sources
    done: dict[Source, Stored] = {}
    while left:
        now = [s for s in left if s not in breaks] or left
        try:
            stored, again = write_files(spark, now, layouts, target, store, spread, opts, result, now[0] in breaks)
        except Exception as error:
            bad = named_in(error, now)
            if not bad:
                raise
            result.failed.update({s: message(error) for s in bad})
            left = [s for s in left if s not in set(bad)]
            continue
        done.update(stored)
        breaks = breaks | set(again)
        left = [s for s in left if s not in set(now)] + again
    return done


def write_files(
    spark: SparkSession,
    sources: list[Source],
    layouts: dict[Source, Layout],
    target: Dataset,
    store: str,
    spread: bool,
    opts: Options,
    result: LoadResult,
    breaks: bool,
) -> tuple[dict[Source, Stored], list[Source]]:
    """What is stored of each file, and files with line breaks inside quotes, which are to be read as such."""
    load = uuid.uuid4().hex
    own = write_session(spark, sources)
    seen = Observation()
    # The observation also keeps the cleaning above the union, to be compiled once and not per scan.
    # Names of files with marked rows: as a rule none.
    odd = F.collect_set(F.when(F.col(TOO_LONG) | F.col(CUT), F.struct(F.col("ano"), F.col(FILE))))
    text = text_rows(own, sources, layouts, target, breaks).observe(seen, odd.alias("odd"))
    rows = clean(text.where(~F.col(TOO_LONG)), target, keep=[FILE])
    tables.write(tables.spread(rows) if spread else rows, store, target, load)
    versions = versions_of(spark, sources, load)
    stored = rows_stored(spark, sources, target, store, versions)
    # Nothing stored: the plan may have been emptied, and what it observes with it.
    names = {(r[0], r[1]) for r in seen.get["odd"]} if any(stored.values()) else {(s.ano, s.filename) for s in sources}
    suspects = [s for s in stored if (s.ano, s.filename) in names]
    again = []
    for s, (n_long, n_cut) in count_marked(own, suspects, layouts, breaks).items():
        if n_cut and not breaks:
            again.append(s)
        elif n_cut:
            result.failed[s] = "layout: quotes that never close"
        elif n_long and opts.strict:
            result.failed[s] = f"layout: {n_long} rows have more fields than the header"
        else:
            if n_long:
                result.long_rows[s] = n_long
            continue
        tables.remove(spark, store, target, [(s.ano, s.filename, versions[s])])
        del stored[s]
    return {s: Stored(n, load) for s, n in stored.items()}, again


def versions_of(spark: SparkSession, sources: list[Source], load: str) -> dict[Source, int]:
    names = spark.createDataFrame([(s.ano, s.filename) for s in sources], f"ano int, {FILE} string")
    found = {(r.ano, r[FILE]): r.version for r in names.select("*", tables.version(load).alias("version")).collect()}
    return {s: found[s.ano, s.filename] for s in sources}


def rows_stored(
    spark: SparkSession, sources: list[Source], target: Dataset, store: str, versions: dict[Source, int]
) -> dict[Source, int]:
    counts = tables.rows_of_versions(spark, store, target, [(s.ano, s.filename, versions[s]) for s in sources])
    found = {(r.ano, r[FILE]): r.rows for r in counts.collect()}
    return {s: found.get((s.ano, s.filename), 0) for s in sources}


def count_marked(
    spark: SparkSession, suspects: list[Source], layouts: dict[Source, Layout], breaks: bool
) -> dict[Source, tuple[int, int]]:
    """Over-long and cut rows per file, by a second scan of files that are known to have some."""
    if not suspects:
        return {}
    # A data column takes part because the reader refuses to be asked for broken rows alone.
    marks = [
        raw.selectExpr(f"{ano} AS ano", FILE, TOO_LONG, CUT, "_c0")
        for ano, _, raw in scans(spark, suspects, layouts, breaks)
    ]
    counts = (
        reduce(DataFrame.unionByName, marks)
        .groupBy("ano", FILE)
        .agg(F.count_if(F.col(TOO_LONG)).alias("n"), F.count_if(F.col(CUT)).alias("cut"), F.count("_c0").alias("first_fields"))
    )
    found = {(r.ano, r[FILE]): (r.n, r.cut) for r in counts.collect()}
    return {s: found.get((s.ano, s.filename), (0, 0)) for s in suspects}
