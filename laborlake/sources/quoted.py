"""Files with line breaks inside quoted fields, read in as many tasks as any other file.

The engine cuts a file into byte ranges and gives each its lines, but a line may start inside quotes. Whether it does
depends only on the parity of all quotes before it. So the quotes of each range are counted first; running sums over the
ranges of a file, a row each, say whether a range starts inside quotes; and each task then joins its lines to records on
its own. A record that a range's end cuts in two leaves a piece in each range; these few pieces alone are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laborlake.sources.files import escape_glob
from laborlake.sources.headers import ENCODING

#: What a row of `_assembled` is: a record, or of one that is cut the end, a part between, or the start.
WHOLE, END, BETWEEN, START = range(4)


def lines_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, start (of the byte range), value, line: all lines, as bytes and as text, in the order of the file within a task."""
    text = spark.read.option("lineSep", "\n").text([escape_glob(p) for p in paths])
    line = F.decode(F.col("value").cast("binary"), ENCODING).alias("line")
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value", line)


def ranges_of(lines: DataFrame) -> DataFrame:
    """path, start, inside, cut: whether a byte range starts inside quotes, and whether a record goes on over either end."""
    # A quote is one byte, and no byte of another character.
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    odd = lines.groupBy("path", "start").agg((F.sum(quotes) % 2).alias("odd"))
    upto = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    after = F.sum("odd").over(upto) % 2 == 1
    inside = (F.sum("odd").over(upto) - F.col("odd")) % 2 == 1
    return odd.select("path", "start", inside.alias("inside"), (inside | after).alias("cut"))


def _assembled(lines: DataFrame) -> DataFrame:
    """Records and pieces of records from (path, start, line, inside); `first` marks what belongs to a file's header.

    Runs of lines are looked at together, and only lines that are no record of their own one by one.
    """

    # Local, so that it travels by value: executors need not have this package.
    def assemble(batches: Iterator, whole=WHOLE, end=END, between=BETWEEN, start_=START) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names = ["path", "start", "part", "first", "record"]
        at, inside, held, inherited, header = None, False, [], False, False

        def made(rows: list[tuple]):
            columns = list(zip(*rows, strict=True))
            types = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        def left_over() -> list[tuple]:
            return [(*at, between if inherited else start_, header, "\n".join(held))] if held else []

        for batch in batches:
            paths, starts = batch.column("path"), batch.column("start").to_numpy()
            keys = pc.run_end_encode(paths)
            edges = np.union1d(np.concatenate([[0], keys.run_ends.to_numpy()]), np.flatnonzero(np.diff(starts)) + 1)
            for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                now = (paths[low].as_py(), int(starts[low]))
                rows: list[tuple] = []
                if now != at:
                    if at is not None:
                        rows += left_over()
                    at, inside = now, batch.column("inside")[low].as_py()
                    held, inherited, header = [], inside, now[1] == 0
                lines = batch.column("line").slice(low, high - low)
                odd = pc.count_substring(lines, '"').to_numpy() % 2 == 1
                after = np.logical_xor.accumulate(odd) ^ inside
                before = np.concatenate([[inside], after[:-1]])
                alone = ~before & ~after
                if header and alone[0]:
                    alone[0] = False
                for i in np.flatnonzero(~alone).tolist():
                    held.append(lines[i].as_py())
                    if not after[i]:
                        rows.append((*at, end if inherited else whole, header, "\n".join(held)))
                        held, inherited, header = [], False, False
                inside = bool(after[-1])
                n = int(alone.sum())
                if n:
                    kept = lines.filter(pa.array(alone))
                    same = [pa.array([now[0]] * n), pa.array(np.full(n, now[1])), pa.array(np.full(n, whole, np.int32)), pa.array(np.zeros(n, bool))]
                    yield pa.RecordBatch.from_arrays([*same, kept], names)
                if rows:
                    yield made(rows)
        if at is not None and held:
            yield made(left_over())

    return lines.mapInArrow(assemble, "path string, start bigint, part int, first boolean, record string")


def records_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path (percent-encoded), record, open: every record of the files but their headers.

    `open` marks a last record whose quotes never close. A line ends with a line feed, before which one carriage return
    is dropped; breaks inside quotes stay as they are. Blank records are left out.
    """
    lines = lines_of(spark, paths)
    ranges = ranges_of(lines)
    # A row for each byte range of a batch, whose size is bounded: 32,768 rows for 4 TiB in ranges of 128 MiB.
    of = lambda some: lines.drop("value").join(F.broadcast(some), ["path", "start"])
    whole = _assembled(of(ranges.select("path", "start", "inside"))).where(F.col("part") == WHOLE)
    found = whole.where(~F.col("first")).select("path", "record", F.lit(False).alias("open"))
    pieces = _assembled(of(ranges.where("cut").select("path", "start", "inside"))).where(F.col("part") != WHOLE)
    order = Window.partitionBy("path").orderBy("start", "part")
    numbered = pieces.withColumn("_nth", F.sum((F.col("part") == START).cast("int")).over(order))
    listed = F.sort_array(F.collect_list(F.struct("start", "part", "record")))
    joined = numbered.groupBy("path", "_nth").agg(
        F.array_join(F.transform(listed, lambda p: p["record"]), "\n").alias("record"),
        F.bool_or("first").alias("first"),
        (~F.bool_or(F.col("part") == END)).alias("open"),
    )
    found = found.unionByName(joined.where(~F.col("first")).select("path", "record", "open"))
    return found.withColumn("record", F.regexp_replace("record", r"\r$", "")).where(F.trim(F.col("record")) != "")
