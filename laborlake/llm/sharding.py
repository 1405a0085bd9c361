"""Contiguous shards of near equal bytes, from global prefix sums of the sizes.

Rows in the order of their id are cut into key ranges; each range sums its sizes, the few sums of all ranges are
added up, and a running sum inside each range then gives every row its place in the whole: the number of bytes and
rows before it. Shard s takes the rows whose middle byte lies in the s-th of equal parts of all bytes.

Only ids, sizes and checksums are shuffled, never texts. An id that many rows repeat is cut further by checksum.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laborlake.llm.common import tasks

#: Bytes that a row takes in a shard beside its text.
ROW_BYTES = 16
RANGES_PER_TASK = 4


def sizes(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id"),
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(text).alias("text_crc32"),
    )


def _range_of(rows: DataFrame, ranges: int) -> Column:
    """The key range of a row: 0 for no id; where several cuts fall on one id, its rows go on by checksum."""
    quantiles = [i / ranges for i in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx("doc_id", quantiles, 20 * ranges).alias("cuts")).first().cuts or []
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))]).cast("array<int>")
    cuts = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<long>") if cuts else F.array().cast("array<long>")

    def count(comes_before: Callable[[Column], Column]) -> Column:
        """How many of the cuts, which ascend, come before: found by steps of halves."""
        return F.aggregate(steps, F.lit(0), lambda n, s: F.when(comes_before(F.get(cuts, n + s - 1)), n + s).otherwise(n))

    below = count(lambda c: c < F.col("doc_id"))
    equal = count(lambda c: c <= F.col("doc_id")) - below + 1
    spread = F.floor(F.col("text_crc32") * equal / F.lit(2**32)).cast("int")
    return F.when(F.col("doc_id").isNull(), -1).otherwise(below + spread)


def shard_by_bytes(docs: DataFrame, shards: int) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: one row per row of `docs`.

    A text that is null counts like an empty one. Rows without an id come first. Rows that agree in id, size and
    checksum are alike in the result, whatever their order. Other columns are ignored. No rows, no result. A row
    larger than a shard leaves shards empty; nothing is split.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    rows = sizes(docs)
    rows = rows.withColumn("_range", _range_of(rows, RANGES_PER_TASK * tasks(docs.sparkSession)))
    ranges = rows.groupBy("_range").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(
        "_range",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(Window.partitionBy()).alias("_total"),
    )
    order = Window.partitionBy("_range").orderBy("doc_id", "text_crc32", "size")
    # One row per range: RANGES_PER_TASK times the number of shuffle partitions at most.
    placed = rows.join(F.broadcast(starts), "_range").select(
        "doc_id",
        "size",
        "text_crc32",
        (
            F.col("_bytes_before")
            + F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        ).alias("_start"),
        (F.col("_rows_before") + F.row_number().over(order) - 1).alias("_row"),
        "_total",
    )
    cut = placed.withColumn("shard", F.expr(f"cast((2 * _start + size) * {int(shards)} div (2 * _total) as int)"))
    first = cut.groupBy("shard").agg(F.min("_row").alias("_first"))
    return cut.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_row") - F.col("_first")).alias("slot")
    )


def write_shards(docs: DataFrame, shards: int, path: str) -> None:
    """The rows themselves, in one folder per shard, ordered by slot inside each file."""
    at = shard_by_bytes(docs, shards).dropDuplicates(["doc_id", "text_crc32", "size"])
    keyed = docs.withColumn("_crc", F.crc32(F.coalesce(F.col("text"), F.lit(""))))
    at = at.select(F.col("doc_id").alias("_id"), F.col("text_crc32").alias("_at_crc"), "shard", "slot")
    joined = keyed.join(at, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_crc") == F.col("_at_crc")), "left")
    joined = joined.drop("_id", "_crc", "_at_crc")
    joined.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
