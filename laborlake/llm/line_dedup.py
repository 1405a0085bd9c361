"""Deleting later copies of maximal repeated line runs.

A run of consecutive lines that also starts at an earlier place, and has MIN_CHARS characters at least, is a copy; every line
that a copy covers is deleted. Each document is a sequence of line names (hashes of its lines; blank lines have none).
Doubling within the row names the runs of 2, 4, 8, ... lines that start at each line: the name of a run is made of the
names of its two halves. From these, every line gets the names of its two *units*, the shortest runs with MIN_CHARS
characters that start and that end there. Of the units with the same name, the first in the order of documents and lines is
the original, and the others are copies; overlapping and touching ones join into runs.

These are the lines of all copies of maximal repeated runs, no more and no fewer: a unit that is a copy is such a run itself,
and of a longer one each line is in the unit that starts at the first line, in the one that ends at the last, or starts a
unit that ends before the last. So no common prefix is longer than needed to be told, and no suffix is sorted: equality of names
stands in for the ranks of a suffix array and its intervals of common prefixes, for one shuffle instead of one per doubling.

Everything is DataFrame operations. One shuffle of names finds the copies, with partial aggregation, so a line that a third
of all documents share is a few rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Repeated runs of fewer characters, such as a heading or a list mark, say nothing.
MIN_CHARS = 40


def _levels(min_chars: int) -> int:
    """A unit has at most `min_chars` lines, as every line that counts has a character."""
    return max(1, min_chars).bit_length()


def _double(names: str, half: int, make) -> Column:
    last = F.size(names) - 1 - half
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: make(F.get(F.col(names), i), F.get(F.col(names), i + half)))


def _advance(level: int, min_chars: int):
    """Moves the end of a run on by 2 ** level lines if it is still too short then."""

    def step(s: Column) -> Column:
        chars = F.get(F.col(f"_c{level}"), s["end"])
        fits = chars.isNotNull() & (s["chars"] + chars < min_chars)
        return F.struct(
            s["start"].alias("start"),
            F.when(fits, s["end"] + (1 << level)).otherwise(s["end"]).alias("end"),
            F.when(fits, s["chars"] + chars).otherwise(s["chars"]).alias("chars"),
            F.when(fits, F.xxhash64(s["name"], F.get(F.col(f"_n{level}"), s["end"]))).otherwise(s["name"]).alias("name"),
        )

    return step


def units(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """_id, _text_hash, _from, _to (places among the lines that are not blank, inclusive), _first, _last (line numbers), _name: one row per line at which a unit starts, and one per line
    at which one ends, but for units of one line, which are both."""
    lines = F.split(F.col("text"), "\n", -1)
    rows = docs.filter(F.col("text").isNotNull()).select(
        F.col("doc_id").alias("_id"),
        F.xxhash64("text").alias("_text_hash"),
        F.filter(
            F.transform(lines, lambda x, i: F.struct(i.alias("at"), x.alias("line"))),
            lambda x: F.trim(x["line"]) != "",
        ).alias("_lines"),
    )

    def named(x: Column, i: Column) -> Column:
        line = x["line"]
        return F.struct(F.struct(i.alias("i"), x["at"].alias("n")).alias("at"), F.xxhash64(line).alias("name"), F.char_length(line).alias("chars"))

    rows = rows.select("_id", "_text_hash", F.transform("_lines", named).alias("_lines"))
    # Backwards, a unit that ends at a line starts there. Where all lines are units of their own, nothing else ends.
    short = F.exists("_lines", lambda x: x["chars"] < min_chars)
    ways = F.when(short, F.array("_lines", F.reverse("_lines"))).otherwise(F.array("_lines"))
    rows = rows.select("_id", "_text_hash", F.posexplode(ways).alias("_way", "_lines"))
    rows = rows.select(
        "_id",
        "_text_hash",
        "_way",
        F.transform("_lines", lambda x: x["at"]).alias("_at"),
        F.transform("_lines", lambda x: x["name"]).alias("_n0"),
        F.transform("_lines", lambda x: x["chars"]).alias("_c0"),
    )
    levels = _levels(min_chars)
    for k in range(levels):
        rows = rows.withColumns(
            {
                f"_n{k + 1}": _double(f"_n{k}", 1 << k, F.xxhash64),
                f"_c{k + 1}": _double(f"_c{k}", 1 << k, lambda a, b: a + b),
            }
        )

    starts = F.when(F.size("_n0") > 0, F.sequence(F.lit(0), F.size("_n0") - 1)).otherwise(F.array().cast("array<int>"))
    # Longest run from each line that is still too short, level by level from the longest; a unit has one line more.
    state = F.transform(
        starts,
        lambda i: F.struct(i.alias("start"), i.alias("end"), F.lit(0).alias("chars"), F.lit(0).cast("long").alias("name")),
    )
    rows = rows.withColumn("_state", state)
    for k in range(levels, -1, -1):
        rows = rows.withColumn("_state", F.transform("_state", _advance(k, min_chars)))
    full = F.filter("_state", lambda s: (s["end"] < F.size("_n0")) & ((F.col("_way") == 0) | (s["end"] > s["start"])))
    return rows.select(
        "_id",
        "_text_hash",
        F.explode(
            F.transform(
                full,
                lambda s: F.struct(
                    F.least(F.get("_at", s["start"]), F.get("_at", s["end"])).alias("_low"),
                    F.greatest(F.get("_at", s["start"]), F.get("_at", s["end"])).alias("_high"),
                    F.xxhash64(s["name"], F.get("_n0", s["end"]), s["end"] - s["start"], F.col("_way")).alias("_name"),
                ),
            )
        ).alias("_unit"),
    ).select(
        "_id", "_text_hash", F.col("_unit._low.i").alias("_from"), F.col("_unit._high.i").alias("_to"),
        F.col("_unit._low.n").alias("_first"), F.col("_unit._high.n").alias("_last"), "_unit._name",
    )


def copied_runs(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """_id, _text_hash, _from, _to (line numbers): maximal runs of lines that are covered by copies of earlier units."""
    found = units(docs, min_chars)
    place = F.struct("_id", "_text_hash", "_from")
    first = found.groupBy("_name").agg(F.min(place).alias("_least"), F.max(place).alias("_most"))
    first = first.filter("_least != _most").select(F.col("_name").alias("_repeated"), "_least")
    later = found.join(first, F.col("_name") == F.col("_repeated")).filter(place != F.col("_least"))
    # A document's own runs: as many rows as it has lines at most.
    own = Window.partitionBy("_id", "_text_hash").orderBy("_from", "_to")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    marked = later.select("_id", "_text_hash", "_from", "_to", "_first", "_last").distinct()
    marked = marked.withColumn("_new", (F.col("_from") > F.coalesce(F.max("_to").over(before) + 1, F.lit(-1))).cast("int"))
    marked = marked.withColumn("_run", F.sum("_new").over(own))
    return marked.groupBy("_id", "_text_hash", "_run").agg(F.min("_first").alias("_from"), F.max("_last").alias("_to")).drop("_run")


def _deduped(docs: DataFrame, min_chars: int) -> DataFrame:
    """`docs` with _kept_text, _n_lines, _n_removed and _n_runs."""
    runs = copied_runs(docs, min_chars).groupBy("_id", "_text_hash")
    runs = runs.agg(F.array_sort(F.collect_list(F.struct("_from", "_to"))).alias("_runs"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key_hash") == F.col("_text_hash"))
    rows = docs.withColumn("_key_hash", F.xxhash64("text")).join(runs, same, "left").withColumn("_all", F.split("text", "\n", -1))
    rows = rows.withColumn("_runs", F.when(F.col("text").isNotNull(), F.col("_runs")))
    starts = F.concat(F.array(F.lit(0)), F.transform("_runs", lambda r: r["_to"] + 1))
    ends = F.concat(F.transform("_runs", lambda r: r["_from"]), F.array(F.size("_all")))
    pieces = F.zip_with(starts, ends, lambda a, b: F.slice(F.col("_all"), a + 1, b - a))
    removed = F.aggregate("_runs", F.lit(0), lambda n, r: n + r["_to"] - r["_from"] + 1)
    return rows.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.when(F.col("_runs").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(pieces), "\n")).alias("_kept_text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("_all")).cast("long").alias("_n_lines"),
        F.coalesce(removed, F.lit(0)).cast("long").alias("_n_removed"),
        F.coalesce(F.array_size("_runs"), F.lit(0)).cast("long").alias("_n_runs"),
    )


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text without later copies, n_lines, n_removed_lines, n_runs: one row per row of `docs`.

    Documents follow each other by doc_id (null first), then by a hash of the text; rows that agree in both are one document
    and all keep the same lines. A null text stays null, with 0 lines; an empty text is one blank line. Blank lines never
    count as copies, but those between two deleted lines go with them. Copies within a document count as well. No row
    is dropped: a document whose every line is a later copy keeps an empty text. Other columns are ignored.
    """
    columns = {"_kept_text": "text", "_n_lines": "n_lines", "_n_removed": "n_removed_lines", "_n_runs": "n_runs"}
    done = _deduped(docs.select("doc_id", "text"), min_chars)
    return done.select("doc_id", *[F.col(a).alias(b) for a, b in columns.items()])


def without_copies(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """`docs` with all its columns, `text` as `dedup_lines` leaves it and `n_chars`, if there, counted anew."""
    changed = {"text": F.col("_kept_text"), "n_chars": F.char_length("_kept_text").cast("long")}
    done = _deduped(docs, min_chars)
    return done.select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
