"""A manifest that proves rows: hash trees whose levels are strings of hex digests, cut and hashed by SQL substrings.

The rows of a language, in the order of their ids, are cut into aligned blocks of `2 ** LEVELS` leaves. A block is one row
that holds each of its levels as one string of digests in a row; fixed-width substrings of two digests are hashed to
make the next level, and the substring beside a node is its sibling. The blocks' roots are the nodes of the next
round, until each language has one root; the languages' roots are a tree of the same kind. The way back down joins
blocks with the siblings above them, so no row is joined by its language, however many rows that has.

H is the lower-case hex SHA-256 of its inputs, concatenated; digests go in as hex text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laborlake.llm.common import tasks, written

#: Columns of a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of a block; it has 2 to this power leaves, and a leaf takes 64 characters.
LEVELS = 8
HEX = 64
#: Key ranges for each shuffle partition, in which rows get their ranks.
RANGES_PER_TASK = 2


def _field(value: Column) -> Column:
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.when(value.isNull(), F.lit("-")).otherwise(sized)


def leaf(**changed: Column) -> Column:
    """The digest of a row, some of its columns changed."""
    return F.sha2(F.concat(*[_field(changed.get(name, F.col(name))) for name in FIELDS]), 256)


def _levels_above(n: Column) -> Column:
    """How many times n nodes are halved, rounding up, until one is left."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def _first(count: Column, most: int) -> Column:
    """0, 1, 2, … of as many numbers as `count` says."""
    return F.slice(F.sequence(F.lit(0), F.lit(most - 1)), F.lit(1), count)


def _parents(level: Column) -> Column:
    last = F.floor((F.length(level) - 1) / (2 * HEX))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), last), lambda i: F.sha2(F.substr(level, i.cast("int") * (2 * HEX) + 1, F.lit(2 * HEX)), 256))
    return F.array_join(pairs, "")


def ranked(nodes: DataFrame, *order: str) -> DataFrame:
    """Adds rank, from 0 in each tree, and n, the tree's nodes. Equal rows may swap their ranks.

    Key ranges are sorted and their rows numbered; counts of ranges, a row for each range and tree in it, give the rest.
    """
    ranges = RANGES_PER_TASK * tasks(nodes.sparkSession)
    dealt = nodes.repartitionByRange(ranges, "tree", *order).sortWithinPartitions("tree", *order)
    row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = written(dealt.withColumns({"_part": F.spark_partition_id(), "_row": row}), "ranked")
    before = Window.partitionBy("_tree").orderBy("_range")
    starts = (
        placed.groupBy(F.col("tree").alias("_tree"), F.col("_part").alias("_range"))
        .agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.sum("_rows").over(before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_rows"))
        .withColumn("n", F.sum("_rows").over(Window.partitionBy("_tree")))
    )
    joined = placed.join(starts, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("_part") == F.col("_range")))
    rank = F.col("_before") + F.col("_row") - F.col("_first")
    return joined.withColumn("rank", rank).drop("_tree", "_range", "_part", "_row", "_first", "_rows", "_before")


def _blocks(nodes: DataFrame) -> DataFrame:
    """tree, block, n, nodes, levels (a string each, the block's leaves first and its root last)."""
    others = [c for c in nodes.columns if c not in ("tree", "rank", "n")]
    at = F.col("rank").bitwiseAND((1 << LEVELS) - 1).cast("int").alias("at")
    rows = nodes.select("tree", F.shiftright("rank", LEVELS).alias("block"), "n", F.struct(at, *others).alias("node"))
    grouped = rows.groupBy("tree", "block", "n").agg(F.sort_array(F.collect_list("node")).alias("nodes"))
    leaves = F.array_join(F.transform("nodes", lambda x: x["digest"]), "")
    steps = F.when(F.col("n") > 2**LEVELS, LEVELS).otherwise(_levels_above(F.col("n"))).cast("int")
    climb = F.aggregate(_first(steps, LEVELS), F.array(leaves), lambda got, _: F.concat(got, F.array(_parents(F.element_at(got, -1)))))
    return grouped.withColumn("levels", climb)


class Trees:
    """All trees of `nodes` (tree, rank, n, digest and whatever else belongs to a leaf), built upward at once."""

    def __init__(self, nodes: DataFrame):
        self.rounds: list[DataFrame] = []
        most = nodes.agg(F.max("n")).first()[0] or 0
        while True:
            self.rounds.append(written(_blocks(nodes), "blocks"))
            root = F.element_at("levels", -1).alias("digest")
            if most <= 2**LEVELS:
                self.roots = self.rounds[-1].select("tree", root)
                return
            over = lambda n: F.shiftright(n + (2**LEVELS - 1), LEVELS)
            nodes = self.rounds[-1].select("tree", F.col("block").alias("rank"), over(F.col("n")).alias("n"), root)
            most = -(-most // 2**LEVELS)

    def leaves(self, above: DataFrame) -> DataFrame:
        """The leaves with rank, n and `siblings`, and with what `above` says of their tree; its `siblings` come last."""
        kept = [c for c in above.columns if c not in ("tree", "siblings")]
        paths = above.withColumn("block", F.lit(0).cast("long"))
        for i, blocks in reversed(list(enumerate(self.rounds))):
            paths = paths.select(F.col("tree").alias("_tree"), F.col("block").alias("_block"), F.col("siblings").alias("_above"), *kept)
            joined = blocks.join(paths, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_block")))
            rows = joined.select("tree", "block", "n", "levels", "_above", *kept, F.explode("nodes").alias("node"))
            beside = lambda level: F.shiftright("node.at", level).bitwiseXOR(1) * HEX + 1
            own = [F.coalesce(F.substr(F.get("levels", F.lit(k)), beside(k), F.lit(HEX)), F.lit("")) for k in range(LEVELS)]
            # The root, a level of its own, has none beside it: the substring starts behind its end.
            rows = rows.withColumn("siblings", F.concat(*own, "_above"))
            rank = F.shiftleft("block", LEVELS) + F.col("node.at")
            if i:
                paths = rows.select("tree", rank.alias("block"), "siblings", *kept)
            else:
                paths = rows.select("tree", rank.alias("rank"), "n", "siblings", *kept, "node.*").drop("at")
        return paths


def _fold(state: Column, siblings: Column, rank: Column, n: Column) -> Column:
    """From a node up to its tree's root; `state` has the digest and where its siblings start."""

    def step(state: Column, level: Column) -> Column:
        at = F.call_function("shiftright", rank, level)
        paired = at.bitwiseXOR(F.lit(1).cast("long")) <= F.call_function("shiftright", n - 1, level)
        other = F.substr(siblings, state["start"], F.lit(HEX))
        left = F.concat(state["digest"], other)
        joined = F.when(~paired, state["digest"]).when(at % 2 == 0, left).otherwise(F.concat(other, state["digest"]))
        return F.struct(F.sha2(joined, 256).alias("digest"), (state["start"] + F.when(paired, HEX).otherwise(0)).alias("start"))

    return F.aggregate(_first(_levels_above(n).cast("int"), 63), state, step)


def folded(digest: Column) -> Column:
    """The root that a leaf of this digest would have, by the siblings of a manifest's row."""
    state = F.struct(digest.alias("digest"), F.lit(1).alias("start"))
    state = _fold(state, F.col("siblings"), F.col("rank"), F.col("n"))
    return _fold(state, F.col("siblings"), F.col("lang_rank"), F.col("n_langs"))["digest"]


def manifest(docs: DataFrame, **extra: Column) -> DataFrame:
    """doc_id, lang, leaf, rank, n, subroot, lang_rank, n_langs, root, siblings (digests, leaf's side first), and `extra`.

    One row per row of `docs`. `rank` of `n` in its language, `lang_rank` of `n_langs` languages. Null ids and languages
    come first; rows with equal ids are ordered by digest, and equal rows, which nothing tells apart, get a place
    each. Null columns count as `-`, so an empty text differs from none. `extra` are expressions on the columns of
    `docs`; all other columns are ignored. No rows, no result. An executor's loss repeats a round at most.
    """
    leaves = docs.select(F.col("lang").alias("tree"), "doc_id", leaf().alias("digest"), *[c.alias(name) for name, c in extra.items()])
    trees = Trees(ranked(written(leaves, "leaves"), "doc_id", "digest"))
    subroots = trees.roots.select(F.lit(0).alias("tree"), F.col("tree").alias("lang"), "digest")
    languages = Trees(ranked(subroots, "lang"))
    top = languages.roots.select("tree", F.col("digest").alias("root"), F.lit("").alias("siblings"))
    above = languages.leaves(top).select(
        F.col("lang").alias("tree"), "siblings", "root", F.col("digest").alias("subroot"), F.col("rank").alias("lang_rank"), F.col("n").alias("n_langs")
    )
    rows = trees.leaves(written(above, "languages"))
    return rows.select("doc_id", F.col("tree").alias("lang"), F.col("digest").alias("leaf"), "rank", "n", "subroot", "lang_rank", "n_langs", "root", "siblings", *extra)
