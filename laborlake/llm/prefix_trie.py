"""The trie of conversations' first turns, by cutting sequences at half depth, again and again.

Every conversation is cut at powers of two into pieces (13 turns: 8, 4, 1), and the prefix that ends at a cut is named.
Equal pieces under one name become one row with the number of their members. Level by level, each distinct piece is cut
at half its depth: the upper half is a piece of the upper trie, where it meets others and is counted with them, and the
lower half hangs below the name of the cut. All pieces of a level, upper tries and lower forests, are cut in one shuffle,
so a shared prefix goes on as one row however many conversations have it, and depth costs its logarithm in rounds.
Pieces of one turn are the trie's nodes.

Totals go up by the same cuts. A node's value is grafted on the few cut prefixes above it, sums of a cut prefix are
handed to both halves of the piece that ends there, and what reaches a piece of one turn is the total of its subtree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborlake.llm.common import tasks, written

#: Hex characters of a name or a turn's digest: 128 bits.
DIGITS = 32
#: Name of the root.
ROOT = ""
NOBODY = hashlib.sha256(b"").hexdigest()

_CHAIN = "array<struct<name:string,level:int>>"
_TURNS = "array<struct<digest:string,chars:int>>"
_PIECE = f"struct<start:string,end:string,level:int,depth:int,chain:{_CHAIN},turns:{_TURNS}>"


def _digest(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat(*parts), 256), 1, DIGITS)


def _name(start: Column, turns: Column) -> Column:
    """Name of the prefix that goes on from `start` by these turns."""
    return _digest(start, F.array_join(F.transform(turns, lambda t: t["digest"]), ""))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, turns (digest, chars): the turns of each conversation in order, null first; equal numbers go by digest."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    sized = _digest(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter("conv_id IS NOT NULL").select("conv_id", F.struct("turn", sized.alias("digest"), F.length(text).alias("chars")).alias("turn"))
    listed = F.sort_array(F.collect_list("turn"))
    return turns.groupBy("conv_id").agg(F.transform(listed, lambda t: F.struct(t["digest"], t["chars"])).cast(_TURNS).alias("turns"))


def with_shared_openings(convs: DataFrame, group: int, opening: Column, most: int) -> DataFrame:
    """Conversations whose first `opening` turns (`most` at most) are those of the first conversation of their hundred,
    or whatever `group` is; all its turns if it has fewer, none if there is no such conversation."""
    of = (F.col("conv_id") - F.col("conv_id") % group).alias("_of")
    firsts = convs.filter(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("_of"), F.slice("turns", 1, most).alias("_first"))
    rows = convs.select("conv_id", "turns", of, opening.cast("int").alias("_h")).join(firsts, "_of", "left")
    head = F.slice(F.coalesce("_first", F.array().cast(_TURNS)), F.lit(1), F.col("_h"))
    rest = F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns") - F.col("_h"), F.lit(0)))
    return rows.select("conv_id", F.concat(head, rest).alias("turns"))


def _cut(turns: Column) -> Column:
    """The pieces of a sequence, and the name of its end."""
    levels = F.when(F.size(turns) > 0, F.sequence(F.length(F.bin(F.size(turns))) - 1, F.lit(0), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    none = F.struct(F.lit(0).alias("depth"), F.lit(ROOT).alias("end"), F.array().cast(_CHAIN).alias("chain"), F.array().cast(f"array<{_PIECE}>").alias("pieces"))

    def step(got: Column, level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1), level)
        part = F.slice(turns, got["depth"] + 1, size)

        def longer(end: Column) -> Column:
            piece = F.struct(got["end"].alias("start"), end.alias("end"), level.alias("level"), got["depth"].alias("depth"), got["chain"].alias("chain"), part.alias("turns"))
            return F.struct(
                (got["depth"] + size).alias("depth"),
                end.alias("end"),
                F.concat(got["chain"], F.array(F.struct(end.alias("name"), level.alias("level")))).alias("chain"),
                F.concat(got["pieces"], F.array(piece)).alias("pieces"),
            )

        return F.when(F.size(turns).bitwiseAND(size) != 0, _let(_name(got["end"], part), longer)).otherwise(got)

    return F.aggregate(levels, none, step)


def _merged(pieces: DataFrame) -> DataFrame:
    alike = [F.any_value(c).alias(c) for c in ("depth", "end_level", "chain", "path", "turns")]
    return pieces.groupBy("start", "end").agg(*alike, F.sum("members").alias("members"), F.min("conv").alias("conv"))


def _halves(level: DataFrame, half: int, of: int) -> DataFrame:
    upper = F.struct(
        "start", F.col("mid").alias("end"), "depth", F.lit(of).alias("end_level"), "chain", F.col("chain").alias("path"), F.slice("turns", 1, half).alias("turns")
    )
    longer = F.concat("chain", F.array(F.struct(F.col("mid").alias("name"), F.lit(of).alias("level"))))
    lower = F.struct(
        F.col("mid").alias("start"), "end", (F.col("depth") + half).alias("depth"), "end_level", longer.alias("chain"), "path", F.slice("turns", half + 1, half).alias("turns")
    )
    return level.select(F.explode(F.array(upper, lower)).alias("piece"), "members", "conv").select("piece.*", "members", "conv")


def _joined_ids(ends: DataFrame) -> DataFrame:
    """name, ends_sha256: the hash of the ids of all conversations that end at a node, in order and joined by commas.

    Ranges of (name, id) join their ids side by side, also those of one name that has a third of all rows. Then one
    task reads a name's strings one after the other, as a hash of one long text must, and holds no more than a batch.
    """
    spark = ends.sparkSession

    def strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            grouped = batch.assign(text=batch.conv_id.astype(str)).groupby("name", sort=False)
            yield grouped.agg(first=("conv_id", "first"), text=("text", ",".join)).reset_index()

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, state = None, None
        for batch in batches:
            done = []
            for now, text in zip(batch["name"], batch["text"], strict=True):
                if state is not None and now == name:
                    state.update(b",")
                else:
                    if state is not None:
                        done.append((name, state.hexdigest()))
                    name, state = now, hashlib.sha256()
                state.update(text.encode())
            yield pd.DataFrame(done, columns=["name", "ends_sha256"])
        if state is not None:
            yield pd.DataFrame([(name, state.hexdigest())], columns=["name", "ends_sha256"])

    dealt = ends.repartitionByRange(tasks(spark), "name", "conv_id").sortWithinPartitions("name", "conv_id")
    joined = dealt.mapInPandas(strings, "name string, first long, text string")
    return joined.repartition(tasks(spark), "name").sortWithinPartitions("name", "first").mapInPandas(hashed, "name string, ends_sha256 string")


def _totals(nodes: DataFrame, levels: dict[int, DataFrame], values: list[str]) -> DataFrame:
    """name and, for each node, the sums of `values` over its subtree."""
    above = F.concat("path", F.array(F.struct(F.col("name").alias("name"), F.col("end_level").alias("level"))))
    grafted = nodes.select(F.explode(above).alias("at"), *values).select("at.*", *values)
    sums = [F.sum(v).alias(v) for v in values]
    handed = None
    for k in sorted({0, *levels}, reverse=True):
        here = grafted.filter(F.col("level") == k).drop("level")
        total = (here if handed is None else here.unionByName(handed)).groupBy("name").agg(*sums)
        if k == 0:
            return total
        cuts = levels[k].select(F.col("end").alias("name"), "mid")
        handed = total.join(cuts, "name").select(F.explode(F.array("mid", "name")).alias("name"), *values)


def trie(convs: DataFrame) -> DataFrame:
    """The nodes of the trie of `convs` (conv_id, turns): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    A node is known by its smallest member and its depth. The root is a node as soon as there is a conversation, with
    or without turns. Ids must be unique. A conversation is one row of about 50 bytes a turn; nodes, members
    and children are never gathered.
    """
    spark = convs.sparkSession
    cut = written(convs.select("conv_id", _cut(F.col("turns")).alias("cut")).select("conv_id", "cut.end", "cut.pieces"), "pieces")
    first = cut.select(F.explode("pieces").alias("piece"), "conv_id").select(
        "piece.*", F.col("piece.level").alias("end_level"), F.col("piece.chain").alias("path"), F.lit(1).cast("long").alias("members"), F.col("conv_id").alias("conv")
    )
    root = cut.agg(F.min("conv_id").alias("conv"), F.count(F.lit(1)).alias("members"), F.max(F.aggregate("pieces", F.lit(-1), lambda m, p: F.greatest(m, p["level"]))).alias("level")).first()
    if not root.members:
        columns = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
        return spark.createDataFrame([], columns)

    levels: dict[int, DataFrame] = {}
    lower = None
    for k in range(max(root.level, 0), -1, -1):
        here = first.filter(F.col("level") == k).drop("level")
        merged = _merged(here if lower is None else here.unionByName(lower))
        if k == 0:
            break
        half = 1 << (k - 1)
        levels[k] = written(merged.withColumn("mid", _name(F.col("start"), F.slice("turns", 1, half))), f"level{k}")
        lower = _halves(levels[k], half, k - 1)

    nodes = merged.select(
        F.col("end").alias("name"), F.col("start").alias("parent"), (F.col("depth") + 1).cast("long").alias("depth"), "members", "conv", "path", "end_level",
        F.get("turns", F.lit(0))["chars"].alias("chars"),
    )
    nodes = written(nodes, "nodes")
    children = nodes.groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    valued = nodes.join(children, "name", "left").fillna(0, ["n_children"])
    valued = valued.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("members") - 1) * F.col("chars")})
    totals = written(_totals(valued, levels, ["n_leaves", "saved_tokens"]), "totals")
    hashes = _joined_ids(cut.select(F.col("end").alias("name"), "conv_id"))

    below = valued.drop("n_leaves", "saved_tokens", "path", "end_level").join(totals, "name")
    over_all = totals.join(nodes.filter(F.col("parent") == ROOT).select("name"), "name").agg(
        F.lit(ROOT).alias("name"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"),
        F.lit(root.members).alias("members"), F.lit(root.conv).cast("long").alias("conv"), F.lit(0).alias("chars"),
        F.count(F.lit(1)).alias("n_children"), F.greatest(F.sum("n_leaves"), F.lit(1)).alias("n_leaves"),
        F.coalesce(F.sum("saved_tokens"), F.lit(0)).alias("saved_tokens"),
    )
    rows = below.unionByName(over_all).join(hashes, "name", "left")
    # The root's children, of which there may be very many, need no join.
    inner = rows.filter(F.col("parent") != ROOT)
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv").alias("parent_conv_id"))
    outer = rows.filter(F.coalesce(F.col("parent"), F.lit(ROOT)) == ROOT)
    outer = outer.withColumn("parent_conv_id", F.when(F.col("parent").isNotNull(), F.lit(root.conv)).cast("long"))
    return inner.join(parents, "parent").unionByName(outer).select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("members").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NOBODY)).alias("ends_sha256"),
    )
