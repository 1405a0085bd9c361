"""Packing token pieces into sequences of equal length, shortest pack first over the histogram of lengths.

A document's tokens are cut into full sequences and one rest. What is packed is the histogram of the rests: lengths
are placed longest first, each count into the open packing patterns that hold least so far, or into new ones where it does
not fit even there.
The histogram has at most as many entries as a sequence has tokens, whatever the number of documents. Patterns go
back to documents by rank: the r-th rest of a length takes the r-th place that the patterns have for that length.
Ranks are made of counts per length and salt, so that a length that many rests share is ranked by many tasks.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laborlake.llm import textscan
from laborlake.llm.common import tasks, written

SEQUENCE = 1024
END = 0
#: Words whose ids a task remembers at most; beyond it starts anew.
REMEMBERED = 500_000
PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, salt int"

#: Words of which the tokenizer makes a line end, letters and a run of signs, whatever stands around them.
PLAIN = re.compile("(\n?)( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\\[-`{-~]*)")


def _byte_signs() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself, or the next one free from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


BYTE_SIGNS = _byte_signs()


class Words(dict):
    """The ids of words, each with a space before it unless it begins with a line end; worked out when first met.

    None for what is no single word: where white space is adjacent, or other than spaces and line ends.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def ids(self, word: str) -> bytes:
        if m := PLAIN.fullmatch(word):
            merge = self.tokenizer.model.tokenize
            parts = [x.encode().decode("latin-1").translate(BYTE_SIGNS) for x in m.groups() if x]
            return np.array([t.id for x in parts for t in merge(x)], "<u4").tobytes()
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: str) -> bytes | None:
        if len(self) >= REMEMBERED:
            self.clear()
        bare = word.removeprefix("\n")
        whole = len(bare.split()) == 1 and not bare[0].isspace() and not bare[-1].isspace()
        found = self[word] = self.ids(word if bare is not word else " " + word) if whole else None
        return found


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit numbers, remembering words.

    The tokenizer splits text into pieces before it merges bytes, and a piece never reaches across a space between
    two other characters. So where no two white-space characters are adjacent, and none but spaces and line ends
    occur inside the text, the ids of a text are those of its words, each with the space or line end before it. Any
    other text is encoded as a whole, and so is one that spells a token that the tokenizer cuts out beforehand.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = Words(self.tokenizer)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]

    def encode(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        first, *more = text.replace("\n", " \n").split(" ")
        if first and len(first.split()) == 1:
            try:
                return self.words.ids(first) + b"".join(map(self.words.__getitem__, more))
            except TypeError:  # a None among them
                pass
        return self.words.ids(text)


@lru_cache(1)
def _encoder(path: str) -> Encoder:
    """One per Python worker, which Spark keeps for many tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def encoded_pieces(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE) -> DataFrame:
    """PIECES: every document's tokens with END after them, cut into full sequences and a rest."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(tokenizer)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            for low, high in textscan.text_slices(batch["text"], 1 << 22):
                rows = []
                part = batch.iloc[low:high]
                for doc_id, text in zip(part["doc_id"], part["text"], strict=True):
                    ids = encoder.encode(text) + end
                    n, salt = len(ids) // 4, zlib.crc32(text.encode("utf-8", "surrogatepass")) & 0xFFFF
                    for start in range(0, n, sequence):
                        piece = ids[4 * start : 4 * (start + sequence)]
                        rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), n, salt))
                frame = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "salt"])
                frame["doc_id"] = frame["doc_id"].astype("string").astype("Int64")
                yield frame

    # As text, so that null ids and large ones come through alike.
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInPandas(cut, PIECES)


def shortest_pack_first(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths in order, longest first) and how many sequences follow each."""
    open_packs: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []
    done: list[tuple[tuple[int, ...], int]] = []

    def put(pattern: tuple[int, ...], count: int, room: int) -> None:
        if room == 0:
            done.append((pattern, count))
            return
        if room not in open_packs:
            open_packs[room] = []
            insort(rooms, room)
        open_packs[room].append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            # The shortest pack has the most room; where it is too full, all are.
            if not rooms or rooms[-1] < length:
                put((length,), left, sequence - length)
                break
            room = rooms[-1]
            pattern, count = open_packs[room].pop()
            if not open_packs[room]:
                del open_packs[room], rooms[-1]
            taken = min(left, count)
            if count > taken:
                put(pattern, count - taken, room)
            put((*pattern, length), taken, room - length)
            left -= taken
    for room in sorted(open_packs):
        done += open_packs[room]
    return done


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """By length: rows of (first rank, first sequence, offset) for each place that patterns have for it."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            rank = ranks.get(length, 0)
            found.setdefault(length, []).append((rank, sequence, offset))
            ranks[length] = rank + count
            offset += length
        sequence += count
    return {length: np.array(rows, dtype=np.int64) for length, rows in found.items()}


def _ranked(rests: DataFrame) -> DataFrame:
    """`rests` with `rank`, gapless from 0 within each length: salts of a length follow each other."""
    counts = rests.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "ids_crc32", "doc_tokens", "start")
    return (
        rests.withColumn("_own", F.row_number().over(own) - 1)
        .join(starts, ["length", "bucket"])
        .withColumn("rank", F.col("_before") + F.col("_own"))
        .drop("_own", "_before")
    )


def pack(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece.

    A text that is null counts as empty: its one token is END. doc_id may be null or repeated; every row is packed by itself. Other columns are ignored. No rows,
    no pieces. Full sequences come first in `sequence_id`s of their own, those of rests follow.
    """
    spark = docs.sparkSession
    pieces = written(encoded_pieces(docs, tokenizer, sequence), "pieces")
    n = tasks(spark)
    rests = pieces.filter(F.col("length") < sequence)
    # As many buckets for each length as a task should rank together; the few lengths times tasks bound all of them.
    rests = rests.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "salt"), F.lit(n)).cast("int"))
    histogram = {r.length: r.n for r in rests.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    patterns = shortest_pack_first(histogram, sequence)
    table = spark.sparkContext.broadcast(places(patterns))
    packed_sequences = sum(count for _, count in patterns)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            first = np.zeros(len(batch), np.int64)
            offset = np.zeros(len(batch), np.int64)
            lengths, ranks = batch["length"].to_numpy(), batch["rank"].to_numpy()
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                at = table.value[int(length)]
                k = np.searchsorted(at[:, 0], ranks[rows], "right") - 1
                first[rows] = at[k, 1] + ranks[rows] - at[k, 0]
                offset[rows] = at[k, 2]
            yield batch.drop(columns="rank").assign(sequence_id=first, offset=offset, doc_id=batch["doc_id"].astype("string").astype("Int64"))

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    ranked = _ranked(rests).select(F.col("doc_id").cast("string").alias("doc_id"), *columns[1:], "rank")
    schema = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    placed = ranked.mapInPandas(place, schema)
    full = _numbered(pieces.filter(F.col("length") == sequence), packed_sequences, n)
    return placed.unionByName(full.select(*columns, "sequence_id", F.lit(0).cast("long").alias("offset"))).withColumn(
        "length", F.col("length").cast("long")
    )


def _numbered(full: DataFrame, first: int, buckets: int) -> DataFrame:
    """Full pieces with sequence ids from `first` on, numbered within buckets that follow each other."""
    full = full.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start", "salt"), F.lit(buckets)).cast("int"))
    counts = full.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("_bucket").orderBy("doc_id", "start", "ids_crc32")
    # One row per bucket, as many as there are shuffle partitions.
    return full.join(F.broadcast(starts), "_bucket").withColumn(
        "sequence_id", F.lit(first).cast("long") + F.col("_before") + F.row_number().over(own) - 1
    )
