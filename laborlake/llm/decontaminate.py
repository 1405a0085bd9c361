"""Benchmark passages in documents, by counts of shared q-grams in diagonal bands and banded alignment.

Texts are compared in lower case with single spaces. An item of m characters is in a document if some stretch of the document is
at most k = m // EDIT_EVERY edits away from it. Such a stretch shares m - Q + 1 - Q k or more q-grams with the item (each edit
spoils Q at most), and they lie on k + 1 neighbouring diagonals of the item's and document's positions. So q-grams shared are
counted in overlapping bands of 2 (k + 1) diagonals; a band with enough of them is a region to align, in a band of that width
alone, and what is aligned within k edits is reported. Nothing that is within the budget can be missed. Items under LEAST
characters have a budget of 0 and count as whole words only; those under Q characters are found by hashes of their length.

The items' q-grams are broadcast in blocks of BLOCK characters; a larger benchmark takes one pass per block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from laborlake.llm import textscan
from laborlake.llm.common import written

Q = 10
EDIT_EVERY = 14
#: An item shorter than this must be there without an edit and as whole words. From here on the q-gram bound is above 0.
LEAST = 40
BLOCK = 8_000_000
MATCH = "array<struct<item_id: bigint, edits: int, start: int, end: int>>"
_FILTER_BITS = 22
_BASE = np.uint64(0xD1342543DE82EF95)


def plain(text: str) -> str:
    return " ".join(text.replace("\x00", " ").lower().split())


def budget(length: int) -> int:
    return length // EDIT_EVERY if length >= LEAST else 0


def _in_word(c: str) -> bool:
    """Whether a character is part of a word that spaces or signs end; Thai to Khmer, kana and Han are written without."""
    return c.isalnum() and not ("\u0e00" <= c <= "\u109f" or "\u1780" <= c <= "\u17ff" or "\u2e80" <= c <= "\ua4cf" or "\uf900" <= c <= "\ufaff" or c >= "\U00020000")


def whole_words(text: str, start: int, end: int) -> bool:
    """Whether neither end of a stretch is inside a word."""
    return all(at in (0, len(text)) or not (_in_word(text[at - 1]) and _in_word(text[at])) for at in (start, end))


def _window_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    n = max(0, len(codes) - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * _BASE + codes[k : k + n]
    return out


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """Hash of the Q characters from each place on."""
    if len(codes) < Q:
        return np.zeros(0, np.uint64)
    two = codes[:-1] * _BASE + codes[1:]
    four = two[:-2] * _BASE**2 + two[2:]
    eight = four[:-4] * _BASE**4 + four[4:]
    return textscan.mix(eight[:-2] * _BASE**2 + two[8:])


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)


class Index:
    """The q-grams of some items, sorted by hash, with the item and place of each."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        self.lengths = np.array([len(t) for t in self.texts], np.int64)
        self.edits = np.where(self.lengths < LEAST, 0, self.lengths // EDIT_EVERY)
        self.needed = self.lengths - Q + 1 - Q * self.edits
        #: Items under Q characters by length and hash.
        self.tiny: dict[int, dict[int, list[int]]] = {}
        for i, t in enumerate(self.texts):
            if 0 < len(t) < Q:
                self.tiny.setdefault(len(t), {}).setdefault(int(_window_hashes(_codes(t), len(t))[0]), []).append(i)
        grams = [gram_hashes(_codes(t)) for t in self.texts]
        hashes = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.items = np.repeat(np.arange(len(grams)), [len(g) for g in grams])[order]
        self.places = np.concatenate([np.arange(len(g)) for g in grams] or [np.zeros(0, np.int64)])[order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[hashes >> np.uint64(64 - _FILTER_BITS)] = True

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in the text, item, and place in the item of each shared q-gram."""
        hashes = gram_hashes(codes)
        at = np.flatnonzero(self.filter[hashes >> np.uint64(64 - _FILTER_BITS)])
        found = hashes[at]
        low, high = np.searchsorted(self.hashes, found, "left"), np.searchsorted(self.hashes, found, "right")
        counts = high - low
        total = int(counts.sum())
        entry = np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(total) if total else low[:0]
        return np.repeat(at, counts), self.items[entry], self.places[entry]

    def tiny_hits(self, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """Place in the text and item of each stretch with the hash of an item under Q characters."""
        for width, found in self.tiny.items():
            hashes = _window_hashes(codes, width)
            for place in np.flatnonzero(np.isin(hashes, np.array(list(found), np.uint64))):
                for item in found[int(hashes[place])]:
                    yield int(place), item

    def regions(self, codes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Text number, item and first diagonal of each band with enough hits; `starts` are where the texts begin."""
        place, item, inner = self.hits(codes)
        if not len(place):
            return
        owner = np.searchsorted(starts, place, "right") - 1
        width = self.edits[item] + 1
        # Counted from the text's start, moved so that none is negative.
        band = (place - starts[owner] - inner + self.lengths[item]) // width + 1
        pair = owner * len(self.ids) + item
        size = int(band.max()) + 2
        keys, counts = np.unique(pair * size + band, return_counts=True)
        # A band's second half is the next band's first: hits of both halves together.
        following = np.concatenate([keys[1:] == keys[:-1] + 1, [False]])
        both = counts + np.where(following, np.concatenate([counts[1:], [0]]), 0)
        good = both >= self.needed[keys // size % len(self.ids)]
        for key in keys[good]:
            number, b = divmod(int(key), size)
            owner, item = divmod(number, len(self.ids))
            yield owner, item, (b - 1) * int(self.edits[item] + 1) - int(self.lengths[item])
        # A band whose first half is empty is the one before the first key of a run.
        # Its hits are all in its second half, which is the first half of the next band, so that one is looked at instead.


def align(item: np.ndarray, text: np.ndarray, diagonal: int, edits: int) -> tuple[int, int, int] | None:
    """Edits, start and end of the best stretch of `text` on 2 (edits + 1) diagonals from `diagonal` on and `edits` to either side.

    None if that takes more than `edits` edits.
    """
    low, width = diagonal - edits, 4 * edits + 2
    far = np.int32(1 << 28)
    steps = np.arange(width, dtype=np.int64)
    padded = np.zeros(len(item) + width, np.uint64)
    first = max(0, low)
    last = min(len(text), low + len(padded))
    if last > first:
        padded[first - low : last - low] = text[first:last]
    inside = (low + steps >= 0) & (low + steps <= len(text))
    cost, start = np.where(inside, 0, far).astype(np.int64), low + steps
    for i in range(len(item)):
        # Cell d of row i + 1 ends before text place low + i + 1 + d.
        ends = low + i + 1 + steps
        step = cost + (padded[i : i + width] != item[i])
        drop = np.concatenate([cost[1:], [far]]) + 1
        origin = np.where(drop < step, np.concatenate([start[1:], [0]]), start)
        step = np.minimum(step, drop)
        step = np.where((ends < 0) | (ends > len(text)), far, step)
        best = np.minimum.accumulate(step - steps)
        source = np.maximum.accumulate(np.where(step - steps == best, steps, 0))
        cost, start = best + steps, origin[source]
        if cost.min() > edits:
            return None
    d = int(np.argmin(cost))
    return int(cost[d]), int(start[d]), int(low + len(item) + d)


def find(index: Index, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
    """For each text, (item_id, edits, start, end) of its best match with each item found, by item."""
    out: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
    texts = [plain(t) for t in texts]
    for low, high in textscan.slices(np.array([len(t) for t in texts]), 1 << 20):
        part = texts[low:high]
        codes = _codes("\x00".join(part))
        starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in part])[:-1]])
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for owner, item, diagonal in index.regions(codes, starts):
            wanted, edits = index.texts[item], int(index.edits[item])
            text = part[owner]
            if len(wanted) < LEAST:
                for at in (diagonal, diagonal + 1):
                    got = (0, at, at + len(wanted))
                    if at >= 0 and text.startswith(wanted, at) and whole_words(text, *got[1:]) and got < best.get((owner, item), (1,)):
                        best[owner, item] = got
                continue
            a = max(0, diagonal - edits)
            at = text.find(wanted, a, diagonal + 3 * (edits + 1) + len(wanted))
            if at >= 0:
                got = (0, at, at + len(wanted))
            else:
                own = codes[starts[owner] : starts[owner] + len(text)]
                got = align(_codes(wanted), own, diagonal, edits)
            if got and got < best.get((owner, item), (1 << 30,)):
                best[owner, item] = got
        for place, item in index.tiny_hits(codes):
            owner = int(np.searchsorted(starts, place, "right")) - 1
            text, wanted, at = part[owner], index.texts[item], place - int(starts[owner])
            if (owner, item) not in best and text.startswith(wanted, at) and whole_words(text, at, at + len(wanted)):
                best[owner, item] = (0, at, at + len(wanted))
        for (owner, item), got in best.items():
            out[low + owner].append((index.ids[item], *got))
    return [sorted(x) for x in out]


def items_of(benchmark: DataFrame) -> DataFrame:
    rows = benchmark.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    return rows.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item_text")).distinct()


@lru_cache(2)
def _index(rows: tuple[tuple[int, str], ...]) -> Index:
    return Index(list(rows))


def _with_block(docs: DataFrame, block: list[Row]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(
        tuple((r.item_id, t) for r in block if (t := plain(r.item_text)))
    )

    @F.pandas_udf(MATCH)
    def matches(texts: pd.Series) -> pd.Series:
        fields = ("item_id", "edits", "start", "end")
        index = _index(shared.value)
        return pd.Series([[dict(zip(fields, m, strict=True)) for m in found] for found in find(index, texts.tolist())])

    found = matches(F.coalesce(F.col("text"), F.lit("")))
    return docs.withColumn("_matches", F.concat("_matches", found))


def with_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` with `_matches`: item_id, edits, and start and end in the text as compared (lower case, single spaces).

    A null or empty text matches nothing, nor does an item that is null, has no id or only white space. An item shorter than
    LEAST matches where it stands unchanged (as compared) and no word goes on at its ends. Items of equal
    text are all reported; rows repeated in the benchmark count once, and an id with several texts has them all. Repeated
    documents are all reported. No benchmark, no matches.
    """
    items = items_of(benchmark)
    total = items.agg(F.sum(F.char_length("item_text"))).first()[0] or 0
    blocks = -(-total // BLOCK)
    docs = docs.withColumn("_matches", F.array().cast(MATCH))
    for i in range(blocks):
        if i:
            docs = written(docs, "matches")
        # About BLOCK characters each, and one item more at most.
        part = items.filter(F.pmod(F.xxhash64("item_text"), F.lit(blocks)) == i) if blocks > 1 else items
        docs = _with_block(docs, part.orderBy("item_id", "item_text").collect())
    return docs


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` without any match, with all their columns."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return with_matches(docs, benchmark).filter(F.size("_matches") == 0).select(*columns)
