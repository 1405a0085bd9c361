"""Exact repeats of LENGTH bytes, by sorting sampled suffixes in range-partitioned buckets.

Sorting a suffix at every byte would move the corpus many times. Suffixes are sampled instead at places that depend on
the bytes alone: in each window of LENGTH bytes, at the leftmost of the GRAM-byte grams with the least hash. Equal windows
choose the same place, so the windows around one suffix can only repeat around a suffix with the same first GRAM
bytes. Suffixes whose gram is nowhere else are dropped; of those left (about as many as there are repeats) each is cut out
with the bytes of all its windows.

These are range-partitioned by their leading bytes with splitters that Spark samples; ties go on by a salt, so bytes that a
third of all texts share fill many buckets. A bucket sorts the windows around its suffixes by multikey quicksort:
grouped by gram and offset, then by one token of TOKEN bytes after the other, each round sorting only what is still undecided.
Windows that end up together are repeats. A gram at the edge of a bucket may go on in the next one, so one of each of its
windows is compared across buckets.

Windows of a text that repeat one period on are settled where they are read; one period of them is kept for others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlake.llm import textscan
from laborlake.llm.common import tasks, written

LENGTH = 400
GRAM = 64
TOKEN = 100
#: Bytes looked at together while reading, under 2 ** 23; bytes whose suffixes are forwarded together; windows in one
#: bucket; windows sorted together. A task holds some 20 arrays of eight bytes for each byte or window that it looks at.
PIECE = 1 << 18
FORWARDED = 1 << 22
BUCKET = 1_000_000
SORTED = 250_000
BROADCAST = 2_000_000
#: Of a sampled suffix: settled already, first of its gram in the batch, and whether the gram is there more than once.
SETTLED, ALSO, ONE, MANY, INTERVAL = 0, 0, 1, 2, 3


def _sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums from which the hash of any stretch follows, and the inverse powers that it takes."""
    power, inverse = textscan._powers(1 << max(PIECE + 4096, len(data)).bit_length())
    sums = np.zeros(len(data) + 1, np.uint64)
    values = textscan.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    np.cumsum(values[data] * power[: len(data)], out=sums[1:])
    return sums, inverse


def _stretch(sums: np.ndarray, inverse: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    return (sums[starts + length] - sums[starts]) * inverse[starts]


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each run in which every key stays the same."""
    n = len(keys[0])
    change = np.zeros(max(n - 1, 0), bool)
    for key in keys:
        change |= key[1:] != key[:-1]
    first = np.concatenate([[0], np.flatnonzero(change) + 1]) if n else np.zeros(0, np.int64)
    return first, np.concatenate([first[1:] - 1, [n - 1]]) if n else first


def sampled_suffixes(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Text number, place, first and last window start, and gram hash of every sampled suffix; then text number, start
    and end of what repeats a period on within its text."""
    parts: list[tuple[np.ndarray, ...]] = []
    settled: list[tuple[np.ndarray, ...]] = []
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def flush() -> None:
        if not held:
            return
        data = np.frombuffer(b"".join(x for _, _, x in held), np.uint8)
        lengths = np.array([len(x) for _, _, x in held])
        number, shift = np.array([i for i, _, _ in held]), np.array([at for _, at, _ in held])
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        sums, inverse = _sums(data)
        grams = textscan.mix(_stretch(sums, inverse, np.arange(len(data) - GRAM + 1), GRAM))
        low = np.uint64((1 << 24) - 1)
        packed = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        least = (_sliding_min(packed, LENGTH - GRAM + 1) & low).astype(np.int64)
        counts = lengths - LENGTH + 1
        owner = np.repeat(np.arange(len(held)), counts)
        start = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(begin, counts)
        place = least[start]
        first, last = _runs(place, owner)
        # Runs that follow one of the same gram in the same text: a window may be the one a period before.
        gram, at, own = grams[place[first]], place[first], owner[first]
        period = np.zeros(len(first), np.int64)
        period[1:] = np.where((gram[1:] == gram[:-1]) & (own[1:] == own[:-1]), at[1:] - at[:-1], 0)
        back = np.repeat(period, last - first + 1)
        again = np.flatnonzero((back > 0) & (start - back >= begin[owner]))
        if len(again):
            here, there = start[again], start[again] - back[again]
            same = _stretch(sums, inverse, here, LENGTH) == _stretch(sums, inverse, there, LENGTH)
            again, here, there = again[same], here[same], there[same]
            repeats = np.unique(np.concatenate([here, there]))
            a, b = _runs(repeats - np.arange(len(repeats)))
            o = np.searchsorted(begin, repeats[a], "right") - 1
            move = shift[o] - begin[o]
            settled.append((number[o], repeats[a] + move, repeats[b] + LENGTH + move))
            left = np.ones(len(start), bool)
            left[again] = False
            owner, start, place = owner[left], start[left], place[left]
            first, last = _runs(place, owner, start - np.arange(len(start)))
            at, own = place[first], owner[first]
        move = shift[own] - begin[own]
        parts.append((number[own], at + move, start[first] + move, start[last] + move, grams[at]))

    for i, text in enumerate(texts):
        if len(text) < LENGTH:
            continue
        for at in range(0, len(text) - LENGTH + 1, PIECE):
            piece = text[at : at + PIECE + LENGTH - 1] if len(text) > PIECE else text
            if size and size + len(piece) > 2 * PIECE:
                flush()
                held, size = [], 0
            held.append((i, at, piece))
            size += len(piece)
            if piece is text:
                break
    flush()
    none = np.zeros(0, np.int64)
    found = tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (none,) * 4 + (np.zeros(0, np.uint64),)
    return found + (tuple(np.concatenate(x) for x in zip(*settled, strict=True)) if settled else (none,) * 3)


def _bytes_of(docs: DataFrame) -> DataFrame:
    """doc_id, text_id (a hash of the text), data (its bytes)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.xxhash64(text, F.octet_length(text)).alias("text_id"), text.cast("binary").alias("data"))


PACKED = "bucket int, texts binary, owners binary, grams binary, places binary, befores binary, afters binary, kinds binary"
_TYPES = {"owners": np.uint32, "grams": np.uint64, "places": np.uint32, "befores": np.uint32, "afters": np.uint32, "kinds": np.uint8}


def repeated_suffixes(rows: DataFrame) -> DataFrame:
    """text_id, place, low, high, settled: sampled suffixes whose gram is there more than once, with their window starts;
    or, where settled, the bytes from low to high that repeat within the text.

    A task forwards one suffix of each gram in a batch; the others are known to be repeats by then.
    """
    spark = rows.sparkSession
    buckets = 4 * tasks(spark)

    def sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.drop_duplicates("text_id")
            for low, high in textscan.slices(batch["data"].map(len).to_numpy(), FORWARDED):
                part = batch.iloc[low:high]
                ids = part["text_id"].to_numpy()
                owner, place, start, end, gram, s_owner, s_from, s_to = sampled_suffixes(part["data"].tolist())
                if not len(owner):
                    continue
                order = np.argsort(gram, kind="stable")
                first, last = _runs(gram[order])
                kind = np.full(len(gram), ALSO, np.uint8)
                kind[order[first]] = np.where(last > first, MANY, ONE)
                key = np.where(kind == ALSO, textscan.mix(ids[owner].astype(np.uint64)), gram)
                s_key = textscan.mix(ids[s_owner].astype(np.uint64))
                columns = {
                    "owners": np.concatenate([owner, s_owner]),
                    "grams": np.concatenate([gram, np.zeros(len(s_owner), np.uint64)]),
                    "places": np.concatenate([place, s_from]),
                    "befores": np.concatenate([place - start, np.zeros(len(s_owner), np.int64)]),
                    "afters": np.concatenate([end - start, s_to - s_from]),
                    "kinds": np.concatenate([kind, np.full(len(s_owner), INTERVAL, np.uint8)]),
                }
                bucket = ((np.concatenate([key, s_key]) >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
                used = np.flatnonzero(np.diff(edges))
                out: dict[str, list] = {"bucket": list(used), "texts": []} | {c: [] for c in columns}
                for b in used:
                    chosen = order[edges[b] : edges[b + 1]]
                    texts, local = np.unique(columns["owners"][chosen], return_inverse=True)
                    out["texts"].append(ids[texts].astype(np.int64).tobytes())
                    out["owners"].append(local.astype(np.uint32).tobytes())
                    for c in ("grams", "places", "befores", "afters", "kinds"):
                        out[c].append(columns[c][chosen].astype(_TYPES[c]).tobytes())
                yield pd.DataFrame(out)

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list = []
        for batch in batches:
            for row in batch.itertuples(index=False):
                if held and row.bucket != held[-1].bucket:
                    yield merged(held)
                    held = []
                held.append(row)
        if held:
            yield merged(held)

    def merged(rows: list) -> pd.DataFrame:
        got = {c: np.concatenate([np.frombuffer(getattr(r, c), t) for r in rows]) for c, t in _TYPES.items() if c != "owners"}
        text = np.concatenate([np.frombuffer(r.texts, np.int64)[np.frombuffer(r.owners, np.uint32)] for r in rows])
        order = np.lexsort((got["places"], text, got["grams"], got["kinds"] != ALSO))
        text, got = text[order], {c: v[order] for c, v in got.items()}
        waits = (got["kinds"] == ONE) | (got["kinds"] == MANY)
        place = got["places"].astype(np.int64)
        # A text that several batches hold is there once.
        keep = np.ones(len(text), bool)
        keep[1:] = (text[1:] != text[:-1]) | (place[1:] != place[:-1]) | (got["grams"][1:] != got["grams"][:-1]) | ~(waits[1:] & waits[:-1])
        many = waits & (got["kinds"] == MANY)
        gram, at = np.unique(got["grams"][waits & keep], return_inverse=True)
        counts = np.bincount(at, minlength=len(gram))
        if len(gram):
            counts += np.bincount(np.searchsorted(gram, got["grams"][many]), minlength=len(gram))
            repeated = np.zeros(len(text), bool)
            repeated[waits & keep] = counts[at] > 1
        else:
            repeated = np.zeros(len(text), bool)
        settled = got["kinds"] == INTERVAL
        take = repeated | (got["kinds"] == ALSO) | settled
        low = place - got["befores"]
        return pd.DataFrame(
            {
                "text_id": text[take],
                "place": place[take],
                "low": low[take],
                "high": (low + got["afters"])[take],
                "settled": settled[take],
            }
        )

    packed = rows.filter(F.octet_length("data") >= LENGTH).select("text_id", "data").mapInPandas(sample, PACKED)
    dealt = packed.repartition(tasks(spark), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInPandas(gather, "text_id long, place long, low long, high long, settled boolean")


def _cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every sampled suffix with the bytes of all its windows."""
    for batch in batches:
        for text_id, data, *places in zip(*(batch[c] for c in ("text_id", "data", "place", "low", "high")), strict=True):
            rows = []
            for place, low, high in zip(*(p.tolist() for p in places), strict=True):
                salt = int(textscan.mix(np.array([(text_id ^ place) & 0xFFFFFFFFFFFFFFFF], np.uint64))[0] >> np.uint64(1))
                gram = hashlib.blake2b(data[place : place + GRAM], digest_size=8).digest()
                rows.append((data[place : place + 16], int.from_bytes(gram, "little", signed=True), salt, text_id, low, place - low, high - low + 1, data[low : high + LENGTH]))
            yield pd.DataFrame(rows, columns=["lead", "gram", "salt", "text_id", "low", "inner", "windows", "data"])


CUT = "lead binary, gram long, salt long, text_id long, low long, inner int, windows int, data binary"
FOUND = "bucket long, h1 binary, h2 binary, times binary, texts binary, lows binary, highs binary"
_EDGE_TYPES = {"h1": np.int64, "h2": np.int64, "times": np.uint8, "texts": np.int64, "lows": np.int64, "highs": np.int64}


def equal_windows(blocks: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """Block, window in the block, class and size of class for each window around the suffixes, and two hashes of it.

    Multikey quicksort: each round sorts by one more token what the tokens before left together.
    """
    counts = blocks["windows"].to_numpy().astype(np.int64)
    lengths = counts + LENGTH - 1
    base = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    sums, inverse = _sums(np.frombuffer(b"".join(blocks["data"]), np.uint8))
    block = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(len(block)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = base[block] + inside
    offset = blocks["inner"].to_numpy()[block] - inside
    tokens = [_stretch(sums, inverse, start + k, TOKEN) for k in range(0, LENGTH, TOKEN)]
    group = np.zeros(len(block), np.int64)
    size = np.ones(len(block), np.int64)
    order = np.lexsort((offset, blocks["gram"].to_numpy()[block]))
    keys = [blocks["gram"].to_numpy()[block][order], offset[order]]
    names = 0
    for token in [None, *tokens]:
        if token is not None:
            order = order[np.lexsort((token[order], group[order]))]
            keys = [group[order], token[order]]
        first, last = _runs(*keys)
        many = last > first
        sizes = last - first + 1
        group[order] = names + np.repeat(np.arange(len(first)), sizes)
        size[order] = np.repeat(sizes, sizes)
        names += len(first)
        order = order[np.repeat(many, sizes)]
        if not len(order):
            break
    h1 = textscan.mix(tokens[0] * np.uint64(3) + textscan.mix(tokens[1]) + textscan.mix(tokens[2] ^ tokens[3]))
    h2 = textscan.mix(textscan.mix(textscan.mix(tokens[0]) + tokens[1]) + textscan.mix(textscan.mix(tokens[2]) + tokens[3]))
    return block, inside, group, size, h1.view(np.int64), h2.view(np.int64)


def _pack(found: dict[str, np.ndarray], bucket: np.ndarray) -> pd.DataFrame:
    """A row for each bucket, with what belongs there as arrays."""
    order = np.argsort(bucket, kind="stable")
    first, last = _runs(bucket[order])
    out = {"bucket": bucket[order][first]}
    for name, kind in _EDGE_TYPES.items():
        values = found[name].astype(kind)[order]
        out[name] = [values[a : b + 1].tobytes() for a, b in zip(first, last, strict=True)]
    return pd.DataFrame(out)


def _sort_bucket(buckets: int):
    """A range's repeats; and what may go on in the ranges beside it with hashes, to be compared there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        windows, edge = 0, True
        # A batch may hold many times the windows that are sorted together.
        parts = (batch.iloc[low:high] for batch in batches for low, high in textscan.slices(batch["windows"].to_numpy(), SORTED))
        for batch in parts:
            new = batch["gram"].to_numpy()
            if held and windows > SORTED:
                # The last gram may go on; all before it are complete.
                whole = pd.concat(held, ignore_index=True)
                gram = whole["gram"].to_numpy()
                cut = len(gram) if new[0] != gram[-1] else int(_runs(gram)[0][-1])
                if cut:
                    yield _sorted(whole.iloc[:cut], edge, False, buckets)
                    edge = False
                    held = [whole.iloc[cut:]] if cut < len(gram) else []
                    windows = int(sum(h["windows"].sum() for h in held))
            held.append(batch)
            windows += int(batch["windows"].sum())
        if held:
            yield _sorted(pd.concat(held, ignore_index=True), edge, True, buckets)

    return run


def _sorted(blocks: pd.DataFrame, from_edge: bool, to_edge: bool, buckets: int) -> pd.DataFrame:
    blocks = blocks.reset_index(drop=True)
    gram = blocks["gram"].to_numpy()
    block, inside, group, size, h1, h2 = equal_windows(blocks)
    text, low = blocks["text_id"].to_numpy(), blocks["low"].to_numpy()
    twice = np.flatnonzero(size > 1)
    first, last = _runs(block[twice], inside[twice] - np.arange(len(twice)))
    a, b = (twice[first], twice[last]) if len(twice) else (first, last)
    at_edge = (from_edge & (gram == gram[0])) | (to_edge & (gram == gram[-1]))
    edge = np.flatnonzero(at_edge[block])
    e = edge[np.unique(group[edge], return_index=True)[1]]
    starts = low[block[e]] + inside[e]
    zeros = np.zeros(len(a), np.int64)
    found = {
        "h1": np.concatenate([zeros, h1[e]]),
        "h2": np.concatenate([zeros, h2[e]]),
        # None for what is settled; at an edge one of each kind of window, with how many there are here.
        "times": np.concatenate([zeros, np.minimum(size[e], 2)]),
        "texts": np.concatenate([text[block[a]], text[block[e]]]),
        "lows": np.concatenate([low[block[a]] + inside[a], starts]),
        "highs": np.concatenate([low[block[b]] + inside[b] + LENGTH, starts + LENGTH]),
    }
    # Windows of one gram that start near each other meet in one bucket, so that what repeats there joins again.
    offset = (blocks["inner"].to_numpy()[block[e]] - inside[e]) >> 4
    key = np.concatenate([text[block[a]].astype(np.uint64), gram[block[e]].astype(np.uint64) + offset.astype(np.uint64)])
    return _pack(found, (textscan.mix(key) % np.uint64(buckets)).astype(np.int64))


def _merge_edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spans of texts: what was settled, and windows at edges that another range has as well."""

    def merged(rows: list) -> pd.DataFrame:
        got = {n: np.concatenate([np.frombuffer(getattr(r, n), t) for r in rows]) for n, t in _EDGE_TYPES.items()}
        order = np.lexsort((got["h2"], got["h1"]))
        got = {n: v[order] for n, v in got.items()}
        first, last = _runs(got["h1"], got["h2"])
        total = np.add.reduceat(got["times"].astype(np.int64), first)
        # Of windows with a like beside them the range has told itself.
        take = (got["times"] == 0) | ((np.repeat(total, last - first + 1) > 1) & (got["times"] == 1))
        text, low, high = (got[n][take] for n in ("texts", "lows", "highs"))
        order = np.lexsort((low, text))
        text, low, high = text[order], low[order], high[order]
        if len(text):
            first, last = _runs(text)
            # Within each text, the end so far: texts are kept apart by an offset larger than any text.
            lift = np.repeat(np.arange(len(first)), last - first + 1) * (int(high.max()) + 1)
            ends = np.maximum.accumulate(high + lift)
            new = np.concatenate([[True], (low + lift)[1:] > ends[:-1]])
            starts = np.flatnonzero(new)
            text, low, high = text[starts], low[starts], np.maximum.reduceat(high, starts)
        return pd.DataFrame({"text_id": text, "low": low, "high": high})

    held: list = []
    for batch in batches:
        for row in batch.itertuples(index=False):
            if held and row.bucket != held[-1].bucket:
                yield merged(held)
                held = []
            held.append(row)
    if held:
        yield merged(held)


def _remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text_id, data, spans in zip(batch["text_id"], batch["data"], batch["spans"], strict=True):
            kept, end, n, removed = hashlib.sha256(), 0, 0, 0
            for low, high in sorted((s["low"], s["high"]) for s in spans):
                if low > end or not n:
                    kept.update(data[end:low])
                    n += 1
                    end = low
                removed += max(0, high - end)
                end = max(end, high)
            kept.update(data[end:])
            rows.append((text_id, removed, n, kept.hexdigest()))
        yield pd.DataFrame(rows, columns=["text_id", "n_removed", "n_spans", "kept_sha256"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """text_id, low, high: stretches of bytes of each text that repeats cover; they may overlap."""
    return _spans(_bytes_of(docs))[1]


def _spans(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The texts with sampled suffixes that repeat (text_id, data), and the spans."""
    spark = rows.sparkSession
    found = written(repeated_suffixes(rows), "suffixes")
    places = found.filter("not settled")
    wanted = written(found.select("text_id").distinct(), "texts")
    few = wanted.count() <= BROADCAST
    texts = rows.select("text_id", "data").join(F.broadcast(wanted) if few else wanted, "text_id", "left_semi")
    # One of each text, whatever its copies, summed up where they are read.
    texts = texts.groupBy("text_id").agg(F.first("data").alias("data"))
    lists = places.groupBy("text_id").agg(F.collect_list(F.struct("place", "low", "high")).alias("places"))
    # Arrays of numbers are a tenth of the objects that structs become in Python.
    lists = lists.select("text_id", *(F.col(f"places.{c}").alias(c) for c in ("place", "low", "high")))
    windows = places.agg(F.sum(F.col("high") - F.col("low") + 1)).first()[0] or 0
    parts = max(tasks(spark), -(-windows // BUCKET))
    cut = texts.join(lists, "text_id").mapInPandas(_cut_out, CUT)
    order = ["lead", "gram", "salt"]
    buckets = 4 * parts
    ranges = cut.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInPandas(_sort_bucket(buckets), FOUND)
    across = ranges.repartition(parts, "bucket").sortWithinPartitions("bucket")
    across = across.mapInPandas(_merge_edges, "text_id long, low long, high long")
    return texts, across.unionByName(found.filter("settled").select("text_id", "low", "high"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per row of `docs`.

    A null text is an empty one; a text shorter than LENGTH loses nothing. Rows with equal texts of LENGTH bytes or more lose
    all of them, ids and their repetition set aside. Other columns are ignored. Texts are told apart by 64-bit hashes and
    their lengths, windows by four hashes of 64 bits, in different buckets by 128 bits.
    """
    rows = _bytes_of(docs)
    texts, spans = _spans(rows)
    spans = spans.groupBy("text_id").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    done = written(texts.join(spans, "text_id").mapInPandas(_remove, "text_id long, n_removed long, n_spans long, kept_sha256 string"), "removed")
    copied = rows.filter(F.octet_length("data") >= LENGTH).groupBy(F.col("text_id").alias("_copied")).agg(F.count(F.lit(1)).alias("_n"))
    copied = copied.filter("_n > 1").select("_copied")
    done = done.withColumnRenamed("text_id", "_done")
    own = rows.select("doc_id", "text_id", F.octet_length("data").cast("long").alias("n_bytes"), F.sha2("data", 256).alias("_sha"))
    out = own.join(copied, F.col("text_id") == F.col("_copied"), "left").join(done, F.col("text_id") == F.col("_done"), "left")
    all_gone = F.col("_copied").isNotNull()
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(all_gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(all_gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(all_gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "_sha")).alias("kept_sha256"),
    )
