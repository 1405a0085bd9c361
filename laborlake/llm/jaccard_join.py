"""Exact Jaccard join of word-shingle sets by pigeonhole over a partitioned universe.

Two sets r, s with |r| <= |s| and similarity t or more differ in at most H = (1 - t) / t |r| elements. Elements are hashed into m > H
segments, m fixed for each band of sizes; then of any H + 1 segments of r at least one is equal in s. Every set is indexed
by all its segments in its own band's partition and, if a smaller set of the band below may be its partner, in that one's.
Two segments of each partition are also indexed by their one-deletion neighbourhoods, so that r may allow one error
there and needs one segment less.

Which segments r searches by is chosen by cost once all are counted: segments that no other set has are free, and the
rarest of the others (or one-deletion neighbourhoods) fill up to H + 1. A set with H + 1 free ones has no partner and is done.
What is left are candidate groups. To verify no pair inside a component that is known already, each group is first
held against its member with most shared segments, the likely original; links found join components; and only pairs across
components are then looked at, block by block with bit sketches. Sketches drop pairs that differ too much before they
become rows, the rest is verified on whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laborlake.llm import textscan
from laborlake.llm.common import tasks, written
from laborlake.llm.components import components

WIDTH = 5
#: Similarity of 80 in 100.
NUMERATOR, DENOMINATOR = 80, 100
#: Sizes of a band go up to this factor.
BAND = 1.5
#: Segments of each partition that are indexed by one-deletion neighbourhoods as well.
DELETED = 2
#: Members of a group that are compared with as many visitors at a time.
BLOCK = 512
#: Ids broadcast at most; more are joined by a shuffle.
BROADCAST = 2_000_000
OWN, INDEXED, DELETION, INDEXED_DELETION = 0, 1, 2, 8
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted hashes of each text's distinct shingles; with fewer words, of the whole sequence; without words, none."""
    words, starts = textscan.word_hashes(texts)
    full, full_starts = textscan.windows(words, starts, WIDTH)
    out = []
    for i in range(len(texts)):
        n = int(starts[i + 1] - starts[i])
        if n >= WIDTH:
            out.append(textscan.distinct(full[full_starts[i] : full_starts[i + 1]]))
        elif n:
            whole, _ = textscan.windows(words[starts[i] : starts[i + 1]], np.array([0, n]), n)
            out.append(whole ^ np.uint64(n))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_hash(elements: np.ndarray) -> int:
    """63 bits that stand for a whole set."""
    return int(textscan.mix(np.array([np.sum(textscan.mix(elements * _ODD)), len(elements)], np.uint64)).sum() >> np.uint64(1))


def errors_allowed(size):
    """Largest symmetric difference of a set of this size and a partner that is no smaller."""
    return size * (DENOMINATOR - NUMERATOR) // NUMERATOR


def largest_partner(size: int) -> int:
    return size * DENOMINATOR // NUMERATOR


def band_bounds(size: int) -> tuple[int, int]:
    """First size of the band, and first size beyond it. Sets so small that they allow no error have no band."""
    low = -(-NUMERATOR // (DENOMINATOR - NUMERATOR))
    while True:
        high = int(np.ceil(low * BAND))
        if size < high:
            return low, high
        low = high


def segments_of(high: int) -> int:
    errors = errors_allowed(high - 1)
    return errors + 2 + errors // 16


def partition_keys(elements: np.ndarray, high: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The key of every segment of the partition for sizes below `high`, and the one-deletion keys of the first DELETED."""
    m = segments_of(high)
    values = textscan.mix(elements + np.uint64(high))
    segment = (values % np.uint64(m)).astype(np.int64)
    sums = np.zeros(m, np.uint64)
    np.add.at(sums, segment, values)
    salt = (np.arange(1, m + 1, dtype=np.uint64) * _ODD) ^ (np.uint64(high) << np.uint64(40))
    deleted = [textscan.mix((sums[i] - values[segment == i]) ^ salt[i]) for i in range(min(DELETED, m))]
    return textscan.mix(sums ^ salt), deleted


def keys_of(elements: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a set, and what each is: OWN, INDEXED (in the band below), DELETION + segment, INDEXED_DELETION."""
    n = len(elements)
    if errors_allowed(n) < 1 and errors_allowed(n * NUMERATOR // DENOMINATOR + 1) < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint8)
    keys, codes = [], []
    low = n
    if errors_allowed(n) >= 1:
        low, high = band_bounds(n)
        exact, deleted = partition_keys(elements, high)
        keys += [exact, *deleted]
        codes += [np.full(len(exact), OWN), *[np.full(len(d), DELETION + i) for i, d in enumerate(deleted)]]
    if low > 1 and largest_partner(low - 1) >= n and errors_allowed(low - 1) >= 1:
        exact, deleted = partition_keys(elements, low)
        keys += [exact, *deleted]
        codes += [np.full(len(exact), INDEXED), *[np.full(len(d), INDEXED_DELETION) for d in deleted]]
    return np.concatenate(keys), np.concatenate(codes).astype(np.uint8)


def sketch(elements: np.ndarray) -> bytes:
    """Parities of the elements by hash, about two bits for each. Bits that differ are no more than elements that differ."""
    bits = 1 << max(6, (2 * len(elements) - 1).bit_length())
    odd = np.bincount((textscan.mix(elements ^ _ODD) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _folded(x: np.ndarray, size: int) -> np.ndarray:
    while x.shape[-1] > size:
        half = x.shape[-1] // 2
        x = x[..., :half] ^ x[..., half:]
    return x


def differing_bits(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(x), len(y))
    return int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum())


def _text(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def _parts(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for low, high in textscan.text_slices(batch["text"], 1 << 21):
        yield batch.iloc[low:high]


def describe(docs: DataFrame) -> DataFrame:
    """_row (doc_id as text), text_hash, node, n, sketch for every document; node is null for one without words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _parts(batch):
                sets = shingle_sets(part["text"].tolist())
                yield pd.DataFrame(
                    {
                        "_row": part["_row"].to_numpy(),
                        "text_hash": part["text_hash"].to_numpy(),
                        "node": pd.array([set_hash(s) if len(s) else None for s in sets], "Int64"),
                        "n": np.array([len(s) for s in sets], np.int64),
                        "sketch": [sketch(s) for s in sets],
                    }
                )

    rows = _text(docs).select(F.col("doc_id").cast("string").alias("_row"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInPandas(run, "_row string, text_hash long, node long, n long, sketch binary")


def index_entries(docs: DataFrame) -> DataFrame:
    """key, node, n, code, freq: the keys that two sets or more have, with the number of these sets.

    Keys are dealt out by hash in packed arrays, sets that repeat within a batch only once.
    """
    buckets = 4 * tasks(docs.sparkSession)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _parts(batch.drop_duplicates("text")):
                nodes, sizes, keys, codes, owners = [], [], [], [], []
                for elements in shingle_sets(part["text"].tolist()):
                    key, code = keys_of(elements)
                    if len(key):
                        owners.append(np.full(len(key), len(nodes), np.uint16))
                        nodes.append(set_hash(elements))
                        sizes.append(len(elements))
                        keys.append(key)
                        codes.append(code)
                if not nodes:
                    continue
                key, code, owner = np.concatenate(keys), np.concatenate(codes), np.concatenate(owners)
                bucket = ((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
                used = np.flatnonzero(np.diff(edges))
                rows = [order[edges[b] : edges[b + 1]] for b in used]
                nodes, sizes = np.array(nodes, np.int64), np.array(sizes, np.int32)
                local = [np.unique(owner[r], return_inverse=True) for r in rows]
                yield pd.DataFrame(
                    {
                        "bucket": used,
                        "nodes": [nodes[u].tobytes() for u, _ in local],
                        "sizes": [sizes[u].tobytes() for u, _ in local],
                        "owners": [i.astype(np.uint16).tobytes() for _, i in local],
                        "keys": [(key[r] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes() for r in rows],
                        "codes": [code[r].tobytes() for r in rows],
                    }
                )

    def group(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list = []
        current = None
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.bucket != current and held:
                    yield shared(current, held)
                    held = []
                current = row.bucket
                held.append(row)
        if held:
            yield shared(current, held)

    def shared(bucket: int, rows: list) -> pd.DataFrame:
        key = np.concatenate([np.frombuffer(r.keys, np.uint32) for r in rows]).astype(np.int64) | (int(bucket) << 32)
        code = np.concatenate([np.frombuffer(r.codes, np.uint8) for r in rows])
        owner = [np.frombuffer(r.owners, np.uint16) for r in rows]
        node = np.concatenate([np.frombuffer(r.nodes, np.int64)[o] for r, o in zip(rows, owner, strict=True)])
        size = np.concatenate([np.frombuffer(r.sizes, np.int32)[o] for r, o in zip(rows, owner, strict=True)])
        order = np.lexsort((code, node, key))
        key, code, node, size = key[order], code[order], node[order], size[order]
        # A set has a key once; of equal keys that it has in two ways the first code counts.
        once = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])
        key, code, node, size = key[once], code[once], node[once], size[once]
        _, inverse, freq = np.unique(key, return_inverse=True, return_counts=True)
        freq = freq[inverse]
        many = freq > 1
        return pd.DataFrame({"key": key[many], "node": node[many], "n": size[many].astype(np.int64), "code": code[many].astype(np.int32), "freq": freq[many]})

    packed = _text(docs).select("text").mapInPandas(
        pack, "bucket int, nodes binary, sizes binary, owners binary, keys binary, codes binary"
    )
    dealt = packed.repartition(tasks(docs.sparkSession), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInPandas(group, "key long, node long, n long, code int, freq long")


def allocate(entries: DataFrame) -> DataFrame:
    """key, node, n, selected, best, best_n, best_selected: entries of the keys by which some set must search, and the member
    of each key with most shared segments."""
    highs = []
    low, top = band_bounds(1)[0], entries.agg(F.max("n")).first()[0] or 0
    while low <= top:
        low = int(np.ceil(low * BAND))
        highs.append(low)
    segments = F.lit(0)
    for high in reversed(highs):  # one branch per band, a few dozen for sets of any size
        segments = F.when(F.col("n") < high, F.lit(segments_of(high))).otherwise(segments)
    own = Window.partitionBy("node")
    searched = (F.col("code") == OWN) | ((F.col("code") >= DELETION) & (F.col("code") < INDEXED_DELETION))
    unit = F.when(F.col("code") == OWN, F.col("key")).when(searched, -F.col("code").cast("long"))
    # One shuffle, by node, serves all windows.
    rows = entries.repartition("node").withColumn("unit", unit).withColumn("searched", searched)
    cost = F.sum(F.when(F.col("searched"), F.col("freq") - 1)).over(Window.partitionBy("node", "unit"))
    rows = rows.withColumn("cost", cost)
    rank = F.dense_rank().over(own.orderBy(F.col("searched").desc(), "cost", F.col("unit") < 0, "unit"))
    shared_segments = F.sum((F.col("code") == OWN).cast("int")).over(own)
    needed = F.floor(F.col("n") * (DENOMINATOR - NUMERATOR) / NUMERATOR) + 1
    rows = rows.withColumns(
        {
            "selected": F.col("searched") & (rank <= needed - (segments - shared_segments)),
            "support": F.sum(F.col("freq") - 1).over(own),
        }
    )
    rows = written(rows.select("key", "node", "n", "selected", "support"), "entries")
    best = rows.groupBy(F.col("key").alias("_key")).agg(F.max("selected").alias("any"), F.max(F.struct("support", "node", "n", "selected")).alias("top"))
    best = best.filter("any").select("_key", F.col("top.node").alias("best"), F.col("top.n").alias("best_n"), F.col("top.selected").alias("best_selected"))
    return rows.drop("support").join(best, F.col("key") == F.col("_key")).drop("_key")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def by_sketches(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sketches differ little enough."""

    @F.pandas_udf("boolean")
    def near(a: pd.Series, b: pd.Series, most: pd.Series) -> pd.Series:
        return pd.Series([differing_bits(x, y) <= m for x, y, m in zip(a, b, most, strict=True)], dtype=bool)

    def of(side: str) -> DataFrame:
        return sets.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}"))

    joined = pairs.join(of("a"), "a").join(of("b"), "b")
    # |x| + |y| - 2 both, where both >= t / (1 + t) (|x| + |y|).
    most = F.floor((F.col("n_a") + F.col("n_b")) * (DENOMINATOR - NUMERATOR) / (DENOMINATOR + NUMERATOR)).cast("long")
    return written(joined.filter(near("s_a", "s_b", most)).select("a", "b"), "near")


def verify(left: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar enough, of those that sketches have left."""

    @F.pandas_udf("boolean")
    def similar(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b, strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(DENOMINATOR * both >= NUMERATOR * (len(x) + len(y) - both))
        return pd.Series(out, dtype=bool)

    def elements(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _parts(batch):
                found = shingle_sets(part["text"].tolist())
                yield pd.DataFrame({"node": [set_hash(s) for s in found], "elements": [s.tobytes() for s in found]})

    nodes = left.select(F.col("a").alias("node")).unionByName(left.select(F.col("b").alias("node"))).distinct()
    wanted = written(sets.join(nodes, "node", "left_semi").select("text_hash"), "wanted")
    few = wanted.count() <= BROADCAST
    hashed = _text(docs).select("text").withColumn("text_hash", F.xxhash64("text"))
    texts = hashed.join(F.broadcast(wanted) if few else wanted, "text_hash", "left_semi")
    texts = texts.groupBy("text_hash").agg(F.first("text").alias("text")).select("text")
    whole = written(texts.mapInPandas(elements, "node long, elements binary"), "elements")
    a = whole.select(F.col("node").alias("a"), F.col("elements").alias("e_a"))
    b = whole.select(F.col("node").alias("b"), F.col("elements").alias("e_b"))
    return written(left.join(a, "a").join(b, "b").filter(similar("e_a", "e_b")).select("a", "b"), "links")


def _pairs_across(members: DataFrame, sets: DataFrame) -> DataFrame:
    """x, y in different components of a group, whose sizes fit and whose sketches differ little enough.

    Each group is cut into blocks of about BLOCK members, and so are those outside its main component, which visit
    blocks: who searches by the key all of them, who does not only those who do. A task holds one block and one block
    of visitors at a time, and pairs become rows only after the sketches.
    """
    spark = members.sparkSession
    counted = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"), F.count_if("selected").alias("s"))
    main = counted.groupBy("key").agg(
        F.max(F.struct("c", "component")).alias("main"), F.sum("c").alias("total"), F.sum("s").alias("chosen"), F.count(F.lit(1)).alias("parts")
    )
    count = lambda n: F.ceil(n / BLOCK).cast("int")
    main = main.filter("parts > 1").select(
        F.col("key").alias("_key"),
        F.col("main.component").alias("main"),
        # Blocks of those who search by the key come before those of the others.
        count(F.col("chosen")).alias("first"),
        count(F.col("total") - F.col("chosen")).alias("rest"),
        count(F.col("total") - F.col("main.c")).alias("crowds"),
    )
    rows = members.join(main, F.col("key") == F.col("_key")).withColumn("outside", F.col("component") != F.col("main"))
    rows = rows.join(sets.select(F.col("node").alias("_node"), "sketch"), F.col("node") == F.col("_node"))
    of = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "node"), F.greatest(F.col(n), F.lit(1))).cast("int")
    block = F.when(F.col("selected"), of(1, "first")).otherwise(F.col("first") + of(1, "rest"))
    visited = F.when(F.col("selected"), F.col("first") + F.col("rest")).otherwise(F.col("first"))
    up_to = lambda n, place: F.transform(F.sequence(F.lit(0), n - 1), place)
    place = lambda block, crowd, visits: F.struct(block.alias("block"), crowd.alias("crowd"), F.lit(visits).alias("visits"))
    stay = up_to(F.col("crowds"), lambda i: place(block, i, False))
    visit = up_to(visited, lambda i: place(i, of(2, "crowds"), True))
    nowhere = F.array().cast("array<struct<block:int,crowd:int,visits:boolean>>")
    places = F.concat(stay, F.when(F.col("outside") & (visited > 0), visit).otherwise(nowhere))
    columns = ["node", "n", "selected", "component", "outside", "visits", "sketch"]

    def compare(held: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        node, n, chosen, part, outside, visits, sketches = held[0] if len(held) == 1 else map(np.concatenate, zip(*held, strict=True))
        inside, come = np.flatnonzero(~visits), np.flatnonzero(visits)
        xs, ys = [node[:0]], [node[:0]]
        if len(inside) and len(come):
            size = min(map(len, sketches))
            bits = np.stack([_folded(np.frombuffer(s, np.uint8), size) for s in sketches])
            for v in come:
                small, large = np.minimum(n[v], n[inside]), np.maximum(n[v], n[inside])
                fits = (part[inside] != part[v]) & (chosen[inside] | chosen[v]) & (small * DENOMINATOR >= large * NUMERATOR)
                # Two visitors meet in the blocks of both.
                at = inside[fits & (~outside[inside] | (node[inside] > node[v]))]
                if len(at):
                    most = (n[at] + n[v]) * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR)
                    close = np.bitwise_count(bits[at] ^ bits[v]).sum(axis=1) <= most
                    at, most = at[close], most[close]
                    if len(sketches[v]) > size:
                        # Sketches of the group's smallest size leave more than those of the pair's.
                        at = at[[differing_bits(sketches[i], sketches[v]) <= m for i, m in zip(at, most, strict=True)]] if len(at) else at
                    xs.append(np.full(len(at), node[v]))
                    ys.append(node[at])
        return np.concatenate(xs), np.concatenate(ys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[list[np.ndarray]] = []
        at = None
        for batch in batches:
            keys = batch[["key", "block", "crowd"]].to_numpy()
            values = [batch[c].to_numpy() for c in columns]
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
            found = []
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                now = tuple(keys[low]) if high > low else at
                if now != at and held:
                    found.append(compare(held))
                    held = []
                at = now
                held.append([x[low:high] for x in values])
            if found:
                # A pair often meets in many groups.
                yield as_rows(found).drop_duplicates()
        if held:
            yield as_rows([compare(held)])

    def as_rows(found: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
        return pd.DataFrame({c: np.concatenate(x).astype(np.int64) for c, x in zip("xy", zip(*found, strict=True), strict=True)})

    at = ["key", "block", "crowd"]
    dealt = rows.select("key", "node", "n", "selected", "component", "outside", "sketch", F.explode(places).alias("place"))
    dealt = dealt.select("key", "place.*", *[c for c in columns if c != "visits"]).repartition(tasks(spark), *at).sortWithinPartitions(*at)
    return dealt.mapInPandas(run, "x long, y long")


def link_sets(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """node, component for each node that is not the smallest of its component."""
    entries = written(allocate(written(index_entries(docs), "index")), "selected")
    stars = entries.filter((F.col("node") != F.col("best")) & (F.col("selected") | F.col("best_selected")))
    stars = stars.filter(F.least("n", "best_n") * DENOMINATOR >= F.greatest("n", "best_n") * NUMERATOR)
    first = written(_ordered(stars.select(F.col("node").alias("x"), F.col("best").alias("y"))), "stars")
    found = components(verify(by_sketches(first, sets), sets, docs))

    known = entries.select("key", "node", "n", "selected").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    second = _ordered(_pairs_across(known, sets)).join(first, ["a", "b"], "left_anti")
    more = verify(written(second, "pairs"), sets, docs)
    return components(more.unionByName(found.select(F.col("node").alias("a"), F.col("component").alias("b"))))


def group_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, text_hash: one row per row of `docs`.

    component_id is the smallest doc_id reachable by links, null ids set aside; a document without words, or a null text, is
    linked with nothing and has its own id. Rows with equal sets are one node, whatever their number; sets are told apart by
    64-bit hashes of shingles and 63-bit hashes of sets. Repeated ids with different texts are rows of their own. Other
    columns are ignored.
    """
    rows = written(describe(docs), "described")
    named = rows.filter("node is not null")
    sets = named.groupBy("node").agg(
        F.min(F.col("_row").cast("long")).alias("first_id"), F.max_by(F.struct("text_hash", "n", "sketch"), "text_hash").alias("s")
    )
    sets = written(sets.select("node", "first_id", "s.*"), "sets")
    found = link_sets(docs, sets)
    placed = sets.select("node", "first_id").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = placed.groupBy("component").agg(F.min("first_id").alias("name"))
    named_sets = placed.join(names, "component").select(F.col("node").alias("_node"), "name")
    out = rows.join(named_sets, F.col("node") == F.col("_node"), "left")
    doc_id = F.col("_row").cast("long")
    return out.select(
        doc_id.alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), doc_id).otherwise(F.col("name")).alias("component_id"),
        "text_hash",
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose id is their component's, and those without an id or without words, with all columns.

    Of rows repeated with one id, those stay whose text is in the component of that id.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    first = group_documents(docs).filter("component_id = doc_id or doc_id is null")
    first = first.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    keyed = docs.withColumn("_own_hash", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own_hash") == F.col("_hash"))
    return keyed.join(first, same, "left_semi").select(*columns)
