"""Quality selection by importance resampling between two hashed n-gram models.

Words and word pairs are hashed into two tables of BUCKETS, each counted once per document. One generative model is counted over all documents (raw), one over those that are
labelled good and not toxic (target). A document's log weight is the sum, over its n-grams, of the log ratio of the two
models, so that a good document stays near zero at any length and each n-gram that target text lacks takes it down.
Documents are then resampled without replacement: Gumbel noise
from a hash of the document is added to the log weights, and the k largest stay, where k is the number of documents whose
weight clears the cut that best divides the labelled ones.

The models are arrays of 2 * BUCKETS numbers whatever the input, summed within tasks first. At most LABELLED labelled
rows are used, those whose ids hash lowest; they alone are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborlake.llm import textscan
from laborlake.llm.common import tasks, written

#: Buckets of each of two tables. An n-gram has one in both, and what it says is the lesser of what they say: where one is
#: shared with an n-gram that junk is full of, the other is not.
BUCKETS = 1 << 18
#: Buckets that are shuffled as one array.
SLICE = 1 << 13
#: Characters whose n-grams are looked at together; a task holds about 40 bytes for each of them.
PIECE = 1 << 19
#: Bound on the labelled rows that are used.
LABELLED = 50_000
#: Documents added to both models in each bucket.
SHRINK = 1.0
#: Standard errors by which the models must differ in a bucket. Below, the ratio counts as 1; else every rare word would
#: speak for the labelled documents that it was counted in, and against all others.
EVIDENCE = 3.0
#: Factor by which they must differ: what is nearly as frequent in both adds only noise, the more the longer a text is.
FACTOR = 1.5
#: How many rejected bad documents one rejected good document outweighs, by share, where the labelled cut is chosen.
GOOD_COUNTS = 4.0
#: What log weights are multiplied by before the noise, so that it decides among documents near the cut alone.
SHARPNESS = 10.0
SEED = 17
#: Parts of a unit of the Gumbel keys; keys that agree in them are ties.
STEPS = 1 << 20
NO_CUT = -(1 << 62)


@dataclass(frozen=True)
class Model:
    """Log ratios by bucket, the labelled cut, and the smallest key (in STEPS) that stays."""

    weights: np.ndarray
    cut: float = -np.inf
    least_key: int = NO_CUT


def ngram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-grams of each text by their buckets in both tables, and the text that each belongs to.

    Beside words and word pairs a text has one n-gram for the share of its words that repeat the word before them, in
    steps of a factor of two: the pair itself is another one in every text, the habit is not.
    """
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
    words, starts = textscan.word_hashes(texts)
    pairs, pair_starts = textscan.windows(words, starts, 2)
    counts = np.diff(starts)
    places = np.arange(len(texts))
    owner = np.repeat(places, counts)
    again = np.flatnonzero((words[1:] == words[:-1]) & (owner[1:] == owner[:-1]))
    share = np.bincount(owner[again], minlength=len(texts)) / np.maximum(counts, 1)
    habit = textscan.mix(np.floor(-np.log2(np.maximum(share, 1e-3))).astype(np.uint64) + np.uint64(SEED))
    used = counts > 0
    owners = np.concatenate([owner, np.repeat(places, np.diff(pair_starts)), places[used]])
    hashes = np.concatenate([words, pairs, habit[used]])
    keys, at = np.unique(owners * BUCKETS + (hashes >> shift).astype(np.int64), return_index=True)
    second = (textscan.mix(hashes[at] + np.uint64(SEED)) >> shift).astype(np.int64)
    return keys % BUCKETS, BUCKETS + second, keys // BUCKETS


def labelled_rows(labels: DataFrame) -> DataFrame:
    """_label_id, good: at most LABELLED rows; good only if no row of an id says otherwise. Unlabelled marks are ignored."""
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
    marks = marks.groupBy(F.col("doc_id").alias("_label_id")).agg((F.min((F.col("quality") == 1) & (F.col("toxic") == 0))).alias("good"))
    return marks.orderBy(F.xxhash64("_label_id"), "_label_id").limit(LABELLED)


def _with_labels(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """`docs` with `_good`: true, false, or null if unlabelled. LABELLED rows of 9 bytes are broadcast at most."""
    known = labelled.withColumnRenamed("good", "_good")
    return docs.join(F.broadcast(known), F.col("doc_id") == F.col("_label_id"), "left").drop("_label_id")


def count_models(docs: DataFrame, labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """N-grams by bucket of both tables: of all documents, and of those labelled good."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw, target = np.zeros(2 * BUCKETS, np.int64), np.zeros(2 * BUCKETS, np.int64)
        for batch in batches:
            for low, high in textscan.text_slices(batch["text"], PIECE):
                part = batch.iloc[low:high]
                first, second, owner = ngram_buckets(part["text"].tolist())
                good = part["good"].to_numpy()[owner]
                for buckets in (first, second):
                    raw += np.bincount(buckets, minlength=2 * BUCKETS)
                    target += np.bincount(buckets[good], minlength=2 * BUCKETS)
        yield packed(range(0, 2 * BUCKETS, SLICE), raw, target)

    def packed(starts, raw: np.ndarray, target: np.ndarray) -> pd.DataFrame:
        parts = [[x[s : s + SLICE].tobytes() for s in starts] for x in (raw, target)]
        return pd.DataFrame({"start": list(starts), "raw": parts[0], "target": parts[1]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, sums = None, np.zeros((2, SLICE), np.int64)
        for batch in batches:
            for row in batch.itertuples(index=False):
                if at is not None and row.start != at:
                    yield pd.DataFrame({"start": [at], "raw": [sums[0].tobytes()], "target": [sums[1].tobytes()]})
                    sums = np.zeros((2, SLICE), np.int64)
                at = row.start
                sums += [np.frombuffer(row.raw, np.int64), np.frombuffer(row.target, np.int64)]
        if at is not None:
            yield pd.DataFrame({"start": [at], "raw": [sums[0].tobytes()], "target": [sums[1].tobytes()]})

    rows = _with_labels(docs.select("doc_id", "text"), labelled)
    rows = rows.select(F.coalesce(F.col("text"), F.lit("")).alias("text"), F.coalesce(F.col("_good"), F.lit(False)).alias("good"))
    columns = "start int, raw binary, target binary"
    dealt = rows.mapInPandas(count, columns).repartition(tasks(docs.sparkSession), "start").sortWithinPartitions("start")
    raw, target = np.zeros(2 * BUCKETS), np.zeros(2 * BUCKETS)
    for row in dealt.mapInPandas(add, columns).toLocalIterator():  # 2 * BUCKETS numbers of either model in all
        raw[row.start : row.start + SLICE] = np.frombuffer(row.raw, np.int64)
        target[row.start : row.start + SLICE] = np.frombuffer(row.target, np.int64)
    return raw, target


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """By bucket; 0 where the models hardly differ, and all 0 without target text."""
    if not target.sum():
        return np.zeros(len(raw))
    expected = raw * (target.sum() / raw.sum())
    ratios = np.log((target + SHRINK) / (expected + SHRINK))
    weak = np.abs(target - expected) < EVIDENCE * np.sqrt(expected + SHRINK)
    ratios[weak | (np.abs(ratios) < np.log(FACTOR))] = 0
    return ratios


def _score(weights: np.ndarray, texts: list[str]) -> np.ndarray:
    out = np.zeros(len(texts))
    for low, high in textscan.text_slices(texts, PIECE):
        first, second, owner = ngram_buckets(texts[low:high])
        one, other = weights[first], weights[second]
        lesser = np.where(np.abs(one) < np.abs(other), one, other)
        out[low:high] = np.bincount(owner, weights=lesser, minlength=high - low)
    return out


def with_keys(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with _log_weight and _key, the Gumbel key in STEPS."""
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)

    @F.pandas_udf("double")
    def log_weight(texts: pd.Series) -> pd.Series:
        return pd.Series(_score(shared.value, texts.tolist()))

    # A number in (0, 1) from the document, the same at every run and on every executor.
    uniform: Column = (F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "text"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    noise = -F.log(-F.log(uniform))
    rows = docs.withColumn("_log_weight", log_weight(F.coalesce(F.col("text"), F.lit(""))))
    return rows.withColumn("_key", F.floor((F.col("_log_weight") * SHARPNESS + noise) * STEPS).cast("long"))


def best_cut(scored: DataFrame) -> float:
    """The weight that divides labelled documents with the fewest errors in both kinds, good ones counted GOOD_COUNTS times."""
    quantiles = [i / 2000 for i in range(2001)]
    found = {
        r._good: np.array(r.q)
        for r in scored.filter("_good is not null")
        .groupBy("_good")
        .agg(F.percentile_approx("_log_weight", quantiles, 100_000).alias("q"))
        .collect()
    }
    if len(found) < 2:
        return -np.inf
    good, bad = found[True], found[False]
    cuts = np.unique(np.concatenate([good, bad]))
    errors = GOOD_COUNTS * np.searchsorted(good, cuts) / len(good) + 1 - np.searchsorted(bad, cuts) / len(bad)
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    below = bad[bad < cuts[best[0]]]
    # In the middle of the gap between the kinds, nearer to neither.
    return float((cuts[best[0]] + (below.max() if len(below) else cuts[best[0]])) / 2)


def kth_key(scored: DataFrame, k: int) -> int:
    """The k-th largest key, found by counts of ever shorter ranges of keys; none of them has over 2 ** 16 parts or so."""
    if k <= 0:
        return 1 << 62
    low, left = None, k
    rows = scored.select("_key")
    for bits in (28, 12, 0):
        inside = rows if low is None else rows.filter((F.col("_key") >= low) & (F.col("_key") < high))
        parts = inside.groupBy(F.shiftright("_key", bits).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
        if not parts:
            return NO_CUT
        for part in sorted(parts, key=lambda p: -p.part):
            if part.n >= left:
                break
            left -= part.n
        low, high = part.part << bits, (part.part + 1) << bits
    return low


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Model, DataFrame]:
    """The model, and doc_id, _log_weight, _key of every row as a written table."""
    labelled = written(labelled_rows(labels), "labelled")
    weights = log_ratios(*count_models(docs, labelled))
    rows = _with_labels(with_keys(docs.select("doc_id", "text"), Model(weights)).drop("text"), labelled)
    scored = written(rows, "weights")
    cut = best_cut(scored)
    k = scored.filter(F.col("_log_weight") >= cut).count() if np.isfinite(cut) else None
    return Model(weights, cut, NO_CUT if k is None else kth_key(scored, k)), scored


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, log_weight, gumbel_key, kept: one row per row of `docs`.

    A null text counts as empty; an empty one has weight 0. A null doc_id is never labelled. Keys that tie with the k-th
    largest all stay. Repeated rows count as often as they are there. Without labels of both kinds there is nothing to
    go by, and all documents stay. Other columns are ignored. No documents, no rows.
    """
    model, scored = fit(docs, labels)
    return scored.select(
        "doc_id",
        F.col("_log_weight").alias("log_weight"),
        (F.col("_key") / F.lit(STEPS)).alias("gumbel_key"),
        (F.col("_key") >= model.least_key).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that `score` keeps, with all their columns."""
    model, _ = fit(docs, labels)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return with_keys(docs, model).filter(F.col("_key") >= model.least_key).select(*columns)
