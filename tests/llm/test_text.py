"""Decontamination, quality and packing."""

from __future__ import annotations

import gc
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from laborlake.llm import decontaminate as dc
from laborlake.llm import jaccard_join as jj
from laborlake.llm import packing, textscan
from laborlake.llm import quality_classifier as qc
from laborlake.llm.queries import op7_decontamination, op8_quality_rules, op9_quality_classifier, op10_packing, tokenizer_path


def fewest_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        new = [i + 1]
        for j, x in enumerate(text):
            new.append(min(row[j] + (c != x), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_within_the_budget(seed):
    rng = random.Random(seed)
    words = ["the", "of", "and", "thanea", "onre", "ersh", "inati", "bleou", "ing", "st"]
    items = [(i, dc.plain(" ".join(rng.choice(words) for _ in range(rng.randint(10, 40))))) for i in range(15)]
    index = dc.Index([(i, t) for i, t in items if len(t) >= dc.LEAST])
    texts = ["", "x"]
    for _ in range(60):
        text = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, len(text) // 9)):
            at = rng.randrange(len(text))
            text[at : at + rng.randint(0, 1)] = rng.choice("abcxyz") * rng.randint(0, 1)
        around = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(2)]
        texts.append(around[0] + "  " + "".join(text).upper() + "\n" + around[1])
    for text, found in zip(texts, dc.find(index, texts), strict=True):
        seen = dc.plain(text)
        edits = {i: fewest_edits(t, seen) for i, t in zip(index.ids, index.texts, strict=True)}
        assert {m[0]: m[1] for m in found} == {i: e for i, e in edits.items() if e <= dc.budget(len(items[i][1]))}
        for item, e, start, end in found:
            assert fewest_edits(items[item][1], seen[start:end]) == e


def test_passages_in_odd_documents(spark, odd):
    rows = op7_decontamination(spark, odd).filter("contaminated").collect()
    assert [(r.item_ids, r.fewest_edits) for r in rows] == [([1, 2], 0)]


def test_a_benchmark_of_several_blocks(spark, odd, monkeypatch):
    whole = op7_decontamination(spark, odd).collect()
    monkeypatch.setattr(dc, "BLOCK", 60)
    assert Counter(map(str, op7_decontamination(spark, odd).collect())) == Counter(map(str, whole))


WORD = re.compile("[^\x20\x09-\x0d]+")


def counts(text):
    words = WORD.findall(text or "")
    seen, covered = Counter(zip(words, words[1:], words[2:])), set()
    for i in range(len(words) - 2):
        if seen[tuple(words[i : i + 3])] > 1:
            covered.update(range(i, i + 3))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_counts_of_odd_documents(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet").select("doc_id", "text").collect()
    rows = op8_quality_rules(spark, odd).collect()
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[n] for n in names) for r in rows) == Counter((d, *counts(t)) for d, t in docs)
    assert not any(r.kept and r.base_failed for r in rows)


def test_distances(spark):
    """Both distances of given documents, worked out anew from the definition."""
    from laborlake.llm import quality_rules as qr

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang", "text").collect()
    common, words_of, classes = {}, Counter(), {}

    def plain(word):
        return "".join(c for c in word if c.isalpha() or c.isnumeric()).lower()

    def kinds(text):
        rest, out = re.sub("[ \t-\r]", "", text), []
        for test in (lambda c: c.islower() and c.isalpha(), lambda c: c.isupper(), str.isalpha, str.isnumeric, lambda c: c in ".,;:!?'\"()-"):
            kept = "".join(c for c in rest if not test(c))
            out.append(len(rest) - len(kept))
            rest = kept
        return np.array([*out, len(rest)], float)

    def js(p, q):
        m = (p + q) / 2
        part = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m, strict=True) if x > 0)
        return math.sqrt(max(0, (part(p) + part(q)) / 2))

    for r in docs:
        words = WORD.findall(r.text)
        words_of[r.lang] += len(words)
        common.setdefault(r.lang, Counter()).update(w for x in words if (w := plain(x)))
        classes[r.lang] = classes.get(r.lang, 0) + kinds(r.text)
    got = {r.doc_id: r for r in op8_quality_rules(spark, "/root/testdata/sf0.001").collect()}
    for r in docs:
        top = sorted(common[r.lang].items(), key=lambda x: (-x[1], x[0]))[: qr.COMMON]
        words = WORD.findall(r.text)
        own = Counter(plain(w) for w in words)
        p = np.array([own[w] for w, _ in top]) / len(words)
        q = np.array([n for _, n in top]) / words_of[r.lang]
        word_distance = js(np.append(p, 1 - p.sum()), np.append(q, 1 - q.sum()))
        assert got[r.doc_id].word_distance == pytest.approx(word_distance, abs=1e-9)
        class_distance = js(kinds(r.text) / kinds(r.text).sum(), classes[r.lang] / classes[r.lang].sum())
        assert got[r.doc_id].class_distance == pytest.approx(class_distance, abs=1e-9)
        far = class_distance > qr.MAX_CLASS_DISTANCE or word_distance > qr.MAX_WORD_DISTANCE + qr.CHANCE / math.sqrt(len(words))
        windows = Counter(zip(words, words[1:], words[2:], strict=False))
        covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if windows[w] > 1 for k in range(3)}
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        assert (got[r.doc_id].base_failed, got[r.doc_id].kept) == (failed, not failed and (words_of[r.lang] < qr.MIN_REFERENCE or not far))


def test_long_and_rare_words_can_be_common(spark, save):
    """Words of any length are in the histograms, and no share of the language is too small for its most frequent words."""
    words = [f"w{i:06d}" for i in range(6000)]
    texts = ["International, " * 70 + "sea " * 30 + "a " * 400] + [" ".join(words[i : i + 100]) for i in range(0, 6000, 100)] + ["w000000 w000001"]
    rows = [(i, t, "en" if i == 0 else "xx", "s", 1) for i, t in enumerate(texts)] + [(900 + i, "a " * 500, "en", "s", 1) for i in range(2)]
    path = save(documents=rows)
    from laborlake.llm import quality_rules as qr

    common = {r.lang: r for r in qr.common_words(spark.read.parquet(f"{path}/documents.parquet")).collect()}
    assert common["en"][1:] == (["a", "international", "sea"], [1400, 70, 30])
    assert common["xx"][1:] == (words[: qr.COMMON], [2, 2] + [1] * (qr.COMMON - 2))
    p, q = (np.array(x) / sum(x) for x in ([400, 70, 30], [1400, 70, 30]))
    m = (p + q) / 2
    want = math.sqrt(sum((x * np.log2(x / m)).sum() for x in (p, q)) / 2)
    got = {r.doc_id: r.word_distance for r in op8_quality_rules(spark, path).collect()}
    assert got[0] == pytest.approx(want, abs=1e-9)


def test_rules_keep_good_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = op8_quality_rules(spark, sf_dir).filter("not base_failed").join(labels, "doc_id").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.3


def test_held_out_labels(spark, tmp_path):
    """Fitted with half of the labels, the other half is told apart."""
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = qc.score(docs, labels.filter("hash(doc_id) % 2 = 0")).join(labels.filter("hash(doc_id) % 2 != 0"), "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and r.toxic == 0]
    bad = [r.kept for r in rows if r.quality == 0]
    toxic = [r.kept for r in rows if r.quality == 1 and r.toxic == 1]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.3 and np.mean(toxic) <= 0.5


def test_without_labels_all_stay(spark, odd, save):
    docs = [tuple(r) for r in spark.read.parquet(f"{odd}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert all(r.kept for r in op9_quality_classifier(spark, save(documents=docs)).collect())


def test_the_largest_keys_stay(spark, odd):
    rows = op9_quality_classifier(spark, odd).collect()
    kept, gone = ([r.gumbel_key for r in rows if r.kept == k] for k in (True, False))
    assert len(kept) + len(gone) == len(rows) and (not gone or min(kept) > max(gone))


def test_scoring_many_texts_takes_little_memory():
    rng = np.random.default_rng(4)
    texts = [" ".join(map(str, rng.integers(0, 10**6, 300).tolist())) for _ in range(4000)]
    weights = rng.normal(size=2 * qc.BUCKETS)
    want = [float(qc._score(weights, [t])[0]) for t in texts[::500]]
    tracemalloc.start()
    got = qc._score(weights, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[::500].tolist() == want
    assert peak < 100e6


def test_kth_key(spark):
    rng = random.Random(1)
    keys = [rng.choice([5, -7, rng.randint(-(10**9), 10**9)]) for _ in range(3000)]
    frame = spark.createDataFrame([(k,) for k in keys], "_key long")
    for k in (1, 2, 700, 2999, 3000):
        assert qc.kth_key(frame, k) == sorted(keys, reverse=True)[k - 1]


@pytest.mark.parametrize("parts", [jj._parts, lambda batch: textscan.text_slices(batch["text"], 1000)])
def test_batches_are_freed_as_soon_as_they_are_done(parts):
    """No cycle keeps a batch's texts until Python looks for such."""
    gc.collect()
    gc.disable()
    tracemalloc.start()
    try:
        for n in range(8):
            batch = pd.DataFrame({"text": [f"{n} {i} ".ljust(2000, "x") for i in range(1000)]})
            assert len(list(parts(batch)))
            del batch
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
        gc.enable()
    assert held < 2e6


def test_distinct():
    x = np.random.default_rng(2).integers(0, 50, 400).astype(np.uint64)
    for n in (0, 1, 2, 400):
        assert textscan.distinct(x[:n]).tolist() == sorted(set(x[:n].tolist()))


def test_word_hashes(monkeypatch):
    monkeypatch.setattr(textscan, "PIECE", 64)
    rng = random.Random(2)
    texts = ["", " ", "A bc\tA\n", "ab" * 100, *(" ".join(rng.choice(["a", "B", "é", "abc" * 30, "\n"]) for _ in range(rng.randint(0, 60))) for _ in range(50))]
    hashes, starts = textscan.word_hashes(texts)
    words = [[re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(t)] for t in texts]
    assert np.diff(starts).tolist() == [len(w) for w in words]
    names = {}
    for word, h in zip([w for ws in words for w in ws], hashes.tolist(), strict=True):
        assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)
    pairs, pair_starts = textscan.windows(hashes, starts, 2)
    assert np.diff(pair_starts).tolist() == [max(0, len(w) - 1) for w in words] and len(pairs) == pair_starts[-1]


def tokens(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return [[*e.ids, 0] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_odd_documents_are_packed(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet").select("doc_id", "text").collect()
    rows = op10_packing(spark, odd).collect()
    want = Counter()
    for (d, _), ids in zip(docs, tokens([t for _, t in docs]), strict=True):
        for at in range(0, len(ids), 1024):
            piece = np.array(ids[at : at + 1024], "<u4")
            want[(d, at, len(piece), zlib.crc32(piece.tobytes()), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    check_packs(rows)


def check_packs(rows):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(by) == list(range(len(by)))
    for pieces in by.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 1024


def test_little_padding(spark):
    rows = op10_packing(spark, "/root/testdata/sf0.01").collect()
    check_packs(rows)
    assert sum(r.length for r in rows) >= 0.99 * 1024 * (1 + max(r.sequence_id for r in rows))


@pytest.mark.parametrize("seed", range(5))
def test_patterns_hold_the_histogram(seed):
    rng = random.Random(seed)
    histogram = {n: rng.randint(1, 50) for n in rng.sample(range(1, 1024), 60)}
    held = Counter()
    for pattern, count in packing.shortest_pack_first(histogram):
        assert sum(pattern) <= 1024 and count > 0
        for length in pattern:
            held[length] += count
    assert held == histogram


def test_a_length_goes_to_the_shortest_pack_that_is_open():
    assert sorted(packing.shortest_pack_first({700: 1, 600: 1, 300: 1})) == [((600, 300), 1), ((700,), 1)]
    assert sorted(packing.shortest_pack_first({600: 3, 300: 2, 100: 2})) == [((600, 100, 100), 1), ((600, 300), 2)]


@pytest.mark.parametrize("seed", range(5))
def test_patterns_are_those_of_one_length_at_a_time(seed):
    """The same number of packs of each fill as with a heap of packs that takes every single length; those of a length that fit
    nowhere open a pack each."""
    import heapq

    rng = random.Random(seed)
    histogram = {n: rng.randint(1, 9) for n in rng.sample(range(1, 1024), 40)}
    packs: list[int] = []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and packs and packs[0] + length <= 1024:
            heapq.heapreplace(packs, packs[0] + length)
            left -= 1
        for _ in range(left):
            heapq.heappush(packs, length)
    fills = Counter()
    for pattern, count in packing.shortest_pack_first(histogram):
        fills[sum(pattern)] += count
    assert fills == Counter(packs)


def test_a_token_that_the_text_spells(spark):
    encoder = packing.Encoder(tokenizer_path())
    assert np.frombuffer(encoder.encode("a <|endoftext|> b"), "<u4").tolist() == [64, 220, 50256, 275]


def test_encoder_agrees_with_the_tokenizer():
    rng = random.Random(7)
    parts = [" ", "  ", "\n", "\t", "a", "The", "it's", "é", "ß", "12", "...", "###", " ", " ", "x", "\x1c", "日", "|", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    encoder = packing.Encoder(tokenizer_path())
    for text, ids in zip(texts, tokens(texts), strict=True):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids[:-1], repr(text)


def test_short_items_are_sought_as_whole_words(spark, save):
    rng = random.Random(4)
    pool = ["what", "is", "2+2?", "who", "a", "cat", "cats", "capital", "of", "france", "(x)", "aaaa", "aa"]
    items = [(i, dc.plain(" ".join(rng.choice(pool) for _ in range(rng.randint(1, 7))))) for i in range(60)]
    index = dc.Index([(i, t) for i, t in items if len(t) < dc.LEAST])
    texts = [" ".join(rng.choice([*pool, "x" + rng.choice(pool), rng.choice(pool) + "s,"]) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    for text, found in zip(texts, dc.find(index, texts), strict=True):
        want = {}
        for i, t in zip(index.ids, index.texts, strict=True):
            at = [m.start() for m in re.finditer(f"(?={re.escape(t)})", text)]
            at = [x for x in at if not (text[x - 1 : x].isalnum() and t[0].isalnum()) and not (text[x + len(t) : x + len(t) + 1].isalnum() and t[-1].isalnum())]
            if at:
                want[i] = (0, at[0], at[0] + len(t))
        assert {m[0]: m[1:] for m in found} == want
    assert dc.find(dc.Index([(1, "首都は何ですか")]), ["日本の首都は何ですかと"]) == [[(1, 0, 3, 10)]]

    question, texts = "What is the capital of France?", ["So: what  is the Capital of France? Yes.", "what is the capital of frances", "no"]
    path = save(documents=[(i, t, "en", "s", 1) for i, t in enumerate(texts)], benchmark=[(1, question), (2, " ")])
    docs, benchmark = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "benchmark"))
    assert {r.doc_id for r in dc.decontaminate(docs, benchmark).collect()} == {1, 2}
