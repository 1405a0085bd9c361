"""Suffix dedup, Jaccard join and line dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from laborlake.llm import components as connected
from laborlake.llm import jaccard_join as jj
from laborlake.llm import suffix_dedup as sd
from laborlake.llm.components import components
from laborlake.llm.queries import op1_suffix_dedup, op2_jaccard_join, op4_line_dedup

LENGTH = 400


def as_documents(texts):
    return [(i, t, "en", "s", 0) for i, t in enumerate(texts)]


def remove_repeats(texts):
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + LENGTH] for t in texts for i in range(len(t) - LENGTH + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - LENGTH + 1):
            if seen[t[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check_repeats(spark, folder):
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = Counter((d, *r) for (d, _), r in zip(docs, remove_repeats([t for _, t in docs]), strict=True))
    assert Counter(map(tuple, op1_suffix_dedup(spark, folder).collect())) == want


def test_suffixes_of_odd_documents(spark, odd):
    check_repeats(spark, odd)


@pytest.mark.parametrize("seed", [1, 2])
def test_suffixes_of_mixed_pieces(spark, save, seed, monkeypatch):
    monkeypatch.setattr(sd, "BUCKET", 3000)  # many buckets, so that grams go on across their edges
    rng = random.Random(seed)
    pieces = ["".join(rng.choice("abcdef ") for _ in range(rng.choice([150, 399, 400, 401, 700, 1500]))) for _ in range(8)]
    texts = []
    for _ in range(150):
        if rng.random() < 0.15:
            texts.append((rng.choice(["ab", "Shti ", "x", "abcabd"]) * rng.randint(1, 900))[: rng.randint(0, 2500)])
        else:
            parts = rng.randint(0, 4)
            texts.append("".join(rng.choice(pieces) if rng.random() < 0.6 else "".join(rng.choice("ghi ") for _ in range(rng.randint(0, 300))) for _ in range(parts)))
    check_repeats(spark, save(documents=as_documents(texts)))


def test_long_texts_are_sampled_in_pieces(monkeypatch):
    rng = random.Random(3)
    text = bytes(rng.choice(b"abcdefgh ") for _ in range(9000))
    whole = sd.sampled_suffixes([text])[:5]
    monkeypatch.setattr(sd, "PIECE", 1000)
    parts = sd.sampled_suffixes([text])[:5]
    windows = [{(p, s) for p, a, b in zip(x[1], x[2], x[3], strict=True) for s in range(a, b + 1)} for x in (whole, parts)]
    assert windows[0] == windows[1] and len(windows[0]) == len(text) - LENGTH + 1


def test_sampling_many_bytes_takes_little_memory():
    rng = np.random.default_rng(4)
    texts = [rng.integers(97, 123, 2000, dtype=np.uint8).tobytes() for _ in range(2000)]
    texts.append(rng.integers(97, 123, 2_000_000, dtype=np.uint8).tobytes())
    sd.sampled_suffixes(texts[:1])
    tracemalloc.start()
    sd.sampled_suffixes(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6


def test_a_batch_of_many_windows_is_sorted_in_parts(monkeypatch):
    """Parts end where a gram does, whatever the batches, and find what one sort of all finds."""
    rng = random.Random(5)
    sorted_together = []
    equal = sd.equal_windows
    monkeypatch.setattr(sd, "equal_windows", lambda blocks: (sorted_together.append(int(blocks["windows"].sum())), equal(blocks))[1])
    stock = ["".join(rng.choice("abcd") for _ in range(LENGTH + 49)).encode() for _ in range(60)]
    rows = [(x[:16], gram, i, 10 * gram + i, 7, 30, 50, x) for gram, x in enumerate(stock) for i in range(rng.choice([1, 2, 3]))]
    batch = pd.DataFrame(rows, columns=[c.split()[0] for c in sd.CUT.split(", ")])

    def spans(size):
        monkeypatch.setattr(sd, "SORTED", size)
        sorted_together.clear()
        return {tuple(r) for found in sd._merge_edges(iter(sd._sort_bucket(1)(iter([batch])))) for r in found.itertuples(index=False)}

    whole = spans(10**6)
    assert sorted_together == [50 * len(rows)] and whole
    assert spans(500) == whole
    assert max(sorted_together) <= 1500


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def groups(rows):
    """(doc_id, size, smallest reachable id) of each row, by all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    ids = sorted(set(sets) - {frozenset()}, key=sorted)
    with_shingle = defaultdict(list)
    for i, s in enumerate(ids):
        for x in s:
            with_shingle[x].append(i)
    up = list(range(len(ids)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in {(i, j) for together in with_shingle.values() for i in together for j in together if i < j}:
        if 100 * len(ids[a] & ids[b]) >= 80 * len(ids[a] | ids[b]):
            up[root(a)] = root(b)
    place = {s: root(i) for i, s in enumerate(ids)}
    least = {}
    for (d, _), s in zip(rows, sets, strict=True):
        if s and d is not None:
            least[place[s]] = min(least.get(place[s], d), d)
    return Counter((d, len(s), least.get(place[s]) if s else d) for (d, _), s in zip(rows, sets, strict=True))


def check_groups(spark, folder):
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(map(tuple, op2_jaccard_join(spark, folder).collect())) == groups(docs)


def test_groups_of_odd_documents(spark, odd):
    check_groups(spark, odd)


def test_groups_of_many_near_copies(spark, save, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK", 5)
    rng = random.Random(9)
    texts = []
    for size in (9, 12, 25, 60, 160):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        for _ in range(30):
            words = list(base)
            for _ in range(rng.randint(0, max(1, size // 20))):
                at = rng.randrange(len(words))
                words[at : at + rng.randint(0, 1)] = [f"n{rng.randrange(10**6)}"] * rng.randint(0, 2)
            texts.append(" ".join(words))
    check_groups(spark, save(documents=as_documents(texts)))


@pytest.mark.parametrize("size", [4, 5, 7, 8, 13, 40, 200])
def test_pigeonhole(size):
    """A partner at the very bound shares a key that the smaller set may search by."""
    rng = np.random.default_rng(size)
    for _ in range(60):
        pool = rng.integers(1, 2**63, 3 * size).astype(np.uint64)
        errors = jj.errors_allowed(size)
        out = int(rng.integers(0, errors + 1))
        small = np.unique(pool[:size])
        large = np.unique(np.concatenate([pool[out:size], pool[size : size + min(errors, jj.largest_partner(size) - size + out)]]))
        both = len(np.intersect1d(small, large))
        if 100 * both < 80 * (len(small) + len(large) - both) or len(large) < len(small):
            continue
        keys, codes = jj.keys_of(small)
        _, high = jj.band_bounds(len(small)) if errors else (0, 0)
        if errors:
            shared = np.isin(keys[codes == jj.OWN], jj.keys_of(large)[0])
            assert (~shared).sum() <= errors and shared.sum() >= jj.segments_of(high) - errors
        elif len(small) == len(large):
            assert (small == large).all()


def test_sketches_never_drop_a_pair():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(1, 2**63, rng.integers(1, 300)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.integers(0, 2, len(a)) > 0], rng.integers(1, 2**63, rng.integers(1, 90)).astype(np.uint64)]))
        assert jj.differing_bits(jj.sketch(a), jj.sketch(b)) <= len(np.setxor1d(a, b))


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (200, 200), (7, 3)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {101: 100, 102: 100}


def counted_writes(monkeypatch):
    """Labels of the tables that the join writes from now on."""
    labels = []
    for module in (jj, connected):
        write = module.written
        monkeypatch.setattr(module, "written", lambda df, label, write=write: (labels.append(label), write(df, label))[1])
    return labels


def test_components_stop_with_stars(spark, monkeypatch):
    """Links that are stars after a round need no second one to see that nothing changes."""
    labels = counted_writes(monkeypatch)
    links = [(9, i) for i in range(10, 60)] + [(70, 71), (72, 71), (71, 70), (80, 80)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 9 for i in range(10, 60)} | {71: 70, 72: 70}
    assert labels == ["links"]


def test_components_without_links(spark):
    assert components(spark.createDataFrame([(3, 3)], "a long, b long")).collect() == []


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_of_random_links(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 7) for i in range(400, 500)]
    least = {x: x for link in links for x in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(least[a], least[b])
            changed |= least[a] != m or least[b] != m
            least[a] = least[b] = m
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: m for x, m in least.items() if x != m}


def test_groups_are_found_in_few_steps(spark, save, monkeypatch):
    """Each step is a shuffle over all partitions, however few rows are left; pairs across components have had their sketches
    compared when they become rows."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    texts = [" ".join([*base[:at], f"n{at}", *base[at + 1 :]]) for at in range(0, 120, 3)] + [" ".join(base)] * 3
    labels = counted_writes(monkeypatch)
    check_groups(spark, save(documents=as_documents(texts)))
    assert labels.count("near") == 1
    assert len(labels) <= 18


def dedup_lines(rows, least=40):
    """Of every line, the longest run from there that an earlier place has as well; all of it goes if it is long enough."""
    places, sequences, out = {}, [], {}
    for key in sorted(set(rows), key=lambda r: (r[0] is not None, r[0])):
        text = key[1]
        if text is None:
            out[key] = (None, 0, 0)
            continue
        lines = text.split("\n")
        full = [i for i, line in enumerate(lines) if line.strip(" ")]
        names, gone = [lines[i] for i in full], set()
        sequences.append(names)
        for a, name in enumerate(names):
            longest = 0
            for d, j in places.get(name, ()):
                n = 0
                while a + n < len(names) and j + n < len(sequences[d]) and sequences[d][j + n] == names[a + n]:
                    n += 1
                longest = max(longest, n)
            if sum(map(len, names[a : a + longest])) >= least:
                gone.update(full[a : a + longest])
            places.setdefault(name, []).append((len(sequences) - 1, a))
        for a, b in zip(full, full[1:], strict=False):
            if a in gone and b in gone:
                gone.update(range(a, b))
        runs = sum(i - 1 not in gone for i in gone)
        out[key] = ("\n".join(line for i, line in enumerate(lines) if i not in gone), len(gone), runs)
    return out


def test_lines(spark, save):
    rng = random.Random(4)
    stock = ["".join(rng.choice("abc ") for _ in range(rng.choice([1, 5, 13, 30, 39, 40, 90]))) for _ in range(15)]
    texts = ["\n".join(rng.choice(["", "  ", *stock, *stock]) for _ in range(rng.randint(0, 25))) for _ in range(80)]
    texts += [texts[3], "\n".join(["same line"] * 60), None, "", "x" * 500, "x" * 500 + "\n" + "x" * 500]
    folder = save(documents=as_documents(texts))
    want = dedup_lines([(i, t) for i, t in enumerate(texts)])
    got = {(r.doc_id, texts[r.doc_id]): (r.kept_text, r.n_removed_lines, r.n_runs) for r in op4_line_dedup(spark, folder).collect()}
    assert got == want


def test_lines_of_odd_documents(spark, odd):
    rows = op4_line_dedup(spark, odd).collect()
    texts = {(r.doc_id, r.kept_text) for r in rows}
    assert (500, None) in texts and (None, "the text without an id") in texts
    assert all(r.n_removed_lines <= r.n_lines for r in rows)
