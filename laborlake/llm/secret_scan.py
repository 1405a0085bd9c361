"""Secrets in texts: fixed patterns, and strings that look drawn at random to two character Markov models.

The models are first-order chains over the characters of identifiers. One is trained on what the fixed patterns label as
secret, the other on all words and identifiers that are too short to be judged, both over all documents. Their counts have a
cell for each pair of characters, so what leaves the tasks has a fixed size. A run of such characters is a secret if the
logarithm of the ratio of its likelihoods reaches a threshold.

Everything is SQL functions on one row: matches come from one pass of a pattern, their places from the lengths of the
pieces between them.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the three kinds, and how long a match (of assign: its value) must be.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
# End of the fixed values.

#: Kinds in the order in which spans of one start are listed; the last is the models'.
KINDS = ("assign", "access", "hex", "random")
#: The same matches as ACCESS and HEX without those that are too short, as a longer run cannot start inside one.
LONG_ACCESS = r"AKIA[A-Z0-9]{16,}"
LONG_HEX = r"[0-9a-f]{24,}"
#: What the models read. Runs of CANDIDATE characters are judged; shorter ones, of ORDINARY at least, teach what is usual.
SYMBOLS = "[A-Za-z0-9+/_=-]"
CANDIDATE = 16
ORDINARY = 8
#: Logarithm of the likelihood ratio from which a run is a secret: one run in a million is, and as much again.
THRESHOLD = 2 * math.log(1e6)
#: Half of the random model is uniform, as secrets come in more alphabets than the labelled ones.
UNIFORM = 0.5
#: The ordinary model takes a character's own frequency for so many of its pairs, and that counts each character so much more.
BACKOFF, PSEUDO = 10.0, 0.5
#: Different symbols; the codes of all lie in so many values from the first.
ALPHABET, FIRST_CODE, CODES = 67, 43, 80
#: Matches whose places are added up together; keeps the time for a text linear in its matches.
RUN = 256

_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _placed(lengths: Column, kind: int) -> Column:
    """Spans from (gap, hit, ok) for each match: code points before it, in it, and whether it counts."""

    def one(got: Column, m: Column) -> Column:
        start = got["at"] + m["gap"]
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + m["hit"]).alias("end"))
        return F.struct((start + m["hit"]).alias("at"), F.when(m["ok"], F.concat(got["spans"], F.array(span))).otherwise(got["spans"]).alias("spans"))

    def run(got: Column, matches: Column) -> Column:
        inner = F.aggregate(matches, F.struct(got["at"].alias("at"), F.array().cast(_SPANS).alias("spans")), one)
        return _let(inner, lambda x: F.struct(x["at"].alias("at"), F.concat(got["runs"], F.array(x["spans"])).alias("runs")))

    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / RUN).cast("int")), lambda i: F.slice(lengths, i * RUN + 1, F.lit(RUN)))
    none = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPANS}>").alias("runs"))
    return F.flatten(F.aggregate(runs, none, run)["runs"])


def _matches(text: Column, pattern: str, kind: int, value: int = 0, least: int = 0) -> Column:
    """Spans of the leftmost matches that do not overlap; those whose group `value` has fewer characters are left out."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value)) if value else hits
    zipped = F.transform(
        F.arrays_zip(F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"), hits.alias("hit"), values.alias("value")),
        lambda m: F.struct(m["gap"].alias("gap"), F.length(m["hit"]).alias("hit"), (F.length(m["value"]) >= least).alias("ok")),
    )
    return F.when(text.rlike(pattern), _let(zipped, lambda x: _placed(x, kind))).otherwise(F.array().cast(_SPANS))


def base_spans(text: Column) -> Column:
    """Spans of the three fixed kinds, by start and then kind."""
    found = [
        _matches(text, ASSIGN, 0, value=2, least=LEAST["assign"]),
        _matches(text, LONG_ACCESS, 1, least=LEAST["access"]),
        _matches(text, LONG_HEX, 2, least=LEAST["hex"]),
    ]
    return F.sort_array(F.concat(*found))


def _codes(run: Column) -> Column:
    return F.transform(F.split(run, ""), lambda c: F.ascii(c) - FIRST_CODE)


def _cells(codes: Column) -> Column:
    """For each character but the first, the number of its cell in a model."""
    n = F.greatest(F.size(codes) - 1, F.lit(0))
    return F.zip_with(F.slice(codes, F.lit(1), n), F.slice(codes, F.lit(2), n), lambda a, b: a * CODES + b)


def _without(text: Column, *patterns: str) -> Column:
    for pattern in patterns:
        text = F.regexp_replace(text, pattern, " ")
    return text


def cell_counts(docs: DataFrame) -> DataFrame:
    """secret (boolean), cell, n: pairs of characters in labelled secrets, and in ordinary words and identifiers."""
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    secret = F.concat(
        F.filter(kept, lambda v: F.length(v) >= LEAST["assign"]),
        F.regexp_extract_all(_without(text, ASSIGN), F.lit(LONG_ACCESS), F.lit(0)),
        F.regexp_extract_all(_without(text, ASSIGN, LONG_ACCESS), F.lit(LONG_HEX), F.lit(0)),
    )
    other = F.regexp_extract_all(_without(text, ASSIGN, LONG_ACCESS, LONG_HEX), F.lit(f"{SYMBOLS}{{{ORDINARY},}}"), F.lit(0))
    other = F.filter(other, lambda r: F.length(r) < CANDIDATE)
    labelled = F.concat(
        F.transform(secret, lambda s: F.struct(F.lit(True).alias("secret"), s.alias("run"))),
        F.transform(other, lambda s: F.struct(F.lit(False).alias("secret"), s.alias("run"))),
    )
    runs = docs.select(F.explode(labelled).alias("of")).select("of.secret", F.regexp_replace("of.run", r"\.", "").alias("run"))
    cells = runs.select("secret", F.explode(_cells(_codes(F.col("run")))).alias("cell"))
    return cells.groupBy("secret", "cell").agg(F.count(F.lit(1)).alias("n"))


def weights(counts: DataFrame) -> list[float]:
    """For each cell the logarithm of the ratio of its probabilities, given the first character: random against ordinary.

    `counts` has two rows for each pair of characters at most.
    """
    seen: dict[bool, list[int]] = {True: [0] * (CODES * CODES), False: [0] * (CODES * CODES)}
    for row in counts.collect():
        seen[row.secret][row.cell] = row.n
    ordinary = [sum(seen[False][second::CODES]) + PSEUDO for second in range(CODES)]
    whole = sum(ordinary) - PSEUDO * (CODES - ALPHABET)
    alone = [n / whole for n in ordinary]
    made = []
    for first in range(CODES):
        random, usual = (seen[s][first * CODES : (first + 1) * CODES] for s in (True, False))
        n, m = sum(random), sum(usual)
        for r, o, one in zip(random, usual, alone, strict=True):
            drawn = UNIFORM / ALPHABET + (1 - UNIFORM) * (r / n if n else 1 / ALPHABET)
            made.append(math.log(drawn * (m + BACKOFF) / (o + BACKOFF * one)))
    return made


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` with `_spans` (start, end in code points, kind as in KINDS), by start and then kind.

    Spans of the fixed kinds may overlap each other; those of the models overlap none. Digits alone are a number and no
    secret of the models. Without labelled secrets the random model is uniform; without ordinary words
    both are nearly so, and add little. A null text has no spans. Repeated rows, null ids and other columns stay as they are.
    No rows, no result.
    """
    # One literal that the optimizer reads once; thousands of them would be planned one by one.
    ratios = F.split(F.lit(",".join(map(repr, weights(cell_counts(docs))))), ",").cast("array<double>")
    text = F.coalesce(F.col("text"), F.lit(""))
    candidates = f"{SYMBOLS}{{{CANDIDATE},}}"

    def is_random(run: Column) -> Column:
        total = F.aggregate(_cells(_codes(run)), F.lit(0.0), lambda s, cell: s + F.get(ratios, cell))
        return run.rlike("[A-Za-z]") & (total >= threshold)

    runs = F.regexp_extract_all(text, F.lit(candidates), F.lit(0))
    scored = F.filter(F.arrays_zip(_matches(text, candidates, 3).alias("span"), runs.alias("run")), lambda x: is_random(x["run"]))
    found = docs.withColumns({"_base": base_spans(text), "_random": F.when(text.rlike(candidates), scored["span"]).otherwise(F.array().cast(_SPANS))})
    apart = F.filter("_random", lambda r: ~F.exists("_base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    spans = F.transform(
        F.sort_array(F.concat("_base", apart)),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.get(F.array(*map(F.lit, KINDS)), s["kind"]).alias("kind")),
    )
    return found.withColumn("_spans", spans).drop("_base", "_random")


def listed(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, every character of a secret replaced by `*`; columns as before."""
    done = scan(docs, threshold)

    def step(got: Column, s: Column) -> Column:
        # Spans may overlap: what is behind the last end is still to be copied.
        start = F.greatest(got["at"], s["start"])
        size = F.greatest(s["end"] - start, F.lit(0))
        clear = F.substr("text", got["at"] + 1, start - got["at"])
        return F.struct(F.greatest(got["at"], s["end"]).alias("at"), F.concat(got["parts"], F.array(clear, F.repeat(F.lit("*"), size))).alias("parts"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    whole = F.aggregate("_spans", none, step, lambda got: F.concat(F.array_join(got["parts"], ""), F.substr("text", got["at"] + 1, F.length("text"))))
    return done.withColumn("text", F.when(F.size("_spans") > 0, whole).otherwise(F.col("text"))).drop("_spans")
