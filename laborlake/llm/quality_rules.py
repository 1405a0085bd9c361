"""Quality rules: plain counts, and how far a document's characters and common words are from its language's.

Two histograms of each document are compared with those of its whole language by Jensen-Shannon distance: classes of
characters, and the COMMON most frequent words of the language beside all others. The references are sums over all
documents. A document with fewer than MIN_WORDS words fails the base rules anyway, and a reference of fewer than
MIN_REFERENCE words judges nobody.

DataFrame operations only. Counts stay within a row; what is shuffled are the counts of words by language, summed in each
task first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laborlake.llm.common import written

MIN_WORDS = 50
#: References are broadcast for so many languages at most, under a kilobyte each.
BROADCAST_LANGUAGES = 10_000
MIN_REFERENCE = 1000
COMMON = 24
#: Largest Jensen-Shannon distance (base 2, so 0 to 1) from the language that is kept. That of words has a share that
#: falls with the root of their number, as a short text is far from any histogram by chance.
MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.27
CHANCE = 0.7
SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
#: Classes of characters, in the order in which they are taken out of the text; what is left is the last class.
CLASSES = {
    "lower": r"\p{Ll}+",
    "upper": r"\p{Lu}+",
    "letter": r"\p{L}+",
    "digit": r"\p{N}+",
    "stop": r"[.,;:!?'\"()\-]+",
}


def _pick(cls: str) -> str:
    return f"_h_{cls}"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, "[\x20\x09-\x0d]+"), lambda w: w != "")


def repeated_windows(words: str, width: int = 3) -> Column:
    """How many words stand in windows of `width` words that the array holds twice or more.

    Windows are sorted by hash with their places; equal neighbours give the places of repeated windows, and sorted places
    the words that they cover. Sorting keeps this near linear for texts of any length.
    """
    firsts = F.slice(words, F.lit(1), F.greatest(F.size(words) - (width - 1), F.lit(0)))
    hashes = F.transform(firsts, lambda w, i: F.xxhash64(w, *[F.get(F.col(words), i + k) for k in range(1, width)]))

    def places(ordered: Column) -> Column:
        def repeated(x: Column, i: Column) -> Column:
            return (x["h"] == F.get(ordered, i - 1)["h"]) | (x["h"] == F.get(ordered, i + 1)["h"])

        twice = F.filter(ordered, lambda x, i: F.coalesce(repeated(x, i), F.lit(False)))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        each = F.transform(at, lambda p, i: F.least(F.lit(width), F.coalesce(F.get(at, i + 1) - p, F.lit(width))))
        return F.aggregate(each, F.lit(0), lambda a, b: a + b)

    def count(found: Column) -> Column:
        windows = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        at = F.transform(F.array(windows), places)
        return F.when(F.size(F.array_distinct(found)) < F.size(found), F.get(F.transform(at, covered), 0)).otherwise(0)

    # An array of one, so that what is made of it is made once.
    return F.get(F.transform(F.array(hashes), count), 0)


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the base counts, the class histogram (_h_...), and the text in `_text`, for each row of `docs`."""
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("lang"), F.lit("")).alias("lang"),
        F.coalesce(F.col("text"), F.lit("")).alias("_text"),
    )
    rows = rows.withColumn("_words", _words(F.col("_text")))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    lost = F.get(F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x))), 0)
    rows = rows.select(
        "doc_id",
        "lang",
        "_text",
        F.size("_words").cast("long").alias("n_words"),
        lost.cast("long").alias("n_dup_lines"),
        repeated_windows("_words").cast("long").alias("n_repeat_words"),
        F.array_join("_words", "").alias("_rest"),
    )
    rows = rows.withColumn("word_chars", F.char_length("_rest").cast("long"))
    for cls, pattern in CLASSES.items():
        rows = rows.withColumn("_less", F.regexp_replace("_rest", pattern, ""))
        rows = rows.withColumn(_pick(cls), (F.char_length("_rest") - F.char_length("_less")).cast("double"))
        rows = rows.withColumn("_rest", F.col("_less"))
    # No class before takes symbols out, so all are among what is left.
    symbols = F.char_length("_rest") - F.char_length(F.translate("_rest", SYMBOLS, ""))
    rows = rows.withColumns({"n_symbols": symbols.cast("long"), _pick("other"): F.char_length("_rest").cast("double")})
    return rows.drop("_rest", "_less")


def _plain(text: Column) -> Column:
    """Words without signs, in lower case, with the white space between them."""
    return F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}\x20\x09-\x0d]+", ""))


def common_words(docs: DataFrame) -> DataFrame:
    """lang, _common (words, most frequent first), _times (how often each): one row per language that has words."""
    words = _words(_plain(F.coalesce(F.col("text"), F.lit(""))))
    each = docs.select(F.coalesce(F.col("lang"), F.lit("")).alias("lang"), F.explode(words).alias("_word"))
    counts = each.groupBy("lang", "_word").agg(F.count(F.lit(1)).alias("_n"))
    # Each task ranks its own words first and passes on COMMON of a language at most.
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("_n"), "_word"))
    top = counts.withColumn("_rank", rank).filter(F.col("_rank") <= COMMON)
    top = top.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("_rank", "_word", "_n"))).alias("_top"))
    return top.select("lang", F.transform("_top", lambda x: x["_word"]).alias("_common"), F.transform("_top", lambda x: x["_n"]).alias("_times"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two arrays of shares."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    parts = F.zip_with(p, q, lambda a, b: (part(a, b) + part(b, a)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)))


def _shares(columns: list[str]) -> Column:
    total = reduce(lambda a, b: a + b, [F.col(c) for c in columns])
    return F.array(*[F.coalesce(F.try_divide(F.col(c), total), F.lit(0.0)) for c in columns])


def _found(text: str, common: str, n_words: str) -> Column:
    """Shares of the common words among all words of a text, by their places among the common ones, other words dropped."""
    # Most words are longer than any common one, which is seen before any comparison.
    longest = F.array_max(F.transform(common, F.octet_length))
    plain = _words(_plain(F.col(text)))
    left = F.get(F.transform(F.array(longest), lambda n: F.filter(plain, lambda w: (F.octet_length(w) <= n) & F.array_contains(F.col(common), w))), 0)
    places = F.transform(left, lambda w: F.array_position(F.col(common), w))

    def shares(at: Column) -> Column:
        return F.transform(common, lambda _, k: (F.size(at) - F.size(F.array_remove(at, k.cast("long") + 1))) / F.col(n_words))

    return F.get(F.transform(F.array(places), shares), 0)


def _with_rest(shares: Column) -> Column:
    rest = 1 - F.aggregate(shares, F.lit(0.0), lambda a, b: a + b)
    return F.concat(shares, F.array(F.greatest(F.lit(0.0), rest)))


def _joined(rows: DataFrame, references: DataFrame) -> DataFrame:
    """Each row with its language's reference, which is broadcast if there are few enough languages."""
    references = references.withColumnRenamed("lang", "_lang")
    few = references.count() <= BROADCAST_LANGUAGES
    references = F.broadcast(references) if few else references
    return rows.join(references, F.col("lang") == F.col("_lang"), "left").drop("_lang")


def judge(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, the base counts, base_failed, class_distance, word_distance, kept.

    A null text counts as empty and fails the base rules by having no words; a null lang is a language of its own, as is any
    other value. Repeated rows count as often as they are there. A document whose language has fewer than MIN_REFERENCE words in
    all gets null distances and is kept if the base rules keep it. Other columns are ignored.
    """
    plain = docs.select("doc_id", "lang", "text")
    common = written(common_words(plain), "common")
    rows = _joined(measures(plain), common.drop("_times"))
    rows = rows.withColumn("_found", F.when(F.col("n_words") > 0, _found("_text", "_common", "n_words")))
    rows = written(rows.drop("_text", "_common"), "measures")
    names = [*CLASSES, "other"]
    sums = [F.sum(_pick(c)).alias(f"_r_{c}") for c in names]
    languages = rows.groupBy("lang").agg(F.sum("n_words").alias("_total"), *sums).join(common.drop("_common"), "lang", "left")
    rows = _joined(rows, written(languages, "languages"))
    expected = F.transform("_times", lambda n: n / F.col("_total"))
    known = (F.col("_total") >= MIN_REFERENCE) & (F.col("n_words") > 0)
    rows = rows.withColumns(
        {
            "class_distance": F.when(known, js_distance(_shares([_pick(c) for c in names]), _shares([f"_r_{c}" for c in names]))),
            "word_distance": F.when(known, js_distance(_with_rest(F.col("_found")), _with_rest(expected))),
            "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        }
    )
    far = (F.col("class_distance") > MAX_CLASS_DISTANCE) | (
        F.col("word_distance") > MAX_WORD_DISTANCE + CHANCE / F.sqrt("n_words")
    )
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "class_distance",
        "word_distance",
        (~F.col("base_failed") & ~F.coalesce(far, F.lit(False))).alias("kept"),
    )
