"""Quality rules by distribution divergence, DataFrame functions only.

A document's histograms over character classes and over the common words of its language are
compared with the language's own, summed over all its documents, by Jensen-Shannon distance (square
root of the divergence in bits, from 0 for equal to 1 for disjoint). Short texts have noisy
histograms, so each comparison has a least length below which it does not judge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.llm.common import SPACES, staged, word_array

SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20

#: Character classes as regular expressions; what is left is the class of all others, mostly lower-case letters.
CLASSES = {
    "upper": r"\p{Lu}",
    "digit": r"\p{Nd}",
    "space": r"\s",
    "symbol": SYMBOLS,
    "mark": r"\p{P}\p{S}",  # less the symbols, which are all among them
}
MOST_CLASS_DISTANCE, LEAST_CHARACTERS = 0.29, 100
MOST_WORD_DISTANCE, LEAST_JUDGED_WORDS = 0.42, 50
#: A common word is at least this share of its language's words, so a language has 250 of them at most.
COMMON_SHARE = 0.004
#: Slots by hash, in which a language's common words are looked up; a power of two.
SLOTS = 256
UNKNOWN = ""


def characters_of(text: Column, cls: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{cls}]+", ""))


def with_characters(rows: DataFrame, text: str) -> DataFrame:
    """Adds chars, word_chars, n_symbols and ``classes``, the counts by class.

    White space is what separates words. The other classes are looked for in what is left without
    it and a to z, which are in none of them, so the long text is gone over only twice.
    """
    body, left = F.col(text), F.col("_left")
    rows = rows.withColumn("_left", F.regexp_replace(body, r"[a-z\s]+", "")).withColumns(
        {
            "chars": F.length(body).cast("long"),
            "word_chars": F.length(F.regexp_replace(body, f"[{SPACES}]+", "")).cast("long"),
            "n_symbols": characters_of(left, CLASSES["symbol"]).cast("long"),
            "_marks": characters_of(left, CLASSES["mark"]).cast("long"),
            "_upper": characters_of(left, CLASSES["upper"]).cast("long"),
            "_digit": characters_of(left, CLASSES["digit"]).cast("long"),
        }
    )
    counted = {
        "upper": F.col("_upper"),
        "digit": F.col("_digit"),
        "space": F.col("chars") - F.col("word_chars"),
        "symbol": F.col("n_symbols"),
        "mark": F.col("_marks") - F.col("n_symbols"),
    }
    classes = F.array(*[counted[name].cast("double") for name in CLASSES])
    return rows.withColumn("classes", classes).drop("_left", "_marks", "_upper", "_digit")


def with_rest(counts: Column, total: Column) -> Column:
    """The histogram with the class of all other characters at its end."""
    return F.concat(counts, F.array(total - F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of equal length; null if either is empty."""

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.when(x.isNotNull(), F.lit(0.0)))

    def divergence(s: Column) -> Column:
        shares = F.zip_with(
            s["p"], s["q"], lambda a, b: F.struct(F.try_divide(a, s["a"]).alias("a"), F.try_divide(b, s["b"]).alias("b"))
        )
        return F.aggregate(
            shares,
            F.lit(0.0),
            lambda d, v: d + (part(v["a"], (v["a"] + v["b"]) / 2) + part(v["b"], (v["a"] + v["b"]) / 2)) / 2,
        )

    # An array of one struct, so that the totals are summed once and not for every element.
    once = F.array(F.struct(p.alias("p"), q.alias("q"), total(p).alias("a"), total(q).alias("b")))
    found = F.get(F.transform(once, divergence), F.lit(0))
    return F.sqrt(F.when(found < 0, F.lit(0.0)).otherwise(found))


def common_word_counts(rows: DataFrame, hashes: str) -> DataFrame:
    """Adds ``common``, (i, n) of the reference's words in the text: number i occurs n times.

    A word's slot in the reference holds the few words it may be, so a text costs what its words
    cost, however long the reference is. Only what is met is numbered, once a distinct word.
    """

    def slot(h: Column) -> Column:
        return h.bitwiseAND(F.lit(SLOTS - 1)).cast("int")

    def number(h: Column) -> Column:
        return F.get("ref_starts", slot(h)) + F.array_position(F.get("ref_slots", slot(h)), h).cast("int") - 1

    met = F.filter(hashes, lambda h: F.array_contains(F.get("ref_slots", slot(h)), h))
    rows = rows.withColumn("_met", F.sort_array(met))
    ends = F.transform(
        "_met",
        lambda i, k: F.when(
            ~i.eqNullSafe(F.get(F.col("_met"), k + 1)), F.struct(i.alias("h"), (k + 1).alias("end"))
        ),
    )
    rows = rows.withColumn("_ends", F.filter(ends, lambda x: x.isNotNull()))
    counts = F.transform(
        "_ends",
        lambda x, k: F.struct(
            number(x["h"]).alias("i"), (x["end"] - F.coalesce(F.get(F.col("_ends"), k - 1)["end"], F.lit(0))).alias("n")
        ),
    )
    return rows.withColumn("common", F.sort_array(counts)).drop("_met", "_ends")


def word_distance(n_words: Column) -> Column:
    """Distance of ``common`` from the reference; words that the text lacks are one place, all other words another."""
    met = F.transform("common", lambda x: x["n"].cast("double"))
    own = F.transform("common", lambda x: F.get("ref_counts", x["i"]))

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)

    p = F.concat(met, F.array(n_words.cast("double") - total(met), F.lit(0.0)))
    q = F.concat(own, F.array(F.col("ref_rest"), F.col("ref_total") - F.col("ref_rest") - total(own)))
    return js_distance(p, q)


def repeated_words(rows: DataFrame, hashes: str, out: str, window: int = WINDOW) -> DataFrame:
    """Adds ``out``: how many words lie in windows of ``window`` words that occur twice or more in their text.

    All in the row, without a shuffle: hashes of the windows are sorted with their places, and
    neighbours compared. Only texts with a repeat get that far.
    """
    runs, order, places = (f"_{out}_{x}" for x in ("runs", "order", "places"))
    n = F.greatest(F.size(hashes) - (window - 1), F.lit(0))
    # The hashes of a window's words, shifted against each other, side by side.
    shifted = F.arrays_zip(*[F.slice(hashes, at + 1, n).alias(f"w{at}") for at in range(window)])
    rows = rows.withColumn(runs, F.transform(shifted, lambda w: F.xxhash64(w)))
    numbered = F.sort_array(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    rows = rows.withColumn(order, F.when(F.size(F.array_distinct(runs)) < F.size(runs), numbered).otherwise(none))
    twice = F.transform(
        order,
        lambda s, k: F.when(
            (s["h"] == F.get(F.col(order), k - 1)["h"]) | (s["h"] == F.get(F.col(order), k + 1)["h"]), s["i"]
        ),
    )
    rows = rows.withColumn(places, F.sort_array(F.filter(twice, lambda x: x.isNotNull())))
    covered = F.transform(
        places,
        lambda p, k: F.least(F.coalesce(F.get(F.col(places), k + 1) - p, F.lit(window)), F.lit(window)),
    )
    rows = rows.withColumn(out, F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x))
    return rows.drop(runs, order, places)


def base_counts(rows: DataFrame, text: str) -> DataFrame:
    """Adds n_words, n_dup_lines, n_repeat_words, base_failed, the hashes of the words, and ``with_characters``."""
    body = F.col(text)
    with_word = F.filter(F.split(body, "\n"), lambda x: F.regexp_like(x, F.lit(f"[^{SPACES}]")))
    hashes = F.transform(word_array(body), lambda w: F.xxhash64(w))
    rows = rows.withColumns({"hashes": hashes, "lines": with_word}).withColumns(
        {
            "n_words": F.size("hashes").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        }
    )
    rows = with_characters(repeated_words(rows.drop("lines"), "hashes", "n_repeat_words"), text)
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return rows.withColumn("base_failed", failed)


def language_references(rows: DataFrame) -> DataFrame:
    """(ref_lang, ref_classes, ref_slots, ref_counts, ref_starts, ref_total, ref_rest) from (lang, text), one row per language.

    Words are counted by hash, map-side first. Every language with a word has a reference, however
    small its share of the corpus; of its words only those of at least COMMON_SHARE are kept. ref_rest counts the rare words. A language without a common word, such as one that
    does not separate its words, has empty arrays and its classes. The common words go by hash, slot by slot: those of
    slot s are ref_slots[s], numbered from ref_starts[s] up to ref_starts[s + 1].
    """
    words = rows.select("lang", F.explode(word_array(F.col("text"))).alias("word"))
    counted = words.groupBy("lang", F.xxhash64("word").alias("hash")).count()
    counted = staged(counted.select("lang", "hash", F.col("count").cast("double").alias("n")), "words")
    totals = staged(counted.groupBy("lang").agg(F.sum("n").alias("total")), "totals")
    common = (
        counted.join(totals, "lang")
        .filter(F.col("n") >= COMMON_SHARE * F.col("total"))
        .withColumn("slot", F.pmod("hash", F.lit(SLOTS)).cast("int"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("slot", "hash", "n"))).alias("common"), F.first("total").alias("total"))
        .select(
            F.col("lang").alias("ref_lang"),
            F.transform(
                F.sequence(F.lit(0), F.lit(SLOTS - 1)),
                lambda s: F.transform(F.filter("common", lambda c: c["slot"] == s), lambda c: c["hash"]),
            ).alias("ref_slots"),
            F.col("common.n").alias("ref_counts"),
            F.transform(
                F.sequence(F.lit(0), F.lit(SLOTS)), lambda s: F.size(F.filter("common", lambda c: c["slot"] < s))
            ).alias("ref_starts"),
            (F.col("total") - F.aggregate("common.n", F.lit(0.0), lambda a, n: a + n)).alias("ref_rest"),
        )
    )
    sums = [F.sum(F.col("classes")[i]) for i in range(len(CLASSES))]
    classes = (
        with_characters(rows, "text")
        .groupBy("lang")
        .agg(F.array(*sums).alias("classes"), F.sum(F.col("chars").cast("double")).alias("chars"))
        .select("lang", with_rest(F.col("classes"), F.col("chars")).alias("ref_classes"))
    )
    none = F.array().cast("array<array<bigint>>"), F.array().cast("array<double>"), F.array_repeat(F.lit(0), SLOTS + 1)
    own = common.select(F.col("ref_lang").alias("lang"), "ref_slots", "ref_counts", "ref_starts", "ref_rest")
    known = totals.select("lang", F.col("total").alias("ref_total"))
    return staged(
        classes.join(known, "lang")
        .join(own, "lang", "left")
        .select(
            F.col("lang").alias("ref_lang"),
            "ref_classes",
            *[F.coalesce(c, x).alias(c) for c, x in zip(("ref_slots", "ref_counts", "ref_starts"), none, strict=True)],
            "ref_total",
            F.coalesce("ref_rest", "ref_total").alias("ref_rest"),
        ),
        "references",
    )


def quality_verdicts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    most_class_distance: float = MOST_CLASS_DISTANCE,
    most_word_distance: float = MOST_WORD_DISTANCE,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base counts, base_failed, both distances, kept.

    kept is false if base_failed, if the character classes are further than ``most_class_distance``
    from the language's, or the common words further than ``most_word_distance``. A distance is null,
    and does not count against a text, below LEAST_CHARACTERS characters or LEAST_JUDGED_WORDS words. Null languages are one language of their own.
    A null text is empty: no words, base_failed. Repeated rows give repeated results; an empty table
    gives none. Other columns are not read.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
    )
    references = language_references(rows.select("lang", "text"))
    # No hint: the references are a written table, by whose size the join is chosen, and split where a language is hot.
    joined = rows.join(references, F.col("lang") == F.col("ref_lang"), "left")
    judged = (
        common_word_counts(base_counts(joined, "text"), "hashes")
        .withColumn("classes", with_rest(F.col("classes"), F.col("chars").cast("double")))
        .withColumns(
            {
                "class_distance": F.when(
                    F.col("chars") >= LEAST_CHARACTERS, js_distance(F.col("classes"), F.col("ref_classes"))
                ),
                "word_distance": F.when(F.col("n_words") >= LEAST_JUDGED_WORDS, word_distance(F.col("n_words"))),
            }
        )
    )
    off = (F.coalesce("class_distance", F.lit(0.0)) > most_class_distance) | (
        F.coalesce("word_distance", F.lit(0.0)) > most_word_distance
    )
    return judged.select(
        F.col("doc").alias(doc_id),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~off).alias("kept"),
        "class_distance",
        "word_distance",
    )
