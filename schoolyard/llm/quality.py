"""Quality rules, line first, in DataFrame functions only.

Every line is held against rules of its own: it needs words, a sentence's punctuation or a
sentence's length, and it must be neither navigation nor boilerplate nor a wall of symbols,
capitals or one repeated word. Lines that fail are removed; a document is rejected when the
lines that remain hold too small a share of its words. Counts over the whole text (words,
symbols, repeated lines and repeated five-word windows) are rules before that.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schoolyard.llm.common import SPACES

#: Fixed values of the whole-text rules.
SYMBOL = "[#*$%&|<>]"
WINDOW = 5


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules; shares are of a line's words or characters."""

    #: A line with fewer words must end like a sentence.
    sentence_words: int = 4
    #: Separators (| > » · •) between words: from so many per hundred words on, a line is a menu.
    separators_per_100_words: int = 20
    #: Symbols per hundred words from which a line is not prose.
    symbols_per_100_words: int = 60
    #: Shouted words: lines of capitals and exclamation marks.
    shouts_per_100_words: int = 50
    #: Phrases of boilerplate count in lines of fewer words.
    boilerplate_words: int = 25
    #: Percent of a document's words that the removed lines may hold.
    lost_percent: int = 40


#: Phrases of lines that sites repeat around their text.
BOILERPLATE = (
    "all rights reserved",
    "click here",
    "cookie policy",
    "cookies to",
    "enable javascript",
    "javascript is disabled",
    "log in to",
    "lorem ipsum",
    "privacy policy",
    "read more",
    "share this",
    "sign up for",
    "skip to content",
    "subscribe to",
    "terms of service",
    "terms of use",
)


def _words(text: Column) -> Column:
    spaced = F.translate(text, SPACES, " " * len(SPACES))
    return F.array_remove(F.split(spaced, " "), "")


def measured_lines(text: Column) -> Column:
    """The \\n-split lines of a text with their numbers of words."""
    count = lambda line: F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.transform(F.split(text, "\n"), lambda line: F.struct(line.alias("line"), count(line).alias("n")))


def line_fails(measured: Column, rules: LineRules) -> Column:
    """Whether a measured line breaks a punctuation, navigation or boilerplate rule."""
    line, n = measured["line"], measured["n"]
    ends = line.rlike(r"[.!?…:;。！？][\"'”’»)\]]*[\x20\x09-\x0D]*$")
    too_short = (n < rules.sentence_words) & ~ends
    menu = F.regexp_count(line, F.lit(r"[|>»·•]")) * 100 >= n * rules.separators_per_100_words
    symbols = F.regexp_count(line, F.lit(SYMBOL)) * 100 >= n * rules.symbols_per_100_words
    shouted = F.regexp_count(line, F.lit(r"!!")) * 100 >= n * rules.shouts_per_100_words
    boilerplate = (n < rules.boilerplate_words) & line.rlike("(?i)" + "|".join(BOILERPLATE))
    return (n > 0) & (too_short | menu | symbols | shouted | boilerplate)


def _window_hashes(words: Column) -> Column:
    """A 64-bit hash for each window of five words, in order."""
    starts = F.slice(words, 1, F.greatest(F.lit(0), F.size(words) - (WINDOW - 1)))
    return F.transform(
        starts, lambda word, i: F.xxhash64(word, *[F.get(words, i + k) for k in range(1, WINDOW)])
    )


def _repeated_starts(hashes: Column) -> Column:
    """Positions of windows that occur twice or more, in order; null if there is none.

    Distinct hashes tell whether there is any, which most texts have not. Only then windows are
    sorted by (hash, position), which brings equal ones together.
    """
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(hashes) > F.size(F.array_distinct(hashes)), placed)


def judged(
    docs: DataFrame,
    rules: LineRules = LineRules(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, lost_words (words of failed lines) and clean_text (the
    lines that did not fail).

    base_failed: fewer than 10 words, or over a fifth of the words in repeated windows. kept:
    not base_failed, and the failed lines hold at most `lost_percent` of the words. A null text
    counts as empty: all counts 0, not kept, clean_text empty. Every row is judged by itself, so
    repeated rows and null ids have a row each; nothing is shuffled. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        text.alias("text"),
        _words(text).alias("words"),
        measured_lines(text).alias("lines"),
    )
    counted = split.select(
        "doc_id",
        "lines",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.transform(F.filter("lines", lambda x: x["n"] > 0), lambda x: x["line"]).alias("worded"),
        F.filter("lines", lambda x: line_fails(x, rules)).alias("failed"),
        _window_hashes(F.col("words")).alias("hashes"),
    )
    placed = counted.withColumn("placed", _repeated_starts(F.col("hashes"))).drop("hashes")

    def beside(x: Column, k: Column) -> Column:
        return F.get(F.col("placed"), k)["h"].eqNullSafe(x["h"])

    twice = F.filter("placed", lambda x, k: beside(x, k - 1) | beside(x, k + 1))
    starts = placed.withColumn("starts", F.sort_array(F.transform(twice, lambda x: x["i"])))
    # a window covers its five words, or those up to the next repeated window
    step = F.transform(
        "starts", lambda at, k: F.least(F.lit(WINDOW), F.get(F.col("starts"), k + 1) - at)
    )
    covered = F.aggregate(step, F.lit(0), lambda total, x: total + x)
    lost = F.aggregate("failed", F.lit(0), lambda total, x: total + x["n"])
    facts = starts.select(
        "doc_id",
        "lines",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("worded") - F.size(F.array_distinct("worded"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        lost.cast("long").alias("lost_words"),
    )
    base_failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    loses = F.col("lost_words") * 100 > F.col("n_words") * rules.lost_percent
    remaining = F.filter("lines", lambda x: ~line_fails(x, rules))
    return facts.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & ~loses).alias("kept"),
        "lost_words",
        F.array_join(F.transform(remaining, lambda x: x["line"]), "\n").alias("clean_text"),
    )
