"""Line-first cleaning in DataFrame functions only.

Each line of a text is judged by itself: how it ends, whether it is navigation, whether
it is boilerplate. Lines that fail go; a document that loses too much of its text goes
as a whole. Counts about the whole text (words, symbols, repeated lines and windows of
words) come first and reject documents by themselves.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.binding import let
from .shared import GAP

# What a line may end with, what separates navigation, and phrases of boilerplate.
ENDINGS = r"[.!?:;,\x{2026}\x{3002}\x{FF01}\x{FF1F}][\"')\]\x{201D}\x{2019}\x{00BB}]*[\x20\x09-\x0D]*\z"
SYMBOLS = r"[#*$%&|<>]"
SEPARATOR = r"(^|[\x20\x09-\x0D])([|>/\x{00BB}\x{203A}\x{2022}\x{00B7}]|>>)([\x20\x09-\x0D]|\z)"
BOILERPLATE = (
    r"(?i)(all rights reserved|cookie policy|privacy policy|terms of (use|service)|accept (all )?cookies|"
    r"enable javascript|subscribe to our newsletter|sign in to continue|skip to (main )?content|lorem ipsum)"
)
WORD = r"[^\x20\x09-\x0D]"


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def repeated_words(words: Column, window: int = 5) -> Column:
    """How many words stand in windows that occur twice or more, the first time included.

    Windows are compared by a 64-bit hash of their words: two different windows of one
    text are taken for equal with a chance below 1e-9 even among 100,000 words.
    """
    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(o: Column) -> Column:
            twice = F.transform(o, lambda e, i: F.when(
                (e["h"] == F.get(o, i - 1)["h"]) | (e["h"] == F.get(o, i + 1)["h"]), e["i"]))
            return F.sort_array(F.array_compact(twice))

        def length(p: Column) -> Column:
            steps = F.transform(p, lambda v, i: F.least(F.lit(window), F.coalesce(F.get(p, i + 1) - v, F.lit(window))))
            return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

        return let(let(ordered, starts), length)

    def count(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - window),
                             lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))
        return F.when(F.size(w) < window, 0).otherwise(
            let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))))

    return let(words, count)


def line_passes(line: Column, short: int = 6, symbol_share: float = 0.1, separator_share: float = 0.2) -> Column:
    """Whether a line survives: each rule looks at the line alone.

    Punctuation: a line of fewer than `short` words must end like a sentence, and symbols must
    not exceed `symbol_share` of its characters. Navigation: separators standing alone must not
    exceed `separator_share` of its words. Boilerplate: none of the phrases. Lines without a
    word pass: they carry no text.
    """
    words = F.regexp_count(line, F.lit(WORD + "+"))
    ended = (words >= short) | line.rlike(ENDINGS)
    plain = F.regexp_count(line, F.lit(SYMBOLS)) <= symbol_share * F.length(line)
    text = F.regexp_count(line, F.lit(SEPARATOR)) <= separator_share * words
    return (words == 0) | (ended & plain & text & ~line.rlike(BOILERPLATE))


def cleaned(documents: DataFrame, text: str = "text", max_loss: float = 0.5) -> DataFrame:
    """Adds the counts, `base_failed`, `clean_text`, `lost_share` and `kept`; other columns pass.

    `lost_share` is the share of word characters in removed lines (0 for texts without a word),
    and a document with more than `max_loss` is not kept. NULL texts count as empty: no words,
    base failed, not kept. Repeated rows are each judged; an empty table stays empty. An input
    column with the name of an added one is replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.split(whole, "\n")
    worded = F.filter(lines, lambda line: line.rlike(WORD))
    stage = documents.withColumn("__words", word_list(whole)).withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length(F.regexp_replace(whole, GAP, "")).cast("long"),
        "n_symbols": F.regexp_count(whole, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": let(worded, lambda w: F.size(w) - F.size(F.array_distinct(w))).cast("long"),
        "n_repeat_words": repeated_words(F.col("__words")).cast("long"),
        "clean_text": F.array_join(F.filter(lines, lambda line: line_passes(line)), "\n"),
    }).drop("__words")
    left = F.length(F.regexp_replace("clean_text", GAP, ""))
    return stage.withColumns({
        "base_failed": (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
        "lost_share": F.when(F.col("word_chars") == 0, 0.0).otherwise(1.0 - left / F.col("word_chars")),
    }).withColumn("kept", ~F.col("base_failed") & (F.col("lost_share") <= max_loss))
