"""Text expressions over string columns.

Whitespace and word boundaries are meant in the Unicode sense, which Java patterns
only have on request: `(?U:...)` asks for it where it is needed, since it is slow. A
lookahead for the possible first letters in front of it skips most positions.
"""

from pyspark.sql import Column, functions as F

from .binding import let

# ---- fixed values -------------------------------------------------------------
# Words that carry no topic, in the four places that use their own list.
RANKING_STOP_WORDS = (
    "a an and are as at be by for from has have in is it of on or that the to was were with "
    "this these those we you their there into than then such also been being can will"
).split()
FREQUENCY_STOP_WORDS = (
    "a an and are as at be by for from has he in is it its of on that the to was were will with "
    "this these those or if but about into than then them they their you your we our can could "
    "should would may might not"
).split()
QUESTION_STOP_WORDS = (
    "a an and are as at be by for from has have in is it of on or that the to was were with"
).split()
GENERIC_QUERY_WORDS = (
    "the a an of for about project document pdf file explain tell me what is are how used"
).split()
# Query words that stand for a set of related words.
QUERY_EXPANSIONS = {
    "workflow": "workflow process pipeline steps architecture flow".split(),
    "tech": "tech technology tools framework stack backend frontend database rfid api".split(),
    "stack": "stack technology tools framework backend frontend database rfid api".split(),
    "evaluation": "evaluation criteria assessment judging marks weightage".split(),
    "criteria": "criteria evaluation assessment judging marks weightage".split(),
}
# Front matter that never answers a question; each starts at a word boundary.
NOISE_PATTERNS = [
    r"roll\s*no\b",
    r"team\s+members?\b",
    r"course\b",
    r"btech\b",
    r"submitted\s+by\b",
    r"department\b",
    r"student\b",
    r"guide\b",
    r"mentor\b",
    r"name\s*:",
]
FOLLOW_UP_WORDS = "this that it them these those continue previous".split()
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
WORD = r"[A-Za-z0-9-]+"
STATISTIC = r"(?=\p{Nd})(?U:\b)\p{Nd}+(?:\.\p{Nd}+)?%?(?U:\b)"
DEFINITION = r"(?i)(?=[irdm])(?U:\b)(?:is|refers to|defined as|means)(?U:\b)"
CAPITALISED_PHRASE = (
    r"(?=[A-Z])(?U:\b)[A-Z][A-Za-z0-9+-]{2,}(?:(?U:\s)+[A-Z][A-Za-z0-9+-]{2,})*(?U:\b)"
)
PAGE_HEADING = r"(?i)(?:^|\n)\[Page\s+(\d+)\]\s*\n"
PAGE_REFERENCE = r"(?iU)\bpage\s+(\d+)\b"
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
# ---- end of fixed values --------------------------------------------------------

# One whitespace character. Printable ASCII is ruled out first, so that ordinary
# letters cost one comparison.
SPACE = r"[[^!-~]&&[\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
_SPACES = "".join(map(chr, [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
    0x202F, 0x205F, 0x3000,
]))


def strip(value: Column) -> Column:
    """Remove whitespace of any kind from both ends."""
    return F.btrim(value, F.lit(_SPACES))


def strip_only(value: Column, characters: str) -> Column:
    """Remove just the given characters from both ends."""
    return F.btrim(value, F.lit(characters))


def is_blank(value: Column) -> Column:
    return ~value.rlike(rf"(?s)[!-~]|(?!{SPACE}).")


def words(value: Column) -> Column:
    """Whitespace-separated words, never an empty one."""
    return F.filter(F.split(value, f"{SPACE}+"), lambda w: w != "")


def word_count(value: Column) -> Column:
    return F.size(words(value))


def clean_token(value: Column) -> Column:
    """Lower-case letters and digits only."""
    return F.lower(F.regexp_replace(value, "[^a-zA-Z0-9]+", ""))


def clean_words(value: Column) -> Column:
    """Cleaned whitespace-separated words without empty ones, duplicates kept."""
    bare = F.regexp_replace(value, f"[^a-zA-Z0-9](?<!{SPACE})", "")
    return F.filter(F.split(F.lower(bare), f"{SPACE}+"), lambda w: w != "")


def strip_page_markers(value: Column) -> Column:
    """Replace `[Page n]` markers by a newline and squeeze longer newline runs to two."""
    text = F.coalesce(value, F.lit(""))
    marker = rf"(?i){SPACE}*\[Page{SPACE}+\d+\]{SPACE}*"
    unmarked = F.when(F.contains(text, F.lit("[")), F.regexp_replace(text, marker, "\n")).otherwise(text)
    return strip(F.regexp_replace(unmarked, r"\n{3,}", "\n\n"))


def without_page_headings(value: Column) -> Column:
    marked = F.contains(value, F.lit("["))
    return strip(F.when(marked, F.regexp_replace(value, PAGE_HEADING, "\n")).otherwise(value))


def _split_after_stop(value: Column) -> Column:
    return F.split(value, f"(?<=[.!?]){SPACE}+")


def sentences(value: Column, min_words: int = 5) -> Column:
    """Sentences of a text with at least `min_words` words, as an array in text order."""
    parts = _split_after_stop(without_page_headings(value))
    return F.transform(F.filter(parts, lambda s: word_count(s) >= min_words), lambda s: strip(s))


def question_sentences(value: Column) -> Column:
    """Sentences long enough to ask about (eight words)."""
    parts = _split_after_stop(strip_page_markers(value))
    return F.transform(F.filter(parts, lambda s: word_count(s) >= 8), lambda s: strip(s))


def lines(value: Column) -> Column:
    return F.split(value, LINE_END)


def is_noise(value: Column) -> Column:
    """Blank text, front-matter phrases, or bracketed text with digits."""
    endings = [p.replace(r"\b", r"(?U:\b)") for p in NOISE_PATTERNS]
    first_letters = "".join(sorted({p[0] for p in NOISE_PATTERNS}))
    anything = rf"(?i)(?=[{first_letters}])(?U:\b)(?:" + "|".join(endings) + ")"
    bracketed = (F.regexp_count(value, F.lit(r"\(")) >= 2) & value.rlike(r"\p{Nd}")
    return is_blank(value) | value.rlike(anything) | bracketed


def units(value: Column) -> Column:
    """Answerable pieces: sentences of each line with four words or more and no noise.

    Cutting at line ends and after sentence stops in one go gives the same
    pieces as cutting lines first: what differs is blank and drops out.
    """
    cut = F.split(strip_page_markers(value), rf"{LINE_END}|(?<=[.!?]){SPACE}+")
    parts = F.transform(cut, lambda p: strip_only(p, " \t-"))
    return F.filter(parts, lambda p: (word_count(p) >= 4) & ~is_noise(p))


def tokens(value: Column) -> Column:
    """Lower-case word tokens without the ranking stop words, duplicates kept."""
    found = F.transform(F.regexp_extract_all(value, F.lit(WORD), F.lit(0)), F.lower)
    return F.filter(found, lambda t: ~t.isin(RANKING_STOP_WORDS))


def title_case(value: Column) -> Column:
    """Lower-case all, then upper-case every ASCII letter that follows a non-letter."""
    apart = F.regexp_replace(F.lower(value), "([^a-z])", "$1\x01 ")
    return F.regexp_replace(F.initcap(apart), "\x01 ", "")


def detect_language(value: Column, sample_chars: int | None = None) -> Column:
    """`en` for nearly pure ASCII, `hi` for Devanagari, else `unknown`.

    Judges the whole text, or its first `sample_chars` characters if a bound is given.
    """
    sample = value if sample_chars is None else F.substring(value, 1, sample_chars)
    plain = F.length(F.regexp_replace(sample, r"[^\x00-\x7F]", ""))
    share = plain / F.greatest(F.length(sample), F.lit(1))
    return (
        F.when(share > 0.97, "en")
        .when(sample.rlike(r"[\u0900-\u097F]"), "hi")
        .otherwise("unknown")
    )


def topic_from_filename(name: Column) -> Column:
    """File stem with `_` and `-` read as spaces; a default when nothing is left."""
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    label = strip(F.regexp_replace(stem, "[_-]", " "))
    return F.coalesce(F.nullif(label, F.lit("")), F.lit("general_document"))


def file_suffix(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"(?<=.)(\.[^.]+)$", 1))


def length_metrics(value: Column) -> dict:
    """Characters, words, sentences (by full stop), non-blank lines, words per sentence."""
    n_words = word_count(value)
    by_stop = F.split(F.regexp_replace(value, r"\n", " "), r"\.")
    n_sentences = F.size(F.filter(by_stop, lambda s: ~is_blank(s)))
    return {
        "characters": F.length(value),
        "words": n_words,
        "sentences": n_sentences,
        "paragraphs": F.size(F.filter(lines(value), lambda s: ~is_blank(s))),
        "avg_words_per_sentence": F.round(
            (n_words / F.greatest(n_sentences, F.lit(1))).cast("decimal(28,10)"), 2
        ).cast("double"),
    }


def is_relevant_page(value: Column) -> Column:
    """Enough words, enough sentences (or words), and mostly letters and digits."""
    n_words = word_count(value)
    alnum = F.length(F.regexp_replace(value, r"[^\p{L}\p{N}]", ""))
    return (
        (n_words >= 35)
        & ((F.size(sentences(value)) >= 2) | (n_words >= 60))
        & (alnum / F.greatest(F.length(value), F.lit(1)) >= 0.55)
    )


def pages(value: Column) -> Column:
    """Array of (page_number, text) by `[Page n]` headings; unmarked text is page 1."""
    numbers = F.regexp_extract_all(value, F.lit(PAGE_HEADING), F.lit(1))
    marked = let(F.split(value, PAGE_HEADING), lambda bodies: F.transform(
        numbers,
        lambda n, i: F.struct(n.cast("int").alias("page_number"), strip(bodies[i + 1]).alias("text")),
    ))
    single = F.array(F.struct(F.lit(1).alias("page_number"), strip(value).alias("text")))
    return F.filter(F.when(F.size(numbers) > 0, marked).otherwise(single), lambda p: p["text"] != "")


def answer_pages(value: Column) -> Column:
    """`pages` with stray markers removed from the text of each page."""
    cleaned = F.transform(
        pages(value),
        lambda p: F.struct(p["page_number"].alias("page_number"), strip_page_markers(p["text"]).alias("text")),
    )
    return F.filter(cleaned, lambda p: p["text"] != "")


def chunks(value: Column, length: int = 1800, overlap: int = 250) -> Column:
    """Pack paragraphs into chunks of at most `length` characters, in text order.

    A paragraph above the limit is cut into windows that share `overlap`
    characters; what was packed before it is closed first.
    """
    step = max(length - overlap, 1)
    text = F.regexp_replace(value, "\r\n", "\n")
    paragraphs = F.filter(
        F.transform(F.split(text, rf"\n{SPACE}*\n+"), lambda p: strip(p)), lambda p: p != ""
    )

    def windows(p):
        last = F.ceil(F.greatest(F.length(p) - length, F.lit(0)) / step).cast("int")
        cut = F.transform(
            F.sequence(F.lit(0), last), lambda i: strip(F.substring(p, i * step + 1, F.lit(length)))
        )
        return F.filter(cut, lambda c: c != "")

    def close(state):
        return F.when(state["open"] == "", state["done"]).otherwise(
            F.concat(state["done"], F.array(state["open"]))
        )

    def add(state, p):
        joined = F.when(state["open"] == "", p).otherwise(F.concat(state["open"], F.lit("\n\n"), p))
        as_done = F.when(F.length(joined) <= length, state["done"]).when(
            F.length(p) <= length, close(state)
        ).otherwise(F.concat(close(state), windows(p)))
        as_open = F.when(F.length(joined) <= length, joined).when(
            F.length(p) <= length, p
        ).otherwise(F.lit(""))
        return F.struct(as_done.alias("done"), as_open.alias("open"))

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))
    return F.aggregate(paragraphs, start, add, close)


def important_words(sentence: Column) -> Column:
    """Words of five letters or more that may serve as an answer, case kept."""
    bare = F.transform(words(sentence), lambda w: F.regexp_replace(w, "[^A-Za-z0-9-]", ""))
    return F.filter(bare, lambda w: (F.length(w) > 4) & ~F.lower(w).isin(QUESTION_STOP_WORDS))


def clauses(sentence: Column) -> Column:
    """Clauses of three words or more between commas, semicolons, colons and `and`."""
    parts = F.filter(F.split(sentence, r"(?U),|;|:|\band\b"), lambda p: strip(p) != "")
    bare = F.transform(parts, lambda p: strip_only(p, " ,;:-"))
    return F.filter(bare, lambda c: word_count(c) >= 3)


def concise_fact(sentence: Column) -> Column:
    """First clause (or the whole sentence), ended by one full stop."""
    first = F.get(clauses(sentence), F.lit(0))
    body = F.coalesce(first, strip(sentence))
    return F.concat(F.regexp_replace(body, r"\.+$", ""), F.lit("."))


def single_spaced(value: Column) -> Column:
    """Page markers out, whitespace runs to one space."""
    return strip(F.regexp_replace(strip_page_markers(value), f"{SPACE}+", " "))


def needs_history(question: Column) -> Column:
    """Whether a question refers back; the words are looked for anywhere in the text."""
    return F.lower(question).rlike("|".join(FOLLOW_UP_WORDS))


def page_requested(question: Column) -> Column:
    """The n of the first `page n` in a question, else NULL."""
    return F.nullif(F.regexp_extract(question, PAGE_REFERENCE, 1), F.lit("")).cast("int")
