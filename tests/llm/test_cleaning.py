import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyroom.llm import cleaning


def slow_counts(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    repeat = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeat))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_counts_match_brute_force(spark):
    pick = random.Random(3)
    texts = [None, "", " \n ", "a b c d e a b c d e", "a b c d", "é| b\né| b\n\n\n<x>", "a " * 3000]
    texts += [" ".join(pick.choice(["a", "b", "c", "d\n", "é#"]) for _ in range(pick.randint(0, 60))) for _ in range(150)]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").selectExpr("*", "'x' as kept", "'y' as n_words")
    for row in cleaning.cleaned(frame).collect():
        counts = slow_counts(texts[row["doc_id"]])
        assert tuple(row[c] for c in COUNTS) == counts, texts[row["doc_id"]]
        assert row["base_failed"] == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert not (row["kept"] and row["base_failed"])
    assert cleaning.cleaned(frame.limit(0)).count() == 0


@pytest.mark.parametrize(("line", "passes"), [
    ("", True), ("  ", True), ("A sentence ends here.", True), ("Too short", False), ("Short but ends!", True),
    ("a.\u2028", False), ("a.\u2029", False), ("a.\u0085", False), ("a.\r", True), ("a |\u2028 b c d e f", True),
    ("a longer line of words without an end", True), ("home | news | about | more", False),
    ("Read our Privacy Policy before you go on with this.", False), ("### *** $$$ ends.", False),
    ("he said “yes it is so.”", True), ("a > b and c > d are facts of order here now", True)])
def test_lines(one, line, passes):
    assert one(cleaning.line_passes(F.lit(line))) is passes


def test_removed_lines_and_lost_text(spark):
    good = "This line has quite enough words to stay in the text."
    bad = "menu | home | login | help"
    frame = spark.createDataFrame([(f"{good}\n{bad}\nQuite another line stands here as well.",), ("\n".join([bad] * 4 + [good]),)], "text string")
    first, second = cleaning.cleaned(frame).collect()
    assert first["clean_text"] == f"{good}\nQuite another line stands here as well." and first["kept"]
    assert second["clean_text"] == good and second["lost_share"] > 0.5 and not second["kept"]
