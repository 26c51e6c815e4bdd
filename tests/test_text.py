import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyroom.functions import text
from tallyroom.functions.numbers import round_half_up
from tallyroom.operators import ranking, summaries, topics


@pytest.mark.parametrize("value, expected", [
    ("", []),
    ("one\n\ntwo", ["one\n\ntwo"]),
    ("a" * 10 + "\n\n" + "b" * 6, ["a" * 10, "b" * 6]),
    ("x" * 25, ["x" * 12, "x" * 12, "x" * 7]),
    ("ab\n \ncd\r\n\r\n" + "0123456789" * 3, ["ab\n\ncd", "012345678901", "901234567890", "890123456789"]),
    ("0123456789abc\n\nend", ["0123456789ab", "9abc", "end"]),
    ("a" * 12, ["a" * 12]),
])
def test_chunks(one, value, expected):
    assert one(text.chunks(F.lit(value), 12, 3)) == expected


def test_chunks_cover_the_whole_text(one):
    value = "".join(chr(97 + i % 26) for i in range(5000))
    parts = one(text.chunks(F.lit(value), 1800, 250))
    rebuilt = parts[0] + "".join(p[250:] for p in parts[1:])
    assert rebuilt == value


def test_pages(one):
    marked = "front\n[Page 3]\nalpha\n\n[page 4] \n \nx\n[Page 9]\nomega "
    got = [tuple(p) for p in one(text.pages(F.lit(marked)))]
    assert got == [(3, "alpha"), (4, "x"), (9, "omega")]
    # A heading takes the line breaks after it, so a second one right behind is plain text.
    assert [tuple(p) for p in one(text.pages(F.lit("[Page 1]\n\n[Page 2]\nb")))] == [(1, "[Page 2]\nb")]
    assert [tuple(p) for p in one(text.pages(F.lit(" plain ")))] == [(1, "plain")]
    assert one(text.pages(F.lit("  "))) == []


def test_strip_page_markers(one):
    assert one(text.strip_page_markers(F.lit("a [Page 2] b\n\n\n\nc "))) == "a\nb\n\nc"
    assert one(text.strip_page_markers(F.lit(None).cast("string"))) == ""


@pytest.mark.parametrize("value, expected", [
    ("plain ascii", "en"), ("नमस्ते दुनिया", "hi"), ("éèêëéèêë", "unknown"), ("", "unknown"),
    ("a" * 3000 + "é" * 500, "unknown"),
])
def test_detect_language(one, value, expected):
    assert one(text.detect_language(F.lit(value))) == expected


def test_detect_language_by_a_sample(one):
    assert one(text.detect_language(F.lit("a" * 3000 + "é" * 500), sample_chars=3000)) == "en"


@pytest.mark.parametrize("name, topic, suffix", [
    ("deep_learning-notes.PDF", "deep learning notes", ".pdf"), ("_.txt", "general_document", ".txt"),
    ("a.b.txt", "a.b", ".txt"), ("plain", "plain", ""), (".hidden", ".hidden", ""),
])
def test_names(one, name, topic, suffix):
    assert one(text.topic_from_filename(F.lit(name))) == topic
    assert one(text.file_suffix(F.lit(name))) == suffix


@pytest.mark.parametrize("value", ["abc-def", "3dprint", "x1y2z", "plain", "quiz submitted", "don't stop"])
def test_title_case_equals_python(one, value):
    assert one(text.title_case(F.lit(value))) == value.title()


def test_noise(one):
    for value, expected in [
        ("", True), ("  ", True), ("Roll  No 12", True), ("Name : x", True), ("(a) and (b) 3", True),
        ("(a) and (b)", False), ("(a) 3", False), ("Discourse on things", False), ("students learn", False),
    ]:
        assert one(text.is_noise(F.lit(value))) is expected, value


def test_unicode_whitespace(one):
    assert one(text.strip(F.lit("  x y\t\n\x1f"))) == "x y"
    assert one(text.words(F.lit("a b  c\n"))) == ["a", "b", "c"]


def test_sentences_keep_short_ones_out(one):
    value = "[Page 1]\nOne two three four five. Too short. Is this a real sentence now? Yes"
    assert one(text.sentences(F.lit("x.\n" + value))) == [
        "One two three four five.", "Is this a real sentence now?"]


def test_units(one):
    value = "- First unit has four words. And no. The department is noise here.\n\n\tSecond line is also fine -"
    assert one(text.units(F.lit(value))) == ["First unit has four words.", "Second line is also fine"]


def test_length_metrics_of_empty_text(spark):
    got = spark.range(1).select(*[v.alias(k) for k, v in text.length_metrics(F.lit("")).items()]).first()
    assert tuple(got) == (0, 0, 0, 0, 0.0)


def test_rounding_is_stable_at_the_tie(one):
    assert one(round_half_up(F.lit(1.0149999999999999), 2)) == 1.02
    assert one(round_half_up(F.lit(0.125), 2)) == 0.13
    assert one(round_half_up(F.lit(-2.675), 2)) == -2.68
    assert one(round_half_up(F.lit(float("nan")), 2)) is None


DOC = (
    "Spark reads parquet files in parallel tasks. Parquet files store columns and Spark prunes columns. "
    "The and of with by from was. Streams update tables while Spark reads new files. "
    "Nothing here matches anything else whatsoever."
)


def _brute(sentences):
    """Scores by forming all pairs, for comparison with the grouped computation."""
    stop = set(text.RANKING_STOP_WORDS)
    bags = [[w for w in "".join(c if c.isalnum() or c == "-" else " " for c in s).lower().split() if w not in stop]
            for s in sentences]
    n = len(bags)
    out = []
    for i, bag in enumerate(bags):
        tfidf = None
        if bag:
            tfidf = sum(math.log((1 + n) / (1 + sum(w in b for b in bags))) + 1 for w in bag) / len(bag)
        rank = 0.0
        for j, other in enumerate(bags):
            if i != j and bag and other:
                shared = len(set(bag) & set(other))
                rank += shared / (math.log(len(set(bag)) + 1) + math.log(len(set(other)) + 1))
        out.append((tfidf, rank))
    return out


def test_scores_equal_the_pairwise_definition(spark, frame, one):
    docs = frame("doc_id long, text string", (1, DOC), (2, DOC + " " + DOC), (3, "short."), (4, None))
    got = ranking.scored_sentences(docs, ["doc_id"], text.sentences(F.col("text")))
    by_doc = {}
    for r in got.orderBy("doc_id", "pos").collect():
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert set(by_doc) == {1, 2}
    for doc_id, value in ((1, DOC), (2, DOC + " " + DOC)):
        sentences = one(text.sentences(F.lit(value)))
        assert [r["sentence"] for r in by_doc[doc_id]] == sentences
        for r, (tfidf, rank) in zip(by_doc[doc_id], _brute(sentences)):
            assert r["tfidf"] == (None if tfidf is None else pytest.approx(tfidf, abs=1e-8))
            assert r["textrank"] == pytest.approx(rank, abs=1e-8)


def test_top_lists(spark, frame):
    docs = frame("doc_id long, text string", (1, DOC))
    scored = ranking.scored_sentences(docs, ["doc_id"], text.sentences(F.col("text")))
    all_ranked = ranking.top_textrank(scored, ["doc_id"], 10)
    assert all_ranked.count() == 5
    assert ranking.top_tfidf(scored, ["doc_id"], 10).count() == 4
    merged = ranking.important_sentences(scored, ["doc_id"], 5).orderBy("line").collect()
    assert [r["line"] for r in merged] == [1, 2, 3, 4, 5]
    assert merged[-1]["n_tokens"] == 0


def test_topics_by_hand(frame):
    value = (
        "Machine Learning helps people learn from data. Machine Learning models need training data. "
        "A neural network is a learning machine with layers. Training of a network takes many examples."
    )
    docs = frame("doc_id long, text string", (1, value), (2, "tiny"))
    got = {r["doc_id"]: r["topics"] for r in topics.extract_topics(docs, ["doc_id"], "text", 4).collect()}
    # "Machine Learning" weighs 4; its single words are covered by the phrase.
    assert got == {1: ["Machine Learning", "Training", "Network", "People"]}


def test_topic_sentences(one):
    sentences = F.array(*[F.lit(s) for s in (
        "graph theory is about graphs.", "trees are special graphs.", "queues are lists.")])
    assert one(topics.topic_sentences(sentences, F.lit("Graph"))) == [
        "graph theory is about graphs.", "trees are special graphs."]
    assert one(topics.topic_sentences(sentences, F.lit("trees lists"))) == [
        "trees are special graphs.", "queues are lists."]
    assert one(topics.topic_sentences(sentences, F.lit("none"))) == []


def test_key_insights_order(frame):
    lines = [
        "Recursion is a function that calls itself again.", "About 45 students passed the test today.",
        "Plain words without any special thing here.", "Recursion is a function that calls itself again.",
        "A stack means last in and first out.",
    ]
    docs = frame("doc_id long, text string", (1, " ".join(lines)))
    got = summaries.key_insights(docs, "doc_id", "text").orderBy("rank").collect()
    assert [(r["type"], r["text"]) for r in got[:3]] == [
        ("definition", lines[0]), ("statistic", lines[1]), ("definition", lines[4])]
    assert [(r["type"], r["text"]) for r in got[3:]] == [("important_line", lines[2])]


def _page(n, body):
    return f"[Page {n}]\n{body}\n"


LONG = "The Binary Search method halves a sorted list at every step until the value is found. " * 4


def test_pagewise_labels_are_unique(frame):
    value = "\n" + _page(1, LONG) + _page(2, LONG) + _page(3, "too short")
    docs = frame("id long, text string", (1, value))
    got = summaries.pagewise_summary(docs, "id", "text").first()
    assert got["page_count"] == 2
    labels = [p["topic"] for p in got["page_summaries"]]
    assert labels[0] == "The Binary Search"
    assert len({label.lower() for label in labels}) == 2
    assert [p["page"] for p in got["page_summaries"]] == [1, 2]
    assert got["summary_text"].startswith("### The Binary Search\n- The Binary Search method")


def test_relevant_pages_fall_back_to_the_longest(frame):
    value = "\n" + "".join(_page(n, "word " * n) for n in range(1, 8))
    docs = frame("id long, text string", (1, value))
    got = summaries.relevant_pages(docs, "id", "text").orderBy("page_order").collect()
    assert [r["page_number"] for r in got] == [7, 6, 5, 4, 3]


def test_hierarchy_levels(frame):
    docs = frame("id long, text string", (1, DOC), (2, ""))
    got = {r["id"]: r for r in summaries.hierarchical_summary(docs, "id", "text").collect()}
    assert len(got[1]["section_level"]) == 1 and len(got[1]["section_level"][0]["summary"]) == 3
    assert len(got[1]["document_level"]) == 5
    assert got[1]["topic_level"][0]["topic"]
    assert (got[2]["section_level"], got[2]["topic_level"], got[2]["document_level"]) == ([], [], [])


def test_summaries_use_the_cache_and_compute_misses(spark, frame):
    docs = frame("id long, text_content string", (1, DOC), (2, DOC), (3, LONG))
    asked = frame(
        "user_id long, document_id long, method string, mode string, target_language string",
        (7, 1, "tfidf", "bullet_summary", "en"), (7, 2, "auto", "bullet_summary", "en"),
        (7, 3, "hybrid", "revision", "en"), (7, 3, "textrank", "brief", "en"), (7, 3, "other", "brief", "en"))
    stored = frame(
        "id long, user_id long, document_id long, summary_hash string, method string, mode string, "
        "target_language string, summary_text string, key_insights string, hierarchy_json string, created_at string",
        (1, 7, 1, "", "tfidf", "bullet_points", "en", "kept", "[]", "{}", "2024-01-01T00:00:00"))
    got = {(r["document_id"], r["method"]): r for r in summaries.summarize_documents(asked, docs, stored).collect()}
    assert len(got) == 5
    assert got[(1, "tfidf")]["cached"] and got[(1, "tfidf")]["summary_text"] == "kept"
    fresh = got[(2, "hybrid")]
    assert not fresh["cached"] and fresh["summary_text"].count("\n- ") == 4
    assert got[(3, "hybrid")]["summary_text"].startswith("### The Binary Search")
    assert got[(3, "textrank")]["summary_text"] == ""
    assert got[(3, "other")]["summary_text"].startswith("### The Binary Search")


def test_word_frequencies_need_three_letters(frame):
    docs = frame("id long, text string", (1, "The cat, the CAT! ox is dog's dog"))
    assert rows(ranking.word_frequencies(docs, "text")) == [("cat", 2), ("dog", 1), ("dogs", 1)]


def test_texts_of_equal_keys_are_scored_together(spark, frame):
    """A sentence that comes twice at one place counts its words twice, but is one sentence of the document."""
    once = [(1, "red fox runs over hills. blue fox sits near lakes."), (None, "grey owls fly over woods.")]
    short, other = "red fox runs over hills.", "red fox runs over hills. green frogs sit near ponds."
    found = {}
    for name, extra in (("once", []), ("twice", once), ("other", [(1, other)]), ("short", [(1, short)])):
        docs = frame("doc_id long, text string", *once, *extra, (2, None), (3, ""))
        scored = ranking.scored_sentences(docs, ["doc_id"], text.sentences(F.col("text")))
        found[name] = {(r["doc_id"], r["pos"]): r for r in scored.collect()}
        assert len(found[name]) == 3
    for place, r in found["once"].items():
        twice = found["twice"][place]
        assert (twice["sentence"], twice["n_tokens"], twice["textrank"]) == (r["sentence"], r["n_tokens"], r["textrank"])
        assert abs(twice["tfidf"] - 2 * r["tfidf"]) < 1e-8
    assert found["other"][1, 1]["sentence"] == "green frogs sit near ponds."
    assert found["short"][1, 1]["tfidf"] == found["once"][1, 1]["tfidf"]


def test_long_documents_are_scored_in_time_of_their_length(spark, frame):
    import time

    def seconds(n):
        words = " ".join(f"w{i % 997}x" + (". " if i % 9 == 8 else "") for i in range(n))
        docs = frame("doc_id long, text string", (1, words))
        started = time.perf_counter()
        ranking.scored_sentences(docs, ["doc_id"], text.sentences(F.col("text"))).agg(F.sum("tfidf")).collect()
        return time.perf_counter() - started

    seconds(500)
    assert seconds(40000) < 30


def test_only_sentences_that_a_list_can_hold_leave_the_row(frame):
    """Lists of four are the same from them as from all sentences, with ties and with texts of equal keys."""
    random = __import__("random").Random(7)
    words = "alpha beta gamma delta the of and eta".split()

    def body(n):
        return ". ".join(" ".join(random.choices(words, k=random.randint(5, 7))) for _ in range(n)) + "."

    tie = "Alpha beta gamma delta eta. " * 9
    docs = frame("doc_id long, text string", *[(i, body(30)) for i in range(8)], (3, body(12)), (20, tie), (21, tie + "The of and the of."),
                 (22, "the of and the of. " * 7), (None, body(9)), (None, body(20)), (23, None), (24, ""))
    cut = text.sentences(F.col("text"))
    every = ranking.scored_sentences(docs, ["doc_id"], cut)
    few = ranking.scored_sentences(docs, ["doc_id"], cut, most=4)
    assert every.groupBy("doc_id").count().agg(F.max("count")).first()[0] == 30
    assert few.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 8
    for lines in (lambda s: ranking.top_tfidf(s, ["doc_id"], 4), lambda s: ranking.top_textrank(s, ["doc_id"], 4),
                  lambda s: ranking.merged_lines(s, ["doc_id"], 4, 4), lambda s: ranking.page_lines(s, ["doc_id"], 2)):
        assert sorted(map(str, lines(few).collect())) == sorted(map(str, lines(every).collect()))


def test_texts_come_back_with_the_topics_of_their_key(frame):
    """Rows with a key that repeats or is NULL, a text without a candidate, and a NULL text, as a left join gave them."""
    from tallyroom.operators import topics

    one, other = "Binary Search halves a sorted list quickly.", "Linked Lists hold their elements in nodes."
    documents = frame("k int, text string, extra int", (1, one, 10), (1, other, 11), (2, "a b", 20), (3, None, 30), (None, one, 40), (1, None, 12))
    found = topics.extract_topics(documents.select("k", "text"), ["k"], "text", 4)
    joined = documents.join(found, "k", "left").select("k", "text", "extra", "topics")
    carried = topics.extract_topics(documents, ["k"], "text", 4, carried=["extra"]).select("k", "text", "extra", "topics")
    assert sorted(map(repr, carried.collect())) == sorted(map(repr, joined.collect()))
    assert {r["extra"] for r in carried.where("topics IS NULL").collect()} == {20, 30, 40}


@pytest.mark.parametrize("name", ["k13_focus_sentences", "k14_build_questions"])
def test_texts_are_shuffled_once_and_never_sorted_to_meet_their_topics(spark, name):
    from conftest import DATA
    from tallyroom.catalog import all_queries

    plan = all_queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan and "Sort [" not in plan
