"""What the physical plans must and must not contain."""

import re

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from tallyroom.catalog import all_queries
from tallyroom.catalog.registry import Tables

QUERIES = all_queries()
PYTHON_NODES = ("MapInPandas", "ArrowEvalPython", "BatchEvalPython", "FlatMapGroups", "FlatMapCoGroups")
# These score query vectors against chunks in batches inside the tasks.
IN_PANDAS = {"e4_nearest_vectors", "k3_vector_top_k", "k3_vector_top_k_by_cells", "k4_retrieve"}
FITS_MODELS = {"h9_student_clusters", "h10_performance_predictions"}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FITS_MODELS - IN_PANDAS))
def test_stays_in_the_jvm_without_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    assert not any(node in text for node in PYTHON_NODES)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(IN_PANDAS))
def test_retrieval_has_no_cross_join_either(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    assert "FlatMapCoGroupsInPandas" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_retrieval_runs_nothing_while_it_is_built(spark, frame):
    from tallyroom.operators import retrieval

    few = frame("query_id long, query string, embedding array<float>", (1, "a b", [1.0]))
    many = frame("query_id long, query string, embedding array<float>", *[(i, "a b", [1.0]) for i in range(2000)])
    chunks = frame("chunk_id long, text string, embedding array<float>", (1, "a b", [1.0]))
    context = spark.sparkContext
    context.setJobGroup("building", "retrieval plans")
    try:
        sizes = [plan(retrieval.retrieve(q, chunks)).count("\n") for q in (few, many)]
        assert not context.statusTracker().getJobIdsForGroup("building")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert sizes[0] == sizes[1]


@pytest.mark.parametrize("name", ["g1_recent_rows", "g3_last_result", "g6_activity_feed", "d8_cached_questions", "g7_first_messages"])
def test_top_k_is_cut_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    partial = text.index("Partial") if "Partial" in text else -1
    assert "WindowGroupLimit" in text and partial > 0


@pytest.mark.parametrize("name", ["j14_tfidf_summary", "j15_textrank_summary", "j16_important_sentences", "j17_topics", "e2_shared_tokens"])
def test_text_ranking_shuffles_once(spark, name):
    assert plan(QUERIES[name](spark, DATA)).count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", [
    "j14_tfidf_summary", "j15_textrank_summary", "j16_important_sentences", "j16_page_lines", "j17_topics",
    "j22_hybrid_bullets"])
def test_tokens_never_become_rows(spark, name):
    """Only what a document yields in the end is exploded: the token table would be sorted and spilled."""
    text = plan(QUERIES[name](spark, DATA))
    assert text.count("Generate posexplode") == 1
    assert "ObjectHashAggregate(keys=[doc_id" in text and "token" not in re.findall(r"keys=\[([^]]*)", text)


def test_sentences_are_cut_before_topics_multiply_them(spark):
    for name in ("j18_topic_sentences", "e5_topic_matches"):
        text = plan(QUERIES[name](spark, DATA))
        assert text.index("Generate explode") < text.index("(?<=[.!?])"), name


def test_columns_and_filters_reach_the_scan(spark):
    text = plan(QUERIES["c11_rows_of_user"](spark, DATA))
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,42)]" in text
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double,props:string>" in text
    text = plan(QUERIES["h4_aggregate_sum"](spark, DATA))
    assert "ReadSchema: struct<o_totalprice:double,o_orderpriority:string>" in text


def test_gold_shuffles_the_events_once(spark):
    from tallyroom.operators import gold, silver

    tables = Tables(spark, DATA)
    cube = gold.activity_cube(silver.log_events(tables.log_records, "log"))
    assert plan(cube).count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan(cube)


def test_no_hint_forces_a_broadcast(spark):
    tables = Tables(spark, DATA)
    from tallyroom.operators import silver

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(silver.messages_with_session(tables.chat_messages, tables.chat_sessions))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_lineage_is_cut_in_the_shared_folder(spark):
    from tallyroom.session import checkpoint

    frame = checkpoint(spark.range(10).withColumn("x", F.col("id") + 1))
    assert frame.count() == 10 and "Scan ExistingRDD" in plan(frame)
    assert spark.sparkContext.getCheckpointDir().startswith("file:" + spark.conf.get("spark.checkpoint.dir"))


def test_figures_of_many_columns_scan_the_data_once(spark):
    """Run first, so that the plan is the one that adaptive execution ended with."""
    for name in ("h2_numeric_summary", "h5_correlation_matrix"):
        frame = QUERIES[name](spark, DATA)
        frame.collect()
        final = plan(frame).split("== Initial Plan ==")[0]
        assert final.count("FileScan parquet") == 1, name
        inner = final[final.index("FileScan parquet") - 4000:final.index("FileScan parquet")]
        assert re.search(r"\*\(\d+\) HashAggregate.*partial", inner), name


@pytest.mark.parametrize("name", ["e3_lexical_candidates", "k2_lexical_top_k", "k4_retrieve"])
def test_words_are_found_without_moving_texts(spark, name):
    """Below every shuffle of chunk rows the text is cut already: its column is in no exchange."""
    query = QUERIES[name](spark, DATA)
    found = query._jdf.queryExecution().executedPlan().toString()
    assert "split(trim(text#" in found
    for line in found.split("\n"):
        if "Exchange hashpartitioning" in line and "REPARTITION_BY_COL" in line:
            assert re.search(r"hashpartitioning\(chunk_id#\d+L?, ", line)
    if name != "k4_retrieve":
        assert "CoGroups" not in found


def test_corpus_words_are_never_broadcast(spark):
    frame = QUERIES["e3_lexical_candidates"](spark, DATA)
    assert "SortMergeJoin [term#" in plan(frame) and "SortMergeJoin [piece#" in plan(frame)


def test_open_questions_are_worked_out_once(spark):
    """Their documents were scored anew for each of nine uses, and a found chunk was cut for each question that found it."""
    text = plan(QUERIES["k9_answer_questions"](spark, DATA))
    assert "Scan ExistingRDD" in text and "conversations.parquet" not in text
    cut = text[:text.index("(?<=[.!?])")]
    assert "Generate explode(blocks" in cut


def test_word_counts_of_documents_shuffle_the_texts_once(spark):
    """Words and their counts, many times as many rows, were shuffled twice."""
    text = plan(QUERIES["j10_document_word_frequencies"](spark, DATA))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("Generate posexplode") < text.index("Exchange hashpartitioning")
