"""Queries for retrieval, answers and the question bank."""

from pyspark.sql import functions as F

from ..functions import text
from ..functions.binding import rows_of
from ..operators import answers, questions, retrieval, topics, vectors
from .registry import query, rounded
from .text_queries import _list, sentences_sql, strip_sql, tokens_sql, units_sql, words_sql

# ---- SQL building blocks ------------------------------------------------------------


def clean_sql(value):
    return (
        f"list_filter(list_transform({words_sql(value)}, lambda x: lower(regexp_replace(x, '[^a-zA-Z0-9]+', '', 'g'))), "
        f"lambda x: x <> '')"
    )


def terms_sql(value):
    return (
        f"list_distinct(list_filter(list_transform(regexp_extract_all({value}, '[A-Za-z0-9-]+'), "
        f"lambda x: lower(regexp_replace(x, '[^a-zA-Z0-9]+', '', 'g'))), lambda x: x <> ''))"
    )


_WORD_EDGE = r"[^\p{L}\p{N}_]"


def unit_score_sql(terms, asked, unit):
    title = (
        rf"(regexp_matches({unit}, '[\p{{Lu}}\p{{Lt}}]') AND NOT regexp_matches({unit}, '(?:^|[^\p{{Lu}}\p{{Ll}}\p{{Lt}}])\p{{Ll}}') "
        rf"AND NOT regexp_matches({unit}, '[\p{{Lu}}\p{{Ll}}\p{{Lt}}][\p{{Lu}}\p{{Lt}}]'))"
    )
    overlap = f"len(list_intersect({terms}, {terms_sql(unit)}))"
    return (
        f"CASE WHEN {overlap} > 0 THEN {overlap} * 2.2 + CASE WHEN contains(lower({unit}), lower({strip_sql(asked)})) THEN 2.5 ELSE 0 END "
        f"+ CASE WHEN regexp_matches({unit}, '(?i)(?:^|{_WORD_EDGE})(?:is|refers to|defined as|means)(?:{_WORD_EDGE}|$)') THEN 1.5 ELSE 0 END "
        f"+ CASE WHEN len({words_sql(unit)}) <= 10 AND {title} THEN 1.0 ELSE 0 END ELSE 0 END"
    )


def query_terms_sql(value):
    cases = " ".join(
        f"WHEN '{word}' THEN {_list([word, *related])}" for word, related in text.QUERY_EXPANSIONS.items()
    )
    return (
        f"list_distinct(list_filter(flatten(list_transform({terms_sql(value)}, lambda y: CASE y {cases} ELSE [y] END)), "
        f"lambda y: NOT list_contains({_list(text.GENERIC_QUERY_WORDS)}, y)))"
    )


_PAIRS = """pairs AS (SELECT q.conv_id, q.turn, q.text AS question, a.text AS reply FROM conversations q
  JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 WHERE q.role = 'user')"""

_LEXICAL = f"""qt AS (SELECT query_id, tok, count(*) AS mult FROM (SELECT query_id, unnest({clean_sql('query')}) AS tok FROM q) GROUP BY 1, 2),
  dt AS (SELECT doc_id, tok, count(*) AS tf FROM (SELECT doc_id, unnest({clean_sql('text')}) AS tok FROM documents) GROUP BY 1, 2),
  hit AS (SELECT query_id, doc_id, CAST(sum(tf) + 1.2 * count(*) AS DOUBLE) AS s FROM qt JOIN dt USING (tok) GROUP BY 1, 2),
  ins AS (SELECT query_id, doc_id, CAST(0.35 * sum(mult) AS DOUBLE) AS s FROM qt, documents WHERE contains(lower(text), tok) GROUP BY 1, 2),
  phr AS (SELECT query_id, doc_id, CAST(2.5 AS DOUBLE) AS s FROM q, documents WHERE contains(lower(text), lower({strip_sql('query')}))),
  al AS (SELECT query_id, doc_id AS chunk_id, {rounded('sum(s)', 6)} AS score FROM
    (SELECT * FROM hit UNION ALL SELECT * FROM ins UNION ALL SELECT * FROM phr) GROUP BY 1, 2
    HAVING query_id IN (SELECT query_id FROM qt) AND doc_id IN (SELECT doc_id FROM dt)),
  ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INTEGER) AS rank FROM al QUALIFY rank <= 10),
  need AS (SELECT query_id, greatest(2.5, least(6.0, len({clean_sql('query')}) * 1.4)) AS needed FROM q),
  strong AS (SELECT query_id, chunk_id, rank, {rounded('score', 3)} AS score, {rounded('least(0.98, 0.45 + score / 12)')} AS confidence
    FROM ranked JOIN need USING (query_id) WHERE rank <= 5 AND score >= needed)"""
_BENCH_Q = "q AS (SELECT item_id AS query_id, text AS query FROM benchmark)"


def _vector_sql(source):
    return f"""near AS (SELECT query_id, v.vec_id AS chunk_id, round(array_distance(qe::DOUBLE[64], v.embedding::DOUBLE[64]) ** 2, 9) AS d,
    row_number() OVER (PARTITION BY query_id ORDER BY round(array_distance(qe::DOUBLE[64], v.embedding::DOUBLE[64]) ** 2, 9), v.vec_id) AS r0
    FROM {source}, (SELECT * FROM embeddings WHERE vec_id IN (SELECT doc_id FROM documents)) v QUALIFY r0 <= 15),
  uniq AS (SELECT n.* FROM near n JOIN documents ON doc_id = chunk_id WHERE d <= 3.5 QUALIFY row_number() OVER (PARTITION BY query_id, text ORDER BY r0) = 1),
  vec AS (SELECT query_id, chunk_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY r0) AS INTEGER) AS rank, {rounded('d', 3)} AS score,
    {rounded('greatest(0.05, 1 - d / 3.5)')} AS confidence FROM uniq QUALIFY rank <= 5)"""


def _chunks(t):
    return t.doc_texts.withColumnRenamed("doc_id", "chunk_id")


def _index(t):
    vectors = t.table("embeddings").withColumnRenamed("vec_id", "chunk_id")
    return retrieval.build_index(_chunks(t), vectors)


def _pairs(t):
    turns = t.table("conversations")
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    replies = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"))
    return asked.join(replies, ["conv_id", "turn"])


# ---- scores and top-k ---------------------------------------------------------------


@query("k1_lexical_score", f"""WITH {_PAIRS}, l AS (SELECT *, {clean_sql('question')} AS a, {clean_sql('reply')} AS f FROM pairs)
  SELECT conv_id, turn, CASE WHEN len(a) = 0 OR len(f) = 0 THEN 0.0 ELSE {rounded(f'''len(list_filter(f, lambda x: list_contains(a, x)))
    + 1.2 * len(list_intersect(a, list_distinct(f))) + 0.35 * len(list_filter(a, lambda x: contains(lower(reply), x)))
    + CASE WHEN contains(lower(reply), lower({strip_sql('question')})) THEN 2.5 ELSE 0 END''', 6)} END AS score FROM l""")
def lexical_score(t):
    return _pairs(t).select("conv_id", "turn", retrieval.lexical_score(F.col("question"), F.col("reply")).alias("score"))


@query("e3_lexical_candidates", f"WITH {_BENCH_Q}, {_LEXICAL} SELECT * FROM ranked")
def lexical_candidates(t):
    return retrieval.lexical_candidates(t.search_queries, _chunks(t), 10)


@query("k2_lexical_top_k", f"WITH {_BENCH_Q}, {_LEXICAL} SELECT * FROM strong")
def lexical_top_k(t):
    return retrieval.lexical_top_k(t.search_queries, _chunks(t), 5)


_ALL_VECTORS = "qv AS (SELECT vec_id AS query_id, embedding AS qe FROM embeddings)"


@query("e4_nearest_vectors", f"""WITH {_ALL_VECTORS}, {_vector_sql('qv')} SELECT query_id, chunk_id, {rounded('d', 6)} AS distance, CAST(r0 AS INTEGER) AS rank FROM near""")
def nearest_vectors(t):
    from ..functions.numbers import round_half_up
    queries = t.table("embeddings").select(F.col("vec_id").alias("query_id"), "embedding")
    rows = retrieval.nearest_vectors(queries, _index(t), 15)
    return rows.withColumn("distance", round_half_up(F.col("distance"), 6))


@query("k3_vector_top_k", f"WITH {_ALL_VECTORS}, {_vector_sql('qv')} SELECT * FROM vec")
def vector_top_k(t):
    queries = t.table("embeddings").select(F.col("vec_id").alias("query_id"), "embedding")
    return retrieval.vector_top_k(queries, _index(t), 5)


@query("k3_vector_top_k_by_cells", f"WITH {_ALL_VECTORS}, {_vector_sql('qv')} SELECT * FROM vec")
def vector_top_k_by_cells(t):
    queries = t.table("embeddings").select(F.col("vec_id").alias("query_id"), "embedding")
    return retrieval.vector_top_k(queries, _index(t), 5, pivots=vectors.PIVOTS)


_MIXED_Q = """raw AS (SELECT item_id, text, unnest([0, 1, 2]) AS variant FROM benchmark),
  q AS (SELECT item_id * 3 + variant AS query_id, CASE variant WHEN 0 THEN text WHEN 1 THEN 'zzqzz' ELSE lower(text[1]) END AS query FROM raw),
  qv AS (SELECT item_id * 3 + variant AS query_id, embedding AS qe FROM raw JOIN embeddings ON vec_id = item_id WHERE variant < 2)"""


@query("k4_retrieve", f"""WITH {_MIXED_Q}, {_LEXICAL}, {_vector_sql('qv')},
  weak AS (SELECT query_id, chunk_id, rank, {rounded('score', 3)} AS score, {rounded('least(0.95, 0.35 + score / 10)')} AS confidence FROM ranked WHERE rank <= 5),
  lv AS (SELECT *, 1 AS level FROM strong UNION ALL SELECT *, 2 FROM vec UNION ALL SELECT *, 3 FROM weak)
  SELECT * FROM lv QUALIFY level = min(level) OVER (PARTITION BY query_id)""")
def retrieve(t):
    vectors = t.table("embeddings").select(F.col("vec_id").alias("item_id"), "embedding")
    variant = F.col("variant")
    queries = (
        t.table("benchmark").join(vectors, "item_id", "left")
        .select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("variant"))
        .select(
            (F.col("item_id") * 3 + variant).alias("query_id"),
            F.when(variant == 0, F.col("text")).when(variant == 1, "zzqzz").otherwise(F.lower(F.substring("text", 1, 1))).alias("query"),
            F.when(variant < 2, F.col("embedding")).alias("embedding"))
    )
    return retrieval.retrieve(queries, _index(t), 5)


# ---- query terms and units ----------------------------------------------------------


@query("k5_query_terms", f"""SELECT item_id, array_to_string(list_sort({query_terms_sql("'Explain the workflow and tech criteria of ' || text")}), ' ') AS terms FROM benchmark""")
def query_terms(t):
    asked = F.concat(F.lit("Explain the workflow and tech criteria of "), F.col("text"))
    return t.table("benchmark").select("item_id", F.array_join(F.array_sort(answers.query_terms(asked)), " ").alias("terms"))


@query("k6_unit_score", f"""WITH {_PAIRS}, p AS (SELECT *, {query_terms_sql('question')} AS terms, {units_sql('reply')} AS u FROM pairs),
  x AS (SELECT conv_id, turn, question, terms, unnest(u) AS unit, CAST(generate_subscripts(u, 1) - 1 AS INTEGER) AS pos FROM p)
  SELECT conv_id, turn, pos, {rounded(unit_score_sql('terms', 'question', 'unit'), 6)} AS score FROM x""")
def unit_score(t):
    pairs = _pairs(t).withColumn("terms", answers.query_terms(F.col("question")))
    rows = rows_of(pairs, ["conv_id", "turn", "question", "terms"], text.units(F.col("reply")), "unit", "pos")
    return rows.select(
        "conv_id", "turn", "pos", answers.unit_score(F.col("terms"), F.col("question"), F.col("unit")).alias("score"))


_ASKED = """CASE turn % 3 WHEN 0 THEN question WHEN 1 THEN question || ' page 1' ELSE question || ' page 3' END"""


@query("k7_page_units", f"""WITH {_PAIRS}, p AS (SELECT conv_id, turn, {_ASKED} AS question, text FROM pairs JOIN documents ON doc_id = conv_id),
  u AS (SELECT conv_id, turn, question, {query_terms_sql('question')} AS terms, {units_sql('text')} AS u FROM p),
  x AS (SELECT conv_id, turn, question, terms, unnest(u) AS unit, generate_subscripts(u, 1) - 1 AS pos FROM u),
  s AS (SELECT *, {rounded(unit_score_sql('terms', 'question', 'unit'), 6)} AS score, contains(question, ' page 1') AS first_page, contains(question, ' page 3') AS third FROM x),
  h AS (SELECT *, bool_or(score > 0) OVER (PARTITION BY conv_id, turn) AS any_hit FROM s WHERE NOT third),
  r AS (SELECT conv_id, turn, unit, CASE WHEN any_hit THEN score ELSE 0.5 END AS score, row_number() OVER (PARTITION BY conv_id, turn ORDER BY CASE WHEN any_hit THEN -score ELSE 0 END, pos) AS rank
    FROM h WHERE CASE WHEN any_hit THEN score > 0 ELSE first_page END)
  SELECT conv_id, turn, CAST(rank AS INTEGER) AS rank, unit, score FROM r WHERE rank <= 5""")
def page_units(t):
    turn = F.col("turn")
    asked = F.when(turn % 3 == 0, F.col("question")).when(turn % 3 == 1, F.concat("question", F.lit(" page 1"))).otherwise(
        F.concat("question", F.lit(" page 3")))
    documents = t.doc_texts.select(F.col("doc_id").alias("conv_id"), F.col("text").alias("document_text"))
    rows = answers.best_units_from_pages(_pairs(t).withColumn("question", asked).join(documents, "conv_id"))
    return rows_of(rows, ["conv_id", "turn"], F.col("units"), "u", "i").select(
        "conv_id", "turn", (F.col("i") + 1).alias("rank"), F.col("u.text").alias("unit"), "u.score")


@query("k8_units_from_chunks")
def units_from_chunks(t):
    return answers.units_from_chunks(t.search_queries, _chunks(t), with_vectors=False)


@query("k9_answer_questions")
def answer_questions(t):
    asked = _pairs(t).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("question_id"), "question", F.col("conv_id").alias("document_id"),
        F.when(F.col("turn") == 0, "step_by_step").otherwise("short").alias("answer_mode"))
    return answers.answer_questions(asked, t.documents, _chunks(t))


@query("k10_needs_history", f"""SELECT conv_id, turn, regexp_matches(lower(text), '{"|".join(text.FOLLOW_UP_WORDS)}') AS needs_history FROM conversations""")
def needs_history(t):
    return t.table("conversations").select("conv_id", "turn", text.needs_history(F.col("text")).alias("needs_history"))


@query("k10_recent_turns", """SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS INTEGER) AS from_end
  FROM conversations QUALIFY from_end <= 2""")
def recent_turns(t):
    return answers.recent_turns(t.table("conversations"), "conv_id", "turn").select("conv_id", "turn", "from_end")


@query("e5_topic_matches", f"""WITH d AS (SELECT doc_id, unnest(['the', 'and of', 'la']) AS topic, {sentences_sql('text')} AS l FROM documents)
  SELECT doc_id, topic, CASE WHEN len(list_filter(l, lambda s: contains(lower(s), topic))) > 0 THEN len(list_filter(l, lambda s: contains(lower(s), topic)))
    ELSE len(list_filter(l, lambda s: list_has_any({tokens_sql('s')}, string_split(topic, ' ')))) END AS matches FROM d""")
def topic_matches(t):
    cut = t.doc_texts.select("doc_id", text.sentences(F.col("text")).alias("l"))
    rows = cut.select("doc_id", "l", F.explode(F.array(F.lit("the"), F.lit("and of"), F.lit("la"))).alias("topic"))
    matches = F.size(topics.topic_sentences(F.col("l"), F.col("topic"), 2**31 - 1))
    return rows.select("doc_id", "topic", matches.cast("long").alias("matches"))


# ---- index and question bank --------------------------------------------------------


@query("k16_question_rows", r"""SELECT conv_id AS document_id, role AS topic, 'multiple_choice' AS question_type, 'medium' AS difficulty_level,
  'intermediate' AS skill_level, regexp_replace(text, '^\s+|\s+$', '', 'g') AS question_text, '["a","b"]' AS options_json, role AS answer_text,
  '' AS explanation, CAST(0.75 AS DOUBLE) AS quality_score, CAST(0 AS BIGINT) AS struggle_count,
  '2024-01-01T00:00:00' AS created_at, '2024-01-01T00:00:00' AS last_used_at FROM conversations""")
def question_rows(t):
    none = F.lit(None).cast("string")
    rows = t.table("conversations").select(
        F.col("conv_id").alias("document_id"), F.concat(F.lit(" "), "role").alias("topic"), none.alias("type"),
        none.alias("difficulty"), none.alias("skill_level"), F.col("text").alias("question"),
        F.array(F.lit("a"), F.lit("b")).alias("options"), F.col("role").alias("answer"), none.alias("explanation"),
        F.lit(None).cast("double").alias("quality_score"))
    return questions.question_rows(rows, F.lit("2024-01-01T00:00:00"))


@query("k17_build_index", """SELECT doc_id AS chunk_id, text, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS embedding
  FROM documents LEFT JOIN embeddings ON vec_id = doc_id""")
def build_index(t):
    return _index(t).select("chunk_id", "text", F.col("embedding").cast("array<double>").alias("embedding"))


@query("k18_question_package")
def question_package(t):
    requests = t.documents.select(
        "user_id", F.col("id").alias("document_id"), F.lit(None).cast("string").alias("difficulty_override"))
    bank = t.events.select(
        F.col("event_id").alias("id"), F.col("k").cast("long").alias("document_id"), F.lit("medium").alias("difficulty_level"),
        F.col("value").alias("quality_score"), F.col("ts").alias("created_at"), F.col("event_type").alias("question_text"),
        F.lit("a").alias("answer_text"), F.lit("multiple_choice").alias("question_type"),
        F.lit('["a", "b"]').alias("options_json"))
    served, _ = questions.question_package(requests, t.documents, t.quiz_results, bank, F.lit("2024-01-01T00:00:00"))
    return served
