"""Queries for table logic and dataset profiling."""

from pyspark.sql import functions as F

from ..functions.numbers import round_half_up
from ..operators import profiling, tables
from .registry import CHAT, EV, QZ, query, rounded

# ---- users, listings, lookups -------------------------------------------------------


@query("c13_documents_listing", """SELECT doc_id AS id, doc_id % 100 AS user_id,
  'file_' || CAST(doc_id AS VARCHAR) || '-notes.TXT' AS filename, '.txt' AS file_type, source AS topic, lang AS language,
  n_chars AS usage_count FROM documents""")
def documents_listing(t):
    docs = t.documents.withColumn("updated_at", F.col("created_at"))
    return tables.listing(docs, "documents").drop("created_at", "updated_at")


@query("c13_events_listing", f"""WITH {EV} SELECT event_id AS id, user_id, event_type AS activity_type, CAST(k AS VARCHAR) AS resource_id
  FROM ev ORDER BY event_id DESC LIMIT 500""")
def events_listing(t):
    return tables.listing(t.table_events, "events", 500).select("id", "user_id", "activity_type", "resource_id")


@query("c14_registration_checks", r"""SELECT c_custkey AS id, regexp_replace(c_mktsegment, '^\s+|\s+$', '', 'g') AS full_name,
  lower(replace(c_name, '#', '.')) || CASE WHEN c_acctbal < 0 THEN '' ELSE '@mail.example' END AS email, length(c_mktsegment) >= 2 AS name_ok,
  c_acctbal >= 0 AS email_ok FROM customer""")
def registration_checks(t):
    users = t.table("customer").select(
        F.col("c_custkey").alias("id"), F.concat(F.lit(" "), "c_mktsegment", F.lit("\t")).alias("full_name"),
        F.concat(F.lit("  "), F.upper(F.replace("c_name", F.lit("#"), F.lit("."))), F.when(F.col("c_acctbal") < 0, "").otherwise("@mail.example")).alias("email"))
    return tables.registration_checks(users)


@query("c15_lookup", "SELECT doc_id AS id, source AS topic, text AS text_content FROM documents WHERE doc_id = 17")
def lookup(t):
    return tables.lookup(t.documents, 17).select("id", "topic", "text_content")


# ---- registry, summaries, questions -------------------------------------------------


@query("d3_document_registry", """SELECT sha256(text) AS file_hash, arg_min(doc_id, (doc_id % 60) * 1000000000 + doc_id) AS id,
  arg_min(doc_id % 100, (doc_id % 60) * 1000000000 + doc_id) AS user_id,
  arg_max(source, (doc_id % 60) * 1000000000 + doc_id) AS topic, arg_max(lang, (doc_id % 60) * 1000000000 + doc_id) AS language,
  count(*) AS usage_count FROM documents GROUP BY 1""")
def document_registry(t):
    return tables.document_registry(t.documents).select("file_hash", "id", "user_id", "topic", "language", "usage_count")


_SUMMARIES = """sums AS (SELECT event_id AS id, user_id, k AS document_id,
  CASE event_type WHEN 'click' THEN 'tfidf' WHEN 'view' THEN 'textrank' ELSE 'hybrid' END AS method, 'brief' AS mode, 'en' AS target_language,
  CAST(value AS VARCHAR) AS summary_text, '[' || CAST(event_id AS VARCHAR) || ']' AS key_insights, props AS hierarchy_json, ts AS created_at FROM ev)"""
_HASH = "sha256(concat_ws('|', CAST(user_id AS VARCHAR), CAST(document_id AS VARCHAR), method, mode, target_language))"


def _summaries(t):
    method = F.when(F.col("event_type") == "click", "tfidf").when(F.col("event_type") == "view", "textrank").otherwise("hybrid")
    return t.events.select(
        F.col("event_id").alias("id"), "user_id", F.col("k").alias("document_id"), method.alias("method"),
        F.lit("brief").alias("mode"), F.lit("en").alias("target_language"),
        F.col("value").cast("string").alias("summary_text"),
        F.concat(F.lit("["), F.col("event_id").cast("string"), F.lit("]")).alias("key_insights"),
        F.col("props").alias("hierarchy_json"), F.col("ts").alias("created_at"))


_LATEST_SQL = f"""WITH {EV}, {_SUMMARIES} SELECT {_HASH} AS summary_hash, arg_min(id, created_at) AS id,
  user_id, document_id, method, mode, target_language, arg_max(summary_text, created_at) AS summary_text,
  arg_max(key_insights, created_at) AS key_insights, arg_max(hierarchy_json, created_at) AS hierarchy_json,
  min(created_at) AS created_at FROM sums GROUP BY user_id, document_id, method, mode, target_language"""


@query("d5_latest_summaries", _LATEST_SQL)
def latest_summaries(t):
    return tables.latest_summaries(_summaries(t))


@query("d5_merge_summaries", _LATEST_SQL)
def merge_summaries(t):
    """The later half of the rows merged into what the earlier half stored."""
    rows = _summaries(t)
    early = F.col("created_at") < F.lit("2024-01-16").cast("timestamp_ntz")
    return tables.merge_summaries(tables.latest_summaries(rows.where(early)), rows.where(~early))


@query("d5_summary_misses", f"""WITH {EV}, {_SUMMARIES}, have AS (SELECT {_HASH} AS h FROM sums WHERE method = 'tfidf')
  SELECT id, {_HASH} AS summary_hash FROM sums WHERE {_HASH} NOT IN (SELECT h FROM have)""")
def summary_misses(t):
    rows = _summaries(t)
    return tables.summary_misses(rows, rows.where(F.col("method") == "tfidf")).select("id", "summary_hash")


@query("d6_propagate_summaries", f"""WITH {QZ}, {_SUMMARIES},
  new AS (SELECT user_id, document_id, arg_max(summary_text, created_at) AS s FROM sums WHERE method = 'tfidf' GROUP BY 1, 2)
  SELECT q.id, new.s AS summary_cache FROM quiz q LEFT JOIN new USING (user_id, document_id)""")
def propagate_summaries(t):
    updates = _summaries(t).where(F.col("method") == "tfidf").withColumn("document_id", F.col("document_id").cast("long"))
    return tables.propagate_summaries(t.quiz_results, updates).select("id", "summary_cache")


@query("d7_question_quality", f"""WITH {EV}, steps AS (SELECT k AS id, list(event_type = 'error' ORDER BY ts) AS misses,
  count(*) FILTER (WHERE event_type = 'error') AS n, max(ts) AS last FROM ev GROUP BY k)
  SELECT id, {rounded('''list_reduce(misses, lambda q, m: CASE WHEN m THEN greatest(0, q - 0.05) ELSE least(1, q + 0.02) END, 0.5::DOUBLE)''', 6)}
    AS quality_score, CAST(n AS BIGINT) AS struggle_count, last AS last_used_at FROM
  (SELECT id, list_transform(misses, lambda m: CASE WHEN m THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS misses, n, last FROM steps)""".replace(
    "CASE WHEN m THEN greatest", "CASE WHEN m = 1 THEN greatest"))
def question_quality(t):
    questions = t.events.select(F.col("k").alias("id")).distinct().withColumns({
        "quality_score": F.lit(0.5), "struggle_count": F.lit(0).cast("long"), "last_used_at": F.lit(None).cast("string")})
    attempts = t.events.select(
        F.col("k").alias("question_id"), F.col("event_id").alias("attempt_id"), F.col("ts").alias("attempted_at"),
        (F.col("event_type") == "error").alias("struggled"))
    return tables.update_question_quality(questions, attempts).withColumn(
        "last_used_at", F.col("last_used_at").cast("timestamp_ntz"))


@query("d8_cached_questions", f"""WITH {EV}, bank AS (SELECT event_id AS id, k AS document_id, event_type AS difficulty_level, value, ts,
    CASE WHEN user_id > 75 THEN 1 ELSE 2 END AS n_options FROM ev)
  SELECT id, document_id, difficulty_level, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY document_id, difficulty_level
    ORDER BY value DESC, ts DESC, id) AS rank FROM bank) WHERE rank <= 5 AND n_options = 2""")
def cached_questions(t):
    bank = t.events.select(
        F.col("event_id").alias("id"), F.col("k").alias("document_id"), F.col("event_type").alias("difficulty_level"),
        F.col("value").alias("quality_score"), F.col("ts").alias("created_at"), F.lit("q").alias("question_text"),
        F.lit("a").alias("answer_text"), F.lit("multiple_choice").alias("question_type"),
        F.when(F.col("user_id") > 75, F.lit('["a"]')).otherwise(F.lit('["a", "b"]')).alias("options_json"))
    return tables.cached_questions(bank, 5).select("id", "document_id", "difficulty_level", "rank")


@query("d9_add_missing_columns", f"""WITH {QZ} SELECT id, topic, CAST(NULL AS BIGINT) AS document_id, CAST(0 AS DOUBLE) AS score_percent,
  CAST(NULL AS VARCHAR) AS difficulty_level FROM quiz""")
def add_missing_columns(t):
    old = t.quiz_results.select("id", "user_id", "topic", "score", "total_questions", "created_at")
    return tables.add_missing_columns(old, "quiz_results").select(
        "id", "topic", "document_id", "score_percent", "difficulty_level")


@query("d10_unique_in_order", r"""WITH w AS (SELECT doc_id, string_split_regex(text, '\s+') AS l FROM documents)
  SELECT doc_id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ' ') AS uniq FROM w""")
def unique_in_order(t):
    return t.doc_texts.select("doc_id", F.array_join(tables.unique_in_order(F.split("text", r"\s+")), " ").alias("uniq"))


@query("d11_merge_uploads", """SELECT doc_id // 6 AS batch_id, count(*) AS n_files,
  string_agg('file_' || CAST(doc_id AS VARCHAR) || '-notes.TXT', ' + ' ORDER BY doc_id) AS filename, '.multi' AS file_type,
  arg_min(lang, doc_id) AS language, sha256(string_agg('===== DOCUMENT: file_' || CAST(doc_id AS VARCHAR) || '-notes.TXT =====' || chr(10) || chr(10) || text,
    chr(10) || chr(10) || chr(10) ORDER BY doc_id)) AS text_hash FROM documents GROUP BY 1""")
def merge_uploads(t):
    uploads = t.documents.withColumns({"batch_id": F.floor(F.col("id") / 6), "position": F.col("id")})
    return tables.merge_uploads(uploads).select(
        "batch_id", F.col("n_files").cast("long").alias("n_files"), "filename", "file_type", "language",
        tables.text_hash(F.col("text_content")).alias("text_hash"))


@query("d12_event_rows", f"""WITH {EV} SELECT event_id, CASE WHEN event_type = 'signup' THEN NULL ELSE user_id END AS user_id,
  CASE event_type WHEN 'view' THEN 'page' ELSE event_type END AS activity_type, event_type,
  '{{"k":"' || CAST(k AS VARCHAR) || '"}}' AS metadata_json, CASE WHEN topic IS NULL THEN '[]' ELSE '["' || topic || '"]' END AS topics_json,
  props AS event_data, CAST(0 AS BIGINT) AS duration_seconds FROM ev""")
def event_rows(t):
    activities = t.events.select(
        F.when(F.col("event_type") == "signup", "guest").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(F.col("event_type") == "view", "page").when(F.col("event_type") == "click", "").alias("activity_type"),
        F.from_json("props", "map<string,string>").alias("metadata"),
        F.when(F.col("topic").isNotNull(), F.array("topic")).alias("topics"), "event_type",
        F.col("props").alias("event_data"), F.col("event_id").cast("string").alias("created_at"))
    rows = tables.event_rows(activities)
    return rows.select(
        F.col("created_at").cast("long").alias("event_id"), "user_id", "activity_type", "event_type", "metadata_json",
        "topics_json", "event_data", "duration_seconds")


@query("d13_touched_sessions", f"""WITH {CHAT} SELECT s.id, greatest(s.updated_at, m.newest) AS updated_at FROM sessions s
  LEFT JOIN (SELECT session_id, max(created_at) AS newest FROM messages GROUP BY 1) m ON s.id = m.session_id""")
def touched_sessions(t):
    return tables.touched_sessions(t.chat_sessions, t.chat_messages).select("id", "updated_at")


@query("d14_quiz_result_rows", f"""WITH {QZ} SELECT user_id, document_id, topic, score, total_questions,
  {rounded("score / greatest(total_questions, 1) * 100")} AS score_percent, '["' || event_type || '"]' AS question_types FROM quiz""")
def quiz_result_rows(t):
    return tables.quiz_result_rows(t.quiz_results.withColumn("topic", F.concat(F.lit(" "), "topic"))).select(
        "user_id", "document_id", "topic", "score", "total_questions", "score_percent", "question_types")


@query("d14_study_session_rows", f"""WITH {EV} SELECT user_id, CAST(k AS BIGINT) AS document_id, event_type AS subject, topic,
  CAST(k AS BIGINT) AS time_spent, value / 500 AS engagement_score, CAST(1 AS DOUBLE) AS completion_percentage FROM ev""")
def study_session_rows(t):
    return tables.study_session_rows(t.study_sessions).drop("created_at")


# ---- profiling ----------------------------------------------------------------------


_EVENT_COLUMNS = ["event_id", "user_id", "ts", "event_type", "value", "props", "k", "topic", "score"]


@query("h1_profile", f"""WITH {EV}, p AS (SELECT {', '.join(_EVENT_COLUMNS)} FROM ev)
  SELECT (SELECT count(*) FROM p) AS rows, {len(_EVENT_COLUMNS)} AS columns,
    (SELECT {' + '.join(f'count(*) FILTER (WHERE {c} IS NULL)' for c in _EVENT_COLUMNS)} FROM p) AS missing_cells,
    (SELECT count(*) FROM p) - (SELECT count(*) FROM (SELECT DISTINCT * FROM p)) AS duplicate_rows,
    'event_id,user_id,value,k,score' AS numeric_columns, 'ts,event_type,props,topic' AS other_columns,
    'event_id:bigint,user_id:bigint,ts:timestamp_ntz,event_type:string,value:double,props:string,k:int,topic:string,score:double' AS column_types""")
def profile(t):
    return profiling.profile(t.events)


_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _summary_sql(column, table):
    v = f"CAST({column} AS DOUBLE)"
    parts = [
        f"'{column}' AS \"column\"", f"count({column}) AS count", f"{rounded(f'avg({v})', 4)} AS mean",
        f"{rounded(f'stddev_samp({v})', 4)} AS std", f"min({v}) AS min",
        *[f"{rounded(f'quantile_cont({v}, {q})', 4)} AS {n}" for q, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))],
        f"max({v}) AS max", f"{rounded(f'quantile_cont({v}, 0.5)', 4)} AS median",
        f"count(*) FILTER (WHERE {column} IS NULL) AS missing",
    ]
    return f"SELECT {', '.join(parts)} FROM {table}"


def _rounded_summary(frame):
    names = ("mean", "std", "q25", "q50", "q75", "median")
    return frame.withColumns({n: round_half_up(F.col(n), 4) for n in names})


@query("h2_numeric_summary", " UNION ALL ".join(_summary_sql(c, "lineitem") for c in _COLUMNS))
def numeric_summary(t):
    return _rounded_summary(profiling.numeric_summary(t.table("lineitem")))


@query("h2_numeric_summary_missing", f"WITH {EV} " + " UNION ALL ".join(
    _summary_sql(c, "ev") for c in ("event_id", "user_id", "value", "k", "score")))
def numeric_summary_missing(t):
    return _rounded_summary(profiling.numeric_summary(t.events))


@query("h3_top_categories", f"""WITH {EV} SELECT coalesce(topic, 'Missing') AS topic, count(*) AS count FROM ev GROUP BY 1
  ORDER BY count DESC, 1 LIMIT 10""")
def top_categories(t):
    return profiling.top_categories(t.events, "topic")


def _aggregate_sql(how):
    value = "avg(o_totalprice)" if how == "mean" else f"{how}(o_totalprice)"
    return f"SELECT o_orderpriority, {rounded(value, 2)} AS o_totalprice FROM orders GROUP BY 1"


for _how in ("sum", "mean", "max", "min", "count"):
    @query(f"h4_aggregate_{_how}", _aggregate_sql(_how))
    def aggregate_metrics(t, how=_how):
        rows = profiling.aggregate_metrics(t.table("orders"), "o_orderpriority", "o_totalprice", how)
        return rows.withColumn("o_totalprice", round_half_up(F.col("o_totalprice"), 2))


_PAIRS = [(a, b) for a in _COLUMNS for b in _COLUMNS]


@query("h5_correlation_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, {rounded(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))', 6)} AS correlation FROM lineitem"
    for a, b in _PAIRS))
def correlation_matrix(t):
    rows = profiling.correlation_matrix(t.table("lineitem"))
    return rows.withColumn("correlation", round_half_up(F.col("correlation"), 6))


@query("h6_detect_anomalies", f"""WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS d FROM events)
  SELECT event_id, value, {rounded("(value - m) / d")} AS anomaly_score FROM events, s WHERE abs((value - m) / d) >= 3""")
def detect_anomalies(t):
    return profiling.detect_anomalies(t.table("events").select("event_id", "value"), "value")


@query("h7_infer_time_column", """SELECT 'ts' AS time_column, count(*) AS rows, min(ts) AS first, max(ts) AS last FROM events""")
def infer_time_column(t):
    name, parsed = profiling.infer_time_series(t.table("events"))
    times = F.col(name).cast("timestamp_ntz")
    return parsed.agg(F.lit(name).alias("time_column"), F.count("*").alias("rows"), F.min(times).alias("first"), F.max(times).alias("last"))


@query("h8_build_time_series", f"""SELECT strftime(o_orderdate, '%Y-%m') AS o_orderdate, {rounded("sum(o_totalprice)")} AS o_totalprice
  FROM orders GROUP BY 1""")
def build_time_series(t):
    rows = profiling.build_time_series(t.table("orders"), "o_orderdate", "o_totalprice")
    return rows.withColumn("o_totalprice", round_half_up(F.col("o_totalprice"), 2))
