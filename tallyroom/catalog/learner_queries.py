"""Queries over learners: results, levels, streaks, trends, feeds, chat, recommendations."""

from pyspark.sql import functions as F

from ..operators import learners
from .registry import CHAT, EV, QZ, mean_sql, query, rounded

_AVG = mean_sql("score_percent", 1)
_NTZ = "timestamp_ntz"


@query("f14_performance_summary", f"""WITH {QZ} SELECT user_id, {mean_sql("score_percent")} AS avg_score, count(*) AS attempts,
  CASE WHEN avg(score_percent) >= 85 THEN 'hard' WHEN avg(score_percent) >= 60 THEN 'medium' ELSE 'easy' END
  AS recommended_difficulty FROM quiz GROUP BY user_id""")
def performance_summary(t):
    from ..functions.numbers import round_half_up
    rows = learners.performance_summary(t.quiz_results)
    return rows.withColumn("avg_score", round_half_up(F.col("avg_score"), 2))


@query("f16_grade_attempts", f"""WITH {CHAT}, graded AS (
  SELECT session_id, id, role IN ('user', 'assistant') AS counts, length(message_text) % 3 <> 0 AS answered,
         length(message_text) % 3 = 1 AS correct FROM messages)
  SELECT session_id AS attempt_id, count(*) AS total_questions, count(*) FILTER (WHERE answered) AS answered,
         count(*) FILTER (WHERE correct) AS score,
         {rounded("count(*) FILTER (WHERE correct) / greatest(count(*), 1) * 100")} AS score_percent,
         coalesce(array_to_string(list(id ORDER BY id) FILTER (WHERE answered AND NOT correct), ','), '') AS struggled
  FROM graded WHERE counts GROUP BY session_id""")
def grade_attempts(t):
    part = F.length("message_text") % 3
    answers = t.chat_messages.select(
        F.col("session_id").alias("attempt_id"), F.col("id").alias("position"), F.col("id").alias("question_id"),
        F.when(F.col("role") == "system", F.array(F.lit("only"))).otherwise(F.array(F.lit("Yes"), F.lit("no"))).alias("options"),
        F.lit(" Yes").alias("answer"),
        F.when(part == 1, " yES ").when(part == 2, "no").alias("user_answer"),
    )
    rows = learners.grade_attempts(answers)
    return rows.withColumn("struggled", F.array_join(F.col("struggled").cast("array<string>"), ","))


@query("f17_overview", f"""WITH {QZ}, docs AS (SELECT doc_id % 100 AS user_id, count(*) AS n FROM documents GROUP BY 1),
  q AS (SELECT user_id, count(*) AS n, {_AVG} AS avg_score FROM quiz GROUP BY 1),
  s AS (SELECT user_id, sum(k) AS minutes FROM ev GROUP BY 1)
  SELECT *, CASE WHEN total_quizzes = 0 THEN 'Beginner' WHEN avg_score >= 85 THEN 'Expert' WHEN avg_score >= 70 THEN 'Advanced'
    WHEN avg_score >= 50 THEN 'Intermediate' ELSE 'Beginner' END AS level FROM (
  SELECT user_id, coalesce(q.n, 0) AS total_quizzes, coalesce(avg_score, 0.0) AS avg_score,
    CAST(coalesce(minutes, 0) AS BIGINT) AS study_minutes, coalesce(docs.n, 0) AS total_documents
  FROM q FULL JOIN s USING (user_id) FULL JOIN docs USING (user_id))""")
def overview(t):
    return learners.overview(t.quiz_results, t.study_sessions, t.documents)


@query("f18_knowledge_map", f"""WITH {QZ} SELECT *, CASE WHEN avg_score >= 85 THEN 'Mastered' WHEN avg_score >= 70 THEN 'Proficient'
  WHEN avg_score >= 45 THEN 'Learning' ELSE 'Needs Work' END AS mastery FROM (
  SELECT user_id, topic, {_AVG} AS avg_score, {rounded("max(score_percent)", 1)} AS best_score,
  arg_max(score_percent, created_at) AS latest_score, count(*) AS attempts FROM quiz GROUP BY 1, 2)""")
def knowledge_map(t):
    return learners.knowledge_map(t.quiz_results)


@query("f19_results_by_difficulty", f"""WITH {QZ} SELECT user_id, difficulty_level, {_AVG} AS avg_score, count(*) AS quizzes,
  CASE difficulty_level WHEN 'easy' THEN 0 WHEN 'medium' THEN 1 WHEN 'hard' THEN 2 ELSE 9 END AS sort_key
  FROM quiz WHERE difficulty_level IS NOT NULL GROUP BY 1, 2""")
def results_by_difficulty(t):
    return learners.results_by_difficulty(t.quiz_results)


@query("f20_smart_recommendations", f"""WITH {QZ},
  per AS (SELECT user_id, topic, avg(score_percent) AS a, count(*) AS n, sum(score_percent) AS s FROM quiz GROUP BY 1, 2),
  weak AS (SELECT user_id, 10 AS place, row_number() OVER (PARTITION BY user_id ORDER BY a, topic) AS rank,
    'Revise **' || topic || '** (avg ' || CAST(CAST(round_even(a, 0) AS BIGINT) AS VARCHAR) || '%) — re-read the summary and retry the quiz.' AS recommendation
    FROM per WHERE a < 60 QUALIFY rank <= 3),
  strong AS (SELECT user_id, 20 AS place, row_number() OVER (PARTITION BY user_id ORDER BY topic) AS rank,
    'You''ve mastered **' || topic || '** at ' || CAST(CAST(round_even(a, 0) AS BIGINT) AS VARCHAR) || '% — try a harder difficulty!' AS recommendation
    FROM per WHERE a >= 85 QUALIFY rank <= 2),
  st AS (SELECT user_id, coalesce(q, 0) AS q, a, coalesce(d, 0) AS d, coalesce(m, 0) AS m FROM
    (SELECT user_id, count(*) AS q, {_AVG} AS a FROM quiz GROUP BY 1)
    FULL JOIN (SELECT doc_id % 100 AS user_id, count(*) AS d FROM documents GROUP BY 1) USING (user_id)
    FULL JOIN (SELECT conv_id AS user_id, count(*) AS m FROM conversations GROUP BY 1) USING (user_id)),
  rules AS (
    SELECT user_id, 30 AS place, 1 AS rank, CASE WHEN a >= 80 AND q >= 3 THEN 'Outstanding performance! You''re consistently scoring above 80%.'
      ELSE 'Solid progress — focus on your weakest topics to improve further.' END AS recommendation FROM st WHERE a >= 60
    UNION ALL SELECT user_id, 40, 1, 'You''ve uploaded documents but haven''t taken any quizzes yet — try one!' FROM st WHERE d > 0 AND q = 0
    UNION ALL SELECT user_id, 50, 1, 'Generate a summary of your documents to reinforce understanding.' FROM st WHERE d > 0 AND m = 0),
  given AS (SELECT * FROM weak UNION ALL SELECT * FROM strong UNION ALL SELECT * FROM rules)
  SELECT user_id, CAST(place AS INTEGER) AS place, CAST(rank AS INTEGER) AS rank, recommendation FROM given
  UNION ALL SELECT user_id, 60, 1, 'Upload a document and take your first quiz to get personalised recommendations.'
  FROM st WHERE user_id NOT IN (SELECT user_id FROM given)""")
def smart_recommendations(t):
    summaries = t.chat_messages.select(F.col("session_id").alias("user_id"))
    return learners.smart_recommendations(t.quiz_results, t.documents, summaries)


@query("f21_study_minutes_by_topic", f"WITH {EV} SELECT user_id, topic, CAST(sum(k) AS BIGINT) AS minutes FROM ev GROUP BY 1, 2")
def study_minutes_by_topic(t):
    return learners.study_minutes_by_topic(t.study_sessions)


@query("f22_learning_profile", f"""WITH {QZ},
  per AS (SELECT user_id, topic, avg(score_percent) AS a, count(*) AS n FROM quiz GROUP BY 1, 2),
  strong AS (SELECT user_id, list(topic ORDER BY r) AS l FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY a DESC, n DESC, topic) AS r
    FROM per WHERE a >= 75 QUALIFY r <= 5) GROUP BY 1),
  weak AS (SELECT user_id, list(topic ORDER BY r) AS l FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY a, n DESC, topic) AS r
    FROM per WHERE a < 60 QUALIFY r <= 5) GROUP BY 1),
  act AS (SELECT user_id, topic FROM ev WHERE topic IS NOT NULL UNION ALL SELECT user_id, topic FROM ev WHERE topic IS NOT NULL
    UNION ALL SELECT user_id, event_type FROM ev WHERE topic IS NOT NULL),
  active AS (SELECT user_id, list(topic ORDER BY r) AS l FROM (SELECT user_id, topic, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, topic) AS r
    FROM act GROUP BY 1, 2 QUALIFY r <= 5) GROUP BY 1),
  macro AS (SELECT user_id, {rounded("avg(a)")} AS avg_score FROM per GROUP BY 1),
  j AS (SELECT m.user_id, avg_score, coalesce(s.l, []) AS s, coalesce(w.l, []) AS w, coalesce(x.l, []) AS x FROM macro m
    LEFT JOIN strong s USING (user_id) LEFT JOIN weak w USING (user_id) LEFT JOIN active x USING (user_id))
  SELECT user_id, avg_score, array_to_string(s, ',') AS strong_topics, array_to_string(w, ',') AS weak_topics,
    array_to_string(x, ',') AS most_active_topics,
    CASE WHEN len(w) > 0 THEN array_to_string(list_transform(w[1:3], lambda v: 'Revise ' || v || ' and try another medium quiz.'), '|')
         WHEN len(s) > 0 THEN 'Move to a harder quiz on ' || s[1] || '.'
         WHEN len(x) > 0 THEN 'Continue studying ' || x[1] || ' and generate a summary revision sheet.' ELSE '' END AS recommendations
  FROM j""")
def learning_profile(t):
    rows = learners.learning_profile(t.study_sessions, t.quiz_results, t.table_events)
    return rows.withColumns({
        **{c: F.array_join(c, ",") for c in ("strong_topics", "weak_topics", "most_active_topics")},
        "recommendations": F.array_join("recommendations", "|"),
    })


@query("g1_recent_rows", f"""WITH {EV} SELECT CAST(user_id AS VARCHAR) AS user_id, ts AS timestamp, topic, event_type AS action_type, score,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS INTEGER) AS rank FROM ev QUALIFY rank <= 10""")
def recent_rows(t):
    parts = learners.recent_history(t.log_records, t.log_records, t.log_records)
    return parts["recent_activity"].withColumn("timestamp", F.col("timestamp").cast(_NTZ))


@query("g1_quiz_history", f"""WITH {EV} SELECT CAST(user_id AS VARCHAR) AS user_id, ts AS timestamp, topic, score, k AS question_count,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS INTEGER) AS rank
  FROM ev WHERE event_type = 'purchase' QUALIFY rank <= 10""")
def quiz_history(t):
    parts = learners.recent_history(t.log_records, t.logs["quiz"], t.log_records)
    return parts["quiz_history"].withColumn("timestamp", F.col("timestamp").cast(_NTZ))


@query("g1_previous_day", f"""WITH {EV} SELECT CAST(user_id AS VARCHAR) AS user_id, topic, event_type AS action_type, score FROM ev
  WHERE CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) - 1 FROM ev)""")
def previous_day(t):
    parts = learners.recent_history(t.log_records, t.log_records, t.log_records)
    return parts["yesterday_topics"].drop("timestamp")


@query("g2_study_streak", """WITH days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
  isl AS (SELECT user_id, count(*) AS n, max(day) AS last FROM (
    SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS g FROM days) GROUP BY user_id, g),
  new AS (SELECT user_id, arg_max(n, last) AS n, max(last) AS last FROM isl GROUP BY 1)
  SELECT user_id, CASE WHEN last >= (SELECT max(day) FROM days) - 1 THEN n ELSE 0 END AS streak_days FROM new""")
def study_streak(t):
    return learners.study_streak(t.table_events)


@query("g3_last_result", f"""WITH {QZ}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC) AS rn,
    lag(score_percent) OVER (PARTITION BY user_id ORDER BY created_at) AS prev FROM quiz)
  SELECT user_id, topic, difficulty_level, score_percent, prev AS previous_score, {rounded("score_percent - prev")} AS delta,
    CASE WHEN {rounded("score_percent - prev")} > 0 THEN 'up' WHEN {rounded("score_percent - prev")} < 0 THEN 'down'
         WHEN {rounded("score_percent - prev")} = 0 THEN 'same' END AS direction FROM r WHERE rn = 1""")
def last_result(t):
    return learners.last_result(t.quiz_results)


_HALVES = """h AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY created_at, id) AS rn, count(*) OVER (PARTITION BY {keys}) AS n FROM quiz),
  d AS (SELECT {keys}, count(*) AS attempts, avg(score_percent) FILTER (WHERE rn <= n // 2) AS a,
    avg(score_percent) FILTER (WHERE rn > n // 2) AS b FROM h GROUP BY ALL)"""


@query("g4_score_trend", f"""WITH {QZ}, {_HALVES.format(keys="user_id")}
  SELECT user_id, attempts, {rounded("b - a", 1)} AS delta, CASE WHEN {rounded("b - a", 1)} > 2 THEN 'improving'
  WHEN {rounded("b - a", 1)} < -5 THEN 'declining' ELSE 'steady' END AS trend FROM d WHERE attempts >= 2""")
def score_trend(t):
    return learners.score_trend(t.quiz_results)


@query("g5_topic_trend", f"""WITH {QZ}, {_HALVES.format(keys="user_id, topic")}
  SELECT user_id, topic, attempts, CASE WHEN attempts < 2 THEN 'not enough data' WHEN b - a > 3 THEN 'improving'
  WHEN b - a < -3 THEN 'declining' ELSE 'steady' END AS trend FROM d""")
def topic_trend(t):
    return learners.topic_trend(t.quiz_results)


@query("g6_activity_feed", f"""WITH {EV} SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS INTEGER) AS rank,
  ts AS created_at, event_type || '_event' AS event_type,
  upper(event_type[1]) || event_type[2:] || ' Event' AS label,
  CASE event_type WHEN 'purchase' THEN 'Score: ' || CAST(k AS VARCHAR) || '%' WHEN 'view' THEN 'brief' ELSE '' END AS detail
  FROM ev QUALIFY rank <= 8""")
def activity_feed(t):
    return learners.activity_feed(t.table_events).withColumn("created_at", F.col("created_at").cast(_NTZ))


@query("g7_first_messages", f"""WITH {CHAT} SELECT session_id, id, role,
  CAST(row_number() OVER (PARTITION BY session_id ORDER BY id) AS INTEGER) AS position, '1' AS meta FROM messages QUALIFY position <= 50""")
def first_messages(t):
    rows = learners.first_messages(t.chat_messages, limit=50)
    return rows.select("session_id", "id", "role", "position", F.col("retrieval_metadata")["k"].alias("meta"))


@query("g7_shown_messages", f"""WITH {CHAT}, f AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY id) AS position FROM messages QUALIFY position <= 40)
  SELECT session_id, id, CAST(row_number() OVER (PARTITION BY session_id ORDER BY position DESC) AS INTEGER) AS from_end FROM f QUALIFY from_end <= 12""")
def shown_messages(t):
    return learners.shown_messages(t.chat_messages, loaded=40, shown=12).select("session_id", "id", "from_end")


@query("g7_sessions_newest", f"WITH {CHAT} SELECT id, user_id, title, updated_at FROM sessions")
def sessions_newest(t):
    return learners.sessions_newest_first(t.chat_sessions).select("id", "user_id", "title", "updated_at")


@query("g8_users_newest", """SELECT c_custkey AS id, c_name AS full_name, lower(c_name) || '@example.org' AS email,
  CAST(c_nationkey AS VARCHAR) AS created_at FROM customer""")
def users_newest(t):
    users = t.table("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("full_name"),
        F.concat(F.lower("c_name"), F.lit("@example.org")).alias("email"),
        F.col("c_nationkey").cast("string").alias("created_at"), F.lit("x").alias("password_hash"))
    return learners.users_newest_first(users)


@query("g9_score_summary", f"""WITH {QZ} SELECT user_id, {_AVG} AS average, max(score_percent) AS best,
  arg_max(score_percent, created_at) AS latest, count(*) AS total_quizzes FROM quiz GROUP BY 1""")
def score_summary(t):
    return learners.score_summary(t.quiz_results)


@query("g11_latest_ratings", f"""WITH {EV} SELECT k AS message_id, CAST(arg_max(floor(value / 100), ts) AS BIGINT) + 1 AS feedback_rating FROM ev GROUP BY k""")
def latest_ratings(t):
    ratings = t.events.select(
        F.col("k").alias("message_id"), (F.floor(F.col("value") / 100) + 1).alias("rating"), F.col("ts").alias("rated_at"))
    return learners.latest_ratings(ratings)


@query("e6_sessions_for_document", f"""WITH {CHAT}, m AS (SELECT *, document_id = 5 AS hit FROM sessions),
  a AS (SELECT user_id, bool_or(hit) AS any_hit FROM m GROUP BY 1)
  SELECT m.id, m.user_id, m.document_id FROM m JOIN a USING (user_id) WHERE hit OR NOT any_hit""")
def sessions_for_document(t):
    return learners.sessions_for_document(t.chat_sessions, F.lit(5)).select("id", "user_id", "document_id")
