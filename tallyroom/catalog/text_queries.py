"""Queries over documents: cleaning, splitting, ranking, topics, summaries, questions."""

from pyspark.sql import functions as F

from ..functions import text
from ..functions.binding import rows_of
from ..operators import questions as question_ops, ranking, summaries, topics
from ..plans import ingest
from .registry import query, rounded

# ---- SQL building blocks ------------------------------------------------------------


def _list(words):
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def strip_sql(value):
    return rf"regexp_replace({value}, '^\s+|\s+$', '', 'g')"


def words_sql(value):
    return rf"list_filter(string_split_regex({value}, '\s+'), lambda w: w <> '')"


def tokens_sql(value):
    return (
        f"list_filter(list_transform(regexp_extract_all({value}, '[A-Za-z0-9-]+'), lambda q: lower(q)), "
        f"lambda q: NOT list_contains({_list(text.RANKING_STOP_WORDS)}, q))"
    )


def split_sql(value):
    """Cut after a full stop, exclamation or question mark that is followed by whitespace."""
    return rf"string_split(regexp_replace({value}, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))"


def sentences_sql(value, least=5):
    return (
        f"list_transform(list_filter({split_sql(strip_sql(value))}, lambda s: len({words_sql('s')}) >= {least}), "
        f"lambda s: {strip_sql('s')})"
    )


def sentence_table(least=5):
    """CTEs `docs` (one list per document) and `sent` (one row per sentence)."""
    return f"""docs AS (SELECT doc_id, text, {sentences_sql('text', least)} AS l FROM documents),
  sent AS (SELECT doc_id, len(l) AS n_sentences, unnest(l) AS sentence, generate_subscripts(l, 1) - 1 AS pos FROM docs)"""


_SCORED = f"""{sentence_table()},
  st AS (SELECT *, {tokens_sql('sentence')} AS toks FROM sent),
  tf AS (SELECT doc_id, pos, n_sentences, len(toks) AS n_tokens, tok, count(*) AS tf FROM
    (SELECT doc_id, pos, n_sentences, toks, unnest(toks) AS tok FROM st) GROUP BY ALL),
  dfr AS (SELECT doc_id, tok, count(*) AS df FROM tf GROUP BY 1, 2),
  tfidf AS (SELECT doc_id, pos, sum(tf * (ln((1.0 + n_sentences) / (1.0 + df)) + 1)) / max(n_tokens) AS score
    FROM tf JOIN dfr USING (doc_id, tok) GROUP BY 1, 2),
  sizes AS (SELECT doc_id, pos, count(*) AS n FROM tf GROUP BY 1, 2),
  pairs AS (SELECT a.doc_id, a.pos, b.pos AS other, count(*) AS shared FROM tf a JOIN tf b
    ON a.doc_id = b.doc_id AND a.tok = b.tok AND a.pos <> b.pos GROUP BY ALL),
  tr AS (SELECT p.doc_id, p.pos, sum(shared / (ln(x.n + 1.0) + ln(y.n + 1.0))) AS score FROM pairs p
    JOIN sizes x ON x.doc_id = p.doc_id AND x.pos = p.pos JOIN sizes y ON y.doc_id = p.doc_id AND y.pos = p.other GROUP BY 1, 2),
  scored AS (SELECT st.doc_id, st.pos, sentence, CAST(len(toks) AS INTEGER) AS n_tokens,
    {rounded('tfidf.score', 9)} AS tfidf, coalesce({rounded('tr.score', 9)}, 0.0) AS textrank
    FROM st LEFT JOIN tfidf ON st.doc_id = tfidf.doc_id AND st.pos = tfidf.pos
    LEFT JOIN tr ON st.doc_id = tr.doc_id AND st.pos = tr.pos)"""


def merged_sql(per_list, limit):
    return f"""{_SCORED},
  rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n_tokens > 0 DESC, tfidf DESC NULLS LAST, pos) AS a,
    row_number() OVER (PARTITION BY doc_id ORDER BY textrank DESC, pos) AS b FROM scored),
  listed AS (SELECT *, CASE WHEN n_tokens > 0 AND a <= {per_list} THEN 0 WHEN b <= {per_list} THEN 1 END AS which FROM rk),
  once AS (SELECT * FROM listed WHERE which IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id, sentence ORDER BY which, pos) = 1),
  lines AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY which, pos) AS INTEGER) AS line, sentence FROM once QUALIFY line <= {limit})"""


def _scored(t, most):
    return ranking.scored_sentences(t.doc_texts, ["doc_id"], text.sentences(F.col("text")), most=most)


# ---- cleaning and splitting ---------------------------------------------------------


@query("j1_clean_words", rf"""SELECT doc_id, array_to_string(list_filter(list_transform({words_sql('text')},
  lambda x: lower(regexp_replace(x, '[^a-zA-Z0-9]+', '', 'g'))), lambda x: x <> ''), ' ') AS cleaned FROM documents""")
def clean_words(t):
    return t.doc_texts.select("doc_id", F.array_join(text.clean_words(F.col("text")), " ").alias("cleaned"))


@query("j2_strip_page_markers", rf"""SELECT conv_id, turn, {strip_sql(r"regexp_replace(regexp_replace('[Page ' || CAST(turn AS VARCHAR) || ']' || chr(10) || text || ' [page 12] end', '(?i)\s*\[Page\s+\d+\]\s*', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g')")} AS cleaned
  FROM conversations""")
def strip_page_markers(t):
    marked = F.concat(F.lit("[Page "), F.col("turn").cast("string"), F.lit("]\n"), "text", F.lit(" [page 12] end"))
    return t.table("conversations").select("conv_id", "turn", text.strip_page_markers(marked).alias("cleaned"))


@query("j3_chunk_text", rf"""WITH p AS (SELECT doc_id, {strip_sql("replace(text, chr(13) || chr(10), chr(10))")} AS p FROM documents),
  w AS (SELECT doc_id, p, unnest(generate_series(0, CAST(ceil(greatest(length(p) - 1800, 0) / 1550.0) AS BIGINT))) AS i FROM p WHERE p <> '')
  SELECT doc_id, CAST(i AS INTEGER) AS chunk_no, {strip_sql("substr(p, i * 1550 + 1, 1800)")} AS chunk FROM w""")
def chunk_text(t):
    return ingest.document_chunks(t.doc_texts, "doc_id", "text")


@query("j4_pages", """SELECT conv_id, turn, CAST(n AS INTEGER) AS page_number, body AS text FROM (
  SELECT conv_id, turn, unnest([turn + 1, turn + 7]) AS n, unnest([regexp_replace(text, '^\\s+|\\s+$', '', 'g'), 'last page']) AS body FROM conversations)
  WHERE body <> ''""".replace("\\\\", "\\"))
def pages(t):
    marked = F.concat(
        F.lit("[Page "), (F.col("turn") + 1).cast("string"), F.lit("]\n"), "text", F.lit("\n[PAGE "),
        (F.col("turn") + 7).cast("string"), F.lit("] \nlast page"))
    rows = t.table("conversations").select("conv_id", "turn", F.explode(text.pages(marked)).alias("p"))
    return rows.select("conv_id", "turn", "p.page_number", "p.text")


@query("j5_detect_language", r"""SELECT doc_id, CASE WHEN length(regexp_replace(text, '[^\x00-\x7F]', '', 'g'))
  / greatest(length(text), 1) > 0.97 THEN 'en'
  WHEN regexp_matches(text, '[\x{0900}-\x{097F}]') THEN 'hi' ELSE 'unknown' END AS language FROM documents""")
def detect_language(t):
    return t.doc_texts.select("doc_id", text.detect_language(F.col("text")).alias("language"))


@query("j6_sentences", f"WITH {sentence_table()} SELECT doc_id, CAST(pos AS INTEGER) AS pos, sentence FROM sent")
def sentences(t):
    return ranking.sentence_rows(t.doc_texts, ["doc_id"], text.sentences(F.col("text"))).select("doc_id", "pos", "sentence")


@query("j6_question_sentences", f"WITH {sentence_table(8)} SELECT doc_id, CAST(pos AS INTEGER) AS pos, sentence FROM sent")
def question_sentences(t):
    return rows_of(t.doc_texts, ["doc_id"], text.question_sentences(F.col("text")), "sentence", "pos")


_NOISE = r"(?i)(?:\broll\s*no\b|\bteam\s+members?\b|\bcourse\b|\bbtech\b|\bsubmitted\s+by\b|\bdepartment\b|\bstudent\b|\bguide\b|\bmentor\b|\bname\s*:)"


def noise_sql(value):
    return (
        f"({strip_sql(value)} = '' OR regexp_matches({value}, '{_NOISE}') OR "
        rf"(length({value}) - length(replace({value}, '(', '')) >= 2 AND regexp_matches({value}, '\d')))"
    )


def units_sql(value):
    def ends(v):
        return rf"regexp_replace({v}, '^[ \t-]+|[ \t-]+$', '', 'g')"

    parts = f"flatten(list_transform(string_split({strip_sql(value)}, chr(10)), lambda z: {split_sql(ends('z'))}))"
    bare = f"list_transform({parts}, lambda z: {ends('z')})"
    return f"list_filter({bare}, lambda z: len({words_sql('z')}) >= 4 AND NOT {noise_sql('z')})"


@query("j7_units", f"""SELECT doc_id, unnest(u) AS unit, CAST(generate_subscripts(u, 1) - 1 AS INTEGER) AS pos FROM
  (SELECT doc_id, {units_sql('text')} AS u FROM documents)""")
def units(t):
    return rows_of(t.doc_texts, ["doc_id"], text.units(F.col("text")), "unit", "pos")


@query("j8_noise_lines", rf"""SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE {noise_sql('line')}) AS n_noise FROM
  (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1""")
def noise_lines(t):
    rows = t.doc_texts.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return rows.groupBy("doc_id").agg(
        F.count("*").alias("n_lines"), F.count_if(text.is_noise(F.col("line"))).alias("n_noise"))


@query("j9_tokens", f"SELECT doc_id, array_to_string({tokens_sql('text')}, ' ') AS tokens FROM documents")
def tokens(t):
    return t.doc_texts.select("doc_id", F.array_join(text.tokens(F.col("text")), " ").alias("tokens"))


_TERMS = rf"""terms AS (SELECT doc_id, lower(regexp_replace(w, '[^a-zA-Z0-9]+', '', 'g')) AS term FROM
  (SELECT doc_id, unnest(string_split_regex(text, '\s+')) AS w FROM documents)),
  kept AS (SELECT * FROM terms WHERE length(term) > 2 AND NOT list_contains({_list(text.FREQUENCY_STOP_WORDS)}, term))"""


@query("j10_word_frequencies", f"WITH {_TERMS} SELECT term, count(*) AS frequency FROM kept GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def word_frequencies(t):
    return ranking.word_frequencies(t.doc_texts, "text")


@query("j10_document_word_frequencies", f"""WITH {_TERMS} SELECT doc_id, term, count(*) AS frequency,
  CAST(row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, term) AS INTEGER) AS rank FROM kept GROUP BY 1, 2 QUALIFY rank <= 15""")
def document_word_frequencies(t):
    return ranking.word_frequencies(t.doc_texts, "text", keys=["doc_id"])


@query("j11_length_metrics", rf"""SELECT *, {rounded("words / greatest(sentences, 1)")} AS avg_words_per_sentence FROM (
  SELECT doc_id, CAST(length(text) AS INTEGER) AS characters, CAST(len({words_sql('text')}) AS INTEGER) AS words,
  CAST(len(list_filter(string_split(replace(text, chr(10), ' '), '.'), lambda s: {strip_sql('s')} <> '')) AS INTEGER) AS sentences,
  CAST(len(list_filter(string_split(text, chr(10)), lambda s: {strip_sql('s')} <> '')) AS INTEGER) AS paragraphs FROM documents)""")
def length_metrics(t):
    return t.doc_texts.select("doc_id", *[v.alias(k) for k, v in text.length_metrics(F.col("text")).items()])


_RELEVANT = rf"""(len({words_sql('text')}) >= 35 AND (len({sentences_sql('text')}) >= 2 OR len({words_sql('text')}) >= 60)
  AND length(regexp_replace(text, '[^\p{{L}}\p{{N}}]', '', 'g')) / greatest(length(text), 1) >= 0.55)"""


@query("j12_page_relevance", f"SELECT doc_id, {_RELEVANT} AS relevant FROM documents")
def page_relevance(t):
    return t.doc_texts.select("doc_id", text.is_relevant_page(F.col("text")).alias("relevant"))


@query("j13_relevant_pages", rf"""WITH p AS (SELECT conv_id, turn, {strip_sql('text')} AS text FROM conversations),
  m AS (SELECT *, {_RELEVANT} AS r, len({words_sql('text')}) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS idx FROM p WHERE text <> ''),
  k AS (SELECT *, bool_or(r) OVER (PARTITION BY conv_id) AS any_r, row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, idx) AS lr FROM m)
  SELECT conv_id, CAST(turn AS INTEGER) AS page_number, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY CASE WHEN any_r THEN idx ELSE lr END) AS INTEGER) AS page_order
  FROM k WHERE CASE WHEN any_r THEN r ELSE lr <= 5 END""")
def relevant_pages(t):
    page = F.concat(F.lit("[Page "), F.col("turn").cast("string"), F.lit("]\n"), "text")
    conversations = t.table("conversations").groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", page.alias("p")))), lambda s: s["p"]), "\n").alias("text"))
    return summaries.relevant_pages(conversations, "conv_id", "text").select("conv_id", "page_number", "page_order")


# ---- ranking ------------------------------------------------------------------------


@query("e2_shared_tokens", f"""WITH {sentence_table()}, tok AS (SELECT DISTINCT doc_id, pos, unnest({tokens_sql('sentence')}) AS tok FROM sent),
  n AS (SELECT doc_id, tok, count(*) AS n FROM tok GROUP BY 1, 2)
  SELECT doc_id, CAST(pos AS INTEGER) AS pos, count(*) AS n_distinct, CAST(sum(n - 1) AS BIGINT) AS shared FROM tok JOIN n USING (doc_id, tok) GROUP BY 1, 2""")
def shared_tokens(t):
    rows = ranking.sentence_rows(t.doc_texts, ["doc_id"], text.sentences(F.col("text")))
    return ranking.shared_token_counts(rows, ["doc_id"])


@query("e7_distinct_sentences", f"""WITH {sentence_table()} SELECT doc_id, sentence, CAST(min(pos) AS INTEGER) AS pos FROM sent GROUP BY 1, 2""")
def distinct_sentences(t):
    rows = ranking.sentence_rows(t.doc_texts, ["doc_id"], text.sentences(F.col("text")))
    return rows.groupBy("doc_id", "sentence").agg(F.min("pos").alias("pos"))


@query("j14_tfidf_summary", f"""WITH {_SCORED} SELECT doc_id, CAST(pos AS INTEGER) AS pos, sentence, tfidf,
  CAST(row_number() OVER (PARTITION BY doc_id ORDER BY tfidf DESC, pos) AS INTEGER) AS rank FROM scored WHERE n_tokens > 0 QUALIFY rank <= 10""")
def tfidf_summary(t):
    return ranking.top_tfidf(_scored(t, 10), ["doc_id"], 10).select("doc_id", "pos", "sentence", "tfidf", "rank")


@query("j15_textrank_summary", f"""WITH {_SCORED} SELECT doc_id, CAST(pos AS INTEGER) AS pos, sentence, textrank,
  CAST(row_number() OVER (PARTITION BY doc_id ORDER BY textrank DESC, pos) AS INTEGER) AS rank FROM scored QUALIFY rank <= 8""")
def textrank_summary(t):
    return ranking.top_textrank(_scored(t, 8), ["doc_id"], 8).select("doc_id", "pos", "sentence", "textrank", "rank")


@query("j16_important_sentences", f"WITH {merged_sql(5, 5)} SELECT doc_id, line, sentence FROM lines")
def important_sentences(t):
    return ranking.important_sentences(_scored(t, 5), ["doc_id"], 5).select("doc_id", "line", "sentence")


@query("j16_page_lines", f"WITH {merged_sql(4, 2)} SELECT doc_id, line, sentence FROM lines")
def page_lines(t):
    return ranking.page_lines(_scored(t, 4), ["doc_id"], 2).select("doc_id", "line", "sentence")


# ---- topics and summaries -----------------------------------------------------------


_MASKED = r"regexp_replace(regexp_replace(sentence, '[^\x00-\x7F\P{L}]', '_', 'g'), '[^\x00-\x7F\P{N}]', '_', 'g')"
_PHRASE = r"\b[A-Z][A-Za-z0-9+-]{2,}(?:\s+[A-Z][A-Za-z0-9+-]{2,})*\b"
_TITLED = (
    "array_to_string(list_transform(range(1, length(w) + 1), lambda i: CASE WHEN i = 1 OR NOT regexp_matches(w[i - 1], '[a-z]') "
    "THEN upper(w[i]) ELSE w[i] END), '')"
)
_DROPPED = f"""(len(kept) >= 8 OR length(x[1]) < 4 OR list_contains({_list(text.RANKING_STOP_WORDS)}, lower(x[1]))
    OR len(list_filter(kept, lambda k: lower(k) = lower(x[1]))) > 0
    OR (len({words_sql('x[1]')}) = 1 AND (list_contains(covered, lower(x[1]))
        OR len(list_filter(kept, lambda k: contains(lower(k), lower(x[1])) OR contains(lower(x[1]), lower(k)))) > 0)))"""


@query("j17_topics", f"""WITH {sentence_table()},
  found AS (SELECT doc_id, pos, list_filter(regexp_extract_all({_MASKED}, '{_PHRASE}'), lambda p: len({words_sql('p')}) <= 5
      AND NOT list_contains({_list(text.RANKING_STOP_WORDS)}, lower(p))) AS phrases,
    list_filter({tokens_sql('sentence')}, lambda t: length(t) > 5) AS longs FROM sent),
  cand AS (SELECT doc_id, unnest(phrases) AS topic, 2 AS w, pos * 10000000 + generate_subscripts(phrases, 1) AS place FROM found
    UNION ALL SELECT doc_id, {_TITLED}, 1, place FROM
      (SELECT doc_id, unnest(longs) AS w, pos * 10000000 + 5000000 + generate_subscripts(longs, 1) AS place FROM found)),
  ordered AS (SELECT doc_id, list(topic ORDER BY r) AS l FROM (SELECT doc_id, topic, row_number() OVER (PARTITION BY doc_id
    ORDER BY sum(w) DESC, min(place)) AS r FROM cand GROUP BY 1, 2 QUALIFY r <= 24) GROUP BY 1),
  cov AS (SELECT doc_id, l, flatten(list_transform(list_filter(l, lambda t: len({words_sql('t')}) > 1), lambda t: {words_sql('lower(t)')})) AS covered FROM ordered)
  SELECT doc_id, array_to_string(list_reduce(list_transform(l, lambda t: [t]),
    lambda kept, x: CASE WHEN {_DROPPED} THEN kept ELSE list_concat(kept, x) END, CAST([] AS VARCHAR[])), '|') AS topics FROM cov""")
def extract_topics(t):
    rows = topics.extract_topics(t.doc_texts, ["doc_id"], "text")
    return rows.withColumn("topics", F.array_join("topics", "|"))


@query("j18_topic_sentences", f"""WITH d AS (SELECT doc_id, unnest(['the', 'and of', 'la']) AS topic, {sentences_sql('text')} AS l FROM documents),
  h AS (SELECT *, list_filter(l, lambda s: contains(lower(s), topic)) AS a,
    list_filter(l, lambda s: list_has_any({tokens_sql('s')}, string_split(topic, ' '))) AS b FROM d)
  SELECT doc_id, topic, coalesce(array_to_string((CASE WHEN len(a) > 0 THEN a ELSE b END)[1:4], '|'), '') AS related FROM h""")
def topic_sentences(t):
    cut = t.doc_texts.select("doc_id", text.sentences(F.col("text")).alias("l"))
    rows = cut.select("doc_id", "l", F.explode(F.array(F.lit("the"), F.lit("and of"), F.lit("la"))).alias("topic"))
    return rows.select(
        "doc_id", "topic", F.array_join(topics.topic_sentences(F.col("l"), F.col("topic")), "|").alias("related"))


@query("j19_key_insights", rf"""WITH {merged_sql(4, 4)},
  nota AS (SELECT doc_id, sentence, min(pos) AS pos FROM sent WHERE regexp_matches(sentence, '(?i)(?:^|[^\p{{L}}\p{{N}}_])(?:is|refers to|defined as|means)(?:[^\p{{L}}\p{{N}}_]|$)')
    OR regexp_matches(sentence, '(?:^|[^\p{{L}}\p{{N}}_])\d+(?:\.\d+)?(?:[^\p{{L}}\p{{N}}_]|$)') GROUP BY 1, 2
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY min(pos)) <= 6),
  al AS (SELECT doc_id, pos AS place, CASE WHEN regexp_matches(sentence, '(?i)(?:^|[^\p{{L}}\p{{N}}_])(?:is|refers to|defined as|means)(?:[^\p{{L}}\p{{N}}_]|$)') THEN 'definition' ELSE 'statistic' END AS type, sentence FROM nota
    UNION ALL SELECT doc_id, 1000000 + line, 'important_line', sentence FROM lines WHERE (doc_id, sentence) NOT IN (SELECT (doc_id, sentence) FROM nota))
  SELECT doc_id, type, sentence AS text, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY place) AS INTEGER) AS rank FROM al QUALIFY rank <= 10""")
def key_insights(t):
    return summaries.key_insights(t.doc_texts, "doc_id", "text")


@query("j20_hierarchical_summary")
def hierarchical_summary(t):
    return summaries.hierarchical_summary(t.doc_texts, "doc_id", "text")


@query("j21_pagewise_summary")
def pagewise_summary(t):
    return summaries.pagewise_summary(t.doc_texts, "doc_id", "text")


@query("j22_hybrid_bullets", f"""WITH {merged_sql(8, 10)} SELECT doc_id, string_agg('- ' || sentence, chr(10) ORDER BY line) AS summary_text FROM lines GROUP BY 1""")
def hybrid_bullets(t):
    lines = summaries.document_lines(t.doc_texts, "doc_id", "text", "hybrid")
    return lines.select("doc_id", summaries.bullets(F.col("document_level")).alias("summary_text"))


@query("j22_mode_aliases", """SELECT conv_id, turn, CASE role WHEN 'user' THEN 'brief' WHEN 'assistant' THEN 'detailed' ELSE 'bullet_points' END AS mode FROM conversations""")
def mode_aliases(t):
    asked = F.when(F.col("role") == "user", "revision").when(F.col("role") == "assistant", "exam_notes").otherwise("bullet_summary")
    return t.table("conversations").select("conv_id", "turn", summaries.normalize_mode(asked).alias("mode"))


@query("j23_summarize_documents")
def summarize_documents(t):
    requests = t.documents.select(
        "user_id", F.col("id").alias("document_id"), F.lit("auto").alias("method"),
        F.lit("bullet_summary").alias("mode"), F.lit("en").alias("target_language"))
    from ..sources.batch import empty_frame
    from ..schemas import OPERATIONAL
    return summaries.summarize_documents(requests, t.documents, empty_frame(t.spark, OPERATIONAL["summaries"]))


@query("j24_document_ingest", r"""SELECT sha256(text) AS file_hash, arg_min(doc_id, (doc_id % 60) * 1000000000 + doc_id) AS id,
  '.txt' AS file_type, count(*) AS usage_count FROM documents GROUP BY 1""")
def document_ingest(t):
    return ingest.ingest(t.documents)["documents"].select("file_hash", "id", "file_type", "usage_count")


# ---- questions ----------------------------------------------------------------------


def important_sql(value):
    return (
        f"list_filter(list_transform({words_sql(value)}, lambda w: regexp_replace(w, '[^A-Za-z0-9-]', '', 'g')), "
        f"lambda w: length(w) > 4 AND NOT list_contains({_list(text.QUESTION_STOP_WORDS)}, lower(w)))"
    )


@query("k11_important_words", f"""WITH {sentence_table(8)} SELECT doc_id, CAST(pos AS INTEGER) AS pos, array_to_string({important_sql('sentence')}, ' ') AS important FROM sent""")
def important_words(t):
    rows = rows_of(t.doc_texts, ["doc_id"], text.question_sentences(F.col("text")), "s", "pos")
    return rows.select("doc_id", "pos", F.array_join(text.important_words(F.col("s")), " ").alias("important"))


@query("k11_concise_fact", rf"""WITH {sentence_table(8)},
  c AS (SELECT doc_id, pos, sentence, list_filter(list_transform(list_filter(
    string_split_regex(sentence, ',|;|:|\band\b'), lambda p: {strip_sql('p')} <> ''),
    lambda p: regexp_replace(p, '^[ ,;:-]+|[ ,;:-]+$', '', 'g')), lambda p: len({words_sql('p')}) >= 3) AS cl FROM sent)
  SELECT doc_id, CAST(pos AS INTEGER) AS pos, regexp_replace(coalesce(cl[1], sentence), '\.+$', '') || '.' AS fact FROM c""")
def concise_fact(t):
    rows = rows_of(t.doc_texts, ["doc_id"], text.question_sentences(F.col("text")), "s", "pos")
    return rows.select("doc_id", "pos", text.concise_fact(F.col("s")).alias("fact"))


@query("k12_sample_evenly", f"""WITH {sentence_table(8)} SELECT doc_id, CAST(pos AS INTEGER) AS pos, sentence FROM sent
  WHERE n_sentences <= 5 OR (pos % greatest(1, n_sentences // 5) = 0 AND pos // greatest(1, n_sentences // 5) < 5)""")
def sample_evenly(t):
    numbered = F.transform(text.question_sentences(F.col("text")), lambda s, i: F.struct(i.alias("pos"), s.alias("sentence")))
    rows = rows_of(t.doc_texts, ["doc_id"], question_ops.sample_evenly(numbered, 5), "s")
    return rows.select("doc_id", "s.pos", "s.sentence")


@query("k13_focus_sentences")
def focus_sentences(t):
    rows = topics.extract_topics(t.doc_texts, ["doc_id"], "text", 4, carried=[]).select(
        "doc_id", text.question_sentences(F.col("text")).alias("s"),
        F.coalesce("topics", F.array().cast("array<string>")).alias("topics"))
    return rows.select("doc_id", question_ops.focus_sentences(F.col("s"), F.col("topics"), 8).alias("sentences"))


@query("k14_build_questions")
def build_questions(t):
    return question_ops.build_questions(t.doc_texts, "doc_id", "text", 5)


@query("k15_check_questions", r"""WITH q AS (SELECT conv_id, turn, role, regexp_replace(CASE WHEN turn > 0 THEN text ELSE ' ' END, '^\s+|\s+$', '', 'g') AS question FROM conversations)
  SELECT conv_id, turn, CASE WHEN question = '' THEN 'no question' WHEN role = 'system' THEN 'no answer'
    WHEN role = 'assistant' AND turn > 3 THEN 'answer is not True or False' WHEN role = 'user' AND turn > 1 THEN 'not four options' END AS reject_reason FROM q""")
def check_questions(t):
    turn = F.col("turn")
    rows = t.table("conversations").select(
        "conv_id", "turn", F.when(F.col("role") == "assistant", "true_false").alias("type"),
        F.when(turn > 0, F.col("text")).otherwise(" ").alias("question"),
        F.when(F.col("role") == "system", "  ").when(turn > 3, "Maybe").otherwise("True").alias("answer"),
        F.when(turn > 1, F.array(F.lit("a"))).otherwise(F.array(*[F.lit(c) for c in "abcd"])).alias("options"),
        F.lit(None).cast("string").alias("difficulty"), F.lit(None).cast("string").alias("skill_level"),
        F.lit(None).cast("string").alias("explanation"), F.lit(None).cast("double").alias("quality_score"))
    return question_ops.check_questions(rows).select("conv_id", "turn", "reject_reason")
