"""Operational table logic as set operations: dedup, upsert, fold, enrichment, appends."""

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .. import schemas
from ..functions import text
from ..functions.clocks import time_of
from ..functions.numbers import round_half_up, score_percent
from ..functions.skew import ranked


# ---- users -------------------------------------------------------------------------


def registration_checks(users: DataFrame) -> DataFrame:
    """Cleaned name and e-mail with a validity flag for each."""
    cleaned = users.withColumns({
        "full_name": text.strip(F.col("full_name")),
        "email": F.lower(text.strip(F.col("email"))),
    })
    return cleaned.withColumns({
        "name_ok": F.length("full_name") >= 2,
        "email_ok": F.col("email").rlike(text.EMAIL),
    })


def lookup(table: DataFrame, row_id) -> DataFrame:
    """Row with the given id; a password column is never returned."""
    visible = [c for c in table.columns if c != "password_hash"]
    return table.where(F.col("id") == F.lit(row_id)).select(*visible)


def listing(table: DataFrame, name: str, limit: int | None = None) -> DataFrame:
    """The listed columns of a table, newest id first."""
    rows = table.select(*schemas.LISTING_COLUMNS[name]).orderBy(F.desc("id"))
    return rows if limit is None else rows.limit(limit)


# ---- documents ---------------------------------------------------------------------


def text_hash(value: Column) -> Column:
    return F.sha2(value, 256)


def document_registry(uploads: DataFrame) -> DataFrame:
    """One document per distinct text.

    The first upload gives id, owner, name, type and creation time; later ones
    add to the usage count and set topic, language and update time. Uploads
    carry id, user_id, filename, file_type, topic, language, text_content and
    created_at. The text itself takes no part in the aggregation: only its hash
    and a few short columns are shuffled, with map-side combining, so a third of
    all uploads being copies costs nothing. `registry_texts` adds the text.
    """
    at = F.struct(time_of(uploads, "created_at"), F.col("id"))
    hashed = uploads.select(
        text_hash(F.col("text_content")).alias("file_hash"),
        at.alias("at"),
        F.struct(
            "id", "user_id", text.strip(F.col("filename")).alias("filename"),
            text.strip(F.col("file_type")).alias("file_type"), "created_at",
        ).alias("first"),
        F.struct(
            text.strip(F.col("topic")).alias("topic"), text.strip(F.col("language")).alias("language"),
            F.col("created_at").alias("updated_at"),
        ).alias("last"),
    )
    return (
        hashed.groupBy("file_hash")
        .agg(
            F.min_by("first", "at").alias("first"), F.max_by("last", "at").alias("last"),
            F.count("*").alias("usage_count"),
        )
        .select("first.*", "file_hash", "last.*", "usage_count")
    )


def registry_texts(registry: DataFrame, uploads: DataFrame) -> DataFrame:
    """Add the text of the first upload to each registered document."""
    return registry.join(uploads.select("id", "text_content"), "id")


def merge_uploads(uploads: DataFrame, batch: str = "batch_id", position: str = "position",
                  most_bytes: int = 64 << 20) -> DataFrame:
    """Combine the files of each upload batch into one document, in upload order.

    A batch of up to `most_bytes` bytes of text is one row, `part` 0. A longer one, such as all
    uploads without a batch, comes as several rows numbered by `part`, each of which begins new once its
    files would pass the bound and lists its own files; their texts, with two blank lines between,
    are the batch's text. Files of one position stay together. Only lengths are put in order per batch;
    the texts meet by (batch, part).
    """
    sizes = uploads.groupBy(F.col(batch).alias("__batch"), F.col(position).alias("__position")).agg(
        F.sum(F.coalesce(F.octet_length("text_content"), F.lit(0))).alias("bytes"))
    upto = F.sum("bytes").over(Window.partitionBy("__batch").orderBy("__position").rowsBetween(Window.unboundedPreceding, 0))
    cut = F.floor(F.greatest(upto - 1, F.lit(0)) / most_bytes)
    parts = sizes.select("__batch", "__position", cut.alias("__cut"))
    numbered = parts.withColumn("part", F.dense_rank().over(Window.partitionBy("__batch").orderBy("__cut")) - 1)
    same = F.col(batch).eqNullSafe(F.col("__batch")) & F.col(position).eqNullSafe(F.col("__position"))
    header = F.concat(F.lit("===== DOCUMENT: "), "filename", F.lit(" =====\n\n"), "text_content")
    files = uploads.join(numbered, same).groupBy(batch, "part").agg(
        F.array_sort(
            F.collect_list(F.struct(position, "filename", "topic", "language", header.alias("section")))
        ).alias("files")
    )
    names = F.col("files.filename")
    return files.select(
        batch,
        F.array_join(names, " + ").alias("filename"),
        F.lit(".multi").alias("file_type"),
        F.array_join(F.array_distinct(F.col("files.topic")), ", ").alias("topic"),
        F.get(F.col("files.language"), F.lit(0)).alias("language"),
        F.array_join(F.col("files.section"), "\n\n\n").alias("text_content"),
        F.size("files").alias("n_files"),
        "part",
    )


# ---- summaries ---------------------------------------------------------------------


def summary_key(user_id: Column, document_id: Column, method: Column, mode: Column,
                target_language: Column) -> Column:
    """Cache key of a summary request."""
    parts = [c.cast("string") for c in (user_id, document_id, method, mode, target_language)]
    return F.sha2(F.concat_ws("|", *parts), 256)


def with_summary_key(frame: DataFrame) -> DataFrame:
    names = ("user_id", "document_id", "method", "mode", "target_language")
    return frame.withColumn("summary_hash", summary_key(*[F.col(n) for n in names]))


def latest_summaries(summaries: DataFrame) -> DataFrame:
    """One row per cache key: content of the newest, id and creation time of the first."""
    keyed = with_summary_key(summaries).withColumn("at", F.struct(time_of(summaries, "created_at"), F.col("id")))
    content = F.struct("summary_text", "key_insights", "hierarchy_json")
    keys = ["user_id", "document_id", "method", "mode", "target_language", "summary_hash"]
    return (
        keyed.groupBy(*keys)
        .agg(
            F.min_by(F.struct("id", "created_at"), "at").alias("first"),
            F.max_by(content, "at").alias("content"),
        )
        .select("first.id", *keys, "content.*", "first.created_at")
    )


def merge_summaries(stored: DataFrame, updates: DataFrame) -> DataFrame:
    """Stored summaries with updates merged in by cache key: a key keeps its first id and creation time and takes the new content.

    Both carry the columns of the summaries table, one row per `summary_hash` in `stored`. Several
    updates of one key in a batch are first made one (`latest_summaries`). The result has the
    columns of `stored`.
    """
    columns = stored.columns
    new = latest_summaries(updates).alias("n")
    old = stored.alias("o")
    content, first = ("summary_text", "key_insights", "hierarchy_json"), ("id", "created_at")

    def chosen(name: str) -> Column:
        own, other = F.col(f"o.{name}"), F.col(f"n.{name}")
        if name in content:
            return F.when(F.col("n.summary_hash").isNotNull(), other).otherwise(own)
        if name in first:
            return F.when(F.col("o.summary_hash").isNotNull(), own).otherwise(other)
        return F.coalesce(own, other)

    return old.join(new, F.col("o.summary_hash") == F.col("n.summary_hash"), "full").select(
        *[chosen(c).alias(c) for c in columns])


def new_summary_rows(summaries: DataFrame, first_id: Column, now: Column, spread: int = 64) -> DataFrame:
    """Computed summaries as rows of the summaries table, with ids from `first_id` on and `now` as their time.

    Ids are numbered inside `spread` shares of the keys and interleaved: they are unique and larger than
    all earlier ones, and no task numbers all rows.
    """
    share = F.pmod(F.xxhash64("summary_hash"), F.lit(spread))
    place = F.row_number().over(Window.partitionBy(share).orderBy("summary_hash"))
    return summaries.select(
        (first_id + (place - 1) * spread + share).cast("long").alias("id"), "user_id", "document_id", "summary_hash",
        "method", "mode", "target_language", "summary_text", "key_insights", "hierarchy_json", now.alias("created_at"))


def cached_summaries(requests: DataFrame, summaries: DataFrame) -> DataFrame:
    """Requests that have a stored summary, with it."""
    stored = latest_summaries(summaries).select(
        "summary_hash", "id", "summary_text", "key_insights", "hierarchy_json"
    )
    return with_summary_key(requests).join(stored, "summary_hash")


def summary_misses(requests: DataFrame, summaries: DataFrame) -> DataFrame:
    """Requests without a stored summary."""
    stored = with_summary_key(summaries).select("summary_hash").distinct()
    return with_summary_key(requests).join(stored, "summary_hash", "left_anti")


def propagate_summaries(quiz: DataFrame, updates: DataFrame) -> DataFrame:
    """Set `summary_cache` of the quiz rows of the same user and document to the newest update."""
    at = F.struct(time_of(updates, "created_at"), F.col("id"))
    newest = updates.groupBy("user_id", "document_id").agg(
        F.max_by("summary_text", at).alias("new_cache")
    )
    return quiz.join(newest, ["user_id", "document_id"], "left").withColumn(
        "summary_cache", F.coalesce("new_cache", "summary_cache")
    ).drop("new_cache")


# ---- questions ---------------------------------------------------------------------


def update_question_quality(questions: DataFrame, attempts: DataFrame) -> DataFrame:
    """Replay attempts on the quality score: a miss takes 0.05 (not below 0), a hit adds 0.02 (not above 1).

    Attempts carry question_id, attempted_at, attempt_id and struggled. One step
    is x -> min(high, max(low, x + shift)); a run of steps is again such a
    triple, so runs are combined minute by minute, then day by day, then in all.
    Each list holds the attempts of one minute or the runs of one period, never
    all attempts of a popular question.
    """
    when = time_of(attempts, "attempted_at")
    missed = F.coalesce("struggled", F.lit(False))
    steps = attempts.select(
        "question_id",
        F.date_trunc("minute", when).alias("minute"),
        F.struct(when.alias("at"), "attempt_id").alias("place"),
        F.when(missed, F.lit(-0.05)).otherwise(F.lit(0.02)).alias("shift"),
        F.when(missed, F.lit(0.0)).otherwise(F.lit(float("-inf"))).alias("low"),
        F.when(missed, F.lit(float("inf"))).otherwise(F.lit(1.0)).alias("high"),
        missed.cast("long").alias("misses"),
        when.alias("last_used_at"),
    )
    minutes = _combine_runs(steps, ["question_id", "minute"]).withColumn("place", F.struct("minute"))
    days = _combine_runs(
        minutes.withColumn("day", F.to_date("minute")), ["question_id", "day"]
    ).withColumn("place", F.struct("day"))
    runs = _combine_runs(days, ["question_id"])
    joined = questions.join(runs, questions["id"] == runs["question_id"], "left")
    replayed = F.least(F.col("high"), F.greatest(F.col("low"), F.col("quality_score") + F.col("shift")))
    changed = {
        "quality_score": round_half_up(F.coalesce(replayed, "quality_score"), 6),
        "struggle_count": F.col("struggle_count") + F.coalesce("misses", F.lit(0)),
        "last_used_at": F.coalesce(runs["last_used_at"].cast("string"), questions["last_used_at"]),
    }
    return joined.select(*[changed.get(c, questions[c]).alias(c) for c in questions.columns])


def _combine_runs(steps: DataFrame, keys: list) -> DataFrame:
    run = F.struct("place", "shift", "low", "high")

    def after(first, then):
        def through(x):
            return F.least(then["high"], F.greatest(then["low"], x + then["shift"]))

        return F.struct(
            (first["shift"] + then["shift"]).alias("shift"),
            through(first["low"]).alias("low"),
            through(first["high"]).alias("high"),
        )

    nothing = F.struct(
        F.lit(0.0).alias("shift"), F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high")
    )
    return (
        steps.groupBy(*keys)
        .agg(
            F.aggregate(F.array_sort(F.collect_list(run)), nothing, after).alias("run"),
            F.sum("misses").alias("misses"),
            F.max("last_used_at").alias("last_used_at"),
        )
        .select(*keys, "run.*", "misses", "last_used_at")
    )


def cached_questions(questions: DataFrame, limit: int, by: str = "document_id") -> DataFrame:
    """Best `limit` questions per document (or topic) and difficulty, then only those with two options.

    The limit comes before the option test, so a key can yield fewer.
    """
    options = F.from_json("options_json", "array<string>")
    best = ranked(
        questions, [by, "difficulty_level"],
        [F.desc("quality_score"), F.desc("created_at"), F.asc("id")], limit,
    )
    return best.withColumn("options", options).where(F.size("options") >= 2).withColumnsRenamed(
        {"question_text": "question", "answer_text": "answer", "question_type": "type"}
    )


# ---- schema evolution and appends --------------------------------------------------


def add_missing_columns(frame: DataFrame, name: str) -> DataFrame:
    """Bring an old copy of a table to its present columns with their defaults."""
    types = {f.name: f.dataType for f in schemas.OPERATIONAL[name]}
    missing = {
        column: F.lit(default).cast(types[column])
        for column, default in schemas.ADDED_COLUMNS.get(name, {}).items()
        if column not in frame.columns
    }
    return frame.withColumns(missing) if missing else frame


def unique_in_order(values: Column) -> Column:
    """Array without repeats, first occurrences in place."""
    return F.array_distinct(values)


def event_rows(activities: DataFrame) -> DataFrame:
    """Activities as rows of the events table.

    No user, an empty one and `guest` become NULL; the activity type defaults to
    the event type; metadata and topics are stored as JSON text.
    """
    def given(name, default, kind):
        value = F.col(name) if name in activities.columns else F.lit(None)
        return F.coalesce(value.cast(kind), F.lit(default).cast(kind))

    def as_json(name, empty):
        if name not in activities.columns:
            return F.lit(empty)
        if isinstance(activities.schema[name].dataType, T.StringType):
            return F.coalesce(F.col(name), F.lit(empty))
        return F.coalesce(F.to_json(name), F.lit(empty))

    user = F.col("user_id").cast("string")
    return activities.select(
        F.when(~user.isin("", "guest"), user).cast("long").alias("user_id"),
        given("activity_type", None, "string").alias("given_type"),
        given("resource_id", None, "string").alias("resource_id"),
        as_json("metadata", "{}").alias("metadata_json"),
        given("duration_seconds", 0, "long").alias("duration_seconds"),
        given("engagement_score", 0, "double").alias("engagement_score"),
        as_json("topics", "[]").alias("topics_json"),
        given("skill_level", None, "string").alias("skill_level"),
        given("completion_percentage", 0, "double").alias("completion_percentage"),
        given("session_id", None, "string").alias("session_id"),
        "event_type",
        as_json("event_data", "{}").alias("event_data"),
        "created_at",
    ).withColumn(
        "activity_type", F.coalesce(F.nullif("given_type", F.lit("")), "event_type")
    ).drop("given_type")


def touched_sessions(sessions: DataFrame, messages: DataFrame) -> DataFrame:
    """Sessions with `updated_at` moved to their newest message."""
    newest = messages.groupBy(F.col("session_id").alias("id")).agg(F.max("created_at").alias("newest"))
    return sessions.join(newest, "id", "left").withColumn(
        "updated_at", F.greatest("updated_at", "newest")
    ).drop("newest").select(*sessions.columns)


def message_rows(messages: DataFrame) -> DataFrame:
    """New chat messages in table form: trimmed role, metadata as JSON text."""
    meta = F.coalesce(F.to_json("retrieval_metadata"), F.lit("{}"))
    return messages.withColumns({"role": text.strip(F.col("role")), "retrieval_metadata": meta})


def session_rows(sessions: DataFrame) -> DataFrame:
    """New chat sessions: trimmed title and topic, updated when created."""
    return sessions.withColumns({
        "title": text.strip(F.col("title")), "topic": text.strip(F.col("topic")),
        "updated_at": F.col("created_at"),
    })


def study_session_rows(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        F.col("user_id").cast("long"), F.col("document_id").cast("long"),
        text.strip(F.col("subject")).alias("subject"), text.strip(F.col("topic")).alias("topic"),
        F.col("time_spent").cast("long"),
        F.coalesce(F.col("engagement_score").cast("double"), F.lit(0.0)).alias("engagement_score"),
        F.coalesce(F.col("completion_percentage").cast("double"), F.lit(0.0)).alias("completion_percentage"),
        "created_at",
    )


def quiz_result_rows(results: DataFrame) -> DataFrame:
    """Quiz results in table form, with the percentage computed from score and total."""
    return results.select(
        F.col("user_id").cast("long"), F.col("document_id").cast("long"),
        text.strip(F.col("subject")).alias("subject"), text.strip(F.col("topic")).alias("topic"),
        F.col("score").cast("double"), F.col("total_questions").cast("long"),
        score_percent(F.col("score"), F.col("total_questions")).alias("score_percent"),
        "difficulty_level",
        F.coalesce(F.to_json("question_types"), F.lit("[]")).alias("question_types"),
        "created_at",
    )


def with_ids(rows: DataFrame, first_free: int) -> DataFrame:
    """Give new rows unique ids above `first_free`; unique across tasks, not consecutive."""
    return rows.withColumn("id", F.lit(first_free) + F.monotonically_increasing_id())


def report_event(report: DataFrame) -> DataFrame:
    """A run report as one row of the events table."""
    return event_rows(report.select(
        F.lit(None).cast("string").alias("user_id"), F.lit("pipeline_report").alias("event_type"),
        F.lit("pipeline").alias("activity_type"), F.col("report_name").alias("resource_id"),
        F.to_json(F.struct(*report.columns)).alias("event_data"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("created_at"),
    ))

