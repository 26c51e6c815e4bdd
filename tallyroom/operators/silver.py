"""Silver: every source brought to one event contract, and the document contract."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas
from ..functions.clocks import hour_label, time_of
from ..functions import text


def _as_event(frame: DataFrame, time_column: str, **columns: Column) -> DataFrame:
    """Project a source onto SILVER_EVENT; columns that are not given get their default."""
    defaults = {
        "score": F.lit(None),
        "resource_id": F.lit(None),
        "document_id": F.lit(None),
        "duration_seconds": F.lit(0),
        "engagement_score": F.lit(0.0),
    }
    values = {"event_timestamp": time_of(frame, time_column), **defaults, **columns}
    return frame.select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in schemas.SILVER_EVENT]
    )


def log_events(records: DataFrame, source: str, use_metadata: bool = False) -> DataFrame:
    """Log records as events, tagged by source.

    `use_metadata` takes duration and engagement from the metadata map instead of
    the fixed zeros.
    """
    extra = {}
    if use_metadata:
        for name, kind in (("duration_seconds", "long"), ("engagement_score", "double")):
            extra[name] = F.coalesce(F.col("metadata")[name].try_cast(kind), F.lit(0).cast(kind))
    return _as_event(
        records, "timestamp", user_id=F.col("user_id"), topic=F.col("topic"),
        action_type=F.col("action_type"), event_type=F.lit(source), score=F.col("score"),
        resource_id=F.col("quiz_id"), **extra,
    )


def table_events(events: DataFrame) -> DataFrame:
    """Operational events; the topic is the first element of `topics_json`."""
    first_topic = F.get_json_object("topics_json", "$[0]")
    return _as_event(
        events, "created_at", user_id=F.col("user_id"),
        topic=F.coalesce(first_topic, F.lit("general")), action_type=F.col("activity_type"),
        event_type=F.col("event_type"), resource_id=F.col("resource_id"),
        duration_seconds=F.coalesce("duration_seconds", F.lit(0)),
        engagement_score=F.coalesce("engagement_score", F.lit(0.0)),
    )


def study_events(sessions: DataFrame) -> DataFrame:
    """Study sessions; minutes become seconds."""
    kind = F.lit("study_session")
    return _as_event(
        sessions, "created_at", user_id=F.col("user_id"), topic=F.col("topic"), action_type=kind,
        event_type=kind, resource_id=F.col("id"), document_id=F.col("document_id"),
        duration_seconds=F.col("time_spent") * 60,
        engagement_score=F.coalesce("engagement_score", F.lit(0.0)),
    )


def quiz_events(results: DataFrame) -> DataFrame:
    """Quiz results, scored in percent."""
    kind = F.lit("quiz_result")
    return _as_event(
        results, "created_at", user_id=F.col("user_id"), topic=F.col("topic"), action_type=kind,
        event_type=kind, score=F.col("score_percent"), resource_id=F.col("id"),
        document_id=F.col("document_id"),
    )


def messages_with_session(messages: DataFrame, sessions: DataFrame) -> DataFrame:
    """Each message with its session's topic and document; messages without a session stay.

    No broadcast hint: Spark broadcasts the session side only below its size
    threshold, and beyond it splits skewed sessions of the sort-merge join.
    """
    lookup = sessions.select(
        F.col("id").alias("session_id"),
        F.col("topic").alias("session_topic"),
        F.col("document_id").alias("session_document_id"),
    )
    return messages.join(lookup, "session_id", "left")


def chat_events(messages: DataFrame, sessions: DataFrame) -> DataFrame:
    """Chat messages, scored by the answer's confidence."""
    kind = F.lit("chat_message")
    return _as_event(
        messages_with_session(messages, sessions), "created_at", user_id=F.col("user_id"),
        topic=F.coalesce("session_topic", F.lit("general")), action_type=kind, event_type=kind,
        score=F.col("confidence_score"), resource_id=F.col("id"),
        document_id=F.col("session_document_id"),
    )


def silver_events(logs: dict, tables: dict, use_metadata: bool = False) -> DataFrame:
    """All eight sources as one bag of events."""
    parts = [
        log_events(logs["quiz"], "quiz_log", use_metadata),
        log_events(logs["chat"], "chat_log", use_metadata),
        log_events(logs["activity"], "activity_log", use_metadata),
        log_events(logs["event_lake"], "event_lake", use_metadata),
        table_events(tables["events"]),
        study_events(tables["study_sessions"]),
        quiz_events(tables["quiz_results"]),
        chat_events(tables["chat_messages"], tables["chat_sessions"]),
    ]
    return reduce(DataFrame.unionByName, parts)


def silver_documents(documents: DataFrame) -> DataFrame:
    """Document facts without the text: sizes in characters and words.

    Words are counted after removing spaces (only) at the ends, so an empty text
    counts one word and a NULL text none at all.
    """
    spaced = F.split(F.trim("text_content"), r"\s+")
    values = {
        "document_id": F.col("id"),
        "content_characters": F.length("text_content"),
        "content_words": F.when(F.col("text_content").isNotNull(), F.size(spaced)),
        "created_ts": time_of(documents, "created_at"),
        "updated_ts": time_of(documents, "updated_at"),
    }
    return documents.select(
        *[
            values.get(f.name, F.col(f.name) if f.name in documents.columns else F.lit(None))
            .cast(f.dataType).alias(f.name)
            for f in schemas.SILVER_DOCUMENT
        ]
    )


def with_calendar(events: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """Add `event_date` and the hour label `event_hour`."""
    return events.withColumns(
        {"event_date": F.to_date(F.col(ts)), "event_hour": hour_label(F.col(ts))}
    )


def complete_events(events: DataFrame, required: list) -> DataFrame:
    """Rows in which none of the required columns is NULL."""
    return events.dropna(subset=required)


def rows_of_user(frame: DataFrame, user_id) -> DataFrame:
    return frame.where(F.col("user_id") == F.lit(user_id))


def dedup_events(events: DataFrame) -> DataFrame:
    """One row per real action: the same action reaches the log, the lake and the table."""
    return events.dropDuplicates(["user_id", "event_timestamp", "topic", "action_type", "score"])


# ---- record builders: application actions to log records -----------------------


def base_record(user_id: Column, timestamp: Column, topic: Column, action_type: Column,
                score: Column | None = None) -> dict:
    """The five columns every log record has; a blank topic becomes `general`."""
    topic = text.strip(topic)
    return {
        "user_id": user_id.cast("string"),
        "timestamp": timestamp,
        "topic": F.coalesce(F.nullif(topic, F.lit("")), F.lit("general")),
        "action_type": text.strip(action_type),
        "score": (F.lit(None) if score is None else score).cast("double"),
    }


def quiz_record(user_id, timestamp, topic, score, question_count, quiz_id) -> dict:
    return {
        **base_record(user_id, timestamp, topic, F.lit("quiz_attempt"), score),
        "quiz_id": quiz_id.cast("string"),
        "question_count": question_count.cast("int"),
    }


def chat_record(user_id, timestamp, topic, question, response) -> dict:
    """A chat turn; the answer is kept as a 300-character preview."""
    return {
        **base_record(user_id, timestamp, topic, F.lit("chat_message")),
        "question": text.strip(question),
        "response_preview": F.substring(response, 1, 300),
    }


def activity_record(user_id, timestamp, topic, action_type, metadata, score=None) -> dict:
    empty = F.create_map().cast("map<string,string>")
    return {
        **base_record(user_id, timestamp, topic, action_type, score),
        "metadata": F.coalesce(metadata, empty),
    }


def records(frame: DataFrame, columns: dict) -> DataFrame:
    """Project a frame onto the record columns of one of the builders."""
    return frame.select(*[value.alias(name) for name, value in columns.items()])
