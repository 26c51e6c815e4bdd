"""Column contracts of every table the library reads or writes.

The column names and types below are fixed values: data written by existing
producers carries exactly these names.
"""

from pyspark.sql import types as T

_S, _L, _D, _I = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()


def _struct(**columns):
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


LOG_RECORD = _struct(
    user_id=_S,
    timestamp=_S,
    topic=_S,
    action_type=_S,
    score=_D,
    quiz_id=_S,
    question_count=_I,
    question=_S,
    response_preview=_S,
    metadata=T.MapType(_S, _S),
)

# The three record layouts; each is a subset of LOG_RECORD.
_COMMON = ["user_id", "timestamp", "topic", "action_type", "score"]
LOG_LAYOUTS = {
    "quiz": _COMMON + ["quiz_id", "question_count"],
    "chat": _COMMON + ["question", "response_preview"],
    "activity": _COMMON + ["metadata"],
}
LOG_FILES = {
    "quiz": "quiz_logs.json",
    "chat": "chat_logs.json",
    "activity": "user_activity.json",
}

OPERATIONAL = {
    "users": _struct(id=_L, full_name=_S, email=_S, password_hash=_S, created_at=_S),
    "documents": _struct(
        id=_L, user_id=_L, filename=_S, file_hash=_S, file_type=_S, topic=_S, language=_S,
        text_content=_S, usage_count=_L, created_at=_S, updated_at=_S,
    ),
    "summaries": _struct(
        id=_L, user_id=_L, document_id=_L, summary_hash=_S, method=_S, mode=_S,
        target_language=_S, summary_text=_S, key_insights=_S, hierarchy_json=_S, created_at=_S,
    ),
    "study_sessions": _struct(
        id=_L, user_id=_L, document_id=_L, subject=_S, topic=_S, time_spent=_L,
        engagement_score=_D, completion_percentage=_D, created_at=_S,
    ),
    "quiz_results": _struct(
        id=_L, user_id=_L, document_id=_L, subject=_S, topic=_S, score=_D, total_questions=_L,
        score_percent=_D, difficulty_level=_S, question_types=_S, question_set_json=_S,
        summary_cache=_S, created_at=_S,
    ),
    "quiz_questions": _struct(
        id=_L, document_id=_L, topic=_S, question_type=_S, difficulty_level=_S, skill_level=_S,
        question_text=_S, options_json=_S, answer_text=_S, explanation=_S, quality_score=_D,
        struggle_count=_L, created_at=_S, last_used_at=_S,
    ),
    "chat_sessions": _struct(
        id=_L, user_id=_L, document_id=_L, title=_S, topic=_S, created_at=_S, updated_at=_S,
    ),
    "chat_messages": _struct(
        id=_L, session_id=_L, user_id=_L, role=_S, message_text=_S, confidence_score=_D,
        retrieval_metadata=_S, feedback_rating=_L, created_at=_S,
    ),
    "events": _struct(
        id=_L, user_id=_L, activity_type=_S, resource_id=_S, metadata_json=_S,
        duration_seconds=_L, engagement_score=_D, topics_json=_S, skill_level=_S,
        completion_percentage=_D, session_id=_S, event_type=_S, event_data=_S, created_at=_S,
    ),
}

# Columns added to old copies of a table, with their defaults (None: NULL).
ADDED_COLUMNS = {
    "events": {
        "activity_type": None, "resource_id": None, "metadata_json": None,
        "duration_seconds": 0, "engagement_score": 0.0, "topics_json": None,
        "skill_level": None, "completion_percentage": 0.0, "session_id": None,
        "event_type": None, "event_data": None,
    },
    "quiz_results": {
        "document_id": None, "score_percent": 0.0, "difficulty_level": None,
        "question_types": None, "question_set_json": None, "summary_cache": None,
    },
    "study_sessions": {"document_id": None, "engagement_score": 0.0, "completion_percentage": 0.0},
}

# What each listing shows, newest id first.
LISTING_COLUMNS = {
    "users": ["id", "full_name", "email", "created_at"],
    "documents": [
        "id", "user_id", "filename", "file_type", "topic", "language", "usage_count",
        "created_at", "updated_at",
    ],
    "study_sessions": [
        "id", "user_id", "document_id", "subject", "topic", "time_spent", "engagement_score",
        "completion_percentage", "created_at",
    ],
    "quiz_results": [
        "id", "user_id", "document_id", "subject", "topic", "score", "total_questions",
        "score_percent", "difficulty_level", "question_types", "created_at",
    ],
    "summaries": [
        "id", "user_id", "document_id", "method", "mode", "target_language", "created_at",
    ],
    "quiz_questions": [
        "id", "document_id", "topic", "question_type", "difficulty_level", "skill_level",
        "quality_score", "struggle_count", "created_at", "last_used_at",
    ],
    "events": [
        "id", "user_id", "activity_type", "resource_id", "metadata_json", "duration_seconds",
        "engagement_score", "topics_json", "skill_level", "completion_percentage", "session_id",
        "event_type", "event_data", "created_at",
    ],
}

SILVER_EVENT = _struct(
    user_id=_S, event_timestamp=T.TimestampType(), topic=_S, action_type=_S, event_type=_S,
    score=_D, resource_id=_S, document_id=_S, duration_seconds=_L, engagement_score=_D,
)
SILVER_DOCUMENT = _struct(
    document_id=_S, user_id=_S, filename=_S, file_type=_S, topic=_S, language=_S,
    usage_count=_L, content_characters=_I, content_words=_I,
    created_ts=T.TimestampType(), updated_ts=T.TimestampType(),
)

GOLD = {
    "topic_metrics": _struct(
        topic=_S, avg_score=_D, attempts=_L, events=_L, unique_users=_L, difficulty_score=_D,
    ),
    "user_engagement": _struct(
        user_id=_S, total_events=_L, avg_score=_D, avg_engagement=_D, total_duration_seconds=_L,
        topics_covered=_L, engagement_band=_S,
    ),
    "daily_activity": _struct(
        event_date=T.DateType(), events=_L, active_users=_L, avg_score=_D, topics_touched=_L,
    ),
    "hourly_activity": _struct(event_hour=_S, event_type=_S, events=_L, active_users=_L),
    "document_usage": _struct(topic=_S, documents=_L, total_usage=_L, avg_words=_D),
    "recommendation_features": _struct(
        user_id=_S, topic=_S, interaction_count=_L, avg_score=_D, time_spent_seconds=_L,
        recommend_revision=_I, skill_band=_S,
    ),
    "student_clusters": _struct(
        user_id=_S, topic=_S, interaction_count=_L, avg_score=_D, time_spent_seconds=_L,
        recommend_revision=_I, skill_band=_S, cluster_id=_I,
    ),
    "performance_predictions": _struct(
        user_id=_S, topic=_S, interaction_count=_L, avg_score=_D, time_spent_seconds=_L,
        recommend_revision=_I, skill_band=_S, predicted_score=_D,
    ),
    "learning_recommendations": _struct(
        topic=_S, avg_score=_D, attempts=_L, difficulty_score=_D, recommendation=_S,
    ),
}
