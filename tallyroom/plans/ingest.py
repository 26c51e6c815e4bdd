"""Document ingest: files or rows to registered documents, chunks and upload events."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text
from ..functions.binding import rows_of
from ..operators import silver, tables


def described_uploads(uploads: DataFrame) -> DataFrame:
    """Add topic (from the name), type and language to uploads.

    Uploads: id, user_id, filename, text (`text_content`), created_at.
    """
    return uploads.withColumns({
        "topic": text.topic_from_filename(F.col("filename")),
        "file_type": text.file_suffix(F.col("filename")),
        "language": text.detect_language(F.col("text_content")),
    })


def document_chunks(documents: DataFrame, key: str, column: str, length: int = 1800,
                    overlap: int = 250) -> DataFrame:
    """One row per chunk with its 0-based number."""
    return rows_of(documents, [key], text.chunks(F.col(column), length, overlap), "chunk", "chunk_no")


def upload_records(described: DataFrame) -> DataFrame:
    """Uploads as activity log records."""
    metadata = F.create_map(
        F.lit("filename"), F.col("filename"), F.lit("language"), F.col("language"),
        F.lit("topics"), F.to_json(F.array("topic")),
    )
    return silver.records(described, silver.activity_record(
        F.col("user_id"), F.col("created_at"), F.col("topic"), F.lit("document_uploaded"), metadata,
    ))


def upload_events(described: DataFrame, document_id: Column) -> DataFrame:
    """Uploads as rows of the events table."""
    data = F.struct("filename", "language", F.array("topic").alias("topics"))
    return tables.event_rows(described.select(
        "user_id", F.lit("document_uploaded").alias("event_type"),
        F.lit("document_upload").alias("activity_type"),
        document_id.cast("string").alias("resource_id"), document_id.cast("string").alias("session_id"),
        data.alias("metadata"), data.alias("event_data"), F.array("topic").alias("topics"), "created_at",
    ))


def ingest(uploads: DataFrame) -> dict:
    """Registered documents, their chunks, log records and table events of one batch of uploads.

    Chunks are cut once per distinct text, from the upload that registered it.
    """
    described = described_uploads(uploads)
    registry = tables.document_registry(described)
    documents = tables.registry_texts(registry, described)
    known = registry.select("file_hash", F.col("id").alias("document_id"))
    hashed = described.withColumn("file_hash", tables.text_hash(F.col("text_content"))).drop("text_content")
    return {
        "documents": documents,
        "chunks": document_chunks(documents, "id", "text_content"),
        "records": upload_records(described),
        "events": upload_events(hashed.join(known, "file_hash"), F.col("document_id")),
    }
