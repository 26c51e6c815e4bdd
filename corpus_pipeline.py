"""From raw documents to packed training sequences: each stage is one operator of `tallyroom.llm`."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyroom.llm import language, quality, queries, secrets, simhash
from tallyroom.llm.shared import stored, table


def _columns(frame: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in frame.columns]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble gives less than 0.3 go."""
    model = queries.quality_model(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model, name="__score").where("__score >= 0.3").select(*_columns(docs))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or between two languages, go."""
    judged = language.identified(docs, queries.language_model(docs), prefix="__")
    return judged.where(f"__lang_pred <> '{language.UNKNOWN}' and not __ambiguous").select(*_columns(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.one_of_each(docs)


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a sign; `n_chars` follows the new text."""
    safe = secrets.without_secrets(docs, queries.secret_model(docs))
    return safe.withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their sequences."""
    return queries.pack(docs)


STAGES = [
    ("quality_rules", good_quality),
    ("language_codes", known_language),
    ("simhash_groups", near_duplicates),
    ("markov_secrets", no_secrets),
    ("nnls_packing", pack),
]

#: Learned stages, SimHash and byte-pair encoding have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
