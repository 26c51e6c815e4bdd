"""The registered queries of these operators, with production parameters, over whole tables."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import alignment, bpe, cleaning, extraction, graphs, language, manifest, packing, quality, secrets, simhash, surrogates, urls
from .parts import ByteLevel
from .shared import fold, stored, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PACKING_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Stands in for a key that a deployment keeps secret; equal keys give equal surrogates.
SURROGATE_KEY = b"a deployment sets its own key"
#: What counts as an identifier when the Markov models are trained.
IDENTIFIER = r"(?<![A-Za-z0-9+/_=-])[A-Za-z][A-Za-z_-]{11,}"


LINE_CLEANING_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM docs WHERE len(words) >= 5),
keyed AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS w FROM windows),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM keyed) WHERE n > 1),
covered AS (
  SELECT doc_id, sum(least(5, coalesce(next - i, 5))) AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM twice) GROUP BY doc_id),
counted AS (
  SELECT d.doc_id, len(words) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(list_filter(lines, lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))
           - len(list_distinct(list_filter(lines, lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words,
         coalesce(list_sum(list_transform(list_filter(lines, lambda l:
           len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) = 0 OR (
             (len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) >= 6
              OR regexp_matches(l, '[.!?:;,\x{2026}\x{3002}\x{FF01}\x{FF1F}]["'')\]\x{201D}\x{2019}\x{00BB}]*[\x20\x09-\x0D]*$'))
             AND length(regexp_replace(l, '[^#*$%&|<>]', '', 'g')) <= 0.1 * length(l)
             AND len(regexp_extract_all(l, '(?:^|[\x20\x09-\x0D])(?:[|>/\x{00BB}\x{203A}\x{2022}\x{00B7}]|>>)(?:[\x20\x09-\x0D]|$)'))
                 <= 0.2 * len(regexp_extract_all(l, '[^\x20\x09-\x0D]+'))
             AND NOT regexp_matches(l, '(?i)(all rights reserved|cookie policy|privacy policy|terms of (use|service)|accept (all )?cookies|enable javascript|subscribe to our newsletter|sign in to continue|skip to (main )?content|lorem ipsum)'))),
           lambda l: length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g')))), 0) AS left_chars
  FROM docs d LEFT JOIN covered c USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND (word_chars = 0 OR 1.0::DOUBLE - left_chars::DOUBLE / word_chars::DOUBLE <= 0.5) AS kept
FROM counted
"""


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def quality_model(documents: DataFrame, labels: DataFrame) -> quality.RuleEnsemble:
    """Fitted on labelled documents outside the held-out fold."""
    return quality.fit(documents, labels.where(fold("doc_id", 5) != 0))


@query("op1_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = quality.scored(documents.select("doc_id", "text"), quality_model(documents, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def language_model(documents: DataFrame) -> language.LanguageModel:
    """Fitted on the documents outside the held-out fold."""
    return language.fit(documents.where(fold("doc_id", 3) != 1))


@query("op3_line_cleaning", LINE_CLEANING_SQL)
def line_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = cleaning.cleaned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def secret_samples(documents: DataFrame, most: int = 2_000) -> DataFrame:
    """Labelled tokens (token, secret), at most `most` of each origin: of each bucket of a hash the least by another hash.

    Secrets: values that the fixed patterns find, and random bytes written in base64.
    Identifiers: words of the corpus of 12 or more characters that touch no span of the fixed patterns.
    """
    spark = documents.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    spans = secrets.base_spans(text)
    found = documents.select(text.alias("whole"), F.concat(spans["hex"], spans["access"]).alias("s")).where(F.size("s") > 0)
    values = found.select("whole", F.explode("s").alias("s")).select(
        F.substring("whole", F.col("s.start") + 1, F.col("s.end") - F.col("s.start")).alias("token"))
    made = spark.range(most).select(F.base64(F.unhex(F.sha2(F.col("id").cast("string"), 256))).alias("token"))
    words = documents.select(text.alias("whole"), F.concat(*spans.values()).alias("base")).select(
        F.explode(secrets.words_outside(F.col("whole"), IDENTIFIER, F.col("base"))).alias("token"))
    # One token of each hash bucket: a bounded sample without a sort, combined on the map side. The second hash makes
    # every distinct token of a bucket equally likely, however many there are.
    kept = F.min(F.struct(F.xxhash64(F.lit("pick"), "token"), "token"))["token"]
    parts = [f.groupBy(F.pmod(F.xxhash64("token"), F.lit(most))).agg(kept.alias("token")).select(
        "token", F.lit(label).alias("secret")) for f, label in [(values, True), (made, True), (words, False)]]
    return parts[0].union(parts[1]).union(parts[2])


def secret_model(documents: DataFrame, most: int = 2_000) -> secrets.MarkovPair:
    """Trained on `secret_samples`."""
    return secrets.train(stored(secret_samples(documents, most)))


@query("op4_markov_secrets")
def markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.marked(documents, secret_model(documents))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"),
                        secrets.span_text(F.col("found")).alias("spans"))


@query("op5_language_codes")
def language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    judged = language.identified(documents.select("doc_id", "text"), language_model(documents))
    return judged.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op2_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), BPE_RANKS, public_tokenizers.PATTERN)


@query("op6_url_cascade", urls.JUDGED_SQL)
def url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"))


@query("op7_nnls_packing")
def nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def pack(documents: DataFrame) -> DataFrame:
    path = PACKING_VOCABULARY
    return packing.packed(documents, lambda: ByteLevel(path, public_tokenizers.PATTERN, added=True), f"packing:{path}")


@query("op8_graph_neighbours")
def graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return graphs.search(graphs.build_index(vectors), vectors.where("vec_id % 50 = 0"))


@query("op9_surrogates")
def pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.with_surrogates(documents, SURROGATE_KEY)


@query("op10_simhash_groups")
def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.grouped(table(spark, sf_dir, "documents"))


@query("op11_token_alignment")
def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.aligned(documents, PACKING_VOCABULARY, PIECES, public_tokenizers.PATTERN)


MANIFEST_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@query("op12_merkle_manifest")
def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return manifest.manifest(documents, MANIFEST_FIELDS, changed={"text": F.replace("text", F.lit("\n"), F.lit(""))}, where=tampered)


@query("op13_host_consensus")
def host_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extraction.extracted(pages).select("page_id", "url", "text", "n_chars")
