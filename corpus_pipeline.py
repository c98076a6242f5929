"""Corpus pipeline: training-data operators applied one after the other.

Each stage takes the documents its predecessor kept and returns what the next
one gets.  All stages but the last return the columns of the documents; a
document that a stage keeps keeps its values, but for the texts that the
secret scan redacts (``n_chars`` follows the text).

    quality_rules     documents that the weakly supervised rules find bad go
    language_id       documents without a recognisable language go
    near_duplicates   one document of each near-duplicate group stays: that of
                      the least id
    secret_scan       secrets are replaced by their kind
    packing           the rest is packed into sequences (one row per piece)

NULL ids: near_duplicates takes such rows for the last of their group, so one
stays only where no row of the group has an id.  Empty tables give empty
results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import bpe, langid_crf, ngram_join, packing, secret_markov, weak_rules
from lakemart.llm.common import fold, free_name, read_table, staged

# Least mean probability of a text's language over its words.  A text half in
# one and half in another language is kept; one that no language explains goes.
LANGUAGE_SCORE_MIN = 0.4
VOCABULARY = "byte_bpe_50k.json"
# Rows without an id take one from their text, above all real ids (below 2**62).
NO_ID = 1 << 62


def _added(after: DataFrame, before: DataFrame) -> str:
    """The one column that an operator added."""
    return next(c for c in after.columns if c not in before.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = weak_rules.judge(docs, model=weak_rules.train(docs))
    return judged.filter(judged[_added(judged, docs)]["kept"]).select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid_crf.train(docs, fold(F.col("doc_id"), 4) != 2)
    found = langid_crf.identify(docs, model)
    verdict = found[_added(found, docs)]
    return found.filter((verdict["lang_pred"] != langid_crf.UNKNOWN) & (verdict["score"] >= LANGUAGE_SCORE_MIN)).select(
        *docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key = free_name(docs, "_key")
    keyed = docs.withColumn(key, F.coalesce("doc_id", F.expr(f"shiftrightunsigned(xxhash64(text), 2) + {NO_ID}L")))
    groups = ngram_join.near_duplicates(keyed, id_col=key)
    kept = groups.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(key)).distinct()
    # The id is all that decides, so equal rows are told apart last.
    return keyed.join(kept, key, "left_semi").dropDuplicates([key, "text"]).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secret_markov.redact(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, bpe.tokenizer_from_file(public_tokenizers.path(VOCABULARY)))


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("packing", packed),
]

# No SQL: expectation-maximisation, the field's training and tokenisation are
# beyond it; tests/llm holds every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
