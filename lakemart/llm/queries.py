"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import heap_means, license_diagonals, resampling
from lakemart.llm.common import fold, read_table


def _public(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_weak_supervision_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakemart.llm.weak_rules import judge

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    # Only the id is kept beside the counts: texts are not staged.
    q = judge(docs, keep=["doc_id"])
    return q.select("doc_id", *[F.col(f"quality.{f}").alias(f) for f in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "good_probability")])


def op1_grid_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakemart.llm.grid_join import near_vectors

    return near_vectors(read_table(spark, sf_dir, "embeddings"))


def op2_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakemart.llm.langid_crf import identify, train

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 4) == 2
    found = identify(docs, train(docs, ~held_out), keep=["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score", "language.n_switched")


def op3_latent_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakemart.llm.quality_knn import classify, train

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = train(docs, read_table(spark, sf_dir, "labels"), ~held_out)
    return classify(docs, model, keep=["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), F.col("quality_score").alias("score"),
        F.when(F.col("quality_score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op4_simple8b_token_ids(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    from lakemart.llm import bpe, simple8b

    spec = bpe.tokenizer_from_file(vocabulary or _public("byte_bpe_50k.json"))
    return simple8b.round_trip(read_table(spark, sf_dir, "documents"), spec)


def op7_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    from lakemart.llm import bpe

    spec = bpe.tokenizer_from_ranks(vocabulary or _public("byte_bpe_multi_50k.tiktoken"))
    return bpe.round_trip_digests(read_table(spark, sf_dir, "documents"), spec)


def op9_mixture_packing(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    from lakemart.llm import bpe, packing

    spec = bpe.tokenizer_from_file(vocabulary or _public("byte_bpe_50k.json"))
    return packing.pack(read_table(spark, sf_dir, "documents"), spec)


def op5_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakemart.llm.ppm import score

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 1
    scored = score(docs, ~held_out, keep=["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakemart.llm.ngram_join import near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op10_secret_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakemart.llm.secret_markov import in_order, scan, span_list

    found = scan(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secrets.*")
    base, every = in_order("assign", "access", "hex"), in_order("assign", "access", "hex", "markov")
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(span_list(base), 256).alias("base_sha256"), span_list(every).alias("spans"))


def op11_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_diagonals.digest(license_diagonals.scan(docs))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return resampling.resample(docs, read_table(spark, sf_dir, "benchmark"))


def op13_heap_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heap_means.inertias(heap_means.cluster_vectors(read_table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_grid_order_join": op1_grid_order_join,
    "op2_crf_language": op2_crf_language,
    "op3_latent_neighbours": op3_latent_neighbours,
    "op4_simple8b_token_ids": op4_simple8b_token_ids,
    "op5_ppm_scores": op5_ppm_scores,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_byte_bpe": op7_byte_bpe,
    "op10_secret_markov": op10_secret_markov,
    "op9_mixture_packing": op9_mixture_packing,
    "op8_weak_supervision_rules": op8_weak_supervision_rules,
    "op11_license_diagonals": op11_license_diagonals,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_heap_means": op13_heap_means,
}

# SQL where it can express the operator.
ORACLE_SQL: dict[str, str] = {
    "op11_license_diagonals": license_diagonals.oracle_sql(),
    "op12_importance_resampling": resampling.oracle_sql(),
    "op13_heap_means": heap_means.oracle_sql(),
}
