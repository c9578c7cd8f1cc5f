"""Queries over the driver's tables: each applies its operator to a whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import exact, fingerprint, jaccard, linededup, mixing, oracles, packing, quality, tokens, toxicity, urls
from .common import table


def op1_token_counts(spark, sf_dir):
    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_jaccard_join(spark, sf_dir):
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op3_mix_sources(spark, sf_dir):
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_url_filters(spark, sf_dir):
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op6_toxicity(spark, sf_dir):
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality(spark, sf_dir):
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_exact_dedup(spark, sf_dir):
    return exact.exact_dedup(table(spark, sf_dir, "documents"))


def _lines(out):
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"), F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("kept_bytes"))


def op9_line_dedup(spark, sf_dir):
    return _lines(linededup.line_dedup(table(spark, sf_dir, "documents")))


def op9_line_dedup_whole(spark, sf_dir):
    """Short lines and passages of two documents too, which op9_line_dedup's SQL leaves out."""
    return _lines(linededup.line_dedup(table(spark, sf_dir, "documents"), whole=True))


def op10_fingerprints(spark, sf_dir):
    return fingerprint.neighbour_likeness(table(spark, sf_dir, "documents"))


_ALL = (op1_token_counts, op2_jaccard_join, op3_mix_sources, op4_best_fit_packing, op5_url_filters, op6_toxicity, op7_quality, op8_exact_dedup, op9_line_dedup, op9_line_dedup_whole, op10_fingerprints)
QUERIES = {f.__name__: f for f in _ALL}
ORACLES = {"op2_jaccard_join": oracles.JACCARD, "op8_exact_dedup": exact.ORACLE, "op9_line_dedup": oracles.LINES}
