"""Registered queries of the training-data operators: ``opN_*`` and their DuckDB texts where SQL can say it."""

from __future__ import annotations

import public_tokenizers

from appraise.llm import bpe, centroids, decontaminate, langid, license, linededup, neardup, ppm, prefixtrie, quality, repeats, tokencount, urlfilter
from appraise.llm.tables import table, training

QUERIES, ORACLES = {}, {}
VOCABULARY, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def _query(key: str, sql: str | None = None):
    def put(fn):
        QUERIES[key] = fn
        if sql:
            ORACLES[key] = sql
        return fn
    return put


@_query("op1_decontamination", decontaminate.ORACLE)
def op1(spark, sf_dir):
    """Every document against every benchmark item, windows of ten words."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op3_near_duplicates", neardup.ORACLE)
def op3(spark, sf_dir):
    """Every document: its component of texts with 5-word-shingle similarity of 0.75 or more."""
    return neardup.groups(table(spark, sf_dir, "documents"))


@_query("op6_quality_rules")
def op6(spark, sf_dir):
    """Every document by the fixed counts and the line field, fitted on the labelled documents."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, model)


@_query("op8_language_id")
def op8(spark, sf_dir):
    """Every document's language, learned from the training folds."""
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


@_query("op9_lm_scoring")
def op9(spark, sf_dir):
    """Every document by the byte model and the token counts of the training folds."""
    docs = table(spark, sf_dir, "documents")
    return ppm.score(docs, docs.where(training("doc_id", ppm.FOLD)))


@_query("op10_url_filter", urlfilter.ORACLE)
def op10(spark, sf_dir):
    """Every page's URL against the listed rules."""
    rules = spark.createDataFrame(urlfilter.RULES, "host string, path string, verdict string")
    return urlfilter.judge(table(spark, sf_dir, "pages"), rules)


@_query("op2_token_counts")
def op2(spark, sf_dir):
    """Every document's tokens, counted by a scan of the token files written from all documents."""
    return tokencount.document_counts(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN, end=50256)


@_query("op4_license_scan")
def op4(spark, sf_dir):
    """Every document against the license templates."""
    return license.scan(table(spark, sf_dir, "documents"))


@_query("op5_line_dedup", linededup.ORACLE)
def op5(spark, sf_dir):
    """Every document's lines against all other lines."""
    return linededup.report(table(spark, sf_dir, "documents"))


@_query("op7_bpe")
def op7(spark, sf_dir):
    """Every document encoded and decoded with the lexicon of all documents."""
    return bpe.digests(table(spark, sf_dir, "documents"), VOCABULARY)


@_query("op11_centroids", centroids.ORACLE)
def op11(spark, sf_dir):
    """Every embedding of 64 finite components: its cluster after ten rounds."""
    return centroids.report(table(spark, sf_dir, "embeddings"))


@_query("op12_prefix_trie", prefixtrie.ORACLE)
def op12(spark, sf_dir):
    """Every node of the rebuilt conversations' prefix trie with its subtree's totals."""
    return prefixtrie.trie(table(spark, sf_dir, "conversations"))


@_query("op13_repeats")
def op13(spark, sf_dir):
    """Every document without the strings of 100 bytes that start earlier in the corpus."""
    return repeats.report(table(spark, sf_dir, "documents"))
