"""The corpus pipeline: five of the training-data operators, one after another, over ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's result as
Parquet in the shared folder and hands the table read from it to the next stage. All stages but the last return
the columns of documents; n_chars follows a changed text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appraise.llm import bpe, decontaminate, linededup, neardup, quality, tables


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed counts and the line field keep; the field learns from the labels of these documents."""
    return quality.keep(docs, quality.train(docs, tables.table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that another place keeps. A document that keeps no line at all goes."""
    out = linededup.dedupe(docs).where(F.btrim("text", F.lit(" \t\n\x0b\x0c\r")) != "")
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one of least doc_id, once."""
    found = neardup.groups(docs, with_key=True)
    return tables.without(docs, found.where("not kept")).dropDuplicates(["doc_id", "text"])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with a benchmark item."""
    found = decontaminate.find_hits(docs, tables.table(spark, sf_dir, "benchmark"))
    return tables.without(docs, found.where("n_hit > 0"))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their ids and number of tokens (columns of these two names are replaced); text is what the ids decode to."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.encode(docs, path, bpe.lexicon(docs, path))
    return bpe.decode(coded, path, text="text").withColumn("n_tokens", F.size("ids").cast("long")).select(
        *[c for c in docs.columns if c not in ("ids", "n_tokens")], "ids", "n_tokens")


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("bpe", bpe_tokens)]

#: The fitted first stage cannot be said in SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = tables.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
