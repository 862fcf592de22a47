"""A corpus from documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``documents``, with ``n_chars`` following the text. ``run`` writes every
stage as Parquet in the cluster's shared folder and hands the next one what it reads there.

1. quality: documents that the quality rules reject go.
2. line_dedup: of fuzzy line duplicates one occurrence stays; documents stay, even without text.
3. near_dedup: one document of each class of near duplicates stays; documents without words all stay.
4. secrets: every secret span becomes ``[SECRET]``.
5. packing: pieces of the documents with their places in sequences of at most 4096 tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm import kneser_ney
from orrery.llm import quality as rules
from orrery.llm.line_dedup import LineDuplicates
from orrery.llm.near_dup import drop_near_duplicates
from orrery.llm.packing import pack_documents
from orrery.llm.secrets import redacted, train_scanner
from orrery.llm.tables import aside, written

#: SQL can express none of the models here; the tests hold each stage against a plain version.
ORACLE_SQL = None


def _with_text(docs: DataFrame, text) -> DataFrame:
    changed = docs.withColumn("text", text)
    return changed.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else changed


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, back = aside(docs, ("text", "lang"))
    scored = written(rules.measured(rows, kneser_ney.train(rows), into="_quality"), "quality")
    return back(rules.judged(scored, rules.bands(scored, q="_quality"), q="_quality").filter("kept"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(LineDuplicates(docs).apply(docs), F.col("text")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs).select(docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(docs, redacted(F.col("text"), train_scanner(docs))).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("secrets", secrets), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
