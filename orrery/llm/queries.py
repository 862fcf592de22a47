"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from .html_text import extract_main_text
from .interpolation import DELETED, HELD_OUT, TRAIN, DeletedInterpolation
from .kneser_ney import train
from .line_dedup import LineDuplicates
from .near_dup import NearDuplicates
from .packing import pack_documents
from .pieces import decode, encode_sampled
from .quality import bands, judged, measured
from .repeats import RepeatedStrings
from .secrets import joined, scan_secrets
from .tables import written
from .token_align import TokenAlignment
from .topk import top_inner_products
from .vector_dedup import VectorDuplicates
from .whitening import Whitening


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, main text and its length of every page."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and spans of the secrets in every document."""
    found = scan_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda x: x["kind"] != "net")
    count = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in packed sequences."""
    return pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the quality rules for every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    scored = written(measured(docs, train(docs)).drop("text"), "quality")
    return judged(scored, bands(scored)).select("doc_id", "quality.n_words", "quality.word_chars", "quality.n_symbols", "quality.n_dup_lines",
                                                "quality.n_repeat_words", "base_failed", "kept", "quality.bits")


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates (its least doc_id) of every document."""
    return NearDuplicates(read(spark, sf_dir, "documents")).documents()


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of lines of every document, how many go as duplicates, and the digest of what is left."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1
    return LineDuplicates(docs).apply(docs, "left", "n_removed").select(
        "doc_id", n_lines.cast("long").alias("n_lines"), "n_removed", F.sha2("left", 256).alias("kept_sha256"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document under the model learned from those whose fold is not 2; fold 3 is the deleted block."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7
    role = F.when(fold == 2, HELD_OUT).when(fold == 3, DELETED).otherwise(TRAIN)
    model = DeletedInterpolation(read(spark, sf_dir, "documents"), role)
    return model.documents.select("doc_id", (F.col("role") == HELD_OUT).alias("held_out"), "n_tokens", "n_known",
                                  F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampled segmentation of every document: number and digest of its pieces, and whether they decode to the text."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("p", encode_sampled(F.col("text"), F.xxhash64("doc_id"), path)).withColumn("back", decode(F.col("p.ids"), path))
    return docs.select("doc_id", "p.n_pieces", F.crc32("p.ids").alias("ids_crc32"), (F.col("back") == F.col("text")).alias("lossless"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best candidates of every vector whose id is divisible by 20."""
    return top_inner_products(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeated strings of 400 bytes cover, and the digest and text of the others."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return RepeatedStrings(docs).apply(docs).select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                                                    "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
                                                    F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight whitened components of every vector."""
    return Whitening(read(spark, sf_dir, "embeddings")).whitened()


def op12_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and verdict of every vector at a cosine of 0.9."""
    return VectorDuplicates(read(spark, sf_dir, "embeddings")).documents()


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of every document's tokens under two tokenizers, with the links' counts in the corpus."""
    return TokenAlignment(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                          public_tokenizers.path("piece_bpe_32k.model")).documents()


QUERIES = {
    "op1_html_text": op1_html_text,
    "op2_secrets": op2_secrets,
    "op3_packing": op3_packing,
    "op4_quality": op4_quality,
    "op5_near_dup": op5_near_dup,
    "op6_line_dedup": op6_line_dedup,
    "op7_lm_score": op7_lm_score,
    "op8_pieces": op8_pieces,
    "op9_topk": op9_topk,
    "op10_repeats": op10_repeats,
    "op11_whitening": op11_whitening,
    "op12_vector_dedup": op12_vector_dedup,
    "op13_token_align": op13_token_align,
    "pipeline": corpus_pipeline.run,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op9_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
        FROM s QUALIFY rank <= 20""",
    "op12_vector_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e, rowid AS r FROM (SELECT *, row_number() OVER () AS rowid FROM embeddings)),
        ok AS (
            SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(e, lambda x: x <> 0)) > 0),
        links AS (
            SELECT a.r AS a, b.r AS b FROM ok a JOIN ok b ON a.r <> b.r AND list_cosine_similarity(a.e, b.e) >= 0.9),
        reach(a, b) AS (SELECT r, r FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
        least AS (SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY reach.a),
        degree AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
        SELECT v.vec_id, coalesce(degree.n, 0)::BIGINT AS n_links, component_id, v.vec_id IS NOT DISTINCT FROM component_id AS kept
        FROM v JOIN least USING (r) LEFT JOIN degree USING (r)""",
}
