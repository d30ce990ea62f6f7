"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .minhash_dups import near_documents
from .packed_ids import matrix_segments, write_id_matrices
from .packing_tiers import pack_tiers
from .phrase_mining import collocations
from .piece_codec import decode_pieces, encode_pieces
from .quality_lines import quality_rules
from .reshard import reshard, rewrite_affected
from .suffix_dups import cut_bytes, with_spans
from .target_resampling import resample
from .topk import exact_top_k
from .toxicity import held_out, toxicity_score, train_toxicity
from .vector_dups import near_vectors
from .url_filter import judge_urls

URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of the written id matrices: place in the document, place in the matrix, CRC of the ids."""
    pieces = matrix_segments(write_id_matrices(_table(spark, sf_dir, "documents")))
    return pieces.select(
        "doc_id",
        "start",
        F.col("length").cast("bigint").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        (F.col("matrix_id") * 64 + F.col("matrix_row")).alias("sequence_id"),
        F.col("offset").cast("bigint").alias("offset"),
        "matrix_id",
        "matrix_row",
    )


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's piece ids and the text decoded from them, as digests."""
    docs = _table(spark, sf_dir, "documents")
    out = decode_pieces(encode_pieces(docs))
    return out.select("doc_id", "n_ids", F.crc32("ids").alias("ids_crc32"), F.crc32("text").alias("decoded_crc32"), F.length("text").cast("bigint").alias("decoded_chars"), "n_differs")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allow or block verdict of every page's url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op4_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents moved from 32 shards by source to 40 of equal bytes; rows read back from the rewritten shard files."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    placed, plan = reshard(docs, F.pmod(F.crc32("source"), F.lit(32)).cast("int"), 40)
    return rewrite_affected(placed, plan).select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_vector_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding's number of links of cosine >= 0.9, its component and whether it stays."""
    return near_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate component over 2-word shingles at a similarity of 0.8."""
    return near_documents(_table(spark, sf_dir, "documents"), shingle_words=2, percent=80)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 100-byte strings that start earlier, as digests."""
    docs = with_spans(_table(spark, sf_dir, "documents").select("doc_id", "text"), length=100)
    cut = docs.select("doc_id", cut_bytes(F.col("__text"), F.col("__spans"), 100).alias("c"))
    return cut.select("doc_id", "c.n_bytes", "c.n_removed", "c.n_spans", F.sha2("c.kept", 256).alias("kept_sha256"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score and decision of every document."""
    docs = _table(spark, sf_dir, "documents")
    fm = train_toxicity(docs, _table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity_score(fm, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 256 to 2048 tokens."""
    pieces = pack_tiers(_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_id")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best integer inner products of every 50th vector."""
    return exact_top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest phrases of every language."""
    return collocations(_table(spark, sf_dir, "documents"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, drawn towards the texts of ``benchmark``."""
    rows = resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document by the base rules and the line frequency of its source."""
    return quality_rules(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_ids": op1_token_ids,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_url_filter": op3_url_filter,
    "op4_reshard": op4_reshard,
    "op5_vector_dups": op5_vector_dups,
    "op6_minhash": op6_minhash,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_packing": op9_packing,
    "op10_topk": op10_topk,
    "op11_collocations": op11_collocations,
    "op12_resampling": op12_resampling,
    "op13_quality": op13_quality,
}
