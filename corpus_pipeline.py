"""Training-corpus pipeline over ``documents``: toxicity, near-duplicates, repeated passages, packing.

Every stage takes the rows its predecessor kept; all but the last return the
columns of ``documents`` (whatever columns came in, in their order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playgraph.llm.minhash_dups import near_documents
from playgraph.llm.packing_tiers import pack_tiers
from playgraph.llm.shared import stored
from playgraph.llm.suffix_dups import cut_text, with_spans
from playgraph.llm.toxicity import toxicity_score, train_toxicity

TOXIC_FROM = 0.3
FEW_IDS = 1_000_000


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity threshold; null and empty texts get the base score and stay."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    fm = train_toxicity(docs, labels)
    return docs.where(toxicity_score(fm, F.col("text")) < TOXIC_FROM)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each near-duplicate group (five-word shingles, 0.8), and all documents of none.

    Rows with a null id stay.  Rows sharing an id are told apart by their texts;
    of rows equal in id and text one stays, the first by its other columns.
    """
    near = stored(near_documents(docs, shingle_words=5, percent=80, by_text=True), "pipeline-near")
    out = stored(near.where("not kept").select("doc_id", "text_hash").distinct(), "pipeline-out")
    again = near.where("doc_id is not null").groupBy("doc_id", "text_hash").count().where("count > 1").select("doc_id", "text_hash")
    again = stored(again, "pipeline-again")

    def few(ids: DataFrame) -> DataFrame:
        return F.broadcast(ids) if ids.count() <= FEW_IDS else ids

    keys = ["doc_id", "__text_hash"]
    out, again = (t.withColumnRenamed("text_hash", "__text_hash") for t in (out, again))
    kept = docs.withColumn("__text_hash", F.xxhash64(F.col("text").cast("string"))).join(few(out), keys, "left_anti")
    if again.isEmpty():
        return kept.select(docs.columns)
    first = Window.partitionBy("doc_id", "text").orderBy(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])))
    one = kept.join(few(again), keys, "left_semi").withColumn("__first", F.row_number().over(first)).where("__first = 1")
    return kept.join(few(again), keys, "left_anti").select(docs.columns).unionByName(one.select(docs.columns))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without its 100-byte strings that occur earlier; ``n_chars`` follows the text.  Emptied documents stay."""
    cut = with_spans(docs, length=100).withColumn("text", cut_text(F.col("__text"), F.col("__spans"), 100))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return cut.select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that is left, in windows of 256 to 2048 tokens; ids as their CRC."""
    pieces = pack_tiers(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_id")


STAGES = [("toxicity", toxicity), ("minhash_dedup", minhash_dedup), ("suffix_dedup", suffix_dedup), ("packing", packing)]

#: Learned weights, near-duplicate components and tokenizer ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read back for the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
