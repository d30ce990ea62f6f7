"""Keyed container files: many documents per file, in key order, found by the files' key ranges.

In place of a file (or folder) per account, documents lie sorted by key in
Parquet files of about ``target_bytes``, so the number of files follows the
bytes.  An index with each file's smallest and largest key tells which files a
read of some accounts needs; inside a file, row-group statistics narrow it
further.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playgraph.session import materialize
from playgraph.sources.documents import parse_payload
from playgraph.sources.ledger import read_or_empty

STORED = "account_id bigint, page int, payload string"
INDEX = "file string, first_id bigint, last_id bigint, documents bigint"
TARGET_BYTES = 128 << 20


def write_containers(docs: DataFrame, path: str, target_bytes: int = TARGET_BYTES) -> int:
    """Write (account_id, payload[, page]) documents as container files and their index; returns the number of files asked for.

    Files are cut by ranges of (account, page), so the pages of a huge account
    may take several files.  Documents without an account cannot be found and
    are left out.
    """
    page = (F.col("page") if "page" in docs.columns else F.lit(None)).cast("int").alias("page")
    # Stored once: the size, the sample for the ranges and the files all read the rendered rows.
    rows = materialize(docs.filter(F.col("account_id").isNotNull()).select("account_id", page, "payload"), "container_rows")
    size = rows.agg(F.sum(F.octet_length("payload") + F.lit(16))).first()[0] or 0
    files = max(1, -(-size // target_bytes))
    base = path.rstrip("/")
    rows.repartitionByRange(files, "account_id", "page").sortWithinPartitions("account_id", "page").write.mode("overwrite").parquet(f"{base}/data")
    stored = docs.sparkSession.read.schema(STORED).parquet(f"{base}/data")
    index = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min("account_id").alias("first_id"), F.max("account_id").alias("last_id"), F.count(F.lit(1)).alias("documents")
    )
    index.coalesce(1).write.mode("overwrite").parquet(f"{base}/index")
    return files


def container_rows(spark: SparkSession, path: str, account_ids: list[int] | None = None) -> DataFrame:
    """account_id, page, payload of all documents, or of ``account_ids`` (only files whose key range holds one are read)."""
    base = path.rstrip("/")
    if account_ids is None:
        return read_or_empty(spark, f"{base}/data", STORED)
    ids = spark.createDataFrame([(i,) for i in account_ids], "id bigint")
    index = read_or_empty(spark, f"{base}/index", INDEX)
    files = [r.file for r in index.join(F.broadcast(ids), F.col("id").between(F.col("first_id"), F.col("last_id")), "left_semi").collect()]
    if not files:
        return spark.createDataFrame([], STORED)
    return spark.read.schema(STORED).parquet(*files).filter(F.col("account_id").isin(account_ids))


def read_containers(spark: SparkSession, path: str, kind: str, account_ids: list[int] | None = None) -> DataFrame:
    """account_id, page + the document's top-level fields, as ``read_documents`` gives them; a missing folder is empty."""
    return parse_payload(container_rows(spark, path, account_ids), kind)
