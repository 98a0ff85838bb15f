"""Exact deduplication by progressive refinement, in DataFrame operations only.

Rows are told apart first by the length of the normalised text, then by a hash of its
first characters, and only what still agrees by a SHA-256 of the whole of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.llm.lineage import cut

#: Buckets of (length, prefix hash). At most so many rows are ever broadcast.
BUCKETS = 1 << 20
PREFIX = 64


def normalised(text: Column) -> Column:
    """The text without the characters ``[\\x20\\x09-\\x0D]``; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, digest``.

    Of equal normalised texts the row with the most code points stays, then the one
    with the smallest id. ``digest`` (hex SHA-256) is null for rows that their length
    and prefix already tell apart, unless ``digest_all``.

    Null and empty texts are equal. Null ids come last; rows which repeat an id and its
    text are one document and share its verdict. Other columns are not looked at, so
    their names don't matter. An empty table gives an empty result.
    """
    norm = normalised(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("_id"), F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("_chars"), norm.alias("_norm"))
    rows = rows.withColumn("_len", F.octet_length("_norm")).withColumn("_bucket", F.pmod(F.xxhash64("_len", F.substring("_norm", 1, PREFIX)), F.lit(BUCKETS)).cast("int"))
    # buckets are counted before the shuffle, so a length that many share costs no more than others
    shared = rows.groupBy("_bucket").count().where("count > 1").select("_bucket", F.lit(True).alias("_shared"))
    rows = rows.join(F.broadcast(shared), "_bucket", "left")  # at most BUCKETS rows, whatever the input
    digest = F.sha2(F.col("_norm"), 256)
    # texts are read twice, once to count buckets and once to hash; from here on rows are short and written
    rows = cut(rows.select("_id", "_chars", "_len", "_shared", (digest if digest_all else F.when(F.col("_shared"), digest)).alias("digest")))
    alone = rows.where(F.col("_shared").isNull()).select(F.col("_id").alias(id_col), F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    same = rows.where(F.col("_shared"))
    best = F.min(F.struct((-F.col("_chars")).alias("a"), F.col("_id").isNull().alias("b"), F.col("_id").alias("c")))
    groups = same.groupBy(F.col("_len").alias("_l"), F.col("digest").alias("_d")).agg(best["c"].alias("keep_id"), F.count("*").alias("group_size"))
    # written, so that the join can split a group that many rows are in
    found = same.join(cut(groups), (F.col("_len") == F.col("_l")) & (F.col("digest") == F.col("_d")))
    found = found.select(F.col("_id").alias(id_col), "keep_id", "group_size", F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")
    return alone.unionByName(found)


def op7_exact_dedup(spark, sf_dir: str) -> DataFrame:
    found = exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest_all=True)
    return found.withColumnRenamed("digest", "text_sha256")


ORACLE = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents
), g AS (
  SELECT doc_id, chars, sha256(norm) AS text_sha256 FROM n
)
SELECT doc_id,
  first_value(doc_id) OVER w AS keep_id,
  CAST(count(*) OVER (PARTITION BY text_sha256) AS BIGINT) AS group_size,
  doc_id = first_value(doc_id) OVER w AS kept,
  text_sha256
FROM g
WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
"""
