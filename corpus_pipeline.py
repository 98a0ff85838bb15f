"""A training corpus from ``documents``: quality rules, exact and near duplicates, repeats, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All
but the last return the columns of their input, whatever their names. Rows may have nulls in any column; null
text counts as empty and fails the quality rules. Rows that agree in id and text are one
document. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberline.llm.exact_dedup import exact_dedup, normalised
from emberline.llm.lineage import cut, discard, written
from emberline.llm.minhash import near_duplicates
from emberline.llm.packing import pack, pieces
from emberline.llm.quality_lines import key_of, quality_rules, without_lines
from emberline.llm.repeats import PASSAGE_BYTES, PASSAGE_WORDS, remove_repeats


def _whole(docs: DataFrame, *without: str) -> Column:
    """The row as one column ``row``, so that no name of its columns clashes with ours."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in without]).alias("row")


def _columns(docs: DataFrame, text: Column | None = None, changed: Column | None = None) -> list[Column]:
    """The columns of ``docs`` out of ``row``, with another text; ``n_chars`` follows it where it has changed."""
    other = {}
    if text is not None:
        other["text"] = text
        if "n_chars" in docs.columns:
            other["n_chars"] = F.when(changed, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row")["n_chars"])
    return [other[c].alias(c) if c in other else F.col("row").getField(c).alias(c) for c in docs.columns]


def _ordered(value: Column, kind: T.DataType, back: bool = False) -> Column:
    """The value with maps as arrays of entries, at any depth, since rows with maps can't be grouped; and back."""
    if "map<" not in kind.simpleString():
        return value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: _ordered(v, kind.elementType, back))
    if isinstance(kind, T.StructType):
        fields = [_ordered(value.getField(f.name), f.dataType, back).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    pair = lambda e: F.struct(_ordered(e["key"], kind.keyType, back).alias("key"), _ordered(e["value"], kind.valueType, back).alias("value"))
    return F.map_from_entries(F.transform(value, pair)) if back else F.transform(F.map_entries(value), pair)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without lines that too many documents of their host have."""
    found = quality_rules(docs).where("kept")
    kept = cut(found.groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).agg(F.min_by("drop_lines", F.size("drop_lines")).alias("drop")))
    rows = docs.select(_whole(docs), key_of("text", "source").alias("row_key"))
    rows = rows.join(kept, F.col("row")["doc_id"].eqNullSafe(F.col("id")) & (F.col("row_key") == F.col("key")))
    return rows.select(*_columns(docs, without_lines(F.col("row")["text"], F.col("drop")), F.size("drop") > 0))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    found = exact_dedup(docs, digest_all=True).where("kept")
    kept = cut(found.groupBy(F.col("doc_id").alias("id"), "digest").agg(F.count("*").alias("n")))
    rows = docs.select(_whole(docs), F.sha2(normalised(F.col("text")), 256).alias("row_digest"))
    rows = rows.join(kept, F.col("row")["doc_id"].eqNullSafe(F.col("id")) & (F.col("row_digest") == F.col("digest")))
    once = rows.where("n = 1").select(*_columns(docs))
    if kept.where("n > 1").isEmpty():
        return once
    longest = F.struct(F.length(F.col("row")["text"]), F.xxhash64(F.col("row")["text"]))
    again = rows.where("n > 1").groupBy("id", "digest").agg(F.max_by("row", longest).alias("row"))
    return once.unionByName(again.select(*_columns(docs)))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates. An id whose rows differ stays if one of them does."""
    kept = cut(near_duplicates(docs).where("kept").select(F.col("doc_id").alias("id")).distinct())
    rows = docs.select(_whole(docs)).join(kept, F.col("row")["doc_id"].eqNullSafe(F.col("id")), "left_semi")
    return rows.select(*_columns(docs))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of PASSAGE_WORDS words or more that start elsewhere too.

    Such passages are found by strings of PASSAGE_BYTES bytes, which so many words reach in
    ordinary text; shorter runs stay. The other columns, of whatever types, ride along in the id.
    """
    kind = docs.select(_whole(docs, "text")).schema["row"].dataType
    rows = docs.select(_ordered(_whole(docs, "text"), kind).alias("row"), "text")
    found = remove_repeats(rows, id_col="row", length=PASSAGE_BYTES, min_words=PASSAGE_WORDS, characters=True)
    if "map<" in kind.simpleString():
        found = found.withColumn("row", _ordered(F.col("row"), kind, back=True))
    return found.select(*_columns(docs, F.col("kept").cast("string"), F.size("start") > 0))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, each with its sequence and its place there."""
    return pack(pieces(docs))


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("near_dedup", near), ("repeated_passages", repeats), ("best_fit_packing", packing)]

#: SQL does not express near duplicates' components nor best-fit packing; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
        if last is not None:
            discard(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
