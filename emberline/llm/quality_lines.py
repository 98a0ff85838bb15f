"""Quality rules with cross-document line frequency.

Lines are normalised and hashed; for each host (``source``) the documents that hold a
line are counted; lines held by more than the limits allow are boilerplate. They are
removed from all documents but the first of the host that has them, and documents that
lose most of their words so are rejected, as are those that fail the base rules.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.llm import textbytes as tb
from emberline.llm.lineage import cut

#: A line is boilerplate of a host when more documents than this, and more than
#: MAX_SHARE of the host's documents, hold it; on both sides, documents of one body are one.
MAX_DOCS = 10
MAX_SHARE = 0.01
#: A document is depleted when less than this share of its words remains.
MIN_LEFT = 0.2
MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8

SCHEMA = "doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, body long, line_hash array<long>, line_words array<int>, line_at array<int>, text_key long"
SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
FOLLOWS = (np.arange(256) & 0xC0) == 0x80  # UTF-8 continuation bytes


def key_of(text_col: str, host_col: str) -> Column:
    """Tells rows of one id apart: a hash of text and host."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(host_col).cast("string"), F.lit("\0")))


def repeated_words(w: tb.Words, n: int, rows: int) -> np.ndarray:
    """Per row: words in windows of n words that the row has twice or more."""
    at, h = tb.windows(w, n)
    covered = np.zeros(len(w.key) + 1, np.int64)
    if len(at):
        _, inverse, count = np.unique(tb.mix(h + w.row[at].astype(tb.U) * tb.U(0x2545F4914F6CDD1D)), return_inverse=True, return_counts=True)
        twice = at[count[inverse] > 1]
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + n, -1)  # stays in the row, since the window does
    return tb.per_row(w.row, rows, np.cumsum(covered)[:-1] > 0)


def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base counts of each document, and hash and word count of its lines that have a word; ``text_key`` goes along."""
    for batch in batches:
        along = [n for n in batch.schema.names if n == "text_key"]
        for i, j, text, offs in tb.slices(batch.column("text")):
            rows = j - i
            w = tb.words(text, offs, lower=False)
            low = tb.words(text, offs, lower=True).key
            points = np.concatenate(([0], np.cumsum(~FOLLOWS[text], dtype=np.int64)))
            symbols = np.concatenate(([0], np.cumsum(SYMBOL[text], dtype=np.int64)))
            row, start, end = tb.lines(text, offs)
            place = np.arange(len(row)) - np.searchsorted(row, np.arange(rows))[row]
            first, after = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
            full = after > first
            row, start, end, place, first, after = row[full], start[full], end[full], place[full], first[full], after[full]
            raw = tb.keys(text, start, end)
            seen = np.unique(tb.mix(raw + row.astype(tb.U) * tb.U(0x2545F4914F6CDD1D)), return_index=True)[1]
            again = np.ones(len(row), bool)
            again[seen] = False
            # a normalised line is the sequence of its folded words
            up, down = tb.powers(1 << max(18, len(low).bit_length() + 1))
            total = np.concatenate((np.zeros(1, tb.U), np.cumsum(low * up[: len(low)])))
            norm = tb.mix((total[after] - total[first]) * down[first] + (after - first).astype(tb.U))
            edge = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
            total = np.concatenate((np.zeros(1, tb.U), np.cumsum(norm * up[: len(norm)])))
            body = tb.mix((total[edge[1:]] - total[edge[:-1]]) * down[edge[:-1]])
            edges = pa.array(edge)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id")[i:j],
                    batch.column("host")[i:j],
                    pa.array(tb.per_row(w.row, rows)),
                    pa.array(tb.per_row(w.row, rows, points[w.end] - points[w.start])),
                    pa.array(symbols[offs[1:]] - symbols[offs[:-1]]),
                    pa.array(tb.per_row(row, rows, again)),
                    pa.array(repeated_words(w, WINDOW, rows)),
                    pa.array(body.view(np.int64)),
                    pa.ListArray.from_arrays(edges, pa.array(norm.view(np.int64))),
                    pa.ListArray.from_arrays(edges, pa.array((after - first).astype(np.int32))),
                    pa.ListArray.from_arrays(edges, pa.array(place.astype(np.int32))),
                    *[batch.column(n)[i:j] for n in along],
                ],
                names=["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "body", "line_hash", "line_words", "line_at", *along],
            )


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_docs: int = MAX_DOCS,
    max_share: float = MAX_SHARE,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """One row per input row: base counts, ``base_failed``, ``kept``, ``n_lines_removed``,
    ``n_words_left``, ``drop_lines`` (places, from 0, of those \\n-split lines that are
    to go) and ``text_key`` (``key_of`` the text and its host).

    A line counts once for each different document body of a host, so exact copies
    don't make boilerplate of one another; nor do copies and empty documents count in
    the host's documents, so they don't hide any. The document with the smallest id keeps a
    line of which the other copies go. Null text is empty, a null host is a host of its
    own, empty documents fail the base rules; rows with one id are counted each by
    itself. Other columns are not looked at. An empty table gives an empty result.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(host_col).cast("string"), F.lit("\0")).alias("host"), key_of(text_col, host_col).alias("text_key"))
    rows = cut(plain.mapInArrow(measured, SCHEMA).withColumn("row", F.monotonically_increasing_id()))
    held = rows.select("host", "doc_id", "row", "body", F.explode(F.array_distinct("line_hash")).alias("line"))
    bodies = held.groupBy("host", "line", "body").agg(F.min(F.struct("doc_id", "row")).alias("first"))
    per_line = bodies.groupBy("host", "line").agg(F.count("*").alias("n"), F.min("first")["row"].alias("keeper")).where(F.col("n") > max_docs)
    per_host = rows.where(F.size("line_hash") > 0).select("host", "body").distinct().groupBy("host").agg(F.count("*").alias("host_bodies"))
    often = per_line.join(per_host, "host").where(F.col("n") > F.col("host_bodies") * max_share).select("host", "line", "keeper")
    found = held.select("host", "row", "line").join(often, ["host", "line"]).where("row <> keeper")
    found = found.groupBy("row").agg(F.collect_set("line").alias("often"))
    rows = rows.join(found, "row", "left").withColumn("often", F.coalesce("often", F.array().cast("array<long>")))
    lines = F.arrays_zip("line_hash", "line_words", "line_at")
    gone = F.filter(lines, lambda x: F.array_contains(F.col("often"), x["line_hash"]))
    lost = F.aggregate(gone, F.lit(0).cast("long"), lambda a, x: a + x["line_words"])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    rows = rows.withColumn("n_words_left", F.col("n_words") - F.when(F.size("often") > 0, lost).otherwise(F.lit(0).cast("long")))
    at = F.transform(gone, lambda x: x["line_at"])
    rows = rows.withColumn("drop_lines", F.when(F.size("often") > 0, at).otherwise(F.array().cast("array<int>")))
    return rows.select(
        F.col("doc_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.col("n_words_left") >= F.col("n_words") * min_left)).alias("kept"), F.size("drop_lines").alias("n_lines_removed"), "n_words_left", "drop_lines", "text_key",
    )


def without_lines(text: Column, drop: Column) -> Column:
    """The text without the \\n-split lines whose places ``drop`` lists."""
    left = F.filter(F.split(text, "\n"), lambda line, at: ~F.array_contains(drop, at))
    return F.when(F.size(drop) > 0, F.array_join(left, "\n")).otherwise(text)


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    found = quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.drop("drop_lines", "text_key")
