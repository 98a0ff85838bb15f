"""Best-fit packing of token sequences by hierarchical residual packing.

Rows are dealt to groups of bounded size and packed there by best fit, largest first.
Nearly full bins are done; the others go up a tree as items of their own, where groups
merge and pack again, until one group is left or nothing more comes together.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm import bpe
from emberline.llm import textbytes as tb
from emberline.llm.lineage import cut

CAPACITY = 2048
#: Encoded words that a Python worker keeps, twice over.
CACHED = 600_000
#: Items that a group takes at first, and rows that a merged group may hold.
GROUP, MOST = 20_000, 400_000
#: Groups that meet at the next level of the tree.
FAN = 8
#: A bin with so much room at most is nearly full.
ROOM = 4


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """``id_col, piece, start, length, ids_crc32``: each document's ids and a closing id,
    cut where they are longer than the capacity. The ids are those of the tokenizers library,
    which the tests compare. Null and empty texts have the closing id alone."""
    path = path or bpe.default_vocabulary()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.tree_encoder(path, CACHED)
        for batch in batches:
            for i, j, _, _ in tb.slices(batch.column(1)):
                of, start, length, crc = [], [], [], []
                for k, ids in enumerate(encoder.encode_all(bpe.utf8(batch.column(1)[i:j]))):
                    ids += end
                    for at in range(0, len(ids), 4 * capacity):
                        part = ids[at : at + 4 * capacity]
                        of.append(k)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                start = np.array(start, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:j].take(pa.array(of, pa.int64())), pa.array((start // capacity).astype(np.int32)), pa.array(start), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=[id_col, "piece", "start", "length", "ids_crc32"],
                )

    plain = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    return plain.mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each item; items come largest first. A bit set over free room finds the tightest bin."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    free = n = 0
    out = []
    for size in sizes:
        fits = free >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            at = room[left].pop()
            if not room[left]:
                free &= ~(1 << left)
        else:
            left, at, n = capacity, n, n + 1
        out.append(at)
        left -= size
        if left:
            room[left].append(at)
            free |= 1 << left
    return out


def pack(items: DataFrame, size_col: str = "length", capacity: int = CAPACITY, group: int = GROUP, fan: int = FAN, room: int = ROOM) -> DataFrame:
    """The rows of ``items`` with ``sequence_id`` and ``offset``: bins of at most ``capacity``.

    Sizes are 0 to ``capacity``; larger ones raise an error, null counts as 0. Rows may
    repeat: each is an item. An empty table gives an empty result.
    """
    names = items.columns
    rows = items.withColumn("_size", F.coalesce(F.col(size_col).cast("long"), F.lit(0).cast("long")))
    rows = rows.withColumn("_size", F.when(F.col("_size").between(0, capacity), F.col("_size")).otherwise(F.raise_error(F.lit("an item is larger than the capacity"))))
    rows = cut(rows.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long")).withColumn("_done", F.col("_size") >= capacity - room).withColumn("_group", F.lit(0).cast("long")))
    schema = rows.schema

    def repack(level: int):
        def run(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["sequence_id", "offset"], kind="stable")
            bins = rows.groupby("sequence_id", sort=True)["_size"].sum()
            bins = bins.reset_index().sort_values(["_size", "sequence_id"], ascending=[False, True], kind="stable")
            into = np.array(best_fit(bins["_size"].tolist(), capacity), np.int64)
            bins["_new"] = into
            bins["_at"] = bins.groupby("_new")["_size"].cumsum() - bins["_size"]
            full = bins.groupby("_new")["_size"].sum() >= capacity - room
            bins["_full"] = full.reindex(bins["_new"]).to_numpy()
            rows = rows.merge(bins[["sequence_id", "_new", "_at", "_full"]], on="sequence_id", how="left")
            rows["offset"] += rows["_at"]
            rows["sequence_id"] = (level << 56) + rows["_group"] * (1 << 26) + rows["_new"]
            rows["_done"] = rows["_full"].astype(bool)
            return rows[schema.names]

        return run

    done = rows.where("_done")
    rest = rows.where("not _done")
    bins = left = rest.count()
    groups = max(1, -(-left // group))
    rest = rest.withColumn("_group", F.pmod(F.xxhash64("sequence_id"), F.lit(groups)))
    for level in range(1, 60):
        if not left:
            break
        packed = cut(rest.groupBy("_group").applyInPandas(repack(level), schema))
        done = done.unionByName(packed.where("_done"))
        rest, had, were = packed.where("not _done"), bins, groups
        left, bins = rest.agg(F.count("*"), F.countDistinct("sequence_id")).first()
        if groups == 1:
            break
        # a bin's group is one number in all its rows, so bins stay whole as groups merge
        groups = max(1, -(-groups // fan), -(-left // MOST))
        if groups >= were and bins >= had:
            break
        rest = rest.withColumn("_group", F.pmod(F.col("_group"), F.lit(groups)))
    return done.unionByName(rest).select(*names, "sequence_id", "offset")


def op6_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(pieces(spark.read.parquet(f"{sf_dir}/documents.parquet")))
