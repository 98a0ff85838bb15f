"""Removal of byte strings that repeat anywhere in the corpus, by sorting suffixes.

Every window of ``length`` bytes has an anchor: its leftmost k-mer of least hash. Runs of
windows with one anchor are cut into RANGES by where the anchor lies in the window; all
windows of a range share most of their bytes, whose hash is the range's key. Equal windows
have equal anchors in equal places and so equal keys: only stretches whose keys occur
twice can hold repeats, and stretches of one key go to one shard. Stretches that are equal
as a whole repeat by themselves and are sorted once. Each shard is a partition, whose
suffixes and common prefixes are found by external induced sorting (``induced``).
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberline.llm import textbytes as tb
from emberline.llm.induced import IN_MEMORY, MEMORY, suffixes
from emberline.llm.lineage import cut, discard, written

LENGTH, KMER, RANGES = 400, 32, 2
#: A passage is a removed run of at least so many words, found by strings of so many bytes.
PASSAGE_BYTES, PASSAGE_WORDS = 200, 50
#: Bytes of stretches that a shard takes on average.
SHARD = 3 << 20
#: Bytes whose windows are looked at together; positions among them take PLACE bits.
SPAN, PLACE = 1 << 19, 20
#: Buckets of text hashes: at most so many rows tell which texts take part in a shuffle.
BUCKETS = 1 << 20
#: Keys with more than one in so many of all rows are joined by a broadcast of them; there are no more than that.
HOT = 1000
U = tb.U
ODD = U(0xA0761D6478BD642F)


def stretches(text: np.ndarray, offs: np.ndarray, length: int, deep: int, most: int | None = None) -> tuple[np.ndarray, ...]:
    """Row, key, hash of the bytes, start, number of windows and of bytes of each run of windows with one anchor and range.

    The bytes go on to where a string of ``deep`` bytes ends, or the row. Of each row the first ``most`` windows count.
    """
    n = len(text)
    none = (np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, U), *[np.zeros(0, np.int64)] * 3)
    if n < length:
        return none
    k = min(KMER, length)
    w = length - k + 1
    up, down = tb.powers(1 << max(18, n.bit_length()))
    total = np.zeros(n + 1, U)
    np.cumsum(tb.BYTE[text] * up[:n], out=total[1:])
    kmer = tb.mix((total[k:] - total[:-k]) * down[: n - k + 1])
    m = len(kmer)
    padded = np.full(-(-m // w) * w, ~U(0))
    padded[:m] = kmer >> U(PLACE) << U(PLACE) | np.arange(m, dtype=U)
    blocks = padded.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    anchor = (np.minimum(right[: m - w + 1], left[w - 1 : m]) & U((1 << PLACE) - 1)).astype(np.int64)
    size = np.diff(offs)
    rows = np.flatnonzero(size >= length)
    if not len(rows):
        return none
    count = size[rows] - length + 1
    if most is not None:
        count = np.minimum(count, most)
    base = np.repeat(offs[rows] - np.concatenate(([0], np.cumsum(count)[:-1])), count)
    at = base + np.arange(len(base))
    row = np.repeat(rows, count)
    anchor = anchor[at]
    step = -(-w // RANGES)
    part = (anchor - at) // step
    first = np.flatnonzero(np.concatenate(([True], (np.diff(anchor) != 0) | (np.diff(row) != 0) | (np.diff(part) != 0))))
    windows = np.diff(np.concatenate((first, [len(at)])))
    start, anchor, part, row = at[first], anchor[first], part[first], row[first]
    lo, hi = anchor - part * step, anchor - np.minimum((part + 1) * step, w) + 1 + length
    key = tb.mix((total[hi] - total[lo]) * down[lo] + part.astype(U) * ODD)
    end = np.minimum(start + windows - 1 + deep, offs[row + 1])
    whole = tb.mix((total[end] - total[start]) * down[start] + ((end - start) << 20 | windows).astype(U) * ODD)
    return row, key, whole, start - offs[row], windows, end - start


def _anchors(length: int, deep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, text, offs in tb.slices(batch.column("_text"), limit=SPAN):
                if len(text) <= 2 * SPAN:
                    row, *found = stretches(text, offs, length, deep)
                else:  # one long text, its windows in turns
                    turns = []
                    for at in range(0, len(text) - length + 1, SPAN):
                        piece = text[at : at + SPAN + deep - 1]
                        r, key, whole, start, windows, size = stretches(piece, np.array([0, len(piece)]), length, deep, SPAN)
                        turns.append((r, key, whole, start + at, windows, size))
                    row, *found = (np.concatenate(c) for c in zip(*turns))
                edge = pa.array(np.searchsorted(row, np.arange(j - i + 1)).astype(np.int32))
                key, whole, start, windows, size = found
                arrays = [key.view(np.int64), whole.view(np.int64), start.astype(np.int32), windows.astype(np.int32), size.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c)[i:j] for c in ("id", "h1", "h2")), *(pa.ListArray.from_arrays(edge, pa.array(a)) for a in arrays)], names=["id", "h1", "h2", "key", "whole", "start", "windows", "size"])

    return run


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the stretches that are listed with each text."""
    for batch in batches:
        data, offs = tb.buffers(batch.column("_text"))
        view, lists = memoryview(data), batch.column("parts")
        of = np.repeat(offs[:-1], np.asarray(lists.value_lengths().fill_null(0)))
        parts = lists.flatten()
        key, whole, windows = (parts.field(c) for c in ("key", "whole", "windows"))
        start = of + np.asarray(parts.field("start"))
        end = start + np.asarray(parts.field("size"))
        for a in range(0, len(parts), 10_000):
            some = slice(a, a + 10_000)
            content = [bytes(view[lo:hi]) for lo, hi in zip(start[some].tolist(), end[some].tolist())]
            yield pa.RecordBatch.from_arrays([key[some], whole[some], windows[some], pa.array(content, pa.binary())], names=["key", "whole", "windows", "bytes"])


def _sorted_shard(length: int, deep: int, memory: int, in_memory: int):
    """Runs of windows that another stretch of the shard has too, and with ``wide`` those where ``deep`` bytes are equal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], int] = {}
        size = []
        # letters go to a scratch file of the task as they come and are mapped from there
        with tempfile.TemporaryFile() as scratch:
            for batch in batches:
                for key, whole, windows, content in zip(*(batch.column(c).to_pylist() for c in ("key", "whole", "windows", "bytes"))):
                    if (key, whole) not in seen:
                        seen[key, whole] = windows
                        letters = np.empty(len(content) + 1, np.int16)
                        letters[:-1] = np.frombuffer(content, np.uint8)
                        letters[:-1] += 1
                        letters[-1] = 0
                        scratch.write(letters.tobytes())
                        size.append(len(letters))
            if not seen:
                return
            scratch.flush()
            text = np.memmap(scratch, np.int16, "r")
            base = np.concatenate(([0], np.cumsum(size)[:-1]))
            valid = np.zeros(len(text) + 1, bool)
            for b, w in zip(base.tolist(), seen.values()):
                valid[b : b + w] = True
            repeated = np.zeros((2, len(text) + 1), np.int8)
            for at, shared in suffixes(text, deep, memory, in_memory):
                # what lies beyond a stretch's windows starts in another stretch as well
                own = np.flatnonzero(valid[at])
                if len(own) < 2:
                    continue
                both = np.minimum.reduceat(shared, own[:-1] + 1)[: len(own) - 1] if own[-1] + 1 == len(at) else np.minimum.reduceat(shared[: own[-1] + 1], own[:-1] + 1)
                for kind, least in enumerate((length, deep)):
                    hit = np.flatnonzero(both >= least)
                    repeated[kind, at[own[hit]]] = 1
                    repeated[kind, at[own[hit + 1]]] = 1
            del text
        for b, w, n in zip(base.tolist(), seen.values(), size):  # prefixes may go on beyond a stretch's end
            repeated[1, b + max(0, min(w, n - deep)) : b + w] = 0
        ids = np.array(list(seen), np.int64).reshape(-1, 2)
        for kind in range(1 if deep == length else 2):
            step = np.diff(repeated[kind], prepend=0)
            start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
            of = np.searchsorted(base, start, side="right") - 1
            wide = pa.array(np.full(len(start), kind == 1))
            yield pa.RecordBatch.from_arrays([pa.array(ids[of, 0]), pa.array(ids[of, 1]), pa.array((start - base[of]).astype(np.int32)), pa.array((end - base[of]).astype(np.int32)), wide], names=["key", "whole", "lo", "hi", "wide"])

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("_text"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))


def _split(rows: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that may be among the keys (by a bucket of ``h1``), and those that are not."""
    bucket = F.pmod("h1", F.lit(BUCKETS)).cast("int").alias("_bucket")
    taken = F.broadcast(keys.select(bucket, F.lit(True).alias("_taken")).distinct())  # BUCKETS rows at most
    rows = rows.withColumn("_bucket", bucket).join(taken, "_bucket", "left")
    return rows.where("_taken").drop("_bucket", "_taken"), rows.where("_taken is null").drop("_bucket", "_taken")


def _with_id(kind: T.DataType, others: str) -> T.StructType:
    return T.StructType([T.StructField("id", kind), *T.StructType.fromDDL(others).fields])


def _met(rows: DataFrame, keys: DataFrame, n: str) -> DataFrame:
    """The rows with one of the keys; ``n`` tells how many rows a key has, so that frequent ones don't meet in one task."""
    keys = cut(keys)
    total = keys.agg(F.sum(n)).first()[0] or 0
    hot = F.broadcast(keys.where(F.col(n) * HOT > total).select("key"))  # less than HOT rows
    return rows.join(hot, "key", "left_anti").join(keys.select("key"), "key").unionByName(rows.join(hot, "key"))


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, deep: int | None = None, memory: int = MEMORY, in_memory: int = IN_MEMORY) -> DataFrame:
    """For each different text with repeats: its hashes ``h1, h2`` and ``runs``, the ranges
    [lo, hi) of starts of windows of ``length`` bytes which start elsewhere too, and with
    ``wide`` the same of ``deep`` bytes where that is more.

    ``memory`` and ``in_memory`` bound what the sorter of a shard holds (``induced``).
    """
    deep = length if deep is None else deep
    rows = _keyed(docs, id_col, text_col)
    names = ("key", "whole", "start", "windows", "size")
    found = rows.mapInArrow(_anchors(length, deep), _with_id(docs.schema[id_col].dataType, "h1 long, h2 long, key array<long>, whole array<long>, start array<int>, windows array<int>, size array<int>"))
    # texts that are copies of one another are one from here on, with their number
    texts = found.where(F.size("key") > 0).groupBy("h1", "h2").agg(F.min("id").alias("id"), F.count("*").alias("n"), *[F.first(c).alias(c) for c in names])
    texts = written(texts)
    parts = texts.select("h1", "h2", "id", "n", F.explode(F.arrays_zip(*names)).alias("p")).select("h1", "h2", "id", "n", "p.*")
    twice = texts.select("n", F.explode("key").alias("key")).groupBy("key").agg(F.sum("n").alias("times"), F.count("*").alias("rows")).where("times > 1")
    parts = written(_met(parts, twice, "rows"))
    discard(texts)
    kinds = parts.groupBy("key", "whole").agg(F.sum("n").alias("times"), F.first("windows").alias("windows"), F.first("size").alias("size"), F.min(F.struct("h1", "h2", "id", "start")).alias("at"))
    kinds = written(kinds)
    several = kinds.groupBy("key").agg(F.count("*").alias("kinds")).where("kinds > 1")
    to_sort = _met(kinds, several, "kinds").select("at.h1", "at.h2", "at.id", F.struct("key", "whole", F.col("at.start").alias("start"), "windows", "size").alias("part"))
    to_sort = written(to_sort)
    size = to_sort.agg(F.sum("part.size")).first()[0]
    wanted = to_sort.groupBy("h1", "h2", F.col("id").alias("id_")).agg(F.collect_list("part").alias("parts"))
    held = _split(rows, to_sort)[0].join(wanted, ["h1", "h2"]).where(F.col("id").eqNullSafe(F.col("id_"))).select("_text", "parts")
    shards = max(1, -(-(size or 0) // SHARD))
    pieces = held.mapInArrow(_cut_out, "key long, whole long, windows int, bytes binary").repartition(shards, "key")
    runs = pieces.mapInArrow(_sorted_shard(length, deep, memory, in_memory), "key long, whole long, lo int, hi int, wide boolean")
    again = kinds.where("times > 1")
    runs = runs.unionByName(again.select("key", "whole", F.lit(0).alias("lo"), F.col("windows").alias("hi"), F.lit(False).alias("wide")))
    if deep > length:
        far = F.least(F.col("windows"), F.col("size") - (deep - 1))
        runs = runs.unionByName(again.where(far > 0).select("key", "whole", F.lit(0).alias("lo"), far.alias("hi"), F.lit(True).alias("wide")))
    runs = cut(runs)
    discard(kinds)
    discard(to_sort)
    placed = parts.join(runs, ["key", "whole"]).select("h1", "h2", F.struct((F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi"), "wide").alias("run"))
    return placed.groupBy("h1", "h2").agg(F.array_sort(F.collect_set("run")).alias("runs"))


def covered(lo: np.ndarray, hi: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The maximal byte ranges that windows with starts in the sorted ranges [lo, hi) cover."""
    if not len(lo):
        return lo, hi
    end = np.maximum.accumulate(hi + length - 1)
    new = np.concatenate(([True], lo[1:] > end[:-1]))
    return lo[new], end[np.concatenate((new[1:], [True]))]


def _worded(text: np.ndarray, start: np.ndarray, end: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Those of the ranges that hold so many words."""
    full = np.array([len(text[a:b].tobytes().split()) >= least for a, b in zip(start, end)], bool)
    return start[full], end[full]


def _removed(length: int, characters: bool, min_words: int, passages: tuple[int, int] | None):
    lists = pa.list_(pa.int32())
    schema = pa.schema([("n_bytes", pa.int64()), ("start", lists), ("end", lists), ("kept", pa.binary()), *[(c, lists) for c in ("passage_start", "passage_end") if passages]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = tb.buffers(batch.column("_text"))
            out: list[list] = [[] for _ in schema]
            for k, runs in enumerate(batch.column("runs")):
                text = data[offs[k] : offs[k + 1]]
                flat = runs.values
                lo, hi, wide = (np.zeros(0, np.int32),) * 2 + (np.zeros(0, bool),) if flat is None else (flat.field(c).to_numpy(zero_copy_only=False) for c in range(3))
                some = wide if passages and passages[0] < length else ~wide
                start, end = covered(lo[some], hi[some], length)
                if min_words and len(start):
                    start, end = _worded(text, start, end, min_words)
                if characters and len(start):  # whole characters only
                    start, end = start.copy(), end.copy()
                    for _ in range(3):
                        start += (text[np.minimum(start, len(text) - 1)] & 0xC0) == 0x80
                        end -= (end < len(text)) & ((text[np.minimum(end, len(text) - 1)] & 0xC0) == 0x80)
                step = np.zeros(len(text) + 1, np.int8)
                step[start] += 1
                step[end] -= 1
                row = [len(text), start, end, text[np.cumsum(step[:-1]) == 0].tobytes()]
                if passages:
                    row += _worded(text, *covered(lo[~wide], hi[~wide], passages[0]), passages[1])
                for column, value in zip(out, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, f.type) for c, f in zip(out, schema))], names=["id", *schema.names])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, characters: bool = False, min_words: int = 0, passages: tuple[int, int] | None = None, memory: int = MEMORY, in_memory: int = IN_MEMORY) -> DataFrame:
    """One row per input row: ``id_col, n_bytes, start, end`` (arrays: the maximal ranges of
    bytes removed) and ``kept`` (binary, the remaining bytes).

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in
    the same or another text; strings overlap, never cross texts, and are judged on the
    input. Ranges of fewer than ``min_words`` words stay. ``characters`` leaves those at the
    ends of a range that would be split. With ``passages``, a shorter length and a number of
    words, ``passage_start, passage_end`` are the ranges which that length and
    ``min_words`` would give; one sort finds both. Null counts as empty; texts shorter than
    ``length`` stay whole. Ids may be null or repeat. ``memory`` (bytes of waiting entries)
    and ``in_memory`` (names) bound what the sorter of one shard holds before it spills to
    disk and recurs.
    """
    if passages and passages[0] > length:
        raise ValueError("passages are found by strings of the length at most")
    runs = cut(repeated_windows(docs, id_col, text_col, passages[0] if passages else length, length, memory, in_memory))
    some, others = _split(_keyed(docs, id_col, text_col), runs)
    some = some.join(runs, ["h1", "h2"], "left").select("id", "_text", "runs")
    rows = some.unionByName(others.select("id", "_text", F.lit(None).cast(runs.schema["runs"].dataType).alias("runs")))
    more = ", passage_start array<int>, passage_end array<int>" if passages else ""
    out = rows.mapInArrow(_removed(length, characters, min_words, passages), _with_id(docs.schema[id_col].dataType, f"n_bytes long, start array<int>, end array<int>, kept binary{more}"))
    return out.withColumnRenamed("id", id_col)


def op9_suffix_array(spark, sf_dir: str) -> DataFrame:
    """The contract's columns, and passages of PASSAGE_WORDS words or more that start elsewhere too, which may be shorter than 400 bytes."""
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), passages=(PASSAGE_BYTES, PASSAGE_WORDS))
    n_removed = F.col("n_bytes") - F.octet_length("kept")
    in_passages = F.aggregate(F.arrays_zip("passage_start", "passage_end"), F.lit(0).cast("long"), lambda n, x: n + x["passage_end"] - x["passage_start"])
    return found.select("doc_id", "n_bytes", n_removed.cast("long").alias("n_removed"), F.size("start").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), F.size("passage_start").cast("long").alias("n_passages"), in_passages.alias("n_passage_bytes"))
