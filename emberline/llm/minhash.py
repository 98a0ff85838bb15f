"""MinHash near-deduplication by an inverted join of signature coordinates.

Documents with one shingle set are one class. A coordinate of a signature is made of DEPTH
least hashes, so that few sets which differ much agree in it. Each class is posted under
its coordinate-value pairs. Two sets of the similarity asked for agree in at least MATCHES
of COORDINATES places, so it is enough to merge their prefixes: the COORDINATES - MATCHES
+ 1 rarest postings of each. The other postings, the longest lists, are skipped;
collisions in them are counted from the signatures of the pairs found. Pairs above the
threshold are confirmed on the full sets.

No list is expanded into all its pairs: its members are linked to its most central member.
For members of a list that stay in different components, the lists of their signatures
give way to those of their items, rarest first by exact counts: of two similar sets each
has one of the items that are rarest in the other among its own rarest. A set with enough
items of its own has nothing to be held against.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm import textbytes as tb
from emberline.llm.components import components
from emberline.llm.lineage import cut, discard, written

#: Sets of Jaccard 0.8 agree in a coordinate with probability 0.8 ** DEPTH, and in fewer
#: than MATCHES of COORDINATES once in 350 million pairs.
COORDINATES, DEPTH, MATCHES = 48, 3, 6
PERCENT, WORDS = 80, 5
#: So many documents to be confirmed at most are looked up by a broadcast of their ids; more, by a shuffle.
BROADCAST_IDS = 500_000
#: The partners of one set are dealt out over so many chunks, to each of which the set goes once.
CHUNKS = 256

U = tb.U
FACTORS = (tb.mix(np.arange(1, COORDINATES * DEPTH + 1, dtype=U)) >> U(32)).astype(np.uint32) | np.uint32(1)
SHIFTS = (tb.mix(np.arange(1001, COORDINATES * DEPTH + 1001, dtype=U)) >> U(32)).astype(np.uint32)
LOW = U((1 << 52) - 1)


def shingles(text: np.ndarray, offs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and 52-bit hash of the distinct n-word shingles of each row, sorted; a row with
    fewer words has its whole sequence as one."""
    w = tb.words(text, offs, lower=True)
    at, h = tb.windows(w, n)
    row = w.row[at]
    first = np.searchsorted(w.row, np.arange(len(offs)))
    count = np.diff(first)
    for c in range(1, n):
        short = np.flatnonzero(count == c)
        if len(short):
            fold = np.full(len(short), U(c) * U(0xA0761D6478BD642F))
            for j in range(c):
                fold = fold * U(tb.ROOT) + w.key[first[short] + j]
            row, h = np.concatenate((row, short)), np.concatenate((h, tb.mix(fold)))
    one = np.unique(row.astype(U) << U(52) | h >> U(12))
    return (one >> U(52)).astype(np.int64), one & LOW


def set_keys(row: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two 64-bit hashes of each row's set."""
    edge = np.searchsorted(row, np.arange(rows + 1))
    out = []
    for seed in (U(0x8EBC6AF09C88C6E3), U(0x589965CC75374CC3)):
        total = np.concatenate((np.zeros(1, U), np.cumsum(tb.mix(value ^ seed))))
        out.append(tb.mix(total[edge[1:]] - total[edge[:-1]]).view(np.int64))
    return np.diff(edge), out[0], out[1]


def signatures(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """COORDINATES hashes of each row's items, each made of DEPTH least ones; 0 where a row has none."""
    edge = np.searchsorted(row, np.arange(rows + 1))
    full = np.flatnonzero(np.diff(edge))
    out = np.zeros((rows, COORDINATES), np.uint32)
    if len(full):
        x = (tb.mix(value) >> U(32)).astype(np.uint32)
        start = edge[full]
        for c in range(COORDINATES):
            fold = np.zeros(len(full), U)
            for k in range(c * DEPTH, c * DEPTH + DEPTH):
                fold = fold * U(tb.ROOT) + np.minimum.reduceat((x ^ SHIFTS[k]) * FACTORS[k], start)
            out[full, c] = tb.mix(fold) >> U(32)
    return out.view(np.int32)


def _sketch(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, text, offs in tb.slices(batch.column(1)):
                row, value = shingles(text, offs, n)
                size, k1, k2 = set_keys(row, value, j - i)
                sig = signatures(row, value, j - i)
                edge = pa.array(np.arange(j - i + 1, dtype=np.int32) * COORDINATES)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(size), pa.array(k1), pa.array(k2), pa.ListArray.from_arrays(edge, pa.array(sig.ravel()))], names=["id", "size", "k1", "k2", "sig"])

    return run


def _sets(n: int):
    """The shingle sets of those rows whose set has the keys that are looked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (np.asarray(batch.column(c)) for c in ("k1", "k2"))
            for i, j, text, offs in tb.slices(batch.column("_text")):
                row, value = shingles(text, offs, n)
                _, a, b = set_keys(row, value, j - i)
                right = (a == k1[i:j]) & (b == k2[i:j])
                edge = np.searchsorted(row, np.arange(j - i + 1)).astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(edge), pa.array(value.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("node")[i:j], found], names=["node", "items"]).filter(pa.array(right))

    return run


def _alike(percent: int):
    """Those of the rows (a, b, ia, ib) whose sorted sets are similar; rows of one a that follow one another are looked up together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a = np.asarray(batch.column("a"))
            left, right = batch.column("ia"), batch.column("ib")
            lo, hi = np.asarray(left.offsets), np.asarray(right.offsets)
            ia, ib = np.asarray(left.values), np.asarray(right.values)
            common = np.zeros(len(a), np.int64)
            edge = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1], [True])))
            for i, j in zip(edge[:-1], edge[1:]):
                one, many = ia[lo[i] : lo[i + 1]], ib[hi[i] : hi[j]]
                at = np.searchsorted(one, many)
                met = np.concatenate(([0], np.cumsum(one[np.minimum(at, len(one) - 1)] == many)))
                common[i:j] = np.diff(met[hi[i : j + 1] - hi[i]])
            size = np.diff(lo) + np.diff(hi)
            near = pa.array(100 * common >= percent * (size - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(near)

    return run


def _prefixes(posts: DataFrame) -> DataFrame:
    """Of each node's COORDINATES postings (node, size, key) the rarest ones that any near set shares one of, without those of one node alone.

    ``centre`` tells how much a node has in common with others: most for the one that near
    copies were made from.
    """
    shared = posts.groupBy("key").count().where("count > 1")
    lists = posts.join(shared, "key").groupBy("node", "size").agg(F.array_sort(F.collect_list(F.struct("count", "key"))).alias("p"))
    # postings of one node alone come first in the order and take their places in the prefix
    room = F.size("p") - (MATCHES - 1)
    centre = F.aggregate("p", F.lit(0).cast("long"), lambda n, x: n + x["count"])
    lists = lists.where(room > 0).select("node", "size", centre.alias("centre"), F.explode(F.slice("p", F.lit(1), room)).alias("p"))
    return lists.select("node", "size", "centre", F.col("p.key").alias("key"))


def _rarest_met(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets (node, size, component, items) of different components that may be similar.

    In the order of how many sets have an item, two similar sets have their first common
    item at a place that leaves room for all the others they must have in common.
    """

    def places(share: float):
        """Of a set's items in order, the first of which it shares one with any set that has that share of them."""
        return F.col("size") - F.ceil(F.col("size") * share - 1e-6) + 1

    items = sets.select("node", "size", "component", F.explode("items").alias("key"))
    counts = items.groupBy("key").count().where("count > 1")
    held = items.join(counts, "key").groupBy("node", "size", "component").agg(F.array_sort(F.collect_list(F.struct("count", "key"))).alias("p"))
    # items of one set alone come first in the order and take their places
    alone = F.col("size") - F.size("p")
    room = (places(percent / 100) - alone).cast("int")
    held = held.where(room > 0).select("node", "size", "component", alone.alias("alone"), F.posexplode(F.slice("p", F.lit(1), room)).alias("at", "p"))
    held = held.select("node", "size", "component", F.col("p.key").alias("key"), (F.col("alone") + F.col("at")).alias("place"))
    held = cut(held.withColumn("early", F.col("place") < places(2 * percent / (100 + percent))))
    # of a list, all but its largest component are held against the others
    shares = held.groupBy("key", "component").agg(F.count("*").alias("n"))
    main = shares.groupBy("key").agg(F.max(F.struct("n", "component")).alias("main"), F.count("*").alias("kinds")).where("kinds > 1").select("key", F.col("main.component").alias("main"))
    held = cut(held.join(main, "key"))
    rest = held.where("component <> main").select("key", *[F.col(c).alias(f"{c}_") for c in ("node", "size", "component", "place", "early")])
    needed = (F.col("size") + F.col("size_")) * percent / (100 + percent)
    first = F.expr("size_ < size or (size_ = size and node_ < node)")
    pairs = rest.join(held, "key").where("component <> component_").where(F.when(first, F.col("early_")).otherwise(F.col("early")))
    pairs = pairs.where((F.least("size", "size_") * 100 >= F.greatest("size", "size_") * percent) & (F.least(F.col("size") - F.col("place"), F.col("size_") - F.col("place_")) + 1e-6 >= needed))
    return pairs.select(F.least("node", "node_").alias("a"), F.greatest("node", "node_").alias("b")).distinct()


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


def _few(rows: DataFrame) -> DataFrame:
    """The rows, to be broadcast if they are BROADCAST_IDS at most."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_IDS else rows


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per input row: ``id_col, n_shingles, component_id, kept``.

    ``component_id`` is the smallest id that links lead to; the row that bears it is kept.
    Null and empty texts, and texts without words, have no shingles and no links. Null ids
    count as the last; a component of them alone has a null id and keeps all its rows.
    Rows that repeat an id and a text share its verdict. Other columns are not looked at.
    """
    if percent < 80:
        raise ValueError("the signature's match threshold holds for 80 percent and more")
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("_text"))
    rows = written(plain.mapInArrow(_sketch(words), "id long, size long, k1 long, k2 long, sig array<int>").withColumn("row", F.monotonically_increasing_id()))
    classes = rows.where("size > 0").groupBy("size", "k1", "k2").agg(F.min("row").alias("node"), F.min("id").alias("least"), F.first("sig").alias("sig"))
    classes = written(classes)

    posts = classes.select("node", "size", F.posexplode("sig").alias("at", "value"))
    posts = posts.select("node", "size", (F.col("value").cast("long") * COORDINATES + F.col("at")).alias("key"))
    lists = written(_prefixes(posts))

    def close(a: str, b: str):
        return (F.least(a, b) * 100) >= (F.greatest(a, b) * percent)

    def sets_of(nodes: DataFrame) -> DataFrame:
        """Full shingle sets of the classes, from one document of each; a document that repeats gives its set again, which does no harm."""
        wanted = _few(cut(_few(nodes).join(classes.select("node", "least", "k1", "k2"), "node")))
        texts = plain.join(wanted, plain["id"].eqNullSafe(wanted["least"])).select("node", "k1", "k2", "_text")
        return written(texts.mapInArrow(_sets(words), "node long, items array<long>"))

    def colliding(pairs: DataFrame) -> DataFrame:
        """Those of the pairs that agree in enough coordinates."""
        sig = written(classes.select("node", "sig").join(_few(cut(_nodes(pairs))), "node"))
        pairs = pairs.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a").join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b")
        hits = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
        found = cut(pairs.where(hits >= MATCHES).select("a", "b"))
        discard(sig)
        return found

    def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Those of the different pairs whose sets are similar; the set of a goes once to each chunk of its partners."""
        pairs = pairs.withColumn("chunk", F.pmod(F.xxhash64("b"), F.lit(CHUNKS)))
        left = pairs.select("a", "chunk").distinct().join(sets.select(F.col("node").alias("a"), F.col("items").alias("ia")), "a")
        both = pairs.join(sets.select(F.col("node").alias("b"), F.col("items").alias("ib")), "b").join(left, ["a", "chunk"])
        return cut(both.select("a", "b", "ia", "ib").mapInArrow(_alike(percent), "a long, b long").distinct())

    hubs = lists.groupBy("key").agg(F.max(F.struct("centre", "node", "size")).alias("hub"), F.count("*").alias("n")).where("n > 1").select("key", F.col("hub.node").alias("a"), F.col("hub.size").alias("size_a"))
    stars = lists.join(hubs, "key").where("node <> a").where(close("size", "size_a")).select("a", F.col("node").alias("b")).distinct()
    stars = colliding(cut(stars))
    sets = sets_of(cut(_nodes(stars)))
    found = cut(components(similar(stars, sets)))
    discard(sets)

    # members of lists that the links so far don't join
    placed = lists.select("key", "node", "size").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    apart = cut(placed.join(mixed, "key").select("node", "size", "component").distinct())
    discard(lists)
    sets = sets_of(apart.select("node"))
    pairs = cut(_rarest_met(apart.join(sets, "node"), percent))
    links = similar(pairs, sets)
    discard(sets)
    found = cut(components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links)))

    placed = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = cut(placed.select("size", "k1", "k2", "component", "least"))
    discard(classes)
    best = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    verdict = cut(placed.join(best, "component").select("size", "k1", "k2", "component_id"))
    out = rows.where("size > 0").join(verdict, ["size", "k1", "k2"]).select("id", "size", "component_id")
    out = out.unionByName(rows.where("size = 0").select("id", "size", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op3_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=2)
