"""Phrase collocations by growth of contiguous patterns, prefix by prefix.

Words are counted first. Every occurrence of a frequent word is then a pointer: it
projects the frequent words that follow it in its piece, MAX_WORDS - 1 at most. Pointers
are shuffled by their prefix, and each prefix is grown on its own, to the right and depth
first: the words that follow often enough extend it, and only the pointers of a frequent
phrase are looked at for the next word. Within a task pointers lie sorted, so that those
of a phrase are one run and growth needs no copy of them.

A task of the scan adds up equal pointers before they are shuffled. Prefixes with more than 1/HOT_PARTS
of all words (HOT_PARTS at most) are dealt out over several slots by the word that
follows, so that no task holds all of a very common word.

Words are known by 64-bit hashes of word and language. Two words of one hash are noticed
(their texts are compared in every task and between tasks), and all is hashed anew.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emberline.llm import textbytes as tb
from emberline.llm.lineage import discard, written

#: Phrases have 2 to MAX_WORDS words and LEAST occurrences; TOP of each language are returned.
MAX_WORDS, LEAST, TOP = 3, 10, 2000
#: A phrase goes if a longer one that holds it has this share of its occurrences.
ABSORBED_PERCENT = 50
#: A prefix with more than this part of all words is dealt out over several tasks.
HOT_PARTS = 1000
#: Words or pointers that a task adds up at once.
HELD = 1 << 21
#: Bits of the filter of frequent words: so many a word, and at most 2 ** MOST_BITS (64 MB).
BITS, MOST_BITS = 16, 29
#: Slots that the rows of a language are ranked in first, so that no task ranks them all.
RANK_SLOTS = 64

U = tb.U
PIECE_END = np.isin(np.arange(256), list(b".,;:!?\n\x0b\x0c\r"))
WORD_END = PIECE_END | np.isin(np.arange(256), list(b" \t"))
WORDS = "key long, lang string, word string, n long"


def byte_table(seed: int) -> np.ndarray:
    return tb.BYTE if seed == 0 else tb.mix(tb.BYTE + U(seed))


def language_keys(lang: pa.Array, seed: int) -> tuple[list[str], np.ndarray]:
    """The language of each row (null: ``und``), and its hash."""
    names = [x if x is not None else "und" for x in lang.to_pylist()]
    made = {}
    for x in set(names):
        data = np.frombuffer(x.encode() or b"\0", np.uint8)
        made[x] = tb.keys(data, np.array([0]), np.array([len(data)]), byte_table(seed + 1))[0]
    return names, np.array([made[x] for x in names], U)


def tokens(text: np.ndarray, offs: np.ndarray, langs: np.ndarray, seed: int):
    """Row, start, end, key and piece of every word of a slice; keys are never 0. Pieces are numbered over the slice."""
    text = tb.LOWER[text]
    start, end = tb.spans(text, offs, WORD_END[text])
    row = np.searchsorted(offs, start, side="right") - 1
    key = tb.mix(tb.keys(text, start, end, byte_table(seed)) + langs[row])
    key[key == 0] = U(1)
    ends = np.concatenate(([0], np.cumsum(PIECE_END[text])))
    return text, row, start, end, key, ends[start] + row


def edges_of(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A second mark of words: length and outer bytes, to notice that words of one key differ."""
    mark = (end - start).astype(U)
    for j in range(8):
        for at in (np.minimum(start + j, end - 1), np.maximum(end - 1 - j, start)):
            mark = mark * U(tb.ROOT) + text[at].astype(U)
    return mark


class Clash(Exception):
    """Two words have one key."""


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each distinct row of ``keys`` (columns), and the sum of ``n`` over its rows."""
    mixed = keys[:, 0]
    for j in range(1, keys.shape[1]):
        mixed = tb.mix(mixed * U(tb.ROOT) + keys[:, j])
    _, first, inverse = np.unique(mixed, return_index=True, return_inverse=True)
    if (keys[first[inverse]] != keys).any():  # rows of one hash: compared in full
        _, first, inverse = np.unique(keys, axis=0, return_index=True, return_inverse=True)
        inverse = inverse.reshape(-1)
    return first, np.bincount(inverse, weights=n, minlength=len(first)).astype(np.int64)


def counted(seed: int):
    """For each task's words ``key, lang, word, n``; one row a language without key or word has the number of all its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}
        held: dict[int, list] = {}  # key: language, word, n, mark

        def out():
            rows = list(held.items())
            yield pa.record_batch([pa.array([U(k).astype(np.int64) for k, _ in rows], pa.int64()), pa.array([v[0] for _, v in rows]), pa.array([v[1].decode("utf-8", "replace") for _, v in rows]), pa.array([v[2] for _, v in rows], pa.int64())], names=["key", "lang", "word", "n"])

        for batch in batches:
            names, langs = language_keys(batch.column("lang"), seed)
            for i, j, raw, offs in tb.slices(batch.column("text")):
                text, row, start, end, key, _ = tokens(raw, offs, langs[i:j], seed)
                for r, n in enumerate(np.bincount(row, minlength=j - i).tolist()):
                    total[names[i + r]] = total.get(names[i + r], 0) + n
                if not len(key):
                    continue
                mark = edges_of(text, start, end)
                some, first, inverse, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
                if (mark[first[inverse]] != mark).any():
                    raise Clash("two words of one key in a slice")
                for k, f, c in zip(some.tolist(), first.tolist(), n.tolist()):
                    known = held.get(k)
                    if known is None:
                        held[k] = [names[i + row[f]], text[start[f] : end[f]].tobytes(), c, mark[f]]
                    elif known[3] != mark[f]:
                        raise Clash("two words of one key in a task")
                    else:
                        known[2] += c
                if len(held) > HELD // 4:
                    yield from out()
                    held.clear()
        if held:
            yield from out()
        if total:
            yield pa.record_batch([pa.nulls(len(total), pa.int64()), pa.array(list(total)), pa.nulls(len(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["key", "lang", "word", "n"])

    return run


def word_table(docs: DataFrame, least: int, seed: int = 0) -> tuple[DataFrame, int]:
    """``key, lang, word, n`` of the words with ``least`` occurrences, a row with null word for all of a language; and the seed of the keys."""
    for tried in range(seed, seed + 8):
        try:
            rows = docs.mapInArrow(counted(tried), WORDS).groupBy("key", "lang").agg(F.sum("n").alias("n"), F.min("word").alias("word"), F.max("word").alias("other"))
            found = written(rows.where(f"key is null or n >= {least}"))
            if found.where("word <> other").isEmpty() and found.where("key is not null").groupBy("key").count().where("count > 1").isEmpty():
                return found.select("key", "lang", "word", "n"), tried
            discard(found)
        except Exception as e:
            if "two words of one key" not in str(e):
                raise
    raise ValueError("words keep meeting in one hash")


def frequent_filter(words: DataFrame) -> np.ndarray:
    """A Bloom filter of the words' keys, of at most 2 ** MOST_BITS bits; it is wrong only in letting words through."""
    keys = words.where("key is not null").select("key")
    bits = min(MOST_BITS, max(16, int(keys.count() * BITS).bit_length()))
    at = F.explode(F.array(*[F.shiftrightunsigned("key", s).bitwiseAND((1 << bits) - 1) for s in (0, 64 - bits)])).alias("at")
    marks = keys.select(at).groupBy(F.shiftright("at", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("m"))
    got = marks.toArrow()  # at most 2 ** (MOST_BITS - 6) rows
    out = np.zeros(1 << (bits - 6), U)
    out[got["w"].to_numpy()] = got["m"].to_numpy().astype(U)
    return out


def passes(mask: np.ndarray, key: np.ndarray) -> np.ndarray:
    bits = (len(mask) - 1).bit_length() + 6
    ok = np.ones(len(key), bool)
    for s in (0, 64 - bits):
        at = (key >> U(s)) & U((1 << bits) - 1)
        ok &= (mask[at >> U(6)] >> (at & U(63))) & U(1) != 0
    return ok


def projected(mask, hot, most: int, seed: int):
    """Pointers of a task: prefix, the frequent words after it in its piece (0: none), how many there are, and the prefix's slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, (hot_keys, hot_slots) = mask.value, hot
        held, size = [], 0

        def out():
            keys = np.concatenate(held)
            first, n = summed(keys, np.ones(len(keys)))
            keys = keys[first]
            slot = np.zeros(len(keys), np.int64)
            if len(hot_keys):
                at = np.minimum(np.searchsorted(hot_keys, keys[:, 0]), len(hot_keys) - 1)
                slots = np.where(hot_keys[at] == keys[:, 0], hot_slots[at], 1).astype(U)
                slot = (tb.mix(keys[:, 1]) % slots).astype(np.int64)
            cols = [pa.array(keys[:, j].astype(np.int64)) for j in range(most)]
            for a in range(0, len(n), 1 << 16):
                yield pa.record_batch([c[a : a + (1 << 16)] for c in [*cols, pa.array(slot), pa.array(n)]], names=[*[f"k{j}" for j in range(most)], "slot", "n"])

        for batch in batches:
            _, langs = language_keys(batch.column("lang"), seed)
            for i, j, raw, offs in tb.slices(batch.column("text")):
                _, _, _, _, key, piece = tokens(raw, offs, langs[i:j], seed)
                if len(key) < 2:
                    continue
                key = np.where(passes(frequent, key), key, U(0))
                pointer = np.flatnonzero((key[:-1] != 0) & (key[1:] != 0) & (piece[:-1] == piece[1:]))
                keys = np.zeros((len(pointer), most), U)
                keys[:, 0], keys[:, 1] = key[pointer], key[pointer + 1]
                for d in range(2, most):
                    at = np.minimum(pointer + d, len(key) - 1)
                    go = (pointer + d < len(key)) & (piece[at] == piece[pointer]) & (keys[:, d - 1] != 0)
                    keys[:, d] = np.where(go, key[at], U(0))
                held.append(keys)
                size += len(keys)
                if size > HELD:
                    yield from out()
                    held, size = [], 0
        if size:
            yield from out()

    return run


def extend(cols: list[np.ndarray], n: np.ndarray, lo: int, hi: int, depth: int, least: int, out: list) -> None:
    """Grows the phrase that rows lo to hi share in their first ``depth`` words; ``out`` gets (length, a row of it, occurrences)."""
    if depth == len(cols):
        return
    col = cols[depth][lo:hi]
    first = np.flatnonzero(np.concatenate(([True], col[1:] != col[:-1])))
    total = np.add.reduceat(n[lo:hi], first)
    last = np.append(first[1:], hi - lo)
    for k in np.flatnonzero((total >= least) & (col[first] != 0)):
        out.append((depth + 1, lo + first[k], total[k]))
        extend(cols, n, lo + int(first[k]), lo + int(last[k]), depth + 1, least, out)


def grown(most: int, least: int):
    """Phrases with ``least`` occurrences from sorted pointers. What is held over to the next batch is the last pair's run, added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f"k{j}" for j in range(most)]
        left = None

        def grow(rows):
            cols, n, out = list(rows[:, :most].T), rows[:, most], []
            prefix = np.flatnonzero(np.concatenate(([True], cols[0][1:] != cols[0][:-1])))
            for lo, hi in zip(prefix.tolist(), [*prefix[1:].tolist(), len(n)]):
                extend(cols, n, lo, hi, 1, least, out)
            if out:
                size, at, total = (np.array(v) for v in zip(*out))
                found = [np.where(j < size, rows[at, j], 0) for j in range(most)]
                yield pa.record_batch([pa.array(size.astype(np.int32)), *[pa.array(c) for c in found], pa.array(total)], names=["size", *names, "a"])

        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy() for c in [*names, "n"]], axis=1)
            rows = rows if left is None else np.concatenate((left, rows))
            if not len(rows):
                continue
            same = (rows[:, 0] == rows[-1, 0]) & (rows[:, 1] == rows[-1, 1])
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:
                yield from grow(rows[:cut])
            left = rows[cut:]
            first = np.flatnonzero(np.concatenate(([True], (left[1:, :most] != left[:-1, :most]).any(axis=1))))
            total = np.add.reduceat(left[:, most], first)
            left = left[first]
            left[:, most] = total
        if left is not None and len(left):
            yield from grow(left)

    return run


def phrases(docs: DataFrame, words: DataFrame, seed: int, most: int, least: int) -> DataFrame:
    """``size, k0, k1, ..., a`` of the phrases of 2 to ``most`` words with ``least`` occurrences; unused keys are 0."""
    sc = docs.sparkSession.sparkContext
    total = words.where("key is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    part = max(1, total // HOT_PARTS)
    hot = sorted((int(r.key) % (1 << 64), -(-r.n // part)) for r in words.where(F.col("key").isNotNull() & (F.col("n") > part)).select("key", "n").collect())  # HOT_PARTS at most
    hot = np.array([k for k, _ in hot], U), np.array([s for _, s in hot], np.int64)
    keys = [f"k{j}" for j in range(most)]
    rows = docs.mapInArrow(projected(sc.broadcast(frequent_filter(words)), hot, most, seed), ", ".join(f"{k} long" for k in [*keys, "slot", "n"]))
    rows = rows.repartition("k0", "slot").select(*keys, "n").sortWithinPartitions(*keys)
    return rows.mapInArrow(grown(most, least), "size int, " + ", ".join(f"{k} long" for k in [*keys, "a"]))


def _part(keys: list[str], start: int, stop: int) -> list[Column]:
    """The phrase's words start to stop as keys, 0 after them."""
    return [F.col(keys[start + j]) if start + j < stop else F.lit(0).cast("long") for j in range(len(keys))]


def collocations(docs: DataFrame, most: int = MAX_WORDS, least: int = LEAST, absorbed: int = ABSORBED_PERCENT, top: int = TOP, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's ``top`` phrases.

    A-Z are lower-cased; pieces end at ``[.,;:!?]`` and line ends, words at blanks. A
    phrase scores by the worst of its cuts in two, floor(10**6 * a**2 / (l * r)), ties to
    the first; it goes if a longer phrase that holds it has ``absorbed`` percent of its
    occurrences. Null text has no words, null language is ``und``; an empty table has no
    phrases. Repeated rows count as often as they come. Other columns are not read. The
    products are decimals of 38 digits: exact to 10**16 occurrences of a phrase.
    """
    docs = docs.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    words, seed = word_table(docs, least)
    keys = [f"k{j}" for j in range(most)]
    found = written(phrases(docs, words, seed, most, least))
    known = words.where("key is not null")
    counts = known.select(*[F.col("key").alias("k0")] + [F.lit(0).cast("long").alias(k) for k in keys[1:]], F.col("n").alias("f")).unionByName(found.select(*keys, F.col("a").alias("f")))

    def with_count(df: DataFrame, part: str, name: str) -> DataFrame:
        got = counts.select(F.struct(*keys).alias(part), F.col("f").alias(name))
        return df.join(got, part)

    # every cut of every phrase; both parts are frequent, since the phrase is
    cuts = None
    for size in range(2, most + 1):
        for k in range(1, size):
            named = [c.alias(n) for c, n in zip(_part(keys, 0, k), keys)], [c.alias(n) for c, n in zip(_part(keys, k, size), keys)]
            one = found.where(F.col("size") == size).select("size", *keys, "a", F.lit(k).alias("cut"), F.struct(*named[0]).alias("left"), F.struct(*named[1]).alias("right"))
            cuts = one if cuts is None else cuts.unionByName(one)
    cuts = with_count(with_count(cuts, "left", "l"), "right", "r")
    square = "cast(a as decimal(16,0)) * cast(a as decimal(16,0)) * cast(1000000 as decimal(7,0))"
    score = F.expr(f"({square}) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = cuts.groupBy("size", *keys, "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("b"))

    # what a longer phrase takes with it
    inner = None
    for size in range(3, most + 1):
        for part in range(2, size):
            for start in range(size - part + 1):
                one = found.where(F.col("size") == size).select(*[c.alias(n) for c, n in zip(_part(keys, start, start + part), keys)], "a")
                inner = one if inner is None else inner.unionByName(one)
    kept = best
    if inner is not None:
        longer = inner.groupBy(*keys).agg(F.max("a").alias("longer"))
        kept = best.join(longer, keys, "left").where(f"longer is null or 100 * cast(longer as decimal(20,0)) < {absorbed} * cast(a as decimal(20,0))")
    for j, k in enumerate(keys):
        one = known.select(F.col("key").alias(k), F.col("word").alias(f"w{j}"), *([F.col("lang")] if j == 0 else []))
        kept = kept.join(one, k, "inner" if j < 2 else "left")
    rows = kept.select("lang", F.concat_ws(" ", *[f"w{j}" for j in range(most)]).alias("phrase"), "a", "b.l", "b.r", "b.score")
    return _ranked(rows, top).join(F.broadcast(words.where("key is null").select("lang", "n")), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")  # a row a language


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language with ``rank``; ranked in slots first, so that a task has RANK_SLOTS * top rows of a language at most."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    some = rows.withColumn("slot", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SLOTS)))
    some = some.withColumn("place", F.row_number().over(Window.partitionBy("lang", "slot").orderBy(*order))).where(F.col("place") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_CLEAN = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: SQL of the query.
ORACLE = f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_CLEAN}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
runs AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (SELECT lang, w[i:i + k - 1] AS p FROM runs, range(1, {MAX_WORDS + 1}) s(k), unnest(range(1, len(w) - k + 2)) t(i)),
f AS (SELECT lang, p, count(*) AS f FROM grams GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE len(p) = 1 GROUP BY lang),
cand AS (SELECT lang, p, f AS a FROM f WHERE len(p) > 1 AND f >= {LEAST}),
cuts AS (SELECT c.lang, c.p, c.a, k, x.f AS l, y.f AS r, CAST(1000000::HUGEINT * c.a * c.a // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cand c, range(1, {MAX_WORDS}) s(k) JOIN f x ON x.lang = c.lang AND x.p = c.p[1:k] JOIN f y ON y.lang = c.lang AND y.p = c.p[k + 1:] WHERE k < len(c.p)),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_parts AS (SELECT lang, p[i:i + k - 1] AS p, max(a) AS longer FROM cand, range(2, {MAX_WORDS}) s(k), unnest(range(1, len(p) - k + 2)) t(i) WHERE k < len(p) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inner_parts i ON i.lang = b.lang AND i.p = b.p WHERE i.longer IS NULL OR 100 * i.longer < {ABSORBED_PERCENT} * b.a),
placed AS (SELECT *, array_to_string(p, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM placed JOIN total USING (lang) WHERE rank <= {TOP}"""
