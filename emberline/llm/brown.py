"""Language-model scoring with Brown class-based bigrams.

Exchange clustering assigns words to classes so that the average mutual information of
adjacent classes grows. Frequent words come first, each a unit of its own; meanwhile all
others are in TAILS tail units by their last two bytes. Then every far word, one that has
LEAST occurrences or more and is no unit, moves from its tail's class to the best one by its
own counts with the classes around it. Words with fewer stay in their tail, which tells what
is to be expected of words never seen. A text's probability is a product of class
transitions, emissions within classes and, within a tail, word emissions, each smoothed.

Counts, neighbours and classes of far words stay in tables, which are joined to the tokens.
Only what a share of the corpus bounds is sent to the executors: a word with at least 1/n of
all tokens is one of at most n words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.llm import textbytes as tb
from emberline.llm.lineage import discard, written

CLASSES, ROUNDS = 64, 6
TAILS = 32
#: Turns in which half of the far words may move.
FAR_ROUNDS = 2
#: Words of so many occurrences have a class of their own, however large the corpus.
LEAST = 2
#: Words with at least one of so many tokens are units, whose counts and classes are at hand.
UNIT_SHARE = 200_000
#: Of far words, those with at least one of UNIT_SHARE * NEAR tokens are scored at hand, like units.
NEAR = 10
#: Weight of the class unigram in a transition.
PRIOR = 4.0
#: Distinct keys that a task gathers before it passes them on.
HELD = 2_000_000
#: Cells of units by classes that a task holds as an array.
DENSE = 1 << 23
#: Words whose moves are sought at once.
CHUNK = 250
#: The place of a far word: SIDE * (1 + class before) + 1 + class after, 0 where there is a far neighbour; or that it follows itself; or its class, added to HOME.
SIDE, SELF, HOME = 256, 1 << 16, 1 << 17
U = tb.U


def word_keys(text: np.ndarray, offs: np.ndarray) -> tb.Words:
    """Words, folded, whose keys hold their tail unit in the low bits."""
    w = tb.words(text, offs, lower=True)
    low = tb.LOWER[text]
    last = low[w.end - 1].astype(U)
    before = np.where(w.end - w.start > 1, low[np.maximum(w.end - 2, 0)], 0).astype(U)
    tail = tb.mix(last * U(257) + before) % U(TAILS)
    return w._replace(key=w.key & ~U(TAILS - 1) | tail)


class Tally:
    """Counts of keys, a bounded number of which is held."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        if len(keys):
            found = np.unique(keys, return_counts=True)
            self.parts.append(found)
            self.size += len(found[0])

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        key, at = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        n = np.bincount(at, weights=np.concatenate([n for _, n in self.parts]), minlength=len(key)).astype(np.int64)
        self.parts, self.size = [(key, n)], len(key)
        return key, n


def tallied(batches: Iterator[pa.RecordBatch], keys_of) -> Iterator[pa.RecordBatch]:
    tally, limit = Tally(), 2 * HELD
    for batch in batches:
        for _, _, text, offs in tb.slices(batch.column("_text")):
            tally.add(keys_of(text, offs))
            if tally.size > limit:
                tally.merged()
                if tally.size > HELD:
                    yield _pairs(tally)
                    tally = Tally()
    tally.merged()
    yield _pairs(tally)


def _pairs(tally: Tally) -> pa.RecordBatch:
    key, n = tally.merged()
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["key", "n"])


class Units(NamedTuple):
    """Sorted keys of the unit words. Units are numbered: these, then the tails, then the end."""

    key: np.ndarray

    @property
    def end(self) -> int:
        return len(self.key) + TAILS

    def of(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.key, keys)
        found = np.append(self.key, U(0))[at] == keys
        found &= at < len(self.key)
        return np.where(found, at, len(self.key) + (keys & U(TAILS - 1)).astype(np.int64))

    def sequence(self, w: tb.Words, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, unit before and unit of each token, each row's end included."""
        unit = self.of(w.key)
        first = np.searchsorted(w.row, np.arange(rows))
        row = np.insert(w.row, np.append(first[1:], len(w.row)), np.arange(rows))
        now = np.insert(unit, np.append(first[1:], len(unit)), self.end)
        before = np.concatenate(([self.end], now[:-1]))
        return row, before, now


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def best_moves(matrix: np.ndarray, home: np.ndarray, right: np.ndarray, left: np.ndarray, self_n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each unit the class that raises the objective most, and by how much.

    matrix: counts of adjacent classes; right, left: each unit's counts with the classes
    after and before it. The objective is sum xlogx(cells) - sum xlogx(row and column sums).
    """
    n, c = right.shape
    best, gain = np.empty(n, np.int64), np.empty(n)
    for i in range(n):
        g, r, l, s = int(home[i]), right[i], left[i], self_n[i]  # noqa: E741
        m = matrix.copy()
        m[g] -= r
        m[:, g] -= l
        m[g, g] += s
        r, l = r.copy(), l.copy()  # noqa: E741
        r[g] -= s
        l[g] -= s
        out, into = r.sum() + s, l.sum() + s
        rows, cols = m.sum(1) + l, m.sum(0) + r  # these parts come back wherever the unit goes
        # row and column k once the unit is in class k; the cell (k, k) is counted in the row
        row = xlogx(m + r[None, :]) - xlogx(m)
        col = xlogx(m.T + l[None, :]) - xlogx(m.T)
        d = np.diagonal(m)
        change = row.sum(1) - np.diagonal(row) + col.sum(1) - np.diagonal(col) + xlogx(d + r + l + s) - xlogx(d)
        change -= xlogx(rows + out) - xlogx(rows) + xlogx(cols + into) - xlogx(cols)
        k = int(np.argmax(change))
        best[i], gain[i] = k, change[k] - change[g]
    return best, gain


def objective(matrix: np.ndarray) -> float:
    return float(xlogx(matrix).sum() - xlogx(matrix.sum(0)).sum() - xlogx(matrix.sum(1)).sum())


def class_matrix(pairs: DataFrame, classes: np.ndarray, units: int) -> np.ndarray:
    def run(batches):
        total = np.zeros(CLASSES * CLASSES)
        for b in batches:
            key, n = np.asarray(b.column("key")), np.asarray(b.column("n"))
            total += np.bincount(classes[key // units] * CLASSES + classes[key % units], weights=n, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at].astype(np.int64))], names=["cell", "n"])

    out = np.zeros(CLASSES * CLASSES)
    for r in pairs.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # CLASSES**2 rows at most
        out[r.cell] = r.n
    return out.reshape(CLASSES, CLASSES)


def proposed(pairs: DataFrame, classes: np.ndarray, units: int, matrix: np.ndarray, turn: int, turns: int):
    """(unit, class, gain) of the units whose turn it is; at most as many rows as units."""

    width = 2 * CLASSES + 1

    def summed(held):
        i, j, n = (np.concatenate(c) for c in zip(*held))
        places = [(i * width + classes[j])[i % turns == turn], (j * width + CLASSES + classes[i])[j % turns == turn], (i * width + 2 * CLASSES)[(i == j) & (i % turns == turn)]]
        counts = [n[i % turns == turn], n[j % turns == turn], n[(i == j) & (i % turns == turn)]]
        if units * width <= DENSE:
            total = np.zeros(units * width)
            for p, q in zip(places, counts):
                total += np.bincount(p, weights=q, minlength=len(total))
            place = np.flatnonzero(total)
            total = total[place].astype(np.int64)
        else:
            place, at = np.unique(np.concatenate(places), return_inverse=True)
            total = np.bincount(at, weights=np.concatenate(counts), minlength=len(place)).astype(np.int64)
        for a in range(0, len(place), 200_000):
            p = place[a : a + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array(p // width), pa.array(p % width), pa.array(total[a : a + 200_000])], names=["unit", "slot", "n"])

    def contexts(batches):
        held, rows = [], 0
        for b in batches:
            key, n = np.asarray(b.column("key")), np.asarray(b.column("n"))
            held.append((key // units, key % units, n))
            rows += len(n)
            if rows > HELD:
                yield from summed(held)
                held, rows = [], 0
        if held:
            yield from summed(held)

    def moves(batches):
        parts = [tuple(np.asarray(b.column(c)) for c in ("unit", "slot", "n")) for b in batches]
        if not parts:
            return
        unit, slot, n = (np.concatenate(c) for c in zip(*parts))
        which, at = np.unique(unit, return_inverse=True)
        wide = np.bincount(at * width + slot, weights=n, minlength=len(which) * width).reshape(-1, width)
        best, gain = np.empty(len(which), np.int64), np.empty(len(which))
        for a in range(0, len(which), CHUNK):
            home = classes[which[a : a + CHUNK]]
            change = far_moves(matrix, home, wide[a : a + CHUNK])
            best[a : a + CHUNK] = change.argmax(1)
            gain[a : a + CHUNK] = change.max(1) - change[np.arange(len(home)), home]
        yield pa.RecordBatch.from_arrays([pa.array(which), pa.array(best), pa.array(gain)], names=["unit", "class", "gain"])

    rows = pairs.mapInArrow(contexts, "unit long, slot long, n long").repartition("unit").mapInArrow(moves, "unit long, class long, gain double")
    return rows.where("gain > 0").collect()


def exchange(pairs: DataFrame, weight: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the units and the counts of adjacent classes. The end has class 0 alone."""
    units = len(weight)
    classes = np.zeros(units, np.int64)
    classes[np.argsort(-weight[:-1], kind="stable")] = np.arange(units - 1) % (CLASSES - 1) + 1
    matrix = class_matrix(pairs, classes, units)
    best = classes, matrix
    turns = 2
    for k in range(rounds):
        new = classes.copy()
        for r in proposed(pairs, classes, units, matrix, k % turns, turns):
            if r.unit != units - 1 and r["class"] != 0:
                new[r.unit] = r["class"]
        classes, matrix = new, class_matrix(pairs, new, units)
        if objective(matrix) > objective(best[1]):
            best = classes, matrix
    return best


def far_moves(matrix: np.ndarray, home: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """For each word and class what the objective gains if the word, taken out, joins the class.

    As ``best_moves``, but only cells that a word's counts change are looked at. wide: a
    row for each word, its counts with the classes after and before it and with itself.
    """
    n, c = len(home), len(matrix)
    right, left, own = wide[:, :c], wide[:, c : 2 * c], wide[:, 2 * c]
    each = np.arange(n)
    r, l = right.copy(), left.copy()  # noqa: E741
    r[each, home] -= own
    l[each, home] -= own
    out, into = r.sum(1) + own, l.sum(1) + own
    rows, cols = np.tile(matrix.sum(1), (n, 1)), np.tile(matrix.sum(0), (n, 1))
    rows[each, home] -= out
    cols[each, home] -= into
    d = np.tile(np.diagonal(matrix), (n, 1))
    d[each, home] -= right[each, home] + left[each, home] - own
    change = xlogx(d + r + l + own[:, None]) - xlogx(d) - xlogx(rows + out[:, None]) + xlogx(rows) - xlogx(cols + into[:, None]) + xlogx(cols)
    for m, some, others, mine in ((matrix.T, r, left, right), (matrix, l, right, left)):
        w, j = np.nonzero(some)
        if not len(w):
            continue
        cell, at = m[j], np.arange(len(w))
        cell[at, home[w]] -= mine[w, j]
        same = np.flatnonzero(home[w] == j)
        cell[same] -= others[w[same]]
        cell[same, j[same]] += own[w[same]]
        more = xlogx(cell + some[w, j][:, None]) - xlogx(cell)
        more[at, j] = 0  # the diagonal, which is counted above
        first = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
        change[w[first]] += np.add.reduceat(more, first, axis=0)
    return change


def _moved(matrix: np.ndarray, tails: np.ndarray, turn: int):
    """Rows (w, place, n) in order of w to a row for each far word, and one for each cell of its counts with units.

    A word's row has its class now and, if it is its turn, the best one; a cell's row, whose key is null, is
    for the class before and after, ``home`` being the cell of the former classes.
    """
    width = 2 * CLASSES + 1

    def solve(word, place, n):
        first = np.append(True, word[1:] != word[:-1])[: len(word)]
        which, at = word[first], np.cumsum(first) - 1
        home = tails[which & (TAILS - 1)]
        told = place >= HOME
        home[at[told]] = place[told] - HOME
        usual = place < SELF
        before, after = np.where(usual, place // SIDE - 1, -1), np.where(usual, place % SIDE - 1, -1)
        after_home, before_home = after >= CLASSES, before >= CLASSES  # a far neighbour's class, which is none of the cells
        right, left = after % CLASSES, before % CLASSES
        total = np.rint(np.bincount(at[after >= 0], weights=n[after >= 0], minlength=len(which))).astype(np.int64)
        best = home.copy()
        may = (total >= LEAST) & ((which // TAILS) % 2 == turn)  # the others stay, so nothing is sought for them
        movers, mine = np.flatnonzero(may), np.flatnonzero(may[at])
        mover = (np.cumsum(may) - 1)[at[mine]]
        for a in range(0, len(movers), CHUNK):
            some = movers[a : a + CHUNK]
            rows = mine[slice(*np.searchsorted(mover, [a, a + CHUNK]))]
            i = np.searchsorted(some, at[rows])
            r, l, s = after[rows] >= 0, before[rows] >= 0, place[rows] == SELF  # noqa: E741
            p = [(i * width + right[rows])[r], (i * width + CLASSES + left[rows])[l], (i * width + 2 * CLASSES)[s]]
            k = n[rows]
            wide = np.bincount(np.concatenate(p), weights=np.concatenate((k[r], k[l], k[s])), minlength=len(some) * width).reshape(len(some), width)
            change = far_moves(matrix, home[some], wide)
            change[:, 0] = -np.inf  # the end's own
            # of equal ones the class it has
            change[np.arange(len(some)), home[some]] += 1e-9
            best[some] = change.argmax(1)
        cells = []
        for of in (home, best):
            c = of[at]
            x, y = (after >= 0) & ~after_home, (before >= 0) & ~before_home
            cell = np.concatenate(((c * CLASSES + right)[x], (left * CLASSES + c)[y]))
            cells.append(np.bincount(cell, weights=np.concatenate((n[x], n[y])), minlength=CLASSES**2))
        return which, home, best, total, cells

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "home", "class", "n"]
        cells = [np.zeros(CLASSES**2), np.zeros(CLASSES**2)]
        held, rows = [], 0

        def ready(last):
            word, place, n = (np.concatenate(c) for c in zip(*held))
            end = len(word) if last else int(np.searchsorted(word, word[-1]))
            return (word[:end], place[:end], n[:end]), [(word[end:], place[end:], n[end:])]

        def emit(part):
            which, home, best, total, more = solve(*part)
            for c, m in zip(cells, more):
                c += m
            return pa.RecordBatch.from_arrays([pa.array(which), pa.array(home), pa.array(best), pa.array(total)], names=names)

        for b in batches:
            held.append(tuple(np.asarray(b.column(c)).astype(np.int64) for c in ("w", "place", "n")))
            rows += b.num_rows
            if rows > HELD // 4:
                part, held = ready(False)
                rows = len(held[0][0])
                if len(part[0]):
                    yield emit(part)
        if held and sum(len(w) for w, _, _ in held):
            part, held = ready(True)
            yield emit(part)
        for k, of in enumerate(cells):
            at = np.flatnonzero(of)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.int64()), pa.array(np.full(len(at), k)), pa.array(at), pa.array(of[at].astype(np.int64))], names=names)

    return run


def far_classes(links: DataFrame, known: np.ndarray, matrix: np.ndarray, tails: np.ndarray, rounds: int) -> tuple[DataFrame, np.ndarray]:
    """``key, class, n`` of all far words, and the counts of adjacent classes.

    links: ``a, b, place, n``, where b is null for a far word's counts with units, or the far
    word that follows a. known: counts of adjacent classes of units alone; matrix: of all, far
    words being in their tails' classes. Turns in which the objective does not grow do not count.
    Words with less than LEAST occurrences are among them, in their tails' classes.
    """
    by_unit, pairs = links.where("b is null").select(F.col("a").alias("w"), "place", "n"), links.where("b is not null").select("a", "b", "n")
    of_tail = F.lit([int(t) for t in tails])
    tail = lambda c: F.get(of_tail, F.col(c).bitwiseAND(TAILS - 1).cast("int"))
    far = 1 + CLASSES  # far neighbours' classes are told from units'
    both = pairs.select("a", "b", "n", tail("a").alias("of_a"), tail("b").alias("of_b"))
    best, homes, of_best, last = None, None, None, None
    for k in range(max(1, rounds)):
        parts = by_unit.unionByName(both.select(F.col("a").alias("w"), (F.col("of_b") + far).cast("int").alias("place"), "n"))
        parts = parts.unionByName(both.select(F.col("b").alias("w"), ((F.col("of_a") + far) * SIDE).cast("int").alias("place"), "n"))
        parts = parts.unionByName(both.where("a = b").select(F.col("a").alias("w"), F.lit(SELF).alias("place"), "n"))
        if homes is not None:
            parts = parts.unionByName(homes.select(F.col("key").alias("w"), (F.col("class") + HOME).cast("int").alias("place"), F.lit(0).cast("long").alias("n")))
        found = written(parts.repartition("w").sortWithinPartitions("w").mapInArrow(_moved(matrix, tails, k % 2), "key long, home long, class long, n long"))
        new = found.where("key is not null").select("key", "class", "n")
        if best is None:
            best, of_best = found.where("key is not null").select("key", F.col("home").alias("class"), "n"), found
        a, b = (new.select(F.col("key").alias(c), F.col("class").cast("int").alias(f"of_{c}")) for c in "ab")
        moved = written(pairs.join(a, "a").join(b, "b").select("a", "b", "n", "of_a", "of_b"))
        total = known.copy()
        cells = found.where("key is null and home = 1").select(F.col("class").alias("cell"), "n").unionByName(moved.select((F.col("of_a") * CLASSES + F.col("of_b")).cast("long").alias("cell"), "n"))
        for r in cells.groupBy("cell").agg(F.sum("n").alias("n")).collect():  # CLASSES**2 rows at most
            total[r.cell // CLASSES, r.cell % CLASSES] += r.n
        grows = objective(total) > objective(matrix)
        for old in [last if grows else moved, of_best if grows else found]:
            if old is not None and old is not (found if grows else of_best):
                discard(old)
        if grows:
            best, homes, both, matrix, of_best, last = new, new, moved, total, found, moved
    if last is not None:
        discard(last)
    return best, matrix


class Model(NamedTuple):
    """All that scoring needs at hand; its size is bounded by the share above."""

    units: Units
    classes: np.ndarray  # of units, tails and the end
    transition: np.ndarray  # log10, by class before and class
    emission: np.ndarray  # log10, of a unit within its class
    spread: np.ndarray  # log10 of what a far word's count and one is divided by, by class
    in_tail: np.ndarray  # log10 of what goes with the count and one of a word in a tail, by tail
    count: np.ndarray  # of units
    end_count: int
    tokens: int
    types: int


def fit(train: DataFrame, text_col: str = "text", rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model and the table (key, n) of all training words."""
    return fitted(train, text_col, rounds)[:2]


def fitted(train: DataFrame, text_col: str = "text", rounds: int = ROUNDS) -> tuple[Model, DataFrame, DataFrame]:
    """The model, the table (key, n) of all training words and that of the far ones (key, class, n)."""
    texts = train.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    counts = texts.mapInArrow(lambda batches: tallied(batches, lambda t, o: word_keys(t, o).key), "key long, n long")
    counts = written(counts.groupBy("key").agg(F.sum("n").alias("n")))
    docs = texts.count()
    total, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    tokens, types = total + docs, types + (docs > 0)
    known = counts.where((F.col("n") * UNIT_SHARE >= tokens) & (F.col("n") >= LEAST)).toPandas()  # UNIT_SHARE rows at most
    key, n = known["key"].to_numpy(np.int64).view(U), known["n"].to_numpy(np.int64)
    order = np.argsort(key)
    key, n = key[order], n[order]
    units = Units(key)
    tails = np.zeros(TAILS)
    for r in counts.groupBy(F.col("key").bitwiseAND(TAILS - 1).alias("tail")).agg(F.sum("n").alias("n")).collect():
        tails[r.tail] = r.n
    tails -= np.bincount((key & U(TAILS - 1)).astype(np.int64), weights=n, minlength=TAILS)
    size = units.end + 1

    def adjacent(text, offs):
        _, before, now = units.sequence(word_keys(text, offs), len(offs) - 1)
        return before * size + now

    pairs = texts.mapInArrow(lambda batches: tallied(batches, adjacent), "key long, n long")
    pairs = written(pairs.groupBy("key").agg(F.sum("n").alias("n")))
    classes, matrix = exchange(pairs, np.concatenate((n, tails, [docs])), rounds)
    is_tail = lambda unit: (unit >= len(key)) & (unit < units.end)
    first, second = F.expr(f"key div {size}"), F.col("key") % size
    alone = class_matrix(pairs.where(~is_tail(first) & ~is_tail(second)), classes, size)
    discard(pairs)

    def neighbours(batches):
        """a, b, place of each far word with a unit beside it, and of each two far words."""
        for batch in batches:
            for _, _, text, offs in tb.slices(batch.column("_text")):
                w = word_keys(text, offs)
                before, now, words, far = beside(units, classes, w, len(offs) - 1)[1:]
                i = np.flatnonzero(far)
                left = np.where(far[i - 1] & (i > 0), 0, 1 + classes[before[i]])
                right = np.where(far[i + 1], 0, 1 + classes[now[i + 1]])
                x = i[(left > 0) | (right > 0)]
                place = (left * SIDE + right)[(left > 0) | (right > 0)]
                y = i[far[i + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words[np.concatenate((x, y))].view(np.int64)), pa.concat_arrays([pa.nulls(len(x), pa.int64()), pa.array(words[y + 1].view(np.int64))]), pa.array(np.concatenate((place, np.zeros(len(y), np.int64))).astype(np.int32))],
                    names=["a", "b", "place"],
                )

    links = texts.mapInArrow(neighbours, "a long, b long, place int")
    links = written(links.groupBy("a", "b", "place").agg(F.count("*").alias("n")))
    far, matrix = far_classes(links, alone, matrix, classes[len(key) : units.end], min(rounds, FAR_ROUNDS))
    discard(links)
    in_class = matrix.sum(0)
    members = np.bincount(classes, minlength=CLASSES)
    for r in far.where(F.col("n") >= LEAST).groupBy("class").agg(F.count("*").alias("v")).collect():  # CLASSES rows at most
        members[r["class"]] += r.v
    left = np.zeros((TAILS, 2))
    for r in counts.where(F.col("n") < LEAST).groupBy(F.col("key").bitwiseAND(TAILS - 1).alias("tail")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        left[r.tail] = r.n, r.v
    unigram = (in_class + 1) / (in_class.sum() + CLASSES)
    transition = (matrix + PRIOR * unigram) / (matrix.sum(1, keepdims=True) + PRIOR)
    spread = np.log10(np.maximum(in_class + members, 1))
    emission = np.log10(np.concatenate((n, left[:, 0], [docs])) + 1) - spread[classes]
    in_tail = emission[len(key) : units.end] - np.log10(left.sum(1) + 1)
    return Model(units, classes, np.log10(transition), emission, spread, in_tail, n, docs, tokens, types), counts, far


def at_hand(model: Model, far: DataFrame) -> tuple[Model, DataFrame]:
    """The model with the commoner far words, by class and count, among its units, and the other far words.

    A word's score is the same by either way; it only needs no join.
    """
    common = (F.col("n") * UNIT_SHARE * NEAR >= model.tokens) & (F.col("n") >= LEAST)
    found = far.where(common).toPandas()  # UNIT_SHARE * NEAR rows at most
    more, of, n = (found[c].to_numpy(np.int64) for c in ("key", "class", "n"))
    key, old = np.concatenate((model.units.key, more.view(U))), len(model.units.key)
    order = np.argsort(key)
    merged = lambda a, b: np.concatenate((np.concatenate((a[:old], b))[order], a[old:]))
    emission = np.log10(n + 1) - model.spread[of]
    units = Units(key[order])
    return model._replace(units=units, classes=merged(model.classes, of), emission=merged(model.emission, emission), count=np.concatenate((model.count, n))[order]), far.where(~common)


def beside(units: Units, classes: np.ndarray, w: tb.Words, rows: int):
    """Row, unit before, unit and key of each token, each row's end included, and whether it is a far word."""
    row, before, now = units.sequence(w, rows)
    words = np.zeros(len(now), U)
    words[now != units.end] = w.key
    return row, before, now, words, (now >= len(units.key)) & (now != units.end)


PARTS = "row long, id long, held_out boolean, n_tokens long, n_known long, base double, score double, key long, place long"
#: Above the place of a far word by its classes: the pair of far words it is one of, and which.
PAIR = 15


def _scored(model):
    """A row for each text with what is known at hand, and rows for each far word in it: one with its place, one for each far neighbour."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        names = [f.split(" ")[0] for f in PARTS.split(", ")]
        for batch in batches:
            ids = np.asarray(batch.column("row"))
            for i, j, text, offs in tb.slices(batch.column("_text")):
                rows = j - i
                row, before, now, words, far = beside(m.units, m.classes, word_keys(text, offs), rows)
                end = now == m.units.end
                at_hand = ~far
                next_to = np.append(False, far[:-1])
                score = np.where(at_hand, m.emission[now], 0.0)
                score += np.where(far | next_to, 0.0, m.transition[m.classes[before], m.classes[now]])
                base = np.zeros(len(row))
                base[end] = np.log10(m.end_count + 1)
                base[at_hand & ~end] = np.log10(m.count[now[at_hand & ~end]] + 1)
                base -= np.log10(m.tokens + m.types + 1)
                size = np.bincount(row, minlength=rows)
                full = size - np.bincount(row[far], minlength=rows) - (0 if m.end_count else 1)
                f = np.flatnonzero(far)
                left = np.where(next_to[f], 0, 1 + m.classes[before[f]])
                right = np.where(far[f + 1], 0, 1 + m.classes[now[f + 1]])
                one = f[far[f + 1]]  # of far words side by side the first
                which = (one + 1) << (PAIR + 1)
                place = np.concatenate((np.full(rows, -1), left * SIDE + right, which, which | (1 << PAIR)))
                of = np.concatenate((f, one, one + 1))
                k = len(of)
                # a text's own row has a key of its own, so that such rows spread out in the join
                none = pa.nulls(k, pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate((ids[i:j], ids[i:j][row[of]]))),
                        pa.concat_arrays([batch.column("id")[i:j], pa.nulls(k, pa.int64())]),
                        pa.concat_arrays([batch.column("held_out")[i:j], pa.nulls(k, pa.bool_())]),
                        pa.concat_arrays([pa.array(size.astype(np.int64)), pa.nulls(k, pa.int64())]),
                        pa.concat_arrays([pa.array(full.astype(np.int64)), pa.nulls(k, pa.int64())]),
                        pa.concat_arrays([pa.array(np.bincount(row, weights=base, minlength=rows)), none]),
                        pa.concat_arrays([pa.array(np.bincount(row, weights=score, minlength=rows)), none]),
                        pa.array(np.concatenate((tb.mix(ids[i:j].view(U)), words[of])).view(np.int64)),
                        pa.array(place),
                    ],
                    names=names,
                )

    return run


def held_out(id_col: str) -> Column:
    """The seventh of the texts from which nothing is learned."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 7 == 2


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per input row: ``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Scores are log10 probabilities of a text's words and of its end, by the unigram base
    and by the class model. Null and empty texts have the end alone. Rows with a null id
    are learned from; rows that repeat count each. A model of no text scores all alike.
    """
    model, counts, far = fitted(docs.where(~held_out(id_col)), text_col, rounds)
    discard(counts)
    model, far = at_hand(model, far)
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), held_out(id_col).alias("held_out"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    parts = rows.mapInArrow(_scored(spark.sparkContext.broadcast(model)), PARTS)
    tails = F.lit([int(c) for c in model.classes[len(model.units.key) : model.units.end]])
    parts = parts.join(far.select("key", F.col("class").cast("int").alias("found"), F.col("n").alias("c")), "key", "left")
    parts = parts.withColumn("class", F.coalesce("found", F.get(tails, F.col("key").bitwiseAND(TAILS - 1).cast("int"))))
    change = F.split(F.lit(" ".join(map(repr, model.transition.ravel().tolist()))), " ").cast("array<double>")  # folded to a literal
    step = lambda a, b: F.get(change, (a * CLASSES + b).cast("int"))
    before, after = F.floor(F.col("place") / SIDE) - 1, F.col("place") % SIDE - 1
    word, pair = F.col("place").between(0, (1 << PAIR) - 1), F.col("place") >= 1 << PAIR
    count = F.log10(F.coalesce("c", F.lit(0)) + 1)
    fits = F.when(before >= 0, step(before, F.col("class"))).otherwise(0.0) + F.when(after >= 0, step(F.col("class"), after)).otherwise(0.0)
    spread, in_tail = (F.lit([float(x) for x in v]) for v in (model.spread, model.in_tail))
    emitted = count + fits + F.when(F.col("c") >= LEAST, -F.get(spread, F.col("class"))).otherwise(F.get(in_tail, F.col("key").bitwiseAND(TAILS - 1).cast("int")))
    parts = parts.select(
        "row", "id", "held_out", "n_tokens",
        F.when(pair, F.shiftright("place", PAIR + 1)).otherwise(F.lit(0)).alias("pair"),
        F.when(word, F.col("c").isNotNull().cast("long")).otherwise(F.col("n_known")).alias("n_known"),
        F.when(word, count).otherwise(F.col("base")).alias("base"),
        F.when(word, emitted).otherwise(F.col("score")).alias("score"),
        F.when(pair, F.when(F.col("place").bitwiseAND(1 << PAIR) == 0, F.col("class") * CLASSES).otherwise(F.col("class"))).alias("cell"),
    )
    both = parts.groupBy("row", "pair").agg(*[F.max(c).alias(c) for c in ("id", "held_out", "n_tokens")], *[F.sum(c).alias(c) for c in ("n_known", "base", "score", "cell")])
    both = both.withColumn("score", F.when(F.col("pair") > 0, F.get(change, F.col("cell").cast("int"))).otherwise(F.col("score")))
    return (
        both.groupBy("row")
        .agg(
            F.max("id").alias(id_col),
            F.max("held_out").alias("held_out"),
            F.max("n_tokens").alias("n_tokens"),
            F.sum("n_known").alias("n_known"),
            F.lit(int(model.tokens)).cast("long").alias("train_tokens"),
            F.sum("base").alias("base_score"),
            F.sum("score").alias("score"),
        )
        .drop("row")
    )


def op5_brown_lm(spark, sf_dir: str) -> DataFrame:
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
