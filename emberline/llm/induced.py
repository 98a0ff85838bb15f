"""Suffix order and common prefixes of one shard by external induced sorting.

Suffixes are L (greater than their right neighbour) or S (smaller). The leftmost S
suffixes are sorted first, by naming their substrings and sorting the shorter text of
names, recursively while it doesn't fit in memory. From them a priority queue keyed by
first letter induces all L suffixes in ascending order, and from those another induces
all S suffixes in descending order. Each queue entry carries its position and the length
of the prefix that it shares with the entry before it. Entries wait in buckets, which go
to unnamed scratch files of the task when they outgrow the memory allowed, as spilled
sort runs do; the files vanish with the task. So do large arrays of one entry a letter.
Suffixes are handed on letter by letter and never gathered.
"""

from __future__ import annotations

import tempfile
from collections import defaultdict
from collections.abc import Iterator

import numpy as np

#: Bytes of waiting entries that a queue holds in memory.
MEMORY = 128 << 20
#: Names that are sorted in memory by doubling; longer texts of names are sorted by induction.
IN_MEMORY = 8 << 20


class Queue:
    """Entries (position, shared prefix) by first letter, in order of arrival; on disk beyond ``memory`` bytes."""

    def __init__(self, memory: int):
        self.memory, self.held = memory, 0
        self.parts: dict[int, list] = defaultdict(list)
        self.file = None

    def put(self, letter: int, at: np.ndarray, shared: np.ndarray) -> None:
        if len(at):
            self.parts[letter].append((at, shared))
            self.held += at.nbytes + shared.nbytes
            if self.held > self.memory:
                self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()  # noqa: SIM115  without a name: gone when the task ends
        for parts in self.parts.values():
            for k, part in enumerate(parts):
                if part[0] is not None:
                    self.file.seek(0, 2)
                    place = self.file.tell()
                    self.file.write(part[0].tobytes())
                    self.file.write(part[1].tobytes())
                    parts[k] = (None, place, len(part[0]))
        self.held = 0

    def take(self, letter: int) -> tuple[np.ndarray, np.ndarray]:
        at, shared = [], []
        for part in self.parts.pop(letter, ()):
            if part[0] is None:
                _, place, n = part
                self.file.seek(place)
                at.append(np.frombuffer(self.file.read(8 * n), np.int64))
                shared.append(np.frombuffer(self.file.read(2 * n), np.uint16))
            else:
                self.held -= part[0].nbytes + part[1].nbytes
                at.append(part[0])
                shared.append(part[1])
        if not at:
            return np.zeros(0, np.int64), np.zeros(0, np.uint16)
        return np.concatenate(at), np.concatenate(shared)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def roomy(n: int, dtype: type, memory: int) -> np.ndarray:
    """Zeros, in a scratch file of the task where they take more than ``memory`` bytes."""
    if n * np.dtype(dtype).itemsize <= memory:
        return np.zeros(n, dtype)
    with tempfile.TemporaryFile() as file:
        file.truncate(n * np.dtype(dtype).itemsize)
        return np.memmap(file, dtype, "r+")


class Minima:
    """Least values of ranges of an array."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        step = 1
        while 2 * step <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of values[first..last], both included."""
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        if len(self.levels) > 1 and len(first) > 1000:
            return self._from_table(level, first, last)
        out = np.empty(len(first), self.levels[0].dtype)
        for k in np.unique(level):
            some = level == k
            table = self.levels[k]
            out[some] = np.minimum(table[first[some]], table[last[some] + 1 - (1 << int(k))])
        return out

    def _from_table(self, level: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        edge = np.concatenate(([0], np.cumsum([len(x) for x in self.levels])))[:-1]
        table, base = np.concatenate(self.levels), edge[level]
        return np.minimum(table[base + first], table[base + last + 1 - (1 << level.astype(np.int64))])


#: Letters that are looked at together.
BLOCK = 1 << 20


def small_types(text: np.ndarray, memory: int) -> np.ndarray:
    """True where the suffix is smaller than the one that starts a letter later; the empty suffix is the smallest."""
    n = len(text)
    out = roomy(n, bool, memory)
    known = False  # of the place behind the block; the last letter is greater than the end
    for lo in range((n - 1) // BLOCK * BLOCK, -1, -BLOCK):
        hi = min(n, lo + BLOCK)
        rise = np.zeros(hi - lo + 1, np.int8)
        follow = text[lo + 1 : hi + 1].astype(np.int64)
        rise[: len(follow)] = np.sign(follow - text[lo : lo + len(follow)])
        if hi == n:
            rise[hi - lo - 1] = -1
        rise[-1] = 1 if known else -1
        nearest = np.where(rise != 0, np.arange(len(rise)), len(rise))
        nearest = np.minimum.accumulate(nearest[::-1])[::-1]
        out[lo:hi] = rise[nearest[:-1]] > 0
        known = bool(out[lo])
    return out


def doubled(names: np.ndarray, order: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The order of the suffixes of a text of names, by doubling, as ties from ``depth`` names on; and for each
    power of two, from 1, numbers that are equal where so many names are. ``order`` sorts the names and is changed."""
    n = len(names)
    bits = n.bit_length()
    slots, key, h = np.arange(n), names[order], 1
    levels: list[np.ndarray] = []
    rank = np.full(n + depth, -1, np.int32)  # nothing is less than the end
    while True:
        # a group of equal names has the number of its first place; what is alone in its place stays there
        fresh = np.concatenate(([True], key[1:] != key[:-1], [True]))
        edge = np.flatnonzero(fresh)
        rank[order[slots]] = np.repeat(slots[edge[:-1]], np.diff(edge))
        levels.append(rank[:n].copy())
        slots = slots[~(fresh[:-1] & fresh[1:])]
        if not len(slots) or h >= depth:
            return order, levels
        at = order[slots]
        key = rank[at].astype(np.int64) << bits | (rank[at + h] + 1)
        if 2 * bits + len(at).bit_length() <= 63:  # the place fits below the key: sorting values is faster than sorting places
            size = len(at).bit_length()
            key = key << size | np.arange(len(at))
            key.sort()
            inner = key & ((1 << size) - 1)
            key >>= size
            order[slots] = at[inner]
        else:
            inner = np.argsort(key)
            order[slots], key = at[inner], key[inner]
        h *= 2


def _named(text: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal or ordered numbers for equal or ordered substrings, and the order that sorts them; one that ends counts as greater than one that goes on."""
    pad = int(text.max()) + 2
    bits = pad.bit_length()
    take = max(1, 62 // bits)
    n = len(text)

    def word(at: np.ndarray, rest: np.ndarray, done: int) -> np.ndarray:
        out = np.zeros(len(at), np.int64)
        for k in range(done, done + take):
            letter = np.where(at + k < n, text[np.minimum(at + k, n - 1)] + 1, 0)  # nothing is less than the end
            out = out << bits | np.where(k < rest, letter, pad)
        return out

    key = word(start, size, 0)
    order = np.argsort(key)  # equal ones in any order: they get one name
    fresh = np.concatenate(([True], np.diff(key[order]) != 0))
    done = take
    while True:
        group = np.cumsum(fresh) - 1
        count = np.bincount(group)
        tied = np.flatnonzero((count[group] > 1) & (size[order] > done))
        if not len(tied):
            rank = np.empty(len(start), np.int64)
            rank[order] = group
            return rank, order
        # members of a group that end here stay at its end, as the greater ones
        whole = np.flatnonzero(np.isin(group, np.unique(group[tied])))
        at = order[whole]
        key = word(start[at], size[at], done)
        inner = np.lexsort((key, group[whole]))
        order[whole] = at[inner]
        g, key = group[whole][inner], key[inner]
        fresh[whole] = np.concatenate(([True], (np.diff(g) != 0) | (np.diff(key) != 0)))
        done += take


FIELD, FIELDS = 9, 7


def packed(text: np.ndarray, depth: int, memory: int) -> np.ndarray | None:
    """At each place the next FIELDS letters as one number, for texts of up to 2**FIELD - 1 letters."""
    if int(text.max()) + 1 >= 1 << FIELD:
        return None
    n = len(text)
    out = roomy(n + depth + FIELDS, np.int64, memory)
    for lo in range(0, n, BLOCK):
        hi = min(n, lo + BLOCK)
        letters = text[lo : hi + FIELDS].astype(np.int64) + 1  # 0 is beyond the end
        for k in range(min(FIELDS, len(letters))):
            some = letters[k : k + hi - lo]
            out[lo : lo + len(some)] |= some << FIELD * (FIELDS - 1 - k)
    return out


def common(text: np.ndarray, words: np.ndarray | None, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, up to ``depth``."""
    n = len(text)
    out = np.zeros(len(a), np.uint16)
    live = np.arange(len(a))
    done = 0
    while len(live) and done < depth:
        x, y = a[live] + done, b[live] + done
        if words is not None:
            differ = words[x] ^ words[y]
            same, step = differ == 0, FIELDS
            ends = np.flatnonzero(~same)
            rest, got = differ[ends], np.zeros(len(ends), np.uint16)
            for k in range(1, FIELDS):
                got += rest >> FIELD * (FIELDS - k) == 0
            out[live[ends]] = done + got
        else:
            same, step = (x < n) & (y < n), 1
            same &= text[np.minimum(x, n - 1)] == text[np.minimum(y, n - 1)]
            out[live[~same]] = done
        live = live[same]
        done += step
    out[live] = depth
    return np.minimum(out, depth).astype(np.uint16)


def starred_order(text: np.ndarray, words: np.ndarray | None, small: np.ndarray, depth: int, memory: int, in_memory: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the leftmost S suffixes in ascending order, and the prefix that each shares with the one before it."""
    star = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    shared = np.zeros(len(star), np.uint16)
    if len(star) < 2:
        return star, shared
    size = np.diff(np.concatenate((star, [len(text)]))) + 1  # with the letter at which the next one starts, or the end
    names, order = _named(text, star, size)
    if names.max() == len(star) - 1:
        found = star[order]
    elif len(names) <= in_memory:
        order, levels = doubled(names, order, depth // 2 + 2)  # a name takes two letters at least
        a, b = order[1:].copy(), order[:-1].copy()
        for k in range(len(levels) - 1, -1, -1):  # past all names that are equal
            same = (levels[k][a] == levels[k][b]).astype(np.int64) << k
            a += same
            b += same
        found = star[order]
        past = star[a] - found[1:]
        open_ = np.flatnonzero(past < depth)
        shared[1:] = depth
        shared[1 + open_] = np.minimum(past[open_] + common(text, words, star[a[open_]], star[b[open_]], depth), depth)
        return found, shared
    else:
        found, end = roomy(len(star), np.int64, memory), len(star)
        for at, _ in suffixes(names, depth, memory, in_memory):
            found[end - len(at) : end] = star[at]
            end -= len(at)
    shared[1:] = common(text, words, found[1:], found[:-1], depth)
    return found, shared


def suffixes(text: np.ndarray, depth: int, memory: int = MEMORY, in_memory: int = IN_MEMORY) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each first letter, from the largest: positions of its suffixes and the prefix that
    each shares with the one before it (0 for the first), both in ascending order of suffix.

    The order holds for the first ``depth`` letters and prefixes are counted up to it.
    """
    n = len(text)
    if not n:
        return
    text = text.view(np.ndarray)
    small = small_types(text, memory).view(np.ndarray)
    words = packed(text, depth, memory)
    star, shared = starred_order(text, words, small, depth, memory, in_memory)
    letters = np.unique(text)
    edge = np.searchsorted(text[star], letters, side="left"), np.searchsorted(text[star], letters, side="right")
    cap = np.uint16(depth)

    def joined(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], rising: bool) -> tuple[np.ndarray, np.ndarray]:
        """Two stretches of one letter's suffixes, the prefix shared where they meet counted."""
        if not len(a[0]) or not len(b[0]):
            return a if len(a[0]) else b
        meet = common(text, words, a[0][-1:], b[0][:1], depth)
        return np.concatenate((a[0], b[0])), np.concatenate((a[1], meet, b[1][1:]))

    def layers(letter: int, at: np.ndarray, lcp: np.ndarray, kind: bool) -> tuple[np.ndarray, np.ndarray]:
        """Adds the suffixes of this letter which those already here induce before themselves."""
        all_at, all_lcp = [at], [lcp]
        last_at, last_lcp = at, lcp
        before = None  # least prefix since the last suffix of the layer before that induced one
        while len(last_at):
            prev = last_at - 1
            some = np.flatnonzero((last_at > 0) & (text[prev] == letter) & (small[prev] == kind))
            if not len(some):
                break
            low = Minima(last_lcp)
            first = some[0]
            head = low.least(np.array([0]), np.array([first]))[0]  # with the meeting of the layers
            if before is not None:
                head = min(head, before)
            elif len(all_at) == 1:
                head = 0  # what came before in this letter was induced by another one
            got = np.empty(len(some), np.uint16)
            got[0] = min(int(head) + 1, depth)
            if len(some) > 1:
                got[1:] = np.minimum(low.least(some[:-1] + 1, some[1:]) + np.uint16(1), cap)
            tail = some[-1]
            before = low.least(np.array([tail + 1]), np.array([len(last_lcp) - 1]))[0] if tail + 1 < len(last_lcp) else cap
            last_at, last_lcp = last_at[some] - 1, got
            all_at.append(last_at)
            all_lcp.append(last_lcp)
        return np.concatenate(all_at), np.concatenate(all_lcp)

    def induce(queue: Queue, letter: int, at: np.ndarray, lcp: np.ndarray, kind: bool) -> None:
        """Puts the suffixes of other letters that start just before those here into the queue."""
        prev = at - 1
        some = np.flatnonzero((at > 0) & (small[prev] == kind) & (text[prev] != letter))
        if not len(some):
            return
        to = text[prev[some]]
        order = np.argsort(to, kind="stable")
        some, to = some[order], to[order]
        got = np.ones(len(some), np.uint16)  # the first of each letter shares that letter alone with the one before
        same = np.flatnonzero(to[1:] == to[:-1]) + 1
        if len(same):
            got[same] = np.minimum(Minima(lcp).least(some[same - 1] + 1, some[same]) + np.uint16(1), cap)
        cut = np.flatnonzero(np.diff(to)) + 1
        for d, a, s in zip(to[np.concatenate(([0], cut))].tolist(), np.split(prev[some], cut), np.split(got, cut)):
            queue.put(d, a, s)

    def begun(part: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        if len(part[0]):
            part[1].flags.writeable or (part := (part[0], part[1].copy()))
            part[1][0] = 0
        return part

    large, done = Queue(memory), Queue(memory)
    large.put(int(text[-1]), np.array([n - 1], np.int64), np.zeros(1, np.uint16))
    for k, letter in enumerate(letters.tolist()):
        at, lcp = layers(letter, *begun(large.take(letter)), kind=False)
        done.put(letter, at, lcp)
        seeds = star[edge[0][k] : edge[1][k]], shared[edge[0][k] : edge[1][k]].copy()
        induce(large, letter, *joined((at, lcp), begun(seeds), True), kind=False)
    large.close()
    rising = Queue(memory)
    for letter in letters[::-1].tolist():
        at, lcp = layers(letter, *begun(rising.take(letter)), kind=True)
        up_at, up_lcp = done.take(letter)
        # descending: each entry holds the prefix shared with the greater one before it
        down = up_at[::-1], np.concatenate(([0], up_lcp[:0:-1])).astype(np.uint16)[: len(up_at)]
        both = joined((at, lcp), begun(down), False)
        induce(rising, letter, *both, kind=True)
        yield both[0][::-1], np.concatenate(([0], both[1][:0:-1])).astype(np.uint16)[: len(both[0])]
    rising.close()
    done.close()
