"""Byte-pair encoding and decoding with a segment tree over adjacent pair ranks.

Each leaf of a word's tree holds the rank of the pair that starts there, joined with its
place; the root is then the leftmost pair of the lowest rank. A merge changes three
leaves, which are carried up in logarithmic time, until no pair can be merged. Many
short words are worked on at once, one tree to a row of an array; long ones alone.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm import textbytes as tb

#: White space as the tokenizer's own patterns have it.
BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Letters and numbers of Unicode versions after 16.0, which the tokenizer's pattern does not count as such.
NEWER = (
    r"\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d"
    r"\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
    r"\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8"
    r"\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20"
    r"\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    r"\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de"
    r"\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff"
    r"\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
LETTER, NUMBER = rf"[\p{{L}}--[{NEWER}]]", rf"[\p{{N}}--[{NEWER}]]"
PIECES = rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|{LETTER}+|{NUMBER}|(?:[^{BLANK}\p{{L}}\p{{N}}]|[{NEWER}])+"
# Letters that got lower-case forms after Unicode 15.1, beside those of Python's tables.
CASES = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
CASES |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
END = "</w>"
#: Longer words get a tree of their own.
WIDE = 256
#: Encoded words that a Python worker keeps, twice over.
CACHED = 300_000
NONE = np.int64(1 << 40)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_names() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


def lowered(text: str) -> str:
    """NFC, then lower case letter by letter: a final sigma is no exception."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower().translate(CASES)


class Vocabulary:
    """Tokens and merges of a word-end BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in chain(vocab.items(), self.special.items())}
        self.names = [names.get(i, "").encode() for i in range(max(names) + 1)]
        chars = byte_names()
        self.inner = np.array([vocab[c] for c in chars], np.int64)
        self.final = np.array([vocab[c + END] for c in chars], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        pair = np.array([vocab[a] << 20 | vocab[b] for a, b in merges], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(pair, kind="stable")
        self.pair, self.rank = pair[order], order
        self.pieces = regex.compile(PIECES)
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.marks = [t.encode() for t in self.special]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, or NONE."""
        want = left << 20 | right
        at = np.minimum(np.searchsorted(self.pair, want), len(self.pair) - 1)
        return np.where(self.pair[at] == want, self.rank[at], NONE)

    def pretokens(self, chunk: bytes) -> list[str | int]:
        """Words of a run without ASCII white space, and ids of special tokens."""
        if chunk.isalpha():  # ASCII letters alone
            return [chunk.lower().decode()]
        text = chunk.decode("utf-8", "replace")
        if text.isascii():
            if text[-1:] in ".,:;" and text[:-1].isalpha():
                return [text[:-1].lower(), text[-1]]
        elif text.isalpha():
            word = lowered(text)
            if word.isalpha():
                return [word]
        parts = [text]
        if self.split and any(m in chunk for m in self.marks):
            parts = [p for p in self.split.split(text) if p]
        out: list[str | int] = []
        for p in parts:
            if p in self.special:
                out.append(self.special[p])
            else:
                out += self.pieces.findall(p.lower() if p.isascii() else lowered(p))
        return out

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each word."""
        out: list[bytes] = [b""] * len(words)
        size = np.array([len(w) for w in words], np.int64)
        width = 4
        low = 0
        while width <= WIDE:
            some = np.flatnonzero((size > low) & (size <= width))
            for k in range(0, len(some), 1 << 16):
                for i, ids in zip(some[k : k + (1 << 16)], self._rows([words[i] for i in some[k : k + (1 << 16)]], size[some[k : k + (1 << 16)]], width)):
                    out[i] = ids
            low, width = width, width * 2
        for i in np.flatnonzero(size > WIDE):
            out[i] = self._long(words[i])
        return out

    def _rows(self, words: list[bytes], size: np.ndarray, width: int) -> Iterator[bytes]:
        """Words of at most ``width`` bytes, a tree of ``2 * width`` nodes for each, all in step."""
        n = len(words)
        sym = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        sym = self.inner[sym]
        every = np.arange(n)
        last = np.frombuffer(b"".join(w[-1:] for w in words), np.uint8)
        sym[every, size - 1] = self.final[last]
        live = np.arange(width) < size[:, None]
        tree = np.full((n, 2 * width), NONE)
        ok = live[:, 1:]
        r = self.ranks(sym[:, :-1][ok], sym[:, 1:][ok])
        leaf = np.full((n, width - 1), NONE)
        leaf[ok] = np.where(r < NONE, r * width + np.nonzero(ok)[1], NONE)
        tree[:, width : 2 * width - 1] = leaf
        for k in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1], out=tree[:, k])
        after = np.tile(np.arange(1, width + 1), (n, 1))
        after[every, size - 1] = width
        before = np.tile(np.arange(-1, width - 1), (n, 1))
        tree, sym, live, after, before = tree.ravel(), sym.ravel(), live.ravel(), after.ravel(), before.ravel()
        at = every[tree[1 :: 2 * width] < NONE]
        while len(at):
            root = tree[at * 2 * width + 1]
            place, rank = root % width, root // width
            base = at * width
            gone = after[base + place]
            new = self.merged[rank]
            sym[base + place] = new
            live[base + gone] = False
            right = after[base + gone]
            after[base + place] = right
            has = right < width
            before[base[has] + right[has]] = place[has]
            left = before[base + place]
            had = left >= 0
            node = at * 2 * width + width
            tree[node + gone] = NONE
            value = np.full(len(at), NONE)
            r = self.ranks(new[has], sym[base[has] + right[has]])
            value[has] = np.where(r < NONE, r * width + place[has], NONE)
            tree[node + place] = value
            r = self.ranks(sym[base[had] + left[had]], new[had])
            tree[node[had] + left[had]] = np.where(r < NONE, r * width + left[had], NONE)
            top = np.concatenate((at, at, at[had])) * 2 * width
            k = np.concatenate((place, gone, left[had])) + width
            while k[0] > 1:
                k >>= 1
                tree[top + k] = np.minimum(tree[top + 2 * k], tree[top + 2 * k + 1])
            at = at[tree[at * 2 * width + 1] < NONE]
        ids = sym[live].astype("<u4").tobytes()
        edge = np.concatenate(([0], np.cumsum(live.reshape(n, width).sum(1)))) * 4
        return (ids[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()))

    @lru_cache(maxsize=1)  # noqa: B019  one vocabulary lives as long as its worker
    def _table(self) -> dict[int, int]:
        return dict(zip(self.pair.tolist(), self.rank.tolist()))

    def _long(self, word: bytes) -> bytes:
        """One word of any length with its own tree."""
        rank_of, merged, none = self._table(), self.merged, int(NONE)
        sym = self.inner[np.frombuffer(word, np.uint8)].tolist()
        sym[-1] = int(self.final[word[-1]])
        n = len(sym)
        width = 1 << (n - 1).bit_length()
        shift = width.bit_length() - 1
        none = 1 << 62
        tree = [none] * (2 * width)

        def leaf(i: int, j: int) -> int:
            r = rank_of.get(sym[i] << 20 | sym[j])
            return none if r is None else r << shift | i

        for i in range(n - 1):
            tree[width + i] = leaf(i, i + 1)
        for k in range(width - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(i: int, value: int) -> None:
            k = width + i
            tree[k] = value
            while k > 1:
                k >>= 1
                low = tree[2 * k] if tree[2 * k] < tree[2 * k + 1] else tree[2 * k + 1]
                if tree[k] == low:
                    break
                tree[k] = low

        while tree[1] < none:
            i = tree[1] & (width - 1)
            sym[i] = int(merged[tree[1] >> shift])
            gone = after[i]
            sym[gone] = -1
            put(gone, none)
            right = after[i] = after[gone]
            if right < n:
                before[right] = i
            put(i, leaf(i, right) if right < n else none)
            if before[i] >= 0:
                put(before[i], leaf(before[i], i))
        return np.array([s for s in sym if s >= 0], "<u4").tobytes()

    def encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of runs without ASCII white space; a token never reaches across such space."""
        parts = [self.pretokens(c) for c in chunks]
        words = sorted({p for ps in parts for p in ps if isinstance(p, str)})
        found: dict = dict(zip(words, self.encode_words([w.encode() for w in words])))
        found |= {i: np.array([i], "<u4").tobytes() for i in self.special.values()}
        return [b"".join([found[p] for p in ps]) for ps in parts]

    def decode(self, ids: bytes) -> bytes:
        """Token texts joined by a space, as the library does where a file has no decoder."""
        return b" ".join(map(self.names.__getitem__, memoryview(ids).cast("I").tolist()))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Encodes texts chunk by chunk, keeping a bounded number of chunks already encoded."""

    def __init__(self, encode_chunks: Callable[[list[bytes]], list[bytes]], cached: int = CACHED):
        self.encode_chunks, self.cached = encode_chunks, cached
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def learn(self, chunks: set[bytes]) -> dict[bytes, bytes]:
        """Makes sure that all the chunks are in the table returned."""
        missing = chunks.difference(self.new)
        if len(self.new) + len(missing) > self.cached:
            self.old, self.new = self.new, {}
            missing = chunks
        unknown = []
        for c in missing:
            if (ids := self.old.get(c)) is None:
                unknown.append(c)
            else:
                self.new[c] = ids
        self.new.update(zip(unknown, self.encode_chunks(unknown)))
        return self.new

    def encode(self, texts: list[bytes]) -> list[bytes]:
        split = [t.split() for t in texts]  # bytes.split() parts at [\x20\x09-\x0D]
        table = self.learn(set(chain.from_iterable(split))).__getitem__
        return [b"".join(map(table, s)) for s in split]

    def encode_all(self, texts: list[bytes], limit: int = 1 << 20) -> Iterator[bytes]:
        """Like encode, for about ``limit`` bytes at once; longer texts are taken in parts."""
        some, size = [], 0
        for t in texts:
            if len(t) > 2 * limit:
                yield from self.encode(some)
                some, size = [], 0
                yield b"".join(b for part in parts(t, limit) for b in self.encode([part]))
                continue
            some.append(t)
            size += len(t)
            if size > limit:
                yield from self.encode(some)
                some, size = [], 0
        yield from self.encode(some)


def parts(text: bytes, limit: int) -> Iterator[bytes]:
    """The text in parts that end at ASCII white space, of ``limit`` bytes or up to the next such space."""
    space = regex.compile(rb"[\x20\x09-\x0D]")
    at = 0
    while at < len(text):
        m = space.search(text, min(len(text), at + limit))
        end = m.start() + 1 if m else len(text)
        yield text[at:end]
        at = end


@lru_cache(maxsize=1)
def tree_encoder(path: str, cached: int = CACHED) -> Encoder:
    return Encoder(vocabulary(path).encode_chunks, cached)


def utf8(col: pa.Array) -> list[bytes]:
    data, offs = tb.buffers(col)
    data, at = memoryview(data), offs.tolist()
    return [bytes(data[a:b]) for a, b in zip(at[:-1], at[1:])]


def bpe_encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """One row per input row: ``id_col``, ``ids`` (array of int), ``decoded`` (string).

    Null and empty texts have no ids and decode to an empty string. Ids may be null or
    repeat; other columns are not looked at. An empty table gives an empty result.
    """
    path = path or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, vocab = tree_encoder(path), vocabulary(path)
        for batch in batches:
            for i, j, _, _ in tb.slices(batch.column(1)):
                ids = list(encoder.encode_all(utf8(batch.column(1)[i:j])))
                edge = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids]))).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.ListArray.from_arrays(pa.array(edge), flat), pa.array([vocab.decode(x).decode() for x in ids], pa.string())], names=[id_col, "ids", "decoded"])

    plain = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    return plain.mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, ids array<int>, decoded string")


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Token count and SHA-256 of ids and of decoded text, for each row of ``bpe_encode``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            edge, flat = ids.offsets.to_pylist(), memoryview(np.asarray(ids.values).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(edge), pa.int64()),
                    pa.array([hashlib.sha256(flat[4 * a : 4 * b]).hexdigest() for a, b in zip(edge[:-1], edge[1:])], pa.string()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in utf8(batch.column("decoded"))], pa.string()),
                ],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return encoded.mapInArrow(run, f"`{id_col}` {encoded.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op4_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(bpe_encode(spark.read.parquet(f"{sf_dir}/documents.parquet")))
