"""Token counts that follow edits, by segment trees over the pre-tokens of each document.

A leaf is a pre-token: a run without ASCII white space with the space after it, for no
token reaches across such space. It has its length in code points and its number of
tokens, and each node above the sums of its two subtrees. An edit is found by descending
the lengths; only the leaves that it touches and the one at either side are encoded
anew, and their changed sums are carried up, level by level.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm import bpe
from emberline.llm import textbytes as tb

#: Bytes of text whose pre-tokens are looked up together.
LIMIT = 1 << 20
EDITS = "array<struct<start:long,stop:long,insert:string>>"
#: Personal data that ``redaction_edits`` takes out: runs of 8 digits or more, and mail addresses.
DIGITS = re.compile(r"[0-9](?:[ .-]?[0-9]){7,}")
MAIL = re.compile(r"[A-Za-z0-9._+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def token_numbers(encoder: bpe.Encoder, texts: list[bytes]) -> Iterator[np.ndarray]:
    """Per text the number of tokens of each run without ASCII white space."""

    def looked_up(some: list[bytes]) -> list[np.ndarray]:
        split = [t.split() for t in some]
        table = encoder.learn({c for s in split for c in s})
        return [np.fromiter(map(len, map(table.__getitem__, s)), np.int32, len(s)) >> 2 for s in split]

    some, size = [], 0
    for t in texts:
        if size + len(t) > LIMIT and some:
            yield from looked_up(some)
            some, size = [], 0
        if len(t) > 2 * LIMIT:
            yield np.concatenate([looked_up([p])[0] for p in bpe.parts(t, LIMIT)])
        else:
            some.append(t)
            size += len(t)
    yield from looked_up(some)


class CountTree:
    """One document's leaves, the sums above them, and the text of the leaves that were edited."""

    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray):
        self.text, n = text, max(1, len(chars))
        self.width = 1 << (n - 1).bit_length()
        self.nodes = np.zeros((2, 2 * self.width), np.int64)
        self.nodes[0, self.width : self.width + len(chars)] = chars
        self.nodes[1, self.width : self.width + len(tokens)] = tokens
        self.start = np.concatenate(([0], np.cumsum(chars, dtype=np.int64)))
        self.own: dict[int, str] = {}
        self.encoded = 0
        self._carry(0, self.width - 1)

    def _carry(self, lo: int, hi: int) -> None:
        """Sums above the leaves from lo to hi."""
        lo, hi = lo + self.width, hi + self.width
        while lo > 1:
            lo, hi = lo >> 1, hi >> 1
            self.nodes[:, lo : hi + 1] = self.nodes[:, 2 * lo : 2 * hi + 2 : 2] + self.nodes[:, 2 * lo + 1 : 2 * hi + 2 : 2]

    def _leaf(self, at: int) -> tuple[int, int]:
        """The leaf with the character at this place, and where the leaf begins."""
        k, begin = 1, 0
        while k < self.width:
            k *= 2
            left = int(self.nodes[0, k])
            if at - begin >= left:
                begin += left
                k += 1
        return k - self.width, begin

    def _text(self, leaf: int) -> str:
        return self.own.get(leaf, self.text[self.start[leaf] : self.start[leaf + 1]] if leaf + 1 < len(self.start) else "")

    def edit(self, encoder: bpe.Encoder, start: int, stop: int, insert: str) -> None:
        total = int(self.nodes[0, 1])
        start = min(max(start, 0), total)
        stop = min(max(stop, start), total)
        # the run before the edit may go on in what is inserted, and that in the run behind
        a, begin = self._leaf(max(start - 1, 0)) if total else (0, 0)
        b, _ = self._leaf(min(stop, total - 1)) if total else (0, 0)
        old = "".join(self._text(i) for i in range(a, b + 1) if i in self.own or self.nodes[0, self.width + i])
        new = old[: start - begin] + insert + old[stop - begin :]
        count = sum(int(x.sum()) for x in token_numbers(encoder, [new.encode()]))
        self.encoded += len(new)
        for i in [i for i in self.own if a < i <= b]:
            del self.own[i]
        self.own[a] = new
        span = slice(self.width + a, self.width + b + 1)
        self.nodes[:, span] = 0
        self.nodes[:, self.width + a] = len(new), count
        self._carry(a, b)

    def count(self) -> int:
        return int(self.nodes[1, 1])

    def leaves(self) -> tuple[np.ndarray, np.ndarray, str]:
        """Lengths and token numbers of the leaves that hold something, and the text as it stands."""
        base = self.nodes[:, self.width :]
        full = np.flatnonzero(base[0])
        return base[0, full], base[1, full], "".join(map(self._text, full.tolist()))


def leaves_of(encoder: bpe.Encoder, column: pa.Array, text: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a slice of texts, with its bytes: where each one's leaves begin, their lengths and token numbers."""
    rows = len(offs) - 1
    start, _ = tb.spans(text, offs, tb.SPACE[text])
    row = np.searchsorted(offs, start, side="right") - 1
    first = np.searchsorted(row, np.arange(rows + 1))
    points = np.concatenate(([0], np.cumsum((text & 0xC0) != 0x80, dtype=np.int64)))
    edges = points[start]
    edges[first[:-1][np.diff(first) > 0]] = points[offs[:-1]][np.diff(first) > 0]  # space at the front is the first leaf's
    ends = np.append(edges[1:], 0)
    ends[first[1:][np.diff(first) > 0] - 1] = points[offs[1:]][np.diff(first) > 0]
    chars = (ends - edges).astype(np.int32)
    blank = (np.diff(first) == 0) & (np.diff(offs) > 0)  # nothing but space: one leaf without tokens
    tokens = list(token_numbers(encoder, bpe.utf8(column)))
    for k in np.flatnonzero(blank):
        tokens[k] = np.zeros(1, np.int32)
    chars = np.insert(chars, first[:-1][blank], np.diff(points[offs])[blank].astype(np.int32))
    at = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))).astype(np.int32)
    return at, chars, np.concatenate(tokens)


def edited(encoder: bpe.Encoder, text: str, chars: np.ndarray, tokens: np.ndarray, todo: list[tuple[int, int, str]]) -> tuple:
    """The text and its leaves after the edits, token numbers before and after, edits and code points encoded anew."""
    before = count = int(tokens.sum())
    done = 0
    if todo:
        tree = CountTree(text, chars, tokens)
        for e in todo:
            tree.edit(encoder, *e)
        chars, tokens, text = tree.leaves()
        count, done = tree.count(), tree.encoded
    return text, chars, tokens, before, count, len(todo), done


def _trees(path: str):
    schema = pa.schema([("text", pa.string()), ("chars", pa.list_(pa.int32())), ("tokens", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.tree_encoder(path)
        for batch in batches:
            for i, j, text, offs in tb.slices(batch.column(1)):
                at, *leaves = leaves_of(encoder, batch.column(1)[i:j], text, offs)
                lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(x)) for x in leaves]
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], batch.column(1)[i:j].cast(pa.string()), *lists], names=[batch.schema.names[0], *schema.names])

    return run


def token_trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """One row per input row: ``id_col, text, chars, tokens``, the leaves of its tree.

    ``chars`` adds up to the text's length and ``tokens`` to its number of tokens. The sums
    above the leaves follow from them and are made when a document is first edited. Null
    and empty texts have no leaves. Ids may be null or repeat; other columns are not
    looked at. An empty table gives an empty result.
    """
    plain = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return plain.mapInArrow(_trees(path or bpe.default_vocabulary()), f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, text string, chars array<int>, tokens array<int>")


def with_edits(trees: DataFrame, edits: DataFrame, id_col: str = "doc_id", order_col: str = "seq") -> DataFrame:
    """The trees with the column ``edits`` from a table of ``id_col, order_col, start, stop, insert``.

    Edits without a document are left out; documents that repeat an id get the edits each.
    A document's edits meet in its row.
    """
    one = F.struct(F.col(order_col).alias("o"), F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), F.col("insert").cast("string").alias("insert"))
    lists = edits.groupBy(F.col(id_col).alias("_id")).agg(F.array_sort(F.collect_list(one)).alias("e"))
    lists = lists.select("_id", F.transform("e", lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), x["insert"].alias("insert"))).alias("edits"))
    return trees.join(lists, trees[id_col] == lists["_id"], "left").drop("_id")


def apply_edits(trees: DataFrame, id_col: str = "doc_id", path: str | None = None) -> DataFrame:
    """Applies the column ``edits`` (array of ``start, stop, insert``) to each row's text and tree.

    Edits are applied in order, each to the text as the ones before have left it: the code
    points from ``start`` to before ``stop`` give way to ``insert``. Places beyond the text
    count as its end, those below 0 as its beginning, a stop before its start as the start;
    a null insert is empty, and an edit with a null place changes nothing. Returns
    ``id_col, text, chars, tokens`` as edited, so that edits can follow, with ``n_before``
    and ``n_tokens`` (counts before and after), ``n_edits`` and ``n_encoded`` (code points that
    were encoded anew).
    """
    path = path or bpe.default_vocabulary()
    names = ["text", "chars", "tokens", "n_before", "n_tokens", "n_edits", "n_encoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.tree_encoder(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts, edits = part.column("text").to_pylist(), part.column("edits").to_pylist()
                out: list[list] = [[] for _ in names]
                for text, todo, chars, tokens in zip(texts, edits, part.column("chars"), part.column("tokens")):
                    chars, tokens = (np.asarray(x.values if x.values is not None else [], np.int64) for x in (chars, tokens))
                    todo = [(e["start"], e["stop"], e["insert"] or "") for e in todo or () if e is not None and e["start"] is not None and e["stop"] is not None]
                    for column, value in zip(out, edited(encoder, text or "", chars, tokens, todo)):
                        column.append(value)
                types = [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(out, types))], names=[id_col, *names])

    kind = trees.schema[id_col].dataType.simpleString()
    return trees.select(id_col, "text", "chars", "tokens", "edits").mapInArrow(run, f"`{id_col}` {kind}, text string, chars array<int>, tokens array<int>, n_before long, n_tokens long, n_edits long, n_encoded long")


def redaction_edits(text: str) -> list[tuple[int, int, str]]:
    """Edits that put a mark for each mail address and long number, from the last to the first."""
    found = [(m.start(), m.end(), "<number>") for m in DIGITS.finditer(text)]
    if "@" in text:
        mails = [(m.start(), m.end(), "<mail>") for m in MAIL.finditer(text)]
        found = [f for f in found if not any(a < f[1] and f[0] < b for a, b, _ in mails)] + mails
    return sorted(found, reverse=True)


def edited_counts(docs: DataFrame, edits_of: Callable[[str], list[tuple[int, int, str]]], id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Like ``apply_edits`` on ``token_trees`` for edits that follow from the text itself, in one pass over slices of it.

    Returns ``id_col, text`` (as edited), ``n_before, n_tokens, n_edits, n_encoded, n_leaves``.
    """
    path = path or bpe.default_vocabulary()
    names = ["text", "n_before", "n_tokens", "n_edits", "n_encoded", "n_leaves"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.tree_encoder(path)
        for batch in batches:
            for i, j, data, offs in tb.slices(batch.column(1)):
                column = batch.column(1)[i:j]
                at, chars, tokens = leaves_of(encoder, column, data, offs)
                out: list[list] = [[] for _ in names]
                for k, text in enumerate(column.to_pylist()):
                    own = slice(at[k], at[k + 1])
                    text, leaves, _, *counts = edited(encoder, text, chars[own], tokens[own], edits_of(text))
                    for values, value in zip(out, (text, *counts, len(leaves))):
                        values.append(value)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], *(pa.array(c, t) for c, t in zip(out, [pa.string(), *[pa.int64()] * 5]))], names=[id_col, *names])

    plain = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return plain.mapInArrow(run, f"`{id_col}` {kind}, text string, n_before long, n_tokens long, n_edits long, n_encoded long, n_leaves long")


def op10_edit_counts(spark, sf_dir: str) -> DataFrame:
    """Per document its number of tokens, and that after personal data gave way to marks."""
    found = edited_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), redaction_edits)
    return found.select("doc_id", F.col("n_before").alias("n_tokens"), F.col("n_tokens").alias("n_tokens_edited"), "n_edits", "n_leaves", "n_encoded", F.sha2("text", 256).alias("edited_sha256"))
