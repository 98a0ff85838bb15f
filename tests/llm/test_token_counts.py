import hashlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from emberline.llm import bpe
from emberline.llm import token_counts as tc
from tests.llm.cases import AWKWARD, frame

tokenizers = pytest.importorskip("tokenizers")
PATH = bpe.default_vocabulary()
LIBRARY = tokenizers.Tokenizer.from_file(PATH)


def n_tokens(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def edited(text, edits):
    for a, b, new in edits:
        a = min(max(a, 0), len(text))
        b = min(max(b, a), len(text))
        text = text[:a] + new + text[b:]
    return text


def leaves(text):
    """Lengths and token numbers of the leaves, one by one."""
    starts = [i for i, x in enumerate(text) if x not in " \t\n\v\f\r" and (i == 0 or text[i - 1] in " \t\n\v\f\r")]
    if not starts:
        return ([len(text)], [0]) if text else ([], [])
    edge = [0, *starts[1:], len(text)]
    return [b - a for a, b in zip(edge[:-1], edge[1:])], [n_tokens(text[a:b]) for a, b in zip(edge[:-1], edge[1:])]


TEXT = st.text(alphabet=st.sampled_from("abentr's  \n\t1é́.<|>"), max_size=40)


@settings(max_examples=400, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(-2, 60), st.integers(-2, 60), TEXT), max_size=6))
def test_any_edits(text, edits):
    chars, tokens = leaves(text)
    tree = tc.CountTree(text, np.array(chars, np.int64), np.array(tokens, np.int64))
    assert tree.count() == n_tokens(text)
    encoder = bpe.tree_encoder(PATH)
    for k, e in enumerate(edits):
        tree.edit(encoder, *e)
        want = edited(text, edits[: k + 1])
        assert (tree.count(), tree.leaves()[2]) == (n_tokens(want), want)


def test_only_what_an_edit_touches_is_encoded(spark):
    text = "many words here " * 5000
    docs = frame(spark, [(1, text)])
    trees = tc.token_trees(docs)
    edits = spark.createDataFrame([(1, 2, 7, 11, "other"), (1, 1, 0, 0, "so "), (9, 1, 0, 0, "lost")], "doc_id long, seq int, start long, stop long, insert string")
    r = tc.apply_edits(tc.with_edits(trees, edits)).first()
    want = edited(text, [(0, 0, "so "), (7, 11, "other")])
    assert (r.text, r.n_tokens, r.n_before, r.n_edits) == (want, n_tokens(want), n_tokens(text), 2)
    assert r.n_encoded < 40 and sum(r.tokens) == r.n_tokens and sum(r.chars) == len(want)


def test_awkward_rows(spark):
    trees = tc.token_trees(frame(spark, AWKWARD)).cache()
    for r in trees.collect():
        text = dict(AWKWARD)[r.doc_id] or ""
        assert r.text == text and (list(r.chars), list(r.tokens)) == leaves(text)
    edits = [(i, 1, 1, 3, "x y") for i, _ in AWKWARD] + [(7, 2, None, 3, "gone"), (8, 2, 5, 2, None), (8, 3, 10**9, 10**9, " end")]
    edits = spark.createDataFrame(edits, "doc_id long, seq int, start long, stop long, insert string")
    for r in tc.apply_edits(tc.with_edits(trees, edits)).collect():
        want = edited(dict(AWKWARD)[r.doc_id] or "", [(1, 3, "x y")] + [(5, 2, ""), (10**9, 10**9, " end")] * (r.doc_id == 8))
        assert (r.text, r.n_tokens) == (want, n_tokens(want))
    none = tc.apply_edits(tc.with_edits(trees, edits.where("false"))).collect()
    assert all(r.n_tokens == r.n_before and r.n_edits == 0 for r in none) and len(none) == len(AWKWARD)
    assert tc.token_trees(frame(spark, [])).count() == 0


def test_query(spark):
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet")
    want = dict(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))
    got = tc.op10_edit_counts(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(want)
    for r in got:
        text = want[r.doc_id] or ""
        after = edited(text, tc.redaction_edits(text))
        assert (r.n_tokens, r.n_tokens_edited, r.edited_sha256) == (n_tokens(text), n_tokens(after), hashlib.sha256(after.encode()).hexdigest())
    assert sum(r.n_edits for r in got) > 0
