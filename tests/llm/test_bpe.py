import hashlib

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from emberline.llm import bpe
from tests.llm.cases import AWKWARD, frame

tokenizers = pytest.importorskip("tokenizers")
PATH = bpe.default_vocabulary()
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
ODD = ["ΑΣ ΣΑΣ", "a\x1cb", "İx", "é ́a", "a\xa0b c　d e f\x85g", "Ǆ ﬁ ½ ² Ⅷ", "<|endoftext|><|STARTOFTEXT|>a<|startoftext|>'S x's", "", "  ", "a​b", "ß ẞ", "\0a", "x" * 3000, "abcab" * 700 + "é", "你好\U0001f600!!??a1b2"]


def library(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


def own(text):
    vocab = bpe.vocabulary(PATH)
    ids = b"".join(bpe.Encoder(vocab.encode_chunks).encode_all([text.encode()], limit=64))
    return list(memoryview(ids).cast("I")), vocab.decode(ids).decode()


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert own(text) == library(text)


def test_every_character():
    """Each code point next to a letter, a digit and a sign."""
    vocab = bpe.vocabulary(PATH)
    some = [chr(c) for c in range(0x80, 0x40000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{x}1:{x}:" for x in some]
    got = vocab.encode_chunks([t.encode() for t in texts])
    spaces = {x for x in some if x.isspace() or x in "\x1c\x1d\x1e\x1f"}
    want = LIBRARY.encode_batch(texts, add_special_tokens=False)
    assert [x for x, g, w in zip(some, got, want) if x not in spaces and list(memoryview(g).cast("I")) != w.ids] == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aeinorst 'SΣ\n<|>é1"), st.characters(codec="utf-8", max_codepoint=0x2FFF)), max_size=60))
def test_any_text(text):
    assert own(text) == library(text)


@settings(max_examples=30, deadline=None)
@given(st.text(alphabet="abcdeinst", min_size=1, max_size=700))
def test_words_in_step_and_alone(word):
    vocab = bpe.vocabulary(PATH)
    assert vocab._long(word.encode()) == vocab.encode_words([word.encode()])[0]


def test_whole_table_and_awkward_rows(spark):
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet")
    want = dict(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))
    got = bpe.op4_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(want)
    for r in got:
        ids, text = library(want[r.doc_id])
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    rows = bpe.bpe_encode(frame(spark, AWKWARD)).collect()
    assert {r.doc_id: (list(r.ids), r.decoded) for r in rows} == {i: library(t) for i, t in AWKWARD}
    assert bpe.digests(bpe.bpe_encode(frame(spark, []))).count() == 0
