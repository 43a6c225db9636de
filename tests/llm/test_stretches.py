"""Texts cut in bulk against one text after the other."""

import re

import pyarrow as pa
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

from tarnworks.llm import ngram_trie
from tarnworks.llm.stretches import SEPARATOR, cut, listed

_WITH_SPACES = re.compile(rb" ?[^ \t\n\x0b\x0c\r]+|[ \t\n\x0b\x0c\r]+(?![^ \t\n\x0b\x0c\r])|[ \t\n\x0b\x0c\r]")
TEXTS = st.lists(st.text(st.sampled_from("aB \t\n\x0b\x0c\r\x1c\x85\xa0é\0")), min_size=1, max_size=5)


def in_order(distinct, number, ends):
    """The stretches of each text."""
    out, begin = [], 0
    for end in ends.tolist():
        assert distinct[number[end]] in (SEPARATOR, ngram_trie.END)
        out.append([distinct[i] for i in number[begin:end].tolist()])
        begin = end + 1
    assert begin == len(number)
    return out


@pytest.mark.parametrize("with_spaces,plain", [(True, _WITH_SPACES.findall), (False, bytes.split)])
@settings(max_examples=300, deadline=None)
@given(texts=TEXTS)
@example(texts=["", " ", "", "a", "a\t", "\n a  b\n\nc ", " "])
def test_stretches(with_spaces, plain, texts):
    texts = [text.encode() for text in texts]
    distinct, number, ends = cut(texts, with_spaces)
    assert in_order(listed(distinct), number, ends) == [plain(text) for text in texts]


@settings(max_examples=100, deadline=None)
@given(texts=TEXTS)
@example(texts=["", "A b\x1cA", "É é Aa"])
def test_tokens_of_the_trie(texts):
    got = in_order(*ngram_trie._tokens(pa.array([None, *texts])))
    assert got == [ngram_trie.words_of(text) for text in [None, *texts]]


def test_counts_of_the_trie_over_many_groups(monkeypatch):
    monkeypatch.setattr(ngram_trie, "BYTES_AT_ONCE", 40)
    monkeypatch.setattr(ngram_trie, "KNOWN_WORDS", 7)
    texts = [None, "", "A a b", *(f"w{i % 11} a b" for i in range(60))]
    batches = [pa.RecordBatch.from_arrays([pa.array(part, pa.string())], ["text"]) for part in (texts[:20], [], texts[20:])]
    got = {}
    for rows in ngram_trie._counted(iter(batches)):
        for key, n in zip(rows.column("key").to_pylist(), rows.column("n").to_pylist()):
            got[key % 2**64] = got.get(key % 2**64, 0) + n
    want = {}
    for text in texts:
        for word in [*ngram_trie.words_of(text), ngram_trie.END]:
            want[ngram_trie.word_hash(word)] = want.get(ngram_trie.word_hash(word), 0) + 1
    assert got == want
