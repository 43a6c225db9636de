"""The stretch-wise encoder against the library on whole texts."""

import numpy as np
import public_tokenizers
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

from tarnworks.llm.tokens import Encoder

KINDS = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]
ENCODERS = {kind: Encoder(public_tokenizers.path(kind[0]), kind[1]) for kind in KINDS}
PIECES = ["the", " ", "  ", "\n", "\t", "\r\n", "don't", "Élan", "é", "İ", "ß", "ſ", "123", "...", "!!", " | ", "x's", "'s", "日本", "😀",
          " ", "　", "​", "\x1c", "<|endoftext|>", "-", "a1b", "ﬁ", "́", "Word.", "WORD,", "€.", "_x_", " ", "﻿", "ǅ"]


@pytest.mark.parametrize("kind", KINDS, ids=lambda k: k[0])
@settings(max_examples=250, deadline=None)
@given(text=st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=4)), max_size=14).map("".join))
@example(text="")
@example(text=" \n the  \n\n x  \n y\t")
def test_equal_to_whole_texts(kind, text):
    text = text.encode("utf-8", "ignore").decode("utf-8")
    encoder = ENCODERS[kind]
    want = np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    assert encoder.ids([text, text + " "])[0] == want


@pytest.mark.parametrize("kind", KINDS, ids=lambda k: k[0])
def test_a_word_is_merged_once_whatever_marks_follow_it(kind):
    encoder, words = Encoder(public_tokenizers.path(kind[0]), kind[1]), []

    class Counted:
        def __init__(self, model):
            self.model = model

        def tokenize(self, word):
            words.append(word)
            return self.model.tokenize(word)

    encoder.model = Counted(encoder.model)
    encoder.ids([" zorbel zorbel, zorbel. (zorbel zorbel!!", " zorbel; zorbel"])
    encoder.ids([" zorbel? zorbel..."])
    assert len(words) == 1
