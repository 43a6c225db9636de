"""Texts that spell an added token, against a freshly loaded tokenizer as it is."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tarnworks.llm import token_store
from tarnworks.llm.tokens import Encoder

END = "<|endoftext|>"
TEXTS = [f"see {END} here", END, f"a{END}b", f"{END}{END}", END.upper(), f"x <|EndOfText|> y", f"Words, {END}\n\n then", "<|startoftext|> a", "<|endof text|>", "plain words"]


@pytest.mark.parametrize("kind", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)], ids=lambda k: k[0])
def test_added_tokens_are_those_of_the_library(kind):
    library = Tokenizer.from_file(public_tokenizers.path(kind[0]))
    want = [library.encode(t, add_special_tokens=False).ids for t in TEXTS]
    assert len(want[1]) == 1
    got = [np.frombuffer(ids, dtype="<u4").tolist() for ids in Encoder(public_tokenizers.path(kind[0]), kind[1]).ids(TEXTS)]
    assert got == want


def test_stored_rows(spark):
    library = Tokenizer.from_file(token_store.vocabulary_path())
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(2)
    manifest, folder = token_store.store(df, token_store.vocabulary_path())
    got = {r[0]: (r[2], r[3]) for r in map(tuple, token_store.read_back(manifest, folder).collect())}
    for key, text in enumerate(TEXTS):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        assert got[key] == (len(ids), zlib.crc32(ids.tobytes()))
