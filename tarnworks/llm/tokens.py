"""Token ids of whole texts by a public tokenizer, each distinct word merged once.

Both vocabularies split a text at ASCII white space before they merge anything, so a text's ids are its
stretches' ids in a row. A stretch that is a plain word, perhaps with ASCII marks behind it, is split in just that place by either
tokenizer, so its word goes straight to the library's merge model, once for all marks that follow it; any other is encoded in full. What
was met before in the task is looked up. The memory is bounded; a full one is emptied. Texts with other white
space, where the rule might not hold, are encoded whole, and so are texts that hold an added token's literal (such as the end of
text), which the library turns into that token.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tarnworks.llm.stretches import SEPARATOR, cut, listed

KNOWN_STRETCHES = 600_000
NO_WORD = -1
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII punctuation but the apostrophe, which begins contractions
# other white space: it can merge with an ASCII neighbour, or may count as white space for one side only
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]")


def _byte_letters() -> dict[int, int]:
    """The tokenizers' letter for each byte: printable Latin-1 stands for itself, the rest for letters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [byte for byte in range(256) if byte not in plain]
    return {byte: 256 + place for place, byte in enumerate(others)}


def _gathered(flat: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of ``flat`` in a row, and where each one ends."""
    behind = np.cumsum(length)
    return flat[np.repeat(first - (behind - length), length) + np.arange(behind[-1])], behind


class Encoder:
    """ids(texts): for each text its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, tokenizer_path: str, keeps_spaces: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        added = {token.content for token in self.tokenizer.get_added_tokens_decoder().values()}
        # they may match after lower-casing, so any case counts
        self.literals = re.compile("|".join(map(re.escape, sorted(added))) or r"(?!)", re.IGNORECASE)
        self.keeps_spaces = keeps_spaces
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.space = chr(self.letters[ord(" ")])
        self._forget()

    def _forget(self) -> None:
        """Number i has the ids from bounds[i] to bounds[i + 1]; 0 has none, as the mark between texts. NO_WORD has no number."""
        self.words: dict[bytes, int] = {SEPARATOR: 0}
        self.others: dict[bytes, int] = {}
        self.bounds = np.zeros(2, dtype=np.int64)
        self.flat = np.empty(0, dtype="<u4")

    def _keep(self, flat: array, lengths: list[int]) -> None:
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(lengths, dtype=np.int64)])
        self.flat = np.concatenate([self.flat, np.frombuffer(flat, dtype=np.uint32).astype("<u4")])

    def _spelt(self, word: str) -> str | None:
        """A word in the letters of the vocabulary; None for what isn't just a word."""
        bare = word.removeprefix(" ") if self.keeps_spaces else word
        if not bare.isalpha():
            return None
        if bare.isascii():  # printable letters stand for themselves; only the space has another
            if not self.keeps_spaces:
                return word.lower()
            return word if word[0] != " " else self.space + bare
        if not self.keeps_spaces:
            # below U+0250 letters are composed already and lower-case one to one, but for U+0130
            if max(bare) >= "\u0250" or "\u0130" in bare:
                return None
            word = word.lower()
        return word.encode("utf-8").decode("latin-1").translate(self.letters)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn_words(self, new: list[bytes]) -> None:
        flat, lengths, number, tokenize = array("I"), [], len(self.bounds) - 1, self.model.tokenize
        for word in new:
            spelt = self._spelt(word.decode("utf-8"))
            if spelt is None:
                self.words[word] = NO_WORD
                continue
            ids = [token.id for token in tokenize(spelt)]
            flat.extend(ids)
            lengths.append(len(ids))
            self.words[word] = number
            number += 1
        self._keep(flat, lengths)

    def _numbers_of_others(self, stretches: list[bytes]) -> list[int]:
        new = [piece for piece in dict.fromkeys(stretches) if piece not in self.others]
        for start in range(0, len(new), 20_000):
            part, flat, number = new[start : start + 20_000], array("I"), len(self.bounds) - 1
            encoded = self._encode([piece.decode("utf-8") for piece in part])
            for ids in encoded:
                flat.extend(ids)
            self.others.update(zip(part, range(number, number + len(part))))
            self._keep(flat, [len(ids) for ids in encoded])
        return [self.others[piece] for piece in stretches]

    def ids(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        whole = {i for i, text in enumerate(texts) if _OTHER_SPACE.search(text) or self.literals.search(text)}
        stretches, number, ends = cut([b"" if i in whole else text.encode("utf-8") for i, text in enumerate(texts)], self.keeps_spaces)
        if len(self.words) + len(self.others) > KNOWN_STRETCHES:
            self._forget()
        bare = pc.ascii_rtrim(stretches.view(pa.large_string()), characters=_MARKS).view(pa.large_binary())
        marks = pc.subtract(pc.binary_length(stretches), pc.binary_length(bare)).to_numpy().copy()
        coded = bare.dictionary_encode()
        words = listed(coded.dictionary)
        new = [word for word in words if word not in self.words]
        if new:
            self._learn_words(new)
        # a stretch is a word and its marks, or something else as a whole
        parts = np.zeros((len(stretches), 2), dtype=np.int64)
        parts[:, 0] = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))[coded.indices.to_numpy()]
        marks[parts[:, 0] == NO_WORD] = 0
        marked = np.flatnonzero(marks)
        parts[marked, 1] = self._numbers_of_others(
            [piece[-n:] for piece, n in zip(listed(stretches.take(pa.array(marked))), marks[marked].tolist())]
        )
        others = np.flatnonzero(parts[:, 0] == NO_WORD)
        parts[others, 0] = self._numbers_of_others(listed(stretches.take(pa.array(others))))
        first = self.bounds[parts]
        length = self.bounds[parts + 1] - first
        own, _ = _gathered(self.flat, first.ravel(), length.ravel())
        length = length.sum(axis=1)
        joined, behind = _gathered(own, (np.cumsum(length) - length)[number], length[number])
        joined, cuts = joined.tobytes(), [0, *(4 * behind[ends]).tolist()]
        out = [joined[begin:end] for begin, end in zip(cuts, cuts[1:])]
        for i in whole:
            out[i] = np.array(self._encode([texts[i]])[0], dtype="<u4").tobytes()
        return out


def in_groups(texts: list[str], characters: int = 4_000_000):
    """Slices of a list of texts of about so many characters."""
    start = total = 0
    for i, text in enumerate(texts):
        total += len(text)
        if total >= characters:
            yield slice(start, i + 1)
            start, total = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))
