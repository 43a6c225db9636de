"""Cutting many texts at ASCII white space at once, without a Python object for every word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SEPARATOR = b"\xff"  # in no UTF-8 text, surrogates included
_WORD, _SPACE, _END = 0, 1, 2
_KIND = np.full(256, _WORD, dtype=np.uint8)
_KIND[list(b" \t\n\x0b\x0c\r")] = _SPACE
_KIND[SEPARATOR[0]] = _END


def cut(texts: list[bytes], with_spaces: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct stretches of the texts, each stretch's number among them in order, and where each text's SEPARATOR stands, which
    is a stretch of its own behind the text.

    A stretch is a word. With spaces, a space before a word belongs to it, and a run of white space is one stretch but for
    its last character, which is one by itself if it isn't such a space; at a text's end the whole run is one."""
    codes = np.frombuffer(SEPARATOR.join(texts) + SEPARATOR, dtype=np.uint8)
    kind = _KIND[codes]
    before = np.concatenate([[np.uint8(_END)], kind[:-1]])
    if with_spaces:
        word_next = np.append(kind[1:] == _WORD, False)
        begins = (kind == _END) | (before == _END)
        begins |= (kind == _SPACE) & ((before == _WORD) | word_next)
        begins[1:] |= (kind[1:] == _WORD) & (kind[:-1] == _SPACE) & (codes[:-1] != ord(" "))
    else:
        begins = (kind == _END) | ((kind == _WORD) & (before != _WORD))
        kept = kind != _SPACE
        begins, codes = begins[kept], codes[kept]
    starts = np.flatnonzero(begins)
    bounds = np.append(starts, len(codes)).astype(np.int64)
    coded = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(codes))]
    ).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), np.flatnonzero(codes[starts] == SEPARATOR[0])


def listed(stretches: pa.Array) -> list[bytes]:
    """As Python objects, made in one go."""
    return stretches.to_numpy(zero_copy_only=False).tolist()
