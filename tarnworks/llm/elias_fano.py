"""Elias-Fano coded monotone sequences, queried many places at once.

A sequence of n values below u keeps the low log2(u/n) bits of each value packed, and the high parts as a
bit vector in unary: value i sets bit (high + i). Two directories, the set and the clear bits before each word of the
vector, make a select one search and one word. They are stored, so that a reader of mapped files computes and holds
nothing of a size with the sequence. All queries take arrays.
"""

from __future__ import annotations

import json

import numpy as np

_AT_ONCE = 1 << 17
_U1, _U63 = np.uint64(1), np.uint64(63)
_IN_BYTE = np.array([[([i for i in range(8) if byte >> i & 1] + [0] * 8)[nth] for nth in range(8)] for byte in range(256)], np.uint8)


def _pack_low(values: np.ndarray, bits: int) -> np.ndarray:
    parts = []
    for start in range(0, len(values), 1 << 16):
        part = np.ascontiguousarray(values[start : start + (1 << 16)], dtype="<u8")
        parts.append(np.packbits(np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :bits].ravel(), bitorder="little"))
    packed = np.concatenate(parts) if parts else np.empty(0, np.uint8)
    return np.concatenate([packed, np.zeros(16 + -len(packed) % 8, np.uint8)]).view("<u8")


def encode(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """values: non-decreasing, unsigned, below ``universe``."""
    values = np.asarray(values, dtype=np.uint64)
    n = len(values)
    bits = max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)
    high = (values >> np.uint64(bits)).astype(np.int64)
    length = (int(high[-1]) if n else 0) + n + 1
    unary = np.zeros(-(-length // 64) * 64, dtype=bool)
    unary[high + np.arange(n)] = True
    words = np.packbits(unary, bitorder="little").view("<u8")
    ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
    kind = "<u4" if len(unary) < 1 << 32 else "<i8"
    low = _pack_low(values & np.uint64((1 << bits) - 1), bits) if bits else np.zeros(2, "<u8")
    return {
        "shape": np.array([n, bits], dtype="<i8"), "high": words, "low": low,
        "ones": ones.astype(kind), "zeros": (np.arange(len(ones)) * 64 - ones).astype(kind),
    }


def _select_in_words(words: np.ndarray, nth: np.ndarray) -> np.ndarray:
    at = np.zeros(len(words), dtype=np.uint8)
    nth = nth.astype(np.uint8)
    for width in (32, 16, 8):
        count = np.bitwise_count((words >> at) & np.uint64((1 << width) - 1))
        beyond = nth >= count
        nth -= count * beyond
        at += beyond * np.uint8(width)
    return at.astype(np.int64) + _IN_BYTE[(words >> at).astype(np.uint8), nth]


class Sequence:
    """Reader over the arrays that ``encode`` made, mapped or in memory."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.n, self.bits = (int(x) for x in arrays["shape"])
        self.high, self.low = arrays["high"], arrays["low"]
        self.ones, self.zeros = arrays["ones"], arrays["zeros"]

    def _select(self, nth: np.ndarray, directory: np.ndarray, flip: bool) -> np.ndarray:
        nth = nth.astype(directory.dtype)  # else the search would copy the directory
        word = np.searchsorted(directory, nth, side="right") - 1
        bits = self.high[word]
        return word * 64 + _select_in_words(~bits if flip else bits, nth - directory[word])

    def _next_zero(self, position: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """Position of the zero bit after the one at ``position``; ``nth`` is its number."""
        word, bit = position >> 6, (position & 63).astype(np.uint64)
        # bits above the known zero, that one itself read as set: the ones up to the next zero
        rest = ~((self.high[word] >> bit) | _U1) & (~np.uint64(0) >> bit)
        ones = np.bitwise_count((rest & (~rest + _U1)) - _U1).astype(np.int64)
        after = position + ones
        beyond = np.flatnonzero(rest == 0)  # it lies in a later word
        after[beyond] = self._select(nth[beyond], self.zeros, True)
        return after

    def _low_at(self, index: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(index), dtype=np.uint64)
        bit = index * self.bits
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        value = self.low[word] >> shift
        value |= (self.low[word + 1] << _U1) << (_U63 - shift)
        value &= np.uint64((1 << self.bits) - 1)
        return value

    def get(self, index: np.ndarray) -> np.ndarray:
        """The values at the given places."""
        out = np.empty(len(index), dtype=np.uint64)
        for start in range(0, len(index), _AT_ONCE):
            part = index[start : start + _AT_ONCE].astype(np.int64)
            high = (self._select(part, self.ones, False) - part).astype(np.uint64)
            out[start : start + _AT_ONCE] = (high << np.uint64(self.bits)) | self._low_at(part)
        return out

    def successor(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first element not below each value, and whether it equals the value."""
        place = np.full(len(values), self.n, dtype=np.int64)
        equal = np.zeros(len(values), dtype=bool)
        if not self.n:
            return place, equal
        last = np.int64(self.zeros[-1])
        for start in range(0, len(values), _AT_ONCE):
            part = values[start : start + _AT_ONCE].astype(np.uint64)
            high = (part >> np.uint64(self.bits)).astype(np.int64)
            inside = high < last  # high parts beyond the vector exceed every element
            if not inside.all():
                part, high = part[inside], high[inside]
            low = part & np.uint64((1 << self.bits) - 1)
            zero = self._select(np.maximum(high - 1, 0), self.zeros, True)
            begin, end = zero + 1 - high, self._next_zero(zero, high) - high
            lowest = high == 0
            begin[lowest], end[lowest] = 0, zero[lowest]
            end = np.minimum(end, self.n)
            # inside the bucket the low bits are in order; a crowded context can fill a bucket, so halve it
            same = np.zeros(len(high), dtype=bool)
            open_ = np.flatnonzero(begin < end)
            left, right, wanted = begin[open_], end[open_], low[open_]
            while len(open_):
                middle = (left + right) >> 1
                seen = self._low_at(middle)
                same[open_[seen == wanted]] = True  # the first element not below has been seen, unless it is the bucket's end
                below = seen < wanted
                left, right = np.where(below, middle + 1, left), np.where(below, right, middle)
                begin[open_] = left
                more = np.flatnonzero(left < right)
                open_, left, right, wanted = open_[more], left[more], right[more], wanted[more]
            place[start : start + _AT_ONCE][inside] = begin
            equal[start : start + _AT_ONCE][inside] = same
        return place, equal
        last = np.int64(self.zeros[-1])
        for start in range(0, len(values), _AT_ONCE):
            part = values[start : start + _AT_ONCE].astype(np.uint64)
            high = (part >> np.uint64(self.bits)).astype(np.int64)
            inside = np.flatnonzero(high < last)  # high parts beyond the vector exceed every element
            high, low = high[inside], (part & np.uint64((1 << self.bits) - 1))[inside]
            begin, end = np.zeros(len(high), dtype=np.int64), np.empty(len(high), dtype=np.int64)
            later = np.flatnonzero(high > 0)
            zero = self._select(high[later] - 1, self.zeros, True)
            begin[later] = zero + 1 - high[later]
            end[later] = self._next_zero(zero, high[later]) - high[later]
            end[high == 0] = self._select(np.zeros(1, dtype=np.int64), self.zeros, True)
            end = np.minimum(end, self.n)
            # inside the bucket the low bits are in order; a crowded context can fill a bucket, so halve it
            left, right = begin, end.copy()
            open_ = np.flatnonzero(left < right)
            while len(open_):
                middle = (left[open_] + right[open_]) >> 1
                below = self._low_at(middle) < low[open_]
                left[open_[below]] = middle[below] + 1
                right[open_[~below]] = middle[~below]
                open_ = open_[left[open_] < right[open_]]
            there = np.flatnonzero(left < end)
            same = there[self._low_at(left[there]) == low[there]]
            place[start + inside] = left
            equal[start + inside[same]] = True
        return place, equal


def pack(arrays: dict[str, np.ndarray], **facts) -> bytes:
    """One file of named arrays, each aligned to eight bytes, behind a JSON header."""
    entries, parts, at = {}, [], 0
    for name, array in arrays.items():
        raw = np.ascontiguousarray(array).tobytes()
        entries[name] = [array.dtype.str, at, len(array)]
        parts.append(raw + bytes(-len(raw) % 8))
        at += len(parts[-1])
    header = json.dumps({"arrays": entries, **facts}).encode()
    header += b" " * (-(len(header) + 8) % 8)
    return len(header).to_bytes(8, "little") + header + b"".join(parts)


def unpack(blob: np.ndarray) -> tuple[dict[str, np.ndarray], dict]:
    """Views into a mapped file; nothing is copied."""
    size = int.from_bytes(blob[:8].tobytes(), "little")
    header = json.loads(blob[8 : 8 + size].tobytes())
    body = blob[8 + size :]
    views = {
        name: np.frombuffer(body, dtype=np.dtype(kind), offset=at, count=n) if n else np.empty(0, np.dtype(kind))
        for name, (kind, at, n) in header.pop("arrays").items()
    }
    return views, header


def prefixed(name: str, arrays: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {f"{name}.{key}": array for key, array in arrays.items()}


def sequence(name: str, views: dict[str, np.ndarray]) -> Sequence:
    return Sequence({key.split(".", 1)[1]: array for key, array in views.items() if key.startswith(f"{name}.")})
