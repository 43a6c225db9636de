"""ZIP packages of stored members: written as a stream, read by ranges of the file and never extracted.

The writer doesn't know a member's size before its end, so sizes and checksum follow the member and stand in the central
directory, whose offsets and sizes take 64 bits throughout. The reader also takes plain 32-bit directories, comments at the end, and
packages whose ZIP64 fields are only partly used.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable
from dataclasses import dataclass

_LOCAL = "<4s5H3I2H"
_DESCRIPTOR = "<4sI2Q"
_CENTRAL = "<4s6H3I5H2I"
_END64 = "<4sQ2H2I4Q"
_LOCATOR = "<4sIQI"
_END = "<4s4H2IH"
_LOCAL_SIZE, _CENTRAL_SIZE, _END64_SIZE, _LOCATOR_SIZE, _END_SIZE = map(struct.calcsize, (_LOCAL, _CENTRAL, _END64, _LOCATOR, _END))
_ZIP64_EXTRA = 1
_NEEDS_ZIP64, _SIZES_FOLLOW, _UTF8_NAME = 45, 1 << 3, 1 << 11
_MOST16, _MOST32 = 0xFFFF, 0xFFFFFFFF
_DATE = 33  # 1980-01-01, the first day a package can name


class BrokenPackage(ValueError):
    """Not a whole package of stored members."""


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    encrypted: bool
    stored: int  # bytes in the package
    size: int
    header: int  # offset of the local header
    crc: int


class PackageWriter:
    """Members one after the other into ``out``, a function that takes bytes."""

    def __init__(self, out: Callable[[bytes], object]):
        self._out = out
        self.written = 0
        self._done: list[tuple[bytes, int, int, int]] = []
        self._name: bytes | None = None

    def _put(self, data: bytes) -> None:
        self._out(data)
        self.written += len(data)

    def open(self, name: str) -> None:
        self._name, self._start, self._crc, self._size = name.encode(), self.written, 0, 0
        extra = struct.pack("<2H2Q", _ZIP64_EXTRA, 16, 0, 0)
        self._put(struct.pack(
            _LOCAL, b"PK\x03\x04", _NEEDS_ZIP64, _SIZES_FOLLOW | _UTF8_NAME, 0, 0, _DATE, 0, _MOST32, _MOST32, len(self._name), len(extra),
        ) + self._name + extra)

    def write(self, data: bytes) -> int:
        """Returns the place of ``data`` in the member."""
        place = self._size
        self._crc = zlib.crc32(data, self._crc)
        self._size += len(data)
        self._put(data)
        return place

    def close_member(self) -> None:
        self._put(struct.pack(_DESCRIPTOR, b"PK\x07\x08", self._crc, self._size, self._size))
        self._done.append((self._name, self._start, self._crc, self._size))

    def finish(self) -> None:
        start = self.written
        for name, header, crc, size in self._done:
            extra = struct.pack("<2H3Q", _ZIP64_EXTRA, 24, size, size, header)
            self._put(struct.pack(
                _CENTRAL, b"PK\x01\x02", _NEEDS_ZIP64, _NEEDS_ZIP64, _SIZES_FOLLOW | _UTF8_NAME, 0, 0, _DATE, crc, _MOST32, _MOST32,
                len(name), len(extra), 0, 0, 0, 0, _MOST32,
            ) + name + extra)
        length, end, count = self.written - start, self.written, len(self._done)
        self._put(struct.pack(_END64, b"PK\x06\x06", _END64_SIZE - 12, _NEEDS_ZIP64, _NEEDS_ZIP64, 0, 0, count, count, length, start))
        self._put(struct.pack(_LOCATOR, b"PK\x06\x07", 0, end, 1))
        self._put(struct.pack(_END, b"PK\x05\x06", 0, 0, _MOST16, _MOST16, _MOST32, _MOST32, 0))


def members(read: Callable[[int, int], bytes], length: int) -> list[Member]:
    """The central directory of a package of ``length`` bytes; ``read(offset, n)`` gives a range of it."""
    count, size, start = _directory(read, length)
    data = read(start, size)
    found, at = [], 0
    for _ in range(count):
        if data[at : at + 4] != b"PK\x01\x02":
            raise BrokenPackage("the central directory ends early")
        (_, _, _, flags, method, _, _, crc, stored, full, name_n, extra_n, comment_n, _, _, _, header) = struct.unpack_from(_CENTRAL, data, at)
        name = data[at + _CENTRAL_SIZE : at + _CENTRAL_SIZE + name_n]
        extra = data[at + _CENTRAL_SIZE + name_n : at + _CENTRAL_SIZE + name_n + extra_n]
        full, stored, header = _widened(extra, full, stored, header)
        text = name.decode("utf-8" if flags & _UTF8_NAME else "cp437")
        found.append(Member(text, method, bool(flags & 1), stored, full, header, crc))
        at += _CENTRAL_SIZE + name_n + extra_n + comment_n
    return found


def _directory(read: Callable[[int, int], bytes], length: int) -> tuple[int, int, int]:
    """Entries, bytes and offset of the central directory."""
    reach = min(length, _END_SIZE + _MOST16)
    tail = read(length - reach, reach)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and (at + _END_SIZE > reach or at + _END_SIZE + struct.unpack_from(_END, tail, at)[7] != reach):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise BrokenPackage("no end of central directory")
    _, _, _, _, count, size, start, _ = struct.unpack_from(_END, tail, at)
    if count != _MOST16 and _MOST32 not in (size, start):
        return count, size, start
    place = length - reach + at - _LOCATOR_SIZE
    locator = read(place, _LOCATOR_SIZE) if place >= 0 else b""
    if locator[:4] != b"PK\x06\x07":
        return count, size, start  # a plain package may truly be this large
    end64 = read(struct.unpack(_LOCATOR, locator)[2], _END64_SIZE)
    if end64[:4] != b"PK\x06\x06":
        raise BrokenPackage("no ZIP64 end of central directory")
    *_, count, size, start = struct.unpack(_END64, end64)
    return count, size, start


def _widened(extra: bytes, *fields: int) -> list[int]:
    """Size, stored size and offset, with those that the 32-bit fields can't hold taken from the ZIP64 field in turn."""
    wide: list[int] = []
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<2H", extra, at)
        if kind == _ZIP64_EXTRA:
            wide = list(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
        at += 4 + n
    if sum(field == _MOST32 for field in fields) > len(wide) and wide:
        raise BrokenPackage("a ZIP64 field is too short")
    return [wide.pop(0) if field == _MOST32 and wide else field for field in fields]


def place_of(read: Callable[[int, int], bytes], member: Member) -> int:
    """Offset of a stored member's first byte: the local header has a name and extra fields of its own."""
    if member.method or member.encrypted:
        raise BrokenPackage(f"{member.name} isn't stored as it is")
    header = read(member.header, _LOCAL_SIZE)
    if header[:4] != b"PK\x03\x04":
        raise BrokenPackage(f"no local header of {member.name}")
    name_n, extra_n = struct.unpack(_LOCAL, header)[9:11]
    return member.header + _LOCAL_SIZE + name_n + extra_n
