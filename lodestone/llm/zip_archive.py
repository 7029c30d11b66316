"""Reading and writing ZIP packages of stored members by byte ranges."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable
from typing import NamedTuple

# Fixed values of the ZIP format: signatures, record layouts, markers.
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
LOCAL_FORM = "<4s5H3I2H"
CENTRAL_FORM = "<4s6H3I5H2I"
END_FORM = "<4s4H2IH"
END64_FORM = "<4sQ2H2I4Q"
LOCATOR64_FORM = "<4sIQI"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
ZIP64_FIELD = 0x0001
UTF8_NAMES = 0x0800
STORED = 0
VERSION = 45
DATE = 0x0021  # the format's first day

ReadAt = Callable[[int, int], bytes]


class Member(NamedTuple):
    name: str
    method: int
    size: int
    header_at: int
    crc: int


class NotAnArchive(ValueError):
    """The bytes hold no readable ZIP directory, or a member that can't be read by range."""


def _wide(extra: bytes, fields: list[int]) -> list[int]:
    """Fields whose 32 bits are full, taken from the ZIP64 extra field in their order."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == ZIP64_FIELD:
            values = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            try:
                return [next(values) if f == FULL32 else f for f in fields]
            except StopIteration:
                raise NotAnArchive("a ZIP64 field is too short") from None
        at += 4 + length
    return fields


def directory(read_at: ReadAt, size: int) -> dict[str, Member]:
    """Members by name, from the central directory; only directories are read."""
    tail_at = max(0, size - struct.calcsize(END_FORM) - FULL16)
    tail = read_at(tail_at, size - tail_at)
    found = tail.rfind(END)
    while found >= 0 and (
        len(tail) - found < struct.calcsize(END_FORM) or struct.unpack_from(END_FORM, tail, found)[-1] != len(tail) - found - struct.calcsize(END_FORM)
    ):
        found = tail.rfind(END, 0, found)
    if found < 0:
        raise NotAnArchive("no end of central directory")
    _, _, _, _, count, length, start, _ = struct.unpack_from(END_FORM, tail, found)
    if FULL16 == count or FULL32 in (length, start):
        at = tail_at + found - struct.calcsize(LOCATOR64_FORM)
        sign, _, end_at, _ = struct.unpack(LOCATOR64_FORM, read_at(at, struct.calcsize(LOCATOR64_FORM))) if at >= 0 else (b"", 0, 0, 0)
        if sign != LOCATOR64:
            raise NotAnArchive("no ZIP64 locator")
        sign, *_, count, length, start = struct.unpack(END64_FORM, read_at(end_at, struct.calcsize(END64_FORM)))
        if sign != END64:
            raise NotAnArchive("no ZIP64 end of central directory")
    if start + length > size:
        raise NotAnArchive("the central directory lies outside the archive")
    table, at, members = read_at(start, length), 0, {}
    for _ in range(count):
        if table[at : at + 4] != CENTRAL or at + struct.calcsize(CENTRAL_FORM) > len(table):
            raise NotAnArchive("a broken central directory")
        fields = struct.unpack_from(CENTRAL_FORM, table, at)
        flags, method, crc, packed, plain, names, extras, notes, header_at = (
            fields[3], fields[4], fields[7], fields[8], fields[9], fields[10], fields[11], fields[12], fields[16],
        )
        name_at = at + struct.calcsize(CENTRAL_FORM)
        name = table[name_at : name_at + names].decode("utf-8" if flags & UTF8_NAMES else "cp437")
        extra = table[name_at + names : name_at + names + extras]
        plain, packed, header_at = _wide(extra, [plain, packed, header_at])
        members[name] = Member(name, method, plain, header_at, crc)
        at = name_at + names + extras + notes
    return members


def data_start(read_at: ReadAt, member: Member) -> int:
    """Where a stored member's bytes begin, so that ranges of it can be read in place."""
    if member.method != STORED:
        raise NotAnArchive(f"{member.name} is compressed")
    fields = struct.unpack(LOCAL_FORM, read_at(member.header_at, struct.calcsize(LOCAL_FORM)))
    if fields[0] != LOCAL:
        raise NotAnArchive(f"{member.name} has no local header")
    return member.header_at + struct.calcsize(LOCAL_FORM) + fields[9] + fields[10]


def package(members: list[tuple[str, list[bytes]]]) -> bytes:
    """A ZIP64 archive of stored members, each given as a list of byte pieces."""
    out, central, at = [], [], 0

    def put(piece: bytes) -> None:
        nonlocal at
        out.append(piece)
        at += len(piece)

    for name, pieces in members:
        label, size, crc, header_at = name.encode(), sum(map(len, pieces)), 0, at
        for piece in pieces:
            crc = zlib.crc32(piece, crc)
        extra = struct.pack("<HHQQ", ZIP64_FIELD, 16, size, size)
        put(struct.pack(LOCAL_FORM, LOCAL, VERSION, UTF8_NAMES, STORED, 0, DATE, crc, FULL32, FULL32, len(label), len(extra)))
        put(label + extra)
        for piece in pieces:
            put(piece)
        extra = struct.pack("<HHQQQ", ZIP64_FIELD, 24, size, size, header_at)
        central.append(
            struct.pack(
                CENTRAL_FORM, CENTRAL, VERSION, VERSION, UTF8_NAMES, STORED, 0, DATE, crc, FULL32, FULL32, len(label), len(extra), 0, 0, 0, 0, FULL32
            )
            + label
            + extra
        )
    start = at
    for entry in central:
        put(entry)
    length, count, end_at = at - start, len(central), at
    put(struct.pack(END64_FORM, END64, struct.calcsize(END64_FORM) - 12, VERSION, VERSION, 0, 0, count, count, length, start))
    put(struct.pack(LOCATOR64_FORM, LOCATOR64, 0, end_at, 1))
    put(struct.pack(END_FORM, END, 0, 0, FULL16, FULL16, FULL32, FULL32, 0))
    return b"".join(out)
