"""ZIP archives of stored members: a writer, and a reader that asks only for the byte ranges it needs.

Layouts and signatures are those of the public ZIP application note (with its ZIP64 extension).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable
from dataclasses import dataclass

LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
BIG, MANY = 0xFFFFFFFF, 0xFFFF


class ZipError(ValueError):
    """The bytes are not a readable archive."""


@dataclass
class Member:
    name: str
    method: int
    stored_size: int
    size: int
    header_at: int


def write_zip(members: list[tuple[str, bytes]], zip64: bool = False) -> bytes:
    """An archive of stored members; ZIP64 records where sizes need them or zip64 asks for them."""
    out, entries = bytearray(), []
    for name, data in members:
        at, raw, crc = len(out), name.encode(), zlib.crc32(data)
        out += LOCAL + struct.pack("<HHHHHIIIHH", 20, 0x800, 0, 0, 0x21, crc, len(data), len(data), len(raw), 0) + raw + data
        entries.append((raw, crc, len(data), at))
    start = len(out)
    for raw, crc, size, at in entries:
        wide = zip64 or at >= BIG
        extra = struct.pack("<HHQQQ", 1, 24, size, size, at) if wide else b""
        shown = (BIG, BIG, BIG) if wide else (size, size, at)
        out += CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45 if wide else 20, 0x800, 0, 0, 0x21, crc, shown[0], shown[1], len(raw), len(extra), 0, 0, 0, 0, shown[2]) + raw + extra
    length = len(out) - start
    if zip64 or len(entries) >= MANY or start >= BIG:
        at = len(out)
        out += END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, len(entries), len(entries), length, start)
        out += LOCATOR64 + struct.pack("<IQI", 0, at, 1)
        out += END + struct.pack("<HHHHIIH", 0, 0, MANY, MANY, BIG, BIG, 0)
    else:
        out += END + struct.pack("<HHHHIIH", 0, 0, len(entries), len(entries), length, start, 0)
    return bytes(out)


def list_members(read: Callable[[int, int], bytes], size: int) -> list[Member]:
    """Members by the central directory. read(offset, length) returns bytes of the archive."""
    back = min(size, 22 + 65_535)
    tail = read(size - back, back)
    at = tail.rfind(END)
    while at >= 0 and (len(tail) - at < 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(END, 0, at)  # the signature inside the comment
    if at < 0:
        raise ZipError("no end of central directory")
    _, _, _, count, length, start, _ = struct.unpack_from("<HHHHIIH", tail, at + 4)
    if count == MANY or length == BIG or start == BIG:
        end_at = size - back + at
        if end_at >= 20 and (locator := read(end_at - 20, 20))[:4] == LOCATOR64:
            record = read(struct.unpack_from("<Q", locator, 8)[0], 56)
            if record[:4] != END64:
                raise ZipError("no ZIP64 end of central directory where its locator points")
            count, length, start = struct.unpack_from("<QQQ", record, 32)
    directory, members, p = read(start, length), [], 0
    for _ in range(count):
        if directory[p : p + 4] != CENTRAL:
            raise ZipError("the central directory is damaged")
        flags, method = struct.unpack_from("<HH", directory, p + 8)
        stored, plain, n, e, c = struct.unpack_from("<IIHHH", directory, p + 20)
        header_at = struct.unpack_from("<I", directory, p + 42)[0]
        name, extra = directory[p + 46 : p + 46 + n], directory[p + 46 + n : p + 46 + n + e]
        q = 0
        while q + 4 <= len(extra):
            tag, width = struct.unpack_from("<HH", extra, q)
            if tag == 1:  # only the fields that did not fit are there, in this order
                field = q + 4
                if plain == BIG:
                    plain, field = struct.unpack_from("<Q", extra, field)[0], field + 8
                if stored == BIG:
                    stored, field = struct.unpack_from("<Q", extra, field)[0], field + 8
                if header_at == BIG:
                    header_at = struct.unpack_from("<Q", extra, field)[0]
            q += 4 + width
        members.append(Member(name.decode("utf-8" if flags & 0x800 else "cp437"), method, stored, plain, header_at))
        p += 46 + n + e + c
    return members


def data_offset(read: Callable[[int, int], bytes], member: Member) -> int:
    """Where a member's bytes begin: its local header has a length of its own."""
    head = read(member.header_at, 30)
    if head[:4] != LOCAL:
        raise ZipError("no local header where the directory points")
    n, e = struct.unpack_from("<HH", head, 26)
    return member.header_at + 30 + n + e
