"""The archive's file format, record by record: block-compressed SequenceFiles.

For Spark tasks that write or read objects as streams of bytes, without the JVM.
"""

from __future__ import annotations

import bz2
import os
import struct
from collections.abc import Iterable, Iterator
from typing import BinaryIO

from logstow.model import KEY_CLASS, VALUE_CLASS

# Fixed values of the format.
MAGIC = b"SEQ\x06"
CODEC_CLASS = "org.apache.hadoop.io.compress.BZip2Codec"
SYNC_ESCAPE = b"\xff\xff\xff\xff"
SYNC_SIZE = 16
#: Bytes of keys and values that are compressed together.
BLOCK_BYTES = 1_000_000


def pack_number(n: int) -> bytes:
    """A number that is not negative, in as few bytes as it needs."""
    if n <= 127:
        return bytes([n])
    size = (n.bit_length() + 7) // 8
    return bytes([256 - 112 - size]) + n.to_bytes(size, "big")


def unpack_number(data: bytes, at: int) -> tuple[int, int]:
    """The number at a position, and the position behind it."""
    first = data[at]
    if first <= 127:
        return first, at + 1
    size = 256 - 112 - first
    if not 1 <= size <= 8:
        raise ValueError("negative length")
    return int.from_bytes(data[at + 1 : at + 1 + size], "big"), at + 1 + size


def _named(text: str) -> bytes:
    raw = text.encode()
    return pack_number(len(raw)) + raw


class RecordWriter:
    """Writes (key, value) records to an open stream; `close` ends the file."""

    def __init__(self, out: BinaryIO):
        self.out, self.sync = out, os.urandom(SYNC_SIZE)
        out.write(
            MAGIC + _named(KEY_CLASS) + _named(VALUE_CLASS) + b"\x01\x01" + _named(CODEC_CLASS)
            + struct.pack(">i", 0) + self.sync
        )
        self._clear()

    def _clear(self) -> None:
        self.n, self.size = 0, 0
        self.parts: list[list[bytes]] = [[], [], [], []]

    def add(self, key: bytes, value: bytes) -> None:
        key, value = pack_number(len(key)) + key, struct.pack(">i", len(value)) + value
        for part, piece in zip(
            self.parts, (pack_number(len(key)), key, pack_number(len(value)), value), strict=True
        ):
            part.append(piece)
        self.n += 1
        self.size += len(key) + len(value)
        if self.size >= BLOCK_BYTES:
            self._flush()

    def _flush(self) -> None:
        if not self.n:
            return
        self.out.write(SYNC_ESCAPE + self.sync + pack_number(self.n))
        for part in self.parts:
            packed = bz2.compress(b"".join(part))
            self.out.write(pack_number(len(packed)) + packed)
        self._clear()

    def close(self) -> None:
        self._flush()
        self.out.close()


class _Bytes:
    """Reads an open stream by numbers and runs of bytes."""

    def __init__(self, source: BinaryIO):
        self.source = source

    def take(self, n: int) -> bytes:
        data = self.source.read(n)
        if len(data) != n:
            raise EOFError("the file ends within a record")
        return data

    def number(self) -> int:
        first = self.take(1)
        if first[0] <= 127:
            return first[0]
        return unpack_number(first + self.take(max(0, 256 - 112 - first[0])), 0)[0]

    def text(self) -> str:
        return self.take(self.number()).decode()


def _items(lengths: bytes, data: bytes, n: int) -> Iterator[bytes]:
    at, begin = 0, 0
    for _ in range(n):
        size, at = unpack_number(lengths, at)
        yield data[begin : begin + size]
        begin += size


def read_records(source: BinaryIO) -> Iterator[tuple[bytes, bytes]]:
    """All (key, value) records of an object, in order; other formats are refused."""
    stream = _Bytes(source)
    if stream.take(len(MAGIC)) != MAGIC:
        raise ValueError("not a SequenceFile of this version")
    classes, flags = [stream.text(), stream.text()], stream.take(2)
    if classes != [KEY_CLASS, VALUE_CLASS] or flags != b"\x01\x01" or stream.text() != CODEC_CLASS:
        raise ValueError("not a file of the archive's record classes and compression")
    for _ in range(2 * struct.unpack(">i", stream.take(4))[0]):
        stream.text()
    sync = stream.take(SYNC_SIZE)
    while escape := source.read(len(SYNC_ESCAPE)):
        if escape != SYNC_ESCAPE or stream.take(SYNC_SIZE) != sync:
            raise ValueError("a block does not begin with the file's mark")
        n = stream.number()
        parts = [bz2.decompress(stream.take(stream.number())) for _ in range(4)]
        keys, values = _items(parts[0], parts[1], n), _items(parts[2], parts[3], n)
        for key, value in zip(keys, values, strict=True):
            yield key[unpack_number(key, 0)[1] :], value[4 : 4 + struct.unpack(">i", value[:4])[0]]


def write_records(out: BinaryIO, records: Iterable[tuple[bytes, bytes]]) -> None:
    writer = RecordWriter(out)
    for key, value in records:
        writer.add(key, value)
    writer.close()
