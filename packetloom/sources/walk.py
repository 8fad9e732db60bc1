"""From record to record through one capture file, classic or pcapng.

A record's start depends on the length of the one before, so this is the only
part of reading captures that Spark's expressions cannot do. ``walker`` gives an object that
steps from a record's first byte to the next one; ``plausible_start`` guesses where
a record starts in the middle of a file. Guesses are checked by ``sources.captures``.
"""

import hashlib
import struct
from urllib.parse import urlsplit

import numpy as np
from pyarrow import fs

# Fixed values of the classic format: file magic (read big-endian) to byte
# order and fraction of a second.
MAGIC = {
    0xA1B2C3D4: (">", 10**6),
    0xD4C3B2A1: ("<", 10**6),
    0xA1B23C4D: (">", 10**9),
    0x4D3CB2A1: ("<", 10**9),
}
FILE_HEADER, RECORD_HEADER = 24, 16
# Fixed values of pcapng: kinds of blocks, the magic that tells the byte order,
# option codes, the time resolution without an option.
SECTION, INTERFACE, OLD_PACKET, SIMPLE_PACKET, PACKET = 0x0A0D0D0A, 1, 2, 3, 6
ORDER_MAGIC = 0x1A2B3C4D
OPTION_END, OPTION_RESOLUTION, OPTION_OFFSET = 0, 9, 14
RESOLUTION = 10**6
# Fixed value: no capture tool writes a longer record.
MAX_RECORD = 262144
MAX_BLOCK = 16 * 1024 * 1024

WINDOW = 1 << 20
#: Records that must follow each other where one is guessed, and the time they may be off.
CHAIN, SPREAD = 4, 366 * 86400
UNKNOWN_KIND = "not a capture file of a known kind"


class Damaged(ValueError):
    """A record that no capture tool writes."""


def located(path):
    """File system and name in it of a path as Spark gives it."""
    if urlsplit(path).scheme in ("", "file"):
        name = path.removeprefix("file:")
        return fs.LocalFileSystem(), "/" + name.lstrip("/") if name.startswith("//") else name
    return fs.FileSystem.from_uri(path)


class Content:
    """Bytes of a file that is in memory."""

    def __init__(self, content):
        self.content, self.size = content, len(content)

    def read(self, at, n):
        return self.content[at : at + n]


class File:
    """Bytes of a file, read by windows; ``size`` may hide what was written since."""

    def __init__(self, path, size=None, step=WINDOW):
        system, name = located(path)
        self.file = system.open_input_file(name)
        self.size = self.file.size() if size is None else size
        self.at, self.window, self.step = 0, b"", step

    def read(self, at, n):
        n = max(0, min(n, self.size - at))
        if at < self.at or at + n > self.at + len(self.window):
            self.file.seek(at)
            self.at, self.window = at, self.file.read(max(n, min(self.step, self.size - at)))
        return self.window[at - self.at : at - self.at + n]

    def close(self):
        self.file.close()


class Records:
    """Classic format. ``step`` takes the place of a record's header."""

    def __init__(self, data):
        head = data.read(0, FILE_HEADER)
        self.data, self.start, self.heads = data, FILE_HEADER, b""
        self.order, self.fraction = MAGIC[struct.unpack_from(">I", head)[0]]
        self.link = struct.unpack_from(self.order + "I", head, 20)[0] & 0xFFFF if len(head) == FILE_HEADER else 0
        self.header = struct.Struct(self.order + "IIII")

    def step(self, at):
        """The record's end and packet (link type, time, start, end), or None if it is incomplete."""
        head = self.data.read(at, RECORD_HEADER)
        if len(head) < RECORD_HEADER:
            return None
        seconds, part, size, _ = self.header.unpack(head)
        first, end = at + RECORD_HEADER, at + RECORD_HEADER + size
        if size > MAX_RECORD:
            raise Damaged(f"damaged capture record of {size} bytes before byte {first}")
        if end > self.data.size:
            return None
        return end, (self.link, (seconds * self.fraction + part) / self.fraction, first, end)

    def packet(self, found):
        return found

    def candidates(self, at, n):
        """Places from ``at`` on, ``n`` at most, where a record's header may stand."""
        raw = np.frombuffer(self.data.read(at, n + RECORD_HEADER - 1), np.uint8).astype(np.int64)
        n = len(raw) - RECORD_HEADER + 1
        if n <= 0:
            return []

        def number(k):
            parts = [raw[k + i : k + i + n] for i in range(4)]
            parts = parts[::-1] if self.order == ">" else parts
            return parts[0] | parts[1] << 8 | parts[2] << 16 | parts[3] << 24

        began = self.header.unpack(self.data.read(self.start, RECORD_HEADER))[0]
        size = number(8)
        good = (number(4) < self.fraction) & (size <= MAX_RECORD) & (number(12) >= size) & (abs(number(0) - began) < SPREAD)
        return at + np.flatnonzero(good)

    def looks_right(self, at):
        return len(self.candidates(at, 1)) == 1


class Blocks:
    """pcapng. The section's byte order and its interfaces are state.

    ``heads`` are the bytes of the last section's head and interfaces as far as they
    were met: what a walk that starts further on has to know.
    """

    def __init__(self, data, order=None, heads=b""):
        self.data, self.start, self.order, self.heads, self.links = data, 0, order, b"", []
        known, at = Content(heads), 0
        while at < known.size:
            at = Blocks._step(self, known, at)[0]
        self.heads = b""
        if self.order is None:
            self.order = self._section_order(data.read(8, 4))

    @staticmethod
    def _section_order(magic):
        for order in "<>":
            if len(magic) == 4 and struct.unpack(order + "I", magic)[0] == ORDER_MAGIC:
                return order
        raise Damaged("damaged section header")

    def step(self, at):
        return self._step(self.data, at)

    def _step(self, data, at):
        """End of the block, and its packet if it holds one; None if it is incomplete."""
        head = data.read(at, 12)
        if len(head) < 12:
            return None
        order = self.order
        if struct.unpack(">I", head[:4])[0] == SECTION:
            order = self._section_order(head[8:])
        kind, size = struct.unpack(order + "II", head[:8])
        if size < 12 or size % 4 or size > MAX_BLOCK:
            raise Damaged(f"damaged block of {size} bytes at byte {at}")
        if at + size > data.size:
            return None
        if data.read(at + size - 4, 4) != head[4:8]:
            raise Damaged(f"block at byte {at} does not end with its length")
        packet = None
        if kind in (SECTION, INTERFACE):
            block = data.read(at, size)
            if kind == SECTION:
                self.order, self.links, self.heads = order, [], block
            else:
                self.links.append(self._interface(block[8:-4], at))
                self.heads += block
        elif kind in (PACKET, OLD_PACKET, SIMPLE_PACKET):
            packet = (kind, at + 8, size - 12)
            fixed = 4 if kind == SIMPLE_PACKET else 20
            if size - 12 < fixed:
                raise Damaged(f"packet block at byte {at} is too short")
            if fixed == 20 and struct.unpack(order + "I", data.read(at + 20, 4))[0] > size - 32:
                raise Damaged(f"packet block at byte {at} is shorter than its packet")
        return at + size, packet

    def _interface(self, body, at):
        if len(body) < 8:
            raise Damaged(f"interface block at byte {at} is too short")
        link, _, snap = struct.unpack_from(self.order + "HHI", body)
        ticks, offset, k = RESOLUTION, 0, 8
        while k + 4 <= len(body):
            code, size = struct.unpack_from(self.order + "HH", body, k)
            value = body[k + 4 : k + 4 + size]
            if code == OPTION_END:
                break
            if code == OPTION_RESOLUTION and size == 1:
                ticks = 2 ** (value[0] & 0x7F) if value[0] & 0x80 else 10 ** value[0]
            if code == OPTION_OFFSET and size == 8:
                offset = struct.unpack(self.order + "q", value)[0]
            k += 4 + size + -size % 4
        return link, ticks, offset, snap

    def packet(self, found):
        """Link type, time, start and end of a packet block.

        A simple one has no time; one of an interface that the section does not
        describe has neither link type nor time.
        """
        kind, at, size = found
        body = self.data.read(at, min(size, 20))
        if kind == SIMPLE_PACKET:
            captured = struct.unpack_from(self.order + "I", body)[0]
            link, _, _, snap = self.links[0] if self.links else (None, None, None, 0)
            return link, None, at + 4, at + 4 + min([captured, size - 4] + [snap] * (snap > 0))
        number = struct.unpack_from(self.order + ("H" if kind == OLD_PACKET else "I"), body)[0]
        high, low, captured = struct.unpack_from(self.order + "III", body, 4)
        first = at + 20
        if number >= len(self.links):
            return None, None, first, first + captured
        link, ticks, offset, _ = self.links[number]
        return link, (high << 32 | low) / ticks + offset, first, first + captured

    def candidates(self, at, n):
        """Places where a block may start: it ends with its length, as it begins."""
        found, at = [], at + -at % 4
        raw = self.data.read(at, n + 8)
        sizes = np.frombuffer(raw[: len(raw) // 4 * 4], np.dtype(self.order + "u4")).astype(np.int64)[1:]
        for k in np.flatnonzero((sizes >= 12) & (sizes % 4 == 0) & (sizes <= MAX_BLOCK)):
            place, size = at + 4 * int(k), int(sizes[k])
            if place + size > self.data.size or self.data.read(place + size - 4, 4) == raw[4 * k + 4 : 4 * k + 8]:
                found.append(place)
        return found

    def looks_right(self, at):
        return self.candidates(at, 4)[:1] == [at]


def starts_section(heads):
    return heads[:4] == struct.pack(">I", SECTION)


def walker(data, order=None, heads=b""):
    """Walker for a file's format, or None while the file is too short to tell; other files raise."""
    head = data.read(0, 12)
    if len(head) < 4:
        return None
    first = struct.unpack_from(">I", head)[0]
    if first in MAGIC:
        return Records(data) if data.size >= FILE_HEADER else None
    if first == SECTION:
        return Blocks(data, order, heads) if len(head) == 12 else None
    raise Damaged(UNKNOWN_KIND)


def packets(walk, at, to):
    """End and packet of each complete record that starts in ``[at, to)`` and holds a packet."""
    while at < to:
        found = walk.step(at)
        if found is None:
            return
        at, packet = found
        if packet:
            yield at, walk.packet(packet)


def plausible_start(walk, at, to):
    """First place in ``[at, to)`` from which records seem to follow each other."""
    while at < to:
        n = min(to - at, 1 << 16)
        for start in walk.candidates(at, n):
            start = int(start)
            if start < to and _chained(walk, start):
                return start
        at += n
    return None


def _chained(walk, at):
    """Some records follow each other from ``at`` on, or up to the end of the file."""
    for _ in range(CHAIN):
        if not walk.looks_right(at):
            return at >= walk.data.size
        size = struct.unpack_from(walk.order + "I", walk.data.read(at + (8 if isinstance(walk, Records) else 4), 4))[0]
        at += size + (RECORD_HEADER if isinstance(walk, Records) else 0)
        if at + RECORD_HEADER > walk.data.size:
            return True
    return True


def capture_name(data, walk):
    """Digest of a file up to the end of its first packet: it stays while the capture grows.

    Empty if there is no complete packet yet.
    """
    for end, _ in packets(walk, walk.start, data.size):
        whole = hashlib.md5()
        for at in range(0, end, WINDOW):
            whole.update(data.read(at, min(WINDOW, end - at)))
        return whole.hexdigest()
    return ""
