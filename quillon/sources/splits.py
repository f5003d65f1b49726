"""Byte ranges of files whose records have no marks: where a range's first record begins, and which records are a range's own.

Blocks of a BGZF file (BAM, bgzip) begin with a header that says how long they are; a place is a block's beginning if the header is right and so is that of the next block. A BAM record
begins where its fields keep the header's ranges and their own lengths, and so do the records behind it. A FASTQ record begins at a line with @ before a line of letters and one with +; a line of qualities may begin
with @, but the line behind it doesn't have letters only. A line belongs to the range that holds the line break before it, a BAM record to that which holds the block it begins in, so each record is read once.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

#: Bytes looked at for a block's beginning at once, records that must follow each other, and bytes of a piece of a plain file.
LOOK, CHAIN, PIECE = 1 << 17, 8, 1 << 20
_HEAD = b"\x1f\x8b\x08\x04"
_SEQUENCE = re.compile(rb"[A-Za-z*.\-]*\r?\n?")


def block_size(head: bytes) -> int | None:
    """Length of the block that begins with these 18 bytes; None if none does."""
    if len(head) < 18 or head[:4] != _HEAD or head[12:16] != b"BC\x02\x00" or struct.unpack_from("<H", head, 10)[0] < 6:
        return None
    return struct.unpack_from("<H", head, 16)[0] + 1


def is_blocked(raw) -> bool:
    raw.seek(0)
    return block_size(raw.read(18)) is not None


def block_at(raw, at: int, size: int) -> int:
    """Place of the first block that begins at a place or behind it; the file's size if none does."""
    while at < size:
        raw.seek(at)
        seen = raw.read(LOOK + 18)
        k = seen.find(_HEAD)
        while 0 <= k < LOOK:
            n = block_size(seen[k : k + 18])
            if n:
                raw.seek(at + k + n)
                if at + k + n == size or block_size(raw.read(18)):
                    return at + k
            k = seen.find(_HEAD, k + 1)
        at += LOOK
    return size


def blocks(raw, at: int) -> Iterator[tuple[int, bytes]]:
    """(place, content) of the blocks from a place on."""
    while True:
        raw.seek(at)
        head = raw.read(18)
        if not head:
            return
        n = block_size(head)
        if n is None:
            raise ValueError("not a blocked gzip file")
        yield at, zlib.decompress(raw.read(n - 18)[:-8], -15)
        at += n


def pieces(raw, at: int) -> Iterator[tuple[int, bytes]]:
    raw.seek(at)
    while data := raw.read(PIECE):
        yield at, data
        at += len(data)


def ranges(size: int, split: int) -> list[tuple[int, int]]:
    return [(a, min(a + split, size)) for a in range(0, size, split)] or [(0, 0)]


# lines


def owned_lines(raw, lo: int, size: int, blocked: bool) -> Iterator[tuple[int, bytes]]:
    """(place of the line break before it, line) of each line from the first break at lo or behind it on; the file's first line has place -1. Of a blocked file, places are those of blocks."""
    tail, owner = (b"", -1) if lo == 0 else (b"", None)  # None: within a line that an earlier range has
    for at, data in blocks(raw, block_at(raw, lo, size) if lo else 0) if blocked else pieces(raw, lo):
        start = 0
        while (end := data.find(b"\n", start)) >= 0:
            if owner is not None:
                yield owner, tail + data[start:end]
            tail, start, owner = b"", end + 1, at if blocked else at + end
        tail += data[start:]
    if owner is not None and tail:
        yield owner, tail


def _begins(lines: list[bytes]) -> bool:
    """Whether records of four lines, as many as are there, begin with the first line."""
    for k, x in enumerate(lines):
        ok = x[:1] == b"@" if k % 4 == 0 else _SEQUENCE.fullmatch(x) if k % 4 == 1 else x[:1] == b"+" if k % 4 == 2 else len(x.rstrip(b"\r")) == len(lines[k - 2].rstrip(b"\r"))
        if not ok:
            return False
    return True


def fastq_records(raw, lo: int, hi: int, size: int, blocked: bool) -> Iterator[tuple[str, str, str]]:
    """(name, sequence, qualities) of the range's own records."""
    lines = owned_lines(raw, lo, size, blocked)
    held: list[tuple[int, bytes]] = []
    if lo:
        for x in lines:
            held.append(x)
            if len(held) == 4 * CHAIN:
                break
        first = next((k for k in range(min(4, len(held))) if _begins([x for _, x in held[k:]])), len(held))
        held = held[first:]
    held.reverse()
    take = lambda: held.pop() if held else next(lines, None)
    while (head := take()) is not None:
        if not head[1].strip():
            continue
        if head[0] >= hi:
            return
        rest = [take() for _ in range(3)]
        seq, plus, qual = ((x[1] if x else b"").rstrip(b"\r") for x in rest)
        if head[1][:1] != b"@" or plus[:1] != b"+" or len(seq) != len(qual):
            raise ValueError(f"not a FASTQ record: {head[1][:80].decode(errors='replace')}")
        yield head[1][1:].split()[0].decode(), seq.decode(), qual.decode()


# alignments


def plausible(data: bytes, at: int, lengths: list[int]) -> int | None:
    """The end of the alignment that begins at a place of data, which has its fixed fields; None if none can."""
    if at + 36 > len(data):
        return None
    size, ref, pos, l_name, _, _, n_ops, _, l_seq, next_ref, next_pos = struct.unpack_from("<iiiBBHHHiii", data, at)
    if not (-1 <= ref < len(lengths) and -1 <= next_ref < len(lengths) and l_name > 0 and 0 <= l_seq < 1 << 28):
        return None
    if not (-1 <= pos <= (lengths[ref] if ref >= 0 else 1 << 31) and -1 <= next_pos <= (lengths[next_ref] if next_ref >= 0 else 1 << 31)):
        return None
    if not 32 + l_name + 4 * n_ops + (l_seq + 1) // 2 + l_seq <= size < 1 << 28:
        return None
    name = data[at + 36 : at + 36 + l_name]
    if len(name) == l_name and (name[-1] or not all(33 <= c <= 126 for c in name[:-1])):
        return None
    ops = data[at + 36 + l_name : at + 36 + l_name + 4 * n_ops]
    if any(c & 15 > 8 for c in ops[::4]):
        return None
    return at + 4 + size


def first_record(data: bytes, lengths: list[int], ended: bool) -> int | None:
    """Where the first alignment begins in data, the content of some blocks; ended: no more follows. None if it can't be told yet."""
    for at in range(len(data) + 1):
        k, n = at, 0
        while n < CHAIN:
            if k == len(data):
                break
            nxt = plausible(data, k, lengths)
            if nxt is None:
                break
            k, n = nxt, n + 1
            if k > len(data):
                break
        if n == CHAIN or ended and k == len(data):
            return at
        if not ended and (k > len(data) or k == len(data) or n == 0 and at + 36 > len(data) or n and k + 36 > len(data)):
            return None  # more blocks are needed to decide
    return len(data)


def alignments(raw, lo: int, hi: int, size: int, skip: int, lengths: list[int]) -> Iterator[bytes]:
    """The range's own alignments as bytes without their length. skip: bytes of the header, for the range that begins at 0."""
    data, starts, found = b"", [], lo == 0
    source = blocks(raw, block_at(raw, lo, size) if lo else 0)
    at = skip if lo == 0 else 0
    while not found:  # blocks enough to know where a record begins
        nxt = next(source, None)
        if nxt is not None:
            if nxt[0] >= hi and not data:
                return
            starts.append((len(data), nxt[0]))
            data += nxt[1]
        where = first_record(data, lengths, nxt is None)
        if where is not None:
            at, found = where, True
        elif nxt is None:
            return
    now = 0  # the block that holds the next record's beginning
    while True:
        while len(data) < at + 4 or len(data) < at + 4 + struct.unpack_from("<i", data, at)[0]:
            nxt = next(source, None)
            if nxt is None:
                return
            if 1 << 18 <= at <= len(data):  # what has been read goes
                while now + 1 < len(starts) and starts[now + 1][0] <= at:
                    now += 1
                starts, now = [(s - at, o) for s, o in starts[now:]], 0
                data, at = data[at:], 0
            starts.append((len(data), nxt[0]))
            data += nxt[1]
        while now + 1 < len(starts) and starts[now + 1][0] <= at:
            now += 1
        if starts[now][1] >= hi:
            return
        n = struct.unpack_from("<i", data, at)[0]
        yield data[at + 4 : at + 4 + n]
        at += 4 + n
