"""zstandard-compressed JSON lines as bytes: frames, sidecars, joining of files and torn tails.

Everything here works on bytes and paths, in Python workers or on the driver; nothing parses JSON.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Callable, Iterable, Iterator
from typing import BinaryIO

import zstandard

MAGIC = b"\x28\xb5\x2f\xfd"
LEVEL = 3
PIECE = 1 << 20
#: Largest skippable-frame magic range of the format.
_SKIP = range(0x184D2A50, 0x184D2A60)


class TornFrame(ValueError):
    """The bytes end inside a frame, or what follows is no frame."""


def compress_frame(lines: Iterable[bytes], level: int = LEVEL) -> bytes:
    """The lines, each ended by a newline, as one frame of its own with content size and checksum."""
    body = b"".join(line if line.endswith(b"\n") else line + b"\n" for line in lines)
    return zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True).compress(body)


def frame_length(data: bytes | memoryview, at: int) -> int:
    """Bytes of the frame that begins there, from its headers alone (RFC 8878): nothing is decompressed."""
    n = len(data)

    def need(upto: int) -> None:
        if upto > n:
            raise TornFrame(f"frame at {at} ends beyond the file")

    need(at + 5)
    word = int.from_bytes(data[at : at + 4], "little")
    if word in _SKIP:
        need(at + 8)
        end = at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")
        need(end)
        return end - at
    if bytes(data[at : at + 4]) != MAGIC:
        raise TornFrame(f"no frame at {at}")
    flags = data[at + 4]
    single, has_sum = flags >> 5 & 1, flags >> 2 & 1
    p = at + 5 + (0 if single else 1) + (0, 1, 2, 4)[flags & 3]
    size_flag = flags >> 6
    p += (1 if single else 0, 2, 4, 8)[size_flag]
    while True:
        need(p + 3)
        head = int.from_bytes(data[p : p + 3], "little")
        last, kind, size = head & 1, head >> 1 & 3, head >> 3
        if kind == 3:
            raise TornFrame(f"bad block at {p}")
        p += 3 + (1 if kind == 1 else size)
        need(p)
        if last:
            break
    p += 4 * has_sum
    need(p)
    return p - at


def good_length(data: bytes) -> tuple[int, int]:
    """(bytes, frames) of the whole frames that a file begins with; less than its length: the tail is torn."""
    view, at, frames = memoryview(data), 0, 0
    while at < len(data):
        try:
            at += frame_length(view, at)
        except TornFrame:
            break
        frames += 1
    return at, frames


def read_lines(source: bytes | BinaryIO) -> Iterator[bytes]:
    """The non-empty lines of all frames, without their newline. A torn file raises zstandard.ZstdError or TornFrame."""
    f = io.BytesIO(source) if isinstance(source, (bytes, bytearray, memoryview)) else source
    rest, ended = b"", True
    d = zstandard.ZstdDecompressor().decompressobj()
    while piece := f.read(PIECE):
        while piece:
            if d.eof:
                d = zstandard.ZstdDecompressor().decompressobj()
            rest += d.decompress(piece)
            ended = d.eof
            piece = d.unused_data if d.eof else b""
        *lines, rest = rest.split(b"\n")
        yield from (x for x in lines if x.strip())
    if not ended:
        raise TornFrame("the file ends inside a frame")
    if rest.strip():
        yield rest


def read_frames(source: BinaryIO) -> Iterator[tuple[int, bytes]]:
    """(bytes of the file up to its end, content) of each whole frame, piece by piece: no more than one frame is held.
    Ends before a torn tail; whether there is one is seen by the last frame's end."""
    done = fed = 0
    out: list[bytes] = []
    d = zstandard.ZstdDecompressor().decompressobj()
    while piece := source.read(PIECE):
        fed += len(piece)
        while piece:
            try:
                out.append(d.decompress(piece))
            except zstandard.ZstdError:
                return
            if not d.eof:
                break
            piece = d.unused_data
            done = fed - len(piece)
            yield done, b"".join(out)
            out, d = [], zstandard.ZstdDecompressor().decompressobj()


def is_compressed(head: bytes) -> bool:
    return head[:4] == MAGIC or (len(head) >= 4 and int.from_bytes(head[:4], "little") in _SKIP)


def sha256_of(source: BinaryIO) -> str:
    """Checksum of a file, piece by piece."""
    sha = hashlib.sha256()
    while piece := source.read(PIECE):
        sha.update(piece)
    return sha.hexdigest()


def sidecar_text(data: bytes, name: str) -> str:
    return f"{hashlib.sha256(data).hexdigest()}  {name}\n"


def sidecar_ok(data: bytes, sidecar: str) -> bool:
    parts = sidecar.split()
    return bool(parts) and parts[0] == hashlib.sha256(data).hexdigest()


class JoinError(ValueError):
    """Joining did not give what was expected; nothing was published."""


def join_files(sources: list[tuple[str, int | None]], target: str, open_read: Callable[[str], BinaryIO], open_write: Callable[[str], BinaryIO], publish: Callable[[str, str], None]) -> dict:
    """Joins files byte by byte into target: whole zstandard frames as they are, plain newline-delimited files with
    a newline between where one lacks it. No JSON is parsed and nothing is recompressed.

    sources: (path, expected bytes or None), in order. Each source must have its expected length, and a
    compressed one must consist of whole frames; compressed and plain files don't mix. The joined bytes go to a
    temporary name and are read again: each member's bytes at its offset must have the checksum of what was read
    from its source, and nothing may follow. Then the file is published under the target's name: a reader sees the
    whole file or none, and a repeated run replaces it by the same bytes. Source files are not deleted here. Empty
    sources are skipped. members: (source, offset, bytes, sha256, whether a newline was added) of the others.
    """
    members: list[tuple[str, int, int, str, bool]] = []
    kind: bool | None = None
    at = 0
    temporary = f"{target}.joining"
    with open_write(temporary) as out:
        for path, expected in sources:
            with open_read(path) as f:
                data = f.read()  # a small file by definition of the plan; bounded by its size limit
            if expected is not None and len(data) != expected:
                raise JoinError(f"{path}: {len(data)} bytes instead of {expected}")
            if not data:
                continue
            packed = is_compressed(data)
            if kind is not None and packed != kind:
                raise JoinError(f"{path}: compressed and plain files can't be joined")
            kind = packed
            if packed and good_length(data)[0] != len(data):
                raise JoinError(f"{path}: torn tail after {good_length(data)[0]} bytes")
            ended = packed or data.endswith(b"\n")
            if not ended:
                data += b"\n"
            out.write(data)
            members.append((path, at, len(data), hashlib.sha256(data).hexdigest(), not ended))
            at += len(data)
    whole = hashlib.sha256()
    with open_read(temporary) as f:
        for path, _, size, told, _ in members:
            own = hashlib.sha256()
            while size and (piece := f.read(min(size, PIECE))):
                own.update(piece)
                whole.update(piece)
                size -= len(piece)
            if size or own.hexdigest() != told:
                raise JoinError(f"{target}: what was written of {path} differs from what was read")
        if f.read(1):
            raise JoinError(f"{target}: bytes follow the last member")
    publish(temporary, target)
    return {"target_path": target, "source_files": len(members), "bytes": at, "sha256": whole.hexdigest(), "members": members}
