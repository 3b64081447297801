"""Decoding of crawl archives: bytes in, response records out.

The helpers work on an iterator of byte chunks, so an archive is never held
whole; memory is bounded by the largest single record.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

from ..functions import formats as fmt

MAGIC = b"\x1f\x8b\x08"
_STEP = 8 << 20
_END = b"\r\n\r\n"


MEMBER_END = "end of member"


class DamagedRecord(ValueError):
    """A stretch of an archive that cannot be read."""


def inflate(
    chunks: Iterable[bytes], begins: Callable[[int], None] | None = None
) -> Iterator[bytes | str | DamagedRecord]:
    """Plain bytes of an archive that is gzipped member by member, or not at all.

    ``MEMBER_END`` marks where a gzip member ends. A damaged member is reported
    in place; reading goes on at the next one. ``begins`` is told the offset of every member
    that follows the one before without bytes in between.
    """
    carry, gzipped, member, lost = b"", None, None, False
    passed = 0
    for chunk in chunks:
        data, carry = carry + chunk, b""
        passed += len(chunk)  # what is left of the chunks so far ends here
        if gzipped is None:
            if len(data) < len(MAGIC):
                carry = data
                continue
            gzipped = data.startswith(MAGIC)
        if not gzipped:
            yield data
            continue
        while data:
            if member is None:
                at = data.find(MAGIC)
                if at < 0:
                    lost = lost or bool(data[:-2].strip(b"\0"))
                    carry = data[-2:]
                    break
                lost = lost or bool(data[:at].strip(b"\0"))
                if lost:
                    yield DamagedRecord("bytes between archive members")
                elif begins:
                    begins(passed - len(data) + at)
                lost = False
                data, member = data[at:], zlib.decompressobj(31)
            try:
                yield member.decompress(data, _STEP)
            except zlib.error as problem:
                yield DamagedRecord(f"damaged archive member: {problem}")
                member, data = None, data[1:]
                continue
            if member.eof:
                yield MEMBER_END
                data, member = member.unused_data, None
            else:
                data = member.unconsumed_tail
    if gzipped is None and carry:
        yield carry
    if member is not None:
        yield DamagedRecord("archive ends inside a member")


def first_member_at(chunks: Iterable[bytes], offsets: set[int]) -> int | None:
    """The first of the offsets where reading these chunks in a row begins a member."""
    found: list[int] = []

    def begins(at: int) -> None:
        if at in offsets:
            found.append(at)

    for _ in inflate(chunks, begins):
        if found:
            break
    return found[0] if found else None


def _headers(block: bytes) -> dict[str, str]:
    found = {}
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            found.setdefault(name.strip().lower(), value.strip())
    return found


def _unchunk(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else 0
        except ValueError:
            # Announced as chunked but stored as one piece.
            return b"".join(out) if out else body
        if size == 0:
            return b"".join(out) if out or end >= 0 else body
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size


def _decode_body(body: bytes, encoding: str) -> bytes:
    modes = {"gzip": (31,), "x-gzip": (31,), "deflate": (15, -15)}.get(encoding, ())
    for mode in modes:
        try:
            return zlib.decompressobj(mode).decompress(body)
        except zlib.error:
            continue
    return body


def payload(uri: str, block: bytes) -> bytes:
    """Page inside an HTTP response block: header off, transfer and content coding undone."""
    if not (uri or "").lower().startswith(("http://", "https://")):
        return block
    head, gap, body = block.partition(_END)
    if not gap or not head.startswith(b"HTTP/"):
        return block
    http = _headers(head)
    if http.get("transfer-encoding", "").lower() == "chunked":
        body = _unchunk(body)
    return _decode_body(body, http.get("content-encoding", "").lower())


def responses(chunks: Iterable[bytes]) -> Iterator[tuple[str | None, str | None, str | None]]:
    """``(uri, content, error)`` of each response record; the bodies of others are not kept."""
    buffer = bytearray()
    unwanted = 0  # bytes of a passed-over body still to come
    head: dict[str, str] | None = None
    skipping = False
    for piece in inflate(chunks):
        if isinstance(piece, (str, DamagedRecord)):
            if isinstance(piece, DamagedRecord):
                yield None, None, str(piece)
            elif not skipping and (unwanted or head is not None or buffer.strip(b"\r\n\0")):
                yield None, None, "archive member ends inside a record"
            buffer.clear()
            head, skipping, unwanted = None, False, 0
            continue
        if skipping:
            continue
        if unwanted:
            gone = min(unwanted, len(piece))
            unwanted, piece = unwanted - gone, piece[gone:]
        buffer += piece
        while True:
            if head is None:
                while buffer[:2] == b"\r\n":
                    del buffer[:2]
                end = buffer.find(_END)
                if end < 0:
                    break
                block = bytes(buffer[:end])
                head = _headers(block)
                if not block.startswith(b"WARC/") or not head.get("content-length", "").isdigit():
                    # Nothing tells where the next record starts: go on at the next member.
                    yield None, None, "not an archive record"
                    buffer.clear()
                    head, skipping = None, True
                    break
                del buffer[: end + len(_END)]
            size = int(head["content-length"])
            wanted = head.get("warc-type") == fmt.RESPONSE
            if len(buffer) < size:
                if not wanted:
                    unwanted, head = size - len(buffer), None
                    buffer.clear()
                break
            if wanted:
                uri = head.get(fmt.TARGET_URI.lower())
                # Bytes that are not valid UTF-8 are dropped.
                yield uri, payload(uri, bytes(buffer[:size])).decode("utf-8", "ignore"), None
            del buffer[:size]
            head = None
    if not skipping and (unwanted or head is not None or buffer.strip(b"\r\n\0")):
        yield None, None, "archive ends inside a record"
