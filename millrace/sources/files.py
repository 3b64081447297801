"""Files as tasks open them, on any file system that Arrow reaches."""

from __future__ import annotations

from collections.abc import Iterator

CHUNK = 1 << 20


def arrow_path(path: str):
    """File system and path for a Hadoop style location."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    if path.startswith(("s3a://", "s3n://")):
        path = "s3" + path[3:]
    return fs.FileSystem.from_uri(path)


def opened(base: str, key: str):
    """A file opened for reading.

    ``base`` is a location with its file system, the key a plain path below it, in which no
    character has a meaning of its own. Without a base the key is the whole location.
    """
    if not base:
        system, name = arrow_path(key)
    else:
        system, root = arrow_path(base)
        name = f"{root.rstrip('/')}/{key}"
    return system.open_input_file(name)


def byte_range(source, start: int, end: int | None) -> Iterator[bytes]:
    """Bytes ``[start, end)`` of an open file in chunks; to its end if ``end`` is None."""
    source.seek(start)
    left = None if end is None else end - start
    while left is None or left > 0:
        chunk = source.read(CHUNK if left is None else min(CHUNK, left))
        if not chunk:
            return
        if left is not None:
            left -= len(chunk)
        yield chunk


def listed(base: str) -> list[tuple[str, int]]:
    """``key, size`` of the files below a folder, in the order of their keys; hidden ones are left out."""
    from pyarrow import fs

    system, root = arrow_path(base)
    root = root.rstrip("/")
    found = system.get_file_info(fs.FileSelector(root, recursive=True))
    names = [(f.path[len(root) + 1 :], f.size) for f in found if f.type == fs.FileType.File]
    return sorted((k, n) for k, n in names if not any(p.startswith(("_", ".")) for p in k.split("/")))
