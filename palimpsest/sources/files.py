"""Reading file bytes inside tasks (local, HDFS, S3, ... through ``pyarrow.fs``).

Jobs that need image bytes (transcription, request building) carry only paths through
their joins and shuffles and read the bytes in the task that uses them, so bytes are
read once, only for pending items, and never shuffled.
"""

from __future__ import annotations

import functools
import os
import re
import uuid
from collections.abc import Callable, Iterator

_URI = re.compile(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/]*))?(.*)", re.DOTALL)


@functools.lru_cache(maxsize=16)
def _filesystem(scheme: str, netloc: str):
    from pyarrow import fs

    if scheme in ("", "file"):
        return fs.LocalFileSystem()
    return fs.FileSystem.from_uri(f"{scheme}://{netloc}/")[0]


def _place(path: str):
    """File system and path in it of a Spark path (``file:/...``, ``hdfs://...``, ``s3a://...``).
    Spark writes names as they are: a ``#`` or ``?`` belongs to them."""
    scheme, netloc, inner = (part or "" for part in _URI.fullmatch(path).groups())
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme.lower(), scheme.lower())
    fs = _filesystem(scheme, netloc)
    return fs, f"{netloc}{inner}" if scheme == "s3" else inner


def read_bytes(path: str) -> bytes:
    """Bytes of a file named by a Spark path."""
    fs, target = _place(path)
    with fs.open_input_stream(target) as f:
        return f.read()


def write_bytes(path: str, data: bytes) -> None:
    """Write one file (parents created), through the same filesystem layer as ``read_bytes``.
    Parents are looked at only if the file cannot be opened: tasks that fill one folder would
    wait for each other there at every file."""
    fs, target = _place(path)
    try:
        out = fs.open_output_stream(target)
    except OSError:
        parent = target.rsplit("/", 1)[0]
        if not parent:
            raise
        fs.create_dir(parent, recursive=True)
        out = fs.open_output_stream(target)
    with out as f:
        f.write(data)


def write_once(path: str, data: bytes) -> None:
    """Write one file so that readers see it whole or not at all; one that is there stays. The
    name it has until then begins with ``_``, which Spark's readers pass over."""
    from pyarrow import fs as pafs

    fs, target = _place(path)
    if fs.get_file_info(target).type != pafs.FileType.NotFound:
        return
    folder, name = path.rsplit("/", 1)
    early = f"{folder}/_{uuid.uuid4().hex}-{name}"
    write_bytes(early, data)
    fs.move(_place(early)[1], target)


def kind_of(path: str) -> str | None:
    """``folder``, ``file`` or None (nothing there)."""
    from pyarrow import fs as pafs

    fs, target = _place(path)
    return {pafs.FileType.Directory: "folder", pafs.FileType.NotFound: None}.get(fs.get_file_info(target).type, "file")


def list_folder(path: str, wanted: Callable[[str], bool]) -> Iterator[tuple[str, bool, int, int]]:
    """(name, is a folder, bytes, milliseconds of the last change) of the folders and the ``wanted``
    files right in a folder; on local storage one at a time, however many there are."""
    from pyarrow import fs as pafs

    fs, target = _place(path)
    if not isinstance(fs, pafs.LocalFileSystem):
        for i in fs.get_file_info(pafs.FileSelector(target)):
            if i.type == pafs.FileType.Directory:
                yield i.base_name, True, 0, 0
            elif wanted(i.base_name):
                yield i.base_name, False, i.size, i.mtime_ns // 1_000_000
        return
    with os.scandir(target) as entries:
        for e in entries:
            try:
                e.name.encode()
                if e.is_dir():
                    yield e.name, True, 0, 0
                elif wanted(e.name):
                    yield e.name, False, e.stat().st_size, e.stat().st_mtime_ns // 1_000_000
            except (FileNotFoundError, UnicodeEncodeError):  # gone since, or no name that Spark can hold
                continue
