"""Binary files in a folder that all executors share: a local mount, or a store that Arrow's file systems reach."""

from __future__ import annotations

import os
from urllib.parse import unquote, urlparse

import numpy as np


def local_path(uri: str) -> str | None:
    """The path of a file on a mounted folder, None for a store."""
    parts = urlparse(uri)
    if parts.scheme == "file":
        return unquote(parts.path)
    return uri if not parts.scheme else None


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def open_new(uri: str):
    """A stream to write; folders on the way are made."""
    path = local_path(uri)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb", buffering=1 << 20)
    store, inner = _store(uri)
    return store.open_output_stream(inner)


def read(uri: str) -> bytes:
    path = local_path(uri)
    if path is not None:
        with open(path, "rb") as stream:
            return stream.read()
    store, inner = _store(uri)
    with store.open_input_file(inner) as stream:
        return stream.read()


def mapped(uri: str, kind: np.dtype) -> np.ndarray:
    """The numbers of a flat file: memory-mapped on a mounted folder, read from a store."""
    path = local_path(uri)
    if path is None:
        return np.frombuffer(read(uri), kind)
    return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)


def read_range(uri: str, offset: int, length: int) -> bytes:
    """`length` bytes from `offset` on; a file that ends before is an error."""
    path = local_path(uri)
    if path is not None:
        with open(path, "rb", buffering=0) as stream:
            stream.seek(offset)
            data = b"".join(iter(lambda: stream.read(min(length - stream.tell() + offset, 1 << 24)), b""))
    else:
        store, inner = _store(uri)
        with store.open_input_file(inner) as stream:
            data = stream.read_at(length, offset)
    if len(data) != length:
        raise OSError(f"{uri} ends before {offset + length}")
    return data
