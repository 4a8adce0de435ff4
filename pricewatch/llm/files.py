"""Files that tasks write to and read from the shared folder, whatever store it is in."""

from __future__ import annotations

import mmap
import uuid
from urllib.parse import unquote, urlparse


def filesystem(uri: str):
    """The file system of a URI and the path in it."""
    from pyarrow import fs

    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path)
    return fs.FileSystem.from_uri(uri)


def write_file(folder: str, name: str, chunks) -> str:
    """Write chunks of bytes; the name holds a random part, so a repeated task never touches another's file."""
    store, path = filesystem(folder)
    store.create_dir(path, recursive=True)
    full = f"{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(f"{path}/{full}", compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
    return f"{folder}/{full}"


def open_input(uri: str):
    store, path = filesystem(uri)
    return store.open_input_file(path)


def mapped(uri: str) -> memoryview:
    """The file's bytes, memory-mapped where the store is a mounted path; read whole elsewhere."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        with open(unquote(parts.path), "rb") as f:
            return memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
    with open_input(uri) as f:
        return memoryview(f.read())
