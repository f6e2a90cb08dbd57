"""Files that tasks write and read themselves: a shared file system by path, any other store through pyarrow."""

from __future__ import annotations

import os
from typing import BinaryIO
from urllib.parse import unquote, urlparse


def _local(path: str) -> str | None:
    parsed = urlparse(path)
    return unquote(parsed.path) if parsed.scheme in ("", "file") else None


def open_new(path: str) -> BinaryIO:
    """A new file of a name that no other attempt uses."""
    local = _local(path)
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        return open(local, "xb")
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    return store.open_output_stream(name)


def open_old(path: str) -> BinaryIO:
    local = _local(path)
    if local is not None:
        return open(local, "rb")
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_stream(name)


def open_random(path: str) -> BinaryIO:
    """A file whose parts are read at places chosen by the caller."""
    local = _local(path)
    if local is not None:
        return open(local, "rb")
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)
