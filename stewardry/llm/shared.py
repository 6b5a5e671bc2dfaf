"""What tasks leave for others: files in the folder that all executors share, and what a
Python worker keeps from one task to the next."""

from __future__ import annotations

import gc
import os
import sys
import tempfile
import uuid
from collections.abc import Callable
from typing import TypeVar

import pyarrow as pa
from pyarrow import fs

T = TypeVar("T")


def put(folder: str, name: str, content: bytes) -> str:
    """Writes a new file and returns its name; a repeated attempt writes another one."""
    name = f"{name}-{uuid.uuid4().hex}"
    where, path = fs.FileSystem.from_uri(folder)
    where.create_dir(path, recursive=True)
    with where.open_output_stream(f"{path}/{name}") as out:
        out.write(content)
    return name


def local_path(folder: str, name: str) -> tuple[str, bool]:
    """A path that can be memory-mapped, and whether it is a copy to be removed once open."""
    where, path = fs.FileSystem.from_uri(folder)
    if isinstance(where, fs.LocalFileSystem):
        return f"{path}/{name}", False
    handle, copy = tempfile.mkstemp(prefix="shard-")
    with where.open_input_stream(f"{path}/{name}") as source, os.fdopen(handle, "wb") as out:
        while block := source.read(1 << 22):
            out.write(block)
    return copy, True


def kept_per_worker(name: str, make: Callable[[], T]) -> T:
    """What `make` gave this Python worker first; later tasks of the worker find it again.

    Only the thing asked for last is kept: a worker serves many stages one after another.
    Functions that are shipped by value have no module of their own to keep it in.
    """
    store = vars(sys.modules["__main__"]).setdefault("_kept_per_worker", {})
    if name not in store:
        store.clear()
        store[name] = make()
    return store[name]


def give_back() -> None:
    """Returns to the system what Arrow's pool of this worker has free."""
    gc.collect()
    pa.default_memory_pool().release_unused()
