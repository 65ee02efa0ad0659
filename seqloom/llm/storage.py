"""Flat files in a store that all executors share: local folders, or what pyarrow.fs can open."""

from __future__ import annotations

import uuid

import numpy as np
from pyarrow import fs


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


def make_dir(uri: str) -> None:
    store, path = _at(uri)
    store.create_dir(path, recursive=True)


class Writer:
    """A file that appears under its name only when it is complete; a second attempt replaces it."""

    def __init__(self, uri: str) -> None:
        self.store, self.path = _at(uri)
        self.part = f"{self.path}.{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.part)

    def write(self, data: bytes) -> None:
        self.out.write(data)

    def commit(self) -> None:
        self.out.close()
        self.store.move(self.part, self.path)


def put(uri: str, data: bytes) -> None:
    w = Writer(uri)
    w.write(data)
    w.commit()


def get(uri: str) -> bytes:
    store, path = _at(uri)
    with store.open_input_file(path) as f:
        return f.read()


def mapped(uri: str, dtype: str) -> np.ndarray:
    """The whole file as an array: memory-mapped where the store is a local folder."""
    store, path = _at(uri)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r") if store.get_file_info(path).size else np.zeros(0, dtype=dtype)
    return np.frombuffer(get(uri), dtype=dtype)
