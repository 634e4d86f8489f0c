"""Reading and writing raw files in tasks, in folders that driver and executors share."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

import pyarrow.fs as pafs


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), unquote(urlparse(path).path)
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


class NewFile:
    """A file that appears under its name only when it is whole.

    It is written under a name no other attempt uses and moved at the end, so a task that
    is lost or runs twice leaves no half file under a name anyone reads.
    """

    def __init__(self, path: str):
        self.fs, self.path = file_system(path)
        self.fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.part = f"{os.path.dirname(self.path)}/.{os.path.basename(self.path)}.{uuid.uuid4().hex}"
        self.out, self.size = self.fs.open_output_stream(self.part), 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.part, self.path)


def open_file(path: str):
    """A random-access file with ``read``, ``seek`` and ``size``."""
    fs, p = file_system(path)
    return fs.open_input_file(p)
