"""Whole files that tasks write to and read from the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark import TaskContext


@contextmanager
def new_file(folder: str, name: str) -> Iterator:
    """A binary file that appears under its name only when it is complete.

    A lost or repeated attempt leaves at most a temporary file under its own name.
    """
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    temporary = f"{root}/.{name}.{TaskContext.get().taskAttemptId()}"
    with system.open_output_stream(temporary, compression=None) as out:
        yield out
    system.move(temporary, f"{root}/{name}")


def open_stream(path: str):
    system, place = fs.FileSystem.from_uri(path)
    return system.open_input_stream(place, compression=None)  # the caller unzips it


def open_random(path: str):
    """For random access; a local file is mapped, so reading it copies nothing."""
    system, place = fs.FileSystem.from_uri(path)
    if isinstance(system, fs.LocalFileSystem):
        import pyarrow as pa

        return pa.memory_map(place)
    return system.open_input_file(place)
