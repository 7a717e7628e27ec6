"""Files of the shared folder as seen from Python tasks (any store that pyarrow opens: file, hdfs, s3, gs)."""

from __future__ import annotations

import pyarrow.fs as pafs


def store(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return pafs.LocalFileSystem(), path


def writable(path: str):
    """An output stream, with the folders above it."""
    fs, inner = store(path)
    fs.create_dir(inner.rpartition("/")[0], recursive=True)
    return fs.open_output_stream(inner, compression=None)  # else the name decides


def readable(path: str):
    """A file that can seek."""
    fs, inner = store(path)
    return fs.open_input_file(inner)


def delete(path: str) -> None:
    fs, inner = store(path)
    fs.delete_file(inner)
