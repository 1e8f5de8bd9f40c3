"""Files that tasks write and read themselves, in the shared folder."""

from __future__ import annotations

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI (local, hdfs, s3, gs, ..) and the path within it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def make_folder(path: str) -> None:
    system, inner = opened(path)
    system.create_dir(inner, recursive=True)
