"""Files of the operators' own formats, through ``pyarrow.fs``."""

from __future__ import annotations

from pyarrow import fs

#: Names that Hadoop gives to stores which pyarrow knows by another one.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfs": "abfss"}


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder given as a path or a Hadoop URI, and the path inside it."""
    scheme, mark, rest = folder.partition("://")
    if not mark:
        return fs.LocalFileSystem(), folder.removeprefix("file:")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")
