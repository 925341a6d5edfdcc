"""Files written by tasks: a temporary name first, then the final one; manifests name what counts.

Tasks reach the shared folder through Arrow's file systems (local or mounted paths, HDFS, S3, GCS).
A repeated or speculative task writes the same bytes under another temporary name and moves them to
the same final name, so a lost executor leaves at most a temporary file that no manifest names.
"""
from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder named by a URI or a plain path."""
    if ":" not in uri:
        return fs.LocalFileSystem(), uri
    scheme, rest = uri.split(":", 1)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(uri)


@contextmanager
def committed(folder: str, name: str):
    """An output stream whose content gets its name only when it is complete."""
    files, path = open_folder(folder)
    files.create_dir(path, recursive=True)
    temporary = f"{path}/_{name}.{uuid.uuid4().hex}.tmp"
    with files.open_output_stream(temporary, compression=None) as out:
        yield out
    files.move(temporary, f"{path}/{name}")


def read_file(folder: str, name: str):
    files, path = open_folder(folder)
    return files.open_input_file(f"{path}/{name}")
