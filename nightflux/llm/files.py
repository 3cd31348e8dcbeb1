"""Binary files in the shared folder, written by tasks so that a lost or repeated task does no harm."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs


def place(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder's URI; a path without a scheme is a file system path."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class Target:
    """One output file.  It is written under a name of this attempt alone; only files that a manifest names count,

    so that the leftovers of lost attempts are never read.
    """

    def __init__(self, folder: str, name: str):
        fs, path = place(folder)
        fs.create_dir(path, recursive=True)
        self.name = f"{name}-{uuid.uuid4().hex}"
        self.stream = fs.open_output_stream(f"{path}/{self.name}", compression=None, buffer_size=1 << 20)

    def __enter__(self) -> Target:
        return self

    def write(self, data: bytes) -> None:
        self.stream.write(data)

    def __exit__(self, *_) -> None:
        self.stream.close()


def opened(folder: str, name: str):
    """A seekable input file."""
    fs, path = place(folder)
    return fs.open_input_file(f"{path}/{name}")
