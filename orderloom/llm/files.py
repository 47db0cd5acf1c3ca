"""Writing and reading files of the shared folder from tasks, committed by renaming a temporary name."""

from __future__ import annotations

import uuid


def filesystem(uri: str):
    """A file system and the path in it; a text without scheme is a path."""
    from pyarrow import fs

    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)
    return fs.LocalFileSystem(), uri


class Committed:
    """A file that appears under its name only once it is whole; a second attempt of a task replaces it by the same bytes."""

    def __init__(self, uri: str):
        self.fs, self.path = filesystem(uri)
        self.temporary = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.stream, self.size = self.fs.open_output_stream(self.temporary, compression=None), 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def commit(self) -> None:
        self.stream.close()
        self.fs.move(self.temporary, self.path)
