"""Binary files that tasks write to, and read from, a shared folder by URI.

A file appears under its name only when it is complete: a task writes an
attempt's own name first and moves it, so a repeated task after a lost
executor replaces the file by equal content.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote, urlparse


def filesystem(uri: str):
    """(pyarrow file system, path) of a folder or file URI."""
    from pyarrow import fs

    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path) if parts.scheme else uri
    return fs.FileSystem.from_uri(uri)


def put(uri: str, data: bytes) -> None:
    fs, path = filesystem(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    own = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(own) as out:
        out.write(data)
    fs.move(own, path)


def opened(uri: str):
    fs, path = filesystem(uri)
    return fs.open_input_file(path)


def listed(uri: str, ending: str) -> list[tuple[str, int]]:
    """(URI, bytes) of the files of a folder with an ending, by name."""
    from pyarrow import fs as pafs

    fs, path = filesystem(uri)
    found = fs.get_file_info(pafs.FileSelector(path, recursive=True, allow_not_found=True))
    head = uri.rstrip("/")
    return sorted((head + f.path[len(path.rstrip("/")):], f.size) for f in found
                  if f.is_file and f.path.endswith(ending) and not f.base_name.startswith("."))
