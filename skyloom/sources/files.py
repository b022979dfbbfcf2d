"""Files in a folder that driver and executors share, from inside tasks, on any file system that pyarrow knows."""

from __future__ import annotations

import uuid


def opened(uri: str):
    """The file system and path of a URI or an absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri("/" + uri[5:].lstrip("/") if uri.startswith("file:") else uri)


def put(uri: str, data: bytes) -> None:
    """A file that is there whole or not at all: written beside its place and moved."""
    where, path = opened(uri)
    draft = f"{path}.{uuid.uuid4()}.draft"
    with where.open_output_stream(draft, compression=None) as out:
        out.write(data)
    where.move(draft, path)


def get(uri: str) -> bytes:
    where, path = opened(uri)
    with where.open_input_stream(path, compression=None) as f:
        return f.read()


def names(uri: str) -> list[str]:
    """Names of whole files in a folder, sorted; none where there is no such folder."""
    from pyarrow import fs

    where, path = opened(uri)
    found = where.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == fs.FileType.File and not f.base_name.endswith(".draft"))


def folder(uri: str) -> None:
    where, path = opened(uri)
    where.create_dir(path, recursive=True)


def remove(uri: str) -> None:
    from pyarrow import fs

    where, path = opened(uri)
    if where.get_file_info(path).type != fs.FileType.NotFound:
        where.delete_file(path)
