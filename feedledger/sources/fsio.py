"""Byte I/O for per-file helpers running inside tasks, through Arrow's filesystem layer, so the
same code reads local paths, ``file:`` URIs and cluster URIs (hdfs://, s3://, ...)."""

from __future__ import annotations

import hashlib
import uuid


def resolve(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        local = "/" + path[5:].lstrip("/")
        return fs.LocalFileSystem(), local
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def hidden(name: str) -> bool:
    """Names that Spark's readers pass over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def entries(path: str) -> list[tuple[str, bool, int, int]]:
    """(path, is directory, bytes, modification time in ms) of what a directory shows: directories and
    files that are not empty. A path that is a file shows itself; one that is not there is an error."""
    from pyarrow import fs

    filesystem, p = resolve(path)
    info = filesystem.get_file_info(p)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        shown = [(path, info)]
    else:
        shown = [(f"{path.rstrip('/')}/{i.base_name}", i) for i in filesystem.get_file_info(fs.FileSelector(p)) if not hidden(i.base_name)]
    return [(at, not i.is_file, i.size or 0, (i.mtime_ns or 0) // 1_000_000) for at, i in shown if i.type == fs.FileType.Directory or (i.is_file and i.size)]


def read_bytes(path: str) -> bytes:
    filesystem, p = resolve(path)
    with filesystem.open_input_stream(p) as f:
        return f.read()


def move(src: str, dst: str) -> None:
    """Move a file, making the folder it goes to and replacing what is there."""
    filesystem, a = resolve(src)
    _, b = resolve(dst)
    filesystem.create_dir(b.rsplit("/", 1)[0], recursive=True)
    filesystem.move(a, b)


def _beside(path: str) -> str:
    """A new name in the same folder, which listings of data files do not show."""
    folder, name = path.rsplit("/", 1)
    return f"{folder}/.{name}.{uuid.uuid4().hex[:12]}"


def put(path: str, data: bytes) -> None:
    """Write a whole file under another name, then move it to its own."""
    beside = _beside(path)
    write_bytes(beside, data)
    move(beside, path)


def copy_with_digest(src: str, dst: str, chunk: int = 4 << 20) -> tuple[str, int]:
    """Copy a file in chunks, under another name and then to its own; (sha256 hex, bytes). What an
    error leaves behind is removed."""
    from_fs, a = resolve(src)
    beside = _beside(dst)
    to_fs, b = resolve(beside)
    digest, size = hashlib.sha256(), 0
    with from_fs.open_input_stream(a) as source:
        to_fs.create_dir(b.rsplit("/", 1)[0], recursive=True)
        try:
            with to_fs.open_output_stream(b) as out:
                while data := source.read(chunk):
                    digest.update(data)
                    out.write(data)
                    size += len(data)
            move(beside, dst)
        except BaseException:
            if to_fs.get_file_info(b).is_file:
                to_fs.delete_file(b)
            raise
    return digest.hexdigest(), size


def write_bytes(path: str, data: bytes) -> None:
    filesystem, p = resolve(path)
    parent = p.rsplit("/", 1)[0]
    if parent:
        filesystem.create_dir(parent, recursive=True)
    with filesystem.open_output_stream(p) as f:
        f.write(data)
