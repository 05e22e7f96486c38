"""Filesystem access from inside tasks, through Arrow's filesystem layer.

Paths are the URIs Spark itself reports (``file:/...``, ``hdfs://...``,
``s3://...``), so executors read and write the same shared locations.
"""

from __future__ import annotations


def arrow_uri(uri: str) -> str:
    """Spark/Hadoop scheme -> the scheme Arrow's filesystems understand."""
    for hadoop, arrow in (("s3a://", "s3://"), ("s3n://", "s3://")):
        if uri.startswith(hadoop):
            return arrow + uri[len(hadoop):]
    return uri


def resolve(uri: str):
    from pyarrow import fs

    uri = arrow_uri(uri)
    if uri.startswith("file:"):
        path = uri[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
        return fs.LocalFileSystem(), path
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def open_output(uri: str):
    filesystem, path = resolve(uri)
    parent = path.rsplit("/", 1)[0]
    if parent:
        filesystem.create_dir(parent, recursive=True)
    return filesystem.open_output_stream(path)


def open_input(uri: str):
    filesystem, path = resolve(uri)
    return filesystem.open_input_file(path)


def delete_dir(uri: str) -> None:
    """Remove a folder and what it holds; a missing one is fine."""
    from pyarrow import fs

    filesystem, path = resolve(uri)
    if filesystem.get_file_info(path).type == fs.FileType.Directory:
        filesystem.delete_dir(path)


def move(uri: str, to: str) -> None:
    """Move a file, into a folder that need not be there yet."""
    filesystem, path = resolve(uri)
    target = resolve(to)[1]
    filesystem.create_dir(target.rsplit("/", 1)[0], recursive=True)
    filesystem.move(path, target)


def make_dirs(uri: str) -> None:
    filesystem, path = resolve(uri)
    filesystem.create_dir(path, recursive=True)


def exists(uri: str) -> bool:
    from pyarrow import fs

    filesystem, path = resolve(uri)
    return filesystem.get_file_info(path).type != fs.FileType.NotFound


def write_bytes(uri: str, data: bytes) -> None:
    with open_output(uri) as out:
        out.write(data)


def write_whole(uri: str, data: bytes) -> None:
    """Write a small file that readers see complete or not at all."""
    filesystem, path = resolve(uri)
    folder, name = path.rsplit("/", 1)
    hidden = f"{folder}/.{name}.tmp"
    filesystem.create_dir(folder, recursive=True)
    with filesystem.open_output_stream(hidden) as out:
        out.write(data)
    filesystem.move(hidden, path)


def subfolders(uri: str) -> list[str]:
    """The folders right below ``uri``; none where it's missing."""
    from pyarrow import fs as pafs

    filesystem, path = resolve(uri)
    found = filesystem.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return sorted(f"{uri.rstrip('/')}/{e.base_name}" for e in found if e.type == pafs.FileType.Directory)


def list_dir(uri: str, recursive: bool = False) -> list[tuple[str, str, int, object]]:
    """(uri, name, size, mtime) of the files below ``uri``, empty files included.

    Spark's own file scans drop zero-length files, so a listing that must
    show them is taken from the filesystem. Names starting with '_' or '.'
    are skipped, as Spark does.
    """
    from pyarrow import fs as pafs

    filesystem, path = resolve(uri)
    info = filesystem.get_file_info(path)
    if info.type == pafs.FileType.NotFound:
        return []
    if info.type == pafs.FileType.File:
        entries = [info]
        base_uri, base_path = uri.rsplit("/", 1)[0], path.rsplit("/", 1)[0]
    else:
        entries = filesystem.get_file_info(pafs.FileSelector(path, recursive=recursive))
        base_uri, base_path = uri.rstrip("/"), path.rstrip("/")
    out = []
    for e in entries:
        if e.type != pafs.FileType.File or e.base_name.startswith(("_", ".")):
            continue
        rel = e.path[len(base_path):].lstrip("/")
        prefix = base_uri if "://" in base_uri or base_uri.startswith("file:") else "file:" + base_uri
        out.append((f"{prefix}/{rel}", e.base_name, int(e.size), e.mtime))
    return sorted(out)
