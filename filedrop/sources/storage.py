"""Small file helpers used inside tasks: one URI form, local paths or any store that Arrow can open."""

from __future__ import annotations

import os
import posixpath
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

from pyarrow import fs

try:
    import boto3
except ImportError:
    boto3 = None


def normalise(uri: str) -> str:
    """One spelling per scheme: ``file:/x`` becomes ``/x``, ``s3a://`` and ``s3n://`` become ``s3://``."""
    for scheme in ("s3a://", "s3n://"):
        if uri.startswith(scheme):
            return "s3://" + uri[len(scheme):]
    if uri.startswith("file:"):
        return "/" + uri[len("file:"):].lstrip("/")
    return uri


# A plain dict: tasks may get these functions by value, which a caching decorator would prevent.
_stores: dict[str, tuple[fs.FileSystem, str]] = {}


def _store(root: str) -> tuple[fs.FileSystem, str]:
    if root not in _stores:
        _stores[root] = fs.FileSystem.from_uri(root)
    return _stores[root]


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path inside it.

    Only ``scheme://authority`` is read as a URI, once per process. The key behind it is a plain path, so blanks,
    percent signs and other signs of odd names mean themselves.
    """
    uri = normalise(uri)
    scheme, found, rest = uri.partition("://")
    if not found:
        return fs.LocalFileSystem(), uri
    authority, _, key = rest.partition("/")
    store, base = _store(f"{scheme}://{authority}/")
    return store, join(base, key) if key else base


def is_local(uri: str) -> bool:
    return "://" not in normalise(uri)


def join(root: str, name: str) -> str:
    return root.rstrip("/") + "/" + name


class Entry(NamedTuple):
    """A file or folder directly below a folder; ``stat`` gives a file's time and size, or None when it is gone."""

    name: str
    is_folder: bool
    stat: Callable[[], tuple[float, int] | None] | None


def entries(uri: str, starts: str = "") -> Iterator[Entry]:
    """What lies directly below a folder and begins with ``starts``, one by one; nothing if there is no such folder.

    Local and mounted folders are read as a stream of names, and only the files that ``stat`` is called for are looked at.
    S3 is read page by page where boto3 is installed. Arrow gives a folder of any other store in one list.
    """
    uri = normalise(uri)
    if is_local(uri):
        return _local_entries(uri, starts)
    if boto3 is not None and uri.startswith("s3://"):
        return _s3_entries(uri, starts)
    return _arrow_entries(uri, starts)


def _local_entries(uri, starts):
    def look(entry):
        try:
            stat = entry.stat()
        except FileNotFoundError:
            return None
        return stat.st_mtime, stat.st_size

    try:
        found = os.scandir(uri)
    except (FileNotFoundError, NotADirectoryError):
        return
    with found:
        for entry in found:
            if entry.name.startswith(starts):
                yield Entry(entry.name, entry.is_dir(), lambda entry=entry: look(entry))


def _s3_entries(uri, starts):
    bucket, _, key = uri[len("s3://"):].partition("/")
    base = key.rstrip("/") + "/" if key else ""
    pages = boto3.client("s3").get_paginator("list_objects_v2")
    for page in pages.paginate(Bucket=bucket, Prefix=base + starts, Delimiter="/"):
        for folder in page.get("CommonPrefixes", ()):
            yield Entry(folder["Prefix"][len(base):].rstrip("/"), True, None)
        for item in page.get("Contents", ()):
            # The key of the folder itself is no file in it.
            if item["Key"] != base:
                known = item["LastModified"].timestamp(), item["Size"]
                yield Entry(item["Key"][len(base):], False, lambda known=known: known)


def _arrow_entries(uri, starts):
    store, path = resolve(uri)
    for info in store.get_file_info(fs.FileSelector(path, allow_not_found=True)):
        if info.base_name.startswith(starts):
            yield Entry(info.base_name, info.type == fs.FileType.Directory,
                        lambda info=info: (info.mtime.timestamp(), info.size))


def size_of(uri: str) -> int | None:
    """Size of a file, or None when there is no such file."""
    store, path = resolve(uri)
    info = store.get_file_info(path)
    return info.size if info.type == fs.FileType.File else None


def modified(uri: str) -> float | None:
    """Modification time of a file in seconds, or None when there is no such file."""
    store, path = resolve(uri)
    info = store.get_file_info(path)
    return info.mtime.timestamp() if info.type == fs.FileType.File and info.mtime is not None else None


def same_content(a: str, b: str, chunk: int = 1 << 20) -> bool:
    """Whether two files hold the same bytes; sizes are compared first."""
    if size_of(a) != size_of(b):
        return False
    with open_binary(a) as x, open_binary(b) as y:
        while piece := x.read(chunk):
            if piece != y.read(chunk):
                return False
    return True


def copy(source: str, target: str) -> None:
    """Copy inside one store; parent folders appear as needed."""
    store, source_path = resolve(source)
    _, target_path = resolve(target)
    if is_local(target):
        os.makedirs(posixpath.dirname(target_path), exist_ok=True)
        # Readers must never see half a copy under the final name.
        partial = f"{target_path}.{uuid.uuid4().hex}.partial"
        store.copy_file(source_path, partial)
        os.replace(partial, target_path)
    else:
        store.copy_file(source_path, target_path)


def delete(uri: str) -> None:
    store, path = resolve(uri)
    store.delete_file(path)


def open_binary(uri: str):
    """Readable binary file object."""
    store, path = resolve(uri)
    return store.open_input_file(path)


def write_bytes(uri: str, data: bytes) -> None:
    """Write a whole file; a repeated task writes the same file again."""
    store, path = resolve(uri)
    if is_local(uri):
        os.makedirs(posixpath.dirname(path), exist_ok=True)
        partial = f"{path}.{uuid.uuid4().hex}.partial"
        with open(partial, "wb") as out:
            out.write(data)
        os.replace(partial, path)
    else:
        with store.open_output_stream(path) as out:
            out.write(data)


def create_new(uri: str, data: bytes) -> bool:
    """Write a small file unless there is one of this name; of several writers one gets True.

    Only local and mounted folders, and S3 where boto3 is installed, can tell.
    """
    uri = normalise(uri)
    if is_local(uri):
        os.makedirs(posixpath.dirname(uri), exist_ok=True)
        partial = f"{uri}.{uuid.uuid4().hex}.partial"
        with open(partial, "wb") as out:
            out.write(data)
        try:
            # Unlike a rename, a link never replaces a file, and the name appears with all its bytes.
            os.link(partial, uri)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(partial)
    if boto3 is None or not uri.startswith("s3://"):
        raise NotImplementedError(f"no way to create {uri} only if it is absent")
    bucket, _, key = uri[len("s3://"):].partition("/")
    client = boto3.client("s3")
    try:
        client.put_object(Bucket=bucket, Key=key, Body=data, IfNoneMatch="*")
        return True
    except client.exceptions.ClientError as e:
        if e.response["ResponseMetadata"]["HTTPStatusCode"] in (409, 412):
            return False
        raise
