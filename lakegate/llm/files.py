"""Binary files written and read by tasks, on local disks and object stores alike.

A task writes under a name of its own and reports it in a row; the rows are committed by Spark's
Parquet writer. A file that no committed row names, left by a lost executor or a second attempt,
is never read. So no rename is needed, and a lost executor costs its running tasks only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from urllib.parse import unquote, urlsplit

from pyarrow import fs

#: Ranges closer than this are read together.
GAP_BYTES = 64 * 1024
#: Most bytes of one coalesced read (a longer record is read whole).
READ_BYTES = 8 * 1024 * 1024


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder or file URI, and the path in it.

    The path is passed apart from the scheme, so that spaces and percent signs in it are kept.
    Known are local paths, ``file:``, ``hdfs:``, ``s3:`` (``s3a:``, ``s3n:``) and ``gs:``.
    """
    parts = urlsplit(uri)
    if not parts.scheme:
        return fs.LocalFileSystem(), uri
    scheme = {"s3a": "s3", "s3n": "s3"}.get(parts.scheme, parts.scheme)
    if scheme == "file":
        return fs.LocalFileSystem(), unquote(parts.path)
    if scheme == "hdfs":
        return fs.HadoopFileSystem(parts.hostname or "default", parts.port or 0), parts.path
    if scheme == "s3":
        return fs.S3FileSystem(), f"{parts.netloc}{parts.path}"
    if scheme == "gs":
        return fs.GcsFileSystem(), f"{parts.netloc}{parts.path}"
    raise ValueError(f"no writer for binary files on {parts.scheme}: {uri}")


def make_folder(uri: str) -> None:
    system, path = filesystem(uri)
    system.create_dir(path, recursive=True)


def write_whole(uri: str, data: bytes) -> None:
    system, path = filesystem(uri)
    with system.open_output_stream(path, compression=None) as out:
        out.write(data)


def read_whole(uri: str) -> bytes:
    system, path = filesystem(uri)
    with system.open_input_file(path) as source:
        return source.read()


def coalesced(ranges: Iterable[tuple[int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES) -> Iterator[list[tuple[int, int]]]:
    """Groups of ascending (offset, length) ranges to be read at once."""
    group: list[tuple[int, int]] = []
    end = 0
    for offset, length in ranges:
        if group and (offset - end > gap or offset + length - group[0][0] > most):
            yield group
            group = []
        group.append((offset, length))
        end = max(end, offset + length) if len(group) > 1 else offset + length
    if group:
        yield group


def read_ranges(uri: str, ranges: Iterable[tuple[int, int]]) -> Iterator[bytes]:
    """The bytes of ascending ranges of one file, by few seeks."""
    system, path = filesystem(uri)
    with system.open_input_file(path) as source:
        for group in coalesced(ranges):
            begin = group[0][0]
            source.seek(begin)
            data = source.read(max(o + n for o, n in group) - begin)
            for offset, length in group:
                part = data[offset - begin : offset - begin + length]
                if len(part) != length:
                    raise EOFError(f"{uri} ends inside a record at {offset}")
                yield part
