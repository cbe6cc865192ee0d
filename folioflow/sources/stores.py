"""Single files of the shared file system, opened inside tasks.

Spark's file sources read folders; a job that wants some files of a folder would open all of them. Here a task
opens the files whose paths are in its rows, through the same shared store, and nothing else.
"""

from __future__ import annotations

import codecs
import contextlib
import os
import posixpath
import re
import stat
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import BinaryIO

from pyarrow import ArrowException, NativeFile
from pyarrow import fs as arrow_fs

_URI = re.compile(r"^(?P<scheme>[A-Za-z][A-Za-z0-9+.-]+):(?://(?P<place>[^/]*))?(?P<path>/.*)?$", re.DOTALL)

#: What opening or writing a file may raise. Arrow's own errors are no OSErrors throughout.
FAILURES = (OSError, ArrowException)

# Longer marks first: that of UTF-32 begins like that of UTF-16.
_MARKS = (
    (codecs.BOM_UTF32_LE, "utf-32-le"), (codecs.BOM_UTF32_BE, "utf-32-be"), (codecs.BOM_UTF8, "utf-8"),
    (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"),
)


@dataclass
class Stores:
    """File systems by scheme and host, each connected once per task."""

    _known: dict[tuple[str, str], tuple[arrow_fs.FileSystem, str]] = field(default_factory=dict)
    _made: set[tuple[str, str]] = field(default_factory=set)
    _own: set[str] = field(default_factory=set)

    def find(self, path: str) -> tuple[arrow_fs.FileSystem, str]:
        """The file system of a path as Spark spells it, and the path inside."""
        parts = _URI.match(path)
        if parts is None or parts["scheme"].lower() == "file":
            return self._connected("file", "")[0], parts["path"] if parts else path
        files, root = self._connected(parts["scheme"].lower(), parts["place"] or "")
        return files, posixpath.join(root, (parts["path"] or "/").lstrip("/"))

    def _connected(self, scheme: str, place: str) -> tuple[arrow_fs.FileSystem, str]:
        if (scheme, place) not in self._known:
            local = scheme == "file"
            self._known[scheme, place] = (
                (arrow_fs.LocalFileSystem(), "/") if local else arrow_fs.FileSystem.from_uri(f"{scheme}://{place}/")
            )
        return self._known[scheme, place]

    def open(self, path: str) -> BinaryIO | NativeFile:
        files, inner = self.find(path)
        return open(inner, "rb") if isinstance(files, arrow_fs.LocalFileSystem) else files.open_input_stream(inner)

    def about(self, path: str) -> tuple[int, int] | None:
        """Size and write time (milliseconds since 1970) of a file; none of what is no file or gone."""
        files, inner = self.find(path)
        if isinstance(files, arrow_fs.LocalFileSystem):
            try:
                info = os.stat(inner)
            except (FileNotFoundError, NotADirectoryError):
                return None
            return (info.st_size, info.st_mtime_ns // 1_000_000) if stat.S_ISREG(info.st_mode) else None
        info = files.get_file_info(inner)
        return (info.size, info.mtime_ns // 1_000_000) if info.type == arrow_fs.FileType.File else None

    def put(self, path: str, write: Callable[[BinaryIO | NativeFile], object], attempt: str) -> None:
        """Write a file under another name near its place, then give it its name: readers see all or nothing."""
        files, inner = self.find(path)
        folder, name = posixpath.split(inner)
        if (files.type_name, folder) not in self._made:
            files.create_dir(folder, recursive=True)
            self._made.add((files.type_name, folder))
        if isinstance(files, arrow_fs.LocalFileSystem):
            return self._put_mounted(folder, name, write, attempt)
        unfinished = posixpath.join(folder, f".{name}.{attempt}")
        try:
            with files.open_output_stream(unfinished) as out:
                write(out)
            if files.get_file_info(inner).type != arrow_fs.FileType.NotFound:
                files.delete_file(inner)
            files.move(unfinished, inner)
        except FAILURES:
            if files.get_file_info(unfinished).type != arrow_fs.FileType.NotFound:
                files.delete_file(unfinished)
            raise

    def _put_mounted(self, folder: str, name: str, write: Callable[[BinaryIO], object], attempt: str) -> None:
        """A mounted file system replaces what has the name.

        Unfinished files lie in a hidden folder of the attempt's own: all tasks of a job write to one folder, which
        takes one new name at a time, and there only the finished files meet.
        """
        own = posixpath.join(folder, f".{attempt}")
        if own not in self._own:
            os.makedirs(own, exist_ok=True)
            self._own.add(own)
        unfinished = posixpath.join(own, name)
        try:
            with open(unfinished, "wb") as out:
                write(out)
            os.replace(unfinished, posixpath.join(folder, name))
        except FAILURES:
            with contextlib.suppress(FileNotFoundError):
                os.remove(unfinished)
            self._drop(own)
            raise

    def _drop(self, own: str) -> None:
        self._own.discard(own)
        with contextlib.suppress(OSError):
            os.rmdir(own)

    def close(self) -> None:
        """Remove the folders of unfinished files; more may be written afterwards."""
        for own in list(self._own):
            self._drop(own)


def reachable(folder: str) -> bool:
    """Can tasks open files of this folder themselves? Not if only Spark's own file systems know the scheme."""
    try:
        Stores().find(folder)
    except (*FAILURES, ValueError, TypeError):
        return False
    return True


def as_text(raw: bytes) -> str:
    """A file's text: in the encoding its byte order mark tells, which is left out, else UTF-8.

    Bytes that are no text come out as replacement characters.
    """
    for mark, encoding in _MARKS:
        if raw.startswith(mark):
            return raw[len(mark) :].decode(encoding, errors="replace")
    return raw.decode("utf-8", errors="replace")
