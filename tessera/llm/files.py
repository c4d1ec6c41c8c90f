"""Output files that tasks write themselves (archives, id shards).

Paths may be plain or carry a scheme that ``pyarrow.fs`` knows. A file is written
under a temporary name of its attempt and then renamed, so a repeated or lost
attempt never leaves half a file under the final name.
"""

from __future__ import annotations

import contextlib
import uuid


def filesystem(path: str):
    """(pyarrow file system, path in it)."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        if path.startswith("file:/") and not path.startswith("file://"):
            path = "file://" + path[len("file:"):]
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


@contextlib.contextmanager
def committed(path: str):
    """An output stream whose file appears under ``path`` only when complete."""
    where, name = filesystem(path)
    where.create_dir(name.rpartition("/")[0], recursive=True)
    attempt = f"{name}.{uuid.uuid4().hex}.tmp"
    with where.open_output_stream(attempt, compression=None) as out:
        yield out
    where.move(attempt, name)


def opened(path: str):
    """A random-access input file."""
    where, name = filesystem(path)
    return where.open_input_file(name)
