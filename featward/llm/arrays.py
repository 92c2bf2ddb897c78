"""Files of named arrays in the shared folder, memory-mapped by workers.

The folder has to be on a path that all executors see, or in a store that ``pyarrow.fs`` opens.
"""

from __future__ import annotations

import json
import mmap
import os
import sys
import tempfile
import uuid
from urllib.parse import unquote, urlparse

import numpy as np
from pyarrow import fs

HEAD = 4096  # bytes before the arrays, which begin at multiples of 64
UNTRACKED = {"trackfd": False} if sys.version_info >= (3, 13) else {}  # a mapping that keeps no file open


def save_arrays(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """Write the arrays under a name of its own and move it into place, so that tasks may run twice."""
    head, at = [], HEAD
    for name, array in arrays.items():
        head.append((name, array.dtype.str, at, len(array)))
        at += -(-array.nbytes // 64) * 64
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        out.write(json.dumps(head).encode().ljust(HEAD))
        for array in arrays.values():
            out.write(np.ascontiguousarray(array))
            out.write(b"\0" * (-array.nbytes % 64))
    system.move(part, path)


def map_arrays(uri: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped; {} if there is none. A file on a path that all executors see is mapped
    where it lies, any other is copied to the worker's own temporary folder once. However many arrays a file
    has, it is one mapping, and no open file from Python 3.13 on (one before)."""
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        path = unquote(parsed.path)
    else:
        path = os.path.join(tempfile.gettempdir(), uri.replace("/", "_").replace(":", "_"))
        if not os.path.exists(path):
            system, source = fs.FileSystem.from_uri(uri)
            if system.get_file_info(source).type == fs.FileType.NotFound:
                return {}
            part = f"{path}.{uuid.uuid4().hex}"
            fs.copy_files(source, part, source_filesystem=system, destination_filesystem=fs.LocalFileSystem())
            os.replace(part, path)
    if not os.path.exists(path):
        return {}
    with open(path, "rb") as file:
        data = np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ, **UNTRACKED), np.uint8)
    head = json.loads(data[:HEAD].tobytes())
    return {name: data[at : at + n * np.dtype(kind).itemsize].view(kind) for name, kind, at, n in head}
