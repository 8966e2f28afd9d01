"""Files in a folder that all executors share."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow.fs as pafs
from pyspark import cloudpickle

# Task functions travel inside the task, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def shared_files(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that all executors share."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), unquote(urlparse(uri).path)
    return pafs.FileSystem.from_uri(uri)


def write_shared(uri: str, data: bytes | memoryview) -> None:
    """Write a file in full under another name, then give it its own: a repeated task replaces it."""
    files, path = shared_files(uri)
    files.create_dir(os.path.dirname(path), recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}"
    with files.open_output_stream(draft) as out:
        out.write(data)
    files.move(draft, path)


def mapped_bytes(uri: str) -> np.ndarray:
    """A shared file as a read-only memory map.

    A mounted folder is mapped in place. From an object store or HDFS the file is first copied to
    the worker's own folder, which goes with the worker.
    """
    files, path = shared_files(uri)
    if not isinstance(files, pafs.LocalFileSystem):
        local = tempfile.NamedTemporaryFile(prefix="mapped-", delete=False)
        with files.open_input_stream(path) as source, local:
            while block := source.read(1 << 22):
                local.write(block)
        path = local.name
        data = np.memmap(path, np.uint8, "r") if os.path.getsize(path) else np.empty(0, np.uint8)
        os.unlink(path)
        return data
    return np.memmap(path, np.uint8, "r") if os.path.getsize(path) else np.empty(0, np.uint8)
