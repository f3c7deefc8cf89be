"""Files of shared stores as Python tasks reach them."""

from __future__ import annotations

import pyarrow as pa
from pyarrow import fs

# Names under which Spark and Arrow know the same store.
_STORES = {"s3a": "s3", "s3n": "s3"}


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path in it; the driver and all tasks see the same files there."""
    scheme, _, rest = path.partition(":")
    if not rest or "/" in scheme or len(scheme) == 1:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    try:
        return fs.FileSystem.from_uri(f"{_STORES.get(scheme, scheme)}:{rest}")
    except (pa.ArrowInvalid, OSError) as fault:
        raise ValueError(f"{path}: Python tasks cannot open a {scheme} store; choose one of file, hdfs, s3a or gs") from fault
