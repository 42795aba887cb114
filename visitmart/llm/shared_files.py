"""Binary files on the cluster's shared storage, written and read inside tasks.

A file is written under a temporary name and moved into place, and is known
only through the manifest row its task returns, so a task that is run again
leaves at most a file that nobody refers to.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def locate(uri: str):
    """(file system, path) of a URI or of a plain absolute path."""
    return fs.FileSystem.from_uri(uri if ":" in uri.split("/")[0] else f"file://{uri}")


def write_file(folder: str, suffix: str, chunks) -> str:
    """Write the byte chunks to a new file in ``folder``; returns its URI."""
    name = f"{uuid.uuid4().hex}{suffix}"
    store, path = locate(f"{folder}/{name}.tmp")
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(path) as out:
        for chunk in chunks:
            out.write(chunk)
    store.move(path, path[:-4])
    return f"{folder}/{name}"


def open_file(uri: str):
    store, path = locate(uri)
    return store.open_input_file(path)


def one_task_per_file(manifest: DataFrame, key: str, cap: int = 10_000) -> DataFrame:
    """Deal the rows of a small manifest out so that files are read in parallel."""
    n = max(1, min(manifest.count(), cap))
    return manifest.repartition(n, F.col(key))
