"""Binary files in the shared folder, written and read inside tasks."""

from __future__ import annotations

from pyarrow import fs as arrow_fs
from pyspark import TaskContext


def resolve(uri: str):
    """File system and path of a URI (file, hdfs, s3, gs) or of a plain absolute path."""
    if "://" not in uri:
        return arrow_fs.LocalFileSystem(), uri.removeprefix("file:")
    return arrow_fs.FileSystem.from_uri(uri)


def create(uri: str):
    """Output stream of a new file; its folder is made where the file system has folders."""
    system, path = resolve(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def open_random(uri: str):
    system, path = resolve(uri)
    return system.open_input_file(path)


def task_suffix() -> str:
    """Partition and attempt of this task: a repeated or speculative attempt writes another
    file, and only the attempt whose rows are kept is ever read."""
    context = TaskContext.get()
    return f"{context.partitionId():06d}-{context.taskAttemptId()}"
