"""A file for every row."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame

# Fixed value: files of a folder, about, which are the work of one task.
FILES_PER_FOLDER = 1024


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_files(rows: DataFrame, path: str, per_folder: int = FILES_PER_FOLDER) -> None:
    """Write ``content`` (binary) of every row to a file of its own below ``path``; its name ends in ``name``.

    A task writes one folder, by Arrow's file systems: Spark's writers open and commit
    each file at a cost that is meant for large ones.  The folder has a name that readers
    pass over until it is whole, so that one attempt at a task counts and no part of it.
    ``path`` must not exist; names may repeat.  As many folders as the number of rows asks
    for; ``rows`` is counted first, so stage it where that is costly.
    """
    fs, top = file_system(path)
    if fs.get_file_info(top).type != pyarrow.fs.FileType.NotFound:
        raise FileExistsError(path)
    fs.create_dir(top, recursive=True)
    folders = max(1, -(-rows.count() // per_folder))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = file_system(path)
        task, number = TaskContext.get(), 0
        done, begun = f"{top}/folder={task.partitionId()}", f"{top}/_temporary-{task.taskAttemptId()}"
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist(), strict=True):
                if not number:
                    fs.create_dir(begun)
                with fs.open_output_stream(f"{begun}/{number}-{name or ''}", compression=None) as out:
                    out.write(content or b"")
                number += 1
        if number and fs.get_file_info(done).type == pyarrow.fs.FileType.NotFound:
            fs.move(begun, done)
        elif number:  # an earlier attempt has written it
            fs.delete_dir(begun)
        yield pa.record_batch([pa.array([number], pa.int64())], names=["files"])

    written = rows.select("name", "content").repartition(folders).mapInArrow(write, "files long")
    written.write.format("noop").mode("overwrite").save()
