"""One file per row: written or removed under the paths of a column."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from tessera.functions.files import filesystem_for
from tessera.functions.paths import parent_str
from tessera.operators.copy import TEMP_PREFIX, move_over
from tessera.operators.layout import default_parallelism


def write_files(rows: DataFrame, path_col: str = "path", content_col: str = "content",
                tasks: int | None = None) -> None:
    """Writes each row's content (text as UTF-8, or bytes; NULL: no bytes) to
    its path, making the folders above it and replacing a file that is there.
    A file appears in one step, by a rename, so retried tasks do no harm."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        made: set[str] = set()
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                fs, local = filesystem_for(path)
                folder = parent_str(local) or "/"
                if folder not in made:
                    fs.create_dir(folder, recursive=True)
                    made.add(folder)
                tmp = f"{folder.rstrip('/')}/{TEMP_PREFIX}{uuid.uuid4().hex}.{os.path.basename(local)}"
                with fs.open_output_stream(tmp) as out:
                    out.write(content.as_py() or b"")
                move_over(fs, tmp, local)
        yield from ()

    work = rows.select(F.col(path_col).alias("path"), F.col(content_col).cast("binary").alias("content"))
    n = tasks or default_parallelism(rows.sparkSession)
    work.repartition(n, "path").mapInArrow(write, "path string").write.format("noop").mode("overwrite").save()


def remove_files(rows: DataFrame, path_col: str = "path", tasks: int | None = None) -> None:
    """Removes each row's path: a file, or a folder with all below it; one
    that is gone is no error, so retried tasks do no harm."""

    def remove(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, local = filesystem_for(path)
                kind = fs.get_file_info(local).type
                if kind == pafs.FileType.Directory:
                    fs.delete_dir(local)
                elif kind == pafs.FileType.File:
                    fs.delete_file(local)
        yield from ()

    work = rows.select(F.col(path_col).alias("path"))
    n = tasks or default_parallelism(rows.sparkSession)
    work.repartition(n, "path").mapInArrow(remove, "path string").write.format("noop").mode("overwrite").save()
