"""Files in the folder that driver and executors share: written under a temporary name, then renamed, and listed in a manifest table."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame

_TEMPORARY = "_temporary_files"


def open_store(uri: str):
    """(file system, path) of a folder given as a path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else "file:" + uri)


@contextmanager
def committed(uri: str, name: str):
    """An output stream whose bytes appear under ``name`` only once all are written; a repeated task replaces the file by an equal one."""
    store, top = open_store(uri)
    store.create_dir(f"{top}/{_TEMPORARY}", recursive=True)
    temporary = f"{top}/{_TEMPORARY}/{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(temporary) as out:
        yield out
    store.move(temporary, f"{top}/{name}")


def drop_temporary(uri: str) -> None:
    """Delete what attempts that broke off have left."""
    from pyarrow import fs

    store, top = open_store(uri)
    if store.get_file_info(f"{top}/{_TEMPORARY}").type == fs.FileType.Directory:
        store.delete_dir(f"{top}/{_TEMPORARY}")


def save_table(df: DataFrame, uri: str, name: str) -> DataFrame:
    """df written as Parquet below the folder and read again; running its tasks writes the files that its rows list."""
    df.write.mode("overwrite").parquet(f"{uri}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{uri}/{name}")


def spread(manifest: DataFrame) -> DataFrame:
    """A manifest's rows dealt to about a task each; their number comes from the Parquet footers."""
    return manifest.repartition(max(1, min(manifest.count(), 1 << 17)))
