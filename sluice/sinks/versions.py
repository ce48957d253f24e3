"""Several tables replaced together: versioned folders and one pointer that is written last.

Each replacement writes its tables to a folder of its own. Then a small file that names the folder takes the
place of the one before by one rename. Readers follow the pointer, so they see all the old tables or all the new
ones. Whatever fails before the rename leaves the pointer and the folders it names as they were.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from sluice.sinks.tables import files_of, remove

POINTER = "_current"


def _renamed_over(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file, in one step also where the target is there."""
    jvm = spark._jvm
    options = jvm.org.apache.hadoop.fs.Options
    rename = spark.sparkContext._gateway.new_array(getattr(options, "Rename"), 1)
    rename[0] = getattr(options, "Rename").OVERWRITE
    old, new = (jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(new).toUri())
    context.rename(context.makeQualified(old), context.makeQualified(new), rename)


def current(spark: SparkSession, base: str) -> str | None:
    """The folder of the tables that readers see, None before the first replacement."""
    files, pointer = files_of(spark, f"{base}/{POINTER}")
    if not files.exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        return f"{base}/{stream.readUTF()}"
    finally:
        stream.close()


def replace_together(
    spark: SparkSession, base: str, tables: Callable[[Callable[[str], DataFrame]], Iterable[tuple[str, DataFrame]]]
) -> str:
    """Writes the named tables as a new version below ``base`` and lets readers see them; returns its folder.

    ``tables`` yields names and rows one after the other. It gets a function that reads a table this
    replacement has written before, so that one can be derived from another without computing it twice. Two
    replacements at once are both whole; the later rename is what readers see.
    """
    version = uuid.uuid4().hex
    folder = f"{base}/{version}"

    def written(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}")

    try:
        for name, rows in tables(written):
            rows.write.mode("errorifexists").parquet(f"{folder}/{name}")
        note = f"{base}/{POINTER}-{version}"
        files, path = files_of(spark, note)
        stream = files.create(path, True)
        try:
            stream.writeUTF(version)
        finally:
            stream.close()
        _renamed_over(spark, note, f"{base}/{POINTER}")
    except BaseException:
        if current(spark, base) != folder:
            remove(spark, folder)
            remove(spark, f"{base}/{POINTER}-{version}")
        raise
    return folder


def read_current(spark: SparkSession, base: str, *names: str) -> tuple[DataFrame, ...]:
    """Tables of the version that readers see, all of the same one."""
    folder = current(spark, base)
    if folder is None:
        raise FileNotFoundError(f"nothing was written to {base}")
    return tuple(spark.read.parquet(f"{folder}/{name}") for name in names)


def forget_old(spark: SparkSession, base: str, keep: Iterable[str] = ()) -> list[str]:
    """Deletes the versions that readers do not see, but for the folders in ``keep``; returns the deleted ones.

    Call it when no reader of an older version is left, and no replacement is under way.
    """
    files, path = files_of(spark, base)
    seen = {current(spark, base), *keep}
    old = [f"{base}/{s.getPath().getName()}" for s in files.listStatus(path) if s.isDirectory()]
    old = [folder for folder in old if folder not in seen]
    for folder in old:
        remove(spark, folder)
    return old
