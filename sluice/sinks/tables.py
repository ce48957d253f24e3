"""Writers: overwrite, append, fill an empty target, hand-off files."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, in its order and types; missing ones are NULL."""
    return df.select(
        *(
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )


def files_of(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    files, folder = files_of(spark, path)
    files.delete(folder, True)


def overwrite(
    df: DataFrame, path: str, schema: T.StructType | None = None, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Create or replace a table folder; returns the written table.

    The rows go to a folder beside it, which takes its place when it is whole: a job that
    fails leaves the old table. The old folder is put aside first and comes back if the new one cannot take
    its place. Between the two renames a reader may find no table; where it must not, or where several tables
    change together, use :mod:`sluice.sinks.versions`.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    staging, aside = (f"{path.rstrip('/')}.{kind}-{mark}" for kind in ("new", "old"))
    shaped = df if schema is None else conform(df, schema)
    try:
        shaped.write.partitionBy(*partition_by).parquet(staging)
    except BaseException:
        remove(spark, staging)
        raise
    put_in_place(spark, staging, path, aside)
    return spark.read.schema(shaped.schema).parquet(path)


def renamed(spark: SparkSession, source: str, target: str) -> None:
    """Renames a folder to a name that is free."""
    files, old = files_of(spark, source)
    if not files.rename(old, files_of(spark, target)[1]):
        raise OSError(f"cannot rename {source} to {target}")


def put_in_place(spark: SparkSession, staging: str, path: str, aside: str) -> None:
    """``staging`` in place of ``path``; if that fails, what was there is there again and ``staging`` goes."""
    files, old = files_of(spark, path)
    there = files.exists(old)
    try:
        if there:
            renamed(spark, path, aside)
        try:
            renamed(spark, staging, path)
        except BaseException:
            if there:
                renamed(spark, aside, path)
            raise
    except BaseException:
        remove(spark, staging)
        raise
    if there:
        remove(spark, aside)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append rows; columns may differ between appends."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """An appended folder with the union of all columns it ever had."""
    return spark.read.option("mergeSchema", True).parquet(path)


def write_if_empty(df: DataFrame, path: str) -> DataFrame:
    """Write to a target that must not exist yet."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_identifier(name)}{where}")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _identifier(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def publish(spark: SparkSession, table: str, folder: str) -> DataFrame:
    """Point a catalog table at a finished folder; readers see the old or the new rows.

    Nothing is copied, whatever the size of the load. ``table`` may be qualified by dots. A folder
    with other columns than the table's becomes a table of its own, which takes the name of the old
    one by two renames in the catalog; if the second fails, the old table has its name again.
    """
    *places, last = table.split(".")
    found = spark.read.parquet(folder).schema

    def named(name: str) -> str:
        return ".".join(_identifier(part) for part in (*places, name))

    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {named(last)} USING parquet LOCATION {_text(folder)}")
        return spark.table(table)
    old = [(f.name, f.dataType) for f in spark.table(table).schema.fields]
    if old == [(f.name, f.dataType) for f in found.fields]:
        spark.sql(f"ALTER TABLE {named(last)} SET LOCATION {_text(folder)}")
        spark.catalog.refreshTable(table)
        return spark.table(table)
    mark = uuid.uuid4().hex
    new, aside = f"{last}_new_{mark}", f"{last}_old_{mark}"
    spark.sql(f"CREATE TABLE {named(new)} USING parquet LOCATION {_text(folder)}")
    try:
        rename_table(spark, named(last), named(aside))
        try:
            rename_table(spark, named(new), named(last))
        except BaseException:
            rename_table(spark, named(aside), named(last))
            raise
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {named(new)}")
        raise
    spark.sql(f"DROP TABLE {named(aside)}")
    return spark.table(table)


def rename_table(spark: SparkSession, name: str, other: str) -> None:
    spark.sql(f"ALTER TABLE {name} RENAME TO {other}")


def overwrite_both(rows: DataFrame, path: str, derive, derived_path: str, schema: T.StructType | None = None):
    """Write rows and something derived from them, computing the rows once.

    The second table is derived from the first one as written: the input is not
    parsed again, only the columns needed are read back, and nothing has to be
    held in executor memory between the two writes. The tables change one after the other; where
    readers must see both change at once, use :func:`sluice.sinks.versions.replace_together`.
    """
    table = overwrite(rows, path, schema)
    return table, overwrite(derive(table), derived_path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV that :func:`sluice.sources.files.read_csv` reads back unchanged: fields quoted where
    needed, quotes doubled, spaces kept, arrays as JSON text. Blank text is a pair of quotes and
    NULL nothing at all, so each comes back as itself; only the character NUL is lost."""
    flat = [
        (F.to_json(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)).alias(f.name)
        for f in df.schema.fields
    ]
    df.select(*flat).write.mode(mode).options(
        header=True, escape='"', emptyValue='""', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
