"""Tolerant file readers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.cleaning import or_null
from sluice.sinks.tables import remove


#: How CSV is read, by batch and by stream alike. The NULL text, two separators, is what no field holds: so
#: nothing between two commas is NULL, and a pair of quotes is blank text.
CSV = {
    "header": True, "multiLine": True, "escape": '"', "mode": "PERMISSIVE", "enforceSchema": True, "nullValue": "\x1e\x1f",
}


def all_strings(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool = True, header: bool = True
) -> DataFrame:
    """CSV with a header, quoted newlines and doubled quotes.

    Short rows are filled with NULL, extra fields dropped, undecodable bytes
    replaced. Empty fields are NULL, quoted ones without text are blank. Give a string schema and type the columns
    afterwards: a typed schema would hide which text could not be read.

    With ``multi_line`` Spark reads one file per task; many files of moderate size read in parallel. Large
    ones are split with ``multi_line=False``, where no field holds a newline, or by
    :func:`sluice.sources.split_csv.read_split_csv`, where some do.
    """
    return (
        spark.read.schema(schema)
        .options(**{**CSV, "header": header, "multiLine": multi_line})
        .csv(path)
    )


def read_lines(spark: SparkSession, path: str | list[str], header: str | None = None) -> DataFrame:
    """One row per line in ``value``; lines equal to ``header`` are left out.

    Compared by text and not by position: a split in the middle of a file has no
    notion of its line number.
    """
    lines = spark.read.text(path)
    return lines if header is None else lines.filter(F.col("value") != header)


def read_objects(spark: SparkSession, path: str | list[str], whole: bool = False) -> DataFrame:
    """Text of objects with the ``source_file`` it came from.

    Line by line, so that large objects are split; ``whole`` keeps one row per
    object for searches that may span lines.
    """
    return spark.read.text(path, wholetext=whole).select("value", F.col("_metadata.file_path").alias("source_file"))


def read_pieces(spark: SparkSession, path: str | list[str], separator: str = " ") -> DataFrame:
    """Text of objects between separators, with the ``source_file`` it came from.

    For searches in objects that may be one very long line, or whose findings may span lines: objects are split at
    separators and nowhere else, by many tasks, and a row is as long as the text between two of them. A
    finding that holds no separator is in one row, newlines included.
    """
    pieces = spark.read.option("lineSep", separator).text(path)
    return pieces.select("value", F.col("_metadata.file_path").alias("source_file"))


class BadRecordBudgetExceeded(ValueError):
    """More unreadable rows than the load may skip."""


@dataclass(frozen=True)
class Loaded:
    table: DataFrame
    good: int
    bad: int


def _typed(field: T.StructField) -> Column:
    text = F.col(field.name)
    return text if isinstance(field.dataType, T.StringType) else or_null(text).try_cast(field.dataType)


def _unreadable(schema: T.StructType) -> Column:
    """Some text is there that cannot be read as its type; blanks are just NULL."""
    bad = F.lit(False)
    for field in schema.fields:
        blank = F.coalesce(F.trim(field.name) == "", F.lit(True))
        bad = bad | (~blank & _typed(field).isNull())
    return bad


def load_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    staging: str,
    max_bad_records: int = 10,
    multi_line: bool = True,
    reader: Callable[[SparkSession, str | list[str], T.StructType], DataFrame] | None = None,
    refuse_early: bool = False,
) -> Loaded:
    """Load a CSV skipping up to ``max_bad_records`` unreadable rows.

    The file is parsed once: good rows go to the new folder ``staging`` while the
    bad ones are counted by the same job. Over budget this raises, and whatever
    was published before stays and the folder goes; within budget the caller publishes the folder
    (:func:`sluice.sinks.tables.publish`) without copying it.

    ``reader`` reads the files in another way, such as :func:`sluice.sources.split_csv.read_split_csv`. With
    ``refuse_early`` a search for bad rows goes first, over a few splits and then ever more of them: it ends as soon as the
    budget is exceeded, with nothing written, however large the files are. A load within budget then reads
    them twice, so ask for it where bad files are to be expected.
    """
    strings = all_strings(schema)
    raw = reader(spark, path, strings) if reader else read_csv(spark, path, strings, multi_line)
    marked = raw.select(
        *(_typed(f).alias(f.name) for f in schema.fields), _unreadable(schema).alias("_bad")
    )
    if refuse_early:
        found = len(marked.filter("_bad").select("_bad").take(max_bad_records + 1))
        if found > max_bad_records:
            raise BadRecordBudgetExceeded(f"more than {max_bad_records} unreadable rows, {max_bad_records} allowed")
    counts = Observation()
    seen = marked.observe(
        counts,
        F.count_if(F.col("_bad")).alias("bad"),
        F.count_if(~F.col("_bad")).alias("good"),
    )
    seen.filter(~F.col("_bad")).drop("_bad").write.mode("errorifexists").parquet(staging)
    bad, good = counts.get["bad"], counts.get["good"]
    if bad > max_bad_records:
        remove(spark, staging)
        raise BadRecordBudgetExceeded(f"{bad} unreadable rows, {max_bad_records} allowed")
    return Loaded(spark.read.schema(schema).parquet(staging), good, bad)
