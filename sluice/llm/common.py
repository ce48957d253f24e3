"""Small helpers shared by the operators: written intermediates and the split of rows by text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.scratch import scratch_dir

#: The ASCII white space that separates words, as a character class for Spark and SQL patterns.
SPACE = r"\x20\x09-\x0D"


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written below the shared folder and read again: the lineage ends there, and a
    lost executor costs a reread and no recomputation."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the folder of a materialised table that nothing reads any more."""
    spark = df.sparkSession
    jvm, files = spark._jvm, df.inputFiles()
    if files:
        folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def lower_ascii(column: Column) -> Column:
    """A-Z lower-cased, all else untouched."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def remainder(id_column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % modulus


def byte_texts(column) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8 bytes; NULL is empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def str_texts(column) -> list[str]:
    """The texts of an Arrow string column; NULL is empty."""
    return [x or "" for x in column.to_pylist()]


def shipped(spark: SparkSession, value):
    """A broadcast of ``value`` pickled with its class, for ``pickle.loads`` on workers without the package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def slices(batches, rows: int) -> Iterator:
    """Arrow batches cut to at most ``rows`` rows, so that Python holds few texts at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


class Carried:
    """Columns that travel beside the text through a Python stage, under names that clash with nothing.

    ``rows`` has the text first. If the text is to be kept it is sent once.
    """

    def __init__(self, docs: DataFrame, text_col: str, keep: Sequence[str]):
        text_batches(docs.sparkSession)
        self.keep, self.text_col = list(keep), text_col
        others = [c for c in keep if c != text_col]
        self.names = {text_col: "text", **{c: f"kept_{i}" for i, c in enumerate(others)}}
        text = F.col(f"`{text_col}`").cast("string").alias("text")
        self.rows = docs.select(text, *[F.col(f"`{c}`").alias(self.names[c]) for c in others])
        self.first = 0 if text_col in keep else 1

    def schema(self, *added: T.StructField) -> T.StructType:
        return T.StructType([*self.rows.schema.fields[self.first :], *added])

    def restored(self) -> list[Column]:
        """The kept columns under their own names."""
        return [F.col(self.names[c]).alias(c) for c in self.keep]


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_batches(spark: SparkSession, rows: int = 512) -> None:
    """Asks for Arrow batches of ``rows`` rows in this session, unless it has a setting of its own.

    Spark's 10,000 texts are a batch of tens of MB, which the JVM and Python hold several times over.
    """
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, str(rows))


def partitions(spark: SparkSession) -> int:
    """The partitions a shuffle of the input should have: the session's own setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
