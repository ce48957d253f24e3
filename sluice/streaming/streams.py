"""Structured Streaming: sources, windows, dedup, confirmation, file arrival.

Steps take and return streaming DataFrames; :func:`drain` runs one to the end of
the available input into a folder, with a checkpoint that makes each input file
count exactly once across runs.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.hashing import HashKey
from sluice.operators import sensitive
from sluice.sources.files import CSV


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    file_format: str = "parquet",
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
    max_file_age: str = "36500d",
    **options,
) -> DataFrame:
    """New files of a folder as a stream; ``max_files_per_trigger`` bounds a micro-batch.

    Spark would leave out files that are a week older than the newest one, such as files copied
    with their old time. Here no file is too old; a shorter ``max_file_age`` keeps the list of files
    seen short, where files are known to arrive in time.
    """
    reader = spark.readStream.schema(schema).option("maxFileAge", max_file_age).options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.format(file_format).load(path)


def message_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """A message topic as ``value binary``; needs Spark's Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
        .select("value", "timestamp")
    )


def drain(stream: DataFrame, folder: str, checkpoint: str, file_format: str = "parquet",
          partition_by: Sequence[str] = (), **options) -> None:
    """Append everything available now to ``folder``, then stop.

    Run again with the same checkpoint to pick up only what arrived since.
    """
    writer = stream.writeStream.format(file_format).outputMode("append").options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(folder)
    query.awaitTermination()


def publish_messages(stream: DataFrame, servers: str, topic: str, checkpoint: str, trigger: str = "10 seconds", **options):
    """Start writing ``value binary`` to a topic and go on until stopped; returns the running query.

    Needs Spark's Kafka connector on the class path. With the same checkpoint it goes on where it stopped;
    a message may then come twice, none is lost.
    """
    writer = stream.select("value").writeStream.format("kafka").options(**options)
    writer = writer.option("kafka.bootstrap.servers", servers).option("topic", topic)
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=trigger).start()


def decoded(messages: DataFrame, column: str = "value") -> DataFrame:
    """Bytes as text; bytes that are no UTF-8 are NULL and do not end the stream."""
    text = F.col(column).cast("string")
    return messages.withColumn(column, F.when(F.is_valid_utf8(text), text))


def encoded(messages: DataFrame, column: str = "value") -> DataFrame:
    return messages.withColumn(column, F.encode(column, "UTF-8"))


def confirmed_messages(messages: DataFrame, key: HashKey, known: DataFrame, broadcast: bool = False) -> DataFrame:
    """Numbers in ``value binary`` to the hashes of those that are known, as ``value binary``.

    No state is kept: each micro-batch is hashed in place and semi-joined with the
    known table. Messages that are not numbers are skipped;
    :func:`sluice.streaming.branches.confirm_messages` keeps them as dead letters.
    """
    hits = sensitive.confirm(decoded(messages), "value", key, known, broadcast)
    return encoded(hits.withColumnRenamed("hash", "value"))


def event_time(df: DataFrame, column: str = "ts") -> DataFrame:
    """Watermarks need a timestamp with zone; readings without one are taken in the
    session's zone, which should be UTC."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def windowed(df: DataFrame, ts: str = "ts", length: str = "30 seconds") -> DataFrame:
    """Add the tumbling window each row falls in; stateless."""
    return df.withColumn("window", F.window(ts, length))


def _window_counts(df: DataFrame, ts: str, length: str) -> DataFrame:
    counts = df.groupBy(F.window(ts, length).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n")


def tumbling_counts(stream: DataFrame, ts: str = "ts", length: str = "30 seconds", late: str = "1 minute") -> DataFrame:
    """Rows per window, each window emitted once, when it can get no more rows.

    Micro-batches are combined on the map side, so state and exchange hold one row
    per open window, however many rows one of them gets.
    """
    return _window_counts(stream.withWatermark(ts, late), ts, length)


def with_open_windows(closed: DataFrame, rows: DataFrame, ts: str = "ts", length: str = "30 seconds") -> DataFrame:
    """The windows a stream has emitted plus those still open, counted from the rows.

    Rows at or after the last emitted window's end are in no emitted window, so
    only the tail of ``rows`` is counted. Rows that came after their window was emitted are in no count:
    :func:`sluice.streaming.branches.write_windows` keeps those as well.
    """
    earliest = F.lit(datetime.datetime(1, 1, 1))
    kind = rows.schema[ts].dataType
    # Compared in the column's own type, so that the scan can skip what is older.
    last_end = closed.select(F.coalesce(F.max("window_end"), earliest).cast(kind)).scalar()
    tail = event_time(rows.filter(F.col(ts) >= last_end), ts)
    return closed.unionByName(_window_counts(tail, ts, length))


def deduplicated(
    stream: DataFrame, keys: Sequence[str], ts: str = "ts", late: str = "10 minutes", salts: int = 1
) -> DataFrame:
    """The first arrival of each key; redeliveries within ``late`` are dropped.

    State holds the keys seen within ``late`` of the watermark, not all of them.

    Copies of a key meet in one task. Where one key may have a large part of all rows,
    ``salts`` drops copies in that many tasks per key first, by where they were read,
    and leaves at most so many rows of a key to the task that decides. The price is that every
    key is kept and shuffled twice, so use it only where such a key is known.
    """
    marked = stream.withWatermark(ts, late)
    if salts > 1:
        salted = marked.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        marked = salted.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return marked.dropDuplicatesWithinWatermark(list(keys))


def object_name(path: Column) -> Column:
    """The part of an object's path that ends in ``csv``."""
    return F.regexp_extract(path, ".*csv", 0)


def arrivals(spark: SparkSession, folder: str, schema: T.StructType, **options) -> DataFrame:
    """Rows of every new ``.csv`` object below a folder, with the object's name.

    The objects are read as :func:`sluice.sources.files.read_csv` reads them, quoted newlines
    included, and so are those that :func:`sluice.sinks.tables.write_csv` writes. Give a string
    schema and type the columns afterwards.
    """
    stream = file_stream(spark, folder, schema, "csv", glob="*.csv", **{**CSV, **options})
    return stream.select("*", object_name(F.col("_metadata.file_path")).alias("source_file"))
