"""Streams with several outputs per micro-batch: good rows and dead letters, windows and late rows.

Each batch writes its branches one after the other into folders that carry its number, and marks
itself as done last. Structured Streaming repeats a batch that failed, with the same number and rows, so its folders
are written anew and nothing is counted twice; readers see the batches that are done. The checkpoint lies
beside the branches, as numbers have a meaning only together with it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.hashing import HashKey
from sluice.operators import sensitive
from sluice.sinks.tables import files_of
from sluice.streaming.streams import decoded

#: The column of a branch that tells the batch.
BATCH = "batch_number"
#: Why a message is no number.
NOT_TEXT, NOT_A_NUMBER = "not text", "not a number"


def write_branches(
    stream: DataFrame, folder: str, branches: Callable[[DataFrame, int], Iterable[tuple[str, DataFrame]]],
    partition_by: Sequence[str] = (),
) -> None:
    """Everything available now to the branches below ``folder``, then stop; run again for what arrived since.

    ``branches`` gets a batch and its number and tells the names and rows of its branches, always the same names.
    Rows of a batch are laid out by the columns ``partition_by`` that every branch has. The batch is kept while it is written, so it is read once; what an executor loses is read again.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for name, rows in branches(batch, number):
                rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{folder}/{name}/{BATCH}={number}")
            files, mark = files_of(batch.sparkSession, f"{folder}/_done/{number}")
            files.create(mark, True).close()
        finally:
            batch.unpersist()

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/_checkpoint")
    query.trigger(availableNow=True).start().awaitTermination()


def last_done(spark: SparkSession, folder: str) -> int:
    """The number of the last batch that is done, -1 before the first."""
    files, done = files_of(spark, f"{folder}/_done")
    if not files.exists(done):
        return -1
    return max((int(s.getPath().getName()) for s in files.listStatus(done)), default=-1)


def read_branch(
    spark: SparkSession, folder: str, name: str, before: int | None = None, schema: T.StructType | str | None = None
) -> DataFrame:
    """The rows of a branch in all batches that are done, or in those before a number. Give the ``schema``
    where the branch may have had no row yet and is laid out by columns."""
    last = last_done(spark, folder) if before is None else before - 1
    if last < 0:
        raise FileNotFoundError(f"no batch is done in {folder}")
    reader = spark.read
    if schema is not None:
        given = spark.createDataFrame([], schema).schema
        reader = reader.schema(T.StructType([*given.fields, T.StructField(BATCH, T.IntegerType())]))
    rows = reader.parquet(f"{folder}/{name}")
    return rows.filter(F.col(BATCH) <= last)


def write_known(known: DataFrame, path: str, digits: int = 2) -> None:
    """A known set of hashes, distinct and laid out by the first ``digits`` hexadecimal digits, for :func:`known_among`."""
    by_prefix = known.select("hash").distinct().withColumn("prefix", F.substring("hash", 1, digits))
    by_prefix.repartition("prefix").write.partitionBy("prefix").parquet(path)


def known_among(hashes: DataFrame, path: str, digits: int = 2) -> DataFrame:
    """The part of a known set that lies under the prefixes of ``hashes``: only these folders are read.

    The driver gets the distinct prefixes, at most ``16 ** digits``.
    """
    prefixes = [r[0] for r in hashes.select(F.substring("hash", 1, digits)).distinct().collect()]
    known = hashes.sparkSession.read.schema("hash string, prefix string").parquet(path)
    return known.filter(F.col("prefix").isin(prefixes)).select("hash")


def confirm_messages(stream: DataFrame, key: HashKey, known_path: str, folder: str, column: str = "value", digits: int = 2) -> None:
    """Messages (``column`` is binary) to two branches; each message is in one of them.

    ``numbers`` has the hash in place of the number and whether it is ``known``. ``dead_letters`` has the ``reason`` why
    a message is no number, without the message. Other columns are kept. ``known_path`` is a set written by
    :func:`write_known`; a batch reads the prefixes it needs of it.
    """

    def branches(batch: DataFrame, number: int) -> Iterable[tuple[str, DataFrame]]:
        read = batch.withColumn("_unread", F.col(column).isNotNull()).transform(decoded, column)
        reason = F.when(F.col("_unread") & F.col(column).isNull(), NOT_TEXT).otherwise(NOT_A_NUMBER)
        yield "dead_letters", sensitive.rejected(read.withColumn("reason", reason), column).drop("_unread")
        numbers = sensitive.hashed(read.drop("_unread"), column, key)
        known = known_among(numbers, known_path, digits).withColumn("known", F.lit(True))
        yield "numbers", numbers.join(known, "hash", "left").withColumn("known", F.coalesce("known", F.lit(False)))

    write_branches(stream, folder, branches)


def _watermark(spark: SparkSession, folder: str, late: str, before: int | None = None):
    """The latest time in the batches done, or before a number, less ``late``; NULL before the first."""
    try:
        latest = read_branch(spark, folder, "seen", before).agg(F.unix_micros(F.max("latest"))).first()[0]
    except (FileNotFoundError, AnalysisException):
        latest = None
    return F.timestamp_micros(F.lit(latest).cast("bigint")) - F.expr(f"INTERVAL {late}")


def write_windows(stream: DataFrame, folder: str, ts: str = "ts", length: str = "30 seconds", late: str = "1 minute") -> None:
    """Counts per window, and beside them each row that came too late for its window.

    A row is late if its window ended at or before the watermark: the latest time in earlier batches less
    ``late``. Late rows go to the branch ``late_rows``, rows without a time to ``undated``, and all others into one
    count per batch and window, so counts, late and undated rows are all that arrived.
    """

    def branches(batch: DataFrame, number: int) -> Iterable[tuple[str, DataFrame]]:
        mark = _watermark(batch.sparkSession, folder, late, before=number)
        window = F.window(F.col(ts).cast("timestamp"), length)
        dated = batch.filter(F.col(ts).isNotNull()).withColumn("_window", window)
        is_late = F.coalesce(F.col("_window.end") <= mark, F.lit(False))
        on_time = dated.filter(~is_late).groupBy(F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"))
        yield "counts", on_time.agg(F.count(F.lit(1)).alias("n"))
        yield "late_rows", dated.filter(is_late).drop("_window")
        yield "undated", batch.filter(F.col(ts).isNull())
        yield "seen", batch.agg(F.max(F.col(ts).cast("timestamp")).alias("latest"))

    write_branches(stream, folder, branches)


def write_first_arrivals(stream: DataFrame, folder: str, keys: Sequence[str], ts: str = "ts", bucket: str = "day") -> None:
    """The first row of each key to the branch ``rows``, however much later the key comes again, and the others to ``repeats``.

    A redelivery has the time of the row it repeats, so the rows kept before lie under the same ``bucket`` of time (``hour``,
    ``day``, ``month``): a batch is joined with the buckets it has rows of and with no others, and no state grows with the
    keys. Rows without a time have a bucket of their own. Rows of a key with different times in different buckets are
    different rows. The driver gets the distinct buckets of a batch.
    """

    def branches(batch: DataFrame, number: int) -> Iterable[tuple[str, DataFrame]]:
        time = F.date_trunc(bucket, F.col(ts).cast("timestamp"))
        placed = batch.withColumn("bucket", F.coalesce(F.date_format(time, "yyyy-MM-dd-HH"), F.lit("none")))
        first = F.row_number().over(Window.partitionBy("bucket", *keys).orderBy(F.col(ts).asc_nulls_last()))
        ranked = placed.withColumn("_place", first)
        fresh = ranked.filter("_place = 1")
        try:
            kept = read_branch(batch.sparkSession, folder, "rows", before=number)
        except (FileNotFoundError, AnalysisException):
            repeated = fresh.limit(0)
        else:
            buckets = [r[0] for r in placed.select("bucket").distinct().collect()]
            kept = kept.filter(F.col("bucket").isin(buckets)).select(*(F.col(c).alias(f"_{c}") for c in ("bucket", *keys)))
            same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("bucket", *keys)]
            repeated = fresh.join(kept, same, "left_semi")
            fresh = fresh.join(kept, same, "left_anti")
        yield "rows", fresh.drop("_place")
        yield "repeats", repeated.unionByName(ranked.filter("_place > 1")).drop("_place")

    write_branches(stream, folder, branches, partition_by=["bucket"])


def window_counts(spark: SparkSession, folder: str, late: str = "1 minute") -> DataFrame:
    """``window_start, window_end, n, closed`` of :func:`write_windows`; a closed window gets no more rows."""
    mark = _watermark(spark, folder, late)
    counts = read_branch(spark, folder, "counts").groupBy("window_start", "window_end").agg(F.sum("n").alias("n"))
    return counts.withColumn("closed", F.coalesce(F.col("window_end") <= mark, F.lit(False)))
