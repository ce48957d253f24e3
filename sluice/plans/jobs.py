"""Whole jobs: sources, operators and sinks put together."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import cleaning
from sluice.functions.hashing import HashKey
from sluice.functions.patterns import evaluated_once
from sluice.operators import enrichment, listings, pivot, scored, scoring, sensitive
from sluice.operators.counts import count_per_key
from sluice.sinks import tables as sinks
from sluice.sources import files, split_csv
from sluice.sources.tables import validate_table, validated_projection
from sluice.streaming import streams


#: The label of rows of the feed that cannot be read.
UNREADABLE = "unreadable"


class Load(NamedTuple):
    """The written rows, what was derived from them, and the rows that could not be read, as they came.

    ``table`` and ``dead_letters`` are the parts ``readable=true`` and ``readable=false`` of one folder.
    """

    table: DataFrame
    counts: DataFrame
    dead_letters: DataFrame


def _load(
    parsed: DataFrame, line: Column, path: str, counts_path: str, derive: Callable[[DataFrame], DataFrame],
    keep_nulls: bool = False,
) -> Load:
    """Parsed rows to a folder, unreadable ones beside them with their text, in one write."""
    fields = listings.LISTING.fieldNames()
    readable = F.col(listings.PARSE_OK)
    rows = parsed.select(*(F.when(readable, F.col(c)).alias(c) for c in fields), readable.alias("readable"),
                         F.when(~readable, line).alias("line"))
    written = sinks.overwrite(rows, path, partition_by=["readable"])
    table = (written if keep_nulls else written.filter("readable")).select(*fields)
    counts = sinks.overwrite(derive(table), counts_path)
    return Load(table, counts, written.filter("NOT readable").select("line"))


def _load_csv(spark, csv_path, listings_path, counts_path, derive, multi_line, in_splits=False) -> Load:
    if in_splits:
        raw = split_csv.read_split_csv(spark, csv_path, listings.RAW_LISTING)
    else:
        raw = files.read_csv(spark, csv_path, listings.RAW_LISTING, multi_line)
    whole = raw.withColumn("_line", F.to_json(F.struct(*raw.columns)))
    return _load(listings.listing_clean(whole), F.col("_line"), listings_path, counts_path, derive)


def load_listings(spark: SparkSession, csv_path: str, listings_path: str, counts_path: str, multi_line: bool = True,
                  in_splits: bool = False) -> Load:
    """Listing CSV to a typed table and the listings per neighbourhood.

    Rows that cannot be read are dead letters, as JSON of their fields. With ``multi_line`` a file
    is read by one task: keep files moderate, switch it off where no field holds a newline, or read large files with
    newlines in quotes ``in_splits``.
    """
    def counted(table: DataFrame) -> DataFrame:
        return count_per_key(table, "neighbourhood")

    return _load_csv(spark, csv_path, listings_path, counts_path, counted, multi_line, in_splits)


def load_listing_lines(spark: SparkSession, path: str, header: str, listings_path: str, counts_path: str,
                       keep_nulls: bool = False) -> Load:
    """The same from physical lines by pattern; ``keep_nulls`` loads unreadable lines as
    all-NULL rows as well, which then count under the NULL neighbourhood."""
    parsed = listings.parse_lines(files.read_lines(spark, path, header))
    return _load(parsed, F.col("_line"), listings_path, counts_path, lambda t: count_per_key(t, "neighbourhood"), keep_nulls)


def load_with_area_statistics(
    spark: SparkSession, csv_path: str, listings_path: str, counts_path: str,
    lookup: DataFrame, replies: DataFrame, variables: Mapping[str, str], multi_line: bool = True,
) -> Load:
    """Listing CSV to a typed table and neighbourhood counts with area statistics."""
    statistics = enrichment.area_statistics(replies, variables)

    def supplement(table: DataFrame) -> DataFrame:
        return enrichment.enrich_two_hop(count_per_key(table, "neighbourhood"), lookup, statistics)

    return _load_csv(spark, csv_path, listings_path, counts_path, supplement, multi_line)


def load_with_demographics(
    spark: SparkSession, csv_path: str, listings_path: str, counts_path: str, raw_demographics: DataFrame,
    multi_line: bool = True,
) -> Load:
    """Listing CSV to a typed table and neighbourhood counts with demographics."""
    found = enrichment.demographics(raw_demographics)

    def supplement(table: DataFrame) -> DataFrame:
        return enrichment.enrich_one_hop(count_per_key(table, "neighbourhood"), found)

    return _load_csv(spark, csv_path, listings_path, counts_path, supplement, multi_line)


def score_texts(
    texts: DataFrame, lexicon: DataFrame, vectors: DataFrame | None = None, width: int | None = None
) -> DataFrame:
    """``(tweet_id, tweet)`` to the columns of a scored text, one row per row whatever the ids.

    Each text is folded where it stands: nothing is moved, sorted or joined back. ``vectors`` (``token, vector``, each of
    ``width`` numbers) adds the mean vector of each text's tokens as ``tok2vec``, summed in the same pass.
    """
    clean = texts.select("tweet_id", evaluated_once(cleaning.ascii_only(F.col("tweet"))).alias("tweet"))
    scores = scoring.row_scores(clean, lexicon, "tweet", vectors, width)
    if vectors is None:
        return scores.withColumn("tok2vec", F.lit(None).cast("array<double>"))
    return scores.withColumnRenamed("vector", "tok2vec")


def hand_off_scores(
    texts: DataFrame, lexicon: DataFrame, folder: str, vectors: DataFrame | None = None, width: int | None = None
) -> None:
    """Score texts and write them as CSV for :func:`route_scores`."""
    names = ["tweet_id", "tweet", *scored.SCORES, "word_sample", "tok2vec"]
    sinks.write_csv(score_texts(texts, lexicon, vectors, width).select(*names), folder, mode="append")


def route_scores(spark: SparkSession, folder: str, target: str, checkpoint: str, **options) -> DataFrame:
    """Scored CSV files that arrived to rows by label, appended below ``target``; neutral ones are dropped.

    Each file comes in once, however often this runs with the same checkpoint. One write
    partitioned by label instead of one per label, so the files are read once. A row of which some text cannot be read
    as its number or list is not routed: it goes to a part of its own, see :func:`feed_dead_letters`.
    """
    names = ["tweet_id", "tweet", *scored.SCORES, "word_sample", "tok2vec"]
    raw = streams.arrivals(spark, folder, T.StructType([T.StructField(n, T.StringType()) for n in names]), **options)
    typed = {
        "tweet_id": cleaning.whole_number(F.col("tweet_id")),
        "tweet": cleaning.strip_quotes(F.col("tweet")),
        **{n: cleaning.real_number(F.col(n)) for n in scored.SCORES},
        "word_sample": F.from_json("word_sample", "array<string>"),
        "tok2vec": F.from_json("tok2vec", "array<double>"),
    }
    unreadable = F.lit(False)
    for name, column in typed.items():
        if name != "tweet":
            unreadable = unreadable | ((F.coalesce(F.trim(name), F.lit("")) != "") & column.isNull())
    line = F.to_json(F.struct(*names))
    marked = raw.select(*(c.alias(n) for n, c in typed.items()), F.when(unreadable, line).alias("line"))
    label = F.when(F.col("line").isNotNull(), UNREADABLE).otherwise(scored.label_of_score(F.col("compound")))
    streams.drain(marked.withColumn("label", label).filter("label != 'neutral'"), target, checkpoint, partition_by=["label"])
    return sinks.read_appended(spark, target).filter(F.col("label") != UNREADABLE).drop("line")


def feed_dead_letters(spark: SparkSession, target: str) -> DataFrame:
    """``line``: the rows that :func:`route_scores` could not read, as JSON of their fields."""
    return sinks.read_appended(spark, target).filter(F.col("label") == UNREADABLE).select("line")


def pivot_table(
    spark: SparkSession, source: str, target: str, keys: Sequence[str], pivots: Sequence[str], values: Sequence[str],
    path: str | None = None, **options,
) -> DataFrame:
    """Pivot a catalog table into another, which is replaced; the result brings its own schema.

    ``path`` keeps the files of the target there instead of in the warehouse folder.
    """
    rows = validated_projection(validate_table(spark, source), [*keys, *pivots, *values])
    writer = pivot.pivot(rows, keys, pivots, values, **options).write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(target)
    return spark.table(target)


def confirm_arriving_files(
    spark: SparkSession, folder: str, key: HashKey, known: DataFrame, target: str, checkpoint: str,
    max_files_per_trigger: int | None = None, broadcast: bool = False,
) -> DataFrame:
    """Text files arriving in a folder to the confirmed hashes found in them, each with
    the file it came from. Run again to process what arrived since.

    What the scan finds has nine digits, so no finding is rejected; those not known are left out.
    ``max_files_per_trigger`` cuts a backlog into several batches.
    """
    lines = streams.file_stream(spark, folder, "value string", "text", max_files_per_trigger=max_files_per_trigger)
    named = lines.select("value", F.col("_metadata.file_path").alias("source_file"))
    found = sensitive.scan(named, "value").select("source_file", "quote")
    streams.drain(sensitive.confirm(found, "quote", key, known, broadcast), target, checkpoint)
    return spark.read.parquet(target)
