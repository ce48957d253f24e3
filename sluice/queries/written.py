"""Queries that write and read back: files, tables, streams, whole jobs.

Everything is written below the shared scratch folder of the session.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sluice.operators import listings, scoring, sensitive
from sluice.operators.counts import count_per_key
from sluice.plans import jobs
from sluice.queries import dirty
from sluice.queries import lookup as lookup_queries
from sluice.queries import sensitive as sensitive_queries
from sluice.queries import texts as text_queries
from sluice.queries.registry import query, spread_table, table
from sluice.scratch import scratch_dir
from sluice.sinks import tables as sinks
from sluice.sinks import versions
from sluice.sources import files, lookups, split_csv, split_json
from sluice.streaming import branches, streams

_LISTING_ROWS = f"SELECT {dirty.LISTING_ORACLE} FROM orders"
_LISTING_AND_COUNT = f"SELECT *, count(*) OVER (PARTITION BY neighbourhood) AS n_listings FROM ({_LISTING_ROWS})"
_LISTING_COUNTS = f"SELECT neighbourhood, count(*) AS n_listings FROM ({_LISTING_ROWS}) GROUP BY 1"


@query("SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 7 = 1 THEN NULL ELSE text END AS text, lang FROM documents")
def csv_roundtrip(spark, sf_dir):
    """Whole texts with commas, quotes and newlines, blank ones and NULL through CSV files."""
    folder = scratch_dir(spark, "csv")
    text = F.when(F.col("doc_id") % 7 == 0, "").when(F.col("doc_id") % 7 != 1, F.col("text"))
    docs = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"), "lang")
    sinks.write_csv(docs, folder)
    back = files.read_csv(spark, folder, files.all_strings(docs.schema))
    return back.withColumn("doc_id", F.col("doc_id").try_cast("bigint"))


@query("SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 7 = 1 THEN NULL ELSE text END AS text, lang FROM documents")
def csv_split_roundtrip(spark, sf_dir):
    """The same, each file read by as many tasks as it has splits, though texts hold newlines."""
    folder = scratch_dir(spark, "split-csv")
    text = F.when(F.col("doc_id") % 7 == 0, "").when(F.col("doc_id") % 7 != 1, F.col("text"))
    docs = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"), "lang")
    sinks.write_csv(docs, folder)
    back = split_csv.read_split_csv(spark, folder, files.all_strings(docs.schema))
    return back.withColumn("doc_id", F.col("doc_id").try_cast("bigint"))


@query(
    """SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'refused' ELSE 'loaded' END AS load, count(*) AS n,
    sum(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END)::BIGINT AS customers FROM orders GROUP BY 1"""
)
def csv_refused_early(spark, sf_dir):
    """Two loads by splits: one with an unreadable customer in every row is refused before anything is written, one is loaded."""
    folder = scratch_dir(spark, "refused")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.concat("o_orderpriority", F.lit('\n"x"')).alias("note"))
    is_bad = F.col("o_orderkey") % 3 == 0
    sinks.write_csv(orders.filter(~is_bad), f"{folder}/good")
    sinks.write_csv(orders.filter(is_bad).withColumn("o_custkey", F.lit("n/a")), f"{folder}/bad")
    loaded = files.load_csv(spark, f"{folder}/good", orders.schema, f"{folder}/out", reader=split_csv.read_split_csv, refuse_early=True)
    refused = None
    try:
        files.load_csv(spark, f"{folder}/bad", orders.schema, f"{folder}/refused", reader=split_csv.read_split_csv, refuse_early=True)
    except files.BadRecordBudgetExceeded:
        refused = split_csv.read_split_csv(spark, f"{folder}/bad", files.all_strings(orders.schema))
    sums = [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("o_custkey").try_cast("bigint")), F.lit(0)).alias("customers")]
    return loaded.table.groupBy(F.lit("loaded").alias("load")).agg(*sums).union(refused.groupBy(F.lit("refused").alias("load")).agg(*sums))


@query(
    """SELECT o_orderkey, o_custkey, o_orderpriority, CAST(round(o_totalprice) AS BIGINT) AS price
    FROM orders WHERE NOT (o_orderkey BETWEEN 3 AND 9)"""
)
def csv_bad_record_budget(spark, sf_dir):
    """A load that skips seven unreadable prices, within its budget of ten."""
    folder = scratch_dir(spark, "budget")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.round("o_totalprice").cast("bigint").alias("price")
    )
    price = F.when(F.col("o_orderkey").between(3, 9), "n/a").otherwise(F.col("price").cast("string"))
    sinks.write_csv(rows.withColumn("price", price), f"{folder}/in")
    return files.load_csv(spark, f"{folder}/in", rows.schema, f"{folder}/out", multi_line=False).table


@query(f"SELECT id, name, neighbourhood, latitude, price FROM ({_LISTING_ROWS})")
def sink_overwrite(spark, sf_dir):
    """Typed rows written twice to the same place with a given schema."""
    folder = scratch_dir(spark, "overwrite")
    rows = listings.good_rows(listings.listing_clean(dirty.raw_listings(spark, sf_dir)))
    sinks.overwrite(rows.select("id", "name"), folder)
    written = sinks.overwrite(rows, folder, listings.LISTING)
    return written.select("id", "name", "neighbourhood", "latitude", "price")


@query(_LISTING_AND_COUNT)
def sink_fan_out(spark, sf_dir):
    """Rows and their counts from one parse; the counts are read from the written rows."""
    folder = scratch_dir(spark, "fan-out")
    rows = listings.good_rows(listings.listing_clean(dirty.raw_listings(spark, sf_dir)))
    written, counted = sinks.overwrite_both(
        rows, f"{folder}/rows", lambda t: count_per_key(t, "neighbourhood"), f"{folder}/counts", listings.LISTING
    )
    return dirty._dates_as_text(written.join(counted, "neighbourhood"))


@query(_LISTING_AND_COUNT)
def sink_replace_together(spark, sf_dir):
    """Rows and their counts replaced together: a replacement that fails between the two tables leaves the first version."""
    folder = scratch_dir(spark, "together")
    rows = listings.good_rows(listings.listing_clean(dirty.raw_listings(spark, sf_dir)))

    def both(written):
        yield "rows", rows
        yield "counts", count_per_key(written("rows"), "neighbourhood")

    def broken(written):
        yield "rows", rows.limit(0)
        raise OSError("between the tables")

    versions.replace_together(spark, folder, both)
    try:
        versions.replace_together(spark, folder, broken)
    except OSError:
        table_, counts = versions.read_current(spark, folder, "rows", "counts")
        return dirty._dates_as_text(table_.join(counts, "neighbourhood"))
    raise AssertionError("a broken replacement went through")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority,
    CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS o_custkey FROM orders"""
)
def sink_append(spark, sf_dir):
    """Two appends with different columns, read back with all of them."""
    folder = scratch_dir(spark, "append")
    orders = table(spark, sf_dir, "orders")
    sinks.append(orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderpriority"), folder)
    sinks.append(orders.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_custkey"), folder)
    return sinks.read_appended(spark, folder)


@query("SELECT id, price FROM (" + _LISTING_ROWS + ") WHERE id % 97 <> 0")
def text_lines(spark, sf_dir):
    """Lines with a header on top of every file, read by pattern."""
    folder = scratch_dir(spark, "lines")
    header = ",".join(listings.LISTING.fieldNames())
    lines = dirty.raw_lines(spark, sf_dir).select("value")
    lines.write.text(f"{folder}/lines")
    spark.createDataFrame([(header,)], "value string").coalesce(1).write.mode("append").text(f"{folder}/lines")
    parsed = listings.parse_lines(files.read_lines(spark, f"{folder}/lines", header))
    return listings.good_rows(parsed).select("id", "price")


_FIELD = "struct<nation:int,segment:string,cents:bigint>"


@query(lookup_queries.ORACLE_LOOKUP)
def lookup_file(spark, sf_dir):
    """A lookup kept as files of JSON objects, one per line."""
    folder = scratch_dir(spark, "lookup")
    lookup_queries.customer_lookup_json(spark, sf_dir).write.text(folder)
    return lookups.explode_lookup(spark.read.text(folder), "value", _FIELD, "customer")


@query(lookup_queries.ORACLE_LOOKUP)
def lookup_one_object(spark, sf_dir):
    """The same kept as a single object in a single file, read by as many tasks as the file has splits."""
    folder = scratch_dir(spark, "one-object")
    objects = lookup_queries.customer_lookup_json(spark, sf_dir)
    least = objects.agg(F.min("value")).first()[0]
    inner = F.regexp_replace("value", r"^\{|\}$", "")
    entries = objects.select(F.lit(1).alias("at"), F.when(F.col("value") == least, inner).otherwise(F.concat(F.lit(","), inner)).alias("value"), "value")
    lines = entries.toDF("at", "value", "whole").union(spark.createDataFrame([(0, "{", ""), (2, "}", "")], "at int, value string, whole string"))
    lines.repartition(1).sortWithinPartitions("at", "whole").select("value").write.text(folder)
    return split_json.read_split_lookup(spark, folder, _FIELD, "customer")


_SCORED = f"""SELECT doc_id AS tweet_id, s.compound, w.word_sample
    FROM ({text_queries.SENTIMENT}) s JOIN ({text_queries.SAMPLE}) w USING (doc_id)"""


@query(_SCORED)
def scored_csv_roundtrip(spark, sf_dir):
    """Scores and word lists through the CSV hand-off, arrays as JSON."""
    folder = scratch_dir(spark, "scored")
    docs = spread_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("tweet_id"), F.col("text").alias("tweet"))
    scores = scoring.all_scores(docs, text_queries.lexicon(spark), "tweet_id", "tweet")
    sinks.write_csv(scores, folder)
    back = files.read_csv(spark, folder, files.all_strings(scores.schema))
    return back.select(
        F.col("tweet_id").try_cast("bigint").alias("tweet_id"),
        F.col("compound").try_cast("double").alias("compound"),
        F.array_join(F.from_json("word_sample", "array<string>"), " ").alias("word_sample"),
    )


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def file_arrival_ingest(spark, sf_dir):
    """Files arriving between two runs: each row comes in once."""
    folder = scratch_dir(spark, "arrivals")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    early = F.col("event_type").isin("click", "view")
    for part in (early, ~early):
        sinks.write_csv(events.filter(part), f"{folder}/in", mode="append")
        streams.drain(streams.arrivals(spark, f"{folder}/in", files.all_strings(events.schema)), f"{folder}/out", f"{folder}/checkpoint")
    seen = spark.read.parquet(f"{folder}/out").filter("source_file like '%csv'")
    return seen.groupBy(F.col("user_id").cast("bigint").alias("user_id"), "event_type").agg(F.count(F.lit(1)).alias("n"))


def _stream_of(spark, sf_dir, name):
    """A table as a stream. Written as a pattern, the path may be a file or a folder of files."""
    return streams.file_stream(spark, f"{sf_dir}/{name}.parque[t]", table(spark, sf_dir, name).schema)


def _event_stream(spark, sf_dir):
    return streams.event_time(_stream_of(spark, sf_dir, "events"))


_BUCKET = "time_bucket(INTERVAL 30 SECONDS, ts)"


@query(f"SELECT strftime({_BUCKET}, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n FROM events GROUP BY 1")
def tumbling_count(spark, sf_dir):
    """Events per 30 seconds: closed windows from the stream, open ones from the tail."""
    folder = scratch_dir(spark, "windows")
    stream = streams.tumbling_counts(_event_stream(spark, sf_dir))
    streams.drain(stream, f"{folder}/closed", f"{folder}/checkpoint")
    closed = spark.read.schema(stream.schema).parquet(f"{folder}/closed")
    counts = streams.with_open_windows(closed, table(spark, sf_dir, "events").select("ts"))
    return counts.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n")


@query(f"SELECT event_id, strftime({_BUCKET}, '%Y-%m-%d %H:%M:%S') AS window_start FROM events")
def stream_windows(spark, sf_dir):
    """Each event with its window; nothing is grouped, so nothing is held back."""
    folder = scratch_dir(spark, "window-rows")
    rows = streams.windowed(_event_stream(spark, sf_dir)).select("event_id", F.col("window.start").alias("start"))
    streams.drain(rows, f"{folder}/rows", f"{folder}/checkpoint")
    back = spark.read.parquet(f"{folder}/rows")
    return back.select("event_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("window_start"))


@query("SELECT event_id, user_id, event_type FROM events")
def stream_dedup(spark, sf_dir):
    """Events delivered twice, kept once."""
    folder = scratch_dir(spark, "dedup")
    twice = _event_stream(spark, sf_dir).unionAll(_event_stream(spark, sf_dir))
    streams.drain(streams.deduplicated(twice, ["event_id"], salts=4), f"{folder}/rows", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/rows").select("event_id", "user_id", "event_type")


@query(
    """SELECT event_type, count(*) AS kept, sum(1 + event_id % 2)::BIGINT - count(*)::BIGINT AS repeats,
    sum(event_id)::BIGINT AS ids FROM events GROUP BY event_type"""
)
def stream_first_arrivals(spark, sf_dir):
    """Events of which every second comes again in a later run, long after its time: each is kept once, and repeats are kept apart."""
    folder = scratch_dir(spark, "first-arrivals")
    events = streams.event_time(table(spark, sf_dir, "events")).select("event_id", "event_type", "ts")
    for part in (F.col("event_id") % 3 > 0, F.col("event_id") % 3 == 0, F.col("event_id") % 2 == 1):
        events.filter(part).write.mode("append").parquet(f"{folder}/in")
        branches.write_first_arrivals(streams.file_stream(spark, f"{folder}/in", events.schema), f"{folder}/out", ["event_id"])
    rows = branches.read_branch(spark, f"{folder}/out", "rows").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("kept"), F.sum("event_id").alias("ids")
    )
    repeats = branches.read_branch(spark, f"{folder}/out", "repeats").groupBy("event_type").agg(F.count(F.lit(1)).alias("repeats"))
    return rows.join(repeats, "event_type", "left")


@query(f"SELECT hash AS value FROM ({sensitive_queries.CONFIRMED})")
def stream_ssn_confirm(spark, sf_dir):
    """Findings published as byte messages, confirmed by a stream, published again."""
    folder = scratch_dir(spark, "confirm")
    texts = _stream_of(spark, sf_dir, "customer").select(F.expr(sensitive_queries.MESSAGE).alias("text"))
    findings = sensitive.scan(texts, "text").select(F.encode("quote", "UTF-8").alias("value"))
    streams.drain(findings, f"{folder}/probable", f"{folder}/checkpoint-1")
    sensitive_queries.known(spark, sf_dir).write.parquet(f"{folder}/known")
    known = spark.read.parquet(f"{folder}/known")
    probable = streams.file_stream(spark, f"{folder}/probable", findings.schema)
    confirmed = streams.confirmed_messages(probable, sensitive_queries.demo_key(spark), known)
    streams.drain(confirmed, f"{folder}/confirmed", f"{folder}/checkpoint-2")
    return streams.decoded(spark.read.schema(confirmed.schema).parquet(f"{folder}/confirmed"))


_NUMBER_FORM = sensitive_queries.FORMS
_IS_KNOWN = f"EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND {sensitive_queries.KNOWN_ORDERS})"


@query(
    f"""SELECT state, count(*) AS n FROM (SELECT CASE WHEN c_custkey % 11 = 0 THEN 'not text' WHEN c_custkey % 5 >= 2 THEN 'not a number'
    WHEN {_IS_KNOWN} THEN 'known' ELSE 'unknown' END AS state FROM customer) GROUP BY state"""
)
def stream_bad_messages(spark, sf_dir):
    """Messages of which some are no text and some no numbers: known, unknown and dead ones are all that arrived.
    The known set is laid out by hash prefix."""
    folder = scratch_dir(spark, "bad-messages")
    branches.write_known(sensitive_queries.known(spark, sf_dir), f"{folder}/known")
    text = F.encode(F.expr(_NUMBER_FORM.replace("E'\\n'", "'\\n'")), "UTF-8")
    value = F.when(F.col("c_custkey") % 11 == 0, F.unhex(F.lit("FF31"))).otherwise(text)
    stream = _stream_of(spark, sf_dir, "customer").select(value.alias("value"))
    branches.confirm_messages(stream, sensitive_queries.demo_key(spark), f"{folder}/known", f"{folder}/out")
    numbers = branches.read_branch(spark, f"{folder}/out", "numbers").select(F.when(F.col("known"), "known").otherwise("unknown").alias("state"))
    dead = branches.read_branch(spark, f"{folder}/out", "dead_letters").select(F.col("reason").alias("state"))
    return numbers.union(dead).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH mark AS (SELECT max(ts) - INTERVAL 1 MINUTE AS watermark FROM events WHERE event_id % 10 <> 0),
    placed AS (SELECT *, time_bucket(INTERVAL 30 SECONDS, ts) AS opened FROM events),
    judged AS (SELECT *, event_id % 10 = 0 AND opened + INTERVAL 30 SECONDS <= watermark AS late FROM placed, mark)
    SELECT strftime(opened, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) FILTER (NOT late) AS n, count(*) FILTER (late) AS n_late
    FROM judged GROUP BY opened"""
)
def window_late_rows(spark, sf_dir):
    """Events in two runs, the second of which brings rows of windows long closed: counts and late rows are all events."""
    folder = scratch_dir(spark, "late-rows")
    events = streams.event_time(table(spark, sf_dir, "events"))
    for part in (F.col("event_id") % 10 != 0, F.col("event_id") % 10 == 0):
        events.filter(part).write.mode("append").parquet(f"{folder}/in")
        branches.write_windows(streams.file_stream(spark, f"{folder}/in", events.schema), f"{folder}/out")
    counts = branches.window_counts(spark, f"{folder}/out").select("window_start", "n", F.lit(0).cast("bigint").alias("n_late"))
    late = streams.windowed(branches.read_branch(spark, f"{folder}/out", "late_rows"))
    late = late.select(F.col("window.start").alias("window_start"), F.lit(0).cast("bigint").alias("n"), F.lit(1).cast("bigint").alias("n_late"))
    both = counts.union(late).groupBy("window_start").agg(F.sum("n").alias("n"), F.sum("n_late").alias("n_late"))
    return both.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query(f"SELECT hash, count(*) AS n, true AS has_source FROM ({sensitive_queries.CONFIRMED}) GROUP BY hash")
def job_confirm_arriving_files(spark, sf_dir):
    """Text files in a folder to confirmed hashes with their source file."""
    folder = scratch_dir(spark, "confirm-files")
    sensitive_queries.messages(spark, sf_dir).select("text").write.text(f"{folder}/in")
    sensitive_queries.known(spark, sf_dir).write.parquet(f"{folder}/known")  # else each batch would hash it again
    confirmed = jobs.confirm_arriving_files(
        spark, f"{folder}/in", sensitive_queries.demo_key(spark), spark.read.parquet(f"{folder}/known"),
        f"{folder}/out", f"{folder}/checkpoint",
    )
    return confirmed.groupBy("hash").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("source_file").endswith(".txt")).alias("has_source")
    )


def _listing_csv(spark, sf_dir, folder):
    sinks.write_csv(dirty.raw_listings(spark, sf_dir), f"{folder}/in")
    return f"{folder}/in"


@query(_LISTING_AND_COUNT)
def job_load_listings(spark, sf_dir):
    folder = scratch_dir(spark, "listings")
    csv = _listing_csv(spark, sf_dir, folder)
    loaded = jobs.load_listings(spark, csv, f"{folder}/rows", f"{folder}/counts")
    return dirty._dates_as_text(loaded.table.join(loaded.counts, "neighbourhood"))


@query(
    """SELECT good, dead, good + dead AS total FROM (SELECT count(*) FILTER (o_orderkey % 13 <> 0) AS good,
    count(*) FILTER (o_orderkey % 13 = 0) AS dead FROM orders)"""
)
def job_load_dead_letters(spark, sf_dir):
    """A load of which some rows cannot be read: good ones and dead letters are all that came."""
    folder = scratch_dir(spark, "dead-letters")
    rows = dirty.raw_listings(spark, sf_dir)
    price = F.when(F.col("id").cast("bigint") % 13 == 0, F.when(F.col("id").cast("bigint") % 2 == 0, "")).otherwise(F.col("price"))
    sinks.write_csv(rows.withColumn("price", price), f"{folder}/in")
    loaded = jobs.load_listings(spark, f"{folder}/in", f"{folder}/rows", f"{folder}/counts")
    dead = loaded.dead_letters.filter(F.get_json_object("line", "$.id").cast("bigint") % 13 == 0)
    good = loaded.table.agg(F.count(F.lit(1)).alias("good"))
    both = good.join(dead.agg(F.count(F.lit(1)).alias("dead")), F.lit(True))
    return both.withColumn("total", F.col("good") + F.col("dead"))


@query(
    f"""SELECT CASE WHEN o_orderkey % 97 <> 0 THEN {dirty._HOOD_SQL} END AS neighbourhood, count(*) AS n_listings
    FROM orders GROUP BY 1"""
)
def job_load_listing_lines(spark, sf_dir):
    folder = scratch_dir(spark, "listing-lines")
    dirty.raw_lines(spark, sf_dir).select("value").write.text(f"{folder}/in")
    header = ",".join(listings.LISTING.fieldNames())
    return jobs.load_listing_lines(
        spark, f"{folder}/in", header, f"{folder}/rows", f"{folder}/counts", keep_nulls=True
    ).counts


_HOOD_DEMOGRAPHICS = f"""SELECT neighbourhood, count(*) AS n_listings, 'NTA-' || neighbourhood AS nta_code,
    CAST(sum(price) AS BIGINT) AS population, neighbourhood AS nta_name, CAST(sum(price) % 10000 AS BIGINT) AS median_rent,
    CASE WHEN neighbourhood <> 'Harlem' THEN CAST(sum(price) % 1000000 AS BIGINT) END AS median_home_value,
    CAST(sum(price) % 100 + 0.5 AS DOUBLE) AS percent_atleast_bachdeg FROM ({_LISTING_ROWS}) GROUP BY neighbourhood"""


@query(
    "SELECT neighbourhood, n_listings, "
    + ", ".join(
        f"CASE WHEN neighbourhood <> 'Astoria' THEN {c} END AS {c}"
        for c in ("nta_code", "median_rent", "median_home_value", "percent_atleast_bachdeg", "population", "nta_name")
    )
    + f" FROM ({_HOOD_DEMOGRAPHICS})"
)
def job_load_with_demographics(spark, sf_dir):
    """Listings with the demographics of all neighbourhoods but one."""
    folder = scratch_dir(spark, "demographics")
    csv = _listing_csv(spark, sf_dir, folder)
    rows = listings.good_rows(listings.listing_clean(dirty.raw_listings(spark, sf_dir)))
    totals = rows.filter("neighbourhood <> 'Astoria'").groupBy("neighbourhood").agg(F.sum("price").alias("total"))
    raw = totals.select(
        "neighbourhood",
        F.concat(F.lit("NTA-"), "neighbourhood").alias("nta_code"),
        F.format_number(F.col("total") % 10_000, 0).alias("median_rent"),
        F.when(F.col("neighbourhood") == "Harlem", "NaN").otherwise(F.format_number(F.col("total") % 1_000_000, 0)).alias("median_home_value"),
        F.concat((F.col("total") % 100).cast("string"), F.lit(".5")).alias("percent_atleast_bachdeg"),
        F.format_number("total", 0).alias("population"),
        F.col("neighbourhood").alias("nta_name"),
    )
    return jobs.load_with_demographics(spark, csv, f"{folder}/rows", f"{folder}/counts", raw).counts


@query(
    f"""SELECT neighbourhood, count(*) AS n_listings, left(neighbourhood_code, 1) AS puma_code,
    CAST(max(total) % 7 AS BIGINT) AS median_rent, CAST(max(total) * 2 AS BIGINT) AS median_home_value,
    37.5::DOUBLE AS percent_adults_bachdeg, CAST(max(total) AS BIGINT) AS population,
    left(neighbourhood_code, 1) AS puma_name FROM (
        SELECT neighbourhood, neighbourhood AS neighbourhood_code,
        sum(price) OVER (PARTITION BY left(neighbourhood, 1)) AS total FROM ({_LISTING_ROWS}))
    GROUP BY neighbourhood, left(neighbourhood_code, 1)"""
)
def job_load_with_area_statistics(spark, sf_dir):
    """Listings with statistics of the area, here all neighbourhoods of one initial."""
    folder = scratch_dir(spark, "areas")
    csv = _listing_csv(spark, sf_dir, folder)
    rows = listings.good_rows(listings.listing_clean(dirty.raw_listings(spark, sf_dir)))
    hoods = rows.groupBy("neighbourhood").agg(F.sum("price").alias("total"))
    lookup = hoods.select("neighbourhood", F.left("neighbourhood", F.lit(1)).alias("puma_code"))
    areas = hoods.groupBy(F.left("neighbourhood", F.lit(1)).alias("puma_code")).agg(F.sum("total").alias("total"))
    headers = F.array(*(F.lit(h) for h in ("P", "H", "A", "B", "R", "NAME")))
    total = F.col("total").cast("string")
    values = F.array(total, (F.col("total") * 2).cast("string"), F.lit("8"), F.lit("3"), (F.col("total") % 7).cast("string"), F.col("puma_code"))
    replies = areas.select("puma_code", F.to_json(F.array(headers, values)).alias("reply"))
    variables = dict(population="P", median_home_value="H", adults="A", adults_bachdeg="B", median_rent="R")
    return jobs.load_with_area_statistics(
        spark, csv, f"{folder}/rows", f"{folder}/counts", lookup, replies, variables
    ).counts


@query(
    """SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') > 0 AS has_f,
    CAST(sum(o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS "F_o_orderkey",
    CAST(sum(o_orderkey) FILTER (WHERE o_orderstatus = 'O') AS BIGINT) AS "O_o_orderkey",
    CAST(sum(o_orderkey) FILTER (WHERE o_orderstatus = 'P') AS BIGINT) AS "P_o_orderkey"
    FROM orders GROUP BY o_custkey"""
)
def job_pivot_table(spark, sf_dir):
    """A table pivoted into another one by their names."""
    folder = scratch_dir(spark, "pivot-table")
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_to_pivot")
    name = "pivoted_" + folder.rsplit("-", 1)[-1]
    wide = jobs.pivot_table(
        spark, "orders_to_pivot", name, ["o_custkey"], ["o_orderstatus"], ["o_orderkey"], path=folder
    )
    return wide.withColumn("has_f", F.col("F_o_orderkey").isNotNull())


_STRIPPED = """rtrim(rtrim(rtrim(trim(text, '"'), E' \\n\\t\\r\\x0b\\x0c'), '"'), E' \\n\\t\\r\\x0b\\x0c')"""
# All columns of the feed, from the cleaned texts under the name of the table.
_FEED = f"""WITH documents AS (SELECT doc_id, {text_queries.CLEAN_SQL} AS text FROM main.documents),
    sentiment AS ({text_queries.SENTIMENT}), polarity AS ({text_queries.POLARITY}), sample AS ({text_queries.SAMPLE}),
    vectors AS ({text_queries.DOCUMENT_VECTOR}),
    joined_vectors AS (SELECT doc_id, string_agg(x, ' ' ORDER BY dim) AS tok2vec FROM (
        SELECT doc_id, dim, CAST(CAST(round(x * 1000) AS BIGINT) AS VARCHAR) AS x FROM vectors) GROUP BY doc_id)
    SELECT doc_id AS tweet_id, neg, neu, pos, compound, polarity, subjectivity, word_sample, coalesce(tok2vec, '') AS tok2vec,
    CASE WHEN compound < -0.5 THEN 'neg' ELSE 'pos' END AS label, {_STRIPPED} AS tweet
    FROM documents JOIN sentiment USING (doc_id) JOIN polarity USING (doc_id) JOIN sample USING (doc_id)
    LEFT JOIN joined_vectors USING (doc_id) WHERE compound < -0.5 OR compound > 0.6"""


def _tweets(spark, sf_dir):
    docs = spread_table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("tweet_id"), F.col("text").alias("tweet"))


def _as_text(routed):
    thousandths = F.transform("tok2vec", lambda x: F.round(x * 1000).cast("bigint").cast("string"))
    return routed.withColumns(
        {"word_sample": F.array_join("word_sample", " "), "tok2vec": F.coalesce(F.array_join(thousandths, " "), F.lit(""))}
    )


@query(_FEED)
def job_sentiment_feed(spark, sf_dir):
    """Documents scored, handed over as CSV, routed, and appended by label."""
    folder = scratch_dir(spark, "feed")
    vectors = text_queries.token_vectors(spark, sf_dir)
    jobs.hand_off_scores(_tweets(spark, sf_dir), text_queries.lexicon(spark), f"{folder}/csv", vectors, text_queries.VECTOR_WIDTH)
    return _as_text(jobs.route_scores(spark, f"{folder}/csv", f"{folder}/out", f"{folder}/checkpoint"))


@query(_FEED.replace("tok2vec, '') AS tok2vec", "NULL, '') AS tok2vec"))
def job_feed_two_arrivals(spark, sf_dir):
    """Two hand-offs with a run after each, and a run without one, load every text once."""
    folder = scratch_dir(spark, "feed-twice")
    tweets = _tweets(spark, sf_dir)
    for part in (F.col("tweet_id") % 2 == 0, F.col("tweet_id") % 2 == 1, F.lit(False)):
        jobs.hand_off_scores(tweets.filter(part), text_queries.lexicon(spark), f"{folder}/csv")
        routed = jobs.route_scores(spark, f"{folder}/csv", f"{folder}/out", f"{folder}/checkpoint")
    return _as_text(routed)


@query(
    """SELECT CASE WHEN doc_id % 5 = 0 OR doc_id % 7 = 0 THEN 'unreadable' WHEN doc_id % 21 < 5 THEN 'neg' ELSE 'pos' END AS label,
    doc_id % 5 = 0 AS bad_score, doc_id % 7 = 0 AS bad_id, count(*) AS n, sum(length(text))::BIGINT AS chars FROM documents
    WHERE doc_id % 5 = 0 OR doc_id % 7 = 0 OR doc_id % 21 < 5 OR doc_id % 21 > 16 GROUP BY ALL"""
)
def feed_dead_letters(spark, sf_dir):
    """A hand-off of which some scores and ids cannot be read: those rows are kept as they came, the others routed."""
    folder = scratch_dir(spark, "feed-dead")
    doc = F.col("doc_id")
    scores = [F.lit("0.25").alias(n) for n in ("neg", "neu", "pos", "polarity", "subjectivity")]
    compound = F.when(doc % 5 == 0, "n/a").otherwise(((doc % 21 - 10) / F.lit(10.0)).cast("string"))
    lists = [F.lit('["a"]').alias("word_sample"), F.lit(None).cast("string").alias("tok2vec")]
    rows = table(spark, sf_dir, "documents").select(
        F.when(doc % 7 == 0, F.concat(F.lit("x"), doc)).otherwise(doc.cast("string")).alias("tweet_id"), F.col("text").alias("tweet"),
        *scores[:3], compound.alias("compound"), *scores[3:], *lists,
    )
    sinks.write_csv(rows, f"{folder}/csv")
    routed = jobs.route_scores(spark, f"{folder}/csv", f"{folder}/out", f"{folder}/checkpoint")
    routed = routed.select("label", F.lit(False).alias("bad_score"), F.lit(False).alias("bad_id"), F.col("tweet_id").alias("id"))
    line = jobs.feed_dead_letters(spark, f"{folder}/out").select(
        *(F.get_json_object("line", f"$.{c}").alias(c) for c in ("tweet_id", "compound"))
    )
    dead = line.select(
        F.lit(jobs.UNREADABLE).alias("label"), F.col("compound") == "n/a", F.col("tweet_id").startswith("x"),
        F.replace("tweet_id", F.lit("x"), F.lit("")).cast("bigint").alias("id"),
    )
    lengths = table(spark, sf_dir, "documents").select(doc.alias("id"), F.length("text").alias("chars"))
    joined = routed.union(dead).join(lengths, "id")
    return joined.groupBy("label", "bad_score", "bad_id").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))


@query(
    """SELECT doc_id // 20 AS object, md5(string_agg(coalesce(text, '') || chr(10), '' ORDER BY doc_id)) AS digest,
    sum(length(coalesce(text, '')) + 1)::BIGINT AS chars FROM documents GROUP BY 1"""
)
def whole_objects(spark, sf_dir):
    """Objects of twenty texts each, read whole with the name they came from."""
    folder = scratch_dir(spark, "objects")
    docs = table(spark, sf_dir, "documents").select(F.expr("doc_id DIV 20").alias("object"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    split = docs.repartition("object").sortWithinPartitions("object", "doc_id")
    split.select("object", "text").write.partitionBy("object").text(folder)
    whole = files.read_objects(spark, folder, whole=True)
    return whole.select(
        F.regexp_extract("source_file", "object=([0-9]+)", 1).cast("bigint").alias("object"),
        F.md5(F.col("value").cast("binary")).alias("digest"), F.length("value").cast("bigint").alias("chars"),
    )


@query(
    r"""WITH planted AS (SELECT coalesce(text, '') || ' ' || lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0') || '-12-3456' || chr(10) AS text FROM documents)
    SELECT quote, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '\b(?:\d{3}-\d{2}-\d{4}|\d{9})\b')) AS quote FROM planted) GROUP BY quote"""
)
def ssn_scan_long_lines(spark, sf_dir):
    """Texts written as objects of one long line, with a number planted in each: searched by the pieces between blanks."""
    folder = scratch_dir(spark, "long-lines")
    number = F.concat(F.lit(" "), F.lpad((F.col("doc_id") % 1000).cast("string"), 3, "0"), F.lit("-12-3456 "))
    text = F.translate(F.coalesce("text", F.lit("")), "\n", "\r")
    table(spark, sf_dir, "documents").select(F.concat(text, number)).write.option("lineSep", " ").text(folder)
    found = sensitive.scan(files.read_pieces(spark, folder).select("value"), "value")
    return found.groupBy("quote").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey, p_name FROM part")
def sink_only_if_empty(spark, sf_dir):
    """A target is filled once; the second write, of other rows, is refused and changes nothing."""
    folder = scratch_dir(spark, "if-empty")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    written = sinks.write_if_empty(parts, folder)
    try:
        sinks.write_if_empty(parts.limit(1), folder)
    except AnalysisException:
        return written
    raise AssertionError("a filled target was written to")


@query("SELECT s_suppkey, s_name FROM supplier")
def namespace_table(spark, sf_dir):
    """A namespace made twice, and a finished folder published in it as a table, then another one."""
    folder = scratch_dir(spark, "namespace")
    name = "sluice_" + folder.rsplit("-", 1)[-1]
    for _ in range(2):
        sinks.create_namespace(spark, name, f"{folder}/it's a place")
    suppliers = table(spark, sf_dir, "supplier")
    sinks.write_if_empty(suppliers.select("s_suppkey"), f"{folder}/one")
    sinks.publish(spark, f"{name}.suppliers", f"{folder}/one")
    sinks.write_if_empty(suppliers.select("s_suppkey", "s_name"), f"{folder}/two")
    return sinks.publish(spark, f"{name}.suppliers", f"{folder}/two")
