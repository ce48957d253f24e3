"""Streams with several outputs: nothing is lost, nothing counted twice, whatever fails in between."""

from __future__ import annotations

import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sluice.operators import sensitive
from sluice.queries.sensitive import demo_key
from sluice.streaming import branches, streams


def numbers_of(df, column):
    return sorted(r[0] for r in df.select(column).collect())


def test_failure_between_two_branches(spark, folder):
    spark.range(20).write.parquet(f"{folder}/in")
    state = {"fail": True}

    def parts(batch, number):
        yield "good", batch.filter("id % 3 > 0")
        if state["fail"]:
            raise OSError("between the branches")
        yield "dead", batch.filter("id % 3 = 0")

    def run():
        branches.write_branches(streams.file_stream(spark, f"{folder}/in", "id long", max_files_per_trigger=3), f"{folder}/out", parts)

    with pytest.raises(StreamingQueryException, match="between the branches"):
        run()
    with pytest.raises(FileNotFoundError):  # one branch is written, and no reader sees it
        branches.read_branch(spark, f"{folder}/out", "good")
    state["fail"] = False
    run()
    spark.range(20, 30).write.mode("append").parquet(f"{folder}/in")
    state["fail"] = True
    with pytest.raises(StreamingQueryException):
        run()
    seen = [numbers_of(branches.read_branch(spark, f"{folder}/out", n), "id") for n in ("good", "dead")]
    assert sorted(seen[0] + seen[1]) == list(range(20))
    state["fail"] = False
    run()
    run()  # nothing arrived
    seen = [numbers_of(branches.read_branch(spark, f"{folder}/out", n), "id") for n in ("good", "dead")]
    assert sorted(seen[0] + seen[1]) == list(range(30)) and seen[1] == list(range(0, 30, 3))


def test_bad_bytes_do_not_end_the_stream(spark, folder):
    values = [b"123-45-6789", b"\xff1", None, b"12345", b"", b" 987654321 ", "é".encode()]
    spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, value binary").write.parquet(f"{folder}/in")
    key = demo_key(spark)
    known = sensitive.known_hashes(spark.createDataFrame([("123456789",), ("123456789",)], "ssn string"), "ssn", key)
    branches.write_known(known.union(known), f"{folder}/known")
    stream = streams.file_stream(spark, f"{folder}/in", "id int, value binary")
    branches.confirm_messages(stream, key, f"{folder}/known", f"{folder}/out")
    good = branches.read_branch(spark, f"{folder}/out", "numbers")
    dead = branches.read_branch(spark, f"{folder}/out", "dead_letters")
    assert {(r.id, r.known) for r in good.collect()} == {(0, True), (5, False)}
    assert {(r.id, r.reason) for r in dead.collect()} == {
        (1, "not text"), (2, "not a number"), (3, "not a number"), (4, "not a number"), (6, "not a number")
    }
    assert "value" not in dead.columns and "value" not in good.columns
    rows = streams.decoded(spark.read.parquet(f"{folder}/in")).filter("value IS NOT NULL").collect()
    assert {r.id for r in rows} == {0, 3, 4, 5, 6}


def test_only_the_prefixes_of_a_batch_are_read(spark, folder):
    key = demo_key(spark)
    numbers = spark.range(3000).select(F.lpad(F.col("id").cast("string"), 9, "0").alias("ssn"))
    branches.write_known(sensitive.known_hashes(numbers, "ssn", key), f"{folder}/known")
    few = sensitive.hashed(numbers.limit(3), "ssn", key)
    touched = branches.known_among(few, f"{folder}/known")
    assert few.join(touched, "hash").count() == 3
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "prefix#" in plan.split("PartitionFilters")[1].split("]")[0]
    read = {r[0] for r in touched.select(F.col("hash").substr(1, 2)).distinct().collect()}
    assert read == {r[0] for r in few.select(F.col("hash").substr(1, 2)).distinct().collect()}


def test_late_and_undated_rows_are_kept(spark, folder):
    def at(minute, second=0):
        return datetime.datetime(2024, 1, 1, 0, minute, second)

    runs = [[(1, at(0, 5)), (2, at(10))], [(3, at(0, 10)), (4, at(8, 59)), (5, None), (6, at(9, 5)), (7, at(30))], [(8, at(9)), (9, at(29, 10))]]
    found = []
    for rows in runs:
        spark.createDataFrame(rows, "id int, ts timestamp").coalesce(1).write.mode("append").parquet(f"{folder}/in")
        branches.write_windows(streams.file_stream(spark, f"{folder}/in", "id int, ts timestamp"), f"{folder}/out")
        late = numbers_of(branches.read_branch(spark, f"{folder}/out", "late_rows"), "id")
        undated = numbers_of(branches.read_branch(spark, f"{folder}/out", "undated"), "id")
        counts = branches.window_counts(spark, f"{folder}/out").collect()
        found.append((late, undated, sum(r.n for r in counts), sum(r.closed for r in counts)))
    # marks: none, 00:09:00, 00:29:00
    assert found == [([], [], 2, 1), ([3, 4], [5], 4, 3), ([3, 4, 8], [5], 5, 3)]


def test_redelivery_days_later_is_dropped(spark, folder):
    def day(d, hour=0):
        return datetime.datetime(2024, 1, d, hour)

    schema = "id int, part string, ts timestamp"
    runs = [
        [(1, "a", day(1)), (1, "a", day(1, 5)), (1, None, day(1)), (2, "a", day(2)), (3, "a", None)],
        [(9, "a", day(28))],
        [(1, "a", day(1)), (1, None, day(1, 7)), (1, "b", day(1)), (1, "a", day(2)), (3, "a", None), (9, "a", day(28))],
    ]
    for rows in runs:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        branches.write_first_arrivals(streams.file_stream(spark, f"{folder}/in", schema), f"{folder}/out", ["id", "part"])
    kept = branches.read_branch(spark, f"{folder}/out", "rows")
    assert sorted(((r.id, r.part, r.ts) for r in kept.collect()), key=str) == sorted(
        [(1, "a", day(1)), (1, None, day(1)), (2, "a", day(2)), (3, "a", None), (9, "a", day(28)), (1, "b", day(1)), (1, "a", day(2))], key=str
    )
    assert branches.read_branch(spark, f"{folder}/out", "repeats").count() == sum(map(len, runs)) - 7
    one = kept.filter(F.col("bucket").isin("2024-01-28-00"))
    assert "bucket#" in one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("]")[0]


def test_branch_without_rows(spark, folder):
    spark.createDataFrame([(1, datetime.datetime(2024, 1, 1))], "id int, ts timestamp").write.parquet(f"{folder}/in")
    branches.write_first_arrivals(streams.file_stream(spark, f"{folder}/in", "id int, ts timestamp"), f"{folder}/out", ["id"])
    assert branches.read_branch(spark, f"{folder}/out", "repeats", schema="id int, ts timestamp, bucket string").count() == 0
