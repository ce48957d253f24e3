"""CSV files read by splits against the whole-file reader."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.cleaning import whole_number
from sluice.sinks import tables as sinks
from sluice.sources import files, split_csv

SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "text", "more")])


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes."""
    sizes = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in sizes}
    for k, v in sizes.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows_of(df):
    return sorted(df.collect(), key=str)


def random_csv(seed: int, newline: str = "\n") -> str:
    rnd = random.Random(seed)
    pieces = ["a", "é", " ", ",", newline, newline, '""', "word", "x" * 40, "'", "\\"]

    def field():
        if rnd.random() < 0.3:
            return rnd.choice(["", "plain", " spaced ", "7"])
        return '"' + "".join(rnd.choice(pieces) for _ in range(rnd.choice([0, 2, 8, 60]))) + '"'

    lines = ["id,text,more"]
    for i in range(120):
        lines.append(rnd.choice(["", f"{i}", f"{i},{field()}", *[f"{i},{field()},{field()}"] * 9, f"{i},{field()},{field()},{field()}"]))
    return newline.join(lines) + (newline if seed % 2 else "")


@pytest.mark.parametrize("seed", range(6))
def test_equals_whole_file_reader(spark, folder, small_splits, seed):
    newline = "\r\n" if seed == 5 else "\n"
    for i in range(2):
        with open(f"{folder}/{i}.csv", "w", encoding="utf-8", newline="") as file:
            file.write(random_csv(10 * seed + i, newline))
    split = split_csv.read_split_csv(spark, folder, SCHEMA)
    assert split_csv._lines(spark, folder).rdd.getNumPartitions() > 20
    as_read = split.select(*(F.replace(c, F.lit("\r\n"), F.lit("\n")).alias(c) for c in split.columns))  # as the other reader does
    assert rows_of(as_read) == rows_of(files.read_csv(spark, folder, SCHEMA))


def test_record_longer_than_splits_and_header_over_a_border(spark, folder, small_splits):
    long = "\n".join(['line, with ""quotes"" '] * 300)
    with open(f"{folder}/a.csv", "w", encoding="utf-8") as file:
        file.write('id,"te\n' + "x" * 700 + '\nxt",more\n1,"' + long + '",b\n2,"",\n\n3,c\n4,"' + long + '",d')
    found = rows_of(split_csv.read_split_csv(spark, folder, SCHEMA))
    assert found == rows_of(files.read_csv(spark, folder, SCHEMA)) and [r.id for r in found] == ["1", "2", "3", "4"]
    assert len(rows_of(split_csv.read_split_csv(spark, folder, SCHEMA, header=False))) == 5


def test_written_csv_comes_back(spark, folder, small_splits):
    rnd = random.Random(3)
    rows = [(str(i), None if i % 5 == 0 else "".join(rnd.choice('ab ",\n\r\\') for _ in range(i)), "") for i in range(60)]
    sinks.write_csv(spark.createDataFrame(rows, SCHEMA).coalesce(1), f"{folder}/out")
    assert rows_of(split_csv.read_split_csv(spark, f"{folder}/out", SCHEMA)) == rows_of(spark.createDataFrame(rows, SCHEMA))


def test_open_quote_empty_files_and_bad_bytes(spark, folder, small_splits):
    open(f"{folder}/empty.csv", "w").close()
    assert rows_of(split_csv.read_split_csv(spark, folder, SCHEMA)) == []
    with open(f"{folder}/bytes.csv", "wb") as file:
        file.write(b'id,text,more\n1,"a\xffb\nc",d\n')
    assert [r.text for r in rows_of(split_csv.read_split_csv(spark, folder, SCHEMA))] == ["a�b\nc"]
    with open(f"{folder}/open.csv", "w") as file:
        file.write('id,text,more\n1,"a\n' + "x\n" * 500)
    with pytest.raises(split_csv.OpenQuote, match="open.csv"):
        split_csv.read_split_csv(spark, folder, SCHEMA)


def test_plan_has_no_whole_file_rows(spark, folder, small_splits):
    with open(f"{folder}/a.csv", "w", encoding="utf-8") as file:
        file.write(random_csv(1))
    read = split_csv.read_split_csv(spark, folder, SCHEMA).withColumn("id", whole_number(F.col("id")))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" in plan and "FileScan csv" not in plan and plan.count("Exchange") <= 1


def test_refusal_reads_no_further_and_writes_nothing(spark, folder):
    """Files that cannot even be opened as what they say they are lie behind the bad rows."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])
    with open(f"{folder}/a.csv", "w", encoding="utf-8") as file:
        file.write("id,text\n" + 'x,"a\nb"\n' * 100_000)  # the largest file comes first
    for i in range(20):
        with open(f"{folder}/b{i}.csv.gz", "wb") as file:
            file.write(b"no gzip")

    def reader(spark, path, strings):
        return files.read_csv(spark, path, strings)

    with pytest.raises(files.BadRecordBudgetExceeded):
        files.load_csv(spark, folder, schema, f"{folder}/out", reader=reader, refuse_early=True)
    with pytest.raises(Exception, match="(?i)gzip|incorrect header|task"):
        files.load_csv(spark, folder, schema, f"{folder}/out2")
