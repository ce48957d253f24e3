from __future__ import annotations

import os
import time

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators import listings, sensitive
from sluice.plans import jobs
from sluice.scratch import scratch_dir
from sluice.sinks import tables as sinks
from sluice.sources import files, tables
from sluice.streaming import streams

HEADER = ",".join(listings.LISTING.fieldNames())
ROW = '{id},"A ""nice"", big\none",345678,"Bob, B",Queens,Astoria,40.5,-73.9,Entire,10,2,3,7/4/2019,0.5,1,365'


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def write(path, text, encoding="utf-8"):
    with open(path, "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode(encoding))
    return str(path)


def test_dirty_csv(spark, tmp_path):
    bad_byte = ROW.format(id=2).encode().replace(b"nice", b"ni\xffce")
    long_row, short_row = ROW.format(id=3) + ",extra", "4,short"
    text = b"\n".join([HEADER.encode(), ROW.format(id=1).encode(), bad_byte, long_row.encode(), short_row.encode()])
    raw = files.read_csv(spark, write(tmp_path / "a.csv", text), listings.RAW_LISTING)
    by_id = {r["id"]: r for r in raw.collect()}
    assert sorted(by_id) == ["1", "2", "3", "4"]
    assert by_id["1"]["name"] == 'A "nice", big\none' and by_id["1"]["host_name"] == "Bob, B"
    assert by_id["2"]["name"] == 'A "ni\ufffdce", big\none'
    assert by_id["3"]["availability_365"] == "365" and by_id["4"]["host_id"] is None
    typed = listings.listing_clean(raw)
    assert {r["id"] for r in listings.good_rows(typed).collect()} == {1, 2, 3}
    assert [r["name"] for r in listings.dead_letters(typed).collect()] == ["short"]


def test_header_is_left_out_of_every_file(spark, tmp_path):
    for name in ("a.txt", "b.txt"):
        write(tmp_path / name, f"h1,h2\n{name}\n")
    assert rows(files.read_lines(spark, str(tmp_path), header="h1,h2")) == [("a.txt",), ("b.txt",)]


def test_objects_with_their_source(spark, tmp_path):
    write(tmp_path / "a.txt", "one\ntwo\n")
    assert files.read_objects(spark, str(tmp_path)).count() == 2
    whole = files.read_objects(spark, str(tmp_path), whole=True).first()
    assert whole["value"] == "one\ntwo\n" and whole["source_file"].endswith("a.txt")


SCHEMA = T.StructType().add("id", "long").add("price", "long").add("score", "double")


@pytest.mark.parametrize("bad, multi_line", [(10, True), (10, False), (11, True)])
def test_bad_record_budget(spark, tmp_path, bad, multi_line):
    lines = ["id,price,score"] + [f"{i},5,0.5" for i in range(20)] + [f"{i},n/a,0.5" for i in range(bad)]
    lines += ["90", "91,,", "92,7,0.1,extra"]
    path = write(tmp_path / "in.csv", "\n".join(lines))
    staging = str(tmp_path / "staging")
    if bad > 10:
        with pytest.raises(files.BadRecordBudgetExceeded, match="11 unreadable rows, 10 allowed"):
            files.load_csv(spark, path, SCHEMA, staging)
        return
    loaded = files.load_csv(spark, path, SCHEMA, staging, multi_line=multi_line)
    assert (loaded.good, loaded.bad) == (23, 10)
    assert loaded.table.schema == SCHEMA and loaded.table.count() == 23
    assert rows(loaded.table.filter("id >= 90")) == [(90, None, None), (91, None, None), (92, 7, 0.1)]


def test_publish_moves_a_table_to_the_new_folder(spark, folder):
    for version in (1, 2):
        spark.range(version).write.parquet(f"{folder}/v{version}")
        published = sinks.publish(spark, "published", f"{folder}/v{version}")
        assert published.count() == version
    spark.sql("DROP TABLE published")


def test_conform_and_overwrite(spark, folder):
    df = spark.createDataFrame([("1", "x")], "price string, more string")
    schema = T.StructType().add("id", "long").add("price", "long")
    sinks.overwrite(df, folder)
    assert rows(sinks.overwrite(df, folder, schema)) == [(None, 1)]
    assert spark.read.parquet(folder).columns == ["id", "price"]


def test_filled_targets_are_refused(spark, folder):
    sinks.write_if_empty(spark.range(1), f"{folder}/t")
    with pytest.raises(AnalysisException):
        sinks.write_if_empty(spark.range(1), f"{folder}/t")


def test_appends_with_new_columns(spark, folder):
    sinks.append(spark.createDataFrame([(1, "a")], "i int, a string"), folder)
    sinks.append(spark.createDataFrame([(2, "b")], "i int, b string"), folder)
    assert rows(sinks.read_appended(spark, folder).select("i", "a", "b")) == [(1, "a", None), (2, None, "b")]


def test_csv_keeps_spaces_quotes_and_arrays(spark, folder):
    df = spark.createDataFrame([(1, ' a "q", \\"\nb ', ["x", 'y"z'])], "i int, t string, w array<string>")
    sinks.write_csv(df, f"{folder}/csv")
    back = files.read_csv(spark, f"{folder}/csv", files.all_strings(df.schema))
    assert rows(back) == [("1", ' a "q", \\"\nb ', '["x","y\\"z"]')]


def test_namespace_twice(spark):
    sinks.create_namespace(spark, "area")
    sinks.create_namespace(spark, "area")
    assert spark.catalog.databaseExists("area")


def test_tables_by_name(spark):
    with pytest.raises(tables.TableNotFound, match="no table missing"):
        tables.validate_table(spark, "missing")
    spark.createDataFrame([("a", "F", 1, "x")], "name string, gender string, number bigint, other string").createOrReplaceTempView("names")
    projected = tables.validated_projection(tables.validate_table(spark, "names"), ["name", "number"])
    assert projected.columns == ["name", "number"]
    with pytest.raises(ValueError, match="not in the table: nope"):
        tables.validated_projection(projected, ["nope"])
    out = jobs.pivot_table(spark, "names", "pivoted", ["name"], ["gender"], ["number"])
    assert rows(out) == [("a", 1)] and out.columns == ["name", "F_number"]
    spark.sql("DROP TABLE pivoted")


def test_only_projected_columns_are_scanned(spark, folder):
    spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").write.parquet(f"{folder}/t")
    df = tables.validated_projection(spark.read.parquet(f"{folder}/t"), ["a", "c"]).filter("a > 0")
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    assert "ReadSchema: struct<a:int,c:int>" in plan and "GreaterThan(a,0)" in plan


def test_load_listings(spark, tmp_path):
    lines = [HEADER] + [ROW.format(id=i) for i in range(5)] + [ROW.format(id="x")]
    path = write(tmp_path / "l.csv", "\n".join(lines))
    table, counts, dead = jobs.load_listings(spark, path, str(tmp_path / "rows"), str(tmp_path / "counts"))
    assert dead.count() == 1 and '"id":"x"' in dead.first()["line"]
    assert table.schema == listings.LISTING and table.count() == 5
    assert rows(counts) == [("Astoria", 5)]
    flat = [HEADER] + [ROW.format(id=i).replace("\n", " ") for i in range(3)] + ["cut"]
    path = write(tmp_path / "l.txt", "\n".join(flat))
    args = (spark, path, HEADER, str(tmp_path / "rows2"), str(tmp_path / "counts2"))
    loaded = jobs.load_listing_lines(*args)
    assert rows(loaded.counts) == [("Astoria", 3)] and rows(loaded.dead_letters) == [("cut",)]
    assert rows(jobs.load_listing_lines(*args, keep_nulls=True)[1]) == sorted([("Astoria", 3), (None, 1)], key=repr)


def test_scratch_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one.startswith(base) and one != two


def test_a_failed_overwrite_leaves_the_old_table(spark, folder):
    good = spark.range(3).select(F.col("id").cast("string").alias("t"))
    sinks.overwrite(good, f"{folder}/t")
    bad = good.select(F.when(F.col("t") == "2", F.raise_error(F.lit("stop"))).otherwise(F.col("t")).alias("t"))
    with pytest.raises(PySparkException, match="stop"):
        sinks.overwrite(bad, f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 3
    assert [f for f in os.listdir(folder) if "new-" in f] == []


def test_old_files_are_streamed(spark, folder):
    schema = "value string"
    for name, age in (("new.txt", 0), ("old.txt", 30)):
        with open(f"{folder}/in-{name}", "w") as f:
            f.write(name)
        os.utime(f"{folder}/in-{name}", (time.time() - age * 86400,) * 2)
        streams.drain(streams.file_stream(spark, folder, schema, "text", glob="in-*"), f"{folder}/out", f"{folder}/c")
    assert spark.read.parquet(f"{folder}/out").count() == 2


def test_pieces_of_one_long_line(spark, folder):
    """A file without line ends is searched by many tasks; findings at the borders of splits are found once."""
    texts = [f"{'x' * (i % 37)} {i:03d}-12-{i:04d}\nnext 9{i:08d}" for i in range(900)]
    with open(f"{folder}/one.txt", "w") as file:
        file.write(" ".join(texts))
    sizes = {"spark.sql.files.maxPartitionBytes": "500", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in sizes}
    for k, v in sizes.items():
        spark.conf.set(k, v)
    pieces = files.read_pieces(spark, folder)
    assert pieces.rdd.getNumPartitions() > 20
    found = sorted(r.quote for r in sensitive.scan(pieces, "value").collect())
    for k, v in before.items():
        spark.conf.set(k, v)
    assert found == sorted([f"{i:03d}-12-{i:04d}" for i in range(900)] + [f"9{i:08d}" for i in range(900)])
