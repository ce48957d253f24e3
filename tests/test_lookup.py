from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluice.operators import counts, enrichment, joins
from sluice.sources import lookups


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@pytest.fixture
def tally(spark):
    return spark.createDataFrame([("Harlem", 3), ("Nowhere", 1), (None, 2)], "neighbourhood string, n_listings bigint")


def test_counts_keep_null_as_a_key(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(counts.count_per_key(df, "k")) == rows(counts.sql_count_per_key(df, "k")) == sorted([("a", 2), (None, 1)], key=repr)


def test_lookup_keeps_all_left_rows(spark, tally):
    codes = spark.createDataFrame([("Harlem", "03803")], "neighbourhood string, puma_code string")
    out = enrichment.add_area_code(tally, codes)
    assert rows(out) == sorted([("Harlem", 3, "03803"), ("Nowhere", 1, None), (None, 2, None)], key=repr)
    with pytest.raises(PySparkException, match="no lookup entry for Nowhere"):
        enrichment.add_area_code(tally.filter("neighbourhood is not null"), codes, strict=True).collect()
    assert enrichment.add_area_code(tally.filter("n_listings = 3"), codes, strict=True).count() == 1


def jobs_of(spark, build):
    """Jobs that ``build`` starts."""
    group = f"group-{build.__name__}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        build()
        return list(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_building_a_lookup_starts_no_job(spark):
    left = spark.range(10).select(F.col("id").alias("k"))
    big = spark.range(1000).select(F.col("id").alias("k"), F.lit("x" * 50).alias("t"))

    def build():
        joins.lookup_join(left, big, "k")
        joins.lookup_or_default(left.select(F.col("k").cast("string")), big.select(F.col("k").cast("string"), "t"), "k", "1")
        joins.exists_in(left, big, "k")
        joins.missing_in(left, big, "k")

    assert jobs_of(spark, build) == []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    try:
        shuffled, hinted = joins.lookup_join(left, big, "k"), joins.lookup_join(left, big, "k", broadcast=True)
        assert "BroadcastHashJoin" in plan(hinted) and "SortMergeJoin" in plan(shuffled)
        assert rows(hinted) == rows(shuffled)
        assert rows(joins.exists_in(left, big, "k", broadcast=True)) == rows(joins.exists_in(left, big, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_repeated_keys_of_a_lookup_count_once(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    lookup = spark.createDataFrame([("a", 1, 9, None), ("a", 2, 5, "x"), ("a", 2, 5, "y"), ("c", 1, 1, "z")], "k string, o int, v int, t string")
    assert rows(joins.lookup_join(left, lookup, "k", order="v")) == sorted([("a", 1, 9, None)] * 2 + [("b", None, None, None)], key=repr)
    assert rows(joins.lookup_join(left, lookup, "k", order="o")) == sorted([("a", 2, 5, "y")] * 2 + [("b", None, None, None)], key=repr)
    assert rows(joins.lookup_join(left, lookup.select("k"), "k", found="f")) == sorted([("a", True)] * 2 + [("b", False)])


def test_a_name_twice_in_json_is_its_last_entry(spark):
    texts = spark.createDataFrame([(1, '{"a": {"v": 1}, "b": {"v": 2}, "a": {"v": 3}}'), (0, '{"b": {"v": 9}}')], "o int, t string")
    assert rows(lookups.explode_lookup(texts, "t", "struct<v:int>", order="o")) == [("a", 3), ("b", 2)]
    assert rows(lookups.explode_lookup(texts.filter("o = 1"), "t", "struct<v:int>")) == [("a", 3), ("b", 2)]


def test_semi_and_anti_split_the_left_side(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    known = spark.createDataFrame([("a",), ("a",)], "k string")
    assert rows(joins.exists_in(left, known, "k")) == [("a", 1), ("a", 2)]
    assert rows(joins.missing_in(left, known, "k")) == sorted([("b", 3), (None, 4)], key=repr)


def test_default_and_found(spark):
    asked = spark.createDataFrame([(1, "Harlem"), (2, None), (3, "x")], "i int, name string")
    lookup = spark.createDataFrame([("Harlem", 7), ("Bayside", 8)], "name string, v int")
    out = joins.lookup_or_default(asked, lookup, "name", default="Bayside").select("i", "name", "v", "found")
    assert rows(out) == [(1, "Harlem", 7, True), (2, "Bayside", 8, True), (3, "x", None, False)]


def test_two_hops(spark):
    tally = spark.createDataFrame([("A", 3), ("B", 1), ("C", 2)], "neighbourhood string, n_listings bigint")
    codes = spark.createDataFrame([("A", "01"), ("B", None), ("C", "02")], "neighbourhood string, puma_code string")
    replies = spark.createDataFrame(
        [("01", '[["NAME","P","H","T","B","R"],["Area","82712","609513","3","1","1089"]]'),
         ("02", '[["NAME","P","H","T","B","R"],["Void","0",null,"0","0","-"]]')],
        "puma_code string, reply string",
    )
    names = dict(population="P", median_home_value="H", adults="T", adults_bachdeg="B", median_rent="R")
    out = enrichment.enrich_two_hop(tally, codes, enrichment.area_statistics(replies, names))
    assert rows(out) == [
        ("A", 3, "01", 1089, 609513, 33.33, 82712, "Area"),
        ("B", 1, "", None, None, None, None, None),
        ("C", 2, "02", None, None, None, 0, "Void"),
    ]


def test_one_hop(spark):
    tally = spark.createDataFrame([("Harlem", 2658), ("X", 1)], "neighbourhood string, n_listings bigint")
    raw = spark.createDataFrame(
        [("Harlem", "MN1002", "1,089", "NaN", 35.1, 82712, "Harlem (North)")],
        "neighbourhood string, nta_code string, median_rent string, median_home_value string,"
        " percent_atleast_bachdeg double, population bigint, nta_name string",
    )
    out = enrichment.enrich_one_hop(tally, enrichment.demographics(raw))
    assert rows(out) == [
        ("Harlem", 2658, "MN1002", 1089, None, 35.1, 82712, "Harlem (North)"),
        ("X", 1, None, None, None, None, None, None),
    ]


def test_lookup_file(spark, folder):
    with open(f"{folder}/lookup.json", "w") as f:
        f.write('{"Breezy Point": {"latitude": 40.5,\n "puma_code": "04114"},\n "Harlem": {"latitude": 40.8, "puma_code": 12}}')
    out = lookups.read_lookup(spark, f"{folder}/lookup.json", "struct<latitude:double,puma_code:string>", "name")
    assert rows(out) == [("Breezy Point", 40.5, "04114"), ("Harlem", 40.8, "12")]


def test_first_record_wins(spark):
    texts = spark.createDataFrame([(2, '[{"a":{"v":9}}]'), (1, '[{"a":{"v":1}},{"b":{"v":2}},{"a":{"v":3}}]'), (3, "no json")], "o int, t string")
    assert rows(lookups.first_match(texts, "t", "struct<v:int>", "o")) == [("a", 1), ("b", 2)]


def test_map_keeps_the_last_pair(spark):
    pairs = spark.createDataFrame([("a", 1, 1), ("a", 5, 2), ("b", 7, 1)], "k string, v int, o int")
    assert lookups.to_map(pairs, "k", "v", "o").first()[0] == {"a": 5, "b": 7}
    with pytest.raises(ValueError, match="too many"):
        lookups.to_map(pairs, "k", "v", "o", max_entries=1)


def test_records_of_replies(spark):
    reply = '{"data":[{"id":"1","text":"a","x":2},{"id":"2"}],"meta":{"result_count":9}}'
    df = spark.createDataFrame([(7, reply), (8, '{"meta":{}}')], "r int, reply string")
    out = lookups.extract_records(df, "reply", {"id": "tweet_id", "text": "tweet"})
    assert rows(out) == [(7, "1", "a"), (7, "2", None)]
    assert lookups.extract_records(df, "reply", {"id": "tweet_id"}, max_results=1).count() == 1
    many = spark.createDataFrame([('{"data":[' + ",".join(f'{{"id":"{i}"}}' for i in range(150)) + "]}",)], "reply string")
    assert lookups.extract_records(many, "reply", {"id": "i"}).count() == 150


def test_hot_left_keys_are_split_beyond_the_bound(spark):
    """A key with a third of all rows does not end up in one task of a shuffle join."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k")
        left = spark.range(0, 60_000, 1, 6).select(key, F.sha2(F.col("id").cast("string"), 256).alias("t"))
        known = spark.range(0, 60_000, 7).select(F.col("id").alias("k"), F.lit("w").alias("w"))
        for join in (joins.exists_in, joins.missing_in, joins.lookup_join):
            out = join(left, known, "k")
            out.collect()
            assert "skew=true" in plan(out), join.__name__
            assert out.count() == join(left, known, "k", broadcast=True).count()
    finally:
        for name in small:
            spark.conf.unset(name)
