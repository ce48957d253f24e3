from __future__ import annotations

import datetime
import math

import pytest
from pyspark.sql import functions as F

from sluice.operators import scoring
from sluice.operators.layout import spread
from sluice.plans import jobs
from sluice.streaming import streams

LEXICON = [("good", 1.9, 0.7, 0.6), ("bad", -2.5, -0.7, 0.66), ("fine", 0.8, 0.4, 0.5)]
TEXTS = [(1, "A good day, a GOOD year, one bad hour!"), (2, "nothing here"), (3, ""), (4, None), (5, "fine\nfine fine")]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def inputs(spark):
    return (
        spark.createDataFrame(TEXTS, "id int, text string"),
        spark.createDataFrame(LEXICON, "token string, valence double, polarity double, subjectivity double"),
    )


def test_sentiment(inputs):
    got = {r["id"]: r for r in scoring.lexicon_sentiment(*inputs, "id", "text").collect()}
    p, n, u, s = 2.9 * 2, 3.5, 6, 1.9 * 2 - 2.5
    total = p + n + u
    assert got[1]["pos"] == round(p / total, 3) and got[1]["neg"] == round(n / total, 3)
    assert got[1]["neu"] == round(u / total, 3) and got[1]["compound"] == round(s / math.sqrt(s * s + 15), 4)
    assert tuple(got[2])[1:] == (0.0, 1.0, 0.0, 0.0)
    assert tuple(got[3])[1:] == tuple(got[4])[1:] == (0.0, 0.0, 0.0, 0.0)


def test_polarity_and_sample(inputs):
    got = {r["id"]: r for r in scoring.lexicon_polarity(*inputs, "id", "text").collect()}
    assert got[1]["polarity"] == pytest.approx(0.7 / 3) and got[1]["subjectivity"] == pytest.approx(1.86 / 3)
    assert got[2]["polarity"] == 0.0 and len(got) == 5
    assert rows(scoring.word_sample(*inputs, "id", "text")) == [(1, ["good", "good", "bad"]), (5, ["fine"] * 3)]


def test_all_scores_are_the_separate_ones(inputs):
    together = scoring.all_scores(*inputs, "id", "text")
    sentiment = scoring.lexicon_sentiment(*inputs, "id", "text").join(scoring.lexicon_polarity(*inputs, "id", "text"), "id")
    assert rows(together.drop("word_sample")) == rows(sentiment)
    assert {r["id"]: r["word_sample"] for r in together.collect()}[2] == []


def test_mean_vector(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [3.0, 6.0]), ("b", [5.0, 5.0])], "id string, v array<float>")
    assert rows(scoring.mean_vector(df, "id", "v")) == [("a", [2.0, 4.0]), ("b", [5.0, 5.0])]


def test_feed_appends_both_labels(spark, inputs, folder):
    texts = inputs[0].filter("text is not null").selectExpr("cast(id as bigint) as tweet_id", "text as tweet")
    texts = texts.unionAll(spark.createDataFrame([(6, '"bad, bad" é news')], "tweet_id bigint, tweet string"))
    for times in (1, 2, 2):  # the last run finds nothing new
        if times == 1 or out.filter("label = 'neg'").count() == 1:
            jobs.hand_off_scores(texts, inputs[1], f"{folder}/csv")
        out = jobs.route_scores(spark, f"{folder}/csv", f"{folder}/out", f"{folder}/checkpoint")
        assert out.filter("label = 'neg'").count() == times and out.filter("label = 'neutral'").count() == 0
    row = out.filter("label = 'neg'").first()
    assert row["tweet"] == 'bad, bad" news' and row["word_sample"] == ["bad", "bad"]


def test_spread_leaves_large_inputs_alone(spark):
    few = spark.range(100).coalesce(1)
    assert spread(few, 4, below=10) is few
    assert spread(few, 5).rdd.getNumPartitions() == 5
    assert rows(spread(few, 5)) == rows(few)


def test_scores_are_per_row_whatever_the_id(spark, inputs):
    texts = spark.createDataFrame([(1, "good"), (1, "bad bad"), (1, "good"), (None, "good"), (2, None)], "tweet_id bigint, tweet string")
    got = sorted(((r["tweet_id"], r["tweet"], r["compound"]) for r in jobs.score_texts(texts, inputs[1]).collect()), key=repr)
    good, bad = round(1.9 / math.sqrt(1.9**2 + 15), 4), round(-5 / math.sqrt(25 + 15), 4)
    assert got == sorted([(1, "good", good)] * 2 + [(1, "bad bad", bad), (None, "good", good), (2, None, 0.0)], key=repr)


def test_vector_of_a_text(spark):
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 3.0])], "token string, vector array<double>")
    texts = spark.createDataFrame([(1, "a a b zzz"), (2, "zzz"), (3, None)], "id int, text string")
    assert rows(scoring.document_vector(texts, vectors, "id", "text")) == [(1, [2 / 3, 1.0]), (2, None), (3, None)]


def test_vectors_are_summed_with_the_scores(spark, inputs):
    vectors = spark.createDataFrame(
        [("good", [1.0, 0.0]), ("good", [0.5, 9.0]), ("day", [0.0, 3.0]), ("bad", None)], "token string, vector array<float>"
    )
    pairs = [(1, "good day, Good"), (1, "good day, Good"), (None, "bad"), (2, None), (3, ""), (4, "day " * 50_000)]
    texts = spark.createDataFrame(pairs, "tweet_id bigint, tweet string")
    for width in (2, None):
        got = jobs.score_texts(texts, inputs[1], vectors, width).collect()
        assert sorted(((r["tweet_id"], r["tok2vec"]) for r in got), key=repr) == sorted(
            [(1, [2 / 3, 1.0])] * 2 + [(None, None), (2, None), (3, None), (4, [0.0, 3.0])], key=repr
        )
    plain = jobs.score_texts(texts, inputs[1]).drop("tok2vec")
    assert rows(plain) == rows(jobs.score_texts(texts, inputs[1], vectors).select(*plain.columns))
    none = vectors.limit(0)
    assert {r["vector"] for r in scoring.document_vector(texts.distinct(), none, "tweet_id", "tweet").collect()} == {None}
    assert scoring.document_vector(texts.limit(0), vectors, "tweet_id", "tweet").collect() == []


def test_texts_are_scored_where_they_stand(spark, inputs):
    vectors = spark.createDataFrame([("good", [1.0, 0.0]), ("day", [0.0, 3.0])], "token string, vector array<float>")
    texts = spark.range(0, 600, 1, 3).select(F.col("id").alias("tweet_id"), F.lit("a good day, so bad").alias("tweet"))
    for scored in (jobs.score_texts(texts, inputs[1]), jobs.score_texts(texts, inputs[1], vectors, 2)):
        placed = scored.select("tweet_id", F.spark_partition_id().alias("part"), "word_sample").collect()
        assert {(r["tweet_id"], r["part"]) for r in placed} == {(i, i // 200) for i in range(600)} and len(placed) == 600
        assert {tuple(r["word_sample"]) for r in placed} == {("good", "bad")}


REPEATED = [(1, "good day"), (1, "so odd, so good"), (1, "good day"), (None, "a day"), (None, None), (2, "s p null")]
ENTRIES = [("good", -1.0, None, 0.75), ("so", 0.0, None, None), ("odd", None, 0.5, None), (None, 9.0, 9.0, 9.0)]


def test_repeated_words_count_by_their_entries(spark):
    lexicon = spark.createDataFrame([("good", 2.0, 0.5, 0.25), *ENTRIES], "token string, valence double, polarity double, subjectivity double")
    vectors = spark.createDataFrame([("good", [1.0, None]), ("day", [4.0, None]), (None, [9.0, 9.0])], "token string, vector array<double>")
    texts = spark.createDataFrame(REPEATED, "id int, text string")
    scores = scoring.all_scores(texts, lexicon, "id", "text", vectors=vectors).collect()
    got = {r["id"]: (r["compound"], r["polarity"], r["subjectivity"], r["word_sample"], r["vector"]) for r in scores}
    words = ["good"] * 4 + ["so", "odd", "so", "good", "good"]
    assert got == {
        1: (round(3 / math.sqrt(9 + 15), 4), 0.5, 0.5, words, [14 / 8, None]),
        None: (0.0, 0.0, 0.0, [], [4.0, None]), 2: (0.0, 0.0, 0.0, [], None),
    }


def test_repeated_ids_and_names_of_sums(spark):
    lexicon = spark.createDataFrame(ENTRIES, "token string, valence double, polarity double, subjectivity double")
    texts = spark.createDataFrame(REPEATED, "id int, text string")
    together = {r["id"]: r.asDict() for r in scoring.all_scores(texts, lexicon, "id", "text").collect()}
    for separate in (scoring.lexicon_sentiment, scoring.lexicon_polarity):
        for r in separate(texts, lexicon, "id", "text").collect():
            assert r.asDict().items() <= together[r["id"]].items()
    named = texts.select(F.col("id").alias("s"), F.col("id").alias("size"), "text")
    alone = scoring.all_scores(texts.withColumn("_n", F.monotonically_increasing_id()), lexicon, "_n", "text", ["id", "text"])
    assert rows(scoring.row_scores(named, lexicon, "text").drop("size")) == rows(alone.drop("_n"))


def test_vectors_of_other_sizes_are_refused(spark):
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [3.0])], "token string, vector array<double>")
    texts = spark.createDataFrame([(1, "a b")], "id int, text string")
    with pytest.raises(Exception, match="not of 2 numbers: the vector of b"):
        scoring.document_vector(texts, vectors, "id", "text").collect()


def at(seconds):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=seconds)


def events(spark, pairs):
    return spark.createDataFrame([(i, at(s)) for i, s in pairs], "event_id bigint, ts timestamp_ntz")


def test_windows_closed_and_open(spark, folder):
    pairs = [(i, s) for i, s in enumerate([0, 1, 29, 30, 31, 95, 200, 201])]
    events(spark, pairs).write.parquet(f"{folder}/in")
    stream = streams.event_time(streams.file_stream(spark, f"{folder}/in", "event_id bigint, ts timestamp_ntz"))
    counts = streams.tumbling_counts(stream, late="10 seconds")
    streams.drain(counts, f"{folder}/closed", f"{folder}/checkpoint")
    closed = spark.read.schema(counts.schema).parquet(f"{folder}/closed")
    assert sorted(r["n"] for r in closed.collect()) == [1, 2, 3]
    both = streams.with_open_windows(closed, streams.event_time(spark.read.parquet(f"{folder}/in")))
    got = {r["window_start"].second + 60 * r["window_start"].minute: r["n"] for r in both.collect()}
    assert got == {0: 3, 30: 2, 90: 1, 180: 2}


def test_open_windows_without_any_closed(spark):
    none = spark.createDataFrame([], "window_start timestamp, window_end timestamp, n bigint")
    rows_ = streams.event_time(events(spark, [(1, 5), (2, 6)]))
    assert [r["n"] for r in streams.with_open_windows(none, rows_).collect()] == [2]


@pytest.mark.parametrize("salts", [1, 3])
def test_redelivery_is_dropped_across_batches(spark, folder, salts):
    schema = "event_id bigint, ts timestamp_ntz"
    for part in ([(1, 0), (2, 10), (1, 0)], [(2, 10), (3, 20)]):
        events(spark, part).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = streams.event_time(streams.file_stream(spark, f"{folder}/in", schema))
        streams.drain(streams.deduplicated(stream, ["event_id"], salts=salts), f"{folder}/out", f"{folder}/checkpoint")
    assert sorted(r["event_id"] for r in spark.read.parquet(f"{folder}/out").collect()) == [1, 2, 3]


def test_window_of_each_row(spark):
    df = streams.windowed(streams.event_time(events(spark, [(1, 29), (2, 30)])))
    assert [r["window"]["start"].second for r in df.orderBy("event_id").collect()] == [0, 30]


def test_new_files_once_with_their_name(spark, folder):
    schema = spark.createDataFrame([], "i string, t string").schema
    for name, text in (("a.csv", 'i,t\n1,"x, ""y""\nz"\n'), ("notes.txt", "no"), ("b.csv", "i,t\n2,z\n")):
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)
        streams.drain(streams.arrivals(spark, folder, schema), f"{folder}/out", f"{folder}/checkpoint")
    got = spark.read.parquet(f"{folder}/out")
    assert rows(got.select("i", "t")) == [("1", 'x, "y"\nz'), ("2", "z")]
    assert sorted(r[0].rsplit("/", 1)[1] for r in got.select("source_file").collect()) == ["a.csv", "b.csv"]
    assert spark.range(1).select(streams.object_name(F.lit("b/pulse 1.csv/17"))).first()[0] == "b/pulse 1.csv"
