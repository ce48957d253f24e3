from __future__ import annotations

import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from sluice.functions.hashing import HashKey
from sluice.operators import sensitive
from sluice.plans import jobs
from sluice.streaming import streams


def ssn(i):
    return f"{100 + i:03d}-{10 + i % 80:02d}-{1000 + i:04d}"


# Made-up lines in four kinds: 17 without a number, 14 with a decoy only, 9 with a
# dashed number only, 10 with a decoy and a bare number. 43 candidates, 19 known.
MESSAGES = (
    [f"Nothing to see here, number {i}" for i in range(17)]
    + [f"My account number is {900000000 + i}" for i in range(14)]
    + [f"My social is {ssn(i)}" for i in range(9)]
    + [f"My account number is {910000000 + i} and my ssn is {ssn(50 + i).replace('-', '')}" for i in range(10)]
)
KNOWN = [ssn(i) for i in range(100)]
EXPECTED_KINDS = (50, 43, 19)


def digest(key, salt, number):
    return hmac.new(key, (salt + number.replace("-", "")).encode(), "sha256").hexdigest()


@pytest.fixture
def known(spark):
    key = HashKey(spark, b"k" * 64, "pepper")
    numbers = spark.createDataFrame([(n,) for n in KNOWN + KNOWN[:7] + ["12", None]], "ssn string")
    return key, sensitive.known_hashes(numbers, "ssn", key)


@pytest.mark.parametrize("size", [0, 16, 64, 65, 100])
def test_hmac_is_the_standard_one(spark, size):
    secret = bytes(range(size))
    key = HashKey(spark, secret, "sält")
    got = spark.createDataFrame([("123456789",), ("ä",)], "m string").select(key.hmac(F.col("m"))).collect()
    assert [r[0] for r in got] == [hmac.new(secret, ("sält" + m).encode(), hashlib.sha256).hexdigest() for m in ("123456789", "ä")]


def test_key_and_salt_are_in_no_plan(spark):
    secret = b"do not print me, I am a key"
    key = HashKey(spark, secret, "salty")
    df = spark.createDataFrame([("123456789",)], "m string").select(key.hmac(F.col("m")).alias("h"))
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "extended")
    padded = secret.ljust(64, b"\0")
    for shown in (secret, bytes(b ^ 0x36 for b in padded), bytes(b ^ 0x5C for b in padded), b"salty"):
        assert shown.hex() not in plan.lower() and shown.decode("latin-1") not in plan


def test_known_set_is_distinct(spark, known):
    key, hashes = known
    assert hashes.columns == ["hash"]
    assert sorted(r[0] for r in hashes.collect()) == sorted(digest(b"k" * 64, "pepper", n) for n in KNOWN)


def test_golden_counts(spark, known):
    key, hashes = known
    texts = spark.createDataFrame([(m,) for m in MESSAGES], "text string")
    found = sensitive.scan(texts, "text")
    confirmed = sensitive.confirm(found, "quote", key, hashes)
    assert (texts.count(), found.count(), confirmed.count()) == EXPECTED_KINDS
    assert "quote" not in confirmed.columns


def test_duplicates_pass_and_a_broadcast_does_not_matter(spark, known):
    key, hashes = known
    numbers = spark.createDataFrame([(KNOWN[0],), (KNOWN[0],), ("999-99-9999",)], "n string")
    assert sensitive.confirm(numbers, "n", key, hashes).count() == 2
    assert sensitive.confirm(numbers, "n", key, hashes, broadcast=True).count() == 2


TRAPS = [" 123-45-6789\n", "123456789", "1234567890", "12345678", "12a456789", "", None, "\u00a0123456789"]


def test_normalise(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TRAPS)], "i int, n string")
    got = [r[0] for r in df.orderBy("i").select(sensitive.normalised(F.col("n"))).collect()]
    assert got == ["123456789", "123456789", None, None, None, None, None, "123456789"]
    rejected = sensitive.rejected(df, "n")
    assert rejected.columns == ["i"] and sorted(r[0] for r in rejected.collect()) == [2, 3, 4, 5, 6]


def test_scan_boundaries_and_likelihood(spark):
    text = "123-45-6789, 987654321; 1234567890 x123456789 f00123456789ab é123456789 12-345-6789 (111-22-3333)"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "i int, t string")
    got = [(r["likelihood"], r["quote"]) for r in sensitive.scan(df, "t").collect()]
    assert got == [("LIKELY", "123-45-6789"), ("POSSIBLE", "987654321"), ("POSSIBLE", "123456789"), ("LIKELY", "111-22-3333")]
    assert [r["quote"] for r in sensitive.scan(df, "t", min_likelihood="LIKELY").collect()] == ["123-45-6789", "111-22-3333"]
    assert sensitive.scan(df, "t", min_likelihood="VERY_LIKELY").count() == 0
    assert sensitive.scan(df, "t", max_findings=1).count() == 1
    assert sensitive.scan(df, "t", include_quote=False).columns == ["i", "info_type", "likelihood"]


def test_stream_equals_batch(spark, known, folder):
    key, hashes = known
    hashes.write.parquet(f"{folder}/known")
    static = spark.read.parquet(f"{folder}/known")
    found = sensitive.scan(spark.createDataFrame([(m,) for m in MESSAGES], "text string"), "text")
    batch = sensitive.confirm(found, "quote", key, static)
    found.select(F.encode("quote", "UTF-8").alias("value")).write.parquet(f"{folder}/in")
    messages = streams.file_stream(spark, f"{folder}/in", "value binary", max_files_per_trigger=2)
    streams.drain(streams.confirmed_messages(messages, key, static), f"{folder}/out", f"{folder}/checkpoint")
    out = spark.read.parquet(f"{folder}/out")
    assert out.schema.simpleString() == "struct<value:binary>"
    assert sorted(bytes(r[0]).decode() for r in out.collect()) == sorted(r["hash"] for r in batch.collect())


def test_arriving_files_once_with_their_source(spark, known, folder):
    key, hashes = known
    args = (spark, f"{folder}/in", key, hashes, f"{folder}/out", f"{folder}/checkpoint")
    for part in (MESSAGES[:40], MESSAGES[40:]):
        spark.createDataFrame([(m,) for m in part], "value string").coalesce(1).write.mode("append").text(f"{folder}/in")
        confirmed = jobs.confirm_arriving_files(*args)
    assert confirmed.count() == EXPECTED_KINDS[2]
    assert confirmed.select("source_file").distinct().count() == 2
