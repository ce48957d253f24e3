from __future__ import annotations

import datetime
import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from sluice.functions import cleaning
from sluice.functions.regions import REGIONS, state_to_region
from sluice.operators import listings, scored


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    return [r["v"] for r in df.select("i", expression(F.col("c")).alias("v")).orderBy("i").collect()]


def test_numbers(spark):
    assert values(spark, [" 12 ", "", None, "1.5", "x", "-3"], cleaning.whole_number) == [12, None, None, None, None, -3]
    assert values(spark, ["1e-5", "", "40.5", "x"], cleaning.real_number) == [1e-5, None, 40.5, None]
    assert values(spark, ["609,513", "82712", "NaN", "", "1,2x"], cleaning.grouped_number) == [609513, 82712, None, None, None]
    assert values(spark, ["1e-7", "0.5", "0", "-3.250"], lambda c: cleaning.positional(c.cast("double"))) == ["0.0000001", "0.5", "0.0", "-3.25"]


def test_percent(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (None, 2)], "a bigint, b bigint")
    assert [r[0] for r in df.select(cleaning.percent(F.col("a"), F.col("b"))).collect()] == [33.33, None, None]


def test_dates(spark):
    day = datetime.date(2019, 7, 4)
    got = values(spark, ["7/4/2019", "07/04/2019", "", "13/4/2019", "2019-07-04", "2/30/2019"], cleaning.month_day_year)
    assert got == [day, day, None, None, None, None]


def test_newlines(spark):
    assert values(spark, ["a\r\nb\nc\rd/ne"], cleaning.one_line) == ["a b c d/ne"]
    assert values(spark, ["a\nb/nc"], lambda c: cleaning.one_line(c, literal_slash_n=True)) == ["a\nb c"]


TEXTS = ['"a b" \n" ', 'abc"\n', '""x', '"', "", 'a"b', ' "x" ', 'é  \n "" ']


def test_quotes_like_string_methods(spark):
    expected = [t.strip('"').rstrip().rstrip('"').rstrip() for t in TEXTS]
    assert values(spark, TEXTS, cleaning.strip_quotes) == expected


def test_ascii_like_string_methods(spark):
    texts = ["a\n\nb", "a\nb", "é  è", "x\t \x0by", "a\x1c\x1db", "  a"]
    expected = [re.sub(r"\s{2,}", " ", t.encode("ascii", "ignore").decode()) for t in texts]
    assert values(spark, texts, cleaning.ascii_only) == expected


def test_lists(spark):
    assert values(spark, ["['0.1', '-0.2']", "['x']", None], cleaning.number_list) == [[0.1, -0.2], [None], None]
    assert values(spark, ["['good', 'bäd']", "[]"], cleaning.word_list) == [["good", "bäd"], []]
    assert values(spark, ["[]"], lambda c: cleaning.word_list(c, keep_empty=True)) == [[""]]


def test_header_and_values(spark):
    assert values(spark, ['[["a","b"],["1","2"]]'], cleaning.header_value_record) == [{"a": "1", "b": "2"}]


def test_regions(spark):
    df = spark.createDataFrame([("TX",), ("NY",), ("ZZ",), (None,), ("CA",), ("OH",)], "state string")
    got = [r[0] for r in state_to_region(df).collect()]
    assert got == ["South", "Northeast", "other", "other", "West", "Midwest"]
    assert sum(len(s) for s in REGIONS.values()) == 51


GOOD = "12,Flat,345678,Bob,Staten Island,Kens ing,40.5,-73.9,Entire,10,2,3,7/4/2019,0.5,1,365"
LINES = [
    GOOD,
    GOOD.replace("Flat", '"A ""nice"", big\none"').replace("Entire", "Entire home, apt"),
    GOOD.replace("7/4/2019,0.5", ","),
    "junk " + GOOD + "9 more",
    GOOD.replace("Flat", "\x1f\x1e\x1f"),
    GOOD.replace(",3,", ",x,"),
    GOOD.replace("Staten", "staten"),
    "cut,1,2",
    "",
    GOOD.replace("7/4", "13/4"),
    GOOD.replace("Flat", "1,2,3456,Q,R"),
]


def test_lines_read_like_the_pattern(spark):
    """Whatever the shortcut, the groups are those of the first match of the full pattern."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(LINES)], "i int, value string")
    parsed = {r["i"]: r for r in listings.parse_lines(df).collect()}
    for i, line in enumerate(LINES):
        match = re.search(f"(?s){listings.LINE_PATTERN}", line)
        if match is None:
            assert parsed[i]["id"] is None and parsed[i]["name"] is None and not parsed[i]["_parse_ok"]
        else:
            groups = match.groups()
            assert parsed[i]["id"] == int(groups[0]), line
            assert parsed[i]["name"] == re.sub("\r\n|\r|\n", " ", groups[1])
            assert parsed[i]["host_name"] == groups[3]
            assert parsed[i]["neighbourhood"] == groups[5]
            assert parsed[i]["room_type"] == groups[8]
            assert parsed[i]["availability_365"] == int(groups[15])
    assert parsed[9]["_parse_ok"] is False and parsed[9]["id"] == 12
    good = listings.good_rows(listings.parse_lines(df))
    letters = listings.dead_letters(listings.parse_lines(df))
    assert good.count() + letters.count() == len(LINES)
    assert {r["_line"] for r in letters.collect()} >= {"", "cut,1,2"}
    kept = listings.good_rows(listings.parse_lines(df), keep_nulls=True)
    assert kept.count() == len(LINES) and kept.filter("id is null and neighbourhood is null").count() == letters.count()


SCORED = "0,0.0,0.5,0.5,0.7,0.1,-0.2,\"['good', 'bad']\",\"['0.1', '-0.2']\",123,\"hello, x\""
SCORED_LINES = [
    SCORED,
    SCORED.replace("\"['good', 'bad']\"", "[]"),
    SCORED.replace("hello", "see [1], it is .5, or [x].,9,"),
    SCORED.replace("0.7", "7e-05"),
    "x " + SCORED,
    SCORED.replace("123", "12a"),
    SCORED.replace("0.0,", "0.0,0.9,0.8,"),
    SCORED.replace(", x", "\nand 1.5, 2.5,"),
    "",
]


def test_scored_lines_read_like_the_pattern(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(SCORED_LINES)], "i int, value string")
    got = {r["i"]: tuple(r)[1:] for r in scored.scored_lines(df).collect()}
    for i, line in enumerate(SCORED_LINES):
        match = re.search(f"(?s){scored.SCORED_PATTERN}", line)
        assert got[i] == (match.groups() if match else (None,) * 10), line


def mixed_lines(good: str, pieces: list[str], seed: int, count: int) -> list[str]:
    """Lines near a good one: parts exchanged, repeated, left out, put in."""
    rnd, lines = random.Random(seed), []
    for _ in range(count):
        parts = good.split(",")
        for _ in range(rnd.randrange(5)):
            at = rnd.randrange(len(parts))
            action = rnd.randrange(3)
            if action == 0:
                parts[at] = rnd.choice(pieces)
            elif action == 1:
                parts.insert(at, rnd.choice(pieces))
            elif len(parts) > 1:
                del parts[at]
        lines.append(",".join(parts))
    return lines


def test_many_lines_read_like_the_patterns(spark):
    pieces = ["", "1", "12", "1234", "x", "Queens", "Ab", "A1", "40.5", "-73.9", "x12", "9y", "a\nb", "Bx", "0.5", "[", "]", "q[a]", "'[b]'", "[c]z", "7e-05", ".5", "[]", "x[", "]y"]
    lines = mixed_lines(GOOD, pieces, 3, 1500)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, value string")
    raw = df.select("i", listings.line_fields(F.col("value")).alias("f"), listings._line_groups(F.split("value", ",")).alias("g"))
    matched = 0
    for r in raw.collect():
        match = re.search(f"(?s){listings.LINE_PATTERN}", lines[r["i"]], re.ASCII)
        assert r["f"] == r["g"] == (list(match.groups()) if match else None), lines[r["i"]]
        matched += match is not None
    assert 100 < matched < 1400
    lines = mixed_lines(SCORED, pieces, 4, 1500)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, value string")
    matched = 0
    for r in scored.scored_lines(df).collect():
        match = re.search(f"(?s){scored.SCORED_PATTERN}", lines[r["i"]], re.ASCII)
        assert tuple(r)[1:] == (match.groups() if match else (None,) * 10), lines[r["i"]]
        matched += match is not None
    assert 100 < matched < 1400


def test_odd_lines_take_linear_time(spark):
    bad = [("a,1234," * 5000,), ("0.5," * 10_000 + "[x],",), ("1,0.5," * 5000 + "[a],'[b],[c]x",), ("1," * 10_000,)]
    bad += [(GOOD.replace("Flat", "a,1234,Q,R" * 2500).replace("40.5", "x"),)]
    df = spark.createDataFrame(bad, "value string").coalesce(1)
    began = time.perf_counter()
    assert not any(r["_parse_ok"] for r in listings.parse_lines(df).collect())
    assert all(r["neg"] is None for r in scored.scored_lines(df).collect())
    assert time.perf_counter() - began < 20


def test_scored_types(spark):
    df = spark.createDataFrame([(SCORED,), (SCORED_LINES[1],), ("",)], "value string")
    one, two, three = scored.type_scored(scored.scored_lines(df)).collect()
    assert one["compound"] == 0.7 and one["word_sample"] == ["good", "bad"] and one["tok2vec"] == [0.1, -0.2]
    assert one["tweet_id"] == 123 and one["tweet"] == "hello, x"
    assert two["word_sample"] == [] and three["tweet_id"] is None and three["tok2vec"] is None


@pytest.mark.parametrize(
    "score, label",
    [(-0.5, "neutral"), (-0.51, "neg"), (0.6, "neutral"), (0.61, "pos"), (0.0, "neutral"), (None, "neutral")],
)
def test_routing_bounds(spark, score, label):
    df = spark.createDataFrame([(score,)], "compound double")
    assert df.select(scored.label_of_score(F.col("compound"))).first()[0] == label
    assert scored.route(df).count() == (label != "neutral")


def test_one_match_per_line(spark):
    """The pattern stands once in the plan, not once per column and filter."""
    df = spark.createDataFrame([(GOOD,)], "value string")
    parsed = listings.good_rows(listings.parse_lines(df), keep_nulls=True)
    plan = parsed._sc._jvm.PythonSQLUtils.explainString(parsed._jdf.queryExecution(), "simple")
    assert plan.count("regexp_extract(") <= 16


def test_positional_keeps_every_finite_double(spark):
    values = [0.0, -0.0, 1e25, 1e-20, -1.5e-7, 123456789.125, 1.7976931348623157e308, 5e-324, 0.1, 1e7, 12345678.9, -3.25, 1e21, 1.0]
    values += [random.Random(1).uniform(-1, 1) * 10.0**e for e in range(-300, 300, 7)]
    df = spark.createDataFrame([(v,) for v in [*values, math.nan, math.inf, -math.inf, None]], "v double")
    got = [r[0] for r in df.select(cleaning.positional(F.col("v"))).collect()]
    assert [float(t) for t in got[: len(values)]] == values
    assert not any("e" in t.lower() for t in got[: len(values)]) and got[len(values) :] == [None] * 4


def test_replies_with_odd_headers(spark):
    cases = {
        '[["a","b"],["1","2"]]': {"a": "1", "b": "2"},
        '[["a","b","a"],["1","2","3"]]': {"b": "2", "a": "3"},
        '[["a","b"]]': {"a": None, "b": None},
        '[["a","b"],["1"]]': {"a": "1", "b": None},
        '[["a"],["1","2"]]': {"a": "1"},
        '[["a",null],["1","2"]]': {"a": "1"},
        "[]": None,
        "no json": None,
        '{"a": 1}': None,
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert [r[0] for r in df.select(cleaning.header_value_record(F.col("t"))).collect()] == list(cases.values())
