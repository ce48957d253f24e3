"""JSON objects read by splits against the whole-file reader and Python's parser."""

from __future__ import annotations

import json
import random

import pytest

from sluice.sources import lookups, split_json

VALUE = "struct<a:string,b:array<string>,c:struct<d:int>>"


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


def random_object(seed: int) -> dict:
    rnd = random.Random(seed)
    bits = ["a", "é🙂", ",", "{", "}", "[", "]", '"', "\\", "\n", ":", "x" * 50, ", "]

    def text(most):
        return "".join(rnd.choice(bits) for _ in range(rnd.randrange(most)))

    return {
        f"{i}{text(4)}": {"a": text(rnd.choice([2, 10, 150])), "b": [text(5) for _ in range(rnd.randrange(4))], "c": rnd.choice([None, {"d": i}])}
        for i in range(150)
    }


def written(folder, name, value, **layout):
    with open(f"{folder}/{name}", "w", encoding="utf-8") as file:
        file.write(value if isinstance(value, str) else json.dumps(value, **layout))


def rows_of(df):
    return sorted(df.collect(), key=str)


@pytest.mark.parametrize("layout", [{}, {"indent": 2}, {"ensure_ascii": False, "separators": (",", ":")}], ids=str)
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_whole_file_reader(spark, folder, small_splits, layout, seed):
    written(folder, "a.json", random_object(seed), **layout)
    assert split_json._pieces(spark, folder).rdd.getNumPartitions() > 20
    want = rows_of(lookups.read_lookup(spark, folder, VALUE))
    assert rows_of(split_json.read_split_lookup(spark, folder, VALUE)) == want and len(want) == 150


@pytest.mark.parametrize("seed", [3, 4])
def test_entries_in_order(spark, folder, small_splits, seed):
    entries = random_object(seed)
    written(folder, "object.json", entries, indent=1)
    written(folder, "array.json", [*entries.values(), "text, [", 7, None, [1, 2]])
    found = split_json.read_entries(spark, folder).orderBy("file", "block", "place").collect()
    named = [r.entry for r in found if r.file.endswith("object.json")]
    assert [next(iter(json.loads("{" + e + "}").items())) for e in named] == list(entries.items())
    assert [json.loads(r.entry) for r in found if r.file.endswith("array.json")] == [*entries.values(), "text, [", 7, None, [1, 2]]


def test_later_entries_replace_and_one_entry_fills_many_splits(spark, folder, small_splits):
    filler = ",".join(f'"k{i}": {{"a": "{i}"}}' for i in range(60))
    long = "[{,".replace("[", "\\u005b") * 900
    written(folder, "a.json", '{"twice": {"a": "first"},' + filler + ', "long": {"a": "' + long + '"},"twice": {"a": "last"}, "end": {"b": ["' + long + '"]}}\n')
    got = {r.key: (r.a, r.b) for r in split_json.read_split_lookup(spark, folder, VALUE).collect()}
    assert got["twice"] == ("last", None) and got["k59"] == ("59", None) and len(got) == 63
    assert got["long"][0] == "[{," * 900 and got["end"][1] == ["[{," * 900]


@pytest.mark.parametrize("text", ["", " \n", "{}", "[]", " { } \n"])
def test_nothing_in_it(spark, folder, text):
    written(folder, "a.json", text)
    assert split_json.read_split_lookup(spark, folder, VALUE).collect() == []


@pytest.mark.parametrize("text", ['{"a": {"a": "1"}', '{"a": {"a": "1}}', '{"a": {}}\n{"b": {}}', '{"a": {"a": "1"}, "b": {}} [1, 2]'])
def test_files_that_are_not_one_value(spark, folder, text):
    written(folder, "a.json", text)
    with pytest.raises(split_json.NotOneValue, match="a.json"):
        split_json.read_split_lookup(spark, folder, VALUE)


def test_unreadable_entries_are_left_out_alone(spark, folder):
    written(folder, "a.json", '{"a": {"a": "1"}, b, "c": {"a": "3"}}')
    assert [r.key for r in rows_of(split_json.read_split_lookup(spark, folder, VALUE))] == ["a", "c"]
    assert "b" in [r.entry for r in split_json.read_entries(spark, folder).collect()]
