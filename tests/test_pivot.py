from __future__ import annotations

import decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from sluice.operators import pivot as pv

NAMES = "name string, gender string, state string, number bigint"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, data, schema=NAMES):
    return spark.createDataFrame(data, schema)


@pytest.fixture(params=[16, 0], ids=["narrow", "wide"])
def cells(request):
    return request.param


def test_null_cells_are_zero_and_missing_cells_null(spark, cells):
    df = frame(spark, [("a", "F", None, None), ("a", "M", None, 3), ("b", "M", None, 4)])
    out = pv.pivot(df, ["name"], ["gender"], ["number"], narrow_cells=cells)
    assert out.columns == ["name", "F_number", "M_number"]
    assert rows(out) == [("a", 0, 3), ("b", None, 4)]


def test_null_label_and_spaces(spark, cells):
    df = frame(spark, [("c", None, None, 5), ("c", "New York", None, 1), ("c", "New_York", None, 2)])
    out = pv.pivot(df, ["name"], ["gender"], ["number"], narrow_cells=cells)
    assert out.columns == ["name", "New_York_number", "None_number"]
    assert rows(out) == [("c", 3, 5)]


def test_two_pivot_fields_stand_side_by_side(spark, cells):
    df = frame(spark, [("a", "F", "TX", 1), ("a", "F", "F", 10), ("a", "TX", "F", 100)])
    out = pv.pivot(df, ["name"], ["gender", "state"], ["number"], narrow_cells=cells)
    assert out.columns == ["name", "F_number", "TX_number"]
    assert rows(out) == [("a", 111, 101)]


def test_keys_keep_their_type_and_value(spark, cells):
    df = frame(spark, [(1, "a__b", "x", 1), (None, "a__b", "x", 2), (None, None, "x", 4)], "k bigint, s string, p string, v bigint")
    out = pv.pivot(df, ["k", "s"], ["p"], ["v"], narrow_cells=cells)
    assert out.schema["k"].dataType == T.LongType()
    assert rows(out) == sorted([(1, "a__b", 1), (None, "a__b", 2), (None, None, 4)], key=repr)


def test_labels_of_other_types(spark, cells):
    df = frame(spark, [("a", True, 7, 1), ("a", False, 8, 2)], "k string, b boolean, n int, v bigint")
    out = pv.pivot(df, ["k"], ["b", "n"], ["v"], narrow_cells=cells)
    assert out.columns == ["k", "7_v", "8_v", "False_v", "True_v"]
    assert rows(out) == [("a", 1, 2, 2, 1)]


def test_booleans_are_counted_and_dates_refused(spark):
    df = frame(spark, [("a", "x", True), ("a", "x", True)], "k string, p string, v boolean")
    assert rows(pv.pivot(df, ["k"], ["p"], ["v"])) == [("a", 2)]
    with pytest.raises(pv.PivotError, match="cannot sum"):
        pv.pivot(df.selectExpr("k", "p", "date'2020-01-01' as v"), ["k"], ["p"], ["v"])


@pytest.mark.parametrize(
    "data, keys",
    [([("F_number", "x")], None), ([("a", "F"), ("a", "f")], None)],
)
def test_clashing_names_are_refused(spark, data, keys):
    df = frame(spark, [(k, p, 1) for k, p in data], "name string, p string, number bigint")
    if data[0][0] == "F_number":
        df = frame(spark, [("a", "F", 1)], "F_number string, p string, number bigint")
        keys = ["F_number"]
    with pytest.raises(pv.PivotError, match="would hold both"):
        pv.pivot(df, keys or ["name"], ["p"], ["number"])


def test_two_pairs_with_one_name_are_refused(spark):
    df = frame(spark, [("k", "a", 1, 2), ("k", "a_b", 1, 2)], "k string, p string, b_c bigint, c bigint")
    with pytest.raises(pv.PivotError, match="a_b_c"):
        pv.pivot(df, ["k"], ["p"], ["b_c", "c"])


def test_strings(spark, cells):
    df = frame(spark, [("a", "x", "t"), ("a", "x", "s"), ("a", "x", "t"), ("a", "y", None), ("b", "y", "u")], "k string, p string, v string")
    out = pv.pivot(df, ["k"], ["p"], ["v"], narrow_cells=cells)
    assert rows(out) == [("a", ["s", "t"], []), ("b", None, ["u"])]
    assert rows(pv.pivot(df, ["k"], ["p"], ["v"], on_string="drop", narrow_cells=cells)) == [("a", None, None), ("b", None, None)]
    single = pv.pivot(df.filter("not (p = 'x' and v = 's')"), ["k"], ["p"], ["v"], on_string="single", narrow_cells=cells)
    assert rows(single) == [("a", "t", None), ("b", None, "u")]
    with pytest.raises(PySparkException, match="several distinct strings"):
        pv.pivot(df, ["k"], ["p"], ["v"], on_string="single", narrow_cells=cells).collect()


def test_strings_and_numbers_together(spark, cells):
    df = frame(spark, [("a", "x", "t", 1), ("a", "x", "t", 2), ("a", "x", "s", None)], "k string, p string, v string, n bigint")
    out = pv.pivot(df, ["k"], ["p"], ["n", "v"], narrow_cells=cells)
    assert rows(out) == [("a", 3, ["s", "t"])]


def test_fill_and_given_labels(spark, cells):
    df = frame(spark, [("a", "x", None, 1), ("b", "y", None, 2), ("c", "z", None, 3)])
    out = pv.pivot(df, ["name"], ["gender"], ["number"], labels=["x", "y"], fill=0, narrow_cells=cells)
    assert rows(out) == [("a", 1, 0), ("b", 0, 2), ("c", 0, 0)]


def test_no_rows_at_all(spark, cells):
    out = pv.pivot(frame(spark, []), ["name"], ["gender"], ["number"], narrow_cells=cells)
    assert out.columns == ["name"] and out.count() == 0


def test_twice(spark):
    data = [("ann", "F", "South", 1), ("ann", "F", "West", 2), ("ann", "M", "South", 4), ("bob", "M", "West", 8)]
    by_region = pv.pivot(frame(spark, data), ["name", "gender"], ["state"], ["number"])
    by_region = pv.strip_suffix(by_region, "_number")
    out = pv.pivot(by_region, ["name"], ["gender"], ["South", "West"])
    assert out.columns == ["name", "F_South", "F_West", "M_South", "M_West"]
    assert rows(out) == [("ann", 1, 2, 4, 0), ("bob", None, None, 0, 8)]


def test_sparse_rows_keep_every_input_row(spark):
    df = frame(spark, [("a", "F", None, 1), ("a", "F", None, 1), ("a", None, None, 2)])
    out = pv.pivot_rows(df, ["name"], ["gender"], ["number"])
    assert rows(out) == sorted([("a", 1, None), ("a", 1, None), ("a", None, 2)], key=repr)
    assert "Exchange" not in out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")


def test_label_limit_and_missing_fields(spark):
    df = frame(spark, [(str(i), str(i), None, i) for i in range(6)])
    assert len(pv.pivot_labels(df, ["gender"], max_labels=6)) == 6
    with pytest.raises(pv.PivotError, match="more than 5"):
        pv.pivot_labels(df, ["gender"], max_labels=5)
    with pytest.raises(pv.PivotError, match="nope"):
        pv.pivot(df, ["nope"], ["gender"], ["number"])


def test_schema(spark):
    df = frame(spark, [("a", "F", None, None), ("a", "M", None, 0)])
    fields = pv.pivot_schema(df, ["name"], ["gender"], ["number"])
    assert rows(fields.select("name", "type")) == [("F_number", "INTEGER"), ("M_number", "INTEGER"), ("name", "STRING")]
    text = pv.schema_text(fields).first()[0]
    assert text == "name:STRING,F_number:INTEGER,M_number:INTEGER"
    assert pv.struct_from_text(text) == pv.pivot(df, ["name"], ["gender"], ["number"]).schema
    assert pv.struct_from_text("t:TIME,f:FLOAT,d:DATETIME").simpleString() == "struct<t:string,f:double,d:timestamp_ntz>"
    with pytest.raises(pv.PivotError, match="NOPE"):
        pv.struct_from_text("a:NOPE")


def test_suffix_clash(spark):
    with pytest.raises(pv.PivotError, match="ambiguous"):
        pv.strip_suffix(frame(spark, [(1, 2)], "a bigint, a_number bigint"), "_number")


LABEL = st.sampled_from(["F", "M", "New York", "New_York", None])
ROW = st.tuples(st.sampled_from(["a", "b", None]), LABEL, LABEL, st.one_of(st.none(), st.integers(-9, 9)))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(ROW, min_size=1, max_size=12), limit=st.sampled_from([0, 16]))
def test_agrees_with_a_plain_fold(spark, data, limit):
    expected = {}
    for name, one, two, number in data:
        cells = expected.setdefault(name, {})
        for column in {f"{label}_number".replace(" ", "_") for label in (one, two)}:
            cells[column] = cells.get(column, 0) + (number or 0)
    out = pv.pivot(frame(spark, data), ["name"], ["gender", "state"], ["number"], narrow_cells=limit)
    got = {r["name"]: {k: v for k, v in r.asDict().items() if k != "name" and v is not None} for r in out.collect()}
    assert got == expected


def test_two_string_fields_have_their_own_lists(spark):
    df = spark.createDataFrame(
        [("k", "L", "x", "1", 1), ("k", "L", "x", "2", 2), ("k", "L", "y", "1", None), ("k", "M", None, None, 5)],
        "k string, p string, a string, b string, n int",
    )
    for narrow in (pv.NARROW_CELLS, 0):
        row = pv.pivot(df, ["k"], ["p"], ["a", "b", "n"], narrow_cells=narrow).first().asDict()
        assert row == {"k": "k", "L_a": ["x", "y"], "L_b": ["1", "2"], "L_n": 3, "M_a": [], "M_b": [], "M_n": 5}


def test_strings_do_not_change_the_type_of_sums(spark):
    df = spark.createDataFrame([("k", "L", "x", decimal.Decimal("1.50"))], "k string, p string, a string, d decimal(10,2)")
    alone = pv.pivot(df, ["k"], ["p"], ["d"]).schema["L_d"].dataType
    for narrow in (pv.NARROW_CELLS, 0):
        assert pv.pivot(df, ["k"], ["p"], ["a", "d"], narrow_cells=narrow).schema["L_d"].dataType == alone


def test_schema_text_refuses_too_many_fields(spark):
    df = spark.createDataFrame([("k", str(i), 1) for i in range(5)], "k string, p string, n int")
    fields = pv.pivot_schema(df, ["k"], ["p"], ["n"])
    assert pv.schema_text(fields).first()[0].startswith("k:STRING,0_n:INTEGER")
    with pytest.raises(pv.PivotError, match="more than 5"):
        pv.schema_text(fields, max_fields=5)


def test_strings_of_a_hot_cell_come_in_parts(spark):
    many = spark.range(30_000).selectExpr("'k' AS k", "true AS p", "CAST(id % 25000 AS STRING) AS s")
    few = spark.createDataFrame([("k", None, "b"), ("k", None, "a"), (None, False, "x"), (None, False, None), ("z", True, None)], "k string, p boolean, s string")
    parts = pv.string_parts(many.union(few), ["k"], "p", "s", part_size=1000).collect()
    hot = [r for r in parts if r.label == "True"]
    assert {r.part for r in hot} == set(range(25)) and {r.parts for r in hot} == {25}
    assert sorted(s for r in hot for s in r.strings) == sorted(map(str, range(25_000)))
    assert all(len(r.strings) < 1200 and r.strings == sorted(r.strings) for r in hot)
    assert {(r.k, r.label, r.part, r.parts, tuple(r.strings)) for r in parts if r not in hot} == {
        ("k", "None", 0, 1, ("a", "b")), (None, "False", 0, 1, ("x",))
    }
