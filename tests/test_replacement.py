"""Tables are replaced whole, whatever fails on the way."""

from __future__ import annotations

import os

import pytest

from sluice.sinks import tables, versions


def values(df):
    return sorted(r[0] for r in df.collect())


def left_in(folder):
    return sorted(n for n in os.listdir(folder) if not n.startswith("."))


@pytest.mark.parametrize("step", [1, 2])
def test_overwrite_restores_the_old_table(spark, folder, monkeypatch, step):
    path = f"{folder}/t"
    tables.overwrite(spark.range(3), path)
    real, calls = tables.renamed, []

    def failing(spark, source, target):
        calls.append(target)
        if len(calls) == step:
            raise OSError("no rename")
        real(spark, source, target)

    monkeypatch.setattr(tables, "renamed", failing)
    with pytest.raises(OSError, match="no rename"):
        tables.overwrite(spark.range(10, 12), path)
    assert values(spark.read.parquet(path)) == [0, 1, 2] and left_in(folder) == ["t"]
    monkeypatch.undo()
    assert values(tables.overwrite(spark.range(10, 12), path)) == [10, 11] and left_in(folder) == ["t"]


def test_overwrite_that_cannot_compute_leaves_the_old_table(spark, folder):
    path = f"{folder}/t"
    tables.overwrite(spark.range(3), path)
    with pytest.raises(Exception, match="(?i)zero"):
        tables.overwrite(spark.range(3).selectExpr("1 DIV (id - 1) AS id"), path)
    assert values(spark.read.parquet(path)) == [0, 1, 2] and left_in(folder) == ["t"]


@pytest.mark.parametrize("step", [1, 2, 0])
def test_publish_with_new_columns(spark, folder, monkeypatch, step):
    name = f"published_{step}"
    spark.range(3).write.parquet(f"{folder}/one")
    spark.range(5).selectExpr("id", "id AS more").write.parquet(f"{folder}/two")
    tables.publish(spark, name, f"{folder}/one")
    real, calls = tables.rename_table, []

    def failing(spark, old, new):
        calls.append(new)
        if len(calls) == step:
            raise OSError("no rename")
        real(spark, old, new)

    monkeypatch.setattr(tables, "rename_table", failing)
    if step:
        with pytest.raises(OSError, match="no rename"):
            tables.publish(spark, name, f"{folder}/two")
        assert spark.table(name).columns == ["id"] and values(spark.table(name)) == [0, 1, 2]
    else:
        assert tables.publish(spark, name, f"{folder}/two").columns == ["id", "more"] and spark.table(name).count() == 5
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
    spark.sql(f"DROP TABLE {name}")


def replaced(spark, base, n):
    def both(written):
        yield "rows", spark.range(n)
        yield "total", written("rows").selectExpr("count(*) AS n")

    return versions.replace_together(spark, base, both)


@pytest.mark.parametrize("step", ["rows", "total", "note", "rename"])
def test_two_tables_change_together_or_not_at_all(spark, folder, monkeypatch, step):
    base = f"{folder}/base"
    first = replaced(spark, base, 3)

    def both(written):
        yield "rows", spark.range(9) if step != "rows" else spark.range(9).selectExpr("1 DIV id AS id")
        if step == "total":
            raise OSError("between the tables")
        yield "total", written("rows").selectExpr("count(*) AS n")

    def fails(*args):
        raise OSError("no rename")

    if step == "rename":
        monkeypatch.setattr(versions, "_renamed_over", fails)
    if step == "note":
        real = versions.files_of
        monkeypatch.setattr(versions, "files_of", lambda s, p: fails() if "_current-" in p else real(s, p))
    with pytest.raises(Exception, match="(?i)zero|between|no rename"):
        versions.replace_together(spark, base, both)
    monkeypatch.undo()
    rows, total = versions.read_current(spark, base, "rows", "total")
    assert versions.current(spark, base) == first and values(rows) == [0, 1, 2] and total.first().n == 3
    assert left_in(base) == sorted([os.path.basename(first), "_current"])


def test_readers_of_the_old_version_go_on(spark, folder):
    base = f"{folder}/base"
    with pytest.raises(FileNotFoundError):
        versions.read_current(spark, base, "rows")
    first = replaced(spark, base, 3)
    old, old_total = versions.read_current(spark, base, "rows", "total")
    second = replaced(spark, base, 5)
    assert values(old) == [0, 1, 2] and old_total.first().n == 3
    rows, total = versions.read_current(spark, base, "rows", "total")
    assert rows.count() == total.first().n == 5
    assert versions.forget_old(spark, base, keep=[first]) == [] and versions.forget_old(spark, base) == [first]
    assert versions.current(spark, base) == second and rows.count() == 5
