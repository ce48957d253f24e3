"""Queries of the dynamic pivot.

Money is summed as whole cents and quantities as whole numbers, so that sums do not
depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators import pivot as pv
from sluice.queries.registry import query, table


def cents(column: str):
    return F.round(F.col(column) * 100).cast("bigint")


def lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumn("qty", F.col("l_quantity").cast("bigint"))


def priced_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("cents", cents("o_totalprice"))


QTY = "CAST(l_quantity AS BIGINT)"
CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"


def _sum(value: str, condition: str) -> str:
    return f"CAST(sum({value}) FILTER (WHERE {condition}) AS BIGINT)"


@query(
    f"""SELECT l_returnflag, {_sum(QTY, "l_linestatus = 'F'")} AS "F_qty", {_sum(QTY, "l_linestatus = 'O'")} AS "O_qty"
    FROM lineitem GROUP BY l_returnflag"""
)
def pivot_sum(spark, sf_dir):
    return pv.pivot(lines(spark, sf_dir), ["l_returnflag"], ["l_linestatus"], ["qty"])


@query(
    "SELECT l_returnflag, "
    + ", ".join(
        _sum(QTY, f"l_linestatus = '{s}' OR o_orderstatus = '{s}'") + f' AS "{s}_qty"' for s in "FOP"
    )
    + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_returnflag"
)
def pivot_multi_field(spark, sf_dir):
    joined = lines(spark, sf_dir).join(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), F.expr("l_orderkey = o_orderkey")
    )
    labels = {*pv.pivot_labels(lines(spark, sf_dir), ["l_linestatus"]), *pv.pivot_labels(table(spark, sf_dir, "orders"), ["o_orderstatus"])}
    return pv.pivot(joined, ["l_returnflag"], ["l_linestatus", "o_orderstatus"], ["qty"], labels=sorted(labels))


@query(
    "SELECT l_returnflag, "
    + ", ".join(
        _sum(v, f"l_linestatus = '{s}'") + f' AS "{s}_{n}"'
        for s in "FO" for v, n in ((QTY, "qty"), ("l_linenumber", "l_linenumber"))
    )
    + " FROM lineitem GROUP BY l_returnflag"
)
def pivot_multi_value(spark, sf_dir):
    return pv.pivot(lines(spark, sf_dir), ["l_returnflag"], ["l_linestatus"], ["qty", "l_linenumber"])


@query(
    "SELECT c_mktsegment, c_nationkey, "
    + ", ".join(_sum(CENTS, f"o_orderstatus = '{s}'") + f' AS "{s}_cents"' for s in "FOP")
    + " FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment, c_nationkey"
)
def pivot_multi_key(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    joined = priced_orders(spark, sf_dir).join(customers, F.expr("o_custkey = c_custkey"))
    labels = pv.pivot_labels(table(spark, sf_dir, "orders"), ["o_orderstatus"])
    return pv.pivot(joined, ["c_mktsegment", "c_nationkey"], ["o_orderstatus"], ["cents"], labels=labels)


# Wide enough that the labels are exploded: 50 sizes times two values.
@query(
    "SELECT l_returnflag, "
    + ", ".join(
        _sum(v, f"p_size = {s}") + f' AS "{s}_{n}"'
        for s in range(1, 51) for v, n in ((QTY, "qty"), ("l_linenumber", "l_linenumber"))
    )
    + " FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_returnflag"
)
def pivot_wide(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    joined = lines(spark, sf_dir).join(parts, F.expr("l_partkey = p_partkey"))
    labels = pv.pivot_labels(parts, ["p_size"])
    return pv.pivot(joined, ["l_returnflag"], ["p_size"], ["qty", "l_linenumber"], labels=labels)


_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query(
    "SELECT p_brand, "
    + ", ".join(
        f"CASE WHEN count(*) FILTER (WHERE l_returnflag = '{f}') > 0 THEN coalesce("
        + _sum(QTY, f"l_returnflag = '{f}' AND r_name = '{r}'")
        + f""", 0) END AS "{f}_{r.replace(' ', '_')}_qty\""""
        for f in "ANR" for r in _REGIONS
    )
    + """ FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY p_brand"""
)
def pivot_twice(spark, sf_dir):
    """By region, then the result by return flag, without a table in between.

    Both label lists come from the columns where they originate, not from the joined
    or the pivoted rows, which would compute those twice.
    """
    regions = table(spark, sf_dir, "region")
    items = lines(spark, sf_dir)
    joined = (
        items.join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.expr("l_partkey = p_partkey"))
        .join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.expr("l_orderkey = o_orderkey"))
        .join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.expr("o_custkey = c_custkey"))
        .join(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"), F.expr("c_nationkey = n_nationkey"))
        .join(regions, F.expr("n_regionkey = r_regionkey"))
    )
    by_region = pv.pivot(
        joined, ["p_brand", "l_returnflag"], ["r_name"], ["qty"], labels=pv.pivot_labels(regions, ["r_name"])
    )
    values = [c for c in by_region.columns if c.endswith("_qty")]
    flags = pv.pivot_labels(items, ["l_returnflag"])
    return pv.pivot(by_region, ["p_brand"], ["l_returnflag"], values, labels=flags)


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "SELECT o_orderkey, "
    + ", ".join(
        f"""CASE WHEN o_orderpriority = '{p}' THEN o_orderstatus END AS "{p.replace(' ', '_')}_o_orderstatus\""""
        for p in _PRIORITIES
    )
    + " FROM orders"
)
def pivot_rows_sparse(spark, sf_dir):
    return pv.pivot_rows(table(spark, sf_dir, "orders"), ["o_orderkey"], ["o_orderpriority"], ["o_orderstatus"])


@query(
    "SELECT o_custkey, "
    + ", ".join(
        f"""array_to_string(list_sort(list(DISTINCT o_orderpriority) FILTER (WHERE o_orderstatus = '{s}')), '|')
        AS "{s}_o_orderpriority\""""
        for s in "FOP"
    )
    + " FROM orders GROUP BY o_custkey"
)
def pivot_string_list(spark, sf_dir):
    lists = pv.pivot(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderstatus"], ["o_orderpriority"])
    return lists.select("o_custkey", *(F.array_join(c, "|").alias(c) for c in lists.columns[1:]))


_CLERK = "coalesce(o_orderpriority, '') || ' ' || (o_orderkey % 5000)"


@query(
    f"""WITH rows AS (SELECT DISTINCT o_orderstatus, replace(o_orderpriority, ' ', '_') AS label, {_CLERK} AS s FROM orders),
    sized AS (SELECT *, CAST(ceil(count(*) OVER (PARTITION BY o_orderstatus, label) / 500.0) AS BIGINT) AS parts FROM rows)
    SELECT o_orderstatus, label, CAST('0x' || substr(md5(s), 1, 8) AS BIGINT) % parts AS part, parts, string_agg(s, '|' ORDER BY s) AS strings
    FROM sized GROUP BY ALL"""
)
def pivot_string_parts(spark, sf_dir):
    """Cells of thousands of strings as lists of about 500."""
    rows = table(spark, sf_dir, "orders").withColumn("s", F.expr(_CLERK))
    parts = pv.string_parts(rows, ["o_orderstatus"], "o_orderpriority", "s", part_size=500)
    return parts.withColumn("strings", F.array_join("strings", "|"))


@query(
    "SELECT o_orderkey, "
    + ", ".join(f"""max(o_orderpriority) FILTER (WHERE o_orderstatus = '{s}') AS "{s}_o_orderpriority\"""" for s in "FOP")
    + " FROM orders GROUP BY o_orderkey"
)
def pivot_string_single(spark, sf_dir):
    return pv.pivot(
        table(spark, sf_dir, "orders"), ["o_orderkey"], ["o_orderstatus"], ["o_orderpriority"], on_string="single"
    )


@query(
    "SELECT o_custkey, "
    + ", ".join(f"coalesce({_sum(CENTS, f'''o_orderstatus = '{s}' ''')}, 0)" + f' AS "{s}_cents"' for s in "FOP")
    + " FROM orders GROUP BY o_custkey"
)
def pivot_filled(spark, sf_dir):
    return pv.pivot(priced_orders(spark, sf_dir), ["o_custkey"], ["o_orderstatus"], ["cents"], fill=0)


@query(
    f"""SELECT l_returnflag, {_sum(QTY, "l_linestatus = 'F'")} AS "F", {_sum(QTY, "l_linestatus = 'O'")} AS "O"
    FROM lineitem GROUP BY l_returnflag"""
)
def pivot_rename(spark, sf_dir):
    return pv.strip_suffix(pivot_sum(spark, sf_dir), "_qty")


_SCHEMA_FIELDS = """SELECT 0 AS is_cell, 'l_returnflag' AS name, 'STRING' AS type
    UNION ALL SELECT 1, l_linestatus || '_qty', 'INTEGER' FROM (SELECT DISTINCT l_linestatus FROM lineitem)
    UNION ALL SELECT 1, l_linestatus || '_l_tax', 'FLOAT' FROM (SELECT DISTINCT l_linestatus FROM lineitem)"""


@query(f"SELECT name, type FROM ({_SCHEMA_FIELDS})")
def pivot_schema(spark, sf_dir):
    fields = pv.pivot_schema(lines(spark, sf_dir), ["l_returnflag"], ["l_linestatus"], ["qty", "l_tax"])
    return fields.select("name", "type")


@query(
    f"""SELECT string_agg(name || ':' || type, ',' ORDER BY is_cell, name) AS "schema" FROM ({_SCHEMA_FIELDS})"""
)
def pivot_schema_text(spark, sf_dir):
    return pv.schema_text(
        pv.pivot_schema(lines(spark, sf_dir), ["l_returnflag"], ["l_linestatus"], ["qty", "l_tax"])
    )


@query(
    """SELECT DISTINCT replace(o_orderpriority, ' ', '_') AS label FROM orders
    UNION SELECT DISTINCT o_orderstatus FROM orders"""
)
def pivot_distinct_labels(spark, sf_dir):
    return pv.distinct_labels(table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"])


@query(
    "SELECT o_custkey, "
    + ", ".join(
        f"""array_to_string(list_sort(list(DISTINCT {c}) FILTER (WHERE o_orderstatus = '{s}')), '|') AS "{s}_{n}\""""
        for s in "FOP" for c, n in (("o_orderpriority", "o_orderpriority"), ("left(o_orderpriority, 1)", "grade"))
    )
    + ", " + ", ".join(_sum(CENTS, f"o_orderstatus = '{s}'") + f' AS "{s}_cents"' for s in "FOP")
    + " FROM orders GROUP BY o_custkey"
)
def pivot_two_strings(spark, sf_dir):
    """Two string fields and a number: each string field has its own distinct list."""
    rows = priced_orders(spark, sf_dir).withColumn("grade", F.left("o_orderpriority", F.lit(1)))
    labels = pv.pivot_labels(rows, ["o_orderstatus"])
    wide = pv.pivot(rows, ["o_custkey"], ["o_orderstatus"], ["o_orderpriority", "grade", "cents"], labels=labels)
    lists = [F.array_join(c, "|").alias(c) if not c.endswith("_cents") else F.col(c) for c in wide.columns[1:]]
    return wide.select("o_custkey", *lists)


@query(
    "SELECT l_returnflag, "
    + ", ".join(
        f"""array_to_string(list_sort(list(DISTINCT p_brand) FILTER (WHERE p_size = {s})), '|') AS "{s}_p_brand\""""
        for s in range(1, 51)
    )
    + " FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_returnflag"
)
def pivot_wide_strings(spark, sf_dir):
    """Fifty lists of strings per key, from one row per key and label."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_brand")
    joined = lines(spark, sf_dir).join(parts, F.expr("l_partkey = p_partkey"))
    wide = pv.pivot(joined, ["l_returnflag"], ["p_size"], ["p_brand"], labels=pv.pivot_labels(parts, ["p_size"]))
    return wide.select("l_returnflag", *(F.array_join(c, "|").alias(c) for c in wide.columns[1:]))


@query(
    """SELECT 'l_returnflag' AS name, 'string' AS type UNION ALL
    SELECT l_linestatus || '_qty', 'bigint' FROM (SELECT DISTINCT l_linestatus FROM lineitem) UNION ALL
    SELECT l_linestatus || '_l_tax', 'double' FROM (SELECT DISTINCT l_linestatus FROM lineitem)"""
)
def pivot_struct_from_text(spark, sf_dir):
    """The schema text of a pivot read back as a schema, its fields as rows."""
    text = pivot_schema_text(spark, sf_dir).first()["schema"]
    fields = [(f.name, f.dataType.simpleString()) for f in pv.struct_from_text(text).fields]
    return spark.createDataFrame(fields, "name string, type string")
