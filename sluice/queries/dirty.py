"""Queries that clean text. The dirt is rendered from table columns, which the
oracles then read directly, so the two sides share no parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions import cleaning
from sluice.functions.regions import REGIONS, state_to_region as to_region
from sluice.operators import counts, listings
from sluice.queries.registry import query, spread_table, table
from sluice.sources.tables import validated_projection as projection

# Every listing field as the text a CSV would hold, from an order.
_RAW_LISTING = {
    "id": "CAST(o_orderkey AS STRING)",
    "name": "concat('Flat \"', o_orderpriority, '\",\\r\\nno. ', o_orderkey)",
    "host_id": "CAST(o_custkey + 10000 AS STRING)",
    "host_name": "concat('Host, ', o_custkey)",
    "neighbourhood_group": "CASE o_orderstatus WHEN 'F' THEN 'Staten Island' WHEN 'O' THEN 'Queens' ELSE 'Bronx' END",
    "neighbourhood": "CASE o_orderpriority WHEN '1-URGENT' THEN 'Harlem' WHEN '2-HIGH' THEN 'East Village'"
    " WHEN '3-MEDIUM' THEN 'Astoria' WHEN '5-LOW' THEN 'Bath Beach' ELSE 'Tribeca' END",
    "latitude": "concat('40.', lpad(CAST(o_orderkey % 100000 AS STRING), 5, '0'))",
    "longitude": "concat('-73.', lpad(CAST(o_custkey % 100000 AS STRING), 5, '0'))",
    "room_type": "CASE WHEN o_totalprice < 250000 THEN 'Private room' ELSE 'Entire home, apt' END",
    "price": "CAST(CAST(round(o_totalprice) AS BIGINT) AS STRING)",
    "minimum_nights": "CAST(o_custkey % 30 + 1 AS STRING)",
    "number_of_reviews": "CAST(o_orderkey % 500 AS STRING)",
    "last_review": "CASE WHEN o_orderstatus = 'P' THEN '' ELSE date_format(o_orderdate, 'M/d/yyyy') END",
    "reviews_per_month": "CASE WHEN o_orderstatus = 'P' THEN '' ELSE concat(o_orderkey % 7, '.', o_orderkey % 4 * 25) END",
    "calculated_host_listings_count": "CAST(o_custkey % 12 AS STRING)",
    "availability_365": "CAST(o_orderkey % 366 AS STRING)",
}
_NAME_SQL = "'Flat \"' || o_orderpriority || '\",{} no. ' || o_orderkey"
_HOOD_SQL = _RAW_LISTING["neighbourhood"]
# The same fields as typed values, for DuckDB.
_LISTING_SQL = {
    "id": "o_orderkey",
    "name": _NAME_SQL.format(""),
    "host_id": "o_custkey + 10000",
    "host_name": "'Host, ' || o_custkey",
    "neighbourhood_group": _RAW_LISTING["neighbourhood_group"],
    "neighbourhood": _HOOD_SQL,
    "latitude": "CAST('40.' || lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0') AS DOUBLE)",
    "longitude": "CAST('-73.' || lpad(CAST(o_custkey % 100000 AS VARCHAR), 5, '0') AS DOUBLE)",
    "room_type": _RAW_LISTING["room_type"],
    "price": "CAST(round(o_totalprice) AS BIGINT)",
    "minimum_nights": "o_custkey % 30 + 1",
    "number_of_reviews": "o_orderkey % 500",
    "last_review": "CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END",
    "reviews_per_month": "CASE WHEN o_orderstatus <> 'P' THEN"
    " CAST((o_orderkey % 7) || '.' || (o_orderkey % 4 * 25) AS DOUBLE) END",
    "calculated_host_listings_count": "o_custkey % 12",
    "availability_365": "o_orderkey % 366",
}
LISTING_ORACLE = ", ".join(f"{sql} AS {name}" for name, sql in _LISTING_SQL.items())


def raw_listings(spark, sf_dir):
    """String columns as a tolerant CSV reader gives them."""
    orders = spread_table(spark, sf_dir, "orders")
    return orders.select(*(F.expr(sql).alias(name) for name, sql in _RAW_LISTING.items()))


def raw_lines(spark, sf_dir):
    """One physical line per order; every 97th is cut short before its price."""
    fields = dict(_RAW_LISTING, name=_RAW_LISTING["name"].replace("\\r\\n", " "))
    whole = F.concat_ws(",", *(F.expr(sql) for sql in fields.values()))
    cut = F.concat_ws(",", *(F.expr(sql) for sql in list(fields.values())[:9]))
    value = F.when(F.col("o_orderkey") % 97 == 0, cut).otherwise(whole)
    return spread_table(spark, sf_dir, "orders").select("o_orderkey", value.alias("value"))


def _dates_as_text(df):
    return df.withColumn("last_review", F.date_format("last_review", "yyyy-MM-dd"))


@query(f"SELECT {LISTING_ORACLE} FROM orders")
def listing_clean(spark, sf_dir):
    typed = listings.listing_clean(raw_listings(spark, sf_dir))
    return _dates_as_text(listings.good_rows(typed))


@query(
    "SELECT o_orderkey, "
    + ", ".join(f"CASE WHEN o_orderkey % 97 <> 0 THEN {sql} END AS {name}" for name, sql in _LISTING_SQL.items())
    + " FROM orders"
)
def listing_regex_parse(spark, sf_dir):
    parsed = listings.parse_lines(raw_lines(spark, sf_dir))
    return _dates_as_text(parsed.drop("_line", listings.PARSE_OK))


@query(
    f"""SELECT o_orderkey, concat_ws(',', o_orderkey, {_NAME_SQL.format("")}, o_custkey + 10000,
    'Host, ' || o_custkey, {_RAW_LISTING["neighbourhood_group"]}, {_HOOD_SQL},
    '40.' || lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0'),
    '-73.' || lpad(CAST(o_custkey % 100000 AS VARCHAR), 5, '0'), {_RAW_LISTING["room_type"]}) AS _line
    FROM orders WHERE o_orderkey % 97 = 0"""
)
def dead_letter(spark, sf_dir):
    return listings.dead_letters(listings.parse_lines(raw_lines(spark, sf_dir))).select("o_orderkey", "_line")


_HOOD_COUNT = f"""SELECT CASE WHEN o_orderkey % 97 <> 0 THEN {_HOOD_SQL} END AS neighbourhood,
    count(*) AS n_listings FROM orders GROUP BY 1"""


@query(_HOOD_COUNT)
def count_per_key(spark, sf_dir):
    """Lines that cannot be read count under the NULL key."""
    parsed = listings.parse_lines(raw_lines(spark, sf_dir))
    return counts.count_per_key(listings.good_rows(parsed, keep_nulls=True), "neighbourhood")


@query(_HOOD_COUNT + " HAVING neighbourhood IS NOT NULL")
def sql_count_per_key(spark, sf_dir):
    parsed = listings.parse_lines(raw_lines(spark, sf_dir))
    return counts.sql_count_per_key(listings.good_rows(parsed), "neighbourhood")


@query("SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def validated_projection(spark, sf_dir):
    return projection(table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderpriority"])


@query(
    r"""SELECT doc_id, regexp_replace(text, '\r\n|\r|\n', ' ', 'g') AS one_line,
    replace(text, '/n', ' ') AS literal FROM documents"""
)
def newline_clean(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        cleaning.one_line(text).alias("one_line"),
        cleaning.one_line(text, literal_slash_n=True).alias("literal"),
    )


@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS padded, strftime(o_orderdate, '%Y-%m-%d') AS short,
    CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS gaps FROM orders"""
)
def mdy_to_date(spark, sf_dir):
    texts = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("padded"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("short"),
        F.expr("CASE WHEN o_orderstatus = 'P' THEN '13/45/2019' ELSE date_format(o_orderdate, 'M/d/yyyy') END").alias("gaps"),
    )
    dates = [F.date_format(cleaning.month_day_year(F.col(c)), "yyyy-MM-dd").alias(c) for c in ("padded", "short", "gaps")]
    return texts.select("o_orderkey", *dates)


@query(
    """SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS grouped,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS gaps FROM orders"""
)
def thousands_to_int(spark, sf_dir):
    cents = F.round(F.col("o_totalprice") * 100)
    texts = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.format_number(cents, 0).alias("grouped"),
        F.when(F.col("o_orderstatus") == "P", "NaN").otherwise(cents.cast("bigint").cast("string")).alias("gaps"),
    )
    return texts.select("o_orderkey", *(cleaning.grouped_number(F.col(c)).alias(c) for c in ("grouped", "gaps")))


@query(
    r"""SELECT conv_id, turn, rtrim(rtrim(rtrim(trim('"' || text || E'" \n', '"'), E' \n\t\r'), '"'), E' \n\t\r')
    AS stripped FROM conversations"""
)
def strip_quotes(spark, sf_dir):
    quoted = F.concat(F.lit('"'), F.col("text"), F.lit('" \n'))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", cleaning.strip_quotes(quoted).alias("stripped"))


@query(
    r"""SELECT doc_id, regexp_replace(regexp_replace(text, '[^\x00-\x7F]', '', 'g'),
    '[\t\n\v\f\r\x1c-\x1f ]{2,}', ' ', 'g') AS cleaned FROM documents"""
)
def ascii_clean(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", cleaning.ascii_only(F.col("text")).alias("cleaned"))


_CODES = [c for states in REGIONS.values() for c in states] + ["PR", "GU"]


@query(
    "WITH s AS (SELECT c_custkey, CASE WHEN c_custkey % 55 < 53 THEN list_extract(["
    + ", ".join(f"'{c}'" for c in _CODES)
    + "], CAST(c_custkey % 55 + 1 AS INTEGER)) END AS code FROM customer) SELECT c_custkey, CASE "
    + " ".join(
        f"WHEN code IN ({', '.join(repr(c) for c in states)}) THEN '{name}'" for name, states in REGIONS.items()
    )
    + " ELSE 'other' END AS state FROM s"
)
def state_to_region(spark, sf_dir):
    code = F.get(F.array(*(F.lit(c) for c in _CODES)), (F.col("c_custkey") % 55).cast("int"))
    return to_region(table(spark, sf_dir, "customer").select("c_custkey", code.alias("state")))


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 5 <> 3 THEN c_name END AS name,
    CASE WHEN c_custkey % 5 NOT IN (2, 3) THEN c_nationkey END AS nation,
    CASE WHEN c_custkey % 5 NOT IN (2, 3) THEN CAST(round(c_acctbal * 100) AS BIGINT) END AS cents FROM customer"""
)
def header_value_zip(spark, sf_dir):
    """Replies of a header row and a value row, to columns; some repeat a header, stop early, or have no values."""
    headers = F.array(F.lit("NAME"), F.lit("VAR1"), F.lit("VAR2"))
    values = F.array("c_name", F.col("c_nationkey").cast("string"), F.round(F.col("c_acctbal") * 100).cast("bigint").cast("string"))
    twice = F.array(F.concat(F.array(F.lit("VAR1")), headers), F.concat(F.array(F.lit("old")), values))
    kind = F.col("c_custkey") % 5
    reply = F.to_json(
        F.when(kind == 1, twice)
        .when(kind == 2, F.array(headers, F.slice(values, 1, 1)))
        .when(kind == 3, F.array(headers))
        .otherwise(F.array(headers, values))
    )
    records = table(spark, sf_dir, "customer").select("c_custkey", cleaning.header_value_record(reply).alias("r"))
    return records.select(
        "c_custkey",
        F.col("r")["NAME"].alias("name"),
        F.col("r")["VAR1"].try_cast("int").alias("nation"),
        F.col("r")["VAR2"].try_cast("bigint").alias("cents"),
    )
