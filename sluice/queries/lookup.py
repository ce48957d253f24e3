"""Queries of lookups and enrichment. JSON is packed from tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators import enrichment, joins
from sluice.operators.counts import count_per_key
from sluice.queries.registry import query, spread_table, table
from sluice.sources import lookups

_ENTRY = "struct<nation:int,segment:string,cents:bigint>"


def customer_lookup_json(spark, sf_dir):
    """``{"<customer>": {...}}`` per row, as a lookup in JSON lines."""
    entry = F.struct(
        F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
        F.round(F.col("c_acctbal") * 100).cast("bigint").alias("cents"),
    )
    return table(spark, sf_dir, "customer").select(F.to_json(F.create_map("c_name", entry)).alias("value"))


def customer_lookup(spark, sf_dir):
    return lookups.explode_lookup(customer_lookup_json(spark, sf_dir), "value", _ENTRY, "customer")


def order_counts(spark, sf_dir):
    """Orders per customer name, the name being made from the key."""
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    counts = count_per_key(table(spark, sf_dir, "orders"), "o_custkey", "n_orders")
    return counts.select(name.alias("customer"), "n_orders")


_ORDER_COUNTS = """SELECT 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS customer, count(*) AS n_orders
    FROM orders GROUP BY 1"""


ORACLE_LOOKUP = """SELECT c_name AS customer, c_nationkey AS nation, c_mktsegment AS segment,
    CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer"""


@query(ORACLE_LOOKUP)
def lookup_explode(spark, sf_dir):
    return customer_lookup(spark, sf_dir)


@query(
    """SELECT o_orderpriority AS key, arg_max(o_orderstatus, o_orderkey) AS value
    FROM orders GROUP BY o_orderpriority"""
)
def lookup_to_map(spark, sf_dir):
    """All pairs folded into one map, the last of a key winning, and listed again."""
    folded = lookups.to_map(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus", "o_orderkey")
    return folded.select(F.explode("lookup").alias("key", "value"))


def _arrays(spark, sf_dir):
    """Arrays of one-key records; each customer's name occurs in several of them."""
    first = F.create_map(
        F.col("o_custkey").cast("string"), F.struct(F.col("o_orderpriority").alias("priority"), F.lit(1).alias("place"))
    )
    second = F.create_map(
        F.col("o_custkey").cast("string"), F.struct(F.lit("later").alias("priority"), F.lit(2).alias("place"))
    )
    return spread_table(spark, sf_dir, "orders").select("o_orderkey", F.to_json(F.array(first, second)).alias("value"))


_FIRST = """SELECT CAST(o_custkey AS VARCHAR) AS customer, arg_min(o_orderpriority, o_orderkey) AS priority, 1 AS place
    FROM orders GROUP BY 1"""


@query(_FIRST)
def lookup_first_match(spark, sf_dir):
    return lookups.first_match(
        _arrays(spark, sf_dir), "value", "struct<priority:string,place:int>", "o_orderkey", "customer"
    )


@query(
    f"""WITH requests AS (
        SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN '1'
        WHEN c_mktsegment = 'FURNITURE' THEN 'x' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS customer FROM customer)
    SELECT c_custkey, customer, priority, priority IS NOT NULL AS found
    FROM requests LEFT JOIN ({_FIRST}) USING (customer)"""
)
def lookup_default(spark, sf_dir):
    """Requests without a name get the default's record; unknown names are marked."""
    asked = F.when(F.col("c_mktsegment") == "FURNITURE", F.concat(F.lit("x"), "c_custkey")).when(
        F.col("c_mktsegment") != "BUILDING", F.col("c_custkey").cast("string")
    )
    requests = table(spark, sf_dir, "customer").select("c_custkey", asked.alias("customer"))
    lookup = lookup_first_match(spark, sf_dir).select("customer", "priority")
    return joins.lookup_or_default(requests, lookup, "customer", default="1")


@query(
    f"""SELECT customer, n_orders, c_nationkey AS nation, c_mktsegment AS segment,
    CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM ({_ORDER_COUNTS}) LEFT JOIN customer ON customer = c_name"""
)
def lookup_join(spark, sf_dir):
    return joins.lookup_join(order_counts(spark, sf_dir), customer_lookup(spark, sf_dir), "customer")


_GAPS = "c_nationkey NOT IN (3, 7)"


@query(
    f"""SELECT k.customer, k.n_orders FROM ({_ORDER_COUNTS}) k
    WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_name = k.customer AND {_GAPS})"""
)
def unmatched_anti(spark, sf_dir):
    """Counts whose customer the lookup, which lacks two nations, does not have."""
    known = customer_lookup(spark, sf_dir).filter("nation not in (3, 7)")
    return joins.missing_in(order_counts(spark, sf_dir), known, "customer")


def nation_counts(spark, sf_dir):
    """Customers per nation; nations stand in for neighbourhoods."""
    counts = count_per_key(table(spark, sf_dir, "customer"), "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("neighbourhood"))
    joined = counts.join(nations, F.expr("c_nationkey = n_nationkey"))
    return joined.select("neighbourhood", "n_listings")


_NATION_COUNTS = """SELECT n_name AS neighbourhood, count(*) AS n_listings
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"""


def _nation_numbers(spark, sf_dir):
    """Numbers per nation from its customers' orders."""
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("o_orderstatus") == "F").alias("f"),
        F.sum(F.round("o_totalprice").cast("bigint")).alias("total"),
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    per_nation = (
        orders.join(customers, F.expr("o_custkey = c_custkey"))
        .groupBy("c_nationkey")
        .agg(F.sum("n").alias("n"), F.sum("f").alias("f"), F.sum("total").alias("total"))
    )
    nations = table(spark, sf_dir, "nation")
    return per_nation.join(nations, F.expr("c_nationkey = n_nationkey"))


_NATION_NUMBERS = """SELECT n_nationkey, n_name, n_regionkey, count(*) AS n,
    count(*) FILTER (WHERE o_orderstatus = 'F') AS f, CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL"""


def raw_demographics(spark, sf_dir):
    """Text demographics: grouped digits, NaN, plain numbers; two nations are missing."""
    numbers = _nation_numbers(spark, sf_dir).filter("n_nationkey not in (4, 9)")
    return numbers.select(
        F.col("n_name").alias("neighbourhood"),
        F.concat(F.lit("NTA"), "n_nationkey").alias("nta_code"),
        F.col("n").cast("string").alias("median_rent"),
        F.when(F.col("n_nationkey") == 2, "NaN").otherwise(F.format_number("total", 0)).alias("median_home_value"),
        F.format_string("%.2f", F.col("n_nationkey") / 4).alias("percent_atleast_bachdeg"),
        F.col("total").alias("population"),
        F.concat(F.lit("Area of "), "n_name").alias("nta_name"),
    )


@query(
    f"""SELECT neighbourhood, n_listings, 'NTA' || n_nationkey AS nta_code, n AS median_rent,
    CASE WHEN n_nationkey <> 2 THEN total END AS median_home_value,
    n_nationkey / 4 AS percent_atleast_bachdeg,
    total AS population, 'Area of ' || n_name AS nta_name
    FROM ({_NATION_COUNTS}) LEFT JOIN (SELECT * FROM ({_NATION_NUMBERS}) WHERE n_nationkey NOT IN (4, 9))
    ON neighbourhood = n_name"""
)
def enrich_one_hop(spark, sf_dir):
    found = enrichment.demographics(raw_demographics(spark, sf_dir))
    return enrichment.enrich_one_hop(nation_counts(spark, sf_dir), found)


_VARIABLES = {
    "population": "VAR1",
    "median_home_value": "VAR2",
    "adults": "VAR3",
    "adults_bachdeg": "VAR4",
    "median_rent": "VAR5",
}


def area_lookup(spark, sf_dir):
    """Nation name to the code of its region, read from JSON; one nation has no code."""
    code = F.when(F.col("n_nationkey") != 5, F.format_string("%05d", "n_regionkey"))
    packed = table(spark, sf_dir, "nation").select(
        F.to_json(F.create_map("n_name", F.struct(code.alias("puma_code")))).alias("value")
    )
    return lookups.explode_lookup(packed, "value", "struct<puma_code:string>", "neighbourhood")


def census_replies(spark, sf_dir):
    """Per region a reply of headers and values; one region has no adults at all."""
    sums = _nation_numbers(spark, sf_dir).groupBy("n_regionkey").agg(
        F.sum("n").alias("n"), F.sum("f").alias("f"), F.sum("total").alias("total")
    )
    named = sums.join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    adults = F.when(F.col("r_regionkey") == 1, F.lit(0)).otherwise(F.col("n"))
    values = ["total", "total", adults, "f", "n", "r_name"]
    reply = F.array(
        F.array(*(F.lit(h) for h in ("VAR1", "VAR2", "VAR3", "VAR4", "VAR5", "NAME"))),
        F.array(*((F.col(v) if isinstance(v, str) else v).cast("string") for v in values)),
    )
    return named.select(F.format_string("%05d", "r_regionkey").alias("puma_code"), F.to_json(reply).alias("reply"))


@query(
    f"""WITH r AS (SELECT r_regionkey, r_name, CAST(sum(n) AS BIGINT) AS n, CAST(sum(f) AS BIGINT) AS f,
        CAST(sum(total) AS BIGINT) AS total
        FROM ({_NATION_NUMBERS}) JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2)
    SELECT neighbourhood, n_listings, coalesce(lpad(CAST(r_regionkey AS VARCHAR), 5, '0'), '') AS puma_code,
    n AS median_rent, total AS median_home_value,
    CASE WHEN r_regionkey <> 1 THEN CAST(round(CAST(100 * f / n AS DECIMAL(20, 10)), 2) AS DOUBLE) END AS percent_adults_bachdeg,
    total AS population, r_name AS puma_name
    FROM ({_NATION_COUNTS}) JOIN nation ON n_name = neighbourhood
    LEFT JOIN r ON r_regionkey = CASE WHEN n_nationkey <> 5 THEN n_regionkey END"""
)
def enrich_two_hop(spark, sf_dir):
    statistics = enrichment.area_statistics(census_replies(spark, sf_dir), _VARIABLES)
    return enrichment.enrich_two_hop(nation_counts(spark, sf_dir), area_lookup(spark, sf_dir), statistics)


@query(
    """SELECT event_id, CAST(event_id AS VARCHAR) AS tweet_id, event_type AS tweet FROM events
    UNION ALL SELECT event_id, 'u' || user_id, props FROM events"""
)
def json_records_extract(spark, sf_dir):
    """Two objects per reply, of which only id and text are wanted."""
    first = F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("text"), F.lit("x").alias("lang"))
    second = F.struct(F.concat(F.lit("u"), "user_id").alias("id"), F.col("props").alias("text"), F.lit("y").alias("lang"))
    reply = F.struct(F.array(first, second).alias("data"), F.struct(F.lit(99).alias("result_count")).alias("meta"))
    replies = table(spark, sf_dir, "events").select("event_id", F.to_json(reply).alias("reply"))
    return lookups.extract_records(replies, "reply", {"id": "tweet_id", "text": "tweet"})


@query(
    """SELECT event_id // 150 AS reply, CAST(event_id AS VARCHAR) AS tweet_id, event_type AS tweet FROM events"""
)
def json_records_all(spark, sf_dir):
    """Replies of up to 150 objects, all of which are wanted."""
    item = F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("text"))
    numbered = table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 150).alias("reply"), item.alias("item"))
    replies = numbered.groupBy("reply").agg(F.to_json(F.struct(F.collect_list("item").alias("data"))).alias("text"))
    return lookups.extract_records(replies, "text", {"id": "tweet_id", "text": "tweet"})


@query(
    """SELECT c_custkey, o.* FROM customer LEFT JOIN (
        SELECT o_custkey, max(o_orderkey) AS last_order, arg_max(o_orderpriority, o_orderkey) AS priority
        FROM orders GROUP BY o_custkey) AS o ON o_custkey = c_custkey"""
)
def lookup_repeated_keys(spark, sf_dir):
    """A lookup that has a key several times: its last order counts, and no customer is multiplied."""
    orders = table(spark, sf_dir, "orders")
    lookup = orders.select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("last_order"), F.col("o_orderpriority").alias("priority")
    )
    found = joins.lookup_join(table(spark, sf_dir, "customer").select("c_custkey"), lookup, "c_custkey", order="last_order")
    known = F.when(F.col("last_order").isNotNull(), F.col("c_custkey")).alias("o_custkey")
    return found.select("c_custkey", known, "last_order", "priority")


@query(
    """SELECT 'n' || o_orderkey % 1000 AS name, max(o_orderkey) * 2 + 1 AS v FROM orders GROUP BY 1"""
)
def lookup_repeated_names(spark, sf_dir):
    """JSON objects that hold a name twice, and names that come in several objects."""
    name = F.concat(F.lit("n"), F.col("o_orderkey") % 1000)
    entry = [F.concat(F.lit('"'), name, F.lit('": {"v": '), F.col("o_orderkey") * 2 + i, F.lit("}")) for i in (0, 1)]
    text = F.concat(F.lit("{"), entry[0], F.lit(", "), entry[1], F.lit("}"))
    texts = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("value"))
    return lookups.explode_lookup(texts, "value", "struct<v:bigint>", "name", order="o_orderkey")
