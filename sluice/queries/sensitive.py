"""Queries of the number scan, the keyed hash and the known set."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.hashing import HashKey
from sluice.operators import sensitive
from sluice.queries.registry import query, spread_table, table

# A key and salt for trying things out; real ones come from a secret store.
DEMO_KEY = bytes(range(1, 65))
DEMO_SALT = "demo-salt"

_INNER = bytes(b ^ 0x36 for b in DEMO_KEY).hex()
_OUTER = bytes(b ^ 0x5C for b in DEMO_KEY).hex()


def hmac_sql(message: str) -> str:
    return (
        f"sha256(unhex('{_OUTER}') || unhex(sha256(unhex('{_INNER}') || encode('{DEMO_SALT}' || {message}))))"
    )


def demo_key(spark) -> HashKey:
    return HashKey(spark, DEMO_KEY, DEMO_SALT)


# A nine-digit number per customer key, the same text in both dialects.
def _number(key: str) -> str:
    return f"lpad(CAST(({key} * 7919 + 100000007) % 800000000 AS STRING), 9, '0')"


def _dashed(key: str) -> str:
    n = _number(key)
    return f"substr({n}, 1, 3) || '-' || substr({n}, 4, 2) || '-' || substr({n}, 6, 4)"


def _decoy(key: str) -> str:
    return f"CAST(900000000 + {key} % 99999999 AS STRING)"


MESSAGE = f"""CASE c_custkey % 4
    WHEN 0 THEN 'My name is ' || c_name || ', and I have nothing to tell'
    WHEN 1 THEN 'My account number is ' || {_decoy("c_custkey")}
    WHEN 2 THEN 'My social is ' || {_dashed("c_custkey")} || '.'
    ELSE 'My account number is ' || {_decoy("c_custkey")} || ' and my ssn is ' || {_number("c_custkey")} END"""

# Orders mark whose numbers are known; a customer is listed once per such order.
KNOWN_ORDERS = "o_orderpriority = '1-URGENT'"


def messages(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return customers.select("c_custkey", F.expr(MESSAGE).alias("text"))


def known_numbers(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").filter(KNOWN_ORDERS)
    return urgent.select(F.expr(_dashed("o_custkey")).alias("ssn"))


def known(spark, sf_dir):
    return sensitive.known_hashes(known_numbers(spark, sf_dir), "ssn", demo_key(spark))


_FINDING = r"'\b(?:\d{3}-\d{2}-\d{4}|\d{9})\b'"


@query(
    f"""WITH texts AS (SELECT 'customer' AS source, c_custkey AS id, {MESSAGE} AS text FROM customer
        UNION ALL SELECT 'document', doc_id, text FROM documents
        UNION ALL SELECT 'page', page_id, html FROM pages),
    found AS (SELECT source, id, unnest(regexp_extract_all(text, {_FINDING})) AS quote FROM texts)
    SELECT source, id, 'US_SOCIAL_SECURITY_NUMBER' AS info_type,
    CASE WHEN contains(quote, '-') THEN 'LIKELY' ELSE 'POSSIBLE' END AS likelihood, quote FROM found"""
)
def ssn_scan(spark, sf_dir):
    """Candidates in messages, documents and pages, all searched whole."""
    texts = messages(spark, sf_dir).select(F.lit("customer").alias("source"), F.col("c_custkey").alias("id"), "text")
    for name, key, column in (("document", "doc_id", "text"), ("page", "page_id", "html")):
        more = spread_table(spark, sf_dir, name + "s")
        texts = texts.unionAll(more.select(F.lit(name), F.col(key), F.col(column)))
    return sensitive.scan(texts, "text")


FORMS = f"""CASE c_custkey % 5 WHEN 0 THEN ' ' || {_dashed("c_custkey")} || E'\\n' WHEN 1 THEN {_number("c_custkey")}
    WHEN 2 THEN {_number("c_custkey")} || '1' WHEN 3 THEN substr({_number("c_custkey")}, 2) END"""


def _forms(spark, sf_dir):
    """Good numbers in two spellings, ten digits, eight digits, and none."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.expr(FORMS.replace("E'\\n'", "'\\n'")).alias("ssn")
    )


@query(f"SELECT c_custkey, CASE WHEN c_custkey % 5 < 2 THEN {_number('c_custkey')} END AS ssn FROM customer")
def ssn_normalise(spark, sf_dir):
    return _forms(spark, sf_dir).select("c_custkey", sensitive.normalised(F.col("ssn")).alias("ssn"))


@query("SELECT c_custkey FROM customer WHERE c_custkey % 5 >= 2")
def ssn_rejected(spark, sf_dir):
    """Where unusable numbers came from, without the numbers."""
    return sensitive.rejected(_forms(spark, sf_dir), "ssn")


@query(f"SELECT c_custkey, {hmac_sql('c_name')} AS digest FROM customer")
def hmac_sha256(spark, sf_dir):
    key = demo_key(spark)
    return table(spark, sf_dir, "customer").select("c_custkey", key.hmac(F.col("c_name")).alias("digest"))


@query(f"SELECT DISTINCT {hmac_sql(_number('o_custkey'))} AS hash FROM orders WHERE {KNOWN_ORDERS}")
def known_hash_set(spark, sf_dir):
    return known(spark, sf_dir)


CONFIRMED = f"""SELECT c_custkey, {hmac_sql(_number('c_custkey'))} AS hash FROM customer
    WHERE c_custkey % 4 >= 2 AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND {KNOWN_ORDERS})"""


@query(CONFIRMED)
def known_semi_join(spark, sf_dir):
    """Scan, hash, and keep the numbers that are known; decoys fall away."""
    found = sensitive.scan(messages(spark, sf_dir), "text").select("c_custkey", "quote")
    return sensitive.confirm(found, "quote", demo_key(spark), known(spark, sf_dir)).select("c_custkey", "hash")
