"""Finding social security numbers in text, hashing them, confirming known ones.

Every step takes a batch or a streaming DataFrame alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.cleaning import SPACES
from sluice.functions.hashing import HashKey
from sluice.operators.joins import exists_in

# Likelihoods from low to high, and what is searched by default.
LIKELIHOODS = ["VERY_UNLIKELY", "UNLIKELY", "POSSIBLE", "LIKELY", "VERY_LIKELY"]
SSN = "US_SOCIAL_SECURITY_NUMBER"

# Per info type: (pattern, likelihood), the more telling shape first. The look-arounds
# are word boundaries in ASCII terms, the same whatever letters surround a number.
_ALONE = r"(?<![0-9A-Za-z_])(?:{})(?![0-9A-Za-z_])"
INFO_TYPES = {
    SSN: [(r"\d{3}-\d{2}-\d{4}", "LIKELY"), (r"\d{9}", "POSSIBLE")],
}


def _findings_of(text: Column, info_type: str, min_likelihood: str) -> Column:
    floor = LIKELIHOODS.index(min_likelihood)
    shapes = [(p, lk) for p, lk in INFO_TYPES[info_type] if LIKELIHOODS.index(lk) >= floor]
    if not shapes:
        return F.array().cast("array<struct<info_type:string,likelihood:string,quote:string>>")
    found = F.regexp_extract_all(text, F.lit(_ALONE.format("|".join(p for p, _ in shapes))), F.lit(0))

    def describe(quote: Column) -> Column:
        likelihood = F.lit(shapes[-1][1])
        for shape, name in reversed(shapes[:-1]):
            likelihood = F.when(F.rlike(quote, F.lit(rf"\A(?:{shape})\z")), name).otherwise(likelihood)
        return F.struct(F.lit(info_type).alias("info_type"), likelihood.alias("likelihood"), quote.alias("quote"))

    return F.transform(found, describe)


def scan(
    texts: DataFrame,
    column: str,
    info_types: list[str] | None = None,
    min_likelihood: str = "POSSIBLE",
    max_findings: int = 0,
    include_quote: bool = True,
) -> DataFrame:
    """One row per finding: the input's other columns, info_type, likelihood, quote.

    ``max_findings`` bounds the findings of one input row; 0 means all.
    Texts are searched whole; a row stays in its task, nothing is shuffled.
    """
    others = [c for c in texts.columns if c != column]
    found = F.concat(*(_findings_of(F.col(column), t, min_likelihood) for t in info_types or [SSN]))
    if max_findings:
        found = F.slice(found, 1, max_findings)
    rows = texts.select(*others, F.explode(found).alias("finding")).select(*others, "finding.*")
    return rows if include_quote else rows.drop("quote")


def normalised(number: Column) -> Column:
    """Nine digits without spaces around and dashes, NULL for anything else."""
    digits = F.replace(F.btrim(number, F.lit(SPACES)), F.lit("-"), F.lit(""))
    return F.when(F.rlike(digits, F.lit(r"\A[0-9]{9}\z")), digits)


def _valid(numbers: DataFrame, column: str) -> DataFrame:
    return numbers.withColumn(column, normalised(F.col(column))).filter(F.col(column).isNotNull())


def _hash_valid(numbers: DataFrame, column: str, key: HashKey) -> DataFrame:
    # The hash of a valid number is never NULL; said so, a join on it adds no
    # null check, which would compute every hash a second time.
    return numbers.withColumn("hash", F.coalesce(key.hmac(F.col(column)), F.lit(""))).drop(column)


def hashed(numbers: DataFrame, column: str, key: HashKey) -> DataFrame:
    """Replace a number column by its keyed ``hash``; the number itself is not kept.

    Rows whose number is not nine digits are left out: see :func:`rejected`.
    """
    return _hash_valid(_valid(numbers, column), column, key)


def rejected(numbers: DataFrame, column: str) -> DataFrame:
    """Rows whose number is not nine digits, without the number: what remains tells
    where it came from and nothing about it."""
    return numbers.filter(normalised(F.col(column)).isNull()).drop(column)


def known_hashes(numbers: DataFrame, column: str, key: HashKey) -> DataFrame:
    """The distinct hashes of a list of numbers; each number is hashed once, however
    often it is listed."""
    return _hash_valid(_valid(numbers.select(column), column).distinct(), column, key)


def confirm(numbers: DataFrame, column: str, key: HashKey, known: DataFrame, broadcast: bool = False) -> DataFrame:
    """The rows whose number is in the known set, with the hash in place of the number."""
    return exists_in(hashed(numbers, column, key), known, "hash", broadcast)
