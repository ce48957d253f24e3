"""Typing of raw listing rows, and the split into good rows and dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import cleaning
from sluice.functions.patterns import bound, evaluated_once, joined, last_place, line_groups, part, places

# The columns of a listing, in file order.
LISTING = (
    T.StructType()
    .add("id", "long")
    .add("name", "string")
    .add("host_id", "long")
    .add("host_name", "string")
    .add("neighbourhood_group", "string")
    .add("neighbourhood", "string")
    .add("latitude", "double")
    .add("longitude", "double")
    .add("room_type", "string")
    .add("price", "long")
    .add("minimum_nights", "long")
    .add("number_of_reviews", "long")
    .add("last_review", "date")
    .add("reviews_per_month", "double")
    .add("calculated_host_listings_count", "long")
    .add("availability_365", "long")
)
RAW_LISTING = T.StructType([T.StructField(f.name, T.StringType()) for f in LISTING.fields])

# Fixed value: the pattern of a raw line, its groups being the columns in file order.
LINE_PATTERN = (
    r"(\d+),(.*),(\d{4,9}),(.*),([BMQS].*),([A-Z]\D*),(40\.\d+),(-\d+\.\d+),(.*),(\d+),(\d+),(\d+),(.*),(.*),(\d+),(\d+)"
)
# The same for a line whose only commas are the 15 between the fields: then each
# field is what stands between two commas, and there is one way to read it.
_PLAIN_LINE = LINE_PATTERN.replace(r"\D*", r"[^\d,]*").replace(".*", "[^,]*")


def _line_groups(parts: Column) -> Column:
    """The groups of a raw line from its parts between commas.

    Names of places are those of the columns that start there; a place is the last at which the
    pattern can go on from that column, except for the first column, which is the first to fit.
    """

    def is_like(i: Column, pattern: str) -> Column:
        return F.rlike(part(parts, i), F.lit(pattern))

    def whole(i: Column) -> Column:
        return is_like(i, r"\A\d+\z")

    def result(listings, price, area, place, host) -> Column:
        borough, hood, latitude = place["borough"], area["hood"], area["latitude"]
        first = F.array_min(places(parts, lambda i: is_like(i, r"\d\z") & (i < host - 1)))

        def all_of(first: Column) -> Column:
            return F.array(
                F.regexp_extract(part(parts, first), r"(\d+)\z", 1),
                joined(parts, first + 1, host),
                part(parts, host),
                joined(parts, host + 1, borough),
                joined(parts, borough, hood),
                joined(parts, hood, latitude),
                part(parts, latitude),
                part(parts, latitude + 1),
                joined(parts, latitude + 2, price),
                part(parts, price),
                part(parts, price + 1),
                part(parts, price + 2),
                joined(parts, price + 3, listings - 1),
                part(parts, listings - 1),
                part(parts, listings),
                F.regexp_extract(part(parts, listings + 1), r"\A(\d+)", 1),
            )

        return bound(first, lambda at: F.when(at.isNotNull(), all_of(at)))

    def latitude_at(i: Column, price: Column) -> Column:
        return is_like(i, r"\A40\.\d+\z") & is_like(i + 1, r"\A-\d+\.\d+\z") & (i + 1 < price - 1)

    def hood_and_latitude(price: Column) -> Column:
        """The neighbourhood has no digit and goes up to the latitude, the first part with one."""
        none = F.lit(None).cast("int")
        start = F.struct(none.alias("open"), none.alias("hood"), none.alias("latitude"))

        def step(state: Column, i: Column) -> Column:
            digits = F.coalesce(is_like(i, r"\d"), F.lit(False))
            found = digits & state["open"].isNotNull() & F.coalesce(latitude_at(i, price), F.lit(False))
            opens = F.coalesce(is_like(i, r"\A[A-Z]"), F.lit(False))
            return F.struct(
                F.when(digits, none).when(opens, i).otherwise(state["open"]).alias("open"),
                F.when(found, state["open"]).otherwise(state["hood"]).alias("hood"),
                F.when(found, i).otherwise(state["latitude"]).alias("latitude"),
            )

        return F.aggregate(F.sequence(F.lit(0), F.size(parts) - 1), start, step)

    def from_listings(listings: Column) -> Column:
        price = last_place(parts, lambda i: whole(i) & whole(i + 1) & whole(i + 2) & (i + 2 < listings - 2))
        return bound(price, lambda p: from_price(listings, p))

    def from_price(listings: Column, price: Column) -> Column:
        return bound(hood_and_latitude(price), lambda area: from_area(listings, price, area))

    def from_area(listings: Column, price: Column, area: Column) -> Column:
        borough = last_place(parts, lambda i: is_like(i, r"\A[BMQS]") & (i < area["hood"]))
        return bound(F.struct(borough.alias("borough")), lambda place: from_place(listings, price, area, place))

    def from_place(listings: Column, price: Column, area: Column, place: Column) -> Column:
        host = last_place(parts, lambda i: is_like(i, r"\A\d{4,9}\z") & (i < place["borough"] - 1))
        return bound(host, lambda h: result(listings, price, area, place, h))

    return bound(last_place(parts, lambda i: whole(i) & is_like(i + 1, r"\A\d")), from_listings)


# Commas beyond those between the fields up to which the pattern is tried as it is.
FEW_COMMAS = 5

_READ = {"bigint": cleaning.whole_number, "double": cleaning.real_number, "date": cleaning.month_day_year}
# A blank is allowed (and becomes NULL) in reals and dates; whole numbers must be there.
_MAY_BE_BLANK = ("double", "date")

PARSE_OK = "_parse_ok"


def _typed(raw: Column, field: T.StructField) -> tuple[Column, Column]:
    """The typed value and whether the text could be read."""
    kind = field.dataType.simpleString()
    if kind not in _READ:
        return raw, F.lit(True)
    value = _READ[kind](raw)
    readable = value.isNotNull()
    if kind in _MAY_BE_BLANK:
        readable = readable | F.coalesce(F.trim(raw) == "", F.lit(True))
    return value, readable


def type_rows(raw: DataFrame, schema: T.StructType = LISTING, literal_slash_n: bool = False) -> DataFrame:
    """String columns to the typed schema, plus ``_parse_ok``.

    ``name`` gets its newlines replaced. Other columns of ``raw`` are kept.
    """
    columns, readable = [], F.lit(True)
    for field in schema.fields:
        value, ok = _typed(F.col(field.name), field)
        if field.name == "name":
            value = cleaning.one_line(value, literal_slash_n)
        columns.append(value.alias(field.name))
        readable = readable & ok
    extra = [c for c in raw.columns if c not in schema.fieldNames()]
    return raw.select(*extra, *columns, readable.alias(PARSE_OK))


def listing_clean(raw: DataFrame, literal_slash_n: bool = False) -> DataFrame:
    return type_rows(raw, LISTING, literal_slash_n)


def line_fields(line: Column) -> Column:
    """The groups of :data:`LINE_PATTERN` in a raw line as an array, NULL if it does not match."""
    n, commas = len(LISTING), F.length(line) - F.length(F.replace(line, F.lit(","), F.lit("")))
    return line_groups(
        line, n, _line_groups, commas >= n - 1, _PLAIN_LINE, commas == n - 1, pattern=LINE_PATTERN, few=commas < n + FEW_COMMAS
    )


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Raw lines to typed listings by pattern; keeps the line in ``_line``.

    A line that does not match has all listing columns NULL and ``_parse_ok`` false.
    """
    others = [c for c in lines.columns if c != column]
    split = lines.select(*others, F.col(column).alias("_line"), evaluated_once(line_fields(F.col(column))).alias("_fields"))
    raw = split.select(
        *others, "_line", *(F.get("_fields", F.lit(i)).alias(f.name) for i, f in enumerate(LISTING.fields))
    )
    return type_rows(raw)


def good_rows(parsed: DataFrame, keep_nulls: bool = False) -> DataFrame:
    """The readable rows. With ``keep_nulls`` unreadable ones stay, as all-NULL rows."""
    data = [c for c in parsed.columns if c not in (PARSE_OK, "_line")]
    if not keep_nulls:
        return parsed.filter(PARSE_OK).select(*data)
    return parsed.select(*(F.when(F.col(PARSE_OK), F.col(c)).alias(c) for c in data))


def dead_letters(parsed: DataFrame) -> DataFrame:
    """The unreadable rows, as they came."""
    return parsed.filter(~F.col(PARSE_OK)).drop(PARSE_OK)
