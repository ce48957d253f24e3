"""Scored texts: parsing the hand-off lines, typing, routing by score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import cleaning
from sluice.functions.patterns import bound, evaluated_once, joined, last_place, line_groups, part, places

# The fields of a scored line, in order, after its row number.
SCORES = ["neg", "neu", "pos", "compound", "polarity", "subjectivity"]
SCORED_FIELDS = [*SCORES, "word_sample", "tok2vec", "tweet_id", "tweet"]

# Fixed value: the pattern of a scored line.
SCORED_PATTERN = (
    r"\d+,(.*\.\d+),(.*\.\d+),(.*\.\d+),(.*\.\d+),(.*\.\d+),(.*\.\d+),(.*\[.*\].*),.(\[.*\]).,(\d+),(.*)"
)
# The same for a line with exactly two lists, both before the id, and plain numbers:
# the six numbers and the lists can then be found in one way only.
_PLAIN_SCORED = (
    r"\d+,(-?\d*\.\d+),(-?\d*\.\d+),(-?\d*\.\d+),(-?\d*\.\d+),(-?\d*\.\d+),(-?\d*\.\d+),"
    r"(\"?\[[^\[\]]*\]\"?),.(\[[^\[\]]*\]).,(\d+),([^\[\]]*)"
)


def _scored_groups(parts: Column) -> Column:
    """The groups of a scored line from its parts between commas, resolved from the right."""
    n = F.size(parts)

    def is_like(i: Column, pattern: str) -> Column:
        return F.rlike(part(parts, i), F.lit(pattern))

    def is_empty(i: Column) -> Column:
        return part(parts, i) == ""

    # The vector: any character, [, ..., ], any character; the first or the last may be a comma,
    # and then its part is empty. The id, in one part, and one more part stand after it.
    def vector_ends(i: Column) -> Column:
        ends = is_like(i, r"(?s)\].\z") | (is_empty(i) & is_like(i - 1, r"\]\z"))
        return ends & is_like(i + 1, r"\A\d+\z") & (i + 2 < n)

    def from_end(end: Column) -> Column:
        def starts(i: Column) -> Column:
            inside = is_like(i, r"(?s)\A.\[") & ((i < end) | is_like(i, r"(?s)\A.\[.*\].\z"))
            return (i <= end) & (inside | (is_empty(i) & (i < end) & is_like(i + 1, r"\A\[")))

        return bound(last_place(parts, starts), lambda vector: from_vector(end, vector))

    # The words hold a [ and later a ].
    def from_vector(end: Column, vector: Column) -> Column:
        close = last_place(parts, lambda i: (i < vector) & F.contains(part(parts, i), F.lit("]")))

        def opens(i: Column, close: Column) -> Column:
            return ((i < close) & F.contains(part(parts, i), F.lit("["))) | ((i == close) & is_like(i, r"(?s)\[.*\]"))

        return bound(close, lambda c: bound(last_place(parts, lambda i: opens(i, c)), lambda o: from_words(end, vector, o)))

    # Six numbers before the words, each up to a part that ends like one: the last six of these.
    def from_words(end: Column, vector: Column, words: Column) -> Column:
        ends = places(parts, lambda i: (i < words) & is_like(i, r"\.\d+\z"))
        last = bound(ends, lambda e: F.when(F.size(e) >= 6, F.slice(e, F.greatest(F.size(e) - 5, F.lit(1)), F.lit(6))))
        return bound(last, lambda numbers: from_numbers(end, vector, numbers))

    def from_numbers(end: Column, vector: Column, numbers: Column) -> Column:
        first = F.array_min(places(parts, lambda i: is_like(i, r"\d\z") & (i < F.get(numbers, F.lit(0)))))

        def all_of(first: Column) -> Column:
            bounds = [first, *(F.get(numbers, F.lit(i)) for i in range(6))]
            scores = [joined(parts, a + 1, b + 1) for a, b in zip(bounds, bounds[1:], strict=False)]
            text = joined(parts, vector, end + 1)
            return F.array(
                *scores,
                joined(parts, bounds[-1] + 1, vector),
                F.substring(text, F.lit(2), F.length(text) - 2),
                part(parts, end + 1),
                joined(parts, end + 2, n),
            )

        return bound(first, lambda at: F.when(at.isNotNull(), all_of(at)))

    return bound(last_place(parts, vector_ends), from_end)


# Bounds of the compound score, both exclusive.
NEGATIVE_BELOW = -0.5
POSITIVE_ABOVE = 0.6


def scored_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Raw hand-off lines to the ten text fields; all NULL when a line does not match."""
    others = [c for c in lines.columns if c != column]
    line = F.col(column)
    # Both lists start with a bracket, so the numbers stand before the last but one.
    before_lists = F.left(line, F.length(line) - F.length(F.substring_index(line, "[", -2)))
    possible = F.regexp_count(before_lists, F.lit(r"\.\d+,")) >= len(SCORES)
    fields = line_groups(line, len(SCORED_FIELDS), _scored_groups, possible, _PLAIN_SCORED)
    split = lines.select(*others, evaluated_once(fields).alias("_fields"))
    return split.select(
        *others, *(F.get("_fields", F.lit(i)).alias(name) for i, name in enumerate(SCORED_FIELDS))
    )


def type_scored(raw: DataFrame, keep_empty_words: bool = False) -> DataFrame:
    """Ten text fields to scores, word list, vector, id and text."""
    typed = {name: cleaning.real_number(F.col(name)) for name in SCORES}
    typed["word_sample"] = cleaning.word_list(F.col("word_sample"), keep_empty_words)
    typed["tok2vec"] = F.when(F.col("tok2vec") != "", cleaning.number_list(F.col("tok2vec")))
    typed["tweet_id"] = cleaning.whole_number(F.col("tweet_id"))
    typed["tweet"] = cleaning.strip_quotes(F.col("tweet"))
    return raw.withColumns(typed)


def label_of_score(compound: Column) -> Column:
    """``neg``, ``pos`` or ``neutral``; a missing score is neutral."""
    return (
        F.when(compound < NEGATIVE_BELOW, "neg").when(compound > POSITIVE_ABOVE, "pos").otherwise("neutral")
    )


def route(scored: DataFrame, column: str = "compound") -> DataFrame:
    """Label every row by its score and drop the neutral ones."""
    return scored.withColumn("label", label_of_score(F.col(column))).filter(F.col("label") != "neutral")
