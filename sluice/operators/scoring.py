"""Text scores by lexicon and vector aggregation.

A lexicon is a table ``(token, valence, polarity, subjectivity)``. Texts are split
into tokens, tokens are joined to the lexicon and folded back to one row per text.
All tokens of a text come from one input row, so the map-side aggregation already
reduces them: the exchange carries one short row per text and never its words. Where
words or texts come along with the scores, that aggregation would have to sort them all;
there each text is folded in place.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.patterns import bound, evaluated_once

# Fixed value: the normalisation constant of the compound score.
ALPHA = 15

# How many lists the known words are dealt to.
LISTS = 1024

# What a token adds to the sums of its text.
SUMS = ("p", "n", "s", "loaded", "polarity", "polarities", "subjectivity", "subjectivities", "vectors")


def tokens(text: Column) -> Column:
    """Lower-case runs of ASCII letters, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0))


def assessed_tokens(texts: DataFrame, lexicon: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """One row per token that the lexicon knows: id, position, token and its scores."""
    spread = texts.select(id_column, F.posexplode(tokens(F.col(text_column))).alias("pos", "token"))
    return spread.join(lexicon, "token")


def _per_text(texts, lexicon, id_column, text_column, aggregates) -> DataFrame:
    spread = texts.select(id_column, F.explode_outer(tokens(F.col(text_column))).alias("token"))
    return spread.join(lexicon, "token", "left").groupBy(id_column).agg(*aggregates)


def _sums_of_valence() -> list[Column]:
    v = F.coalesce("valence", F.lit(0).cast("decimal(10,4)"))
    return [
        F.sum(F.when(v > 0, v + 1).otherwise(0)).cast("double").alias("_p"),
        F.sum(F.when(v < 0, 1 - v).otherwise(0)).cast("double").alias("_n"),
        F.count_if(F.col("token").isNotNull() & (v == 0)).cast("double").alias("_u"),
        F.sum(v).cast("double").alias("_s"),
    ]


def _rounded(c: Column, digits: int) -> Column:
    """Ties go by the decimal value and not by the last bit of a double: 0.1625, computed
    as 0.16249999999999998, is 0.163."""
    return F.round(F.round(c, 14), digits)


def _shares_and_compound(p: Column, n: Column, u: Column, s: Column) -> list[Column]:
    shares = (("neg", n), ("neu", u), ("pos", p))
    return [
        *(_rounded(F.coalesce(F.try_divide(part, p + n + u), F.lit(0.0)), 3).alias(name) for name, part in shares),
        _rounded(s / F.sqrt(s * s + ALPHA), 4).alias("compound"),
    ]


def _mean(total: Column, count: Column) -> Column:
    return F.coalesce(F.try_divide(total, count), F.lit(0.0))


def _means_of_assessed() -> list[Column]:
    return [_mean(F.sum(c).cast("double"), F.count(c)).alias(c) for c in ("polarity", "subjectivity")]


def _exact(lexicon: DataFrame, *scores: str) -> DataFrame:
    """Scores as decimals: their sums do not depend on the order of addition."""
    return lexicon.select("token", *(F.col(c).cast("decimal(10,4)").alias(c) for c in scores))


def lexicon_sentiment(texts: DataFrame, lexicon: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``neg, neu, pos, compound`` per text.

    Shares weigh each positive (negative) word one more than its valence and each
    other word one; compound is the valence sum squeezed into -1..1.
    """
    sums = _per_text(texts, _exact(lexicon, "valence"), id_column, text_column, _sums_of_valence())
    return sums.select(id_column, *_shares_and_compound(*(F.col(c) for c in ("_p", "_n", "_u", "_s"))))


def lexicon_polarity(texts: DataFrame, lexicon: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Mean ``polarity`` and ``subjectivity`` over the assessed words, 0 without any."""
    exact = _exact(lexicon, "polarity", "subjectivity")
    return _per_text(texts, exact, id_column, text_column, _means_of_assessed())


def _list_of(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(LISTS)).cast("int")


def _word_lists(lexicon: DataFrame, vectors: DataFrame | None, width: int | None) -> Column:
    """What is known of the words, as one value: ``LISTS`` lists, of which a word is in that of its hash.

    Each entry holds what a token that has it adds to the sums of its text, scores as whole ten-thousandths.
    """
    entries = _exact(lexicon, "valence", "polarity", "subjectivity").withColumn("known", F.lit(True))
    if vectors is None:
        entries = entries.withColumn("_vector", F.lit(None))
    else:
        entries = entries.join(_one_vector(vectors, "token", "vector", width), "token", "full")
    v = F.coalesce("valence", F.lit(0).cast("decimal(10,4)"))
    adds = {"p": F.when(v > 0, v + 1), "n": F.when(v < 0, 1 - v), "s": v, "polarity": F.col("polarity"), "subjectivity": F.col("subjectivity")}
    counted = {"loaded": v != 0, "polarities": F.col("polarity").isNotNull(), "subjectivities": F.col("subjectivity").isNotNull(),
               "vectors": F.col("_vector").isNotNull()}
    entry = F.struct(
        "token", F.coalesce("known", F.lit(False)).alias("known"), F.col("_vector").cast("array<double>").alias("vector"),
        *(F.coalesce((c * 10_000).cast("bigint"), F.lit(0)).alias(n) for n, c in adds.items()),
        *(c.cast("bigint").alias(n) for n, c in counted.items()),
    )
    lists = entries.filter("token IS NOT NULL").groupBy(_list_of(F.col("token")).alias("_list")).agg(F.collect_list(entry).alias("_words"))
    by_number = F.map_from_entries(F.collect_list(F.struct("_list", "_words")))
    numbers = F.sequence(F.lit(0), F.lit(LISTS - 1))
    return lists.agg(by_number.alias("_lists")).select(F.transform(numbers, lambda i: F.try_element_at("_lists", i))).scalar()


def _sums_of_text(text: Column, word_lists: Column, width: int | None) -> Column:
    """The sums of one text, computed where it stands, as a struct."""

    def hits_in(lists: Column, words: Column) -> Column:
        def entries(word: Column, pos: Column) -> Column:
            same = F.filter(F.get(lists, _list_of(word)), lambda e: e["token"] == word)
            return F.transform(same, lambda e: F.struct(pos.alias("pos"), e.alias("entry")))

        return F.flatten(F.filter(F.transform(words, entries), lambda found: found.isNotNull()))

    def plus(sums: Column, hit: Column) -> Column:
        added = F.zip_with(sums, hit["entry"]["vector"], lambda x, y: F.coalesce(x + y, x, y))
        return F.when(hit["entry"]["vector"].isNotNull(), added).otherwise(sums)

    def sums(words: Column, hits: Column) -> Column:
        def total(n: str) -> Column:
            return F.aggregate(hits, F.lit(0).cast("bigint"), lambda a, h: a + h["entry"][n])

        known = F.filter(hits, lambda h: h["entry"]["known"])
        words_known = F.transform(known, lambda h: F.struct(h["pos"].alias("pos"), h["entry"]["token"].alias("token")))
        none = F.array_repeat(F.lit(None).cast("double"), width or 0)
        return F.struct(F.size(words).cast("bigint").alias("size"), *(total(n).alias(n) for n in SUMS), words_known.alias("hits"),
                        F.aggregate(hits, none, plus).alias("vector"))

    words = F.coalesce(tokens(text), F.array().cast("array<string>"))
    return bound(word_lists, lambda lists: bound(words, lambda w: bound(hits_in(lists, w), lambda hits: sums(w, hits))))


def _with_sums(texts, lexicon, text_column, vectors, width) -> DataFrame:
    known = texts.select("*", _word_lists(lexicon, vectors, width).alias("_lists"))
    sums = known.select(*texts.columns, _sums_of_text(F.col(text_column), F.col("_lists"), width).alias("_sums"))
    return sums.select(*texts.columns, evaluated_once(F.col("_sums")).alias("_sums"))


def _scores_of_sums(sums: Callable[[str], Column], vector: Sequence[Column]) -> list[Column]:
    """All scores from the sums, by their names: ``SUMS``, ``size`` and ``hits``."""
    p, n, s, polarity, subjectivity = (sums(c) / 10_000 for c in ("p", "n", "s", "polarity", "subjectivity"))
    neutral = (sums("size") - sums("loaded")).cast("double")
    return [
        *_shares_and_compound(p, n, neutral, s),
        _mean(polarity, sums("polarities")).alias("polarity"),
        _mean(subjectivity, sums("subjectivities")).alias("subjectivity"),
        F.transform(sums("hits"), lambda h: h["token"]).alias("word_sample"),
        *(F.when(sums("vectors") > 0, v).alias("vector") for v in vector),
    ]


def row_scores(
    texts: DataFrame, lexicon: DataFrame, text_column: str, vectors: DataFrame | None = None, width: int | None = None
) -> DataFrame:
    """Each row with the sentiment, polarity and word sample of its text, as :func:`all_scores` gives them.

    A text is folded where it stands: neither it nor its words are moved or sorted, whatever its length. For this
    every task holds the lexicon and the vectors of its words, which should therefore be tables that could be broadcast.
    """
    width = vector_width(vectors) if vectors is not None and width is None else width
    sums = F.col("_sums")
    mean = [F.transform(sums["vector"], lambda x: x / sums["vectors"])] if vectors is not None else []
    scores = _scores_of_sums(sums.getField, mean)
    return _with_sums(texts, lexicon, text_column, vectors, width).select(*texts.columns, *scores)


def all_scores(
    texts: DataFrame, lexicon: DataFrame, id_column: str, text_column: str, carry: Sequence[str] = (),
    vectors: DataFrame | None = None, width: int | None = None,
) -> DataFrame:
    """Sentiment, polarity and word sample per id, from one pass over the tokens of its texts.

    The columns in ``carry`` come along with the sums of a text, so that they need no join back.
    With ``vectors`` (``token, vector``, see :func:`document_vector`) the same pass adds the mean ``vector``.
    Each text is folded in place first, as in :func:`row_scores`, which does it all where each row has an id of its own:
    the exchange gets one row per text, with its sums and the words that the lexicon knows.
    """
    width = vector_width(vectors) if vectors is not None and width is None else width
    sums = _with_sums(texts.select(id_column, *carry, F.col(text_column).alias("_text")), lexicon, "_text", vectors, width)
    numbers = [F.sum(F.col("_sums.vector")[i]).alias(f"_x{i}") for i in range(width)] if vectors is not None else []
    folded = sums.groupBy(F.col(id_column).alias("_id")).agg(
        *(F.sum(f"_sums.{c}").alias(c) for c in ("size", *SUMS)),
        F.sort_array(F.flatten(F.collect_list("_sums.hits"))).alias("hits"), *numbers,
        *([F.first(F.struct(*carry)).alias("_carried")] if carry else []),
    )
    means = F.array(*(F.col(f"_x{i}") / F.col("vectors") for i in range(len(numbers)))).cast("array<double>")
    carried = [F.col("_carried").getField(c).alias(c) for c in carry]
    return folded.select(F.col("_id").alias(id_column), *carried, *_scores_of_sums(F.col, [means] if vectors is not None else []))


def word_sample(texts: DataFrame, lexicon: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The assessed words per text, in order; texts without any are absent.

    A list is never longer than the text it was read from.
    """
    hits = assessed_tokens(texts, lexicon.select("token"), id_column, text_column)
    in_order = F.sort_array(F.collect_list(F.struct("pos", "token")))
    return hits.groupBy(id_column).agg(F.transform(in_order, lambda h: h["token"]).alias("word_sample"))


def mean_vector(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """The element-wise mean of all vectors of an id, as ``array<double>``.

    Grouped by (id, dimension) with map-side combining, so a hot id costs the
    exchange one row per dimension and task; the lists then hold one entry per
    dimension.
    """
    spread = vectors.select(id_column, F.posexplode(vector_column).alias("dim", "x"))
    means = spread.groupBy(id_column, "dim").agg(F.avg("x").alias("m"))
    in_order = F.sort_array(F.collect_list(F.struct("dim", "m")))
    return means.groupBy(id_column).agg(F.transform(in_order, lambda e: e["m"]).alias(vector_column))


def vector_width(vectors: DataFrame, vector: str = "vector") -> int:
    """How many numbers the vectors have: the largest size, from one scan of their table."""
    return vectors.agg(F.max(F.size(vector))).first()[0] or 0


def _one_vector(vectors: DataFrame, token: str, vector: str, width: int) -> DataFrame:
    """One vector per token, of several the largest, of which each has ``width`` numbers."""
    fits = F.size("_vector") == width
    wrong = F.raise_error(F.concat(F.lit(f"not of {width} numbers: the vector of "), F.col(token)))
    one = vectors.filter(F.col(vector).isNotNull()).groupBy(token).agg(F.max(vector).alias("_vector"))
    return one.select(token, F.when(fits, F.col("_vector")).otherwise(wrong).alias("_vector"))


def _vector_sums(width: int) -> list[Column]:
    """A sum per number of the vectors, and how many vectors there are."""
    return [
        *(F.sum(F.col("_vector")[i].cast("double")).alias(f"_x{i}") for i in range(width)),
        F.count("_vector").alias("_vectors"),
    ]


def _mean_of_sums(width: int) -> Column:
    means = F.array(*(F.col(f"_x{i}") / F.col("_vectors") for i in range(width))).cast("array<double>")
    return F.when(F.col("_vectors") > 0, means)


def document_vector(
    texts: DataFrame, vectors: DataFrame, id_column: str, text_column: str, token: str = "token", vector: str = "vector",
    width: int | None = None,
) -> DataFrame:
    """``id_column`` and the mean of the vectors of a text's tokens, each occurrence counted, as
    ``array<double>``; tokens without a vector are left out, and NULL is the vector of a text without any.

    ``vectors`` has one row per token; of several the largest counts. All have ``width`` numbers, another size is an
    error; without ``width`` it is read from their table. Each number is a sum of its own, so that
    a token stays one row, and the exchange carries one row of sums per text.
    """
    width = vector_width(vectors, vector) if width is None else width
    words = texts.select(id_column, F.posexplode_outer(tokens(F.col(text_column))).alias("_pos", token))
    found = words.join(_one_vector(vectors, token, vector, width), token, "left")
    found = found.filter(F.col("_vector").isNotNull() | (F.coalesce("_pos", F.lit(0)) == 0))  # a text keeps its first
    return found.groupBy(id_column).agg(*_vector_sums(width)).select(id_column, _mean_of_sums(width).alias(vector))
