"""Queries of text scoring, routing and the scored hand-off."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions import cleaning
from sluice.operators import scored, scoring
from sluice.queries.registry import query, spread_table, table

# A small lexicon over frequent words of the test texts: valence, polarity, subjectivity.
LEXICON = [
    ("the", 0.1, 0.05, 0.1), ("of", -0.2, -0.05, 0.2), ("and", 0.3, 0.1, 0.1), ("to", 0.4, 0.15, 0.3),
    ("in", 1.1, 0.4, 0.5), ("is", -0.9, -0.3, 0.6), ("that", -1.5, -0.5, 0.75), ("it", 1.9, 0.6, 0.8),
    ("for", 2.4, 0.7, 0.9), ("was", -2.1, -0.65, 0.85), ("on", 0.6, 0.2, 0.35), ("with", 1.3, 0.45, 0.4),
    ("be", 0.8, 0.25, 0.3), ("by", -0.7, -0.2, 0.2), ("this", -1.2, -0.35, 0.45), ("are", 1.6, 0.5, 0.55),
    ("der", 0.9, 0.3, 0.5), ("die", -1.4, -0.45, 0.7), ("und", 0.5, 0.2, 0.25), ("schen", -1.8, -0.55, 0.9),
    ("la", 0.7, 0.25, 0.4), ("le", -0.6, -0.2, 0.3), ("et", 1.2, 0.35, 0.5), ("les", -1.1, -0.3, 0.6),
    ("el", 0.9, 0.3, 0.45), ("que", -1.0, -0.35, 0.55), ("los", 1.4, 0.4, 0.65), ("una", -1.6, -0.5, 0.8),
]

_LEXICON_SQL = "(VALUES " + ", ".join(
    f"('{w}', CAST({v} AS DECIMAL(10,4)), CAST({p} AS DECIMAL(10,4)), CAST({s} AS DECIMAL(10,4)))" for w, v, p, s in LEXICON
) + ") AS lexicon(token, valence, polarity, subjectivity)"

_TOKENS_SQL = "SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM documents"


# Vectors for the words of the lexicon: the embedding of the word's place in it.
DOCUMENT_VECTOR = f"""WITH words AS (SELECT * FROM (VALUES {", ".join(f"('{w[0]}', {i})" for i, w in enumerate(LEXICON))}) AS v(token, vec_id)),
    spread AS (SELECT token, generate_subscripts(embedding, 1) - 1 AS dim, unnest(embedding)::DOUBLE AS x
        FROM words JOIN embeddings USING (vec_id))
    SELECT doc_id, dim, avg(x) AS x FROM ({_TOKENS_SQL}) JOIN spread USING (token) GROUP BY doc_id, dim"""


#: Numbers of an embedding.
VECTOR_WIDTH = 64


def token_vectors(spark, sf_dir):
    words = spark.createDataFrame([(w[0], i) for i, w in enumerate(LEXICON)], "token string, vec_id bigint")
    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return F.broadcast(words.join(embeddings, "vec_id").select("token", "vector"))


def lexicon(spark):
    """A constant of 28 rows, so the caller knows that it can be broadcast."""
    return F.broadcast(spark.createDataFrame(LEXICON, "token string, valence double, polarity double, subjectivity double"))


SENTIMENT = f"""WITH sums AS (SELECT d.doc_id,
        CAST(coalesce(sum(valence + 1) FILTER (WHERE valence > 0), 0) AS DOUBLE) AS p,
        CAST(coalesce(sum(1 - valence) FILTER (WHERE valence < 0), 0) AS DOUBLE) AS n,
        CAST(count(t.token) FILTER (WHERE coalesce(valence, 0) = 0) AS DOUBLE) AS u,
        CAST(coalesce(sum(valence), 0) AS DOUBLE) AS s
        FROM documents d LEFT JOIN ({_TOKENS_SQL}) t USING (doc_id) LEFT JOIN {_LEXICON_SQL} USING (token)
        GROUP BY d.doc_id)
    SELECT doc_id, CASE WHEN p + n + u = 0 THEN 0.0::DOUBLE ELSE CAST(round(CAST(n / (p + n + u) AS DECIMAL(20, 14)), 3) AS DOUBLE) END AS neg,
    CASE WHEN p + n + u = 0 THEN 0.0::DOUBLE ELSE CAST(round(CAST(u / (p + n + u) AS DECIMAL(20, 14)), 3) AS DOUBLE) END AS neu,
    CASE WHEN p + n + u = 0 THEN 0.0::DOUBLE ELSE CAST(round(CAST(p / (p + n + u) AS DECIMAL(20, 14)), 3) AS DOUBLE) END AS pos,
    CAST(round(CAST(s / sqrt(s * s + 15) AS DECIMAL(20, 14)), 4) AS DOUBLE) AS compound FROM sums"""


CLEAN_SQL = r"""regexp_replace(regexp_replace(text, '[^\x00-\x7F]', '', 'g'), '[\t\n\v\f\r\x1c-\x1f ]{2,}', ' ', 'g')"""
SENTIMENT_OF_CLEAN = SENTIMENT.replace("lower(text)", f"lower({CLEAN_SQL})")


@query(SENTIMENT)
def lexicon_sentiment(spark, sf_dir):
    return scoring.lexicon_sentiment(spread_table(spark, sf_dir, "documents"), lexicon(spark), "doc_id", "text")


POLARITY = f"""SELECT d.doc_id, coalesce(CAST(sum(polarity) AS DOUBLE) / count(polarity), 0.0::DOUBLE) AS polarity,
    coalesce(CAST(sum(subjectivity) AS DOUBLE) / count(subjectivity), 0.0::DOUBLE) AS subjectivity
    FROM documents d LEFT JOIN ({_TOKENS_SQL}) USING (doc_id) LEFT JOIN {_LEXICON_SQL} USING (token)
    GROUP BY d.doc_id"""


@query(POLARITY)
def lexicon_polarity(spark, sf_dir):
    return scoring.lexicon_polarity(spread_table(spark, sf_dir, "documents"), lexicon(spark), "doc_id", "text")


SAMPLE = """SELECT doc_id, array_to_string(list_filter(regexp_extract_all(lower(text), '[a-z]+'),
    lambda w: w IN ({})), ' ') AS word_sample FROM documents""".format(", ".join(f"'{w[0]}'" for w in LEXICON))


@query(f"SELECT * FROM ({SAMPLE}) WHERE word_sample <> ''")
def word_sample(spark, sf_dir):
    found = scoring.word_sample(spread_table(spark, sf_dir, "documents"), lexicon(spark), "doc_id", "text")
    return found.select("doc_id", F.array_join("word_sample", " ").alias("word_sample"))


@query(
    f"""SELECT doc_id, compound, CASE WHEN compound < -0.5 THEN 'neg' ELSE 'pos' END AS label
    FROM ({SENTIMENT}) WHERE compound < -0.5 OR compound > 0.6"""
)
def sentiment_route(spark, sf_dir):
    return scored.route(lexicon_sentiment(spark, sf_dir)).select("doc_id", "compound", "label")


@query(
    """SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '[a-z]+'), ' ') AS words FROM documents"""
)
def clean_words(spark, sf_dir):
    """Word lists as text, ``['a', 'b']``, of whole documents, read back into words."""
    listed = F.concat(F.lit("['"), F.array_join(scoring.tokens(F.col("text")), "', '"), F.lit("']"))
    texts = spread_table(spark, sf_dir, "documents").select("doc_id", listed.alias("words"))
    return texts.select("doc_id", F.array_join(cleaning.word_list(F.col("words")), " ").alias("words"))


@query(
    """SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS dim, round(unnest(embedding)::DOUBLE, 4) AS x
    FROM embeddings"""
)
def parse_embedding(spark, sf_dir):
    """Vectors as text, ``['0.1', '-0.2']``, read back into numbers."""
    digits = F.transform("embedding", lambda x: cleaning.positional(F.round(x.cast("double"), 4)))
    listed = F.concat(F.lit("['"), F.array_join(digits, "', '"), F.lit("']"))
    texts = table(spark, sf_dir, "embeddings").select("vec_id", listed.alias("text"))
    spread = texts.select("vec_id", F.posexplode(cleaning.number_list(F.col("text"))).alias("dim", "x"))
    return spread.withColumn("dim", F.col("dim").cast("bigint"))


@query(
    """WITH spread AS (SELECT label, generate_subscripts(embedding, 1) - 1 AS dim, unnest(embedding)::DOUBLE AS x
        FROM embeddings)
    SELECT label, dim, round(avg(x), 6) AS mean FROM spread GROUP BY label, dim"""
)
def mean_vector(spark, sf_dir):
    means = scoring.mean_vector(table(spark, sf_dir, "embeddings"), "label", "embedding")
    spread = means.select("label", F.posexplode("embedding").alias("dim", "mean"))
    return spread.select("label", F.col("dim").cast("bigint").alias("dim"), F.round("mean", 6).alias("mean"))


def _thousandths(number: str) -> str:
    """The text of a number of thousandths between -0.999 and 0.999."""
    return f"concat(CASE WHEN {number} < 0 THEN '-' ELSE '' END, '0.', lpad(CAST(abs({number}) AS STRING), 3, '0'))"


_SCORE_NUMBERS = {
    "neg": "doc_id % 1000",
    "neu": "doc_id * 3 % 1000",
    "pos": "doc_id * 7 % 1000",
    "compound": "doc_id * 17 % 1999 - 999",
    "polarity": "doc_id * 13 % 1999 - 999",
    "subjectivity": "doc_id * 11 % 1000",
}


def scored_line(spark, sf_dir):
    """Scored documents as hand-off lines; every 89th has a score in exponent form."""
    scores = [F.expr(_thousandths(n)) for n in _SCORE_NUMBERS.values()]
    scores[0] = F.when(F.col("doc_id") % 89 == 0, "1e-05").otherwise(scores[0])
    line = F.concat_ws(
        ",",
        F.col("doc_id").cast("string"),
        *scores,
        F.lit("\"['good', 'bad']\""),
        F.expr("""concat('"[''0.', doc_id % 10, ''', ''-1.5'']"')"""),
        F.col("doc_id").cast("string"),
        F.concat(F.lit('"'), cleaning.ascii_only(F.col("text")), F.lit('"')),
    )
    return spread_table(spark, sf_dir, "documents").select(line.alias("value"))


_SCORED_OK = "doc_id % 89 <> 0"


@query(
    "SELECT "
    + ", ".join(f"(({n}) / 1000)::DOUBLE AS {name}" for name, n in _SCORE_NUMBERS.items())
    + f""", 'good bad' AS word_sample, CAST('0.' || (doc_id % 10) AS DOUBLE) AS first_dim, doc_id AS tweet_id,
    rtrim(rtrim(rtrim(trim('"' || {CLEAN_SQL} || '"', '"'), E' \\n\\t\\r\\x0b\\x0c'), '"'), E' \\n\\t\\r\\x0b\\x0c') AS tweet
    FROM documents WHERE {_SCORED_OK}"""
)
def scored_parse(spark, sf_dir):
    """Hand-off lines to typed rows; lines that do not match are left out here."""
    typed = scored.type_scored(scored.scored_lines(scored_line(spark, sf_dir))).filter("tweet_id is not null")
    return typed.select(
        *scored.SCORES,
        F.array_join("word_sample", " ").alias("word_sample"),
        F.get("tok2vec", F.lit(0)).alias("first_dim"),
        "tweet_id",
        "tweet",
    )


@query(
    f"""SELECT CASE WHEN {_SCORED_OK} THEN CASE WHEN doc_id * 17 % 1999 - 999 < -500 THEN 'neg'
    WHEN doc_id * 17 % 1999 - 999 > 600 THEN 'pos' ELSE 'neutral' END ELSE 'neutral' END AS label,
    count(*) AS n FROM documents GROUP BY 1"""
)
def scored_labels(spark, sf_dir):
    """Rows per label; unreadable lines are neutral."""
    typed = scored.type_scored(scored.scored_lines(scored_line(spark, sf_dir)))
    return typed.groupBy(scored.label_of_score(F.col("compound")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT doc_id, dim, round(x, 6) AS x FROM ({DOCUMENT_VECTOR})")
def document_vector(spark, sf_dir):
    """The mean vector of each document's words that have one."""
    docs = spread_table(spark, sf_dir, "documents")
    means = scoring.document_vector(docs, token_vectors(spark, sf_dir), "doc_id", "text", width=VECTOR_WIDTH)
    spread = means.select("doc_id", F.posexplode("vector").alias("dim", "x"))
    return spread.select("doc_id", F.col("dim").cast("bigint").alias("dim"), F.round("x", 6).alias("x"))
