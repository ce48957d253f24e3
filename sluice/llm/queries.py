"""The registered queries, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import decontaminate, html_templates, language_id, lm_bloom, minhash, packing, perspectives, phrases, quality, records, simhash, spelling, url_graph
from sluice.llm.common import remainder
from sluice.queries.registry import table
from sluice.scratch import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Registers a function under its name, with the SQL that must give the same rows."""

    def register(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op1_sql(rounds: int = 1000, damping: float = url_graph.DAMPING) -> str:
    """What seeds give away, followed link by link until it fades; a rank is all that arrives at a host."""
    ranks = f"""walks AS (
       SELECT 0 AS step, good, host, seed AS part FROM seeds
       UNION ALL SELECT step + 1, good, taker, sum({damping} * part * share)
       FROM walks JOIN shares ON shares.g = walks.good AND shares.giver = walks.host
       WHERE step < {rounds} GROUP BY step, good, taker)"""
    return rf"""
WITH RECURSIVE located AS (
       SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
              regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
     ruled AS (
       SELECT *, CASE WHEN '.' || host LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                      WHEN '.' || host LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
                      WHEN '.' || host LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
                      WHEN '.' || host LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
                      WHEN '.' || host LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule FROM located),
     edges AS (
       SELECT DISTINCT host AS src, translate(link, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst
       FROM located, unnest(regexp_extract_all(coalesce(html, ''), '{url_graph.LINK.replace("'", "''")}', 1)) AS t(link)
       WHERE host != '' AND host != translate(link, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')),
     flows AS (SELECT true AS g, src AS giver, dst AS taker FROM edges UNION ALL SELECT false, dst, src FROM edges),
     shares AS (SELECT *, 1.0::DOUBLE / count(*) OVER (PARTITION BY g, giver) AS share FROM flows),
     hosts AS (SELECT host, count(*) FILTER (rule IN ('org/', 'com/fr/')) AS a, count(*) AS n FROM ruled
               WHERE host != '' AND rule IS NOT NULL GROUP BY host),
     seeds AS (SELECT * FROM (
                 SELECT true AS good, host, {1 - damping}::DOUBLE * (a / n) AS seed FROM hosts
                 UNION ALL SELECT false, host, {1 - damping}::DOUBLE * ((n - a) / n) FROM hosts) WHERE seed > 0),
     {ranks},
     verdicts AS (SELECT host, coalesce(sum(part) FILTER (good), 0) AS trust, coalesce(sum(part) FILTER (NOT good), 0) AS distrust
                  FROM walks GROUP BY host)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN distrust > {url_graph.THRESHOLD} * (trust + distrust) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN verdicts USING (host)
"""


@query(op1_sql())
def op1_link_graph_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_graph.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query()
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder(F.col("doc_id"), 3) == 1
    pieces = language_id.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    model = language_id.learn(docs.filter(~held_out), pieces)
    predicted = language_id.identify(docs, model, keep=["doc_id"]).select("row.doc_id", "lang_pred", "score")
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query()
def op3_log_frequency_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), 7) == 2
    scores, model = lm_bloom.score_documents(docs, ~held_out)
    return scores.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )


@query()
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, max_bits=4)


@query()
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=2048)


@query()
def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "records")
    records.write_records(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    read = records.read_records(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


OP7_SQL = """
WITH t AS (SELECT conv_id, coalesce(turn, -1) AS turn, replace(coalesce(role, ''), '<|', '< |') AS role,
             replace(coalesce(text, ''), '<|', '< |') AS said,
             CASE WHEN count(*) OVER (PARTITION BY conv_id) > 512
                  THEN (rank() OVER (PARTITION BY conv_id ORDER BY coalesce(turn, -1)) - 1) // 512 ELSE 0 END::BIGINT AS block
           FROM conversations),
     placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id, block ORDER BY turn, role, said) AS place FROM t),
     speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role NOT IN ('system', '')),
     pieces AS (SELECT placed.conv_id, speaker, block, (place - 1) // 512 AS part, place, role = speaker AS own,
                  CASE WHEN role = speaker THEN '<|assistant|>' WHEN role = 'system' THEN '<|system|>'
                       WHEN role = '' THEN '<|user|>' ELSE '<|user|> name=' || role END || chr(10) AS head,
                  said || '<|end|>' AS body
                FROM placed JOIN speakers ON placed.conv_id IS NOT DISTINCT FROM speakers.conv_id),
     ended AS (SELECT *, sum(length(head) + length(body) + 1) OVER (
                 PARTITION BY conv_id, speaker, block, part ORDER BY place)::BIGINT - 1 AS last FROM pieces)
SELECT conv_id, speaker, block, part, count(*) AS n_turns, count(*) FILTER (own) AS n_own,
       string_agg(head || body || chr(10), '' ORDER BY place) AS text,
       coalesce(string_agg((last - length(body)) || '-' || last, ',' ORDER BY place) FILTER (own), '') AS mask
FROM ended GROUP BY conv_id, speaker, block, part
"""


@query(OP7_SQL)
def op7_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.rotate(table(spark, sf_dir, "conversations"))


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
           FROM documents),
     windows AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS k FROM d, unnest(range(1, len(w) - 6)) AS u(i)),
     twice AS (SELECT r, k FROM windows GROUP BY r, k HAVING count(*) > 1),
     places AS (SELECT r, count(DISTINCT p) AS n FROM windows JOIN twice USING (r, k), unnest(range(i, i + 8)) AS u(p)
                GROUP BY r),
     m AS (SELECT doc_id, t, w, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             coalesce(n, 0) AS n_repeat_words,
             length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper_letters,
             length(regexp_replace(t, '[^a-z]', '', 'g')) AS lower_letters,
             length(regexp_replace(t, '[^!]', '', 'g')) AS exclamations,
             len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS stutters,
             len(list_filter(w, lambda x: regexp_matches(x, '[^\x00-\x40\x5B-\x60\x7B-\x7F]'))) AS lettered
           FROM d LEFT JOIN places USING (r)),
     f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT 10 * n_symbols > n_words
         AND NOT 10 * upper_letters > 3 * (upper_letters + lower_letters)
         AND NOT 10 * exclamations > 3 * n_words
         AND NOT 2 * n_dup_lines > n_lines
         AND NOT 5 * stutters > n_words
         AND word_chars BETWEEN 2 * n_words AND 20 * n_words
         AND NOT 10 * lettered < 6 * n_words AS kept
FROM f
"""


@query(OP8_SQL)
def op8_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select("row.doc_id", *quality.MEASURES, "base_failed", "kept")


OP9_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
     b AS (SELECT CAST(item_id AS VARCHAR) AS item,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
     windows AS (SELECT DISTINCT item, least(len(w), 10) AS n, list_aggregate(w[i:i + least(len(w), 10) - 1], 'string_agg', ' ') AS k
                 FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i) WHERE len(w) > 0),
     runs AS (SELECT r, i, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS k
              FROM d, (SELECT DISTINCT n FROM windows) AS s, unnest(range(1, len(w) - n + 2)) AS t(i)),
     hits AS (SELECT r, i, windows.n, item FROM runs JOIN windows USING (k)),
     places AS (SELECT r, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(p) GROUP BY r),
     names AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
               FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN names USING (r)
"""


@query(OP9_SQL)
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["first"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query()
def op10_template_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_templates.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


#: Shingle sets, their overlaps, and the links followed from every document.
OP11_SQL = r"""
WITH RECURSIVE worded AS (
       SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x != '') AS w FROM documents),
     sets AS (
       SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
              ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM worded),
     members AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
     links AS (
       SELECT a.doc_id AS a, b.doc_id AS b FROM members a JOIN members b USING (shingle)
       WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
       GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
     ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
     reached AS (SELECT DISTINCT a AS doc_id, a AS other FROM ways
                 UNION SELECT reached.doc_id, ways.b FROM reached JOIN ways ON ways.a = reached.other),
     lowest AS (SELECT doc_id, min(other) AS low FROM reached GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(low, doc_id) AS component_id,
       doc_id = coalesce(low, doc_id) AS kept FROM sets LEFT JOIN lowest USING (doc_id)
"""


@query(OP11_SQL)
def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=5, percent=85)


@query()
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), least_length=5, least_count=3, factor=2, one_in=97)


OP13_SQL = r"""
WITH pieces AS (
       SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
     worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x != '') AS w FROM pieces),
     grams AS (SELECT lang, s.n AS words, array_to_string(w[i:i + s.n - 1], ' ') AS phrase
               FROM worded, (VALUES (1), (2), (3)) AS s(n), unnest(range(1, len(w) - s.n + 2)) AS t(i)),
     counts AS (SELECT lang, words, phrase, count(*) AS f FROM grams GROUP BY ALL),
     totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE words = 1 GROUP BY lang),
     candidates AS (SELECT * FROM counts WHERE words > 1 AND f >= 10),
     cuts AS MATERIALIZED (SELECT lang, phrase, words, f AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
                array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest FROM candidates, unnest(range(1, words)) AS t(k)),
     headed AS MATERIALIZED (SELECT cuts.*, x.f AS l FROM cuts JOIN counts x ON x.lang = cuts.lang AND x.phrase = head),
     scored AS (SELECT headed.*, y.f AS r, (1000000::HUGEINT * a * a) // (l::HUGEINT * y.f) AS score
                FROM headed JOIN counts y ON y.lang = headed.lang AND y.phrase = rest),
     lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
     longer AS (SELECT lang, array_to_string(string_split(phrase, ' ')[i:i + 1], ' ') AS phrase, max(f) AS f
                FROM candidates, unnest([1, 2]) AS t(i) WHERE words = 3 GROUP BY ALL),
     kept AS (SELECT lowest.* FROM lowest LEFT JOIN longer USING (lang, phrase) WHERE longer.f IS NULL OR 100 * longer.f < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
       CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""


@query(OP13_SQL)
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(
        table(spark, sf_dir, "documents"), least_words=2, most_words=3, least_count=10, inside_percent=50, first=2000
    )
