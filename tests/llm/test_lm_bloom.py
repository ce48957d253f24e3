"""The log-frequency filter against exact counts, and scores against a plain computation."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import lm_bloom as B
from sluice.llm import segments

DOCS = "doc_id long, text string, n_tokens string, bucket int, training string"


def texts():
    rnd = random.Random(6)
    vocabulary = [f"w{i}" for i in range(150)] + ["The", "é", "ÉÀ"]
    made = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, 2, 30, 400]))) for _ in range(80)]
    rows = [(i, t) for i, t in enumerate(made)]
    return [*rows, (200, None), (201, "\t\n"), (202, "new words only"), rows[4], rows[4], (None, rows[7][1]), (203, rows[7][1].upper())]


def words_of(text):
    return [*(text or "").encode().lower().split(), None]


def test_tokens_are_the_words_and_an_end():
    hasher, raw = segments.WordHasher(B.KEY), [b"", b" A b\tA ", b"b", b"\x0b", "é\xa0x É".encode()]
    found, bounds = B.tokens(raw, hasher)
    assert np.diff(bounds).tolist() == [1, 4, 2, 1, 3]
    assert found[1] == found[3] and found[2] == found[5] and found[0] == found[4] == B.END
    assert len(set(found.tolist())) == 5


def test_hashes_do_not_depend_on_the_place():
    hasher = segments.WordHasher(B.KEY)
    both = B.tokens([b"some words here", b"here some"], hasher)[0]
    alone = B.tokens([b"here"], segments.WordHasher(B.KEY))[0]
    assert both[2] == alone[0] == both[4]


def test_levels_begin_at_one_and_grow():
    first = B.thresholds()
    assert first[:4].tolist() == [1, 2, 3, 4] and (np.diff(first) > 0).all() and first[-1] > 1e11
    assert B.level_of(np.array([1, 2, 3, 10**9])).tolist()[:3] == [0, 1, 2]


def test_packing_of_numbers():
    values = np.array([0, 1, 255, 256, 2**47, 2**63], np.uint64)
    assert B.expanded(B.squeezed(values)).tolist() == values.tolist()


@pytest.fixture(scope="module")
def model(spark):
    rows = [(t,) for _, t in texts()]
    df = spark.createDataFrame(rows, "text string").repartition(3)
    counts = B.word_counts(df)
    total, types = counts.agg(F.sum("n"), F.count("*")).first()
    return B.build(B.levels(df), total, types), counts


def test_no_count_is_read_too_low(model):
    own, counts = model
    exact = Counter(w for _, t in texts() for w in words_of(t))
    pairs = Counter(p for _, t in texts() for w in [words_of(t)] for p in zip([False, *w], w, strict=False))
    assert (own.tokens, own.types) == (sum(exact.values()), len(exact))
    hashes = {w: (B.tokens([w], segments.WordHasher(B.KEY))[0][0] if w else np.uint64(B.END)) for w in exact}
    keys = np.array([hashes[w] for w in exact], np.uint64)
    read = own.counts(B.word_keys(keys))
    lower = [B.thresholds()[B.level_of(np.array([c]))[0]] for c in exact.values()]
    assert (read >= lower).all() and np.mean(read <= np.array(list(exact.values())) * 1.3 + 1) > 0.98
    some = [(a, b) for a, b in pairs if a is not False and a is not None]
    found = own.counts(B.pair_keys(np.array([hashes[a] for a, _ in some], np.uint64), np.array([hashes[b] for _, b in some], np.uint64)))
    many = np.array([pairs[p] for p in some])
    assert (found >= B.thresholds()[B.level_of(many)]).all() and np.mean(found[many == 1] == 1) > 0.98
    assert own.fill() < 0.5


def test_one_filter_is_bounded_and_leaves_nothing_out(spark, monkeypatch):
    levels, least = B.levels(spark.createDataFrame([(t,) for _, t in texts()], "text string")), B.LEAST_BLOCK * B.BLOCKS
    with pytest.raises(ValueError, match="max_bits"):
        B.build(levels, 1, 1, max_bits=least // 2)
    monkeypatch.setattr(B, "BITS_PER_LEVEL", 20_000)
    with pytest.raises(ValueError, match="more than"):
        B.build(levels, 1, 1, max_bits=least)


def test_a_pair_seen_once_counts(spark):
    rows = [(0, "a b"), (1, "c d"), (10, "a b"), (11, "a d")]
    score = {r.doc_id: r.score for r in B.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") < 10)[0].collect()}
    assert score[10] > score[11]  # by little: no pair occurs again in the training texts, so the weight is the largest
    rows += [(2, "e f"), (3, "e f"), (4, "g h"), (5, "g h")]
    score = {r.doc_id: r.score for r in B.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") < 10)[0].collect()}
    assert score[10] > score[11] + 0.1


def plain_scores(rows, counts, total, types):
    """Scores from quantised counts in dictionaries, under the weight that suits the training texts best."""
    first = B.thresholds()

    def read(n):
        level = int(B.level_of(np.array([n]))[0])
        return (first[level] + first[level + 1] - 1) / 2 if n else 0.0

    def pairs_of(text):
        own = words_of(text)
        return list(zip([False, *own], own, strict=False))

    trained = [t for i, t in rows if i is None or i % 3 != 1]
    pairs = Counter(p for t in trained for p in pairs_of(t))
    contexts = Counter(counts) + Counter({False: len(trained)})

    def score(text, weight, out):
        log = 0.0
        for before, word in pairs_of(text):
            context, single = (max(0.0, read(n) - out) for n in (contexts[before], counts[word]))
            pair = max(0.0, min(read(pairs[before, word]), read(contexts[before])) - out)
            alone = min((single + 1) / (total + types + 1 - out), 1.0)
            log += math.log10((pair + weight * alone) / (context + weight))
        return log

    best = max(B.WEIGHTS, key=lambda w: sum(score(t, w, 1) for t in trained))
    return [score(t, best, 0) for _, t in rows]


@pytest.mark.parametrize("buckets", ["2", "7"])
def test_scores_equal_a_plain_computation(spark, buckets):
    rows = texts()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", buckets)
    try:
        docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], DOCS).repartition(3)
        scored, own = B.score_documents(docs, F.coalesce(F.col("doc_id") % 3 != 1, F.lit(True)))
        got = sorted(((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 9)) for r in scored.collect()), key=str)
        scores = [r.score for r in scored.collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    counts = Counter(w for i, t in rows if i is None or i % 3 != 1 for w in words_of(t))
    total, types = sum(counts.values()), len(counts)
    want = []
    for doc_id, text in rows:
        own_words = words_of(text)
        base = sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in own_words)
        want.append((doc_id, len(own_words), sum(counts[w] > 0 for w in own_words), round(base, 9)))
    assert got == sorted(want, key=str)
    assert sorted(scores) == pytest.approx(sorted(plain_scores(rows, counts, total, types)), rel=0.02)
    assert (own.tokens, own.types) == (total, types) and all(s <= 0 and math.isfinite(s) for s in scores)


@pytest.mark.parametrize("buckets", ["2", "7"])
def test_dealt_filters_forget_nothing(spark, monkeypatch, buckets):
    monkeypatch.setattr(B, "BITS_PER_LEVEL", 20_000)
    monkeypatch.setattr(B, "SET_AT_ONCE", 1 << 20)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", buckets)
    try:
        docs = spark.createDataFrame([(*r, "x", 1, "y") for r in texts()], DOCS).repartition(3)
        training, least = F.coalesce(F.col("doc_id") % 3 != 1, F.lit(True)), B.LEAST_BLOCK * B.BLOCKS
        whole, one = B.score_documents(docs, training, max_bits=1 << 40)
        dealt, several = B.score_documents(docs, training, max_bits=least)
        want, got = (sorted((tuple(r) for r in x.collect()), key=str) for x in (whole, dealt))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert 8 * one.bits.size == several.bits > least and several.parts() == several.bits // least
    assert got == want


def test_repeated_passages_are_likelier(spark):
    rnd = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(40))
    plain = [" ".join(f"p{rnd.randrange(40)}" for _ in range(40)) for _ in range(40)]
    docs = spark.createDataFrame([(i, passage if i % 2 else plain[i]) for i in range(40)] + [(100, passage), (101, plain[1])], "doc_id long, text string")
    scored, _ = B.score_documents(docs, F.col("doc_id") < 100)
    score = {r.doc_id: (r.score, r.base_score) for r in scored.collect()}
    assert score[100][0] > score[101][0] + 5 and score[100][0] > score[100][1]


def test_nothing_to_learn_from_and_nothing_to_score(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    scored, own = B.score_documents(docs, F.lit(False))
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.base_score) for r in scored.collect()) == [(1, 3, 0, 0.0), (2, 1, 0, 0.0)]
    assert B.score_documents(docs.limit(0), F.lit(True))[0].collect() == []
