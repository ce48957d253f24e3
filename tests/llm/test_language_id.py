"""Language identification: the lattice against all segmentations, and held-out accuracy."""

from __future__ import annotations

import math
import os
import random

import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as entry
from sluice.llm import language_id as L

DOCS = "doc_id long, text string, lang string, score int, lang_pred string, row string"


def segmentations(word: str):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        for rest in segmentations(word[n:]):
            yield [word[:n], *rest]


def chance(pieces, index, probability, segments):
    out = np.ones(probability.shape[1])
    for s in segments:
        if s in index:
            out = out * probability[index[s]]
        elif len(s) == 1:
            out = out * probability[0]
        else:
            return out * 0
    return out


@pytest.fixture(scope="module")
def lattice():
    rnd = random.Random(4)
    pieces = sorted({"a", "b", "ab", "ba", "aab", L.WORD_START, L.WORD_START + "a", "bb", "é"})
    probability = np.array([[rnd.random() for _ in range(2)] for _ in range(len(pieces) + 1)]) / 5
    return L.Lattice(pieces, probability), pieces, probability


def test_scores_sum_all_segmentations(lattice):
    own, pieces, probability = lattice
    index = {p: i for i, p in enumerate(pieces, 1)}
    words = ["a", "ab", "aabab", "xé", "bbabaa", "b", "zzz"]
    got = own.scores(words)
    for word, scores in zip(words, got, strict=True):
        total = sum(chance(pieces, index, probability, s) for s in segmentations(L.WORD_START + word))
        assert np.allclose(scores, np.log(total))


def test_expected_counts_are_those_of_all_segmentations(lattice):
    own, pieces, probability = lattice
    index = {p: i for i, p in enumerate(pieces, 1)}
    words, counts = ["ab", "aabab", "xa"], np.array([1.0, 3.0, 2.0])
    want = np.zeros(len(probability))
    for word, n in zip(words, counts, strict=True):
        weighted = [(s, chance(pieces, index, probability, s)[1]) for s in segmentations(L.WORD_START + word)]
        total = sum(w for _, w in weighted)
        for segments, weight in weighted:
            for s in segments:
                want[index.get(s, 0)] += n * weight / total
    assert np.allclose(own.expected(words, counts, 1), want)


@pytest.mark.parametrize("word", ["ab" * 20, "x" * 90 + "ab" * 300, "ab" * 3000])
def test_long_words_give_their_counts(lattice, word):
    _, pieces, probability = lattice
    small = L.Lattice(pieces, probability * 1e-4)
    found = small.expected([word], np.array([2.0]), 1)
    letters = np.array([1, *map(len, pieces)])
    assert (found * letters).sum() == pytest.approx(2.0 * (len(word) + 1))


def test_long_words_do_not_underflow(lattice):
    own, pieces, probability = lattice
    long = own.scores(["ab" * 3000])
    assert np.isfinite(long).all() and (long < -1000).all()
    short = own.scores(["ab" * 20])
    table = next(own._groups(["ab" * 20]))[1]
    plain = [np.ones(2)]
    padded = np.vstack([probability, np.zeros(2)])
    for end in range(1, table.shape[1] + 1):
        plain.append(sum(plain[end - n] * padded[table[0, end - 1, n - 1]] for n in range(1, min(table.shape[2], end) + 1)))
    assert np.allclose(short[0], np.log(plain[-1]))


def labelled(spark):
    rnd = random.Random(1)
    words = {"xx": ["the", "thing", "other"], "yy": ["für", "schön", "über"]}
    rows = []
    for i in range(60):
        lang = ["xx", "yy"][i % 2]
        rows.append((i, " ".join(rnd.choice(words[lang]) for _ in range(20)), lang, 1, "p", "q"))
    return spark.createDataFrame(rows, DOCS)


def test_odd_rows(spark):
    pieces = L.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    model = L.learn(labelled(spark).union(spark.createDataFrame([(None, None, "zz", 0, "", ""), (7, "text", None, 0, "", "")], DOCS)), pieces)
    assert model.languages == ["xx", "yy"]
    rows = [(1, None), (2, ""), (3, "123 !? ... \u00bd \u00b2"), (4, "the other"), (None, "SCHÖN"), (4, "the other"), (5, "über " * 50_000), (6, "ŋ")]
    docs = spark.createDataFrame([(*r, "no", 9, "no", "no") for r in rows], DOCS)
    found = [(r.row.doc_id, r.row.lang_pred, r.lang_pred, r.score) for r in L.identify(docs, model, keep=["doc_id", "lang_pred"]).collect()]
    assert [f[2] for f in found][:7] == ["und", "und", "und", "xx", "yy", "xx", "yy"] and found[3] == found[5]
    assert all(f[1] == "no" and 0 <= f[3] <= 1 for f in found) and [f[3] for f in found[:3]] == [0, 0, 0]
    assert found[7][2] == "xx"  # equally likely: the first by name


def test_unknown_letters_speak_for_no_language(spark):
    few = labelled(spark).filter("lang = 'xx' OR doc_id < 6")  # yy has a tenth of the words
    model = L.learn(few, L.read_pieces(public_tokenizers.path("piece_bpe_32k.model")))
    assert model.probability[0, 0] == model.probability[0, 1] > 0
    assert all(model.probability[1:].min(axis=0) >= model.probability[0])
    assert abs(model.probability[1:].sum(axis=0) - 1).max() < 1e-9


def test_long_pieces_are_used(spark):
    pieces = L.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    longest = max(pieces, key=len)
    assert len(longest) > 8
    word = longest.lstrip(L.WORD_START)
    docs = spark.createDataFrame([(i, f"{word} a", "xx", 1, "", "") for i in range(9)], DOCS)
    model = L.learn(docs, pieces)
    assert model.probability[1 + pieces.index(longest), 0] > 1e-3


def test_nothing_to_learn_from(spark):
    docs = labelled(spark)
    model = L.learn(docs.limit(0), ["a"])
    assert {(r.lang_pred, r.score) for r in L.identify(docs, model).collect()} == {("und", 0.0)}
    assert L.identify(docs.limit(0), model).collect() == []


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_LANGUAGES", 1)
    with pytest.raises(ValueError, match="languages"):
        L.learn(labelled(spark), ["a"])


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = entry.queries()["op2_language_id"](spark, sf_dir)
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").filter("held_out").collect()
    assert len(rows) > 250 and sum(r.lang == r.lang_pred for r in rows) >= 0.99 * len(rows)
    assert not math.isnan(sum(r.score for r in rows))


def test_letters_by_unicode_category():
    found = {t: L.has_letter(L.words_of(t)) for t in ("一二三", "½", "½ ⅓", "½ a", "", "12", "Ⅷ", "é", "〇")}
    assert found == {"一二三": True, "½": False, "½ ⅓": False, "½ a": True, "": False, "12": False, "Ⅷ": False, "é": True, "〇": False}
