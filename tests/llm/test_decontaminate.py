"""Test items found by the automaton against a search of every window."""

from __future__ import annotations

import random

import pytest

from sluice.llm import decontaminate as D

DOCS = "doc_id long, text string, spans string, n_words int"


def longest_runs(words, sequences):
    known = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    return [max((n for n in range(1, i + 2) if tuple(words[i + 1 - n : i + 1]) in known), default=0) for i in range(len(words))]


@pytest.mark.parametrize("seed", range(40))
def test_automaton_knows_the_longest_runs(seed):
    rnd = random.Random(seed)
    alphabet = "ab" if seed % 2 else "abcd"
    sequences = [[rnd.choice(alphabet) for _ in range(rnd.randrange(9))] for _ in range(rnd.randrange(6))]
    words = [rnd.choice(alphabet + "x") for _ in range(40)]
    assert D.SuffixAutomaton(sequences).lengths(words) == longest_runs(words, sequences)


def brute(words, items, window):
    marks, found = set(), set()
    for item_id, text in items:
        own = D.words_of((text or "").encode())
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            for at in range(len(words) - size + 1):
                if words[at : at + size] == own[i : i + size]:
                    marks.update(range(at, at + size))
                    found.add(item_id)
    return marks, sorted(str(x) for x in found if x is not None)


def tables():
    rnd = random.Random(2)
    vocabulary = ["The", "of", "é", "x1", "and", "Straße", "中"]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, 2, 5, 9, 10, 14])))) for i in range(12)]
    items += [(3, items[3][1]), (50, None), (51, "!?"), (None, "secret item words")]
    docs = []
    for i in range(60):
        words = [rnd.choice(vocabulary + ["other", "thing"] * 20) for _ in range(rnd.randrange(40))]
        if i % 2:
            words += (items[i % 12][1] or "").upper().split()[rnd.randrange(3) :]
        docs.append((i, rnd.choice([" ", ", ", "\n-"]).join(words)))
    docs += [(100, None), (101, ""), (102, "... !"), (103, "a Secret item-WORDS b"), docs[1], (None, docs[1][1])]
    return docs, items


@pytest.mark.parametrize("block_words", [D.BLOCK_WORDS, 20])
def test_equals_brute_force(spark, block_words):
    docs, items = tables()
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS).repartition(3)
    found = D.find_items(df, spark.createDataFrame(items, "item_id int, text string"), window=10, block_words=block_words)
    rows = sorted(
        ((r.doc_id, r.text, r.n_words, sorted(i for s in r.spans for i in range(s.first, s.end)), r["items"]) for r in found.collect()), key=str
    )
    wanted = []
    for doc_id, text in docs:
        words = D.words_of((text or "").encode())
        marks, names = brute(words, items, 10)
        wanted.append((doc_id, text, len(words), sorted(marks), names))
    assert rows == sorted(wanted, key=str)
    assert any(r[3] for r in rows) and any(not r[3] for r in rows)


def test_blocks_write_hits_and_no_texts(spark, monkeypatch):
    written = []

    def noted(df, purpose):
        out = materialise(df, purpose)
        written.append((df.columns, out.count()))
        return out

    materialise = D.materialise
    monkeypatch.setattr(D, "materialise", noted)
    items = [(i, " ".join(f"item{i}word{j}" for j in range(12))) for i in range(30)]
    docs = [(i, f"clean text {i}", "x", 1) for i in range(200)] + [(900, items[3][1] + " and " + items[4][1], "x", 1)] * 50
    found = D.find_items(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id int, text string"), block_words=30)
    hit = [r for r in found.collect() if r.spans]
    assert len(hit) == 50 and all(r["items"] == ["3", "4"] and [tuple(s) for s in r.spans] == [(0, 12), (13, 25)] for r in hit)
    assert found.count() == 250 and len(written) > 5
    assert all("text" not in columns for columns, _ in written) and 1 <= sum(n for _, n in written) <= 2


def test_very_long_texts(spark):
    long = "filler words here " * 100_000
    docs = [(1, long + "one two three four " + long, "x", 1), (2, long, "x", 1)]
    items = spark.createDataFrame([(1, "one two three four"), (2, "x y z w")], "item_id int, text string")
    for block_words in (D.BLOCK_WORDS, 1):
        found = D.find_items(spark.createDataFrame(docs, DOCS), items, block_words=block_words)
        assert {r.doc_id: (r.n_words, [tuple(s) for s in r.spans]) for r in found.collect()} == {
            1: (600_004, [(300_000, 300_004)]), 2: (300_000, [])
        }


def test_cut_leaves_the_rest_alone(spark):
    items = spark.createDataFrame([(1, "one two three four"), (2, "x y")], "item_id int, text string")
    docs = spark.createDataFrame(
        [(1, "Keep  this.\nONE, two three four!  And this.", "s", 3), (2, "nothing\t here ", "s", 4), (3, None, "s", 5), (4, "x y", "s", 6)], DOCS
    )
    cleaned = {r.doc_id: (r.text, r.spans, r.n_words) for r in D.remove_items(docs, items, window=3).collect()}
    assert cleaned == {1: ("Keep  this.!  And this.", "s", 3), 2: ("nothing\t here ", "s", 4), 3: (None, "s", 5), 4: ("", "s", 6)}


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b", "", 0)], DOCS), spark.createDataFrame([], "item_id int, text string")
    assert [(r.n_words, r.spans, r["items"]) for r in D.find_items(docs, items).collect()] == [(2, [], [])]
    assert D.find_items(docs.limit(0), items).collect() == []
