"""Spelling variants against the comparison of all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluice.llm import spelling
from sluice.llm.queries import QUERIES

DOCS = "doc_id long, text string, word string, n int, root string, `a.b` int"


def plain_counts(rows, length=5, least=3) -> dict:
    counts = Counter()
    for doc_id, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= length and n >= least}


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts: dict) -> set:
    words = sorted(counts)
    near = {w: [] for w in words}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for w in words:
        for v in by_length[len(w)] + by_length.get(len(w) + 1, []):
            if v != w and one_edit(w, v):
                near[w].append(v)
                if len(v) > len(w):
                    near[v].append(w)
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return out


def result(df) -> list:
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def texts() -> list:
    rnd = random.Random(4)
    stems = ["".join(rnd.choice("aeinrstÉé÷ÿ") for _ in range(rnd.randrange(4, 9))) for _ in range(40)]
    rows = []
    for doc_id in range(200):
        words = []
        for _ in range(30):
            w = rnd.choice(stems[: 1 + int(40 * rnd.random() ** 2)])
            for _ in range(rnd.choice([0, 0, 0, 1, 1, 2])):
                at = rnd.randrange(len(w) + 1)
                w = rnd.choice([w[:at] + "a" + w[at:], w[:at] + w[at + 1 :], w[:at] + "Z" + w[at + 1 :]])
            words.append(w)
        rows.append((doc_id, rnd.choice([" ", "Ā", "1", "\n"]).join(words)))
    return rows + [(500, None), (501, ""), (None, "nameless nameless nameless namelesss"), rows[3], rows[3]]


@pytest.mark.parametrize("symbols", [1, 3, 8])
def test_equals_all_pairs(spark, symbols):
    rows = texts()
    docs = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], DOCS).repartition(3)
    want = brute(plain_counts(rows))
    assert result(spelling.variants(docs, symbols=symbols)) == sorted(want, key=str)
    assert any(r[2] not in (r[0], r[1]) for r in want)  # chains of forms


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(spelling, "HELD_WORDS", 10)
    counts = {r.word: r.n for r in spelling.word_counts(docs, "doc_id", "text", 5, 3, 97).collect()}
    assert counts == plain_counts(rows)


def test_neighbourhoods_meet(spark):
    """Whatever the edit, one of two words finds the other by its code."""
    rnd = random.Random(1)
    letters = "abcdefgh"
    for _ in range(300):
        w = "".join(rnd.choice(letters) for _ in range(rnd.randrange(5, 12)))
        at = rnd.randrange(len(w))
        for v in (w[:at] + w[at + 1 :], w[:at] + rnd.choice(letters) + w[at + 1 :], w[:at] + rnd.choice(letters) + w[at:]):
            made = {}
            for numbers, codes, own in spelling.neighbourhoods([w, v], 8, 4):
                for i, c in zip(numbers.tolist(), codes.tolist(), strict=True):
                    made.setdefault((i, own), set()).add(c)
            assert made[0, True] & made[1, False] or made[1, True] & made[0, False]


def test_very_long_words_ties_and_empty_table(spark):
    long = "".join(random.Random(3).choice(spelling.LETTERS) for _ in range(60_000))
    rows = [(i, f"{long} {long[:30_000]}x{long[30_000:]} aaaaa aaaab aaaac aaaac aaaab bbbbbb") for i in range(3)]
    rows += [(9, f"{long[:-1]} " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = result(spelling.variants(docs))
    assert found == sorted(brute(plain_counts(rows)), key=str)
    assert {(r[0], r[1]) for r in found if len(r[0]) == 5} == {("aaaaa", "aaaab"), ("aaaab", None), ("aaaac", None)}
    assert spelling.variants(spark.createDataFrame([], DOCS)).collect() == []
    with pytest.raises(ValueError, match="factor"):
        spelling.variants(docs, factor=1)


def test_query_on_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.filter(F.col("text").isNotNull()).collect()]
    assert result(QUERIES["op12_spelling_variants"](spark, sf_dir)) == sorted(brute(plain_counts(rows)), key=str)
