"""Phrase collocations against plain counting of all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from sluice.llm import phrases, segments

DOCS = "doc_id long, lang string, text string, phrase string, n int, f string, `a.b` int"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least=10, most=3, first=2000, inside=50) -> list:
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(words)
            for n in range(1, most + 1):
                for i in range(len(words) - n + 1):
                    f[lang, tuple(words[i : i + n])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = []
    for lang in total:
        own = []
        for (of, p), a in candidates.items():
            if of != lang:
                continue
            longer = [b for (o, q), b in candidates.items()
                      if o == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= inside * a for b in longer):
                continue
            cuts = [(1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            own.append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(own)[:first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def result(df) -> list:
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def texts(seed=1, count=150) -> list:
    rnd = random.Random(seed)
    words = ["New", "new", "york", "York", "of", "the", "é", "É", "x1", "a-b", "ß", " y", "𝄞"]
    rows = []
    for _ in range(count):
        made = []
        for _ in range(rnd.randrange(40)):
            made += rnd.choice([["New", "York"], ["new", "york", "city"], [rnd.choice(words)], ["the", "of"]])
            made.append(rnd.choice([" ", "  ", "\t", ". ", ",", "\n", "\x0b", " "]))
        rows.append((rnd.choice(["en", "en", "en", "fr", None, "und", ""]), " ".join(made)))
    return rows + [("en", None), ("fr", ""), (None, " ,.\n"), rows[0], rows[0]]


@pytest.mark.parametrize(("most", "first"), [(3, 2000), (2, 5), (4, 7)])
def test_equals_plain_counting(spark, most, first):
    rows = texts()
    docs = spark.createDataFrame([(i, *r, "x", 1, "y", 2) for i, r in enumerate(rows)], DOCS).repartition(3)
    found = phrases.collocations(docs, most_words=most, first=first)
    want = brute(rows, most=most, first=first)
    assert result(found) == want and len(want) > 10


def test_collisions_change_no_count(spark):
    class Everything:
        """A bit array in which all bits are set, as if all fingerprints collided."""

        def __call__(self, fingerprints):
            import numpy

            return numpy.ones(len(fingerprints), bool)

    rows = texts(2, 60)
    docs = spark.createDataFrame(rows, "lang string, text string").selectExpr("coalesce(lang, 'und') AS lang", "text")
    want = Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for n in (1, 2, 3):
                want.update(("und" if lang is None else lang, " ".join(words[i : i + n])) for i in range(len(words) - n + 1))
    found = {(r.lang, r.phrase): r.f for r in phrases.phrase_counts(docs.repartition(3), 3, 4, Everything()).collect() if r.words}
    assert found == {k: n for k, n in want.items() if n >= 4}


def test_words_that_collide_are_counted_apart(spark):
    """Thue-Morse words of 2,048 letters share their polynomial modulo 2 ** 64."""
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    raw = np.frombuffer((word + other).encode(), np.uint8)
    one, two = segments.Hasher()(raw, np.array([0, 2048]), np.array([2048, 4096]))
    assert one == two
    rows = [("en", f"{word} x. {other} x. {other} x")] * 10
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert result(phrases.collocations(docs)) == brute(rows)
    assert {r[3] for r in brute(rows)} == {10, 20}


def test_bit_array_holds_all(spark):
    values = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 50_000)
    known = phrases.members(spark.createDataFrame([(int(v),) for v in values], "fp long").repartition(4))
    assert known(values.view(np.uint64)).all()
    others = np.random.default_rng(2).integers(-(1 << 63), 1 << 63, 50_000).view(np.uint64)
    assert known(others).mean() < 0.05


def test_long_text_is_cut_at_delimiters(spark, monkeypatch):
    text = "one two three. four five\n" * 60_000 + "tail " * 200_000
    assert b"".join(phrases.parts(text.encode())) == text.encode()
    assert len(list(phrases.parts(text.encode()))) > 2
    rows = [("en", text)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert result(phrases.collocations(docs)) == brute(rows)


def test_exact_scores_of_large_counts(spark):
    counts = [("en", "a b", 2, 3_000_000_007), ("en", "a", 1, 4_000_000_009), ("en", "b", 1, 900_000_000_041)]
    made = phrases.scored(spark.createDataFrame(counts, "lang string, phrase string, words int, f long"), 2).first()
    assert made.score == 1000000 * 3_000_000_007**2 // (4_000_000_009 * 900_000_000_041)


def test_empty_table_and_refused_sizes(spark):
    empty = spark.createDataFrame([], DOCS)
    assert phrases.collocations(empty).collect() == []
    with pytest.raises(ValueError, match="two words"):
        phrases.collocations(empty, least_words=1)
