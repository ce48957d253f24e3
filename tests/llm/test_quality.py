"""The quality cascade: measures against plain loops, verdicts whatever the order."""

from __future__ import annotations

import random

import pytest

from sluice.llm import quality as Q

DOCS = "doc_id long, text string, kept string, n_words int, row string"


def plain_repeats(words, window=8):
    seen: dict = {}
    for i in range(len(words) - window + 1):
        seen.setdefault(tuple(words[i : i + window]), []).append(i)
    return len({j for places in seen.values() if len(places) > 1 for i in places for j in range(i, i + window)})


@pytest.mark.parametrize("seed", range(30))
def test_repeat_words(seed):
    rnd = random.Random(seed)
    words = [rnd.choice([b"a", b"b", b"c"][: 1 + seed % 3]) for _ in range(rnd.randrange(60))]
    assert Q.repeat_words(words) == plain_repeats(words)


GOOD = " ".join(f"Word{i} and plain text, here." for i in range(12))
TEXTS = {
    "good": GOOD,
    "short": "Only a few words.",
    "symbols": " ".join(f"word{i}###" for i in range(40)),
    "shouting": GOOD.upper(),
    "exclaiming": GOOD.replace(" ", "! "),
    "repeated_lines": "\n".join(["one line of a few words"] * 5 + [f"line {i} of others" for i in range(2)]),
    "stuttering": " ".join(f"w{i} w{i}" for i in range(30)),
    "word_length": " ".join("x" * 30 + str(i) for i in range(30)),
    "unlettered": " ".join(f"{i}.{i} x{i}" if i % 3 == 0 else f"{i} {i + 1}" for i in range(30)),
    "french": " ".join(f"élève{i} à côté" for i in range(10)),
}


def test_each_rule_rejects_its_kind():
    for name, text in TEXTS.items():
        raw = text.encode()
        hit = {n for n, rule in Q.RULES.items() if rule(raw, raw.split())}
        assert hit == ({name} if name in Q.RULES else set()), name


def rows():
    return [*((i, t) for i, t in enumerate(TEXTS.values())), (90, None), (91, ""), (92, "\n \t"), (None, GOOD), (0, GOOD), (93, "\xa0é " * 100_000)]


def test_verdicts_do_not_depend_on_the_order(spark):
    docs = spark.createDataFrame([(*r, "no", 5, "x") for r in rows()], DOCS).repartition(3)
    orders = [list(Q.RULES), list(reversed(Q.RULES))]
    results = []
    for order in orders:
        judged = Q.judge(docs, {n: Q.RULES[n] for n in order}, keep=["doc_id", "kept", "row"])
        results.append(sorted(((r.row.doc_id, r.row.kept, r.row.row, r.n_words, r.base_failed, r.kept) for r in judged.collect()), key=str))
    assert results[0] == results[1]
    kept = {r[0] for r in results[0] if r[5]}
    assert kept == {0, 9, None} and all(r[1:3] == ("no", "x") for r in results[0])
    assert {r[0]: r[3] for r in results[0]}[92] == 0


def test_measures(spark):
    text = "é# <b> a\n\nsame line\n  \nsame line\nsame line"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = Q.judge(docs).first()
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (9, 30, 3, 2, 0)


def test_order_is_rejections_per_cost(spark):
    def never(raw, words):
        return False

    def always_slow(raw, words):
        return sum(range(20_000)) > 0

    def always_fast(raw, words):
        return True

    docs = spark.createDataFrame([(i, GOOD) for i in range(40)], "doc_id long, text string")
    order = Q.calibrate(docs, {"never": never, "slow": always_slow, "fast": always_fast})
    assert [o["rule"] for o in order][0] == "fast" and order[0]["rejects"] == 1.0
    assert {o["rule"]: o["rejects_here"] for o in order} == {"fast": 1.0, "slow": 0.0, "never": 0.0}


def test_order_comes_from_texts_that_pass_the_base(spark):
    def short(raw, words):  # rejects only what the base has rejected
        return len(words) < 20

    def rare(raw, words):
        return raw.startswith(b"Rare")

    texts = ["too short"] * 50 + [" ".join(["again and"] * 30)] * 20 + [GOOD] * 9 + ["Rare " + GOOD]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    order = Q.calibrate(docs, {"short": short, "rare": rare})
    assert [(o["rule"], o["rejects"]) for o in order] == [("rare", 0.1), ("short", 0.0)]
    assert {o["rejects"] for o in Q.calibrate(docs.limit(50), {"short": short, "rare": rare})} == {0.0}


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert Q.judge(docs).collect() == [] and len(Q.calibrate(docs)) == len(Q.RULES)
