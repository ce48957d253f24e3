"""SimHash near-duplicates against the comparison of all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from sluice.llm import simhash

DOCS = "doc_id long, text string, fingerprint int, component_id string"


def plain_fingerprint(text: str | None, size: int = 4) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows: list[tuple], max_bits: int) -> list[tuple]:
    prints = [plain_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    lowest = {}
    for g, (doc_id, _) in zip(group, rows, strict=True):
        if doc_id is not None:
            lowest[g] = min(doc_id, lowest.get(g, doc_id))
    return [(d, f"{p:016x}", lowest.get(g)) for (d, _), p, g in zip(rows, prints, group, strict=True)]


def texts(seed: int = 1) -> list[tuple]:
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "ÉA", "Straße"]
    rows = []
    for doc_id in range(60):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, 3, 4, 5, 60, 300]))]
        rows.append((doc_id, " ".join(words)))
        if doc_id % 3 == 0 and len(words) > 50:  # a family of edited copies
            for copy in range(8):
                changed = list(words)
                changed[rnd.randrange(len(words))] = "changed"
                rows.append((1000 + 10 * doc_id + copy, "\t".join(changed).upper()))
    rows += [(5000, None), (5001, ""), (5002, " \n\t"), (None, rows[5][1]), (None, "lonely row without id"), rows[7]]
    return rows


def result(df) -> list[tuple]:
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


@pytest.mark.parametrize("crowd", [simhash.CROWD, 3])
def test_equals_all_pairs(spark, crowd):
    rows = texts()
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], DOCS).repartition(3)
    found = simhash.near_duplicates(docs, crowd=crowd)
    assert result(found) == sorted(brute_components(rows, 4), key=str)


def test_long_text_and_empty_table(spark):
    long = " ".join(f"w{i % 977}" for i in range(200_000))
    assert simhash.fingerprint(long.encode(), 4) == plain_fingerprint(long)
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []


def test_no_pair_within_the_distance_is_missed(spark):
    rnd = random.Random(3)
    found = []
    for _ in range(150):
        base = rnd.getrandbits(64)
        found += [base, base ^ sum({1 << rnd.randrange(64) for _ in range(4)})]
    signed = np.array(found, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(f,) for f in set(signed)], "fp long")
    linked = {frozenset((r.a, r.b)) for r in simhash.links(nodes, 4).collect()}
    wanted = {frozenset((a, b)) for a, b in zip(signed[::2], signed[1::2], strict=True) if a != b}
    assert wanted <= linked


def test_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 501)], "a long, b long")
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    assert {roots[i] for i in range(1, 101)} == {0} and roots[501] == 500


def test_odd_distance_is_refused(spark):
    with pytest.raises(ValueError, match="max_bits"):
        simhash.near_duplicates(spark.createDataFrame([], DOCS), max_bits=3)
