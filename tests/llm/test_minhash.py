"""MinHash near-duplicates against the comparison of all pairs of whole sets."""

from __future__ import annotations

import random

import numpy as np
import pytest

from sluice.llm import minhash

DOCS = "doc_id long, text string, n_shingles int, component_id string, root int, words string, `a.b` int"


def plain_set(text: str | None, size: int = 5) -> set:
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def brute(rows: list[tuple], percent: int = 85) -> list[tuple]:
    sets = [plain_set(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    lowest = {}
    for g, (doc_id, _) in zip(group, rows, strict=True):
        if doc_id is not None:
            lowest[g] = min(doc_id, lowest.get(g, doc_id))
    return [(d, len(s), lowest.get(g), d == lowest.get(g)) for (d, _), s, g in zip(rows, sets, group, strict=True)]


def texts(seed: int = 1, families: int = 4, copies: int = 40) -> list[tuple]:
    """Families of copies with few to many edits, so that similarities lie on either side of the threshold."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)] + ["É", "ÉA", "Straße"]
    rows, doc_id = [], 1000
    for _ in range(families):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([30, 120, 400]))]
        for _ in range(copies):
            words = list(base)
            for _ in range(int(len(base) * rnd.random() * 0.05)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            rows.append((doc_id, "\t ".join(words).upper() if doc_id % 5 == 0 else " ".join(words)))
            doc_id = doc_id - 1 if doc_id % 2 else doc_id + 3
    for n in (1, 3, 4, 5, 6, 50):
        rows.append((n, " ".join(rnd.choice(vocabulary) for _ in range(n))))
        rows.append((100 + n, rows[-1][1]))
    rows += [(5000, None), (5001, ""), (5002, " \n\t"), (5002, " \n\t"), (None, rows[5][1]), (None, "lonely row"), (None, "lonely row"), rows[7]]
    return rows


def result(df) -> list[tuple]:
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("limits", [{}, {"block_rows": 6, "block_bytes": 4000}])
def test_equals_all_pairs(spark, limits):
    rows = texts()
    docs = spark.createDataFrame([(*r, 7, "x", 1, "y", 2) for r in rows], DOCS).repartition(3)
    assert result(minhash.near_duplicates(docs, **limits)) == sorted(brute(rows), key=str)


def test_both_sides_of_the_threshold(spark):
    """17 of 20 shingles in common are enough, 16 of 19 are not."""
    words = [f"v{i}" for i in range(60)]
    rows = [(1, " ".join(words[:23])), (2, " ".join(words[:21])), (3, " ".join(words[30:53])), (4, " ".join([*words[30:50], "x"]))]
    assert [len(plain_set(t)) for _, t in rows] == [19, 17, 19, 17]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert [w[2] for w in want] == [1, 1, 3, 4] and result(minhash.near_duplicates(docs)) == sorted(want, key=str)


def test_every_pair_within_the_distance_shares_a_key(spark):
    rnd = np.random.default_rng(5)
    first = rnd.integers(0, 256, (200, minhash.SLOTS), np.uint8)
    second = first.copy()
    for row in second:
        places = rnd.choice(minhash.SLOTS, minhash.MAX_DISTANCE, replace=False)
        row[places] ^= rnd.integers(1, 256, len(places), np.uint8)
    made = [(i, 10, s.tobytes()) for i, s in enumerate(np.concatenate([first, second]))]
    signatures = spark.createDataFrame(made, "node long, n long, sig binary").repartition(3)
    found = {(r.a, r.b) for r in minhash.near_signatures(signatures, minhash.MAX_DISTANCE, 85, 64).collect()}
    assert found == {(i, i + 200) for i in range(200)}
    assert not minhash.near_signatures(signatures, minhash.MAX_DISTANCE - 1, 85, 64).collect()


def test_signature_estimates_similarity():
    hashing, rnd = minhash.factors(), random.Random(2)
    distances = []
    for _ in range(300):
        shared, a, b = ({rnd.randbytes(8) for _ in range(n)} for n in (170, 15, 15))
        x, y = (np.frombuffer(minhash.signature(shared | s, hashing), np.uint8) for s in (a, b))
        distances.append(int((x != y).sum()))
    assert abs(np.mean(distances) - minhash.SLOTS * 0.15) < 1 and np.std(distances) < 4.2


def test_one_large_family_and_long_texts(spark):
    """A third of the rows are near copies of one text; its keys are cut into ranges and blocks."""
    rnd = random.Random(9)
    long = [f"w{rnd.randrange(9000)}" for _ in range(60_000)]
    other = list(long)
    other[100] = "changed"
    rows = [(90_000, " ".join(long)), (90_001, " ".join(other))]
    base = [f"u{i}" for i in range(100)]
    for i in range(300):
        words = list(base)
        words[rnd.randrange(100)] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"z{rnd.randrange(10**6)}" for _ in range(40))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, block_rows=40).collect()}
    assert found == {d: 0 if d < 300 else 90_000 if d >= 90_000 else d for d, _ in rows}


def test_empty_table_and_refused_distance(spark):
    empty = spark.createDataFrame([], DOCS)
    assert minhash.near_duplicates(empty).collect() == []
    with pytest.raises(ValueError, match="max_distance"):
        minhash.near_duplicates(empty, max_distance=32)
