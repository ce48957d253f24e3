"""Encoding, packing and record files against the tokenizers library and exact round trips."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluice.llm import packing, records, tokens
from sluice.scratch import scratch_dir

BYTES, WORDS = (public_tokenizers.path(f"{name}.json") for name in ("byte_bpe_50k", "word_bpe_49k"))
ODD = [" ", "  ", "\n", "\t", "\r\n", "\xa0", " ", "　", "\x85", "\x1c", " ", "​", "﻿", "́"]
COMMON = ["a", "B", "é", "ß", "The", " the", "1", "22", "'s", "'ll", "'S", "!", "...", "İ", "Σ", "中文", "🙂", "É", "'", "×", "ª"]
SPECIAL = ["<|endoftext|>", "<|startoftext|>", "<|", "\x00"]
DOCS = "doc_id long, text string, piece string, ids int"


def encoded(path: str, text: str | None, end: int) -> np.ndarray:
    ids = Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, end], "<u4")


@pytest.mark.parametrize("path", [BYTES, WORDS])
@pytest.mark.parametrize("alphabet", [COMMON + [" ", " ", "\n"], COMMON + ODD + SPECIAL])
def test_segments_give_the_ids_of_the_whole(path, alphabet):
    rnd, whole = random.Random(7), Tokenizer.from_file(path)
    encode = tokens.SegmentEncoder(tokens.read_tokenizer(path), remembered=500)
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(40))) for _ in range(4000)]
    for start in range(0, len(texts), 100):
        part = texts[start : start + 100]
        for text, ids in zip(part, encode([t.encode() for t in part]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def rows() -> list[tuple]:
    rnd = random.Random(5)
    made = [(i, " ".join(rnd.choice(["the", "word", "Zürich,", "x"]) for _ in range(rnd.choice([0, 1, 50, 700, 5000])))) for i in range(60)]
    return [*made, (100, None), (101, ""), (None, "no id"), (None, None), made[3], made[3], (-5, "negative")]


def test_pieces_and_sequences(spark):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows()], DOCS).repartition(4)
    packed = packing.pack(packing.materialise(packing.pieces(docs, BYTES, 0, 512, with_ids=True), "t"), 512).collect()
    wanted = Counter()
    for doc_id, text in rows():
        ids = encoded(BYTES, text, 0)
        first = len(ids) % 512 or 512
        at, number = 0, 0
        while at < len(ids):
            size = first if not number else 512
            wanted[doc_id, number, at, size, zlib.crc32(ids[at : at + size].tobytes())] += 1
            at, number = at + size, number + 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == wanted
    ends: dict[int, int] = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    assert max(ends.values()) <= 512
    assert len(ends) == -(-sum(r.length for r in packed) // 512)


def test_sequences_hold_the_tokens(spark):
    docs = spark.createDataFrame([(i, "word " * (30 * i)) for i in range(8)], "doc_id long, text string")
    packed = packing.pack(packing.materialise(packing.pieces(docs, BYTES, 0, 256, with_ids=True), "t"), 256)
    made = packing.sequences(packed).collect()
    assert sum(len(r.ids) for r in made) == packed.agg(F.sum("length")).first()[0]
    assert all(r.ids[s - 1] == 0 or r.ids[s] != 0 for r in made for s in r.starts if s)


@pytest.mark.parametrize("seed", range(30))
def test_plan_uses_every_piece_once_and_wastes_little(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([16, 100, 2048])
    counts = Counter(rnd.randint(1, capacity) for _ in range(rnd.choice([1, 10, 500])))
    plan = packing.plan(counts, capacity)
    used = Counter()
    for pattern, times in plan:
        assert sum(pattern) <= capacity and times > 0
        for length in pattern:
            used[length] += times
    assert used == counts
    sequences = sum(times for _, times in plan)
    free = sorted(counts.elements(), reverse=True)
    bins: list[int] = []
    for length in free:  # best-fit decreasing
        fitting = [b for b in range(len(bins)) if bins[b] >= length]
        if fitting:
            bins[min(fitting, key=lambda b: bins[b])] -= length
        else:
            bins.append(capacity - length)
    assert sequences <= len(bins) + 1


def test_a_search_that_failed_for_pieces_set_aside_is_made_again():
    index = packing.Complements(np.array([0, 0, 1, 1, 0, 0, 0, 0]))
    assert index.filling(5, Counter([3])) is None
    assert index.filling(5, Counter()) == (3, 2)
    assert index.filling(7, Counter()) is None and index.pairs[7] == index.triples[7] == ()


def test_packing_nothing(spark):
    assert packing.pack_documents(spark.createDataFrame([], DOCS), BYTES).collect() == []


@pytest.mark.parametrize("per_file", [3, 20_000])
def test_records_round_trip(spark, per_file):
    path = scratch_dir(spark, "records")
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows()], DOCS).repartition(5)
    records.write_records(docs, path, WORDS, 2, records_per_file=per_file)
    read = records.read_records(spark, path).collect()
    wanted = Counter((d, encoded(WORDS, t, 2).tobytes()) for d, t in rows())
    assert Counter((r.doc_id, bytes(r.ids)) for r in read) == wanted
    ordered = sorted(read, key=lambda r: r.start)
    assert [r.start for r in ordered] == [0, *np.cumsum([r.n_tokens for r in ordered])[:-1]]
    ids = [r.doc_id for r in ordered]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))


def test_index_fetches_records_in_any_order(spark):
    path = scratch_dir(spark, "records")
    records.write_records(spark.createDataFrame(rows(), "doc_id long, text string"), path, WORDS, 2)
    content = {r.path.rsplit("/", 1)[1]: bytes(r.content) for r in spark.read.format("binaryFile").load(f"{path}/records").collect()}
    for r in spark.read.parquet(f"{path}/index").collect():
        one = content[r.file][r.offset : r.offset + r.length + 17]
        ((offset, length, _, n_tokens, ids),) = records.frames(one, payloads=True)
        assert (offset, length, n_tokens, len(ids)) == (0, r.length, r.n_tokens, 4 * n_tokens)


def test_records_of_nothing(spark):
    path = scratch_dir(spark, "records")
    records.write_records(spark.createDataFrame([], "doc_id long, text string"), path, WORDS, 2)
    assert records.read_records(spark, path).collect() == []


@pytest.mark.parametrize("at, what", [(3, "length checksum"), (30, "payload checksum"), (-1, "torn")])
def test_damage_is_found(at, what):
    good = records.frame("7", np.arange(20, dtype="<u4").tobytes(), 2) + records.END
    assert [x[2:4] for x in records.frames(good, True)] == [("7", 20)]
    bad = bytearray(good)
    bad[at] ^= 1
    with pytest.raises(ValueError, match=what):
        list(records.frames(bytes(bad), True))


def test_wide_ids_survive():
    ids = np.array([0, 65_535, 65_536, 4_294_967_295], "<u4").tobytes()
    assert [x[4] for x in records.frames(records.frame(None, ids, 4) + records.END, True)] == [ids]
