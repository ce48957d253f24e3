"""Words that share a polynomial hash are told apart: ids of the tokenizers library, exact counts of known words."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluice.llm import lm_bloom, packing, segments, tokens


def thue_morse(letters: int) -> tuple[str, str]:
    word = "a"
    while len(word) < letters:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("key", [None, b"", b"words"])
def test_word_hashes_tell_words_apart(key):
    rnd = random.Random(1)
    words = {bytes(rnd.choice(b"ab\x00\xc3") for _ in range(rnd.randrange(1, 14))) for _ in range(20_000)}
    words |= {bytes(rnd.choice(b"ab") for _ in range(n)) for n in range(14, 50) for _ in range(40)}
    words = sorted(words | {w.encode() for n in (1024, 2048, 4096) for w in thue_morse(n)})
    data, offsets = segments.joined(words)
    hasher = segments.WordHasher(key)
    first = hasher(data, offsets[:-1], offsets[1:])
    assert len(np.unique(first)) == len(words)
    some = [words[0], words[-1], words[len(words) // 2], b"abcdefgh", b"abcdefghi"]
    data, offsets = segments.joined(some)
    assert hasher(data, offsets[:-1], offsets[1:]).tolist()[:3] == first[[0, -1, len(words) // 2]].tolist()
    polynomial = segments.Hasher()
    data, offsets = segments.joined([w.encode() for w in thue_morse(1024)])
    assert len(np.unique(polynomial(data, offsets[:-1], offsets[1:]))) == 1  # what it replaces


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("letters", [1024, 2048, 4096])
def test_ids_of_colliding_words_in_one_task(name, letters):
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    texts = [*thue_morse(letters), "before " + thue_morse(letters)[1] + " after"]
    encoder = tokens.SegmentEncoder(tokens.read_tokenizer(path))
    for text, ids in zip(texts, encoder([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_packed_lengths_of_colliding_documents(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    texts = thue_morse(1024)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    packed = packing.pack_documents(docs, path, end_id=0, capacity=2048)
    lengths = {r.doc_id: r.n for r in packed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert lengths == {i: len(plain.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}


def test_unseen_colliding_word_is_not_known(spark):
    one, two = thue_morse(1024)
    rows = [(1, f"{one} x"), (2, f"{two} x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    scores, _ = lm_bloom.score_documents(docs, F.col("doc_id") == 1)
    assert {r.doc_id: r.n_known for r in scores.collect()} == {1: 3, 2: 2}
