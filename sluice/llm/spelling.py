"""Spelling variants grouped by words one edit apart, found over a reduced alphabet.

Letters are hashed to a few symbols. Words that are one inserted, deleted or replaced code point apart
have reduced words that are equal or one edit apart, so it is enough to take every distinct reduced word,
generate its one-edit neighbourhood, join that with the reduced vocabulary, and verify what shares a reduced
word or a neighbour on the words themselves.

Every edit is looked up from one of its two ends. An insertion is the deletion of the longer word, so it is
left to that word; of two reduced words of one length that with the larger code finds the other.
Codes are polynomials of the symbols, so that a neighbour's code takes one step whatever the length of the
word. Different reduced words may share a code: that adds pairs to verify and loses none, as reduced words
are told apart by their text.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import byte_texts, materialise, slices, str_texts, text_batches

#: The letters of a word after lower-casing A-Z.
LETTERS = "".join(map(chr, [*range(0x61, 0x7B), *range(0xC0, 0x100)]))
SYMBOLS = 8
BASE = 0x9E3779B97F4A7C15
#: Words, and characters of words, that a task counts before it hands on what it has.
HELD_WORDS, HELD_CHARACTERS = 400_000, 1 << 24
#: Symbols whose neighbours are generated at once, about.
BLOCK = 1 << 14


def damaged(run: str, prefix: int, one_in: int) -> str:
    """``run`` without one code point, if its checksum says so; ``prefix`` is the checksum of what stands before."""
    from zlib import crc32

    h = crc32(run.encode(), prefix)
    if h % one_in:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, id_col: str, text_col: str, least_length: int, least_count: int, one_in: int) -> DataFrame:
    """``word`` and ``n`` of all words long and frequent enough. Counts are combined in each task and then by shuffle."""
    import pyarrow as pa

    text_batches(docs.sparkSession)
    name = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    rows = docs.select(name.alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def counted(batches):
        import re
        from collections import Counter
        from zlib import crc32

        runs = re.compile(f"[{LETTERS[:26]}À-ÿ]{{{least_length},}}").findall
        total, characters = Counter(), 0

        def handed_on():
            return pa.RecordBatch.from_arrays(
                [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"]
            )

        for batch in slices(batches, 256):
            for doc_id, text in zip(byte_texts(batch.column(0)), byte_texts(batch.column(1)), strict=True):
                prefix = crc32(doc_id + b":")
                for run, n in Counter(runs(text.lower().decode())).items():
                    word = damaged(run, prefix, one_in)
                    if len(word) >= least_length:
                        before = len(total)
                        total[word] += n
                        characters += len(word) if len(total) > before else 0
                        if len(total) > HELD_WORDS or characters > HELD_CHARACTERS:
                            yield handed_on()
                            total, characters = Counter(), 0
        if total:
            yield handed_on()

    counts = rows.mapInArrow(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= least_count)


def symbol_of(letter: str, symbols: int) -> int:
    return (ord(letter) * 0x9E3779B1 >> 9 & 0xFFFF) % symbols


def reduced(word, symbols: int = SYMBOLS):
    """A column of words with each letter replaced by the symbol it hashes to."""
    if not 1 <= symbols <= 26:
        raise ValueError(f"symbols must be 1 to 26: {symbols}")
    return F.translate(word, LETTERS, "".join(LETTERS[symbol_of(c, symbols)] for c in LETTERS))


def neighbourhoods(words: list[str], symbols: int, least_length: int) -> Iterator[tuple]:
    """Blocks of numbers of words, their codes, and the codes of their neighbours that are looked up from here.

    Yields ``(numbers, codes)`` of the words themselves first and then of their edits, for some words at a time.
    """
    import numpy as np

    base, inverse = np.uint64(BASE), np.uint64(pow(BASE, -1, 1 << 64))
    first = 0
    while first < len(words):
        last, size = first + 1, len(words[first])
        while last < len(words) and size + len(words[last]) <= BLOCK:
            size += len(words[last])
            last += 1
        lengths = np.fromiter(map(len, words[first:last]), np.int64, last - first)
        letters = np.frombuffer("".join(words[first:last]).encode("utf-32-le"), np.uint32).astype(np.uint64) - np.uint64(96)
        word = np.repeat(np.arange(last - first), lengths)
        starts = np.cumsum(lengths) - lengths
        place = np.arange(len(letters)) - starts[word]
        power = np.full(int(lengths.max()) + 1, base, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)[place]
        term = letters * power
        sums = np.r_[np.uint64(0), np.cumsum(term, dtype=np.uint64)]
        own = sums[starts + lengths] - sums[starts]
        before = sums[:-1] - sums[starts][word]
        yield first + np.arange(last - first), own, True
        yield first + np.arange(last - first), own, False
        repeated = np.r_[False, (letters[1:] == letters[:-1]) & (word[1:] == word[:-1])]
        deleted = ~repeated & (lengths[word] > least_length)
        after = own[word] - before - term
        yield first + word[deleted], (before + after * inverse)[deleted], False
        for symbol in range(1, symbols + 1):
            code = own[word] + (np.uint64(symbol) - letters) * power
            found = (letters != symbol) & (code <= own[word])
            yield first + word[found], code[found], False
        first = last


def near_reduced(numbered: DataFrame, symbols: int, least_length: int) -> DataFrame:
    """``a``, ``b``: numbers of pairs of reduced words (``number``, ``reduced``) that are equal or may be one edit apart."""
    import pyarrow as pa

    def coded(batches):
        import numpy as np

        for batch in slices(batches, 1024):
            numbers = batch.column(0).to_numpy()
            for places, codes, own in neighbourhoods(str_texts(batch.column(1)), symbols, least_length):
                columns = [numbers[places], codes.view(np.int64), np.full(len(places), own)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["number", "code", "own"])

    codes = numbered.select("number", "reduced").mapInArrow(coded, "number bigint, code bigint, own boolean")
    own = codes.filter("own").select("code", F.col("number").alias("b"))
    return codes.filter("NOT own").select("code", F.col("number").alias("a")).join(own, "code").select("a", "b").distinct()


def near_words(vocabulary: DataFrame, symbols: int, least_length: int) -> DataFrame:
    """``word``, ``other``, ``other_n``: every word beside each word one edit away."""
    distinct = vocabulary.select("reduced").distinct().select(F.monotonically_increasing_id().alias("number"), "reduced")
    numbered = materialise(distinct, "reduced-words")  # written, so that numbers stay
    words = materialise(vocabulary.join(numbered, "reduced").select("number", "word", "n"), "numbered-words")
    pairs = near_reduced(numbered, symbols, least_length)
    left = words.select(F.col("number").alias("a"), F.col("word").alias("x"), F.col("n").alias("x_n"))
    right = words.select(F.col("number").alias("b"), F.col("word").alias("y"), F.col("n").alias("y_n"))
    both = pairs.join(left, "a").join(right, "b")
    # pairs within one reduced word come from both sides, and verify once
    near = both.filter(((F.col("a") != F.col("b")) | (F.col("x") < F.col("y"))) & (F.levenshtein("x", "y", 1) == 1))
    swap = F.col("x") > F.col("y")
    ordered = near.select(
        F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"),
        F.when(swap, F.col("y_n")).otherwise(F.col("x_n")).alias("x_n"), F.when(swap, F.col("x_n")).otherwise(F.col("y_n")).alias("y_n"),
    )
    ordered = materialise(ordered.distinct(), "near-words")
    there = ordered.select(F.col("x").alias("word"), F.col("y").alias("other"), F.col("y_n").alias("other_n"))
    return there.union(ordered.select(F.col("y").alias("word"), F.col("x").alias("other"), F.col("x_n").alias("other_n")))


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and the last form that its forms lead to. Each round doubles the steps taken; a form is at least
    twice as frequent as its word, so the rounds grow with the logarithm of the logarithm of the largest count."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        after = materialise(after, "roots")
        now = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return now


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = 5,
    least_count: int = 3,
    factor: int = 2,
    one_in: int = 97,
    symbols: int = SYMBOLS,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the texts.

    Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lower-cased. Where ``one_in`` divides the unsigned crc32
    of ``<id>:<run>``, the run loses the code point at that number modulo its length. Words have ``least_length`` code
    points and ``least_count`` occurrences. A word's form is the most frequent word one edit away (of equals the
    smallest in code-point order) if it is at least ``factor`` times as frequent; the root is the last of the forms
    that follow each other.

    NULL texts have no words, a NULL id counts as empty text, repeated rows count again. An empty table gives no rows.
    Words of any length are compared whole. Other columns of ``docs`` are not read.
    """
    if factor < 2:
        raise ValueError(f"factor must be at least 2, or forms need not end: {factor}")
    counts = word_counts(docs, id_col, text_col, least_length, least_count, one_in)
    vocabulary = materialise(counts.withColumn("reduced", reduced(F.col("word"), symbols)), "vocabulary")
    near = near_words(vocabulary, symbols, least_length)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    joined = vocabulary.select("word", "n").join(best, "word", "left")
    taken = -F.col("best.less") >= factor * F.col("n")
    judged = materialise(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(taken, F.col("best.other")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    last = roots(judged.filter("form IS NOT NULL"))
    return judged.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
