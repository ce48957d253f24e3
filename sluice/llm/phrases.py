"""Phrase collocations found by Rabin-Karp fingerprints.

Words are hashed by prefix polynomials over the bytes of many texts at once, and phrases by prefix polynomials over
the words' hashes, so that every phrase of a block costs a few array operations. A shuffle adds up the
counts of fingerprints, combined in each task first. Single words and pairs come first; of longer
phrases only those count whose two parts without the last and without the first word are frequent, since no
phrase is more frequent than its parts.

The frequent fingerprints go into a bit array of bounded size that every task gets. A last
pass finds the occurrences that it may hold and keeps for each phrase a pointer to one occurrence. There phrases are
told apart by their words and not by fingerprints: texts that share a fingerprint are counted apart, and only
phrases whose fingerprint is frequent are ever written out as text. Collisions, and bits set by other
fingerprints, so cost time and change no count: a fingerprint is at least as frequent as each of its phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm import segments
from sluice.llm.common import byte_texts, materialise, partitions, slices, text_batches

DELIMITERS, SPACE = b".,;:!?\n\x0b\x0c\r", b" \t"
#: Bytes of text whose phrases are hashed at once, about; arrays take some 60 times as much.
BLOCK = 1 << 19
#: Bits per frequent fingerprint, probes, and the most bits of the array: 32 MB. Beyond that more phrases pass it that are not frequent.
BITS_EACH, PROBES, MOST_BITS = 12, 3, 1 << 28
#: Bits of the array that are put together as one value.
SLICE = 1 << 19
#: Parts in which a language is ranked before its best phrases meet.
MOST_PARTS = 256


def parts(text: bytes) -> Iterator[bytes]:
    """A text cut after delimiters into parts of ``BLOCK`` bytes or a little more; no phrase crosses a delimiter."""
    import re

    delimiter, at = re.compile(b"[" + re.escape(DELIMITERS) + b"]"), 0
    while len(text) - at > BLOCK:
        found = delimiter.search(text, at + BLOCK)
        if not found:
            break
        yield text[at : found.end()]
        at = found.end()
    yield text[at:]


class Block:
    """The words of some texts, their pieces and hashes, and the fingerprints of their phrases."""

    def __init__(self, langs: list[bytes], texts: list[bytes], hasher: segments.Hasher):
        import numpy as np
        from xxhash import xxh64_intdigest

        self.raw = b"".join(t.lower() + b"\n" for t in texts)
        data = np.frombuffer(self.raw, np.uint8)
        delimiter = segments.flags(DELIMITERS)[data]
        plain = ~(delimiter | segments.flags(SPACE)[data])
        edges = np.diff(plain.astype(np.int8), prepend=0)
        self.starts, self.ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        self.piece = np.cumsum(delimiter)[self.starts]
        text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), self.starts, "right")
        self.langs = list(dict.fromkeys(langs))
        number = {x: i for i, x in enumerate(self.langs)}
        self.lang = np.array([number[x] for x in langs])[text]
        self.salt = np.array([xxh64_intdigest(x, 13) for x in self.langs], np.uint64)
        words = hasher(data, self.starts, self.ends)
        self.inverse = hasher.inverse
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * hasher.power[: len(words)], out=self.sums[1:])

    def phrases(self, size: int):
        """The first words of all phrases of ``size`` words, and their fingerprints."""
        import numpy as np

        count = max(0, len(self.starts) - size + 1)
        at = np.flatnonzero(self.piece[size - 1 :] == self.piece[:count])
        h = (self.sums[at + size] - self.sums[at]) * self.inverse[at]
        return at, segments.mixed((h + np.uint64(size)) ^ self.salt[self.lang[at]])


def blocks(batches, hasher) -> Iterator[Block]:
    """Blocks of the texts of Arrow batches of ``lang`` and ``text``."""
    langs, texts, size = [], [], 0
    for batch in slices(batches, 256):
        for lang, text in zip(byte_texts(batch.column(0)), byte_texts(batch.column(1)), strict=True):
            for part in parts(text):
                langs.append(lang)
                texts.append(part)
                size += len(part) + 1
                if size >= BLOCK:
                    yield Block(langs, texts, hasher)
                    langs, texts, size = [], [], 0
    if texts:
        yield Block(langs, texts, hasher)


def probes(fingerprints, bits: int):
    """The places of fingerprints in an array of ``bits`` bits, a power of two."""
    import numpy as np

    step = segments.mixed(fingerprints ^ np.uint64(0x5851F42D4C957F2D)) | np.uint64(1)
    return [((fingerprints + np.uint64(i) * step) & np.uint64(bits - 1)).astype(np.int64) for i in range(PROBES)]


class Members:
    """A bit array that holds fingerprints; says yes for all of them and for few others."""

    def __init__(self, bits: int, shared):
        self.bits, self.shared = bits, shared

    def __call__(self, fingerprints):
        import numpy as np

        array = np.frombuffer(self.shared.value, np.uint8)
        found = np.ones(len(fingerprints), bool)
        for place in probes(fingerprints, self.bits):
            found &= (array[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        return found


def members(fingerprints: DataFrame) -> Members:
    """The bit array of the ``fp`` of a table. It is put together by tasks, slice by slice; the
    driver gets the slices, ``MOST_BITS`` at most, and no fingerprint."""
    import pyarrow as pa

    spark = fingerprints.sparkSession
    bits = 1 << 16
    wanted = min(MOST_BITS, BITS_EACH * fingerprints.count())
    while bits < wanted:
        bits *= 2

    def placed(batches):
        import numpy as np

        for batch in batches:
            places = np.unique(np.concatenate(probes(batch.column(0).to_numpy().view(np.uint64), bits)))
            yield pa.RecordBatch.from_arrays([pa.array(places // SLICE), pa.array(places % SLICE)], names=["slice", "place"])

    def gathered(batches):
        import numpy as np

        made = {}
        for batch in batches:
            number, place = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i in np.unique(number).tolist():
                own = made.setdefault(i, np.zeros(SLICE, bool))
                own[place[number == i]] = True
        for i, own in made.items():
            packed = np.packbits(own, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([packed], pa.binary())], names=["slice", "bits"])

    places = fingerprints.select("fp").mapInArrow(placed, "slice bigint, place bigint")
    array = bytearray(max(bits, SLICE) // 8)
    for row in places.repartition(partitions(spark), "slice").mapInArrow(gathered, "slice bigint, bits binary").toLocalIterator():
        array[row.slice * SLICE // 8 : (row.slice + 1) * SLICE // 8] = row.bits
    return Members(bits, spark.sparkContext.broadcast(bytes(array)))


def frequent(rows: DataFrame, sizes: list[int], least: int, known: Members | None = None) -> DataFrame:
    """``fp`` of all phrases of the given numbers of words that occur at least ``least`` times; with ``known`` those whose
    two longest parts are known to be frequent only."""
    import pyarrow as pa

    def counted(batches):
        import numpy as np

        hasher = segments.Hasher()
        for block in blocks(batches, hasher):
            for size in sizes:
                at, fps = block.phrases(size)
                if known is not None:
                    begin, shorter = block.phrases(size - 1)
                    good = np.zeros(len(block.starts) + 1, bool)
                    good[begin[known(shorter)]] = True
                    fps = fps[good[at] & good[at + 1]]
                values, counts = np.unique(fps, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], names=["fp", "n"])

    found = rows.mapInArrow(counted, "fp bigint, n bigint").groupBy("fp").agg(F.sum("n").alias("n"))
    return materialise(found.filter(F.col("n") >= least).select("fp"), "frequent")


def phrase_counts(rows: DataFrame, most_words: int, least: int, known: Members) -> DataFrame:
    """``lang, phrase, words, f`` of all phrases that occur at least ``least`` times, and of each language the number of
    its words as the phrase of no words."""
    import pyarrow as pa

    def written(batches):
        import numpy as np

        hasher = segments.Hasher()
        for block in blocks(batches, hasher):
            texts = [block.raw[a:b] for a, b in zip(block.starts.tolist(), block.ends.tolist(), strict=True)]
            numbers: dict[bytes, int] = {}
            word = np.fromiter((numbers.setdefault(t, len(numbers)) for t in texts), np.int64, len(texts))
            langs, per_lang = np.unique(block.lang, return_counts=True)
            lang, phrase, words, n = [block.langs[i] for i in langs.tolist()], [b""] * len(langs), [0] * len(langs), per_lang.tolist()
            for size in range(1, most_words + 1):
                at, fps = block.phrases(size)
                at = at[known(fps)]
                key, most = block.lang[at], len(block.langs)
                for i in range(size):
                    if most * len(numbers) >= 1 << 62:  # numbered anew, so that it cannot overflow
                        key, most = np.unique(key, return_inverse=True)[1], len(at)
                    key, most = key * len(numbers) + word[at + i], most * len(numbers)
                _, first, count = np.unique(key, return_index=True, return_counts=True)
                pointers = at[first].tolist()
                lang += [block.langs[i] for i in block.lang[at[first]].tolist()]
                phrase += [b" ".join(texts[p : p + size]) for p in pointers]
                words += [size] * len(pointers)
                n += count.tolist()
            columns = [pa.array(lang, pa.binary()), pa.array(phrase, pa.binary())]
            columns = [c.cast(pa.string()) for c in columns] + [pa.array(words, pa.int32()), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "words", "f"])

    found = rows.mapInArrow(written, "lang string, phrase string, words int, f bigint")
    total = found.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
    return materialise(total.filter((F.col("f") >= least) | (F.col("words") == 0)), "phrases")


def word_range(first, count):
    """Words of the phrase from number ``first``, joined."""
    return F.array_join(F.slice(F.split("phrase", " "), first, count), " ")


def scored(counts: DataFrame, least_words: int) -> DataFrame:
    """``lang, phrase, words, a, l, r, score`` of each candidate at its lowest-scoring cut."""
    candidates = counts.filter(F.col("words") >= least_words)
    cuts = candidates.withColumnRenamed("f", "a").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("*", word_range(F.lit(1), F.col("k")).alias("first"), word_range(F.col("k") + 1, F.col("words")).alias("rest"))
    known = counts.filter("words > 0").select(F.col("lang").alias("of"), F.col("phrase").alias("part"), "f")
    left = known.select("of", F.col("part").alias("first"), F.col("f").alias("l")).withColumnRenamed("of", "lang")
    right = known.select("of", F.col("part").alias("rest"), F.col("f").alias("r")).withColumnRenamed("of", "lang")
    both = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    # decimals of 38 digits: counts up to 10 to the 15th are exact
    score = F.expr("CAST(1000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(15, 0)) * CAST(a AS DECIMAL(15, 0))"
                   " DIV (CAST(l AS DECIMAL(15, 0)) * CAST(r AS DECIMAL(15, 0)))")  # fmt: skip
    low = both.withColumn("score", score).groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("low"))
    return low.select("lang", "phrase", "words", "a", "low.l", "low.r", "low.score")


def longest(counts: DataFrame, least_words: int) -> DataFrame:
    """``lang, phrase`` of all phrases inside a longer candidate, with the largest count ``longer`` of such."""
    longer = counts.filter(F.col("words") > least_words)
    sizes = longer.withColumn("size", F.explode(F.sequence(F.lit(least_words), F.col("words") - 1)))
    places = sizes.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    inside = places.select("lang", word_range(F.col("at"), F.col("size")).alias("phrase"), "f")
    return inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    least_words: int = 2,
    most_words: int = 3,
    least_count: int = 10,
    inside_percent: int = 50,
    first: int = 2000,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``first`` best phrases of each language.

    Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at blanks and tabs into words.
    A phrase of ``least_words`` to ``most_words`` words that occurs ``a >= least_count`` times within pieces scores
    ``floor(1000000 * a * a / (l * r))`` at the cut into parts of ``l`` and ``r`` occurrences where that is lowest, of equal
    ones the earliest. Phrases inside a longer candidate with ``100 * f >= inside_percent * a`` are left out. Ranks
    follow score and ``a`` downwards, then the phrase's bytes; ``n`` counts the language's words.

    NULL text is empty, a NULL language is ``und``, repeated rows count again. A language without such a phrase has no
    row; an empty table gives none. Texts of any length are read whole; one piece above 0.5 MB is held at once. Other
    columns of ``docs`` are not read.
    """
    if not 2 <= least_words <= most_words:
        raise ValueError(f"phrases have two words or more: {least_words} to {most_words}")
    text_batches(docs.sparkSession)
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    rows = docs.select(lang.alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = frequent(rows, [1, 2], least_count)
    for size in range(3, most_words + 1):
        found = found.union(frequent(rows, [size], least_count, members(found)))
    counts = phrase_counts(rows, most_words, least_count, members(found))
    inside = longest(counts, least_words)
    best = scored(counts, least_words).join(inside, ["lang", "phrase"], "left")
    kept = best.filter(F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a"))).drop("longer")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language may have most of the phrases: each part gives its best before they meet
    part = F.pmod(F.xxhash64("phrase"), F.lit(min(MOST_PARTS, partitions(docs.sparkSession))))
    ranked = kept.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    ranked = ranked.filter(F.col("rank") <= first).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    totals = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.filter(F.col("rank") <= first).join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
