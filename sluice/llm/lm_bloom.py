"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs are gathered from all training texts and quantised on a
logarithmic scale. The filter holds an n-gram together with every level up to its own; a count is read back by probing level after level until one is missing. A document's probability
comes from such probes alone::

    P(word | previous) = (pair + weight * P(word)) / (context + weight)
    P(word)            = (count + 1) / (tokens + types + 1)

The weight is that of a fixed list under which all training texts are likeliest, each token's own
occurrence being left out of its counts.

A probe may wrongly succeed, with the chance that ``probes`` bits are set by accident, and then a
count is read too high; none is read too low. Words and pairs count from one occurrence on. The filter takes ``BITS_PER_LEVEL`` bits for each level stored. Up to
``max_bits`` it is broadcast. A larger one is dealt by ranges of keys into filters of at most ``max_bits``: documents
are dealt into buckets, each bucket asks every filter for the levels of its distinct n-grams in that range, and meets
the answers. So every n-gram keeps its level whatever the corpus, and no worker holds more than one filter.

Besides, every score comes with an exact baseline by add-one word probabilities. Its counts are no
broadcast: documents are dealt into buckets, each bucket asks for the counts of its distinct words by
a join, and meets the answers in a cogroup.
"""

from __future__ import annotations

import math
import pickle

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import segments
from sluice.llm.common import byte_texts, materialise, partitions, shipped, slices, text_batches

#: Hashes of what is no word: where a text begins and ends.
START, END = 0x5851F42D4C957F2D, 0x14057B7EF767814F
PAIR, WORD = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
#: Ratio of the counts at which one level and the next begin, apart from the lowest, which are 1, 2, 3, ...
RATIO = 1.25
MAX_LEVEL = 120
PROBES = 3
BITS_PER_LEVEL = 10
MAX_BITS = 1 << 28
#: Blocks of the filter; all probes of an n-gram fall into one.
BLOCKS = 4096
#: Bits of a block at least: all levels of a frequent n-gram, up to some 360 bits, must leave it mostly empty.
LEAST_BLOCK = 4096
#: Weights of the word probability against the pair's context to choose from.
WEIGHTS = [0.4 * 5**i for i in range(8)]
#: All tasks hash words by this key.
KEY = b"words"
#: N-grams a task gathers before it passes them on.
GATHERED = 4_000_000
#: Bits of blocks that a task sets at once, a byte each.
SET_AT_ONCE = 1 << 26


def tokens(texts: list[bytes], hasher: segments.WordHasher):
    """Hashes of all words, END after each text's, and the offsets of the texts."""
    import numpy as np

    data, offsets = segments.joined(texts)
    data = segments.lowered()[data]
    first, last = segments.words(data, offsets)
    found = hasher(data, first, last) if len(first) else np.zeros(0, np.uint64)
    before = np.searchsorted(first, offsets)
    out = np.full(len(found) + len(texts), END, np.uint64)
    owner = np.repeat(np.arange(len(texts)), np.diff(before))
    out[np.arange(len(found)) + owner] = found
    return out, before + np.arange(len(texts) + 1)


def previous(words, bounds):
    """For each token the one before it, START for the first of a text."""
    import numpy as np

    out = np.empty_like(words)
    out[1:] = words[:-1]
    out[bounds[:-1]] = np.uint64(START)
    return out


def word_keys(words):
    import numpy as np

    return segments.mixed(words * np.uint64(WORD))


def pair_keys(before, words):
    import numpy as np

    return segments.mixed(segments.mixed(before) * np.uint64(PAIR) + words)


def distinct(keys):
    """Distinct keys in order, by a sort: ``np.unique`` goes through a hash table, which takes far longer for many."""
    import numpy as np

    keys = np.sort(keys)
    return keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys


def summed(keys, counts):
    """Distinct keys in order and their total counts."""
    import numpy as np

    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


def squeezed(values) -> bytes:
    """Unsigned numbers, their bytes sorted by weight and compressed."""
    import numpy as np
    import zstandard

    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def expanded(data: bytes):
    import numpy as np
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def word_counts(texts: DataFrame) -> DataFrame:
    """``h``, ``n``: how often each token, by its hash, occurs in column ``text``; written, a row per token."""
    import pyarrow as pa

    def counted(batches):
        import numpy as np

        hasher, held, size = segments.WordHasher(KEY), [], 0

        def flush():
            keys, counts = summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
            for at in range(0, len(keys), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(keys[part].view(np.int64)), pa.array(counts[part])], names=["h", "n"])

        for batch in slices(batches, 512):
            for block in segments.blocks(byte_texts(batch.column(0))):
                held.append(np.unique(tokens(block, hasher)[0], return_counts=True))
                size += len(held[-1][0])
                if size > GATHERED:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    rows = texts.mapInArrow(counted, "h bigint, n bigint")
    return materialise(rows.groupBy("h").agg(F.sum("n").alias("n")), "word-counts")


def thresholds():
    """The counts at which levels 0, 1, ... begin."""
    import numpy as np

    out = [1]
    while len(out) <= MAX_LEVEL + 1:
        out.append(max(out[-1] + 1, math.ceil(out[-1] * RATIO)))
    return np.array(out, np.int64)


def level_of(counts):
    """Levels of counts: the logarithm, rounded down."""
    import numpy as np

    return np.minimum(np.searchsorted(thresholds(), counts, "right") - 1, MAX_LEVEL)


def levels(texts: DataFrame) -> DataFrame:
    """``words`` (or pairs), packed ``keys`` and ``levels`` of all n-grams in column ``text``, with ``histogram``,
    how many have each level; written, a row per range of keys.

    Tasks pack their distinct n-grams by range of keys; a range, one of as many as a shuffle has
    partitions, is summed in one task.
    """
    import pyarrow as pa

    ranges = partitions(texts.sparkSession)

    def gathered(batches):
        import numpy as np

        hasher = segments.WordHasher(KEY)
        held: dict[bool, list] = {True: [], False: []}
        bounds = np.array([-(-(i << 64) // ranges) for i in range(1, ranges)], np.uint64)

        def flush():
            for words, parts in held.items():
                if not parts:
                    continue
                keys, counts = summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
                cuts = np.r_[0, np.searchsorted(keys, bounds), len(keys)]
                some = np.flatnonzero(np.diff(cuts))
                packed = [[], []]
                for i in some:
                    part = slice(cuts[i], cuts[i + 1])
                    own = keys[part] >> np.uint64(16)
                    packed[0].append(squeezed(np.diff(own, prepend=np.uint64(0))))
                    packed[1].append(squeezed(counts[part]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([bool(words)] * len(some), pa.bool_()),
                        pa.array(some, pa.int64()),
                        *(pa.array(p, pa.binary()) for p in packed),
                    ],
                    names=["words", "range", "keys", "counts"],
                )

        size = 0
        for batch in slices(batches, 512):
            for block in segments.blocks(byte_texts(batch.column(0))):
                words, offsets = tokens(block, hasher)
                before = previous(words, offsets)
                single = np.r_[words, np.full(len(block), START, np.uint64)]
                held[True].append(np.unique(word_keys(single), return_counts=True))
                held[False].append(np.unique(pair_keys(before, words), return_counts=True))
                size += len(held[True][-1][0]) + len(held[False][-1][0])
                if size > GATHERED:
                    yield from flush()
                    held, size = {True: [], False: []}, 0
        yield from flush()

    def reduced(table: pa.Table) -> pa.Table:
        import numpy as np

        words = table.column("words")[0].as_py()
        parts = [
            (np.cumsum(expanded(k.as_py()), dtype=np.uint64), expanded(c.as_py()).astype(np.int64))
            for k, c in zip(table.column("keys"), table.column("counts"), strict=True)
        ]
        keys, counts = summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        level = level_of(counts) + 1
        histogram = np.bincount(level, minlength=MAX_LEVEL + 2)
        return pa.table(
            {
                "words": pa.array([words], pa.bool_()),
                "keys": pa.array([squeezed(np.diff(keys, prepend=np.uint64(0)))], pa.binary()),
                "levels": pa.array([level.astype(np.uint8).tobytes()], pa.binary()),
                "histogram": pa.array([histogram], pa.list_(pa.int64())),
            }
        )

    rows = texts.mapInArrow(gathered, "words boolean, range bigint, keys binary, counts binary")
    packed = rows.groupBy("words", "range").applyInArrow(
        reduced, "words boolean, keys binary, levels binary, histogram array<bigint>"
    )
    return materialise(packed, "levels")


def bit_places(keys, level, block_bits: int):
    """Block and bits of the probes of (48-bit keys, level)."""
    import numpy as np

    seed = segments.mixed(keys * np.uint64(PAIR) + np.uint64(level * WORD % (1 << 64)))
    step = segments.mixed(seed) | np.uint64(1)
    for i in range(PROBES):
        yield ((seed + np.uint64(i) * step) >> np.uint64(20)) & np.uint64(block_bits - 1)


class Filter:
    """The filter, or its blocks from ``first`` on, and the tokens and types it was made from."""

    def __init__(self, bits, tokens: int, types: int, first: int = 0):
        self.bits, self.tokens, self.types, self.first = bits, tokens, types, first

    def fill(self) -> float:
        import numpy as np

        return float(np.bitwise_count(self.bits).sum() / (8 * self.bits.size))

    def level(self, keys):
        """Levels of keys by repeated probes; 0 if the n-gram is not there."""
        import numpy as np

        keys = keys >> np.uint64(16)
        out, left, level = np.zeros(len(keys), np.int64), np.arange(len(keys)), 1
        width = 8 * self.bits.shape[1]
        flat = self.bits.ravel()
        while len(left) and level <= MAX_LEVEL + 1:
            own = keys[left]
            start = ((own >> np.uint64(36)) - np.uint64(self.first)) * np.uint64(width)
            there = np.ones(len(left), bool)
            for place in bit_places(own, level, width):
                at = start + place
                there &= flat[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 > 0
            left = left[there]
            out[left] = level
            level += 1
        return out

    def counts(self, keys):
        """Counts as read back: the middle of the level."""
        import numpy as np

        first = thresholds()
        return np.r_[0.0, (first[:-1] + first[1:] - 1) / 2][self.level(keys)]

    def evidence(self, words, bounds):
        """For each token the counts of the pair, of the token before it, and of itself."""
        import numpy as np

        known, at = np.unique(np.r_[words, np.uint64(START)], return_inverse=True)
        count = self.counts(word_keys(known))
        now, before = at[: len(words)], np.empty(len(words), np.int64)
        before[1:] = now[:-1]
        before[bounds[:-1]] = at[-1]
        pairs, place = np.unique(pair_keys(known[before], words), return_inverse=True)
        context = count[before]
        return np.minimum(self.counts(pairs)[place], context), context, count[now]

    def logs(self, words, bounds, training):
        """Two arrays [weight, text]: logarithms to base 10 of the texts' probabilities under each of ``WEIGHTS``, and
        the same with every token's own occurrence left out of the counts, 0 for texts that are not ``training``."""
        import numpy as np

        evidence, first = self.evidence(words, bounds), bounds[:-1]
        out = np.zeros((2, len(WEIGHTS), len(first)))
        for left_out in (0, 1):
            pair, context, count = (np.maximum(x - left_out, 0.0) for x in evidence)
            alone = np.minimum((count + 1) / (self.tokens + self.types + 1 - left_out), 1.0)
            for i, weight in enumerate(WEIGHTS):
                out[left_out, i] = np.add.reduceat(np.log((pair + weight * alone) / (context + weight)), first)
        out[1] *= training
        return out / math.log(10)


class Answers(Filter):
    """Levels of some keys as read from dealt filters, in the order of the keys."""

    def __init__(self, keys, levels, tokens: int, types: int):
        super().__init__(None, tokens, types)
        self.keys, self.levels = keys, levels

    def level(self, keys):
        import numpy as np

        own = keys >> np.uint64(16)
        order = np.argsort(own)  # a search in order stays in the cache
        out = np.empty(len(own), np.int64)
        out[order] = self.levels[np.searchsorted(self.keys, own[order])]
        return out


class Dealt:
    """Written levels with more to store than one filter may hold, and the bits that hold them all."""

    def __init__(self, packed: DataFrame, tokens: int, types: int, bits: int, max_bits: int):
        self.packed, self.tokens, self.types, self.bits, self.max_bits = packed, tokens, types, bits, max_bits

    def parts(self, least: int = 1) -> int:
        """Filters to deal to, a power of two: as many as ``max_bits`` asks for, and ``least`` at least."""
        return min(BLOCKS, 1 << (max(least, self.bits // self.max_bits) - 1).bit_length())


def needed(packed: DataFrame) -> int:
    """Bits for all levels of all n-grams."""
    stored = F.aggregate("histogram", F.struct(F.lit(0).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("sum")),
                         lambda s, n: F.struct((s["at"] + 1).alias("at"), (s["sum"] + s["at"] * n).alias("sum")), lambda s: s["sum"])
    return packed.agg(F.coalesce(F.sum(stored), F.lit(0))).first()[0] * BITS_PER_LEVEL


def rounded(bits: int) -> int:
    """The size of a filter for that many bits."""
    return max(LEAST_BLOCK * BLOCKS, 1 << (max(1, bits) - 1).bit_length())


def set_bits(packed: DataFrame, width: int) -> DataFrame:
    """``block``, ``bits``: blocks of ``width`` bits with the n-grams of one row of written levels; a block may have several rows."""
    import pyarrow as pa

    span = max(1, SET_AT_ONCE // width)

    def placed(batches):
        import numpy as np

        for batch in slices(batches, 1):
            keys = np.cumsum(expanded(batch.column(0)[0].as_py()), dtype=np.uint64)
            levels = np.frombuffer(batch.column(1)[0].as_py(), np.uint8)
            if not len(keys):
                continue
            blocks = (keys >> np.uint64(36)).astype(np.int64)
            for lowest in range(int(blocks[0]), int(blocks[-1]) + 1, span):
                part = slice(*np.searchsorted(blocks, [lowest, lowest + span]))
                if part.start == part.stop:
                    continue
                block, own_keys, level = blocks[part], keys[part], levels[part]
                own = np.zeros((int(block[-1]) - lowest + 1) * width, bool)
                for n in range(1, int(level.max()) + 1):
                    block, own_keys, level = (x[level >= n] for x in (block, own_keys, level))
                    for place in bit_places(own_keys, n, width):
                        own[(block - lowest) * width + place.astype(np.int64)] = True
                rows = np.packbits(own.reshape(-1, width), axis=1, bitorder="little")
                numbers = np.arange(lowest, lowest + len(rows))
                some = rows.any(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers[some]), pa.array([r.tobytes() for r in rows[some]], pa.binary())], names=["block", "bits"]
                )

    return packed.select("keys", "levels").mapInArrow(placed, "block bigint, bits binary")


def build(packed: DataFrame, tokens: int, types: int, max_bits: int = MAX_BITS) -> Filter:
    """The filter of written levels. Its bits come to the driver in ``BLOCKS`` rows, ``max_bits`` at most; more
    is an error, see :func:`model_of`."""
    import numpy as np
    import pyarrow as pa

    if max_bits < LEAST_BLOCK * BLOCKS or max_bits & (max_bits - 1):
        raise ValueError(f"max_bits must be a power of two from {LEAST_BLOCK * BLOCKS} on: {max_bits}")
    bits = needed(packed)
    if bits > max_bits:
        raise ValueError(f"all n-grams take {bits} bits, more than {max_bits}")
    width = rounded(bits) // BLOCKS

    def united(table: pa.Table) -> pa.Table:
        both = np.bitwise_or.reduce([np.frombuffer(b.as_py(), np.uint8) for b in table.column("bits")])
        return pa.table({"block": table.column("block")[:1], "bits": pa.array([both.tobytes()], pa.binary())})

    blocks = set_bits(packed, width).groupBy("block").applyInArrow(united, "block bigint, bits binary")
    out = np.zeros((BLOCKS, width // 8), np.uint8)
    for r in blocks.collect():
        out[r["block"]] = np.frombuffer(r["bits"], np.uint8)
    return Filter(out, tokens, types)


def model_of(packed: DataFrame, tokens: int, types: int, max_bits: int = MAX_BITS) -> Filter | Dealt:
    """A filter of all written levels, or if that takes more than ``max_bits``, what is to be dealt into several."""
    bits = needed(packed)
    return build(packed, tokens, types, max_bits) if bits <= max_bits else Dealt(packed, tokens, types, rounded(bits), max_bits)


def ngram_keys(blocks):
    """Distinct keys, of 48 bits and in order, of the words and pairs in blocks of (tokens, bounds)."""
    import numpy as np

    held = [word_keys(np.array([START], np.uint64))]
    for words, bounds in blocks:
        held += [word_keys(distinct(words)), pair_keys(previous(words, bounds), words)]
    return distinct(np.concatenate(held) >> np.uint64(16))


def read_levels(dealt: DataFrame, model: Dealt) -> DataFrame:
    """``bucket``, ``part``, ``levels``: of the distinct n-grams, in the order of their keys, of the bucket's texts in the
    key range ``part``.

    Each bucket asks the filter of each range, which is put together where the asks for it come in.
    """
    import pyarrow as pa

    spark = dealt.sparkSession
    parts = model.parts(partitions(spark))
    shift, per, width = 48 - (parts.bit_length() - 1), BLOCKS // parts, model.bits // BLOCKS
    kept: dict = {}

    def asked(texts: pa.Table) -> pa.Table:
        import numpy as np

        hasher = kept.setdefault("hasher", segments.WordHasher(KEY))
        keys = ngram_keys(tokens(b, hasher) for b in segments.blocks(byte_texts(texts.column("text").combine_chunks())))
        cuts = np.searchsorted(keys, np.arange(parts + 1, dtype=np.uint64) << np.uint64(shift))
        some = np.flatnonzero(np.diff(cuts))
        packed = [squeezed(np.diff(keys[cuts[i] : cuts[i + 1]], prepend=np.uint64(0))) for i in some]
        bucket = np.full(len(some), texts.column("bucket")[0].as_py(), np.int64)
        return pa.table({"bucket": pa.array(bucket), "part": pa.array(some, pa.int64()), "keys": pa.array(packed, pa.binary())})

    def answered(asks: pa.Table, blocks: pa.Table) -> pa.Table:
        import numpy as np
        import zstandard

        out = []
        if asks.num_rows:
            first = asks.column("part")[0].as_py() * per
            bits = np.zeros((per, width // 8), np.uint8)
            for block, own in zip(blocks.column("block").to_pylist(), blocks.column("bits"), strict=True):
                bits[block - first] |= np.frombuffer(own.as_py(), np.uint8)
            own = Filter(bits, model_tokens, model_types, first)
            for row in asks.column("keys"):
                keys = np.cumsum(expanded(row.as_py()), dtype=np.uint64) << np.uint64(16)
                out.append(zstandard.ZstdCompressor(level=1).compress(own.level(keys).astype(np.uint8).tobytes()))
        return pa.table({"bucket": asks.column("bucket"), "part": asks.column("part"), "levels": pa.array(out, pa.binary())})

    model_tokens, model_types = model.tokens, model.types
    asks = dealt.groupBy("bucket").applyInArrow(asked, "bucket bigint, part bigint, keys binary")
    blocks = set_bits(model.packed, width).withColumn("part", F.expr(f"block div {per}"))
    return asks.groupBy("part").cogroup(blocks.groupBy("part")).applyInArrow(answered, "bucket bigint, part bigint, levels binary")


def score(
    docs: DataFrame,
    counts: DataFrame,
    model: Filter | Dealt,
    training: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, scores, left_out`` per row of ``docs``; see the module's text.

    ``scores`` has the score under each of ``WEIGHTS``, and ``left_out``, for rows that are ``training``,
    the same without each token's own occurrence; for others it is 0.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    buckets = partitions(spark)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.lit(False) if training is None else training, F.lit(False)).alias("training"),
    )
    # all readers of the dealt rows take all their columns, so that they share one shuffle
    bucket = F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("bigint")
    dealt = rows.withColumn("bucket", bucket).repartition(buckets, "bucket")
    package = shipped(spark, model) if isinstance(model, Filter) else None
    model_tokens, model_types = model.tokens, model.types
    total = math.log10(model.tokens + model.types + 1)

    def asked(batches):
        import numpy as np

        hasher, held, size, at = segments.WordHasher(KEY), {}, 0, None

        def flush():
            for bucket, parts in held.items():
                keys = distinct(np.concatenate(parts)).view(np.int64)
                for i in range(0, len(keys), 100_000):
                    part = keys[i : i + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), bucket, np.int64)), pa.array(part)], names=["bucket", "h"]
                    )

        for batch in slices(batches, 512):
            owners = batch.column("bucket").to_numpy(zero_copy_only=False)
            texts = np.array([*byte_texts(batch.column("text")), None], object)[:-1]
            for at in np.unique(owners):
                for block in segments.blocks(texts[owners == at].tolist()):
                    held.setdefault(int(at), []).append(distinct(tokens(block, hasher)[0]))
                    size += len(held[int(at)][-1])
            if size > GATHERED:
                yield from flush()
                held, size = {}, 0
        yield from flush()

    asks = dealt.mapInArrow(asked, "bucket bigint, h bigint")
    answers = asks.join(counts, "h").select("bucket", "h", "n")
    if isinstance(model, Dealt):
        read = read_levels(dealt, model)
        answers = answers.unionByName(read, allowMissingColumns=True)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    kept: dict = {}

    def scored(texts: pa.Table, found: pa.Table) -> pa.Table:
        import numpy as np

        if "hasher" not in kept:
            kept["hasher"] = segments.WordHasher(KEY)
            kept["model"] = package and pickle.loads(package.value)
        raw = byte_texts(texts.column("text").combine_chunks())
        blocks = (tokens(block, kept["hasher"]) for block in segments.blocks(raw))
        own = kept["model"]
        if own is None:
            import pyarrow.compute as pc
            import zstandard

            blocks = list(blocks)
            levels = found.filter(pc.is_valid(found.column("levels"))).sort_by("part").column("levels")
            read = b"".join(zstandard.ZstdDecompressor().decompress(x.as_py()) for x in levels)
            own = Answers(ngram_keys(blocks), np.frombuffer(read, np.uint8), model_tokens, model_types)
            found = found.filter(pc.is_valid(found.column("h")))
        keys, at = np.unique(found.column("h").to_numpy().view(np.uint64), return_index=True)
        numbers = found.column("n").to_numpy()[at]
        trained = texts.column("training").to_numpy()
        out: list[list] = [[], [], [], [], []]
        done = 0
        for words, bounds in blocks:
            texts_here = len(bounds) - 1
            place = np.minimum(np.searchsorted(keys, words), max(0, len(keys) - 1))
            c = np.where(keys[place] == words, numbers[place], 0) if len(keys) else np.zeros(len(words), np.int64)
            first = bounds[:-1]
            out[0].append(np.diff(bounds))
            out[1].append(np.add.reduceat((c > 0).astype(np.int64), first))
            out[2].append(np.add.reduceat(np.log10(c + 1.0) - total, first))
            logs = own.logs(words, bounds, trained[done : done + texts_here])
            out[3].append(logs[0].T)
            out[4].append(logs[1].T)
            done += texts_here
        columns = [np.concatenate(x) if x else np.zeros(0) for x in out]
        return pa.Table.from_arrays(
            [texts.column("doc_id")]
            + [pa.array(c) for c in columns[:2]]
            + [pa.array(columns[2])]
            + [pa.array(list(c), pa.list_(pa.float64())) for c in columns[3:]],
            names=["doc_id", "n_tokens", "n_known", "base_score", "scores", "left_out"],
        )

    return dealt.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(
        scored,
        f"doc_id {id_type}, n_tokens bigint, n_known bigint, base_score double, scores array<double>, left_out array<double>",
    )


def score_documents(
    docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS
) -> tuple[DataFrame, Filter | Dealt]:
    """``doc_id, n_tokens, n_known, base_score, score`` of all rows under the model of those that are ``training``,
    and the filter, or what was dealt into several.

    NULL text is empty: its only token is the end. Repeated rows give repeated results. Without
    training texts all counts are zero. Other columns are not read.
    """
    text_batches(docs.sparkSession)
    texts = docs.filter(training).select(F.col(text_col).cast("string").alias("text"))
    counts = word_counts(texts)
    tokens_, types_ = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    model = model_of(levels(texts), tokens_, types_, max_bits)
    scored = materialise(score(docs, counts, model, training, id_col, text_col), "scores")
    sums = scored.agg(*[F.sum(F.element_at("left_out", i + 1)).alias(f"w{i}") for i in range(len(WEIGHTS))]).first()
    best = max(range(len(WEIGHTS)), key=lambda i: (sums[i] or 0.0, -i))
    return scored.select("doc_id", "n_tokens", "n_known", "base_score", F.element_at("scores", best + 1).alias("score")), model
