"""SimHash near-duplicates found by deletion-variant signatures.

Fingerprints that differ in at most ``d`` bits are cut into ``d // 2 + 1`` segments: were
all segments apart by two bits or more, the whole would be apart by more than ``d``. So one
segment differs by at most one bit, and there is a bit position whose deletion makes that
segment equal. Every fingerprint is therefore indexed once per bit position, under the
position and its segment without that bit; equal keys meet by an equality shuffle and are
verified on all 64 bits. No pair within the distance is missed.

Only distinct fingerprints are indexed, so exact copies cost one row. A group of equal keys
is walked breadth first over its members not yet reached and gives the edges of a spanning
forest, never all its pairs. A key with more than ``crowd`` members is not held in a task: its
members go on to the exact way for crowds, in which each is expanded to all values within
``d / 2`` bits and members that share such a value are linked to the smallest of them. Two
members share one exactly if they are within ``d`` bits, at a cost linear in the members.
"""

from __future__ import annotations

from itertools import accumulate, combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import byte_texts, discard, materialise, partitions, slices, text_batches

SEED = 42
#: Members of one key that a task may hold: 12 bytes each, 8 MB at most with the work arrays.
CROWD = 65_536
#: Key groups up to this size are compared by shifted arrays, larger ones by the walk.
SMALL_RUN = 24


def fingerprint(text: bytes, shingle_words: int) -> int:
    """64 bits; a bit is set if over half the hashes of the word shingles have it set."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return xxh64_intdigest(joined, SEED)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    counts, total = np.zeros(64, np.int64), len(words) - shingle_words + 1
    for first in range(0, total, 65_536):
        last = min(first + 65_536, total)
        hashes = np.fromiter(
            (
                xxh64_intdigest(joined[a : b - 1], SEED)
                for a, b in zip(starts[first:last], starts[first + shingle_words : last + shingle_words], strict=True)
            ),
            np.dtype("<u8"),
            last - first,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``fp`` (the 64 bits as a signed bigint) per row; NULL text has no words."""
    import pyarrow as pa

    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def hashed(batches):
        import numpy as np

        for batch in slices(batches, 512):
            values = [fingerprint(t, shingle_words) for t in byte_texts(batch.column(1))]
            fps = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], names=["id", "fp"])

    return rows.mapInArrow(hashed, f"id {rows.schema['id'].dataType.simpleString()}, fp bigint")


def signatures(nodes: DataFrame, max_bits: int) -> DataFrame:
    """One row per fingerprint and bit position: ``key`` is the position and the rest of its segment."""
    segments = max(2, max_bits // 2 + 1)
    edges = [round(64 * i / segments) for i in range(segments + 1)]
    keys = []
    for low, high in zip(edges, edges[1:], strict=False):
        segment = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        for position in range(low, high):
            kept = segment.bitwiseAND(F.lit(~(1 << (position - low))))
            keys.append(kept.bitwiseOR(F.lit(position << 32)))
    return nodes.select(F.explode(F.array(*keys)).alias("key"), "fp")


def forest(fps, max_bits: int) -> list:
    """Edges of a spanning forest of the links between distinct fingerprints."""
    import numpy as np

    edges, left = [], fps
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= max_bits
            if near.any():
                reached = left[near]
                edges.append(np.stack([np.full(len(reached), at), reached]))
                queue.extend(reached)
                left = left[~near]
    return edges


def links(nodes: DataFrame, max_bits: int, crowd: int = CROWD) -> DataFrame:
    """``a``, ``b``: links that join all fingerprints within ``max_bits``, and rows with a NULL ``b``
    for members of crowded keys."""
    import pyarrow as pa

    spark = nodes.sparkSession
    keyed = signatures(nodes, max_bits).repartition(partitions(spark), "key").sortWithinPartitions("key")

    def rows(edges, hot=()):
        import numpy as np

        both = np.concatenate([np.zeros((2, 0), np.uint64), *edges], axis=1)
        low, high = both.min(axis=0), both.max(axis=0)
        a = np.concatenate([low, *hot]).view(np.int64)
        b = np.concatenate([high, np.zeros(len(a) - len(low), np.uint64)]).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(a), pa.array(b, mask=np.arange(len(a)) >= len(low))], names=["a", "b"]
        )

    def compared(keys, fps):
        """Links within all runs of equal keys, and the members of crowded runs."""
        import numpy as np

        edges, hot = [], []
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        size_of = np.repeat(sizes, sizes)
        small = (size_of > 1) & (size_of <= SMALL_RUN)
        k, f = keys[small], fps[small]
        for shift in range(1, min(SMALL_RUN, len(k))):
            same = np.flatnonzero(k[shift:] == k[:-shift])
            if not len(same):
                break
            x, y = f[same], f[same + shift]
            near = np.bitwise_count(x ^ y) <= max_bits
            edges.append(np.stack([x[near], y[near]]))
        for i in np.flatnonzero(sizes > SMALL_RUN):
            run = fps[starts[i] : starts[i] + sizes[i]]
            if len(run) > crowd:
                hot.append(run)
            else:
                edges.extend(forest(run, max_bits))
        return rows(edges, hot)

    def linked(batches):
        import numpy as np

        keys, fps, crowded = np.zeros(0, np.int64), np.zeros(0, np.uint64), None
        for batch in batches:
            k = batch.column(0).to_numpy(zero_copy_only=False)
            f = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if crowded is not None:  # the rest of a run whose first members have gone on
                more = k == crowded
                if more.any():
                    yield rows([], [f[more]])
                    k, f = k[~more], f[~more]
            if not len(k):
                continue
            keys, fps = np.concatenate([keys, k]), np.concatenate([fps, f])
            cut = int(np.searchsorted(keys, keys[-1], "left"))  # the last run may go on in the next batch
            if cut:
                yield compared(keys[:cut], fps[:cut])
            keys, fps = keys[cut:], fps[cut:]
            if len(keys) > crowd:
                yield rows([], [fps])
                crowded, keys, fps = int(keys[0]), keys[:0], fps[:0]
        if len(keys):
            yield compared(keys, fps)

    return keyed.mapInArrow(linked, "a bigint, b bigint")


def crowd_links(members: DataFrame, max_bits: int) -> DataFrame:
    """Links among ``fp`` by shared values within half the distance; see the module's text."""
    import pyarrow as pa
    half = max_bits // 2
    masks = [sum(1 << i for i in c) for n in range(half + 1) for c in combinations(range(64), n)]

    def expanded(batches):
        import numpy as np

        flips = np.array(masks, np.uint64)
        for batch in slices(batches, 64):
            f = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            near = (f[:, None] ^ flips).ravel().view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(near), pa.array(np.repeat(f.view(np.int64), len(flips)))], names=["near", "fp"]
            )

    values = members.mapInArrow(expanded, "near bigint, fp bigint")
    lowest = values.groupBy("near").agg(F.min("fp").alias("low"), F.count("*").alias("n")).filter("n > 1")
    return values.join(lowest, "near").filter("fp != low").select(F.col("low").alias("a"), F.col("fp").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node of an edge (``a``, ``b``).

    Alternating stars: neighbours are handed to the smallest neighbour, first the larger ones
    and then the smaller ones, until nothing moves; rounds grow with the logarithm of the
    longest path. Each round is a written table of at most as many edges.
    """

    def state(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = materialise(edges.select("a", "b").distinct(), "stars")
    seen = state(now)
    while seen[0]:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        pairs = large.join(least, "a")
        small = (
            pairs.filter("b != m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
            .distinct()
        )
        after = materialise(small, "stars")
        before, seen = seen, state(after)
        discard(now)
        now = after
        if seen == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = 4,
    max_bits: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    crowd: int = CROWD,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable) per row.

    Texts without words have fingerprint zero and link like any other. Rows are documents:
    repeated rows give repeated results. A NULL id belongs to a group but never names it; a group
    of NULL ids only has a NULL ``component_id``. Other columns of ``docs`` are not read.
    ``max_bits`` must be even, as crowds meet half way.
    """
    if max_bits < 2 or max_bits % 2:
        raise ValueError(f"max_bits must be 2, 4, ...: {max_bits}")
    marked = materialise(fingerprints(docs, shingle_words, id_col, text_col), "fingerprints")
    nodes = marked.groupBy("fp").agg(F.min("id").alias("first_id"))
    found = materialise(links(nodes, max_bits, crowd), "links")
    edges = found.filter("b IS NOT NULL")
    members = found.filter("b IS NULL").select(F.col("a").alias("fp")).distinct()
    if not members.isEmpty():
        edges = edges.union(crowd_links(members, max_bits))
    roots = components(edges)
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    # written, so that the join below has plain exchanges, of which adaptive execution splits a large group's
    lowest = materialise(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "lowest")
    grouped = rooted.join(lowest, "root").select("fp", "component_id")
    return marked.join(grouped, "fp", "left").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
