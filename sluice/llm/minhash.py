"""MinHash near-duplicates found by a multi-index join of b-bit signatures in Hamming space.

A set of word shingles has a signature of ``SLOTS`` slots; each keeps ``b = 8`` bits of a MinHash, and
the distance of two signatures is the number of slots that differ. Sets of similarity 0.85 differ in
0.15 of the slots on average; ``max_distance`` allows 31 of 96, which a pair at the very threshold passes
but for a chance of about 5 in a million.

The signature is cut into chunks of six slots. Were all 16 chunks of two signatures apart in two slots or
more, the whole would be apart in 32: so one chunk differs in at most one slot. Every signature is
indexed once per chunk and per slot that may be in error, under the five other slots. Two
signatures within the distance share a key, by the pigeonhole principle, and no such pair is missed.

Only distinct word sequences are indexed, so exact copies cost one row. Rows are sorted by key over all
partitions by range, which also cuts a key with very many rows into pieces; keys of one row
end there. What shares a key is compared by signature in blocks of bounded size, and gives the edges of a
spanning forest and never all its pairs. The connected parts of that graph are families. Links are
confirmed on the whole shingle sets: each member of a family against its first one, and the members that this
leaves unlinked against all others, block by block. Members linked to the first are one component already,
so no pair among them is looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import byte_texts, discard, materialise, partitions, slices, text_batches
from sluice.llm.simhash import components

SLOTS, CHUNK = 96, 6
CHUNKS = SLOTS // CHUNK
#: Slots in which linked signatures may differ: less than twice the number of chunks.
MAX_DISTANCE = 2 * CHUNKS - 1
#: Rows of a key, and bytes of words of a family, that one task holds at once; more are compared in pairs of blocks.
BLOCK_ROWS, BLOCK_BYTES = 2048, 1 << 21
#: Runs of a key up to this size are compared by shifted arrays.
SMALL_RUN = 8


def shingle_set(text: bytes, size: int) -> tuple[bytes, set[bytes]]:
    """The lower-cased words joined by spaces, and the distinct runs of ``size`` words; fewer words are one shingle."""
    words = text.lower().split()
    joined = b" ".join(words)
    if len(words) <= size:
        return joined, {joined} if words else set()
    ends, at = [], 0
    for word in words:
        at += len(word)
        ends.append(at)
        at += 1
    starts = [0, *[e + 1 for e in ends[:-1]]]
    return joined, {joined[a:b] for a, b in zip(starts, ends[size - 1 :], strict=False)}


def factors(slots: int = SLOTS):
    """Fixed odd factors and offsets of the hash functions, 32 bits each."""
    import numpy as np

    random = np.random.default_rng(11)
    return (random.integers(0, 1 << 32, (slots, 1), np.uint64) | np.uint64(1)).astype(np.uint32), random.integers(
        0, 1 << 32, (slots, 1), np.uint64
    ).astype(np.uint32)


def signature(shingles: set[bytes], hashing) -> bytes:
    """One byte per slot: eight well-mixed bits of the least hash of all shingles."""
    import numpy as np
    from xxhash import xxh32_intdigest

    factor, offset = hashing
    least = np.full(len(factor), 0xFFFFFFFF, np.uint32)
    hashes = np.fromiter(map(xxh32_intdigest, shingles), np.uint32, len(shingles))
    for first in range(0, len(hashes), 1024):
        some = factor * hashes[first : first + 1024]
        some += offset
        np.minimum(least, some.min(axis=1), out=least)
    mixed = (least ^ (least >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    mixed = (mixed ^ (mixed >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return (mixed >> np.uint32(24)).astype(np.uint8).tobytes()


def signed(docs: DataFrame, shingle_words: int, id_col: str, text_col: str) -> DataFrame:
    """Per row ``row``, ``id``, the size ``n`` of its set, a ``digest`` of its words, ``sig`` and the ``words``."""
    import pyarrow as pa

    text_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def hashed(batches):
        from hashlib import blake2b

        hashing = factors()
        for batch in slices(batches, 512):
            out = []
            for text in byte_texts(batch.column(1)):
                words, shingles = shingle_set(text, shingle_words)
                digest = blake2b(words, digest_size=16).digest()
                out.append((len(shingles), digest, signature(shingles, hashing) if shingles else b"", words))
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), *[pa.binary()] * 3), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "n", "digest", "sig", "words"])

    kind = rows.schema["id"].dataType.simpleString()
    made = rows.mapInArrow(hashed, f"id {kind}, n bigint, digest binary, sig binary, words binary")
    return made.select(F.monotonically_increasing_id().alias("row"), "*")


def keys(signatures: DataFrame) -> DataFrame:
    """``key`` and ``node``, one row per chunk and slot left out. The key ends with the byte left out: rows
    that agree on all but that byte follow each other."""
    import pyarrow as pa

    def enumerated(batches):
        import numpy as np

        for batch in slices(batches, 4096):
            nodes = batch.column(0).to_numpy()
            chunks = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, CHUNKS, CHUNK).astype(np.int64)
            number = np.arange(CHUNKS, dtype=np.int64)
            out = []
            for error in range(CHUNK):
                key = number * CHUNK + error
                for slot in [*(s for s in range(CHUNK) if s != error), error]:
                    key = (key << 8) | chunks[:, :, slot]
                out.append(key)
            made = np.stack(out, axis=2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(made.ravel()), pa.array(np.repeat(nodes, CHUNKS * CHUNK))], names=["key", "node"]
            )

    return signatures.select("node", "sig").mapInArrow(enumerated, "key bigint, node bigint")


def shared_keys(signatures: DataFrame) -> DataFrame:
    """``key`` (without the byte left out) and ``node`` for keys of two nodes or more.

    Rows are dealt by ranges of key and node, so a key's rows may lie in several partitions: the first and
    the last key of a partition are kept whatever their number. A run whose nodes also agree on the byte left out
    is kept under the first such key of its chunk only.
    """
    import pyarrow as pa

    count = partitions(signatures.sparkSession)
    ranged = keys(signatures).repartitionByRange(count, "key", "node").sortWithinPartitions("key", "node")

    def shared(batches):
        import numpy as np

        def kept(whole, nodes, first, last):
            key = whole >> 8
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(key)])
            ends = starts + sizes - 1
            chosen = (sizes > 1) & (((key[starts] >> 40) % CHUNK == 0) | (whole[starts] != whole[ends]))
            if first:
                chosen[0] = True
            if last:
                chosen[-1] = True
            rows = np.repeat(chosen, sizes)
            return pa.RecordBatch.from_arrays([pa.array(key[rows]), pa.array(nodes[rows])], names=["key", "node"])

        key, node, first = np.zeros(0, np.int64), np.zeros(0, np.int64), True
        for batch in batches:
            k, n = (batch.column(i).to_numpy() for i in (0, 1))
            if not len(k):
                continue
            key, node = np.concatenate([key, k]), np.concatenate([node, n])
            cut = int(np.searchsorted(key, key[-1] >> 8 << 8, "left"))  # the last run may go on
            if not cut and len(key) > 65_536:  # of a very long run all but two rows go on at once
                yield pa.RecordBatch.from_arrays([pa.array(key[:-2] >> 8), pa.array(node[:-2])], names=["key", "node"])
                key, node, first = key[-2:], node[-2:], True  # its rest is kept as well
            elif cut:
                yield kept(key[:cut], node[:cut], first, False)
                key, node, first = key[cut:], node[cut:], False
        if len(key):
            yield kept(key, node, first, True)

    return ranged.mapInArrow(shared, "key bigint, node bigint")


def in_blocks(rows: DataFrame, group: str, blocks: str, among: str | None = None) -> DataFrame:
    """Each row once per pair of blocks of its group that it belongs to, as columns ``i`` and ``j``.

    ``blocks`` is the number of blocks of the group. With ``among``, a boolean column, blocks hold rows of
    one value of it, and pairs of blocks of true rows are left out.
    """
    dealt = rows.withColumn("_own", F.pmod(F.xxhash64("node", F.lit(7)), F.col(blocks)))
    if among is None:
        others = F.sequence(F.lit(0).cast("bigint"), F.col(blocks) - 1)
        done = dealt.withColumn("_other", F.explode(others))
    else:
        dealt = dealt.withColumn("_own", F.col("_own") * 2 + F.col(among).cast("bigint"))
        every = F.sequence(F.lit(0).cast("bigint"), F.col(blocks) * 2 - 1)
        unlinked = F.filter(every, lambda x: x % 2 == 0)
        done = dealt.withColumn("_other", F.explode(F.when(F.col(among), unlinked).otherwise(every)))
    pair = done.select("*", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"))
    count = partitions(rows.sparkSession)
    return pair.drop("_own", "_other").repartition(count, group, "i", "j").sortWithinPartitions(group, "i", "j")


def near(sig, sizes, other, other_sizes, max_distance: int, percent: int):
    """Whether signatures (rows of bytes) lie within the distance and sizes allow the similarity; broadcast."""
    import numpy as np

    fits = 100 * np.minimum(sizes, other_sizes) >= percent * np.maximum(sizes, other_sizes)
    return fits & (np.count_nonzero(sig != other, axis=-1) <= max_distance)


def forest(nodes, sigs, sizes, max_distance: int, percent: int) -> list:
    """Edges of a spanning forest of the graph of near signatures."""
    import numpy as np

    edges, left = [], np.arange(len(nodes))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            found = near(sigs[left], sizes[left], sigs[at], sizes[at], max_distance, percent)
            if found.any():
                reached = left[found]
                edges.append(np.stack([np.full(len(reached), nodes[at]), nodes[reached]]))
                queue.extend(reached)
                left = left[~found]
    return edges


def groups(batches, count: int) -> Iterator:
    """Arrow tables of whole groups of a stream that is sorted by its first ``count`` columns, several at once."""
    import numpy as np
    import pyarrow as pa

    waiting = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = [batch.column(i).to_numpy() for i in range(count)]
        changed = np.zeros(batch.num_rows, bool)
        for c in ids:
            changed[1:] |= c[1:] != c[:-1]
        cuts = np.flatnonzero(changed)
        if waiting and any(waiting[-1].column(i)[-1].as_py() != c[0] for i, c in enumerate(ids)):
            yield pa.Table.from_batches(waiting)
            waiting = []
        if len(cuts):
            last = int(cuts[-1])
            yield pa.Table.from_batches([*waiting, batch.slice(0, last)])
            waiting = [batch.slice(last)]
        else:
            waiting.append(batch)
    if waiting:
        yield pa.Table.from_batches(waiting)


def runs(table, count: int):
    """Starts and ends of the groups in such a table."""
    import numpy as np

    changed = np.zeros(table.num_rows, bool)
    changed[:1] = True
    for i in range(count):
        c = table.column(i).to_numpy()
        changed[1:] |= c[1:] != c[:-1]
    starts = np.flatnonzero(changed)
    return starts, np.r_[starts[1:], table.num_rows]


def near_signatures(signatures: DataFrame, max_distance: int, percent: int, block_rows: int) -> DataFrame:
    """``a``, ``b``: edges that connect all nodes whose signatures lie within the distance."""
    import pyarrow as pa

    shared = materialise(shared_keys(signatures), "shared-keys")
    counted = shared.groupBy("key").agg(F.count("*").alias("rows")).filter("rows > 1")
    counted = counted.select("key", F.ceil(F.col("rows") / block_rows).cast("bigint").alias("blocks"))
    rows = shared.join(counted, "key").join(signatures, "node").select("key", "blocks", "node", "n", "sig")

    def compared(batches):
        import numpy as np

        for table in groups(batches, 3):
            starts, ends = runs(table, 3)
            nodes, sizes = table.column("node").to_numpy(), table.column("n").to_numpy()
            sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(-1, SLOTS)
            lengths, edges = ends - starts, []
            length = np.repeat(lengths, lengths)
            group = np.repeat(np.arange(len(starts)), lengths)
            small = np.flatnonzero((length > 1) & (length <= SMALL_RUN))
            for shift in range(1, SMALL_RUN):
                x, y = small[:-shift], small[shift:]
                same = group[x] == group[y]
                x, y = x[same], y[same]
                if not len(x):
                    break
                found = near(sigs[x], sizes[x], sigs[y], sizes[y], max_distance, percent)
                edges.append(np.stack([nodes[x[found]], nodes[y[found]]]))
            for i in np.flatnonzero(lengths > SMALL_RUN):
                a, b = starts[i], ends[i]
                edges += forest(nodes[a:b], sigs[a:b], sizes[a:b], max_distance, percent)
            both = np.concatenate([np.zeros((2, 0), np.int64), *edges], axis=1)
            both = np.unique(np.sort(both, axis=0), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])

    blocks = in_blocks(rows, "key", "blocks").select("key", "i", "j", "node", "n", "sig")
    found = materialise(blocks.mapInArrow(compared, "a bigint, b bigint").distinct(), "near-signatures")
    discard(shared)
    return found


def similar(a: set, b: set, percent: int) -> bool:
    both = len(a & b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirmed_with_first(members: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """``node`` and ``linked``: whether the node's set is similar to that of its family's first member.

    Members of a family are read one after the other, each beside the words of the first.
    """
    import pyarrow as pa

    first = members.filter("node = root").select("root", F.col("words").alias("first_words"))
    pairs = members.filter("node != root").join(first, "root").select("root", "node", "words", "first_words")

    def checked(batches):
        last, known = None, set()
        for batch in slices(batches, 256):
            out = []
            for words, first_words in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if first_words != last:
                    last, known = first_words, shingle_set(first_words, shingle_words)[1]
                out.append(similar(shingle_set(words, shingle_words)[1], known, percent))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out)], names=["root", "node", "linked"])

    return pairs.mapInArrow(checked, "root bigint, node bigint, linked boolean")


def confirmed_in_blocks(members: DataFrame, linked: DataFrame, shingle_words: int, max_distance: int, percent: int,
                        block_bytes: int) -> DataFrame:
    """``a``, ``b``: edges that connect all similar pairs of families of which not all are linked to the first.

    Blocks hold linked members (with the first) or unlinked ones; a pair of blocks of linked members has nothing to find.
    """
    import pyarrow as pa

    sizes = members.groupBy("root").agg(F.count("*").alias("rows"), F.sum(F.length("words") + 64).alias("bytes"))
    open_families = linked.groupBy("root").agg(F.count_if(~F.col("linked")).alias("open")).filter("open > 0")
    # in a family of two, both were compared already
    sizes = sizes.filter("rows > 2").join(open_families.select("root"), "root")
    sizes = sizes.select("root", F.ceil(F.col("bytes") / block_bytes).cast("bigint").alias("blocks"))
    known = linked.select("node", "linked")
    rows = members.join(sizes, "root").join(known, "node", "left")
    rows = rows.select("root", "blocks", "node", "n", "sig", "words", F.coalesce("linked", F.lit(True)).alias("linked"))

    def compared(batches):
        import numpy as np

        for table in groups(slices(batches, 64), 3):
            for start, end in zip(*runs(table, 3), strict=True):
                part = table.slice(int(start), int(end - start))
                own, words = part.column("linked").to_numpy(), part.column("words").to_pylist()
                nodes, count = part.column("node").to_numpy(), part.column("n").to_numpy()
                sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint8).reshape(-1, SLOTS)
                numbers: dict[bytes, int] = {}
                sets: dict[int, set[int]] = {}

                def members_of(i, words=words, sets=sets, numbers=numbers):
                    if i not in sets:
                        made = shingle_set(words[i], shingle_words)[1]
                        sets[i] = {numbers.setdefault(s, len(numbers)) for s in made}
                    return sets[i]

                group = np.where(own, -1, np.arange(len(nodes)))  # linked ones are one component
                found = []
                for i in range(len(nodes)):
                    after = np.arange(i + 1, len(nodes))
                    after = after[group[after] != group[i]]
                    if not len(after):
                        continue
                    after = after[near(sig[after], count[after], sig[i], count[i], max_distance, percent)]
                    for k in after.tolist():
                        if group[k] != group[i] and similar(members_of(i), members_of(k), percent):
                            found.append((nodes[i], nodes[k]))
                            group[group == group[k]] = group[i]
                    sets.pop(i, None)
                both = np.array(found, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    blocks = in_blocks(rows, "root", "blocks", among="linked")
    return blocks.select("root", "i", "j", "node", "n", "sig", "words", "linked").mapInArrow(compared, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = 5,
    percent: int = 85,
    max_distance: int = MAX_DISTANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_rows: int = BLOCK_ROWS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable) and ``kept`` per row.

    Two rows are linked if ``100 * |intersection| >= percent * |union|`` of their sets of lower-cased word shingles.
    NULL and texts without words have an empty set and are linked with nothing, not even each other.
    Rows are documents: repeated rows give repeated results, equal ids of different texts are different
    documents. A NULL id belongs to a group but never names it; a group of NULL ids has a NULL ``component_id``.
    ``kept`` is ``doc_id <=> component_id``. An empty table gives an empty result. Texts are compared whole,
    whatever their length. Other columns of ``docs`` are not read.
    """
    if not 0 <= max_distance < 2 * CHUNKS:
        raise ValueError(f"max_distance must be below {2 * CHUNKS}: {max_distance}")
    marked = materialise(signed(docs, shingle_words, id_col, text_col), "signed")
    alike = marked.filter("n > 0").groupBy("digest").agg(F.min("row").alias("node"), F.min("id").alias("first_id"))
    nodes = materialise(alike, "nodes")
    own = marked.join(nodes.select(F.col("node").alias("row")), "row", "left_semi")
    signatures = materialise(own.select(F.col("row").alias("node"), "n", "sig"), "signatures")
    edges = near_signatures(signatures, max_distance, percent, block_rows)
    families = components(edges)
    families = families.union(families.select(F.col("root").alias("node"), "root").distinct())
    words = marked.select(F.col("row").alias("node"), "n", "sig", "words")
    members = materialise(words.join(families, "node").select("root", "node", "n", "sig", "words"), "members")
    linked = materialise(confirmed_with_first(members, shingle_words, percent), "linked")
    more = confirmed_in_blocks(members, linked, shingle_words, max_distance, percent, block_bytes)
    links = linked.filter("linked").select(F.col("root").alias("a"), F.col("node").alias("b"))
    roots = components(links.union(more.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))))
    rooted = nodes.join(roots.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left").select(
        "digest", "first_id", F.coalesce("root", "node").alias("root")
    )
    rooted = materialise(rooted, "rooted")
    lowest = materialise(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "lowest")
    grouped = materialise(rooted.join(lowest, "root").select("digest", "component_id"), "grouped")
    plain = marked.select("id", "n", F.when(F.col("n") > 0, F.col("digest")).alias("digest"))
    joined = plain.join(grouped, "digest", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return joined.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
