"""Best-fit packing of token sequences by exact-complement hashing.

Documents become pieces of at most ``capacity`` tokens. Which sequence a piece goes to depends
on its length alone, so planning needs only how many pieces have each length: at most
``capacity`` counts, whatever the corpus. The plan opens a sequence with the longest piece
left and looks up, by hash of the gap, a single, a pair or a triple of lengths that fills it
exactly and is still available; failing that, the longest piece that fits goes in and the
smaller gap is looked up again. Each pattern is consumed as often as the counts allow, which
uses up one of its lengths, so there are few patterns.

Pieces are then numbered within their length, in Spark: each task numbers its own, and counts
per task and length give the offsets. The pattern slots are ranges of these numbers.
"""

from __future__ import annotations

import zlib
from collections import Counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import byte_texts, materialise, slices, text_batches
from sluice.llm.tokens import encoder, read_tokenizer

PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 0,
    capacity: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of each document: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``.

    A document is its token ids and ``end_id``; NULL text is empty. Only documents over
    ``capacity`` are cut, all pieces but the first being full. ``task`` and ``place`` number
    the pieces of a length within the writing task.
    """
    import pyarrow as pa

    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    tokenizer = rows.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        import numpy as np
        from pyspark import TaskContext

        encode = encoder(tokenizer.value)
        end, task, seen = np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId(), Counter()
        for batch in slices(batches, 256):
            owners, numbers, starts, lengths, sums, places, ids = [], [], [], [], [], [], []
            for row, content in enumerate(encode(byte_texts(batch.column(1)))):
                content += end
                total = len(content) // 4
                at, number = 0, 0
                while at < total:
                    length = (total - at) % capacity or capacity
                    own = content[4 * at : 4 * (at + length)]
                    owners.append(row)
                    numbers.append(number)
                    starts.append(at)
                    lengths.append(length)
                    sums.append(zlib.crc32(own))
                    places.append(seen[length])
                    if with_ids:
                        ids.append(np.frombuffer(own, "<u4").astype(np.int64))
                    seen[length] += 1
                    at, number = at + length, number + 1
            columns = [
                batch.column(0).take(pa.array(owners, pa.int64())),
                pa.array(numbers, pa.int32()),
                pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(sums, pa.int64()),
                pa.array([task] * len(owners), pa.int32()),
                pa.array(places, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "place"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {id_type}, {PIECES}, task int, place bigint" + (", ids array<bigint>" if with_ids else "")
    return rows.mapInArrow(cut, schema)


class Complements:
    """Single, pair and triple lengths by their sum, among the lengths still available."""

    def __init__(self, available):
        self.available = available
        self.pairs: dict[int, tuple] = {}
        self.triples: dict[int, tuple] = {}

    def has(self, lengths, used) -> bool:
        need = Counter(lengths)
        return all(self.available[x] >= n + used[x] for x, n in need.items())

    def filling(self, gap: int, used: Counter) -> tuple | None:
        """Lengths that sum to ``gap`` and are available beside those in ``used``, if any."""
        if self.has((gap,), used):
            return (gap,)
        for index, search in ((self.pairs, self._pair), (self.triples, self._triple)):
            known = index.get(gap)
            if known is None or not self.has(known, used):
                known = search(gap, used)
                if known or not search(gap, Counter()):  # a failure for want of what is in used may not last
                    index[gap] = known
            if known:
                return known
        return None

    def _left(self, gap, used):
        left = self.available[: gap + 1].copy()
        for x, n in used.items():
            if x <= gap:
                left[x] -= n
        return left

    def _pair(self, gap, used, left=None):
        """The pair that can be used most often."""
        import numpy as np

        left = self._left(gap, used) if left is None else left
        half = gap // 2
        small, large = left[1 : half + 1], left[gap - half : gap][::-1]
        times = np.minimum(small, large)
        if len(times) and gap % 2 == 0:
            times[-1] = small[-1] // 2
        if not len(times) or times.max() < 1:
            return ()
        at = int(times.argmax()) + 1
        return (gap - at, at)

    def _triple(self, gap, used):
        import numpy as np

        left = self._left(gap, used)
        for first in np.flatnonzero(left > 0)[::-1]:
            first = int(first)
            if first > gap - 2:
                continue
            if 3 * first < gap:  # the largest of three is at least a third
                break
            rest = left[: gap - first + 1].copy()
            if first <= gap - first:
                rest[first] -= 1
            pair = self._pair(gap - first, used, rest)
            if pair:
                return (first, *pair)
        return ()


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how many sequences have each; every counted piece is used once."""
    import numpy as np

    available = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        available[length] = n
    index, patterns = Complements(available), []
    for longest in range(capacity, 0, -1):
        while available[longest]:
            pattern, used, gap = [longest], Counter([longest]), capacity - longest
            while gap:
                filling = index.filling(gap, used)
                if filling is None:
                    left = index._left(gap, used)
                    fitting = np.flatnonzero(left > 0)
                    if not len(fitting):
                        break
                    filling = (int(fitting[-1]),)
                pattern += filling
                used.update(filling)
                gap -= sum(filling)
            times = min(int(available[x]) // n for x, n in used.items())
            for x, n in used.items():
                available[x] -= n * times
            patterns.append((tuple(pattern), times))
    return patterns


def slots(patterns, capacity: int):
    """Arrays sorted by (length, first number): the pieces from there on go to ``sequence``, ``sequence + 1``, ... at ``offset``."""
    import numpy as np

    taken, sequence, rows = Counter(), 0, []
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, taken[length], sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(cut: DataFrame, capacity: int = 2048) -> DataFrame:
    """``cut`` (materialised pieces) with ``sequence_id`` and ``offset``, gapless from 0 in each sequence."""
    import pyarrow as pa

    spark = cut.sparkSession
    own = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in own.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(slots(plan(counts, capacity), capacity))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = own.select("task", "length", F.coalesce(before, F.lit(0)).alias("before"))
    numbered = cut.join(offsets, ["task", "length"]).withColumn("number", F.col("before") + F.col("place"))
    kept = [c for c in cut.columns if c not in ("task", "place")]
    numbered = numbered.select(*kept, "number")
    schema = numbered.select(*kept).schema
    schema = schema.add("sequence_id", "long").add("offset", "long")
    length_at, number_at = kept.index("length"), len(kept)

    def placed(batches):
        import numpy as np

        length, first, sequence, offset = table.value.T
        keys = length << 44 | first
        for batch in batches:
            lengths = batch.column(length_at).to_numpy(zero_copy_only=False)
            numbers = batch.column(number_at).to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, lengths << 44 | numbers, "right") - 1
            columns = [batch.column(i) for i in range(len(kept))]
            columns += [pa.array(sequence[at] + numbers - first[at]), pa.array(offset[at])]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "sequence_id", "offset"])

    return numbered.mapInArrow(placed, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = 2048, **columns) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece of every row.

    NULL text is an empty document of one token, ``end_id``; repeated rows and NULL ids are
    documents of their own; an empty table gives no rows. Other columns are not read.
    """
    return pack(materialise(pieces(docs, tokenizer_path, end_id, capacity, **columns), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id``, ``ids`` and ``starts`` (where a new piece begins) from packed pieces that carry ``ids``.

    A group is one sequence, at most ``capacity`` tokens.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten(F.col("parts.ids")).alias("ids"), F.col("parts.offset").alias("starts")
    )
