"""One large JSON object or array in a file, read by many tasks.

A file is cut at its commas, wherever they stand, so neither a line nor an object is ever a row of its own.
A comma ends an entry only outside strings and at the first level of brackets, which a task that starts in
the middle of a file cannot know. So splits are read twice. First each split tells how its quotes and brackets change the
state, for a start inside and outside a string: a few numbers a split. Taken along a file they give the state in
which each split starts, and where the entry began that is open there. Then each split joins its pieces to entries, and those cut by
borders of splits are put together from their fragments by a shuffle of those alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The place in its split of an entry that goes on in the next: after all others.
LAST = 1 << 62


class NotOneValue(ValueError):
    """A file is not one JSON object or array: it ends inside of one, or another follows."""


def _change(marks: Column) -> Column:
    """Opening less closing brackets."""
    return F.length(marks) - 2 * F.length(F.translate(marks, "{[", ""))


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """What stands between commas, in the order of its split, with the file, the split's place, whether the quotes are odd, and
    the change of depth for a start outside and inside a string; ``broken`` if one value follows another."""
    text = spark.read.option("lineSep", ",").text(path)
    marks = F.regexp_replace("value", r'(?s)\\.|[^"\[\]{}]', "")
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    # no comma is escaped, so each piece starts after a whole character
    found = text.select(F.xxhash64(file, block).alias("split"), file.alias("file"), block.alias("block"), "value", marks.alias("marks"))
    strings = r'"[^"]*("|$)'
    outside = F.regexp_replace("marks", strings, "")
    inside = F.regexp_replace(F.concat(F.lit('"'), "marks"), strings, "")
    adjacent = r"[}\]][{\[]"
    return found.select(
        "split", "file", "block", ((F.length("marks") - F.length(F.translate("marks", '"', ""))) % 2 != 0).alias("odd"),
        _change(outside).alias("out"), _change(inside).alias("in"),
        outside.rlike(adjacent).alias("out_broken"), inside.rlike(adjacent).alias("in_broken"), F.col("value").cast("binary").alias("value"),
    )


def _runs(split):
    """Starts and ends of the runs of equal values."""
    import numpy as np

    starts = np.flatnonzero(np.r_[True, split[1:] != split[:-1]])
    return zip(starts.tolist(), [*starts[1:].tolist(), len(split)], strict=True)


def _walk(odd, out, within, inside: bool, depth: int):
    """After each piece, whether a string is open, and the depth; and before each, whether a string is open."""
    import numpy as np

    after = np.logical_xor.accumulate(np.r_[inside, odd])
    return after[1:], depth + np.cumsum(np.where(after[:-1], within, out)), after[:-1]


def _split_states(pieces: DataFrame) -> list:
    """Per split ``file, block, odd`` and for a start outside and inside a string the change of depth, the distinct depths
    at commas outside strings, and whether a value follows another. Depths count from the split's start; as many as brackets are nested."""
    import pyarrow as pa

    names = ("file", "block", "odd", "change", "depths", "broken")

    def told(known):
        return pa.RecordBatch.from_pylist(
            [dict(zip(names, [*known[:3], known[3], [sorted(x) for x in known[4]], known[5]], strict=True))],
            pa.schema([("file", pa.string()), ("block", pa.int64()), ("odd", pa.bool_()), ("change", pa.list_(pa.int64())),
                       ("depths", pa.list_(pa.list_(pa.int64()))), ("broken", pa.list_(pa.bool_()))]),
        )

    def counted(batches):
        import numpy as np

        now, known = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            split, odd, out, within, *broken = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 3, 4, 5, 6, 7))
            for a, b in _runs(split):
                if split[a] != now:
                    if known:
                        yield told(known)
                    now = split[a]
                    known = [batch.column(1)[a].as_py(), batch.column(2)[a].as_py(), False, [0, 0], [set(), set()], [False, False]]
                for start in (0, 1):
                    after, depth, before = _walk(odd[a:b], out[a:b], within[a:b], known[2] != bool(start), known[3][start])
                    known[3][start] = int(depth[-1])
                    known[4][start].update(np.unique(depth[~after]).tolist())
                    known[5][start] |= bool(np.where(before, broken[1][a:b], broken[0][a:b]).any())
                known[2] ^= bool(odd[a:b].sum() % 2)
        if known:
            yield told(known)

    schema = "file string, block bigint, odd boolean, change array<bigint>, depths array<array<bigint>>, broken array<boolean>"
    # the value itself stays in the JVM
    return pieces.withColumn("value", F.lit(None).cast("binary")).mapInArrow(counted, schema).collect()


def _starts(splits: list) -> tuple[dict, int]:
    """Per file and split whether a string is open at its start, the depth, and the place of the split where the entry began that is
    open there, if one is; and how many entries are cut."""
    by_file: dict[str, list] = {}
    for row in splits:
        by_file.setdefault(row.file, []).append(row)
    found: dict[str, dict[int, tuple]] = {}
    cut = 0
    for file, rows in by_file.items():
        inside, depth, opener = False, 0, None
        for row in sorted(rows, key=lambda r: r.block):
            found.setdefault(file, {})[row.block] = inside, depth, opener
            if row.broken[inside]:
                raise NotOneValue(f"{file}: one value follows another")
            ends = any(depth + d <= 1 for d in row.depths[inside])
            inside, depth, before = inside != row.odd, depth + row.change[inside], opener
            opener = (before if before is not None and not ends else row.block) if inside or depth > 1 else None
            cut += opener == row.block
        if inside or depth:
            raise NotOneValue(f"{file}: ends inside a value")
    return found, cut


def _joined(pieces: DataFrame, starts, whole: bool) -> DataFrame:
    """Entries that lie in one split, or without ``whole`` the fragments of the others."""
    import pyarrow as pa

    kinds = pa.schema([("file", pa.string()), ("opener", pa.int64()), ("place", pa.int64()), ("block", pa.int64()),
                       ("first", pa.bool_()), ("last", pa.bool_()), ("entry", pa.binary())])

    def entries(batches):
        import numpy as np

        at_start = starts.value
        now = file = block = opener = None
        inside, depth, place, waiting, out = False, 0, 0, [], []

        def put(last: bool, ended: bool):
            nonlocal place, opener, waiting
            is_cut = opener is not None or not ended
            if waiting and is_cut != whole:
                begun = block if opener is None else opener
                out.append((file, begun, LAST if is_cut else place, block, block == 0 and place == 0, last, b",".join(waiting)))
            place, opener, waiting = place + 1, None, []

        def batch_of():
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds.types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, schema=kinds)

        for batch in batches:
            if not batch.num_rows:
                continue
            split, odd, change, within = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 3, 4, 5))
            values = batch.column(6).to_pylist()
            for a, b in _runs(split):
                if split[a] != now:
                    put(False, False)
                    now, file, block = split[a], batch.column(1)[a].as_py(), batch.column(2)[a].as_py()
                    (inside, depth, opener), place = at_start[file][block], 0
                after, depths, _ = _walk(odd[a:b], change[a:b], within[a:b], inside, depth)
                inside, depth, at = bool(after[-1]), int(depths[-1]), a
                for end in (np.flatnonzero(~after & (depths <= 1)) + a + 1).tolist():
                    waiting += values[at:end]
                    put(bool(depths[end - 1 - a] == 0), True)
                    at = end
                waiting += values[at:b]
            if out:
                yield batch_of()
        put(False, False)
        if out:
            yield batch_of()

    schema = "file string, opener bigint, place bigint, block bigint, first boolean, last boolean, entry binary"
    return pieces.select("split", "file", "block", "odd", "out", "in", "value").mapInArrow(entries, schema)


def read_entries(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, block, place, entry``: one row per entry of the JSON object or array that each file holds, as text: ``"name": value``
    or ``value``. ``block`` and ``place`` order the entries of a file.

    Raises :class:`NotOneValue` for a file cut short or with several values. An empty file, object or array has no entries. Compressed files
    are one split each. An entry must fit into a row. The driver keeps three numbers per split, as it keeps the list of splits itself.
    """
    pieces = _pieces(spark, path)
    found, cut = _starts(_split_states(pieces))
    starts = spark.sparkContext.broadcast(found)
    text = F.col("entry").cast("string")
    columns = ["file", F.col("opener").alias("block"), "place", "first", "last"]
    rows = _joined(pieces, starts, True).select(*columns, text.alias("entry"))
    if cut:
        parts = _joined(pieces, starts, False).groupBy("file", "opener").agg(
            F.first("place").alias("place"), F.bool_or("first").alias("first"), F.bool_or("last").alias("last"),
            F.array_sort(F.collect_list(F.struct("block", text.alias("text")))).alias("parts"),
        )
        rows = rows.union(parts.select(*columns, F.array_join(F.transform("parts", lambda p: p["text"]), ",")))
    opened = F.when(F.col("first"), F.regexp_replace("entry", r"^\uFEFF?\s*[{\[]", "")).otherwise(F.col("entry"))
    closed = F.when(F.col("last"), F.regexp_replace(opened, r"[}\]]\s*$", "")).otherwise(opened)
    return rows.select("file", "block", "place", F.trim(closed).alias("entry")).filter(~F.col("entry").rlike(r"^\s*$"))


def read_split_lookup(spark: SparkSession, path: str | list[str], value_type: str, key: str = "key") -> DataFrame:
    """The rows of :func:`sluice.sources.lookups.read_lookup`, each object read by as many tasks as its file has splits.

    Of a name that occurs again the last entry counts, of several files that of the last by path. An entry that cannot
    be read is left out, and not the whole object; :func:`read_entries` shows it.
    """
    value = F.from_json(F.concat(F.lit("{"), "entry", F.lit("}")), f"map<string,{value_type}>")
    entries = read_entries(spark, path).select("file", "block", "place", F.explode(value).alias(key, "_entry"))
    last = entries.groupBy(key).agg(F.max(F.struct("file", "block", "place", "_entry")).alias("_last"))
    return last.select(key, "_last._entry.*")
