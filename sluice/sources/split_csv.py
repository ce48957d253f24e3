"""Large CSV files with newlines inside quotes, read by many tasks a file.

A newline ends a record only where the number of quotes before it is even, so a task that starts in the
middle of a file cannot tell records apart by itself. The lines of all splits are read twice.
First each split counts its quotes, and reports their parity and whether some line ends a record for
either state it may start in: a few bytes a split. Taken along a file these give the state in which each split
starts, and where the record began that is open there. Then each split joins its lines to records. What is cut by
the border of a split is put together from its fragments by a shuffle of those alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.sources.files import CSV


class OpenQuote(ValueError):
    """A file ends inside quotes."""


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Physical lines in the order of their split, with the file, the split's place and whether the quotes are odd."""
    text = spark.read.option("lineSep", "\n").text(path)
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    return text.select(
        F.xxhash64(file, block).alias("split"), file.alias("file"), block.alias("block"), (quotes % 2 != 0).alias("odd"),
        F.col("value").cast("binary").alias("value"),
    )


def _runs(split):
    """Starts and ends of the runs of equal values."""
    import numpy as np

    starts = np.flatnonzero(np.r_[True, split[1:] != split[:-1]])
    return zip(starts.tolist(), [*starts[1:].tolist(), len(split)], strict=True)


def _split_states(lines: DataFrame) -> list:
    """Per split ``file, block, odd, even_end, odd_end``: the parity of its quotes, and whether a line ends after an
    even or an odd number of them."""
    import pyarrow as pa

    def counted(batches):
        import numpy as np

        now, known = None, []

        def told():
            return pa.RecordBatch.from_pylist([dict(zip(("file", "block", "odd", "even_end", "odd_end"), known, strict=True))])

        for batch in batches:
            if not batch.num_rows:
                continue
            split, odd = batch.column(0).to_numpy(), batch.column(3).to_numpy(zero_copy_only=False)
            for a, b in _runs(split):
                if split[a] != now:
                    if known:
                        yield told()
                    now, known = split[a], [batch.column(1)[a].as_py(), batch.column(2)[a].as_py(), False, False, False]
                after = np.logical_xor.accumulate(np.r_[known[2], odd[a:b]])
                known[2:] = bool(after[-1]), known[3] or not after[1:].all(), known[4] or bool(after[1:].any())
        if known:
            yield told()

    schema = "file string, block bigint, odd boolean, even_end boolean, odd_end boolean"
    # the value itself stays in the JVM: only the parity is sent
    return lines.withColumn("value", F.lit(None).cast("binary")).mapInArrow(counted, schema).collect()


def _open_splits(splits: list) -> tuple[dict, int]:
    """Per file the splits that start inside a record, with the place of the split where it began; and how many records are cut."""
    by_file: dict[str, list] = {}
    for row in splits:
        by_file.setdefault(row.file, []).append(row)
    found: dict[str, dict[int, int]] = {}
    cut = 0
    for file, rows in by_file.items():
        inside, opener = False, 0
        for row in sorted(rows, key=lambda r: r.block):
            if inside:
                found.setdefault(file, {})[row.block] = opener
            ends = row.odd_end if inside else row.even_end
            after = inside != row.odd
            if after and (ends or not inside):
                opener = row.block
                cut += 1
            inside = after
        if inside:
            raise OpenQuote(f"{file}: a quote is left open")
    return found, cut


def _joined(lines: DataFrame, inside, whole: bool) -> DataFrame:
    """Records that lie in one split, or without ``whole`` the fragments of the others."""
    import pyarrow as pa

    def records(batches):
        import numpy as np

        open_at, out = inside.value, []
        now = file = block = opener = None
        state = cut = first = False
        waiting: list[bytes] = []

        def fragment(first):
            if not whole and waiting:
                out.append((file, opener, block, first, b"\n".join(waiting)))

        def batch_of():
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "opener", "block", "first", "record"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            split, odd = batch.column(0).to_numpy(), batch.column(3).to_numpy(zero_copy_only=False)
            values = batch.column(4).to_pylist()
            out = []
            for a, b in _runs(split):
                if split[a] != now:
                    fragment(first)  # of the split before: its open end
                    now, file, block = split[a], batch.column(1)[a].as_py(), batch.column(2)[a].as_py()
                    state, waiting = block in open_at.get(file, {}), []
                    cut, opener, first = state, open_at.get(file, {}).get(block, block), block == 0
                after = np.logical_xor.accumulate(np.r_[state, odd[a:b]])
                state, at = bool(after[-1]), a
                for end in (np.flatnonzero(~after[1:]) + a + 1).tolist():
                    if cut:  # the end of a record that began in another split
                        waiting += values[at:end]
                        fragment(False)
                        cut, opener, waiting = False, block, []
                    else:
                        record = values[at] if not waiting and end == at + 1 else b"\n".join([*waiting, *values[at:end]])
                        waiting = []
                        if record not in (b"", b"\r"):
                            if whole:
                                out.append((None, None, None, first, record))
                            first = False
                    at = end
                waiting += values[at:b]
            if out:
                yield batch_of()
        out = []
        fragment(first)
        if out:
            yield batch_of()

    return lines.mapInArrow(records, "file string, opener bigint, block bigint, first boolean, record binary")


def read_records(spark: SparkSession, path: str | list[str], header: bool = True) -> DataFrame:
    """``record``: one row per CSV record of the files, as text with its quotes and newlines.

    Blank lines are no records; with ``header`` the first record of each file is left out. Rows come in no
    particular order. Quotes must stand around fields or doubled inside quoted ones; a file whose
    quotes are odd in number raises :class:`OpenQuote`. Compressed files are one split each.

    The driver keeps what it knows of each split that starts inside a record, two numbers, as it keeps the list of splits itself.
    """
    lines = _lines(spark, path)
    found, cut = _open_splits(_split_states(lines))
    inside = spark.sparkContext.broadcast(found)
    records = _joined(lines, inside, True).select("first", "record")
    if cut:
        text = F.col("record").cast("string")
        parts = _joined(lines, inside, False).groupBy("file", "opener").agg(
            F.array_sort(F.collect_list(F.struct("block", text.alias("text")))).alias("parts"), F.bool_or("first").alias("first")
        )
        stitched = F.array_join(F.transform("parts", lambda p: p["text"]), "\n")
        records = records.union(parts.select("first", stitched.cast("binary").alias("record")))
    if header:
        records = records.filter(~F.col("first"))
    text = F.make_valid_utf8(F.col("record").cast("string"))
    return records.select(F.regexp_replace(text, r"\r\z", "").alias("record"))


def read_split_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, header: bool = True) -> DataFrame:
    """The rows of :func:`sluice.sources.files.read_csv` with ``multi_line``, read by as many tasks as the files have splits.

    Line ends inside quotes come as they are; the other reader turns those of two characters into one.
    """
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in CSV.items() if k not in ("header", "enforceSchema")}
    return read_records(spark, path, header).select(F.from_csv("record", fields, options).alias("r")).select("r.*")
