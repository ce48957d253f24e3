"""Token sequences as length-delimited binary records with masked checksums and an offset index.

A record file is a plain concatenation of frames::

    length    u64   bytes of the payload
    check     u32   masked checksum of the eight length bytes
    payload
    check     u32   masked checksum of the payload
    end       0x0A

Numbers are little-endian. The checksum is zlib's CRC-32, rotated right by 15 bits plus a
constant, so that a checksum stored in a payload is not taken for its own. A payload is::

    width     u8    bytes per token id, 2 or 4
    has_id    u8    0 if the document's id is NULL
    id_bytes  u32   bytes of the id as UTF-8 text
    id
    token ids

Spark's text writer makes the files, one frame a line, hence the end byte: any store that
Spark writes to will do, and the commit protocol keeps files of lost or repeated tasks out.
Files follow each other in the order of their names' numbers, and documents in the order of
their ids, NULL first, rows of one id by a hash of their text. The index, a Parquet table beside
the files, has ``file, record, offset, length, n_tokens`` and the file's place, so that a reader
can fetch records in any order.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import byte_texts, partitions, slices, text_batches
from sluice.llm.tokens import encoder, read_tokenizer

MASK_DELTA = 0xA282EAD8
HEAD, CHECK, META, END = "<Q", "<I", "<BBI", b"\n"
META_BYTES = 6
#: Files whose places a broadcast may hold, 24 bytes each; beyond, records meet them in a shuffle.
BROADCAST_FILES = 1_000_000
PART = r"part-(\d+)-.*?(?:-c(\d+))?\.txt$"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: str | None, ids: bytes, width: int) -> bytes:
    """One record, without its end byte, from ids given as unsigned 32-bit numbers."""
    import numpy as np

    name = b"" if doc_id is None else doc_id.encode()
    if width == 2:
        ids = np.frombuffer(ids, "<u4").astype("<u2").tobytes()
    payload = struct.pack(META, width, doc_id is not None, len(name)) + name + ids
    head = struct.pack(HEAD, len(payload))
    return b"".join((head, struct.pack(CHECK, masked(head)), payload, struct.pack(CHECK, masked(payload))))


def frames(content: bytes, payloads: bool) -> Iterator[tuple[int, int, str | None, int, bytes]]:
    """``offset, length, doc_id, n_tokens, ids`` of each record of a file.

    ``ids`` are 32-bit numbers, or empty if payloads are not asked for; then only heads are
    checked. A wrong checksum or a torn record is an error that names its offset.
    """
    import numpy as np

    at, end = 0, len(content)
    while at < end:
        if at + 12 > end:
            raise ValueError(f"torn record at byte {at}")
        head = content[at : at + 8]
        (length,) = struct.unpack(HEAD, head)
        if struct.unpack_from(CHECK, content, at + 8)[0] != masked(head):
            raise ValueError(f"wrong length checksum at byte {at}")
        first, last = at + 12, at + 12 + length
        if last + 5 > end or content[last + 4 : last + 5] != END:
            raise ValueError(f"torn record at byte {at}")
        width, has_id, id_bytes = struct.unpack_from(META, content, first)
        own = first + META_BYTES + id_bytes
        doc_id = content[first + META_BYTES : own].decode() if has_id else None
        ids = b""
        if payloads:
            payload = content[first:last]
            if struct.unpack_from(CHECK, content, last)[0] != masked(payload):
                raise ValueError(f"wrong payload checksum at byte {at}")
            ids = content[own:last]
            if width == 2:
                ids = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
        yield at, length, doc_id, (last - own) // width, ids
        at = last + 5


def write_records(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    records_per_file: int = 20_000,
) -> None:
    """Writes ``path``/records and ``path``/index. NULL text is empty: a record of ``end_id`` alone.
    Repeated rows are records of their own; an empty table gives no record. Other columns are not read."""
    import pyarrow as pa

    spark = docs.sparkSession
    text_batches(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    ordered = (
        rows.withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(partitions(spark), "id", "tie")
        .sortWithinPartitions("id", "tie")
        .select(F.col("id").cast("string").alias("id"), "text")
    )
    tokenizer = spark.sparkContext.broadcast(read_tokenizer(tokenizer_path))

    def framed(batches):
        import json

        import numpy as np

        vocabulary = json.loads(tokenizer.value)
        largest = max([*vocabulary["model"]["vocab"].values(), *(t["id"] for t in vocabulary["added_tokens"]), end_id])
        width = 2 if largest < 1 << 16 else 4
        encode, end = encoder(tokenizer.value), np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, 256):
            ids = batch.column(0).to_pylist()
            made = [frame(i, c + end, width) for i, c in zip(ids, encode(byte_texts(batch.column(1))), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["frame"])

    lines = ordered.mapInArrow(framed, "frame binary").select(F.col("frame").cast("string").alias("value"))
    lines.write.option("lineSep", END.decode()).option("maxRecordsPerFile", records_per_file).text(f"{path}/records")
    index = parsed(spark, path, payloads=False).drop("ids", "id")
    index.write.parquet(f"{path}/index")


def parsed(spark: SparkSession, path: str, payloads: bool) -> DataFrame:
    """``part, chunk, file, record, offset, length, id, n_tokens, before, ids`` of every record; ``before`` counts
    the tokens before it in its file. A file is one row of at most ``records_per_file`` records."""
    import pyarrow as pa

    files = spark.read.format("binaryFile").load(f"{path}/records").select("path", "content")
    name = F.element_at(F.split("path", "/"), -1)
    files = files.select(
        F.regexp_extract(name, PART, 1).cast("int").alias("part"),
        F.coalesce(F.regexp_extract(name, PART, 2).try_cast("int"), F.lit(0)).alias("chunk"),
        name.alias("file"),
        "content",
    )
    fields = [
        ("record", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("id", pa.string()),
        ("n_tokens", pa.int64()), ("before", pa.int64()), ("ids", pa.binary()),
    ]

    def opened(batches):
        for batch in slices(batches, 1):
            part, chunk, file, content = (batch.column(i)[0].as_py() for i in range(4))

            def made(rows):
                same = [
                    pa.array([part] * len(rows), pa.int32()),
                    pa.array([chunk] * len(rows), pa.int32()),
                    pa.array([file] * len(rows), pa.string()),
                ]
                columns = [pa.array(c, kind) for c, (_, kind) in zip(zip(*rows, strict=True), fields, strict=True)]
                return pa.RecordBatch.from_arrays([*same, *columns], names=["part", "chunk", "file", *(f[0] for f in fields)])

            rows, before = [], 0
            for number, (offset, length, doc_id, n_tokens, ids) in enumerate(frames(content, payloads)):
                rows.append((number, offset, length, doc_id, n_tokens, before, ids))
                before += n_tokens
                if len(rows) == 512:
                    yield made(rows)
                    rows = []
            if rows:
                yield made(rows)

    return files.mapInArrow(
        opened,
        "part int, chunk int, file string, record bigint, offset bigint, length bigint, id string, n_tokens bigint,"
        " before bigint, ids binary",
    )


def read_records(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every record: ``start`` counts the tokens of all records before it,
    ``ids`` are little-endian unsigned 32-bit numbers. All checksums are verified."""
    index = spark.read.parquet(f"{path}/index")
    totals = index.groupBy("part", "chunk").agg(F.sum("n_tokens").alias("n"))  # a row per file
    order = Window.orderBy("part", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    places = totals.select("part", "chunk", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("file_start"))
    if totals.count() <= BROADCAST_FILES:
        places = F.broadcast(places)
    return (
        parsed(spark, path, payloads=True)
        .join(places, ["part", "chunk"])
        .select(
            F.col("id").cast(id_type).alias("doc_id"),
            (F.col("file_start") + F.col("before")).alias("start"),
            "n_tokens",
            "ids",
        )
    )
