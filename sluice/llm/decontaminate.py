"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton accepts every run of consecutive words of every item. A document's words are
streamed through it; after each word it knows the length of the longest run ending there that
some item contains. A run of ``window`` words, or a whole item that has fewer, is a hit, and its
words are marked. The items of a hit are looked up by its words.

The items are put into the automaton block by block: a block holds about ``block_words`` words
at most, so what is broadcast has a bound however many items there are. Usually there is one
block, and the documents are read once. Further blocks read them again but write no texts, only
what they hit.
"""

from __future__ import annotations

import itertools
import pickle
import re
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import byte_texts, materialise, shipped, slices, text_batches

#: Words of lower-cased UTF-8 text: ASCII letters and digits, and all that is not ASCII.
WORD = rb"[0-9a-z\x80-\xff]+"
BLOCK_WORDS = 500_000


def words_of(text: bytes) -> list[bytes]:
    return re.findall(WORD, text.lower())


class SuffixAutomaton:
    """The generalised suffix automaton of word sequences."""

    def __init__(self, sequences: Iterable[list]):
        self.steps: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        for sequence in sequences:
            last = 0
            for word in sequence:
                last = self._extend(last, word)

    def _state(self, length: int, link: int, steps: dict) -> int:
        self.steps.append(steps)
        self.length.append(length)
        self.link.append(link)
        return len(self.steps) - 1

    def _split(self, state: int, word, target: int) -> int:
        """The part of ``target`` reached from ``state`` and its suffixes, as a state of its own."""
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.steps[target]))
        self.link[target] = copy
        while state >= 0 and self.steps[state].get(word) == target:
            self.steps[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word) -> int:
        target = self.steps[last].get(word)
        if target is not None:  # another sequence has been here
            return target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
        new = self._state(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.steps[state]:
            self.steps[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.steps[state][word]
            exact = self.length[target] == self.length[state] + 1
            self.link[new] = target if exact else self._split(state, word, target)
        return new

    def lengths(self, words: list) -> list[int]:
        """For each word the length of the longest run ending there that a sequence contains."""
        steps, link, length = self.steps, self.link, self.length
        state, matched, out = 0, 0, []
        for word in words:
            step = steps[state].get(word)
            if step is None:
                while state and step is None:
                    state = link[state]
                    step = steps[state].get(word)
                matched = length[state]
                if step is None:
                    out.append(0)
                    continue
            state, matched = step, matched + 1
            out.append(matched)
        return out


class Items:
    """Test items as an automaton, and the items of each window."""

    def __init__(self, items: Iterable[tuple[str | None, bytes]], window: int):
        self.window, self.owners = window, {}
        sequences = []
        for item_id, text in items:
            words = words_of(text)
            sequences.append(words)
            size = min(window, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                self.owners.setdefault(tuple(words[i : i + size]), set()).add(item_id)
        self.short = sorted({len(w) for w in self.owners} - {window})
        self.least = min((len(w) for w in self.owners), default=window)
        self.automaton = SuffixAutomaton(sequences)

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Spans of hit words, merged and in order, and the ids of the items that hit."""
        spans: list[tuple[int, int]] = []
        found: set = set()
        lengths = self.automaton.lengths(words)
        if max(lengths, default=0) < self.least:
            return spans, found
        for i, matched in enumerate(lengths):
            if matched < self.least:
                continue
            end, start = i + 1, None
            sizes = [n for n in self.short if n <= matched]
            if matched >= self.window:
                sizes.append(self.window)
            for size in sizes:
                owners = self.owners.get(tuple(words[end - size : end]))
                if owners:
                    found |= owners
                    start = end - size
            if start is not None:
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, end))
        return spans, found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple]]:
    """The items, dealt by a hash into blocks of about ``block_words`` words, one block at a time."""
    rows = items.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.filter("text IS NOT NULL")
    letters = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = letters // (4 * block_words) + 1
    at = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    for block in range(blocks):
        part = rows.filter(at == block).distinct().collect()
        if part:
            yield sorted(((r["id"], r["text"].encode()) for r in part), key=lambda x: (x[0] or "", x[1]))


def find_items(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``doc_id``, ``text``, ``n_words``, ``spans`` (first and end word) and ``items`` per row.

    NULL text has no words, and items without words no windows. An item with a NULL id marks its
    words and has no name. Repeated documents give repeated rows, repeated items one name. Without
    items nothing is hit. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _matched(rows, items, window, item_id_col, item_text_col, block_words)


def _matched(rows, items, window, item_id_col, item_text_col, block_words) -> DataFrame:
    """``rows``, whose second column is the text, with ``n_words``, ``spans`` and ``items``.

    With one block of items the rows go through it once. With more, each block writes only the hits,
    by a digest of their text, and the rows meet all hits of their text in one join at the end: what is
    written grows with the hits and not with texts times blocks.
    """
    import pyarrow as pa

    span = T.StructType([T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType())])
    added = [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(span)),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
    span_type = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
    text_batches(rows.sparkSession)
    spark = rows.sparkSession

    def matcher(block: Items, width: int, names: list[str], only_hits: bool):
        """Batches with the text second to their first ``width`` columns and what the block finds."""
        shared = shipped(spark, block)

        def matched(batches):
            own = pickle.loads(shared.value)
            for batch in slices(batches, 256):
                counts, spans, found = [], [], []
                for text in byte_texts(batch.column(1)):
                    words = words_of(text)
                    hit, items = own.hits(words)
                    counts.append(len(words))
                    spans.append([{"first": a, "end": b} for a, b in merged(hit)])
                    found.append(sorted(x for x in items if x is not None))
                columns = [pa.array(counts, pa.int64()), pa.array(spans, span_type), pa.array(found, pa.list_(pa.string()))]
                out = pa.RecordBatch.from_arrays([*batch.columns[:width], *columns], names=names)
                yield out.filter(pa.array([bool(s) for s in spans], pa.bool_())) if only_hits else out

        return matched

    blocks = item_blocks(items, item_id_col, item_text_col, block_words)
    first, second = next(blocks, []), next(blocks, None)
    whole = T.StructType([*rows.schema.fields, *added])
    if second is None:
        return rows.mapInArrow(matcher(Items(first, window), len(rows.columns), whole.names, False), whole)

    # a NULL text has no words, hence no hits
    keyed = rows.select(F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "text").filter("text IS NOT NULL")
    hit_type = T.StructType([T.StructField("digest", T.StringType()), *added])
    hits = None
    for block in itertools.chain([first, second], blocks):
        part = keyed.mapInArrow(matcher(Items(block, window), 1, hit_type.names, True), hit_type)
        part = materialise(part.dropDuplicates(["digest"]), "hits").select("digest", "spans", "items")
        hits = part if hits is None else hits.unionAll(part)
    folded = hits.groupBy("digest").agg(
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    joined = rows.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256)).join(folded, "digest", "left")

    def finished(batches):
        for batch in slices(batches, 256):
            counts = [len(words_of(text)) for text in byte_texts(batch.column(1))]
            spans = [
                [{"first": a, "end": b} for a, b in merged([(s["first"], s["end"]) for s in own or ()])]
                for own in batch.column("spans").to_pylist()
            ]
            found = [own or [] for own in batch.column("items").to_pylist()]
            columns = [pa.array(counts, pa.int64()), pa.array(spans, span_type), pa.array(found, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *columns], names=whole.names)

    return joined.select(*rows.columns, "spans", "items").mapInArrow(finished, whole)


def remove_items(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs``, all columns, with every hit passage cut out of the text.

    A passage goes if it reaches the length limit, ``window`` words of an item in a row, or the
    coverage limit, all words of an item that has fewer. It goes from its first word to its last
    with the white space before it; all other bytes stay, and so do texts without a passage.
    """
    import pyarrow as pa

    others = [c for c in docs.columns if c != text_col]
    renamed = [F.col(f"`{c}`").alias(f"kept_{i}") for i, c in enumerate(others)]
    rows = docs.select(F.lit(0).alias("first"), F.col(text_col).cast("string").alias("text"), *renamed)
    found = _matched(rows, items, window, item_id_col, item_text_col, block_words)

    def cut(batches):
        for batch in slices(batches, 256):
            texts, spans = batch.column(1).to_pylist(), batch.column("spans").to_pylist()
            for row, own in enumerate(spans):
                if own:
                    raw = texts[row].encode()
                    places = [m.span() for m in re.finditer(WORD, raw.lower())]
                    kept, at = [], 0
                    for s in own:
                        kept.append(raw[at : places[s["first"]][0]].rstrip())
                        at = places[s["end"] - 1][1]
                    texts[row] = b"".join([*kept, raw[at:]]).decode()
            columns = [pa.array(texts, pa.string()) if i == 1 else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    cleaned = found.mapInArrow(cut, found.schema)
    names = {text_col: "text", **{c: f"kept_{i}" for i, c in enumerate(others)}}
    return cleaned.select(*[F.col(names[c]).alias(c) for c in docs.columns])
