"""Quality rules as a short-circuit cascade.

Each rule looks at one text and may reject it; a text is kept if no rule does, so the verdict
does not depend on the order of the rules, but the time does. On a sample every rule judges every
text, which gives its cost and its rejections. The cascade then puts the rule first that
rejects most per second, the next by what it rejects of the texts left, and so on; over the
whole table a text meets rules only until the first that rejects it.
"""

from __future__ import annotations

import pickle
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import Carried, byte_texts, shipped, slices

SYMBOLS = b"#*$%&|<>"
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
WINDOW = 8
#: Rows, about, on which costs and rejections are estimated.
SAMPLE_ROWS = 1000


def n_of(raw: bytes, characters: bytes) -> int:
    return len(raw) - len(raw.translate(None, characters))


def word_chars(words: list[bytes]) -> int:
    return len(b"".join(words).decode())


def lines_and_repeats(raw: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier line."""
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return len(lines), len(lines) - len(set(lines))


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows that occur twice or more, the first occurrence included."""
    import numpy as np

    count = len(words) - window + 1
    if count < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.uint64, len(words))
    # two independent 64-bit hashes of the word numbers in each window
    first, second = np.zeros(count, np.uint64), np.zeros(count, np.uint64)
    for i in range(window):
        first = first * np.uint64(0x9E3779B97F4A7C15) + ids[i : i + count]
        second = (second ^ ids[i : i + count]) * np.uint64(0xC2B2AE3D27D4EB4F)
    first ^= first >> np.uint64(29)
    key = first * np.uint64(0xBF58476D1CE4E5B9) ^ second
    _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
    if len(times) == count:
        return 0
    marks = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(times[inverse] > 1)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + window, -1)
    return int((np.cumsum(marks)[:-1] > 0).sum())


def symbols(raw: bytes, words: list[bytes]) -> bool:
    """More than one symbol to ten words."""
    return 10 * n_of(raw, SYMBOLS) > len(words)


def shouting(raw: bytes, words: list[bytes]) -> bool:
    """Over 30 % of the ASCII letters are capitals."""
    upper = n_of(raw, UPPER)
    return 10 * upper > 3 * (upper + n_of(raw, LOWER))


def exclaiming(raw: bytes, words: list[bytes]) -> bool:
    """More than three exclamation marks to ten words."""
    return 10 * raw.count(b"!") > 3 * len(words)


def repeated_lines(raw: bytes, words: list[bytes]) -> bool:
    """Over half of the lines with a word equal an earlier one."""
    lines, repeats = lines_and_repeats(raw)
    return 2 * repeats > lines


def stuttering(raw: bytes, words: list[bytes]) -> bool:
    """Over 20 % of the words equal the word before."""
    return 5 * sum(a == b for a, b in zip(words, words[1:], strict=False)) > len(words)


def word_length(raw: bytes, words: list[bytes]) -> bool:
    """Words of under 2 or over 20 characters on average."""
    return not 2 * len(words) <= word_chars(words) <= 20 * len(words)


def unlettered(raw: bytes, words: list[bytes]) -> bool:
    """Over 40 % of the words have neither an ASCII letter nor any character beyond ASCII."""
    plain = bytes(range(65)) + b"[\\]^_`{|}~\x7f"
    lettered = sum(bool(w.translate(None, plain)) for w in words)
    return 10 * lettered < 6 * len(words)


RULES: dict[str, Callable[[bytes, list[bytes]], bool]] = {
    rule.__name__: rule
    for rule in (symbols, shouting, exclaiming, repeated_lines, stuttering, word_length, unlettered)
}


def fails_base(words: list[bytes], repeats: int, min_words: int, max_repeat_percent: int) -> bool:
    """Whether a text goes before the cascade: too few words, or too many of them in repeated windows."""
    return len(words) < min_words or 100 * repeats > max_repeat_percent * len(words)


def calibrate(
    docs: DataFrame, rules: dict[str, Callable] = RULES, text_col: str = "text", sample_rows: int = SAMPLE_ROWS,
    min_words: int = 20, max_repeat_percent: int = 30,
) -> list[dict]:
    """The rules in the order of the cascade, each with ``cost`` (seconds a text, alone), ``rejects`` (share
    of all sampled texts that meet the cascade) and ``rejects_here`` (share of the texts that reach it).

    The sample is about ``sample_rows`` rows spread over the table; those that fail the base measures meet no
    rule and count nowhere. If none meets the cascade, as in an empty table, the order is left as given.
    """
    import pyarrow as pa

    rows = docs.select(F.col(text_col).cast("string").alias("text"))
    share = min(1.0, sample_rows / max(1, rows.count()))
    sample, names = rows.sample(share, seed=8), list(rules)
    package = shipped(docs.sparkSession, rules)

    def tried(batches):
        own = pickle.loads(package.value)
        for batch in slices(batches, 256):
            out = []
            for raw in byte_texts(batch.column(0)):
                words, seconds, verdicts = raw.split(), [], []
                if fails_base(words, repeat_words(words), min_words, max_repeat_percent):
                    continue
                for rule in own.values():
                    began = time.perf_counter()
                    verdicts.append(rule(raw, words))
                    seconds.append(time.perf_counter() - began)
                out.append((seconds, verdicts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.list_(pa.float64())), pa.array([x[1] for x in out], pa.list_(pa.bool_()))],
                names=["seconds", "verdicts"],
            )

    tries = sample.mapInArrow(tried, "seconds array<double>, verdicts array<boolean>").collect()
    total = max(1, len(tries))
    cost = [sum(t["seconds"][i] for t in tries) / total for i in range(len(names))]
    rejected = [{row for row, t in enumerate(tries) if t["verdicts"][i]} for i in range(len(names))]
    order, left, open_rules = [], set(range(len(tries))), list(range(len(names)))
    while open_rules:
        best = max(open_rules, key=lambda i: (len(rejected[i] & left) / max(cost[i], 1e-9), -cost[i]))
        order.append(
            {
                "rule": names[best],
                "cost": cost[best],
                "rejects": len(rejected[best]) / total,
                "rejects_here": len(rejected[best] & left) / max(1, len(left)),
            }
        )
        left -= rejected[best]
        open_rules.remove(best)
    return order


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judge(
    docs: DataFrame,
    rules: dict[str, Callable] = RULES,
    keep: Sequence[str] = ("doc_id",),
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    min_words: int = 20,
    max_repeat_percent: int = 30,
) -> DataFrame:
    """The columns ``keep`` as ``row``, the base measures, ``base_failed`` and ``kept`` per row.

    The measures are of the whole text; NULL is empty and has no words. A text of under
    ``min_words`` words, or with more than ``max_repeat_percent`` percent of them in repeated
    windows, fails before the cascade and meets no rule. Repeated rows are judged alike; an empty table
    gives no rows.
    """
    import pyarrow as pa

    order = calibrate(docs, rules, text_col, sample_rows, min_words, max_repeat_percent)
    package = shipped(docs.sparkSession, [rules[o["rule"]] for o in order])
    carried = Carried(docs, text_col, keep)
    schema = carried.schema(
        *(T.StructField(m, T.LongType()) for m in MEASURES),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
    )
    first, names = carried.first, schema.names

    def judged(batches):
        cascade = pickle.loads(package.value)
        for batch in slices(batches, 256):
            out = []
            for raw in byte_texts(batch.column(0)):
                words = raw.split()
                n_words, repeats = len(words), repeat_words(words)
                failed = fails_base(words, repeats, min_words, max_repeat_percent)
                kept = not failed and not any(rule(raw, words) for rule in cascade)
                out.append(
                    (n_words, word_chars(words), n_of(raw, SYMBOLS), lines_and_repeats(raw)[1], repeats, failed, kept)
                )
            added = [pa.array(c) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[first:], *added], names=names)

    row = F.struct(*carried.restored()).alias("row")
    return carried.rows.mapInArrow(judged, schema).select(row, *MEASURES, "base_failed", "kept")
