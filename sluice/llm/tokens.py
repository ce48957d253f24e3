"""Token ids of whole texts by a public tokenizer file, encoded segment by segment.

A text is cut where a character that is no white space is followed by white space, and where an
ASCII letter is followed by one of a few punctuation marks. The patterns of these tokenizers end a
pre-token at every such place and look at nothing before it, so the ids of the text are those of its
segments one after the other, and a segment seen before is looked up and not encoded again.
Tokenizers that mark word ends drop white space, so there it is no part of a segment.
"""

from __future__ import annotations

import json
import os
import re
import sys
from collections.abc import Callable, Iterator

from sluice.llm import segments

#: Unicode's White_Space, which the tokenizers' patterns mean by ``\\s``.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The white space beyond ASCII, as UTF-8.
WIDE_SPACE = rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
MARKS = b'!"),.:;?'
#: Segments a worker remembers, at about 35 bytes each.
REMEMBERED = 2_000_000
#: Texts above this many bytes are cut by the pattern, a part at a time.
LONG = 1 << 23


def read_tokenizer(path: str) -> str:
    """The tokenizer's JSON, read once by the driver; its size is that of a fixed vocabulary."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def memory() -> dict:
    """A dict that lives as long as the Python worker, so that later tasks find what earlier ones learned: the encoder with
    up to ``REMEMBERED`` segments. Segments are told apart by :class:`segments.WordHasher`, whose hashes texts cannot be made to share."""
    return sys.__dict__.setdefault("_sluice_memory", {})


class Known:
    """Ids of segments by their hash: sorted hashes, a large table and a small one of new ones, and all ids in one array."""

    MERGED = 100_000

    def __init__(self, kind: str):
        import numpy as np

        self.tables = [(np.zeros(0, np.uint64), np.zeros(0, np.int64)) for _ in range(2)]
        self.ends, self.count = np.zeros(1 << 16, np.int64), 0  # of the segments' ids, by number
        self.ids = np.zeros(1 << 18, kind)

    def numbers(self, hashes):
        """Numbers of sorted hashes, -1 for new ones."""
        import numpy as np

        out = np.full(len(hashes), -1, np.int64)
        for keys, numbers in self.tables:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                out = np.where(keys[at] == hashes, numbers[at], out)
        return out

    def add(self, hashes, ids: list[list[int]]) -> None:
        """Takes up new segments, given by sorted hashes."""
        import numpy as np

        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        first, last = self.count, self.count + len(ids)
        start = int(self.ends[first - 1]) if first else 0
        ends = start + np.cumsum(lengths)
        end = int(ends[-1])
        while last > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        while end > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ends[first:last] = ends
        self.ids[start:end] = np.fromiter((i for own in ids for i in own), self.ids.dtype, end - start)
        self.count = last
        self._merge(1, hashes, np.arange(first, last))
        if len(self.tables[1][0]) > self.MERGED:
            self._merge(0, *self.tables[1])
            self.tables[1] = (hashes[:0], np.zeros(0, np.int64))

    def _merge(self, table: int, hashes, numbers) -> None:
        import numpy as np

        keys, old = self.tables[table]
        at = np.searchsorted(keys, hashes)
        self.tables[table] = (np.insert(keys, at, hashes), np.insert(old, at, numbers))

    def gathered(self, numbers):
        """Lengths of numbered segments and their ids one after the other."""
        import numpy as np

        firsts = np.where(numbers > 0, self.ends[numbers - 1], 0)
        lengths = self.ends[numbers] - firsts
        after = np.cumsum(lengths)
        total = int(after[-1]) if len(after) else 0
        return after, self.ids[np.repeat(firsts - after + lengths, lengths) + np.arange(total)].astype("<u4")


class SegmentEncoder:
    """Ids of texts, given as UTF-8, as little-endian unsigned 32-bit numbers."""

    def __init__(self, tokenizer_json: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the unit of parallel work
        content = json.loads(tokenizer_json)
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.remembered = remembered
        self.words_only = bool(content["model"].get("end_of_word_suffix"))
        special = [t["content"] for t in content["added_tokens"]]
        self.marks = b"" if any(chr(c) in t for t in special for c in MARKS) else MARKS
        # texts that are cut by the pattern: wide space, or what may be the start of a special token
        odd = [re.escape(t[:2].encode()) for t in special]
        self.odd = re.compile(b"|".join([rb"(?:%s)" % WIDE_SPACE, *odd])).search
        self.pattern = re.compile(f"[^{WHITE}]+" if self.words_only else f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
        self.hasher = segments.WordHasher()
        largest = max([*content["model"]["vocab"].values(), *(t["id"] for t in content["added_tokens"])])
        self.kind = "<u2" if largest < 1 << 16 else "<u4"
        self.known = Known(self.kind)

    def _encoded(self, parts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def _by_pattern(self, text: bytes) -> bytes:
        import numpy as np

        out, parts = [], []
        for match in self.pattern.finditer(text.decode()):
            parts.append(match[0])
            if len(parts) == 65_536:
                out += [np.array(i, "<u4").tobytes() for i in self._encoded(parts)]
                parts = []
        out += [np.array(i, "<u4").tobytes() for i in self._encoded(parts)]
        return b"".join(out)

    def _cut(self, data, offsets):
        """Starts and ends of the segments of all texts, in order."""
        import numpy as np

        starts, ends = segments.words(data, offsets)
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = edge[ends] = True
        if self.marks:
            letters = segments.flags(bytes(c for c in range(128) if chr(c).isalpha()))
            edge[1:-1] |= letters[data[:-1]] & segments.flags(self.marks)[data[1:]]
        if self.words_only:
            edge[starts] = True
        cuts = np.flatnonzero(edge)
        first, last = cuts[:-1], cuts[1:]
        if self.words_only and len(first):  # white space between words is dropped
            plain = ~segments.flags(segments.ASCII_SPACE)[data[first]]
            first, last = first[plain], last[plain]
        return first, last

    def _block(self, texts: list[bytes]) -> Iterator[bytes]:
        import numpy as np

        raw = b"".join(texts)
        data, offsets = segments.joined([raw.lower()] if self.words_only else [raw])
        offsets = np.r_[0, np.cumsum([len(t) for t in texts], dtype=np.int64)]
        if not len(data):
            yield from (b"" for _ in texts)
            return
        first, last = self._cut(data, offsets)
        hashes, sample, inverse = np.unique(self.hasher(data, first, last), return_index=True, return_inverse=True)
        new = np.flatnonzero(self.known.numbers(hashes) < 0)
        content = data.tobytes()
        for at in range(0, len(new), 16_384):
            some = new[at : at + 16_384]
            places = sample[some]
            parts = [content[a:b].decode() for a, b in zip(first[places].tolist(), last[places].tolist(), strict=True)]
            self.known.add(hashes[some], self._encoded(parts))
        after, ids = self.known.gathered(self.known.numbers(hashes)[inverse])
        bounds = np.r_[0, after][np.searchsorted(first, offsets)].tolist()
        out = ids.tobytes()
        for a, b in zip(bounds, bounds[1:], strict=False):
            yield out[4 * a : 4 * b]
        if self.known.count > self.remembered:
            self.known = Known(self.kind)

    def __call__(self, texts: list[bytes]) -> Iterator[bytes]:
        odd = [len(t) > LONG or self.odd(t) is not None for t in texts]
        plain = (ids for block in segments.blocks([t for t, o in zip(texts, odd, strict=True) if not o]) for ids in self._block(block))
        for text, is_odd in zip(texts, odd, strict=True):
            yield self._by_pattern(text) if is_odd else next(plain)


def encoder(tokenizer_json: str) -> Callable[[list[bytes]], Iterator[bytes]]:
    """The worker's encoder for a tokenizer; it remembers segments across tasks."""
    key = ("encoder", tokenizer_json)
    if key not in memory():
        memory()[key] = SegmentEncoder(tokenizer_json)
    return memory()[key]
