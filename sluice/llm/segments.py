"""Cutting UTF-8 texts at white space and hashing the parts, on arrays of bytes.

Hashes of 64 bits. :class:`WordHasher` tells parts apart: up to seven bytes its hash is a
number that no other part of up to seven bytes has; up to 32 bytes it mixes eight bytes at a time with numbers drawn from
a key; above it is a cryptographic digest. Without a key each process draws its own, so that texts cannot be made to
collide. Where tasks must agree a key is given; one kept secret does the same. That two of a hundred million
different parts share a hash has a chance of about 1 in 4,000.

:class:`Hasher` is a polynomial in the bytes modulo 2**64: a running sum of byte times power
over all texts gives the sum of every part by one subtraction, and a multiplication by the
inverse power moves it to the origin. A mixing step follows. Different parts of a thousand bytes can be made to share
a hash, so it may only choose what is compared by its bytes afterwards.
"""

from __future__ import annotations

BASE = 0x9E3779B97F4A7C15 | 1
MIX = 0xBF58476D1CE4E5B9
ASCII_SPACE = b"\t\n\x0b\x0c\r "
#: Bytes worked on at once, about; the arrays take some 40 times as much.
BLOCK = 1 << 19


def powers(length: int):
    """Powers of the base and of its inverse."""
    import numpy as np

    both = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        factors = np.full(length, base, np.uint64)
        factors[:1] = 1
        both.append(np.multiply.accumulate(factors))
    return both


class Hasher:
    """Hashes of byte ranges; keeps its tables of powers."""

    def __init__(self):
        self.power, self.inverse = powers(BLOCK + 1)

    def __call__(self, data, starts, ends):
        import numpy as np

        if len(data) >= len(self.power):
            self.power, self.inverse = powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[: len(data)], out=sums[1:])
        h = (sums[ends] - sums[starts]) * self.inverse[starts]
        return mixed(h ^ (ends - starts).astype(np.uint64))


class WordHasher:
    """Hashes of byte ranges by which they may be told apart; the same for the same ``key``, by default this object's own."""

    WIDEST = 32

    def __init__(self, key: bytes | None = None):
        import os
        from hashlib import blake2b

        import numpy as np

        self.key = os.urandom(32) if key is None else blake2b(key, digest_size=32).digest()
        drawn = np.frombuffer(blake2b(self.key, digest_size=2 * self.WIDEST).digest(), "<u8")
        self.added, self.factors = drawn[0::2].copy(), drawn[1::2] | np.uint64(1)

    def _digest(self, part: bytes) -> int:
        from hashlib import blake2b

        return int.from_bytes(blake2b(part, digest_size=8, key=self.key).digest(), "little")

    def __call__(self, data, starts, ends):
        import numpy as np

        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))  # the eight bytes from each place on
        lengths = (ends - starts).astype(np.uint64)
        out = mixed(leading(eight[starts], lengths, 7) | (lengths << np.uint64(56)))  # one to one up to seven bytes
        where = np.flatnonzero((lengths > 7) & (lengths <= self.WIDEST))
        out[where] = lengths[where] << np.uint64(56)
        at, left = starts[where], lengths[where]
        for added, factor in zip(self.added, self.factors, strict=True):
            if not len(where):
                break
            out[where] = mixed((out[where] ^ (leading(eight[at], left, 8) + added)) * factor)
            more = left > 8
            at, left, where = at[more] + 8, left[more] - np.uint64(8), where[more]
        long = np.flatnonzero(lengths > self.WIDEST)
        if len(long):
            raw = data.tobytes()
            parts = (raw[a:b] for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True))
            out[long] = np.fromiter(map(self._digest, parts), np.uint64, len(long))
        return out


def leading(eight, lengths, most: int):
    """The first bytes of each eight, so many as its length says, ``most`` at most."""
    import numpy as np

    spare = np.uint64(64) - np.minimum(lengths, np.uint64(most)) * np.uint64(8)  # no range is empty
    return (eight.astype(np.uint64) << spare) >> spare


def mixed(h):
    import numpy as np

    h = (h ^ (h >> np.uint64(31))) * np.uint64(MIX)
    return h ^ (h >> np.uint64(29))


def flags(characters: bytes):
    """A table that is true for the given bytes."""
    import numpy as np

    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


def lowered():
    """A table that lower-cases A-Z."""
    import numpy as np

    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def joined(texts: list[bytes]):
    """The bytes of all texts in one array, and the offsets of the texts in it."""
    import numpy as np

    data = np.frombuffer(b"".join(texts), np.uint8)
    return data, np.r_[0, np.cumsum([len(t) for t in texts], dtype=np.int64)]


def words(data, offsets):
    """Starts and ends of the maximal runs without ASCII white space, none reaching into another text."""
    import numpy as np

    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    plain = ~flags(ASCII_SPACE)[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts, ends = plain.copy(), plain.copy()
    starts[1:] &= ~plain[:-1] | edge[1:-1]
    ends[:-1] &= ~plain[1:] | edge[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def blocks(texts: list[bytes], size: int = BLOCK):
    """Consecutive texts of about ``size`` bytes together; a longer text is alone."""
    block, total = [], 0
    for text in texts:
        if block and total + len(text) > size:
            yield block
            block, total = [], 0
        block.append(text)
        total += len(text)
    if block:
        yield block
