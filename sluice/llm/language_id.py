"""Language identification by segmentation-marginalised unigrams.

A fixed public vocabulary of pieces is given. A language is a probability of each piece; the
probability of a word is the sum, over all ways to cut it into pieces, of the product of its
pieces' probabilities, computed by a forward pass over the word's characters. A text's score
under a language is the sum of the logarithms over its words, that is, over its maximal runs of
letters, lower-cased.

The piece probabilities are learned by expectation maximisation on a bounded sample of labelled
texts: a forward and a backward pass give the expected count of every piece over all
segmentations. Words of equal length go through the passes together, as arrays. Letters that are no
piece of the vocabulary are pieces of their own, at one small probability for all of them, the same in
every language, so that such a letter speaks for none.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import Carried, shipped, slices, str_texts

LETTERS = r"[^\W\d_]+"
#: Labelled texts per language, about, from which the piece probabilities are learned.
SAMPLE_TEXTS = 2000
#: Passes of expectation maximisation.
PASSES = 3
#: Added to the expected count of every piece.
ALPHA = 0.05
#: Languages a model may have: its size is at most this times the vocabulary.
MAX_LANGUAGES = 200
#: Words of a language that go through a pass of learning together.
WORDS_AT_ONCE = 20_000
#: Words whose scores a task remembers.
REMEMBERED = 300_000
WORD_START = "▁"


def read_pieces(model_path: str) -> list[str]:
    """The pieces of a sentencepiece vocabulary that can be part of a lower-case word, once each."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    found = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    letters = re.compile(f"{WORD_START}?{LETTERS}|{WORD_START}").fullmatch
    return sorted(filter(letters, found))


def words_of(text: str) -> list[str]:
    return re.findall(LETTERS, text.lower())


class PieceTable:
    """Rows of pieces by a rolling hash of their characters, in two tables of slots.

    Different pieces have different hashes (checked); that another string has the hash of a
    piece has a chance of one in 2**64 per piece.
    """

    BASE, SPREAD = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9

    def __init__(self, pieces: list[str]):
        import numpy as np

        keys = [0]
        for piece in pieces:
            h = 0
            for c in piece:
                h = (h * self.BASE + ord(c) + 1) % (1 << 64)
            keys.append(h)
        if len(set(keys)) < len(keys):
            raise ValueError("two pieces share a hash")
        self.keys = np.array(keys, np.uint64)
        for bits in range(16, 30):
            self.shift = np.uint64(64 - bits)
            self.slots = np.zeros((2, 1 << bits), np.int32)
            if all(self._place(i) for i in range(1, len(keys))):
                return

    def _places(self, h):
        import numpy as np

        once = h * np.uint64(self.SPREAD)
        return once >> self.shift, (once ^ (once >> np.uint64(32))) * np.uint64(self.BASE) >> self.shift

    def _place(self, row: int) -> bool:
        for slots, (at,) in zip(self.slots, self._places(self.keys[row : row + 1]), strict=True):
            if not slots[at]:
                slots[at] = row
                return True
        return False

    def find(self, h):
        """Rows of hashes, 0 where there is no piece."""
        import numpy as np

        first, second = self._places(h)
        rows = self.slots[0][first]
        rest = np.flatnonzero(self.keys[rows] != h)
        others = self.slots[1][second.ravel()[rest]]
        rows.ravel()[rest] = np.where(self.keys[others] == h.ravel()[rest], others, 0)
        return rows


class Lattice:
    """All segmentations of words into pieces. Row 0 of ``probability`` is for letters that are no piece."""

    def __init__(self, pieces: list[str], probability):
        self.table = PieceTable(pieces)
        self.probability = probability  # pieces + 1, languages
        self.longest = max(map(len, pieces), default=1)

    def _groups(self, words: list[str], size: int = 500_000):
        """Words of one length together, as indices and a table of rows: [word, end, characters - 1], -1 for none."""
        import numpy as np

        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word) + 1, []).append(i)
        for length, members in by_length.items():
            width = min(length, self.longest)
            step = max(1, size // (length * width))
            for at in range(0, len(members), step):
                some = members[at : at + step]
                text = "".join(WORD_START + words[i] for i in some)
                letters = np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(some), length).astype(np.uint64)
                letters += np.uint64(1)
                table = np.full((len(some), length, width), -1, np.int32)
                h = letters
                table[:, :, 0] = self.table.find(h)
                for n in range(2, width + 1):
                    h = h[:, :-1] * np.uint64(PieceTable.BASE) + letters[:, n - 1 :]
                    rows = self.table.find(h)
                    rows[rows == 0] = -1
                    table[:, n - 1 :, n - 1] = rows
                yield some, table

    def scores(self, words: list[str]):
        """Logarithms of the words' probabilities, [word, language]."""
        import numpy as np

        out = np.zeros((len(words), self.probability.shape[1]))
        padded = np.vstack([self.probability, np.zeros(self.probability.shape[1])])  # row -1 is zero
        for members, table in self._groups(words):
            forward, scale = self._forward(table, padded)
            out[members] = np.log(forward[-1]) + scale
        return out

    def _forward(self, table, padded):
        """Sums over segmentations up to each end, rescaled as they go; the logarithm of the scale at the end."""
        import numpy as np

        count, length, width = table.shape
        languages = padded.shape[1]
        sums, scale = [np.ones((count, languages))], np.zeros((count, languages))
        for end in range(1, length + 1):
            total = np.zeros((count, languages))
            for n in range(1, min(width, end) + 1):
                total += sums[end - n] * padded[table[:, end - 1, n - 1]]
            sums.append(total)
            if end % 16 == 0:  # a common factor of all sums still needed
                live = sums[max(0, end - width + 1) :]
                factor = np.maximum.reduce(live)
                scale += np.log(factor)
                for s in live:
                    s /= factor
                if end > width:
                    sums[: end - width] = [None] * (end - width)
        return sums, scale

    def expected(self, words: list[str], counts, language: int):
        """Expected counts of the rows over all segmentations of the words under one language."""
        import numpy as np

        out = np.zeros(len(self.probability))
        padded = np.r_[self.probability[:, language], 0.0]
        for members, table in self._groups(words):
            count, length, width = table.shape
            p = padded[table]
            forward, backward = np.zeros((count, length + 1)), np.zeros((count, length + 1))
            forward[:, 0] = backward[:, length] = 1.0
            # logarithms of the scales of both, which are rescaled as in _forward
            scales = np.zeros((2, count, length + 1))
            for end in range(1, length + 1):
                for n in range(1, min(width, end) + 1):
                    forward[:, end] += forward[:, end - n] * p[:, end - 1, n - 1]
                scales[0, :, end] = scales[0, :, end - 1]
                if end % 16 == 0:
                    rescale(forward, scales[0], slice(max(0, end - width + 1), end + 1), end)
            for start in range(length - 1, -1, -1):
                for n in range(1, min(width, length - start) + 1):
                    backward[:, start] += backward[:, start + n] * p[:, start + n - 1, n - 1]
                scales[1, :, start] = scales[1, :, start + 1]
                if (length - start) % 16 == 0:
                    rescale(backward, scales[1], slice(start, start + width), start)
            weight = counts[members] / np.maximum(forward[:, length], 1e-300)
            for end in range(1, length + 1):
                for n in range(1, min(width, end) + 1):
                    rows = table[:, end - 1, n - 1]
                    scale = np.exp(np.minimum(scales[0, :, end - n] + scales[1, :, end] - scales[0, :, length], 700.0))
                    share = weight * forward[:, end - n] * p[:, end - 1, n - 1] * backward[:, end] * scale
                    out += np.bincount(np.maximum(rows, 0), np.where(rows >= 0, share, 0.0), len(out))
        return out


def rescale(sums, scales, live: slice, at: int) -> None:
    """Takes a common factor out of the ``live`` columns of ``sums``, and notes it in the scales."""
    import numpy as np

    factor = sums[:, live].max(axis=1)
    factor[factor == 0] = 1.0
    sums[:, live] /= factor[:, None]
    scales[:, live] = (scales[:, at] + np.log(factor))[:, None]


def initial(pieces: list[str], languages: int):
    """The same start for all languages: a piece is the less likely the longer it is."""
    import numpy as np

    start = np.array([1e-4, *(4.0 ** -len(p) for p in pieces)])
    return np.repeat((start / start.sum())[:, None], languages, axis=1)


class Model:
    """Languages in order, their pieces' probabilities, and their shares among the learned texts."""

    def __init__(self, languages: list[str], pieces: list[str], probability):
        self.languages, self.pieces, self.probability = languages, pieces, probability


def learn(
    labelled: DataFrame,
    pieces: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_texts: int = SAMPLE_TEXTS,
    passes: int = PASSES,
) -> Model:
    """A model from the rows with text and language.

    Of a language with more than ``sample_texts`` texts about so many are used, chosen by a hash of
    the id; the sample's words are what an executor and the driver see of the texts. All languages
    found are learned, ``MAX_LANGUAGES`` at most; more are an error.
    """
    import numpy as np
    import pyarrow as pa

    rows = labelled.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).filter("text IS NOT NULL AND lang IS NOT NULL")
    totals = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(totals) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(r["lang"] for r in totals)
    probability = initial(pieces, len(languages))
    if not languages:
        return Model(languages, pieces, probability)
    share = F.create_map(*[x for r in totals for x in (F.lit(r["lang"]), F.lit(min(1.0, sample_texts / r["count"])))])
    draw = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    word = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)")))
    counted = (
        rows.filter(draw < F.element_at(share, F.col("lang")))
        .select("lang", word.alias("word"))
        .groupBy("lang", "word")
        .count()
        .persist()
    )
    spark = rows.sparkSession
    for _ in range(passes):
        package = shipped(spark, (languages, pieces, probability))

        def expectation(batches, package=package):
            own_languages, own_pieces, own_probability = pickle.loads(package.value)
            lattice = Lattice(own_pieces, own_probability)
            totals = np.zeros(own_probability.shape)
            held: dict[str, tuple[list, list]] = {}

            def add(lang: str) -> None:
                words, counts = held.pop(lang)
                column = own_languages.index(lang)
                totals[:, column] += lattice.expected(words, np.array(counts, float), column)

            for batch in batches:  # a pass is cheaper for many words at once
                for lang, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    words, counts = held.setdefault(lang, ([], []))
                    words.append(word)
                    counts.append(n)
                    if len(words) == WORDS_AT_ONCE:
                        add(lang)
            for lang in list(held):
                add(lang)
            for column, lang in enumerate(own_languages):
                rows = np.flatnonzero(totals[:, column])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(rows), pa.string()), pa.array(rows), pa.array(totals[rows, column])],
                    names=["lang", "row", "n"],
                )

        expected = counted.mapInArrow(expectation, "lang string, row bigint, n double")
        probability = np.full_like(probability, ALPHA)
        column_of = {lang: i for i, lang in enumerate(languages)}
        for r in expected.groupBy("lang", "row").agg(F.sum("n").alias("n")).collect():
            probability[r["row"], column_of[r["lang"]]] += r["n"]
        probability[0] = 0.0
        totals = probability.sum(axis=0)
        probability /= totals
        probability[0] = ALPHA / totals.max()
    counted.unpersist()
    return Model(languages, pieces, probability)


def has_letter(words: set[str] | list[str]) -> bool:
    """Whether some character is a letter by its Unicode category: fractions are none, ideographs that count are."""
    from unicodedata import category

    if not all(map(str.isnumeric, words)):  # a word of other than numerals has a letter
        return True
    return any(category(c)[0] == "L" for word in words for c in word)


def identify(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns ``keep`` as ``row``, ``lang_pred`` and ``score`` per row.

    Only the text is looked at. ``score`` is the probability of the predicted language among those
    learned, all equally likely beforehand. Texts that are NULL or have no letter are ``und`` with
    score 0, as are all texts if no language was learned. Of equally likely languages the first by
    name is taken. Repeated rows give repeated results.
    """
    import pyarrow as pa

    carried = Carried(docs, text_col, keep)
    package, first = shipped(docs.sparkSession, model), carried.first
    schema = carried.schema(T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()))
    names = schema.names

    def scored(batches):
        import numpy as np

        known = pickle.loads(package.value)
        lattice, numbers = Lattice(known.pieces, known.probability), {}
        table = np.zeros((0, len(known.languages)))
        for batch in slices(batches, 256):
            texts = [words_of(t) for t in str_texts(batch.column(0))]
            if len(numbers) > REMEMBERED:
                numbers, table = {}, table[:0]
            new = list(set().union(*texts).difference(numbers))
            numbers.update(zip(new, range(len(numbers), len(numbers) + len(new)), strict=True))
            table = np.vstack([table, lattice.scores(new)])
            langs, scores = [], []
            for own in texts:
                if not known.languages or not has_letter(own):
                    langs.append("und")
                    scores.append(0.0)
                    continue
                total = table[np.fromiter(map(numbers.__getitem__, own), np.int64, len(own))].sum(axis=0)
                best = int(total.argmax())
                langs.append(known.languages[best])
                scores.append(float(1.0 / np.exp(total - total[best]).sum()))
            added = [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[first:], *added], names=names)

    row = F.struct(*carried.restored()).alias("row")
    return carried.rows.mapInArrow(scored, schema).select(row, "lang_pred", "score")
