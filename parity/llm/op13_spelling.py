"""Spelling variant grouping with a bidirectional FM-index.

Words are maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` of whole texts, A-Z
lower-cased, of at least ``MIN_LENGTH`` code points and ``MIN_COUNT``
occurrences.  (A run whose crc32 with its doc_id is divisible by ``TYPO_MOD``
first loses a code point; this rule, of the query's contract, plants typos.)
Two words are near if one insertion, deletion or replacement of a code point
turns one into the other.  The form of a word is its most frequent near word
(ties: first in code-point order) if that is at least ``TIMES`` as frequent;
its root is where the forms end.

1. Counting: tasks count their texts' words, handing the counts on whenever
   ``TABLE`` words have gathered; Spark adds them up.
2. Shards: a near word holds the left half or the right half of a word
   unchanged, at the same end.  A word is sent, as a word to search, to the
   shards of its two halves and, as a word to be found, to those of the halves
   that words a code point shorter or longer, or as long, can have.  A half
   that more than ``SHARD`` words share is a grid of shards: words to be found
   are split over its rows, words to search over its columns, so no shard grows
   with the vocabulary and no pair is lost.
3. Search, in one task a shard: the words to be found, each between a begin
   and an end mark, are indexed in both directions (suffix order by prefix
   doubling, Burrows-Wheeler symbols in a wavelet matrix).  A search matches a
   word's half exactly from its middle outwards to the mark, keeping the
   suffix-rank intervals of both directions in step, and then turns round and
   extends across the other half and its mark with exactly one error.  All
   words of a shard step through the index together, as numpy arrays.
4. Spark drops pairs found by both halves, counts near words, chooses forms,
   and follows them by pointer doubling: a form is ``TIMES`` as frequent, so the
   number of rounds is bounded by the logarithm of the largest count's.

Nulls, ties, emptiness: a null text has no words; a null doc_id counts as the
empty text in the typo rule; repeated rows count each; a word without near
words has null form, itself as root and 0 near words; no words give no rows;
other columns are ignored.  Texts and words of any length are read whole.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parity.llm import common

MIN_LENGTH = 6
MIN_COUNT = 5
TIMES = 5
TYPO_MOD = 199
#: Words that a task counts before it hands them on.
TABLE = 400_000
#: Words of a shard, about; and words that search side by side.
SHARD = 8192
SIDE = 4096
#: Characters of a text from which on its runs aren't listed at once.
LONG_TEXT = 4 << 20

RUN = re.compile(f"[a-zÀ-ÿ]{{{MIN_LENGTH},}}")   # runs that are shorter can't become words

BEGIN, END, FIRST = 0, 1, 2   # symbols: marks, then letters


# --------------------------------------------------------------- counting --

def words_of(doc_id: int | None, text: str) -> Iterator[tuple[str, int]]:
    """Words of a text after the typo rule, with their counts (not distinct)."""
    text = common.lower_ascii(text)
    runs = RUN.findall(text) if len(text) < LONG_TEXT else (m[0] for m in RUN.finditer(text))
    before = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    for word, n in Counter(runs).items():
        h = zlib.crc32(word.encode("utf-8"), before)
        if h % TYPO_MOD == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
            if len(word) < MIN_LENGTH:
                continue
        yield word, n


_COUNTED = pa.schema([("word", pa.string()), ("n", pa.int64())])


def _count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, int] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        words, numbers = list(counts), list(counts.values())
        counts.clear()
        for at in range(0, len(words), 65_536):
            yield common.batches({"word": words[at:at + 65_536], "n": numbers[at:at + 65_536]}, _COUNTED)

    for batch in parts:
        for doc_id, text in zip(batch.column(0).to_pylist(), common.texts(batch)):
            for word, n in words_of(doc_id, text):
                counts[word] = counts.get(word, 0) + n
            if len(counts) > TABLE:
                yield from rows()
    yield from rows()


# ------------------------------------------------------------------ index --

class Ranks:
    """A wavelet matrix: occurrences of symbols before places of a sequence."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.levels = []
        self.begin = np.zeros(1 << bits, np.int64)
        every = np.arange(1 << bits)
        for b in reversed(range(bits)):
            one = (symbols >> b & 1).astype(bool)
            zeros = np.concatenate([[0], np.cumsum(~one)]).astype(np.int32)
            self.levels.append((b, zeros, int(zeros[-1])))
            at = zeros[self.begin]
            self.begin = np.where(every >> b & 1, zeros[-1] + self.begin - at, at)
            symbols = np.concatenate([symbols[~one], symbols[one]])

    def __call__(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Occurrences of each symbol before lo and before hi, and of smaller symbols between."""
        less = np.zeros(len(lo), np.int64)
        for b, zeros, n in self.levels:
            one = (symbol >> b & 1).astype(bool)
            a, z = zeros[lo], zeros[hi]
            less += np.where(one, z - a, 0)
            lo, hi = np.where(one, n + lo - a, a), np.where(one, n + hi - z, z)
        return lo - self.begin[symbol], hi - self.begin[symbol], less


def suffix_order(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Places in the order of their suffixes up to their string's end (``left``
    symbols follow in it); equal ones by place."""
    rank, step, distinct = text.astype(np.int64), 1, -1
    place = np.arange(len(text))
    while step <= left.max(initial=0) + 1:
        after = np.where(left >= step, rank[np.minimum(place + step, len(text) - 1)] + 1, 0)
        values, rank = np.unique(rank * (rank.max() + 2) + after, return_inverse=True)
        if len(values) == distinct:
            break
        distinct, step = len(values), 2 * step
    return np.argsort(rank, kind="stable")


class Direction:
    """The FM-index of one direction: extending a pattern at its front."""

    def __init__(self, text: np.ndarray, word: np.ndarray, left: np.ndarray, bits: int) -> None:
        order = suffix_order(text, left)
        self.word_at = word[order]
        dead = (1 << bits) - 1                      # nothing stands before a string's first symbol
        before = np.concatenate([[dead], text[:-1]])
        before[np.concatenate([[True], word[1:] != word[:-1]])] = dead
        self.symbols = before[order]
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << bits))])
        self.ranks = Ranks(self.symbols, bits)

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals of the patterns with a symbol before them, and by how much
        the other direction's interval moves on."""
        a, z, less = self.ranks(symbol, lo, hi)
        return self.smaller[symbol] + a, self.smaller[symbol] + z, less


def _joined(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pieces in one array, and where each begins (with the end)."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    return np.concatenate([np.empty(0, np.uint8), *pieces]), np.concatenate([[0], np.cumsum(sizes)])


class Index:
    """Distinct words, searchable from either end."""

    def __init__(self, words: list[str]) -> None:
        letters, at = _joined([np.frombuffer(w.encode("latin-1"), np.uint8) for w in words])
        used = np.unique(letters)
        self.letters = FIRST + len(used)             # symbols of marks and letters; then one for unknown letters
        bits = max(1, (self.letters + 1).bit_length())
        self.code = np.full(256, self.letters, np.int64)
        self.code[used] = FIRST + np.arange(len(used))
        size = np.diff(at) + 2
        ends = np.cumsum(size)
        word = np.repeat(np.arange(len(words)), size)
        place = np.arange(ends[-1] if len(ends) else 0)
        text = np.full(len(place), BEGIN, np.int64)
        text[ends - 1] = END
        inner = np.ones(len(place), bool)
        inner[ends - 1] = inner[ends - size] = False
        text[inner] = self.code[letters]
        left, gone = np.repeat(ends, size) - 1 - place, place - np.repeat(ends - size, size)
        self.forward = Direction(text, word, left, bits)
        self.backward = Direction(text[::-1], word[::-1], gone[::-1], bits)

    def near(self, words: list[str], left: bool) -> tuple[np.ndarray, np.ndarray]:
        """(number of a searched word, number of an indexed word) of the pairs
        with exactly one error outside the searched word's left (or right) half.
        A pair may come more than once."""
        found = [np.empty((2, 0), np.int64)]
        for at in range(0, len(words), SIDE):
            some = [self.code[np.frombuffer(w.encode("latin-1"), np.uint8)] for w in words[at:at + SIDE]]
            half = np.array([len(w) // 2 for w in some], np.int64)
            if left:
                q, hit = self._search(self.forward, self.backward, some, half, BEGIN, END)
            else:
                half = np.array([len(w) for w in some], np.int64) - half
                q, hit = self._search(self.backward, self.forward, [w[::-1] for w in some], half, END, BEGIN)
            found.append(np.stack([q + at, hit]))
        return tuple(np.concatenate(found, axis=1))

    def _search(self, front: Direction, back: Direction, words: list[np.ndarray], half: np.ndarray, first: int,
                last: int) -> tuple[np.ndarray, np.ndarray]:
        """``front`` extends patterns to the left, ``back`` to the right; the
        first ``half`` symbols of each word match exactly."""
        flat, at = _joined([np.append(w, last) for w in words])
        # the exact half, from its last symbol to the mark before its first
        q = np.arange(len(words))
        symbol = np.where(half > 0, flat[at[:-1] + np.maximum(half - 1, 0)], first)
        lo, hi, other = front.smaller[symbol], front.smaller[symbol + 1], front.smaller[symbol]
        for step in range(1, int(half.max(initial=0)) + 1):
            on = np.flatnonzero(half[q] >= step)
            place = at[q[on]] + half[q[on]] - 1 - step
            symbol = np.where(half[q[on]] == step, first, flat[np.maximum(place, 0)])
            a, z, less = front.extend(symbol, lo[on], hi[on])
            lo[on], hi[on] = a, z
            other[on] += less
            some = hi > lo
            q, lo, hi, other = q[some], lo[some], hi[some], other[some]
        # round the middle: from here on intervals of the other direction
        exact = (q, other, other + hi - lo, at[q] + half[q])
        wrong = tuple(np.empty(0, np.int64) for _ in range(4))
        out = [np.empty((2, 0), np.int64)]
        while len(exact[0]) or len(wrong[0]):
            new = self._errors(back, flat, at, half, *exact)
            wrong, done = self._advance(back, flat, at, *wrong)
            out.append(done)
            exact, _ = self._advance(back, flat, at, *exact)     # with its mark, the word itself: no error
            wrong = tuple(np.concatenate(x) for x in zip(wrong, new))
        return tuple(np.concatenate(out, axis=1))

    @staticmethod
    def _advance(back: Direction, flat, at, q, lo, hi, place) -> tuple[tuple, np.ndarray]:
        """Patterns extended by their word's next symbol; those that took the
        mark are done and give (searched word, indexed word)."""
        lo, hi, _ = back.extend(flat[place], lo, hi)
        place = place + 1
        some, done = hi > lo, place == at[q + 1]
        end, on = some & done, some & ~done
        return (q[on], lo[on], hi[on], place[on]), np.stack([q[end], back.word_at[lo[end]]])

    def _errors(self, back: Direction, flat, at, half, q, lo, hi, place) -> tuple:
        """Patterns of the exact ones with one error at the next symbol.  An
        insertion of the next symbol itself, or a deletion of a symbol like the
        one before, is found elsewhere."""
        size = hi - lo
        small = size <= self.letters
        i = np.repeat(np.flatnonzero(small), size[small])
        rows = np.repeat(lo[small], size[small]) + np.arange(len(i)) - np.repeat(np.cumsum(size[small]) - size[small], size[small])
        pairs = np.unique(i * 256 + back.symbols[rows])
        i, symbol = pairs // 256, pairs % 256
        large = np.flatnonzero(~small)
        every = np.arange(FIRST, self.letters)
        i = np.concatenate([i, np.repeat(large, len(every))])
        symbol = np.concatenate([symbol, np.tile(every, len(large))])
        some = (symbol >= FIRST) & (symbol < self.letters) & (symbol != flat[place[i]])
        i, symbol = i[some], symbol[some]
        a, z, _ = back.extend(symbol, lo[i], hi[i])
        i, a, z = i[z > a], a[z > a], z[z > a]
        inside = place < at[q + 1] - 1                                   # before the mark
        swap = inside[i]
        drop = np.flatnonzero(inside & ((place == at[q] + half[q]) | (flat[place] != flat[np.maximum(place - 1, 0)])))
        return (np.concatenate([q[i], q[i[swap]], q[drop]]), np.concatenate([a, a[swap], lo[drop]]),
                np.concatenate([z, z[swap], hi[drop]]),
                np.concatenate([place[i], place[i[swap]] + 1, place[drop] + 1]))


_PAIRS = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])


def _shard(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Near words of a shard's words to search among its words to be found."""
    words, n, search = (table.column(c).to_pylist() for c in ("word", "n", "search"))
    indexed = {w: k for w, k, s in zip(words, n, search) if not s}
    searched = sorted({w for w, s in zip(words, search) if s})
    if not indexed or not searched:
        return _PAIRS.empty_table()
    names = sorted(indexed)
    q, hit = Index(names).near(searched, key[0].as_py() == "left")
    names, counts = pa.array(names), pa.array([indexed[w] for w in names], pa.int64())
    return pa.Table.from_arrays([pa.array(searched).take(pa.array(q)), names.take(pa.array(hit)),
                                 counts.take(pa.array(hit))], schema=_PAIRS)


# ------------------------------------------------------------------ Spark --

def vocabulary(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n."""
    return (common.doc_columns(docs).mapInArrow(_count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count))


def _halves(words: DataFrame) -> DataFrame:
    """side, half, search, word, n: where words go."""
    made = []
    for side, cut, add in (("left", "substr(word, 1, k)", 0), ("right", "substr(word, length(word) - k + 1, k)", 1)):
        for search, lengths in (("true", (0,)), ("false", (-1, 0, 1))):
            sizes = ", ".join(f"(length(word) + {x + add}) div 2" for x in lengths)
            made.append(f"transform(filter(array_distinct(array({sizes})), k -> k >= {MIN_LENGTH // 2}), k -> "
                        f"named_struct('side', '{side}', 'half', {cut.replace('k', 'CAST(k AS INT)')}, 'search', {search}))")
    return words.selectExpr("word", "n", f"inline(concat({', '.join(made)}))")


def near_words(words: DataFrame, shard: int = SHARD) -> DataFrame:
    """word, near, near_n: all pairs of near words, each way once."""
    n_shards = max(1, -(-words.count() // shard))
    dealt = _halves(words)
    hot = (dealt.filter(~F.col("search")).groupBy("side", "half").agg(F.count(F.lit(1)).alias("members"))
           .filter(F.col("members") > shard)
           .select("side", "half", F.ceil(F.col("members") / shard).cast("int").alias("cells")))
    own = F.pmod(F.xxhash64("word"), F.col("cells")).cast("int")
    dealt = (dealt.join(hot, ["side", "half"], "left").fillna(1, ["cells"])
             .withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
             .withColumn("row", F.when(F.col("search"), F.col("other")).otherwise(F.col("own")))
             .withColumn("column", F.when(F.col("search"), F.col("own")).otherwise(F.col("other")))
             .select("side", F.pmod(F.xxhash64("half", "row", "column"), F.lit(n_shards)).alias("shard"),
                     "search", "word", "n"))
    # as many tasks as shards: AQE would merge them by the size of what they read, which is small beside their work
    pairs = (dealt.repartition(2 * n_shards, "side", "shard").groupBy("side", "shard")
             .applyInArrow(_shard, "word string, near string, near_n long"))
    return pairs.repartition("word").distinct()


def forms(words: DataFrame, times: int = TIMES, shard: int = SHARD) -> DataFrame:
    """word, n, n_near, form, form_n."""
    best = near_words(words, shard).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    clear = -F.col("best.less") >= times * F.col("n")
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(clear, F.col("best.near")).alias("form"), F.when(clear, -F.col("best.less")).alias("form_n"))


def roots(found: DataFrame, times: int = TIMES) -> DataFrame:
    """word, root of the words that have a form."""
    top = found.agg(F.max("n")).first()[0] or 1
    steps = max(1, int(math.log(top, times)) + 1)          # forms that can follow one another, at most
    at = found.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(max(1, steps.bit_length())):
        at = common.written(at, "spelling-roots")
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return at


def variants(docs: DataFrame, min_count: int = MIN_COUNT, times: int = TIMES, shard: int = SHARD) -> DataFrame:
    """word, form, root, n, n_near, form_n."""
    words = common.written(vocabulary(docs, min_count), "spelling-words")
    found = common.written(forms(words, times, shard), "spelling-forms")
    return found.join(roots(found, times), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(common.read(spark, sf_dir, "documents"))
