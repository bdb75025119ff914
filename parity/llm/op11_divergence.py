"""Source divergence audit: how the sources of a language differ in their terms.

Terms are maximal runs of ASCII letters and code points from U+0080 on, with
A-Z lower-cased.  A language keeps the V terms that at least ``MIN_DOCS`` of
its documents hold.  A group (lang, source) gives each kept term the share

    p = 1 + floor(10^9 * (count + 2) / (N + 2 V))

(N: the group's occurrences of kept terms; a language has shares likewise),
and two shares are apart by f = floor((p - q)^2 / (p + q)).  ``divergence``
returns for each group its distance to every other source of the language
(part ``pair``: f summed over all V terms) and the ten terms by which it
exceeds its language most (part ``term``).

1. Counting.  A task reads the UTF-8 bytes of its texts as numpy arrays.  Terms
   are packed by length: up to 8 bytes in one uint64, up to 16 in two, longest
   byte first, so that their numeric order is the byte order; longer terms go
   to a bucket of their own byte length.  Packed terms are sorted by radix, 16
   bits a pass, buckets as fixed-width byte strings; run lengths of the sorted
   (term, group, document) rows are the counts.  A task folds its counts when
   ``FOLD`` rows have gathered and hands them on when they don't shrink, so
   its memory doesn't grow with its input.
2. Spark sums the counts by (lang, source, term), then finds the kept terms by
   (lang, term).  A frequent term has one row a source by then.
3. Pairs of sources.  The kept terms of a language are dealt into blocks of
   about ``BLOCK`` terms, its sources into tiles of about ``TILE``; a task takes
   two tiles of one block as matrices of shares and sums f - f0, where f0 is
   the distance at a term that both sources lack.  The sum over the blocks plus
   V * f0 is the sum over all V terms.  No pair of rows is ever built; work and
   output are those of the S^2 results that the audit is about.

Arithmetic is exact: shares are computed in DECIMAL, their squares fit a BIGINT.

Nulls, ties, emptiness: null text, lang or source is ''; repeated rows are
documents of their own; a group without terms has p of count 0 and takes part
in ``pair``; a language without kept terms has distances 0; equal values are
ranked by item in UTF-8 order; an empty table gives no rows; other columns are
ignored.  A text longer than ``SLICE`` bytes is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parity.llm import common

MIN_DOCS = 10
TOP_TERMS = 10
#: Terms of a block and sources of a tile, about.
BLOCK = 2048
TILE = 256
#: Bytes of text that a task takes at a time, and rows of counts that it folds.
SLICE = 4 << 20
FOLD = 1 << 20
#: Bytes of long terms that make a task fold as well.
FOLD_BYTES = 64 << 20

_BYTES = np.arange(256)
_IS_LETTER = (_BYTES >= 0x80) | ((_BYTES | 0x20 >= ord("a")) & (_BYTES | 0x20 <= ord("z")) & (_BYTES >= ord("A")))
_LOWER = np.where((_BYTES >= ord("A")) & (_BYTES <= ord("Z")), _BYTES + 32, _BYTES).astype(np.uint8)
#: Mask that keeps the first n bytes of a packed word.
_KEEP = np.array([0] + [(1 << 64) - (1 << 8 * (8 - n)) for n in range(1, 9)], np.uint64)

COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                    ("n", pa.int64()), ("docs", pa.int64())])


# ---------------------------------------------------------------- packing --

def spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, document number) of the terms in the bytes of documents
    that begin and end at ``bounds``."""
    letter = _IS_LETTER[data]
    begins, ends = letter.copy(), letter.copy()
    begins[1:] &= ~letter[:-1]
    ends[:-1] &= ~letter[1:]
    inner = bounds[(bounds > 0) & (bounds < len(data))]   # a term never runs on into the next document
    begins[inner] = letter[inner]
    ends[inner - 1] = letter[inner - 1]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1 - start, np.searchsorted(bounds, start, "right") - 1


def packed(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
    """Terms of at most 8 (one word) or 16 (two words) bytes as uint64, first byte highest."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    at = np.ndarray((len(padded) - 7,), ">u8", padded, strides=(1,))
    n_words = 1 if not len(length) or length.max() <= 8 else 2
    return [at[start + 8 * k].astype(np.uint64) & _KEEP[np.clip(length - 8 * k, 0, 8)] for k in range(n_words)]


def radix_order(words: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """``order`` sorted stably by the words (the first one counts most), 16 bits a pass."""
    for word in reversed(words):
        for shift in range(0, 8 * word.dtype.itemsize, 16):
            digit = (word >> word.dtype.type(shift)).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                order = order[np.argsort(digit[order], kind="stable")]   # numpy sorts 16-bit keys by radix
    return order


def _order(keys: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    if keys[0].dtype.kind == "S":
        return order[np.argsort(keys[0][order], kind="stable")]
    return radix_order(keys, order)


def _changes(keys: list[np.ndarray]) -> np.ndarray:
    """Whether a row differs from the one before it."""
    out = np.zeros(len(keys[0]), bool)
    out[:1] = True
    for k in keys:
        out[1:] |= k[1:] != k[:-1]
    return out


def run_counts(keys: list[np.ndarray], group: np.ndarray, doc: np.ndarray) -> tuple:
    """Distinct (term, group) rows: keys, group, occurrences, documents.
    ``doc`` ascends."""
    order = _order(keys, radix_order([group], np.arange(len(group))))
    keys, group, doc = [k[order] for k in keys], group[order], doc[order]
    new = _changes([*keys, group])
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(group)))
    docs = np.add.reduceat((new | _changes([doc])).astype(np.int64), at) if len(at) else n
    return [k[at] for k in keys], group[at], n, docs


def fold(parts: list[tuple]) -> tuple:
    """Counts of several parts added up, one row a (term, group)."""
    keys = [np.concatenate(k) for k in zip(*(p[0] for p in parts))]
    group, n, docs = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
    order = _order(keys, radix_order([group], np.arange(len(group))))
    keys, group, n, docs = [k[order] for k in keys], group[order], n[order], docs[order]
    at = np.flatnonzero(_changes([*keys, group]))
    return [k[at] for k in keys], group[at], np.add.reduceat(n, at), np.add.reduceat(docs, at)


def unpacked(keys: list[np.ndarray]) -> pa.Array:
    """The terms as strings (no term holds a zero byte)."""
    if keys[0].dtype.kind == "S":
        rows = keys[0].view(np.uint8).reshape(len(keys[0]), -1)
    else:
        rows = np.stack(keys, axis=1).astype(">u8").view(np.uint8)
    used = rows != 0
    ends = np.concatenate([[0], np.cumsum(used.sum(axis=1))])
    return pa.Array.from_buffers(pa.large_string(), len(rows), [
        None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(rows[used].tobytes())]).cast(pa.string())


class Counter:
    """Counts of the terms that a task has seen, by length bucket: 1 and 2
    words, and the byte length for longer terms."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.parts: dict[int, list[tuple]] = {}
        self.rows = self.bytes = 0

    def add(self, data: np.ndarray, bounds: np.ndarray, group: np.ndarray) -> None:
        """The documents between ``bounds``, each with its group number."""
        data = _LOWER[data]
        start, length, doc = spans(data, bounds)
        for bucket, some in ((1, length <= 8), (2, (length > 8) & (length <= 16))):
            if some.any():
                self._keep(bucket, packed(data, start[some], length[some]), doc[some], group)
        for size in np.unique(length[length > 16]).tolist():
            some = np.flatnonzero(length == size)
            rows = np.lib.stride_tricks.sliding_window_view(data, size)[start[some]]
            self._keep(size, [np.ascontiguousarray(rows).view(f"S{size}").ravel()], doc[some], group)

    def _keep(self, bucket: int, keys: list[np.ndarray], doc: np.ndarray, group: np.ndarray) -> None:
        part = run_counts(keys, group[doc], doc)
        self.parts.setdefault(bucket, []).append(part)
        self._grow(bucket, len(part[1]))

    def _grow(self, bucket: int, rows: int) -> None:
        self.rows += rows
        self.bytes += rows * bucket if bucket > 16 else 0

    @property
    def full(self) -> bool:
        return self.rows > FOLD or self.bytes > FOLD_BYTES

    def folded(self) -> None:
        parts, self.parts, self.rows, self.bytes = self.parts, {}, 0, 0
        for bucket, some in parts.items():
            self.parts[bucket] = [fold(some)]
            self._grow(bucket, len(self.parts[bucket][0][1]))

    def rows_out(self) -> Iterator[pa.RecordBatch]:
        """All counts, folded; the counter is empty afterwards."""
        self.folded()
        names = list(self.groups)
        langs, sources = (pa.array([g[i] for g in names], pa.string()) for i in (0, 1))
        for keys, group, n, docs in (p[0] for p in self.parts.values()):
            step = max(1, min(65_536, FOLD_BYTES // 8 // max(1, keys[0].dtype.itemsize)))
            for at in range(0, len(group), step):
                cut = slice(at, at + step)
                who = pa.array(group[cut])
                yield pa.RecordBatch.from_arrays(
                    [langs.take(who), sources.take(who), unpacked([k[cut] for k in keys]),
                     pa.array(n[cut], pa.int64()), pa.array(docs[cut], pa.int64())], schema=COUNTS)
        self.__init__()


def _slices(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about SLICE bytes, a longer row by itself."""
    ends = np.cumsum(lengths)
    at = 0
    while at < len(lengths):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + SLICE, "right")))
        yield at, to
        at = to


def _count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter = Counter()
    for batch in parts:
        text = batch.column(2).cast(pa.large_binary())
        bounds = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, 8 * text.offset) if len(text) else []
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        pairs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        for a, b in _slices(np.diff(bounds)):
            number = np.array([counter.groups.setdefault(p, len(counter.groups)) for p in pairs[a:b]], np.uint32)
            counter.add(data[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a], number)
            if counter.full:
                counter.folded()
                if counter.rows > FOLD // 2 or counter.bytes > FOLD_BYTES // 2:
                    yield from counter.rows_out()
    yield from counter.rows_out()


# ------------------------------------------------------------------ Spark --

def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def _share(count: str, total: str, terms: str) -> Column:
    """p; 1 where a language keeps no terms."""
    return F.expr(f"CASE WHEN {terms} = 0 THEN 1L ELSE 1 + CAST(1000000000 AS DECIMAL(10, 0)) * "
                  f"CAST({count} + 2 AS DECIMAL(20, 0)) div CAST({total} + 2 * {terms} AS DECIMAL(20, 0)) END")


def _apart(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: occurrences and documents of every term."""
    return (docs.select(_text("lang"), _text("source"), _text("text"))
            .mapInArrow(_count, "lang string, source string, term string, n long, docs long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, term, n of the kept terms, with ``lang_n`` (occurrences in
    the language) and ``first`` (1 in one row a term)."""
    w = Window.partitionBy("lang", "term")
    return (counts.select("lang", "source", "term", "n", F.sum("docs").over(w).alias("lang_docs"),
                          F.sum("n").over(w).alias("lang_n"),
                          (F.col("source") == F.min("source").over(w)).cast("long").alias("first"))
            .filter(F.col("lang_docs") >= min_docs).drop("lang_docs"))


def group_totals(docs: DataFrame, kept: DataFrame, block: int, tile: int) -> DataFrame:
    """One row a group: its total, its language's total and V, p of count 0,
    blocks and tiles of the language and the group's tile."""
    groups = docs.select(_text("lang"), _text("source")).distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("first").alias("firsts"))
    g = groups.join(sums, ["lang", "source"], "left").fillna(0, ["total", "firsts"])
    langs = g.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("firsts").alias("v"),
                                  F.count(F.lit(1)).alias("sources"))
    return (g.drop("firsts").join(langs, "lang")
            .withColumn("p0", _share("0L", "total", "v"))
            .withColumn("blocks", F.expr(f"greatest(1, (v + {block - 1}) div {block})").cast("int"))
            .withColumn("tiles", F.expr(f"greatest(1, (sources + {tile - 1}) div {tile})").cast("int"))
            .withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")))


_SUMS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()),
                   ("more", pa.int64()), ("f0", pa.int64()), ("v", pa.int64())])


def _tile_pair(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Sums of f - f0 for the pairs of sources of two tiles, over a block's terms."""
    source, term = (table.column(c).combine_chunks().dictionary_encode() for c in ("source", "term"))
    s = source.indices.to_numpy(zero_copy_only=False)
    p, p0, tile = (table.column(c).to_numpy() for c in ("p", "p0", "tile"))
    names, n = source.dictionary, len(source.dictionary)
    zero, at_tile = np.zeros(n, np.int64), np.zeros(n, np.int64)
    zero[s], at_tile[s] = p0, tile
    some = pc.is_valid(term.indices).to_numpy(zero_copy_only=False)   # the other rows only name a group
    share = np.repeat(zero[:, None], len(term.dictionary), axis=1)
    share[s[some], pc.drop_null(term.indices).to_numpy(zero_copy_only=False)] = p[some]
    low, high = (np.flatnonzero(at_tile == key[i].as_py()) for i in (2, 3))
    out = [[], [], [], []]
    for a in low.tolist():
        others = high[high > a] if key[2] == key[3] else high
        f0 = (zero[others] - zero[a]) ** 2 // (zero[others] + zero[a])
        f = (share[others] - share[a]) ** 2 // (share[others] + share[a])
        for column, values in zip(out, (np.full(len(others), a), others, f.sum(axis=1) - f0 * share.shape[1], f0)):
            column.append(values)
    a, b, more, f0 = (np.concatenate([np.empty(0, np.int64), *c]) for c in out)
    both = [names.take(pa.array(np.concatenate(x))) for x in ((a, b), (b, a))]
    return pa.Table.from_arrays(
        [pa.array([key[0].as_py()] * 2 * len(a), pa.string()), *both, pa.array(np.tile(more, 2)),
         pa.array(np.tile(f0, 2)), pa.array(np.full(2 * len(a), table.column("v")[0].as_py(), np.int64))], schema=_SUMS)


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (another source), value."""
    shares = (kept.join(groups, ["lang", "source"])
              .select("lang", "source", "term", _share("n", "total", "v").alias("p"), "p0", "v", "tile", "tiles",
                      F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")))
    names = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("p"),
                          "p0", "v", "tile", "tiles", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    dealt = (shares.unionByName(names)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other")))
    sums = (dealt.select("lang", "block", "low", "high", "source", "term", "p", "p0", "v", "tile")
            .groupBy("lang", "block", "low", "high")
            .applyInArrow(_tile_pair, "lang string, source string, item string, more long, f0 long, v long"))
    return (sums.groupBy("lang", "source", "item")
            .agg((F.sum("more") + F.max("f0") * F.max("v")).alias("value")))


def surplus_terms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (a term above its language's share), value."""
    return (kept.join(groups, ["lang", "source"])
            .select("lang", "source", F.col("term").alias("item"), _share("n", "total", "v").alias("p"),
                    _share("lang_n", "lang_total", "v").alias("q"))
            .filter("p > q").select("lang", "source", "item", F.expr(_apart("p", "q")).alias("value")))


def _ranked(df: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return df.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                     F.row_number().over(order).alias("rank"))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, block: int = BLOCK,
               tile: int = TILE) -> DataFrame:
    """lang, source, part, item, value, rank: all distances between the sources
    of a language, and each group's ``top`` surplus terms."""
    kept = common.written(kept_terms(term_counts(docs), min_docs), "divergence-terms")
    groups = common.written(group_totals(docs, kept, block, tile), "divergence-groups")
    return (_ranked(source_pairs(kept, groups), "pair")
            .unionByName(_ranked(surplus_terms(kept, groups), "term").filter(F.col("rank") <= top)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(common.read(spark, sf_dir, "documents"))


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS (SELECT rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS c FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= {MIN_DOCS}),
l AS (SELECT lang, sum(c)::HUGEINT AS n, count(*)::HUGEINT AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
gn AS (SELECT lang, source, sum(c)::HUGEINT AS n FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
        1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 2)) // (coalesce(gn.n, 0) + 2 * l.v) AS p,
        1 + (1000000000::HUGEINT * (k.c + 2)) // (l.n + 2 * l.v) AS q
      FROM g JOIN k ON k.lang = g.lang JOIN l ON l.lang = g.lang
      LEFT JOIN gn ON gn.lang = g.lang AND gn.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
      GROUP BY a.lang, a.source, b.source),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value,
  row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM r
QUALIFY part = 'pair' OR rank <= {TOP_TERMS}
"""
