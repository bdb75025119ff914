"""N-gram Jaccard join by T-occurrence search (DivideSkip), without losing a link.

A document's set is its distinct 5-word shingles (64-bit hashes); two link when
100 * |A n B| >= 80 * |A u B|.  The result has each document's component.

1. *Sets.*  One pass over the texts gives each document's size and a 128-bit
   fingerprint of its set.  Equal sets are one class from here on; a class is
   represented by its smallest doc_id.
2. *Blocks that lose nothing.*  Sets whose sizes are within a factor 1.25 (the
   others can't link) differ in at most d = floor((a + b) / 9) shingles.  The
   shingle space is cut by hash into m > d slices; of linked sets at least
   m - d slices are equal.  A set shows the d + 1 of its slices that hold most
   shingles (ties by content): the largest slice that two linked sets have in
   common is among what both show.  m = 1.5 (d + 1), so that empty slices and
   most of the single shingles are left out.  Classes that share a slice get an edge
   to the smallest of them, first within a batch of documents, so that only
   one row for a slice and batch is shuffled, then across batches.  Connected
   components of those edges are blocks: every link is inside one.
   Passages that many documents have let unlinked sets percolate into one
   block, the faster the larger the corpus.  So blocks of more than an eighth of
   ``BLOCK`` shingles are parted: of every slice in them all classes are compared
   by sketches of their sets, a bit for the parity of each of K parts of the
   shingle space.  Sketches differ in no more bits than the sets in shingles,
   so a pair that differs in more bits than linked sets may is no link.  The
   components of the pairs left are the blocks.
3. *Search.*  A block's sets are indexed by inverted lists.  A query set needs
   T = ceil(0.8 a) occurrences: all but the L longest of its lists are merged
   with a heap, which yields the candidates with T - L occurrences; these are
   looked up in the long lists by binary search, and dropped as soon as the
   lists left can't make up what they lack.  Only components matter, so a set
   is a query only against sets of other components, and sets of the largest
   component need no query of their own.
4. *Large blocks* (more than ``BLOCK`` shingles) are dealt into chunks.  The
   first set of the block is the query against all chunks; sets that don't
   link with it are then queries, in blocks, against every chunk.  So one hot
   group of copies is spread over many tasks, and no task holds it whole.
5. Links become components by distributed min-label propagation.

Counts: ``n_shingles`` is the set's size.  Words are ``[^\\x20\\x09-\\x0D]+`` after
A-Z are lower-cased; fewer than five words are one shingle; no words or no
text: the empty set, linked with nothing.

Nulls, ties, emptiness: a row with a null doc_id links with nothing (its
component is null); repeated rows, and rows with one doc_id and several texts,
are documents of their own in the class of their text, named by their id; an
empty table gives no rows; other columns are ignored by ``components`` and kept
by ``keep_one``.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parity.llm import common

WORDS = 5
#: Least similarity, in percent.
PERCENT = 80
#: Shingles that a search block holds at most (bounds a task's memory).
BLOCK = 2_000_000
#: Blocks that hold more than this part of ``BLOCK`` are parted by sketches.
PARTED = 8
#: Words whose hashes a worker keeps before it begins anew.
MAX_WORDS = 400_000

_HASHES: dict[str, int] = {}
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


# ------------------------------------------------------------------- sets --

def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def shingles(text: str) -> np.ndarray:
    """Distinct shingle hashes of a whole text, ascending."""
    words = common.words_of(common.lower_ascii(text))
    if not words:
        return np.empty(0, np.uint64)
    if len(_HASHES) > MAX_WORDS:
        _HASHES.clear()
    known = _HASHES
    for w in set(words):
        if w not in known:
            known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = min(WORDS, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        out = mix(out ^ h[i:len(h) - n + 1 + i])
    return np.unique(out)


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums of scrambled members, as signed numbers."""
    a = mix(s).sum(dtype=np.uint64)
    b = mix(s ^ _M2).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


# ----------------------------------------------------------------- slices --

def _band(n: int) -> tuple[int, int]:
    """The size band that ``n`` is in: bands end where 1.25 times their begin does."""
    lo = 1
    while True:
        hi = max(lo, (5 * lo) // 4)
        if n <= hi:
            return lo, hi
        lo = hi + 1


def schemes(n: int) -> list[tuple[int, int]]:
    """(scheme number, largest difference d) that a set of size ``n`` shows
    slices under: the scheme of its band, for partners of its band and larger,
    and that of the band below, for partners of that one."""
    lo, hi = _band(n)
    out = [(lo, hi // 4)]
    if lo > 1:
        below = _band(lo - 1)
        if 4 * n <= 5 * below[1]:
            out.append((below[0], below[1] // 4))
    return out


def slices(s: np.ndarray) -> np.ndarray:
    """Signatures (64-bit) of the slices that a set shows."""
    made = []
    for scheme, d in schemes(len(s)):
        m = -(-3 * (d + 1) // 2) if d else 1
        at = ((s >> np.uint64(20)) % np.uint64(m)).astype(np.int64)
        count = np.bincount(at, minlength=m)
        content = np.zeros(m, np.uint64)
        np.add.at(content, at, mix(s ^ np.uint64(scheme)))
        sig = mix(content + np.arange(scheme << 20, (scheme << 20) + m, dtype=np.uint64) * _M1)
        if d:
            order = np.lexsort((sig, count))
            sig = sig[order[m - (d + 1):]]
        made.append(sig)
    return np.concatenate(made)


# --------------------------------------------------------------- sketches --

def sketch_words(n: int) -> int:
    """64-bit words of a sketch: a power of two, of at least 3/4 n bits."""
    words = 1
    while 4 * 64 * words < 3 * n:
        words *= 2
    return words


def sketch(s: np.ndarray) -> np.ndarray:
    """Parities of the number of members in each part of the shingle space."""
    bits = 64 * sketch_words(len(s))
    at = ((s >> np.uint64(8)) & np.uint64(bits - 1)).astype(np.int64)
    odd = (np.bincount(at, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<u8")


def folded(x: np.ndarray, words: int) -> np.ndarray:
    """The sketch with fewer words (a power of two) of the same set."""
    while len(x) > words:
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return x


def may_link(n: int, x: np.ndarray, sizes: np.ndarray, sketches: np.ndarray) -> np.ndarray:
    """Which of the sets, by sizes and sketches (rows as long as ``x``), the set
    of size ``n`` and sketch ``x`` isn't known not to link with."""
    most = n + sizes - 2 * needed(n, sizes)
    return ((100 * np.minimum(n, sizes) >= PERCENT * np.maximum(n, sizes))
            & (np.bitwise_count(sketches ^ x).sum(axis=1, dtype=np.int64) <= most))


def sketch_links(sizes: np.ndarray, sketches: list[np.ndarray], label: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of sets that may link and connect, beyond ``label``, the components
    of all pairs that may."""
    out, label = [], label.copy()
    words = np.array([len(x) for x in sketches])
    for w in np.unique(words).tolist():
        # sizes within a factor 1.25 have sketches of as many words or twice as many
        at = np.concatenate([np.flatnonzero(words == w), np.flatnonzero(words == 2 * w)])
        own, n, labels = int((words == w).sum()), sizes[at], label[at]
        if (labels == labels[0]).all():
            continue
        rows = np.stack([folded(sketches[i], w) for i in at.tolist()])
        for q in range(own):
            c = q + 1 + np.flatnonzero(labels[q + 1:] != labels[q])
            c = c[may_link(int(n[q]), rows[q], n[c], rows[c])]
            if len(c):
                joined, first = np.unique(labels[c], return_index=True)
                out += [(int(at[q]), int(at[i])) for i in c[first].tolist()]
                label[np.isin(label, joined)] = labels[q]
                labels = label[at]
                if (labels == labels[0]).all():
                    break
    return out


# ----------------------------------------------------------------- search --

class Lists:
    """Inverted lists of sets: shingle -> ascending numbers of the sets."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(s) for s in sets], np.int64)
        tokens = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, self.owner = tokens[order], owner[order]
        self.first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else \
            np.empty(0, np.int64)
        self.token = tokens[self.first]
        self.end = np.concatenate([self.first[1:], [len(tokens)]]) if len(tokens) else np.empty(0, np.int64)

    def of(self, s: np.ndarray, least: int) -> list[np.ndarray]:
        """The lists of a set's shingles that hold at least ``least`` numbers."""
        if not len(self.token):
            return []
        at = np.minimum(np.searchsorted(self.token, s), len(self.token) - 1)
        at = at[(self.token[at] == s) & (self.end[at] - self.first[at] >= least)]
        return [self.owner[a:b] for a, b in zip(self.first[at].tolist(), self.end[at].tolist())]


def needed(a, b):
    """Least overlap of linked sets of these sizes: ceil of 80 (a + b) / 180."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def divide_skip(query: np.ndarray, index: Lists, wanted: np.ndarray, inside: bool = False) -> list[int]:
    """Numbers of the index's sets that link with the query, among ``wanted``
    (booleans by number).  ``inside``: the query is in the index, and not
    wanted, so lists of one number hold nothing else."""
    a = len(query)
    lists = index.of(query, 1 + inside)
    t = -(-PERCENT * a // 100)  # whatever the partner's size, it needs this many
    if len(lists) < t:
        return []
    lists.sort(key=len)
    n_long = min(t - 1, len(lists) - 1)
    short, long = lists[:len(lists) - n_long], [x.tolist() for x in lists[len(lists) - n_long:]]
    counts: dict[int, int] = {}
    if sum(map(len, short)) == len(short):
        for x in short:
            counts[int(x[0])] = counts.get(int(x[0]), 0) + 1
    else:
        for number in heapq.merge(*(x.tolist() for x in short)):
            counts[number] = counts.get(number, 0) + 1
    found = []
    for number, n in counts.items():
        b = int(index.sizes[number])
        if not wanted[number] or n < t - n_long or 100 * min(a, b) < PERCENT * max(a, b):
            continue
        least, left = needed(a, b), n_long
        for x in reversed(long):  # the longest first: the likeliest to hold it
            if n >= least or n + left < least:
                break
            left -= 1
            i = bisect_left(x, number)
            n += i < len(x) and x[i] == number
        if n >= least:
            found.append(number)
    return found


class Forest:
    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def block_links(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect the components of a block's sets."""
    index, out = Lists(sets), []
    label = np.arange(len(sets))
    asked = np.zeros(len(sets), bool)
    while True:
        # two sets not asked yet may link unseen only if they are in different components
        kinds, n = np.unique(label[~asked], return_counts=True)
        if len(kinds) < 2:
            return out
        rarest = kinds[int(np.argmin(n))]
        q = int(np.flatnonzero(~asked & (label == rarest))[0])
        asked[q] = True
        found = np.array(divide_skip(sets[q], index, ~asked & (label != rarest), inside=True), np.int64)
        if len(found):
            joined, first = np.unique(label[found], return_index=True)
            out += [(q, int(number)) for number in found[first]]
            label[np.isin(label, joined)] = rarest


# ------------------------------------------------------------------ Spark --

#: What a batch of documents shows, packed: arrays of one bucket a row.
SHOWN = pa.schema([("part", pa.int32()),
                   *((c, pa.binary()) for c in ("sig", "f1", "a", "b", "sets", "slice", "member", "class", "words"))])
#: An edge (a, b) between classes, or a document's set (f2 not null), or a class
#: (f1) of a slice, or a class's size and sketch.
FOUND = pa.schema([*((c, pa.int64()) for c in ("a", "b", "doc_id", "text_hash", "n", "f1", "f2", "slice")),
                   ("sketch", pa.binary())])
EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def text_hash():
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _stars(sig: np.ndarray, f1: np.ndarray, last: bool) -> tuple[np.ndarray, ...]:
    """Of (slice, class) rows: each slice once with its smallest class, the
    distinct edges (a, b) from that one to the slice's other classes, and the
    (slice, class) rows of slices of several classes.

    A slice's last bit tells that it stands for several classes of a batch.
    The ``last`` time, slices of two classes in all are left out of the rows:
    their edge says the same."""
    order = np.lexsort((f1, sig >> np.uint64(1)))
    sig, f1 = sig[order], f1[order]
    key, many = sig >> np.uint64(1), (sig & np.uint64(1)).astype(bool)
    new = np.concatenate([[True], key[1:] != key[:-1]])
    fresh = new | np.concatenate([[True], f1[1:] != f1[:-1]])
    start = np.flatnonzero(new)
    group = np.cumsum(new, dtype=np.int32) - 1
    least = f1[start][group]
    other = least != f1
    edges = np.unique(np.stack([least[other], f1[other]], axis=1), axis=0)
    classes = np.add.reduceat(fresh.astype(np.int64), start)
    several = classes > 1
    known = fresh & (several & ((classes + np.logical_or.reduceat(many, start) > 2) | (not last)))[group]
    return ((key[start] << np.uint64(1)) | several.astype(np.uint64), f1[start], edges[:, 0], edges[:, 1],
            key[known].view(np.int64), f1[known])


def _show(parts: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Each batch's sets, and the slices and sketches of the classes not seen before in the task."""
    seen: set[int] = set()
    for batch in parts:
        sigs, owners, rows, classes, words = [], [], [], [], []
        for doc_id, h, t in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), common.texts(batch)):
            s = shingles(t)
            f, f2 = fingerprint(s)
            rows.append((doc_id or 0, doc_id is None, h, len(s), f, f2))
            if not len(s) or doc_id is None or f in seen:
                continue
            if len(seen) > MAX_WORDS:
                seen.clear()
            seen.add(f)
            x = slices(s)
            sigs.append(x)
            owners.append(np.full(len(x), f, np.int64))
            classes.append((f, len(s)))
            words.append(sketch(s).tobytes())
        out: list[dict] = [{"part": lo % buckets, "sets": np.array(rows[lo:lo + 1000], "<i8").tobytes()}
                           for lo in range(0, len(rows), 1000)]
        if sigs:
            sig = np.concatenate(sigs) & ~np.uint64(1)
            sig, f1, a, b, shown, member = _stars(sig, np.concatenate(owners), False)
            bucket = ((sig >> np.uint64(1)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            sig, f1 = sig[order], f1[order]
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
            out += [{"part": i, "sig": sig[x:y].tobytes(), "f1": f1[x:y].tobytes()}
                    for i, (x, y) in enumerate(zip(cut, cut[1:])) if y > x]
            for one, two, x, y in (("a", "b", a, b), ("slice", "member", shown, member)):
                out += [{"part": lo % buckets, one: x[lo:lo + 100_000].tobytes(), two: y[lo:lo + 100_000].tobytes()}
                        for lo in range(0, len(x), 100_000)]
            out += [{"part": lo % buckets, "class": np.array(classes[lo:lo + 1000], "<i8").tobytes(),
                     "words": b"".join(words[lo:lo + 1000])} for lo in range(0, len(classes), 1000)]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array([row.get(f.name, b"") for row in out], f.type) for f in SHOWN], schema=SHOWN)


def _found(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in FOUND], schema=FOUND)


def _found_edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return _found(a=np.minimum(a, b), b=np.maximum(a, b))


def _found_sets(sets: np.ndarray) -> pa.RecordBatch:
    named = {c: np.ascontiguousarray(sets[:, i]) for i, c in enumerate(("text_hash", "n", "f1", "f2"), 2)}
    return _found(doc_id=pa.array(sets[:, 0], mask=sets[:, 1] != 0), **named)


def _found_sketches(classes: np.ndarray, words: bytes) -> pa.RecordBatch:
    ends = np.cumsum([8 * sketch_words(n) for n in classes[:, 1].tolist()]).tolist()
    return _found(f1=np.ascontiguousarray(classes[:, 0]), n=np.ascontiguousarray(classes[:, 1]),
                  sketch=[words[lo:hi] for lo, hi in zip([0, *ends], ends)])


def sets_and_edges(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(doc_id, text_hash, n, f1, f2 of each document; edges a < b from each
    class to the smallest that shows the same slice; slice, f1 of slices that
    more than two classes show; f1, n, sketch of each class), from one pass
    over the texts.

    Slices travel as arrays, one row for a batch and bucket; buckets are as
    many as four times the shuffle partitions, so their size is set by those."""
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def show(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _show(parts, buckets)

    def meet(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sig, f1 = [], []
        for batch in parts:
            for s, f, a, b, rows, at, member, classes, words in zip(
                    *(batch.column(i).to_pylist() for i in range(1, len(SHOWN)))):
                if s:
                    sig.append(np.frombuffer(s, np.uint64))
                    f1.append(np.frombuffer(f, np.int64))
                if a:
                    yield _found_edges(np.frombuffer(a, np.int64), np.frombuffer(b, np.int64))
                if rows:
                    yield _found_sets(np.frombuffer(rows, "<i8").reshape(-1, 6))
                if at:
                    yield _found(slice=np.frombuffer(at, np.int64), f1=np.frombuffer(member, np.int64))
                if classes:
                    yield _found_sketches(np.frombuffer(classes, "<i8").reshape(-1, 2), words)
        if sig:
            _, _, a, b, at, member = _stars(np.concatenate(sig), np.concatenate(f1), True)
            if len(a):
                yield _found_edges(a, b)
            if len(at):
                yield _found(slice=at, f1=member)

    shown = common.doc_columns(docs).withColumn("text_hash", text_hash()).mapInArrow(
        show, "part int, " + ", ".join(f"{f.name} binary" for f in list(SHOWN)[1:]))
    found = common.written(shown.repartition(buckets // 4, "part").mapInArrow(
        meet, ", ".join(f"{f.name} {'binary' if f.type == pa.binary() else 'long'}" for f in FOUND)), "sets")
    common.let_go(docs.sparkSession)
    return (found.filter("f2 is not null").select("doc_id", "text_hash", "n", "f1", "f2"),
            found.filter("a is not null").select("a", "b").distinct(),
            found.filter("slice is not null").select("slice", "f1"),
            found.filter("sketch is not null").select("f1", "n", "sketch"))


def _edge_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], schema=EDGES)


def connected(edges: DataFrame, name: str) -> DataFrame:
    """(node, label): the smallest node of each node's component.

    Min-label propagation with hooking: every round each node takes the
    smallest label next to it, and labels are then replaced by their own
    labels; rounds are written to the shared folder.  A hub with very many
    edges is pre-aggregated, as labels are combined by min before each
    shuffle."""
    both = common.written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                          .distinct(), f"{name}-edges")
    labels = common.written(both.groupBy(F.col("a").alias("node"))
                            .agg(F.least(F.min("b"), F.first("a")).alias("label")), f"{name}-labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        # a node's root takes the smallest label next to any node of its own
        hooks = (labels.join(near, "node").groupBy(F.col("label").alias("root")).agg(F.min("near").alias("to"))
                 .filter("to < root"))
        hooks = common.written(hooks, f"{name}-hooks")
        if hooks.isEmpty():
            return labels
        labels = labels.join(hooks, labels["label"] == hooks["root"], "left").select(
            "node", F.coalesce("to", "label").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        labels = common.written(labels.join(jump, "label", "left").select(
            "node", F.coalesce("up", "label").alias("label")), f"{name}-labels")


def _sets_of(batches_: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches_:
        cols = {f: b.column(b.schema.get_field_index(f)) for f in b.schema.names}
        for lo in range(0, b.num_rows, 256):
            yield from zip(*(cols[f].slice(lo, 256).to_pylist() for f in ("task", "query", "f1", "text")))


def _tasks(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows of one task after another (the partition is sorted by task)."""
    group: list[tuple] = []
    for r in rows:
        if group and r[0] != group[0][0]:
            yield group
            group = []
        words = shingles(r[3])
        if fingerprint(words)[0] == r[2]:  # another text under the same doc_id isn't the class's
            group.append((r[0], r[1], r[2], words))
    if group:
        yield group


def search(rows: DataFrame) -> DataFrame:
    """Links (a, b) found in tasks.  Rows: task, query (null: all against all;
    true: a query; false: a set of the index), f1, text."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple[int, int]] = []
        for group in _tasks(_sets_of(parts)):
            group = list({(r[1], r[2]): r for r in sorted(group, key=lambda r: r[2])}.values())
            if group[0][1] is None:
                links = [(group[i][2], group[j][2]) for i, j in block_links([r[3] for r in group])]
            else:
                # a query in its own chunk is in the index as well
                asked, held = [r for r in group if r[1]], [r for r in group if not r[1]]
                index, forest = Lists([r[3] for r in held]), Forest(len(held) + len(asked))
                links = []
                for i, (_, _, f, s) in enumerate(asked):
                    wanted = np.array([r[2] != f for r in held], bool)
                    for j in divide_skip(s, index, wanted):
                        if forest.join(len(held) + i, j):
                            links.append((f, held[j][2]))
            made += links
            if len(made) > 50_000:
                yield _edge_batch(*np.array(made, np.int64).T)
                made = []
        if made:
            yield _edge_batch(*np.array(made, np.int64).T)

    keyed = rows.repartition("task").sortWithinPartitions("task")
    return keyed.mapInArrow(run, "a long, b long")


def near_edges(edges: DataFrame) -> DataFrame:
    """The edges (a, b) whose sets may link, by sizes na, nb and sketches sa, sb."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            kept = []
            for a, b, n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "na", "nb", "sa", "sb"))):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                w = min(len(x), len(y))
                if may_link(n, folded(x, w), np.array([m]), folded(y, w)[None, :])[0]:
                    kept.append((a, b))
            if kept:
                yield _edge_batch(*np.array(kept, np.int64).T)

    return edges.mapInArrow(run, "a long, b long")


def near_in_slices(rows: DataFrame) -> DataFrame:
    """Edges (a, b) that connect, of each slice, the classes that may link.
    Rows: slice, f1, n, sketch.  What one slice of a task has connected isn't
    compared again in another."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[int, int] = {}
        forest = Forest(0)
        made: list[tuple[int, int]] = []

        def compare(group: dict[int, tuple]) -> None:
            for f in group:
                if f not in numbers:
                    numbers[f] = len(numbers)
                    forest.parent.append(numbers[f])
            names = list(group)
            label = np.array([forest.find(numbers[f]) for f in names])
            for i, j in sketch_links(np.array([n for n, _ in group.values()], np.int64),
                                     [np.frombuffer(x, "<u8") for _, x in group.values()], label):
                if forest.join(numbers[names[i]], numbers[names[j]]):
                    made.append((names[i], names[j]))

        at, group = None, {}
        for batch in parts:
            for key, f, n, x in zip(*(batch.column(c).to_pylist() for c in ("slice", "f1", "n", "sketch"))):
                if key != at:
                    if len(group) > 1:
                        compare(group)
                    at, group = key, {}
                group[f] = n, x
            if len(made) > 50_000:
                yield _edge_batch(*np.array(made, np.int64).T)
                made.clear()
        if len(group) > 1:
            compare(group)
        if made:
            yield _edge_batch(*np.array(made, np.int64).T)

    return rows.repartition("slice").sortWithinPartitions("slice").mapInArrow(run, "a long, b long")


def parted(blocks: DataFrame, large: DataFrame, edges: DataFrame, shown: DataFrame, sketches: DataFrame) -> DataFrame:
    """``blocks`` (node, label), those whose label is in ``large`` parted by
    sketches.  ``large`` has few rows: a block of it has many shingles."""
    held = common.written(blocks.join(F.broadcast(large), "label", "left_semi").select(F.col("node").alias("f1"))
                          .join(sketches.dropDuplicates(["f1"]), "f1"), "block-sketches")
    ends = edges.join(held.select(F.col("f1").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a").join(
        held.select(F.col("f1").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b")
    near = common.written(near_edges(ends).union(near_in_slices(shown.join(held, "f1"))), "near")
    common.let_go(blocks.sparkSession)
    return common.written(blocks.join(F.broadcast(large), "label", "left_anti").select("node", "label")
                          .union(connected(near, "parted").select("node", "label")), "blocks")


def class_links(docs: DataFrame, sets: DataFrame, edges: DataFrame, shown: DataFrame, sketches: DataFrame,
                block: int = BLOCK) -> DataFrame:
    """Links (a, b) between classes (by f1) that connect each component."""
    blocks = connected(edges, "blocks")
    # one document for each class of a block; its text is what the search reads
    named = (sets.filter("n > 0 and doc_id is not null").groupBy("f1")
             .agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n")))

    def of(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
        members = named.join(blocks.withColumnRenamed("node", "f1"), "f1")
        return members, members.groupBy("label").agg(F.sum("n").alias("total"), F.min("f1").alias("pivot"))

    members, sizes = of(blocks)
    large = common.written(sizes.filter(F.col("total") > block // PARTED).select("label"), "large-blocks")
    if not large.isEmpty():
        members, sizes = of(parted(blocks, large, edges, shown, sketches))
    members = members.join(sizes, "label").select("f1", "doc_id", "label", "total", "pivot")
    text = common.written(common.doc_columns(docs.filter(F.col("doc_id").isNotNull())).join(members, "doc_id"),
                          "block-members")
    common.let_go(docs.sparkSession)
    small = text.filter(F.col("total") <= block).select(
        F.struct(F.col("label").alias("label"), F.lit(0).alias("chunk"), F.lit(0).alias("part")).alias("task"),
        F.lit(None).cast("boolean").alias("query"), "f1", "text")
    found = common.written(search(small), "links")
    large = text.filter(F.col("total") > block)
    return found if large.isEmpty() else found.union(_large_links(large, block))


def _large_links(large: DataFrame, block: int) -> DataFrame:
    """Links within blocks too large for one task: their first set against
    every chunk, then the sets that it doesn't link with against every chunk."""
    half = block // 2
    sets = common.written(large.select(
        "f1", "text", "label", "pivot", F.ceil(F.col("total") / half).cast("int").alias("chunks")), "large-sets")
    sets = sets.withColumn("chunk", F.pmod(F.xxhash64("f1"), F.col("chunks")).cast("int"))
    task = F.struct("label", "chunk", "part").alias("task")
    index = sets.withColumn("part", F.lit(0)).select(task, F.lit(False).alias("query"), "f1", "text")

    def queries(asked: DataFrame) -> DataFrame:
        spread = asked.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        return spread.select(task, F.lit(True).alias("query"), "f1", "text")

    pivots = sets.filter("f1 = pivot").withColumn("part", F.lit(0))
    first = common.written(search(index.union(queries(pivots))), "pivot-links")
    linked = first.select(F.col("a").alias("f1")).union(first.select(F.col("b").alias("f1"))).distinct()
    left = common.written(sets.filter("f1 != pivot").join(linked, "f1", "left_anti"), "large-left")
    if left.isEmpty():
        return first
    # queries in parts of about half a block's share; the index goes to each part that its block has
    per_part = F.pmod(F.xxhash64(F.col("f1") + 1), F.col("parts")).cast("int")
    parts = left.groupBy("label").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / 2000)).cast("int").alias("parts"))
    asked = left.join(parts, "label").withColumn("part", per_part)
    again = (sets.join(parts, "label").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select(task, F.lit(False).alias("query"), "f1", "text"))
    return first.union(common.written(search(again.union(queries(asked))), "left-links"))


def labelled(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id of each document, and
    ``label``, which tells components apart whose smallest rows share an id."""
    sets, *found = sets_and_edges(docs)
    linked = connected(class_links(docs, sets, *found, block), "links")
    classes = (sets.filter("n > 0 and doc_id is not null").groupBy("f1", "f2").agg(F.min("doc_id").alias("least"))
               .join(linked.withColumnRenamed("node", "f1"), "f1", "left")
               .withColumn("label", F.coalesce("label", "f1")))
    least = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "label").select("f1", "f2", "component_id", "label")
    return (sets.join(named, ["f1", "f2"], "left")
            .select("doc_id", "text_hash", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id"))
                    .alias("component_id"), "label"))


def components(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id of each document."""
    return labelled(docs, block).drop("label")


def keep_one(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One document of each component, with all columns: that with the smallest
    doc_id; of several rows under this id, one whose text has the smallest hash.
    Documents that link with nothing stay, repeated rows without words too.
    Columns of the table are held in one, so none can clash with a helper's."""
    found = common.written(labelled(docs, block).filter("doc_id is not null and n_shingles > 0"), "join-decisions")
    first = (found.filter("doc_id = component_id").groupBy("label", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
             .groupBy("label").agg(F.min("text_hash").alias("first_hash"), F.min_by("copies", "text_hash").alias("copies")))
    stays = (F.col("doc_id") == F.col("component_id")) & (F.col("text_hash") == F.col("first_hash"))
    gone = (found.join(first, "label").filter(~stays | (F.col("copies") > 1))
            .select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"), stays.alias("again")).distinct())
    gone = common.written(gone, "join-gone")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col("doc_id").cast("long").alias("id"), text_hash().alias("hash"))
    same = (F.col("id") == F.col("gone_id")) & (F.col("hash") == F.col("gone_hash"))
    out = keyed.join(gone, same, "left_anti").select("row")
    again = gone.filter("again")
    if not again.isEmpty():     # the one row of several under the same id and text
        order = Window.partitionBy("id", "hash").orderBy(F.xxhash64("row"))
        out = out.unionByName(keyed.join(again, same, "left_semi").withColumn("place", F.row_number().over(order))
                              .filter("place = 1").select("row"))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(common.read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
        WHEN len(ws) < {WORDS} THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - {WORDS - 2}), lambda i: array_to_string(ws[i:i + {WORDS - 1}], ' '))
        END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
      GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * shared >= {PERCENT} * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, reached) AS (SELECT DISTINCT a, a FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.reached),
c AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.node = d.doc_id
"""
