"""Language-model scoring by context-tree weighting over bytes.

A text's symbols are the bytes of its words (A-Z lower-cased) joined by one
space, and one end.  A byte is eight binary decisions (its leading bits so far
name the decision, 1..255); each decision has a context tree over the
``DEPTH`` bytes before it.  A node of a tree has the Krichevsky-Trofimov
estimate of its counts; its probability is half that and half the product of
its children's.  From the training counts follows the weight w of a node's own
estimate against its children's, so that the next bit's probability is
w * KT + (1 - w) * child's, from the deepest known context up.

The tree has every node of the training texts (crc32(doc_id as text) mod 7 is
not 2), however rare.

1. One pass over the texts forms groups of documents of about ``GROUP`` bytes
   and writes their symbols, the counts of their training words (64-bit
   hashes) and, dealt into ``CELLS`` by the ``TOP`` bytes before the last, their
   distinct (DEPTH + 1)-byte strings with the training counts, packed.
2. Cells are put together to buckets of about ``BUCKET`` bytes.  A bucket's
   strings are added up over ``FAN`` groups in a task, then over those sums, so
   neither the groups nor the corpus decide what a task holds, but the distinct
   strings of its contexts.  A bucket has whole subtrees: their weights are
   computed in it, and what its nodes of depth TOP sum to is added up, over all
   buckets, for the nodes above.  Those are at most 255 * 256 ** d of depth
   d < TOP whatever the corpus, and broadcast.
3. Each distinct string of a bucket is scored once; the scores meet the groups
   that ask for them, FAN groups in a task, and go back to the groups, whose
   documents add theirs up.
4. Base score: words with at least 1 / ``HEAVY`` of all tokens (so at most HEAVY of them)
   are broadcast; each document's other distinct words are joined with the
   counts, which no frequent word takes part in.

Nulls, ties, emptiness: a null text is empty (one token, the end); a null
doc_id stays null (its remainder is the empty text's); repeated rows each give
their row and, if trained on, count each; with nothing to learn from, counts
and their base are zero and every bit has probability 1/2; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parity.llm import common

DEPTH = 5
#: Bytes of a group of documents, about; its distinct strings are looked up once.
GROUP = 64_000_000
#: Cells the strings are dealt into by the TOP bytes before their last.
CELLS = 1 << 12
#: Bytes of packed strings of a bucket, about; a bucket is some cells.
BUCKET = 4 << 20
#: Groups whose strings of a bucket meet in one task.
FAN = 64
#: Depths above this one are broadcast.
TOP = 3
#: Broadcast words, at most.
HEAVY = 1 << 20
#: Words whose hashes a worker keeps before it begins anew.
MAX_WORDS = 400_000
#: Bytes scored at once, about.
CHUNK = 1_000_000
#: Entries of string counts that are added up at once.
FOLD = 2_000_000

#: The end's key among the words' hashes.
END = 0
_END_BYTE = b"\n"

_HASHES: dict[str, int] = {}
DOC, STRINGS, WORDS = range(3)
GATHERED = pa.schema([("kind", pa.int32()), ("grp", pa.int64()), ("row_ids", pa.list_(pa.int64())),
                      ("doc_ids", pa.list_(pa.int64())), ("symbols", pa.binary()), ("cell", pa.int32()),
                      ("size", pa.int32()), ("key", pa.binary()),
                      ("n", pa.binary()),
                      ("words", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])
MERGED = pa.schema([("bucket", pa.int32()), ("size", pa.int32()), ("key", pa.binary()), ("n", pa.binary())])
PART = pa.schema([*MERGED, ("top", pa.list_(pa.int64())), ("n0", pa.list_(pa.int64())),
                  ("n1", pa.list_(pa.int64())), ("total", pa.list_(pa.float64()))])
LOGS = pa.schema([("bucket", pa.int32()), ("key", pa.binary()), ("log", pa.binary())])
FOUND = pa.schema([("grp", pa.int64()), ("key", pa.binary()), ("log", pa.binary())])
SCORED = pa.schema([("row_id", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                    ("heavy_known", pa.int64()), ("heavy_score", pa.float64()), ("score", pa.float64()),
                    ("light", pa.list_(pa.int64())), ("light_n", pa.list_(pa.int32()))])


# ----------------------------------------------------------------- symbols --

def word_list(text: str) -> list[str]:
    return common.words_of(common.lower_ascii(text))


def hashes(words: list[str]) -> np.ndarray:
    """Signed 64-bit hashes of words."""
    if len(_HASHES) > MAX_WORDS:
        _HASHES.clear()
    known = _HASHES
    for w in words:
        if w not in known:
            known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words)).view(np.int64)


def symbols(words: list[str]) -> bytes:
    return " ".join(words).encode("utf-8", "surrogatepass") + _END_BYTE


def words_in(doc: bytes) -> list[str]:
    """The words whose symbols these are."""
    return doc[:-1].decode("utf-8", "surrogatepass").split(" ") if len(doc) > 1 else []


def strings(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(the DEPTH + 1 bytes that end at each symbol of the documents, as one
    number; where each document begins).  Before a document stand ends."""
    pad = _END_BYTE * DEPTH
    data = np.frombuffer(pad + pad.join(docs), np.uint8).astype(np.uint64)
    key = np.zeros(len(data) - DEPTH, np.uint64)
    for i in range(DEPTH + 1):
        key = (key << np.uint64(8)) | data[i:len(data) - DEPTH + i]
    size = np.array([len(d) for d in docs])
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    keep = np.ones(len(key), bool)
    gaps = (start + np.arange(len(docs)) * DEPTH)[1:]
    for i in range(1, DEPTH + 1):
        keep[gaps - i] = False
    return key[keep], start


def chunks(docs: Iterator[tuple], size: int = CHUNK) -> Iterator[list[tuple]]:
    """Documents (their symbols last) in chunks of about ``size`` bytes."""
    held, n = [], 0
    for d in docs:
        held.append(d)
        n += len(d[-1])
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


# -------------------------------------------------------------------- tree --

def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma(x), x >= 0.5: Stirling's series at x + 8, taken back."""
    y = x + 8.0
    series = 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7)
    back = sum(np.log(x + i) for i in range(8))
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - back


def kt_log(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - np.log(np.pi)


class Level:
    """Kept nodes of one depth: keys (context << 8 | decision) ascending, the
    weight of a node's own estimate, that estimate of a one, and the one of
    its "other" child."""

    def __init__(self, key: np.ndarray, w: np.ndarray, p: np.ndarray, other: np.ndarray) -> None:
        self.key, self.w, self.p, self.other = key, w, p, other

    def find(self, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.key):
            return np.zeros(len(want), np.int64), np.zeros(len(want), bool)
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return at, self.key[at] == want


def parent(key: np.ndarray, d: int) -> np.ndarray:
    """Keys of the parents of depth-d nodes: the context lacks the farthest byte."""
    return (((key >> 8) & ((1 << (8 * (d - 1))) - 1)) << 8) | (key & 255)


def summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, ascending, and the sums of each one's values, added up in their order."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
    key = key[first]
    if not len(key):
        return key, *values
    out = []
    for v in values:
        if v.dtype.kind == "f":
            label = np.repeat(np.arange(len(first)), np.diff(first, append=len(v)))
            out.append(np.bincount(label, v[order], len(first)))
        else:
            out.append(np.add.reduceat(v[order], first))
    return key, *out


def nodes_of(key: np.ndarray, n: np.ndarray, first: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All nodes (key ascending, zeros, ones) of depths ``first`` to DEPTH of counted strings."""
    seen = n > 0
    context, byte, n = (key[seen] >> 8).astype(np.int64), (key[seen] & 255).astype(np.int64), n[seen]
    node = np.concatenate([(context << 8) | (1 << i) | (byte >> (8 - i)) for i in range(8)])
    ones = np.concatenate([n * ((byte >> (7 - i)) & 1) for i in range(8)])
    out = [summed(node, np.tile(n, 8) - ones, ones)]
    for d in range(DEPTH, first, -1):
        out.append(summed(parent(out[-1][0], d), *out[-1][1:]))
    return out[::-1]


def weigh(levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], first: int = 0,
          below: tuple | None = None) -> tuple[list[Level], tuple | None]:
    """Weights of the nodes (key ascending, zeros, ones) of each depth from
    ``first`` on, and what the depth above needs of them.  ``below``: keys of
    the parents of the nodes under the last depth, their counts and ln P_w."""
    out: list[Level | None] = [None] * len(levels)
    for i in range(len(levels) - 1, -1, -1):
        key, n0, n1 = levels[i]
        own = kt_log(n0, n1)
        rest0, rest1, children = n0.astype(float), n1.astype(float), np.zeros(len(key))
        has = np.zeros(len(key), bool)
        if below is not None and len(below[0]):
            at = np.searchsorted(key, below[0])
            np.subtract.at(rest0, at, below[1])
            np.subtract.at(rest1, at, below[2])
            np.add.at(children, at, below[3])
            has[at] = True
        children += kt_log(rest0, rest1)
        # ln P_w = ln(P_e / 2 + P_children / 2); a leaf has its estimate alone
        w = np.where(has, 1 / (1 + np.exp(np.clip(children - own, -700, 700))), 1.0)
        total = np.where(has, np.logaddexp(own, children) - np.log(2), own)
        out[i] = Level(key, w, (n1 + 0.5) / (n0 + n1 + 1.0), (rest1 + 0.5) / (rest0 + rest1 + 1.0))
        below = (parent(key, first + i), n0, n1, total) if first + i else None
    return out, below


def build(levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[Level]:
    """Weights of the kept nodes (key ascending, zeros, ones) of each depth from 0 on."""
    return weigh(levels)[0]


class Model:
    def __init__(self, levels: list[Level]) -> None:
        self.levels = levels

    def bits(self, key: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each string after the others."""
        context, byte = (key >> np.uint64(8)).astype(np.int64), (key & np.uint64(255)).astype(np.int64)
        out = np.zeros(len(key))
        for i in range(8):
            decision = (1 << i) | (byte >> (8 - i))
            p = np.full(len(key), 0.5)
            found_below = np.zeros(len(key), bool)
            for d in range(len(self.levels) - 1, -1, -1):
                level = self.levels[d]
                at, found = level.find(((context & ((1 << (8 * d)) - 1)) << 8) | decision)
                if found.any():
                    a = at[found]
                    w, below = level.w[a], np.where(found_below[found], p[found], level.other[a])
                    p[found] = w * level.p[a] + (1 - w) * below
                found_below = found
            out += np.log10(np.where((byte >> (7 - i)) & 1, p, 1 - p))
        return out

    def to_bytes(self) -> bytes:
        out = [np.array([len(self.levels), *(len(x.key) for x in self.levels)], "<i8").tobytes()]
        for x in self.levels:
            out += [x.key.astype("<i8").tobytes(), *(a.astype("<f8").tobytes() for a in (x.w, x.p, x.other))]
        return b"".join(out)

    @staticmethod
    def from_bytes(data: bytes) -> "Model":
        n = int(np.frombuffer(data, "<i8", 1)[0])
        sizes = np.frombuffer(data, "<i8", n, 8).tolist()
        at, levels = 8 * (n + 1), []
        for size in sizes:
            key = np.frombuffer(data, "<i8", size, at)
            levels.append(Level(key, *np.frombuffer(data, "<f8", 3 * size, at + 8 * size).reshape(3, size)))
            at += 32 * size
        return Model(levels)


# ------------------------------------------------------------------- Spark --

def held_out():
    return common.crc_remainder(7) == 2


def squeezed(values: np.ndarray) -> bytes:
    """64-bit numbers, compressed."""
    return pa.compress(values.tobytes(), "zstd", asbytes=True) if len(values) else b""


def restored(blob: bytes, size: int, dtype=np.int64) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, 8 * size, "zstd"), dtype) if size else np.empty(0, dtype)


def packed(key: np.ndarray) -> bytes:
    """Ascending strings as compressed differences."""
    return squeezed(np.diff(key, prepend=np.uint64(0)))


def unpacked(blob: bytes, size: int) -> np.ndarray:
    return np.cumsum(restored(blob, size, np.uint64), dtype=np.uint64)


def string_counts(docs: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct strings, ascending, of (held out, symbols) and their number in training texts."""
    found, held_rows = [], 0
    for held in chunks(iter(docs)):
        for out in (False, True):
            some = [d for h, d in held if h == out]
            if some:
                key, n = np.unique(strings(some)[0], return_counts=True)
                found.append((key, n * (not out)))
                held_rows += len(key)
        if held_rows > FOLD:                       # so that the parts of a group never add up to many times it
            found = [summed(*(np.concatenate(x) for x in zip(*found)))]
            held_rows = 0
    return summed(*(np.concatenate(x) for x in zip(*found)))


def word_counts(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word hashes, ascending, of symbols, and their numbers."""
    found, held_rows = [], 0
    for held in chunks((d,) for d in docs):
        found.append(np.unique(np.concatenate([hashes(words_in(d)) for d, in held]), return_counts=True))
        held_rows += len(found[-1][0])
        if held_rows > FOLD:
            found, held_rows = [summed(*(np.concatenate(x) for x in zip(*found)))], 0
    return summed(*(np.concatenate(x) for x in zip(*found)))


def cell_of(key: np.ndarray) -> np.ndarray:
    context = (key >> np.uint64(8)) & np.uint64((1 << (8 * TOP)) - 1)
    mixed = (context * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)
    return ((mixed * np.uint64(CELLS)) >> np.uint64(32)).astype(np.int32)


def gathered(docs: DataFrame) -> DataFrame:
    """Rows of three kinds: documents (grp, row_ids, doc_ids and, compressed, the
    symbols of about CHUNK bytes of them), strings of a group in a cell (packed, with their training counts), training words of
    a group.  A group is the row_id of its first document."""
    def rows(kind: int, grp: int, n_rows: int, **columns) -> pa.RecordBatch:
        made = {"kind": np.full(n_rows, kind, np.int32), "grp": np.full(n_rows, grp, np.int64)} | columns
        return pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) if f.name in made else pa.nulls(n_rows, f.type)
                                           for f in GATHERED], schema=GATHERED)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read() -> Iterator[tuple]:
            for batch in parts:
                ids = zip(*(batch.column(i).to_pylist() for i in range(3)))
                for (r, d, h), w in zip(ids, map(word_list, common.texts(batch))):
                    yield r, d, h, symbols(w)

        for group in chunks(read(), GROUP):
            grp = group[0][0]
            for held in chunks(iter(group)):
                some = b"".join(x[-1] for x in held)
                yield rows(DOC, grp, 1, row_ids=[[x[0] for x in held]], doc_ids=[[x[1] for x in held]],
                           size=[len(some)], symbols=[pa.compress(some, "zstd", asbytes=True)])
            key, n = string_counts([(x[2], x[-1]) for x in group])
            cell = cell_of(key)
            order = np.argsort(cell, kind="stable")
            key, n, cell = key[order], n[order], cell[order]
            cut = np.flatnonzero(np.diff(cell, prepend=-1))
            ends = [*cut[1:].tolist(), len(key)]
            spans = list(zip(cut.tolist(), ends))
            yield rows(STRINGS, grp, len(cut), cell=cell[cut], size=[b - a for a, b in spans],
                       key=[packed(key[a:b]) for a, b in spans], n=[squeezed(n[a:b]) for a, b in spans])
            learned = [x[-1] for x in group if not x[2]]
            if learned:
                words, times = word_counts(learned)
                yield rows(WORDS, grp, 1, words=[np.append(words, END)], times=[np.append(times, len(learned))])
            pa.default_memory_pool().release_unused()

    made = common.doc_columns(docs).select(F.monotonically_increasing_id().alias("row_id"), "doc_id",
                                           held_out().alias("held_out"), "text")
    return common.written(made.mapInArrow(
        run, "kind int, grp long, row_ids array<long>, doc_ids array<long>, symbols binary, cell int, size int, key binary, n binary, "
             "words array<long>, times array<long>"), "gathered")


def added(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct strings of packed rows, ascending, and the sums of their counts."""
    found, held = [], 0
    for size, key, n in zip(*(rows.column(c).to_pylist() for c in ("size", "key", "n"))):
        found.append((unpacked(key, size), restored(n, size)))
        held += size
        if held > FOLD:
            found, held = [summed(*(np.concatenate(x) for x in zip(*found)))], 0
    return summed(*(np.concatenate(x) for x in zip(*found)))


def bucketed(made: DataFrame) -> tuple[DataFrame, int, int]:
    """(bucket, grp, key, n of the strings, number of buckets, number of groups).
    Buckets are as many as the strings' bytes ask for, up to one a cell."""
    rows = made.filter(F.col("kind") == STRINGS)
    size, groups = rows.agg(F.coalesce(F.sum(F.length("key") + F.length("n")), F.lit(0)), F.count_distinct("grp")).first()
    buckets = int(min(CELLS, max(1, -(-size // BUCKET))))
    return (rows.select(F.pmod("cell", F.lit(buckets)).cast("int").alias("bucket"), "grp", "size", "key", "n"), buckets,
            groups)


def _shard(groups: int):
    return F.pmod(F.xxhash64("grp"), F.lit(max(1, -(-groups // FAN)))).cast("int").alias("shard")


def parts_of(strings_: DataFrame, groups: int) -> DataFrame:
    """One row a bucket: its distinct strings, their counts, and the sums for the
    nodes above.  Strings of about FAN groups are added up in a task, then those
    sums, and so on, so a task's input doesn't grow with the number of groups."""
    def row(schema: pa.Schema, *values) -> pa.Table:
        return pa.table([pa.array([x], f.type) for x, f in zip(values, schema)], schema=schema)

    def merge(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        k, n = added(rows)
        return row(MERGED, key[0].as_py(), len(k), packed(k), squeezed(n))

    def part(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        k, n = added(rows)
        return row(PART, key[0].as_py(), len(k), packed(k), squeezed(n), *summed(*weigh(nodes_of(k, n, TOP), TOP)[1]))

    rows, shard = strings_, _shard(groups)
    while groups > FAN:
        rows = common.written(rows.groupBy("bucket", shard).applyInArrow(merge, "bucket int, size int, key binary, n binary"), "string-sums")
        groups = -(-groups // FAN)
        rows = rows.withColumn("grp", F.monotonically_increasing_id())
        shard = _shard(groups)
    return common.written(rows.groupBy("bucket").applyInArrow(
        part, "bucket int, size int, key binary, n binary, top array<long>, n0 array<long>, n1 array<long>, "
              "total array<double>"), "string-parts")


def top_model(parts: DataFrame) -> bytes:
    """The model of the depths above TOP (at most 255 * 256 ** (TOP - 1) nodes each)."""
    each = parts.select(F.inline(F.arrays_zip(F.col("top").alias("key"), "n0", "n1", "total")))
    # added up in one order, so that scores don't change from run to run
    rows = (each.groupBy("key").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"),
                                    F.sort_array(F.collect_list("total")).alias("total"))
            .select("key", "n0", "n1", F.aggregate("total", F.lit(0.0), lambda a, x: a + x).alias("total"))
            .orderBy("key").toArrow())
    key, n0, n1, total = (c.to_numpy() for c in rows.columns)
    levels = [(key, n0, n1)]
    for d in range(TOP - 1, 0, -1):
        levels.append(summed(parent(levels[-1][0], d), *levels[-1][1:]))
    return Model(weigh(levels[::-1], 0, (key, n0, n1, total))[0]).to_bytes()


def string_logs(parts: DataFrame, strings_: DataFrame, groups: int) -> DataFrame:
    """(grp, keys, log10 probabilities) of the strings of each group and bucket.

    A bucket's strings are scored once; the scores meet the groups that ask for
    them FAN groups at a time."""
    shared = parts.sparkSession.sparkContext.broadcast(top_model(parts))

    def score_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = Model.from_bytes(shared.value).levels
        for batch in batches:
            for bucket, size, key, n in zip(*(c.to_pylist() for c in batch.columns)):
                k, n = unpacked(key, size), restored(n, size)
                logs = Model(top + weigh(nodes_of(k, n, TOP), TOP)[0]).bits(k)
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((bucket, key, logs.tobytes()), LOGS)],
                                                 schema=LOGS)

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return FOUND.empty_table()
        logs = np.frombuffer(known.column("log")[0].as_py(), np.float64)
        key = unpacked(known.column("key")[0].as_py(), len(logs))
        out = []
        for grp, size, k in zip(*(asked.column(c).to_pylist() for c in ("grp", "size", "key"))):
            out.append((grp, k, logs[np.searchsorted(key, unpacked(k, size))].tobytes()))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), FOUND)], schema=FOUND)

    shards = max(1, -(-groups // FAN))
    logs = (parts.select("bucket", "size", "key", "n").mapInArrow(score_all, "bucket int, key binary, log binary")
            .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    asked = strings_.drop("n").withColumn("shard", _shard(groups))
    return (asked.groupBy("bucket", "shard").cogroup(logs.groupBy("bucket", "shard"))
            .applyInArrow(answer, "grp long, key binary, log binary"))


def together(found: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A group's strings, ascending, and their log10 probabilities, from its rows
    of FOUND: filled and sorted in place, a row of them unpacked at a time."""
    n = (pc.sum(pc.binary_length(found.column("log"))).as_py() or 0) // 8
    key, log, at = np.empty(n, np.uint64), np.empty(n), 0
    for k, x in zip(found.column("key"), found.column("log")):
        part = np.frombuffer(x.as_buffer(), np.float64)
        end = at + len(part)
        key[at:end], log[at:end], at = unpacked(k.as_buffer(), len(part)), part, end
    log = log[np.argsort(key)]
    key.sort()
    return key, log


def scored(held: list[tuple], scores: np.ndarray, keys: np.ndarray, logs: np.ndarray) -> pa.RecordBatch:
    """Rows of documents (row_id, doc_id, word list) with these scores; keys and
    logs of the broadcast words."""
    known, known_score, light, light_n = [], [], [], []
    for _, _, w in held:
        h, n = np.unique(np.concatenate([hashes(w), [END]]), return_counts=True)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            has = keys[at] == h
            known.append(int(n[has].sum()))
            known_score.append(float(n[has] @ logs[at[has]]))
        else:
            has = np.zeros(len(h), bool)
            known.append(0)
            known_score.append(0.0)
        light.append(h[~has])
        light_n.append(n[~has].astype(np.int32))
    cut = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in light])]).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in held], pa.int64()), pa.array([x[1] for x in held], pa.int64()),
         pa.array([len(x[2]) + 1 for x in held], pa.int64()), pa.array(known, pa.int64()),
         pa.array(known_score, pa.float64()), pa.array(scores),
         pa.ListArray.from_arrays(cut, pa.array(np.concatenate(light))),
         pa.ListArray.from_arrays(cut, pa.array(np.concatenate(light_n)))], schema=SCORED)


_SCORED = ("row_id long, doc_id long, n_tokens long, heavy_known long, heavy_score double, score double, "
           "light array<long>, light_n array<int>")


def scored_by_tree(made: DataFrame, heavy) -> DataFrame:
    """Rows of the documents in ``made`` (see ``gathered``), by the whole tree."""
    strings_, _, groups = bucketed(made)
    logs = string_logs(parts_of(strings_, groups), strings_, groups)
    docs = made.filter(F.col("kind") == DOC).select("grp", "row_ids", "doc_ids", "size", "symbols")

    def run(group: pa.Table, found: pa.Table) -> pa.Table:
        key, log = together(found)
        out = []
        for some in group.drop_columns("grp").to_batches(max_chunksize=1):
            row_ids, doc_ids, size, blob = (c[0] for c in some.columns)
            docs_ = pa.decompress(blob.as_buffer(), size.as_py(), "zstd", asbytes=True).split(_END_BYTE)[:-1]
            held = [(r, d, x + _END_BYTE) for r, d, x in zip(row_ids.as_py(), doc_ids.as_py(), docs_)]
            want, start = strings([x[-1] for x in held])
            distinct, back = np.unique(want, return_inverse=True)
            scores = np.add.reduceat(log[np.searchsorted(key, distinct)][back], start)
            out.append(scored([(r, d, words_in(x)) for r, d, x in held], scores, *heavy.value))
        pa.default_memory_pool().release_unused()
        return pa.Table.from_batches(out, SCORED)

    return docs.groupBy("grp").cogroup(logs.groupBy("grp")).applyInArrow(run, _SCORED)


def score(docs: DataFrame, heavy_words: int = HEAVY) -> DataFrame:
    made = gathered(docs)
    words = common.written(
        made.filter(F.col("kind") == WORDS)
        .select(F.inline(F.arrays_zip(F.col("words").alias("key"), F.col("times").alias("n"))))
        .groupBy("key").agg(F.sum("n").alias("n")), "word-counts")
    n_train, n_distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("n")).first()
    base = n_train + n_distinct + 1
    is_heavy = F.col("n") * heavy_words >= n_train
    frequent = words.filter(is_heavy).orderBy("key").toArrow()
    heavy = docs.sparkSession.sparkContext.broadcast((
        frequent.column("key").to_numpy(), np.log10((frequent.column("n").to_numpy() + 1) / base)))
    rows = common.written(scored_by_tree(made, heavy), "scored")
    light = rows.select("row_id", F.inline(F.arrays_zip(F.col("light").alias("key"), F.col("light_n").alias("times"))))
    n = F.coalesce("n", F.lit(0))
    summed_ = (light.join(words.filter(~is_heavy), "key", "left").groupBy("row_id")
               .agg(F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("known"),
                    F.sum(F.col("times") * F.log10((n + 1) / F.lit(float(base)))).alias("base")))
    return (rows.drop("light", "light_n").join(summed_, "row_id", "left")
            .select("doc_id", held_out().alias("held_out"), "n_tokens",
                    (F.col("heavy_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
                    F.lit(n_train).cast("long").alias("train_tokens"),
                    (F.col("heavy_score") + F.coalesce("base", F.lit(0.0))).alias("base_score"), "score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(common.read(spark, sf_dir, "documents"))
