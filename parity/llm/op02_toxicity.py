"""Toxicity: a factorization machine over hashed terms.

A text's terms are its words (lower case, punctuation stripped) and their
beginnings of 4, 5 and 6 characters, each hashed to one of ``BUCKETS``
numbers.  A term's value is log(1 + occurrences).  The machine scores

    w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

so that a pair of terms (an insult and the mention of a group) has a weight of
its own, which linear weights can't give it.  The score is the logistic
function of that, with w0 shifted after training so that 0.7 is the threshold
with the best F0.5 on the sample.

Learning: a sample of labelled documents, bounded by ``SAMPLE`` (the smallest
hashes of doc_id among the rows that may be learned from), is hashed by Spark
and fitted in one task.  Every term number in at least ``MIN_DOCS`` documents of
the sample takes part, whether or not it says anything alone.  Values are
divided by their root mean square, so that the noise in every weight's gradient
has one scale, and the penalties are multiples of it: an absolute-value penalty
on weights, a group penalty on the length of each term's factors, which leave
a term out unless what it adds, alone or in pairs, stands out of that noise.
The minimum is sought by accelerated proximal gradient steps, first of the
linear weights, then, from there, with factors; of every run the step with the
least loss on a fifth of the sample (the others are learned from) counts, and
among the penalties and beginnings tried the run with the least.  The model is
the terms with a weight or a factor, at most as many as the sample has distinct
ones; it is broadcast to score all texts, whole, without a shuffle.  A sampled
document sends at most ``MAX_TERMS`` terms (those that come first in a scrambled
order of the numbers), and rows under one doc_id send one, so the task's input
is bounded in bytes as well.

Nulls, ties, emptiness: a null or empty text has no terms and scores w0; a
null doc_id stays null (its remainder is the empty text's); repeated label
rows for a document count as one with the larger label, null labels as none;
repeated documents each give their row; an empty table gives no rows; with no
labels to learn from, or no term associated with them, every score is 0.5 and nothing is predicted toxic; other
columns are ignored by ``score`` and kept by ``keep_clean``.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parity.llm import common

BUCKETS = 1 << 18
FACTORS = 4
#: Documents of the sample that a term is in, at least.
MIN_DOCS = 4
#: Labelled documents that the model is fitted on, at most, and terms of each that it learns from.
SAMPLE = 4000
MAX_TERMS = 8192
#: Penalties on weights, in units of the gradient's noise.
WEIGHT_PENALTIES = (0.35, 0.7)
#: (penalty on factors, size that a document's factor sums begin with).
FACTOR_RUNS = ((0.1, 0.6), (0.5, 3.0))
STEPS = 100
#: Steps without a better loss on held-back rows that end a run.
PATIENCE = 12
THRESHOLD = 0.7
PREFIXES = (4, 5, 6)
#: Words whose term numbers a worker keeps before it begins anew.
MAX_WORDS = 400_000

_STRIP = ".,;:!?\"'()[]{}<>*#"

SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def terms_of(word: str, buckets: int = BUCKETS) -> list[int]:
    """Term numbers of a word and its beginnings."""
    w = word.strip(_STRIP)
    terms = [w] if w else []
    terms += ["^" + w[:n] for n in PREFIXES if len(w) > n]
    return [zlib.crc32(t.encode("utf-8", "surrogatepass")) % buckets for t in terms]


class Terms:
    """Term numbers and values of texts; of ``kept`` terms their places in it."""

    def __init__(self, kept: np.ndarray | None = None) -> None:
        self.place = None if kept is None else {b: i for i, b in enumerate(kept.tolist())}
        self.known: dict[str, list[int]] = {}

    def _of(self, word: str) -> list[int]:
        found = terms_of(word)
        if self.place is not None:
            found = [self.place[b] for b in found if b in self.place]
        self.known[word] = found
        return found

    def values(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(distinct term numbers ascending, their values) of a whole text."""
        if len(self.known) > MAX_WORDS:
            self.known.clear()
        known, total = self.known, {}
        for w, n in Counter(text.lower().split()).items():
            for t in known[w] if w in known else self._of(w):
                total[t] = total.get(t, 0) + n
        ids = np.array(sorted(total), np.int64)
        return ids, np.log1p(np.array([total[t] for t in ids.tolist()], np.float64))


class FactorizationMachine:
    """Weights and factors of the terms ``kept``."""

    def __init__(self, w0: float, kept: np.ndarray, w: np.ndarray, v: np.ndarray) -> None:
        self.w0, self.kept, self.w, self.v = w0, kept, w, v

    def raw(self, ids: np.ndarray, x: np.ndarray) -> float:
        xv = self.v[ids] * x[:, None]
        s = xv.sum(axis=0)
        return float(self.w0 + self.w[ids] @ x + 0.5 * (s @ s - (xv * xv).sum()))

    def score(self, ids: np.ndarray, x: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.raw(ids, x), -30, 30))))

    def to_bytes(self) -> bytes:
        head = np.array([len(self.kept), self.v.shape[1]], "<i8").tobytes()
        return head + np.float64(self.w0).tobytes() + b"".join(
            np.ascontiguousarray(a, "<f8").tobytes() for a in (self.kept, self.w, self.v))

    @staticmethod
    def from_bytes(data: bytes) -> "FactorizationMachine":
        n, k = np.frombuffer(data, "<i8", 2).tolist()
        a = np.frombuffer(data, "<f8", offset=16)
        return FactorizationMachine(float(a[0]), a[1:1 + n].astype(np.int64), a[1 + n:1 + 2 * n],
                                    a[1 + 2 * n:].reshape(n, k))


#: Entries that sums are formed over at a time, about.
ENTRIES = 1 << 18


def _blocks(sizes: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(first, end, first entry, end of entries) of consecutive groups of
    entries, ENTRIES together or a larger one alone."""
    ends = np.cumsum(sizes)
    out, at = [], 0
    while at < len(sizes):
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + ENTRIES, "right")))
        out.append((at, to, before, int(ends[to - 1])))
        at = to
    return out


class Samples:
    """Labelled rows of (term places, values) as flat arrays, documents with terms first."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> None:
        rows = sorted(rows, key=lambda r: not len(r[0]))
        self.size = np.array([len(ids) for ids, *_ in rows], np.int64)
        self.some = int((self.size > 0).sum())
        self.ids = np.concatenate([np.empty(0, np.int32), *(ids for ids, *_ in rows)]).astype(np.int32, copy=False)
        self.x = np.concatenate([np.empty(0, np.float32), *(x for _, x, _ in rows)]).astype(np.float32, copy=False)
        self.y = np.array([y for *_, y in rows], np.int64)
        self.blocks = _blocks(self.size[:self.some])
        self.begin = np.cumsum(self.size) - self.size
        share = np.clip(self.y.mean() if len(rows) else .5, 1e-9, 1 - 1e-9)
        self.weight = np.where(self.y == 1, .5 / share, .5 / (1 - share)) / max(len(rows), 1)   # classes weigh the same


class Objective:
    """Mean logistic loss of a machine of ``n`` terms and ``k`` factors over
    rows, and its gradient.  The machine is one vector: w0, w, v."""

    def __init__(self, rows: Samples, n: int, k: int) -> None:
        self.rows, self.n, self.k = rows, n, k
        order = np.argsort(rows.ids, kind="stable")
        self.doc = np.repeat(np.arange(len(rows.size), dtype=np.int32), rows.size)[order]
        self.x = rows.x[order]
        self.term, count = np.unique(rows.ids, return_counts=True)
        self.begin = np.cumsum(count) - count
        self.blocks = _blocks(count)

    def parts(self, z: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        return z[0], z[1:1 + self.n], z[1 + self.n:].reshape(self.n, self.k)

    def raw(self, z: np.ndarray, rows: Samples) -> tuple[np.ndarray, np.ndarray]:
        """Raw scores of rows, and their factor sums."""
        w0, w, v = self.parts(z)
        w, v = w.astype(np.float32), v.astype(np.float32)
        length = (v * v).sum(axis=1)
        out, s = np.full(len(rows.size), float(w0)), np.zeros((len(rows.size), self.k), np.float32)
        for lo, hi, a, b in rows.blocks:
            ids, x, at = rows.ids[a:b], rows.x[a:b], rows.begin[lo:hi] - a
            out[lo:hi] += np.add.reduceat(w[ids] * x, at)
            if self.k:
                s[lo:hi] = np.add.reduceat(v[ids] * x[:, None], at, axis=0)
                out[lo:hi] += 0.5 * ((s[lo:hi] * s[lo:hi]).sum(axis=1) - np.add.reduceat(length[ids] * x * x, at))
        return out, s

    def loss(self, z: np.ndarray, rows: Samples | None = None) -> float:
        rows = rows or self.rows
        raw, _ = self.raw(z, rows)
        return float((rows.weight * np.logaddexp(0, np.where(rows.y == 1, -raw, raw))).sum())

    def gradient(self, z: np.ndarray) -> tuple[float, np.ndarray]:
        rows, out = self.rows, np.zeros(len(z))
        raw, s = self.raw(z, rows)
        turned = np.where(rows.y == 1, -raw, raw)
        d = rows.weight * np.where(rows.y == 1, -1, 1) / (1 + np.exp(-np.clip(turned, -40, 40)))
        out[0] = d.sum()
        _, w, v = self.parts(out)
        held = self.parts(z)[2]
        d = d.astype(np.float32)
        for lo, hi, a, b in self.blocks:
            term, doc, x, at = self.term[lo:hi], self.doc[a:b], self.x[a:b], self.begin[lo:hi] - a
            dx = d[doc] * x
            w[term] = np.add.reduceat(dx, at)
            if self.k:
                own = np.add.reduceat(dx * x, at)[:, None] * held[term]
                v[term] = np.add.reduceat(dx[:, None] * s[doc], at, axis=0) - own
        return float((rows.weight * np.logaddexp(0, turned)).sum()), out

    def noise(self) -> float:
        """Scale of the largest entry of a gradient that is noise alone."""
        return float(np.sqrt((self.rows.weight ** 2).sum() * 0.25 * 2 * np.log(max(self.n, 2))))

    def shrunk(self, z: np.ndarray, lw: float, lv: float) -> np.ndarray:
        """The penalties' proximal step."""
        z = z.copy()
        _, w, v = self.parts(z)
        w[:] = np.sign(w) * np.maximum(np.abs(w) - lw, 0)
        length = np.sqrt((v * v).sum(axis=1))
        v *= np.maximum(1 - lv / np.maximum(length, 1e-12), 0)[:, None]
        return z


def descend(f: Objective, z: np.ndarray, lw: float, lv: float, held: Samples, steps: int = STEPS) -> tuple[float, np.ndarray]:
    """(least loss on the held-back rows, the machine there) of accelerated
    proximal gradient steps with backtracking and restarts."""
    best, best_z, since = f.loss(z, held), z, 0
    ahead, curve, t = z, 1.0, 1.0
    for _ in range(steps):
        at, g = f.gradient(ahead)
        while True:
            new = f.shrunk(ahead - g / curve, lw / curve, lv / curve)
            move = new - ahead
            if f.loss(new) <= at + g @ move + 0.5 * curve * (move @ move) + 1e-6 or curve > 1e8:
                break
            curve *= 2
        if (ahead - new) @ (new - z) > 0:       # momentum points uphill
            ahead, t = new.copy(), 1.0
        else:
            t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
            ahead = new + (last - 1) / t * (new - z)
        z, curve, since = new, 0.9 * curve, since + 1
        loss = f.loss(z, held)
        if loss < best - 1e-4:
            best, best_z, since = loss, z, 0
        elif since >= PATIENCE:
            break
    return best, best_z


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], factors: int = FACTORS, seed: int = 7) -> FactorizationMachine:
    """The machine of labelled rows (term numbers, values, label)."""
    n_toxic = sum(y for *_, y in rows)
    none = FactorizationMachine(0.0, np.empty(0, np.int64), np.empty(0), np.empty((0, factors)))
    if not 0 < n_toxic < len(rows):
        return none
    kept, seen = np.unique(np.concatenate([np.empty(0, np.int64), *(ids for ids, *_ in rows)]), return_counts=True)
    kept = kept[seen >= MIN_DOCS]
    local, squares = [], np.zeros(len(kept))
    for ids, x, y in rows:
        place = np.searchsorted(kept, ids)
        has = kept[np.minimum(place, max(len(kept) - 1, 0))] == ids if len(kept) else np.zeros(len(ids), bool)
        local.append((place[has].astype(np.int32), x[has].astype(np.float32), y))
        squares[place[has]] += x[has] ** 2
    scale = np.sqrt(squares / len(rows))
    for at, x, _ in local:
        x /= scale[at]
    rng = np.random.default_rng(seed)
    held = np.zeros(len(rows), bool)
    for label in (0, 1):                        # a fifth of either class is held back
        mine = rng.permutation([i for i, (*_, y) in enumerate(local) if y == label])
        held[mine[:len(mine) // 5].astype(int)] = True
    learn = Samples([r for r, h in zip(local, held) if not h])
    back = Samples([r for r, h in zip(local, held) if h]) if held.any() else learn
    n, width = len(kept), max(1.0, float(np.mean([len(i) for i, *_ in local])))
    del local
    linear, full = Objective(learn, n, 0), Objective(learn, n, factors)
    unit = linear.noise()
    runs = [(*descend(linear, np.zeros(1 + n), p * unit, 0.0, back), p) for p in WEIGHT_PENALTIES]
    loss, start, penalty = min(runs, key=lambda r: r[0])
    z = np.concatenate([start, np.zeros(n * factors)])
    for p, size in FACTOR_RUNS:
        v = rng.normal(0, size / np.sqrt(width), (n, factors)) * scale[:, None]
        other, other_z = descend(full, np.concatenate([start, v.ravel()]), penalty * unit, p * unit, back)
        if other < loss:
            loss, z = other, other_z
    w0, w, v = full.parts(z)
    some = (w != 0) | (v != 0).any(axis=1)
    fm = FactorizationMachine(float(w0), kept[some], w[some] / scale[some], v[some] / scale[some, None])
    raws, labels = zip(*((full.raw(z, some)[0], some.y) for some in ((learn, back) if back is not learn else (learn,))))
    fm.w0 += np.log(THRESHOLD / (1 - THRESHOLD)) - _cut(np.concatenate(raws).tolist(), np.concatenate(labels).tolist())
    return fm


def _cut(raw: list[float], labels: list[int]) -> float:
    """The raw value that separates the labels with the best F0.5 (a clean
    document taken away costs more than a toxic one left): the middle of the
    gap between the last one taken and the next."""
    if not 0 < sum(labels) < len(labels):
        return 0.0
    order = np.argsort(-np.asarray(raw), kind="stable")
    r, y = np.asarray(raw)[order], np.asarray(labels)[order]
    hit = np.cumsum(y)
    f = 1.25 * hit / (np.arange(1, len(y) + 1) + 0.25 * y.sum())
    f[:-1][r[:-1] == r[1:]] = -1  # no cut between equal values
    best = int(np.argmax(f))
    return float(r[best] if best + 1 == len(r) else (r[best] + r[best + 1]) / 2)


# ------------------------------------------------------------------- Spark --

def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row: the model as bytes.  ``labels`` holds the rows to learn from."""
    chosen = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    texts = (common.doc_columns(docs).join(F.broadcast(chosen), "doc_id")  # at most ``sample`` rows
             .groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text")))

    def sent(ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(ids) <= MAX_TERMS:
            return ids, x
        some = np.sort(np.argsort(ids * 40_503 % BUCKETS, kind="stable")[:MAX_TERMS])
        return ids[some], x[some]

    def hashed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in parts:
            made = [sent(*terms.values(t)) for t in common.texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), batch.column(batch.schema.get_field_index("toxic")),
                 pa.array([i.astype("<i4").tobytes() for i, _ in made], pa.binary()),
                 pa.array([x.astype("<f4").tobytes() for _, x in made], pa.binary())],
                names=["doc_id", "toxic", "ids", "x"])

    def fitted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(d, np.frombuffer(i, "<i4"), np.frombuffer(x, "<f4"), y) for b in parts
                for d, y, i, x in zip(*(c.to_pylist() for c in b.columns))]
        rows.sort(key=lambda r: (r[0], r[1].tobytes()))  # the same model whatever order tasks end in
        yield pa.RecordBatch.from_arrays([pa.array([fit([r[1:] for r in rows]).to_bytes()], pa.binary())],
                                         names=["model"])

    return (texts.mapInArrow(hashed, "doc_id long, toxic int, ids binary, x binary")
            .repartition(1).mapInArrow(fitted, "model binary"))


def _scorer(spark: SparkSession, model: DataFrame):
    """A function that makes the scoring function of a task."""
    row = model.first()  # none where Spark saw that there is nothing to learn from
    shared = spark.sparkContext.broadcast(bytes(row[0]) if row else fit([]).to_bytes())

    def make():
        fm = FactorizationMachine.from_bytes(shared.value)
        terms = Terms(fm.kept)
        return lambda text: fm.score(*terms.values(text))

    return make


def score(docs: DataFrame, model: DataFrame) -> DataFrame:
    """doc_id and score of each document."""
    scorer = _scorer(docs.sparkSession, model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = scorer()
        for batch in parts:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([of(t) for t in common.texts(batch)], pa.float64())], schema=SCORED)

    return common.doc_columns(docs).mapInArrow(run, "doc_id long, score double")


def learnable(labels: DataFrame) -> DataFrame:
    """Labels that may be learned from: crc32(doc_id as text) mod 3 isn't 1."""
    return labels.filter(common.crc_remainder(3) != 1)


def classify(docs: DataFrame, labels: DataFrame, train_docs: DataFrame | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    model = train(docs if train_docs is None else train_docs, learnable(labels))
    return score(docs, model).select(
        "doc_id", (common.crc_remainder(3) == 1).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents not predicted toxic, with all their columns."""
    scorer = _scorer(docs.sparkSession, train(docs, learnable(labels)))
    schema = docs.schema

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = scorer()
        for batch in parts:
            yield batch.filter(pa.array([of(t) < THRESHOLD for t in common.texts(batch)], pa.bool_()))

    return docs.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels"))
