"""Language ID: a bidirectional gated recurrent network over bytes.

The UTF-8 bytes of a whole text are cut into windows of ``WINDOW`` bytes.  Two
recurrent layers of ``UNITS`` gated units read each window, one forwards and
one backwards:

    z, r = sigmoid(W[byte] + U h)     n = tanh(W[byte] + r (U h + b))     h' = (1 - z) n + z h

A softmax over both layers' states labels every position with probabilities of
the learned languages.  The probabilities at positions of letters (ASCII
letters and bytes from 0x80 on) are averaged over the whole document; the
language with the largest average is predicted, and the average is its score.

Learning: Spark picks at most ``PER_LANG`` documents a language and ``SAMPLE``
in all (the smallest hashes of their rows, the languages in turn, among those
that may be learned from), and at most ``VIEWS`` windows of ``VIEW`` bytes of
each, spread evenly over the text.  One task fits the network to these few bytes by
backpropagation through time (Adam, fixed seed): position by position, every
letter of a window has the document's language as its label.  The model has a
fixed size but for one output row a language, so it is broadcast to label all
texts without a shuffle.

Nulls, ties, emptiness: ``und`` with score 0 for a null text, a text without a
letter (Unicode category L), or where nothing could be learned; a null doc_id
stays null (its remainder is the empty text's); repeated rows each give their
row; equal averages go to the language first in code-point order; an empty
table gives no rows; other columns are ignored.  Texts of any length are read
whole, ``SLICE`` bytes at a time.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parity.llm import common

UNITS = 8
#: Bytes of a window.
WINDOW = 128
#: Documents that the network is fitted to: a language, and in all; windows of each, and their bytes.
PER_LANG = 800
SAMPLE = 20_000
SPARE = 4
VIEWS = 4
VIEW = 64
#: Steps of learning, and windows of a step.
STEPS = 400
BATCH = 256
RATE = 0.01
#: Windows that go through the network side by side, and bytes of text taken at a time.
SIDE = 3072
SLICE = 1 << 20
UNKNOWN = "und"

_BYTES = np.arange(256)
_ASCII_LETTER = ((_BYTES | 0x20) >= ord("a")) & ((_BYTES | 0x20) <= ord("z")) & (_BYTES >= ord("A")) & (_BYTES < 0x80)
_COUNTS = _ASCII_LETTER | (_BYTES >= 0x80)

LABELLED = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


class Network:
    """Weights: w (2, 256, 3 units), u (2, 3 units, units), b (2, units), v
    (languages, 2 units), c (languages); gates in the order z, r, n."""

    PARTS = ("w", "u", "b", "v", "c")

    def __init__(self, langs: list[str], units: int = UNITS, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.langs, self.units = langs, units
        self.w = rng.normal(0, 0.3, (2, 256, 3 * units)).astype(np.float32)
        self.u = rng.normal(0, units ** -0.5, (2, 3 * units, units)).astype(np.float32)
        self.b = np.zeros((2, units), np.float32)
        self.v = rng.normal(0, 0.1, (len(langs), 2 * units)).astype(np.float32)
        self.c = np.zeros(len(langs), np.float32)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, langs=np.frombuffer(json.dumps(self.langs).encode(), np.uint8),
                 **{p: getattr(self, p) for p in self.PARTS})
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> "Network":
        got = np.load(io.BytesIO(data))
        net = Network(json.loads(got["langs"].tobytes()), got["u"].shape[2])
        for p in Network.PARTS:
            setattr(net, p, got[p])
        return net

    # -- labelling ----------------------------------------------------------
    def _states(self, way: int, x: np.ndarray) -> np.ndarray:
        """States (steps, units, windows) of one layer over bytes (steps, windows)."""
        k = self.units
        half = np.ones(3 * k, np.float32)
        half[:2 * k] = 0.5                     # sigmoid(a) = (1 + tanh(a / 2)) / 2
        w = np.ascontiguousarray((self.w[way] * half).T)
        u, b = self.u[way] * half[:, None], self.b[way][:, None]
        h = np.zeros((k, x.shape[1]), np.float32)
        out = np.empty((len(x), k, x.shape[1]), np.float32)
        for t in range(len(x)):
            a = w.take(x[t], axis=1)
            g = u @ h
            gates, n = g[:2 * k], g[2 * k:]
            gates += a[:2 * k]
            np.tanh(gates, out=gates)
            gates += 1
            gates *= 0.5
            n += b
            n *= gates[k:]
            n += a[2 * k:]
            np.tanh(n, out=n)
            h -= n
            h *= gates[:k]
            h += n
            out[t] = h
        return out

    def labels(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities (steps, languages, windows) of every position of the
        windows of ``data``, and the bytes (steps, windows); positions past a
        window's length hold no meaning."""
        t = np.arange(int(length.max()))[:, None]
        back = np.maximum(length - 1 - t, 0)
        x = data[np.minimum(start + t, len(data) - 1)]
        k = self.units
        fore = np.matmul(self.v[:, :k], self._states(0, x))
        rear = np.matmul(self.v[:, k:], self._states(1, data[start + back]))
        fore += rear[::-1] if length.min() == len(t) else np.take_along_axis(rear, back[:, None, :], 0)
        fore += self.c[:, None]
        fore -= fore.max(axis=1, keepdims=True)
        np.exp(fore, out=fore)
        fore /= fore.sum(axis=1, keepdims=True)
        return fore, x

    def pooled(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Mean probabilities (documents, languages) at letters of documents
        that begin and end at ``bounds``; 0 where there are none."""
        n_docs = len(bounds) - 1
        windows = -(-np.diff(bounds) // WINDOW)
        doc = np.repeat(np.arange(n_docs), windows)
        start = bounds[doc] + WINDOW * (np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows))
        length = np.minimum(WINDOW, bounds[doc + 1] - start)
        order = np.argsort(-length, kind="stable")
        sums, letters = np.zeros((n_docs, len(self.langs))), np.zeros(n_docs)
        side = max(64, SIDE * 16 // max(16, len(self.langs)))
        for at in range(0, len(order), side):
            some = order[at:at + side]
            p, x = self.labels(data, start[some], length[some])
            counts = (_COUNTS[x] & (np.arange(len(x))[:, None] < length[some])).astype(np.float32)
            found = np.einsum("tlb,tb->bl", p, counts)
            letters += np.bincount(doc[some], counts.sum(axis=0), n_docs)
            for i in range(len(self.langs)):
                sums[:, i] += np.bincount(doc[some], found[:, i], n_docs)
        return sums / np.maximum(letters, 1)[:, None]

    # -- learning -----------------------------------------------------------
    def _forward(self, way: int, x: np.ndarray) -> tuple:
        k, steps = self.units, len(x)
        a = self.w[way][x].transpose(0, 2, 1)
        h = np.zeros((steps + 1, k, x.shape[1]), np.float32)
        gates, n, un = (np.empty((steps, m, x.shape[1]), np.float32) for m in (2 * k, k, k))
        for t in range(steps):
            g = self.u[way] @ h[t]
            gates[t] = 1 / (1 + np.exp(-(a[t, :2 * k] + g[:2 * k])))
            un[t] = g[2 * k:] + self.b[way][:, None]
            n[t] = np.tanh(a[t, 2 * k:] + gates[t, k:] * un[t])
            h[t + 1] = n[t] + gates[t, :k] * (h[t] - n[t])
        return h, gates, n, un

    def _backward(self, way: int, x: np.ndarray, run: tuple, dh_out: np.ndarray) -> dict:
        """Gradients of w, u, b from those of the states."""
        k = self.units
        h, gates, n, un = run
        da, du = np.empty((len(x), 3 * k, x.shape[1]), np.float32), np.zeros_like(self.u[way])
        db, dh = np.zeros(k, np.float32), np.zeros_like(h[0])
        for t in range(len(x) - 1, -1, -1):
            dh = dh + dh_out[t]
            z, r = gates[t, :k], gates[t, k:]
            dn = dh * (1 - z) * (1 - n[t] * n[t])
            g = np.concatenate([dh * (h[t] - n[t]) * z * (1 - z), dn * un[t] * r * (1 - r), dn * r])
            du += g @ h[t].T
            db += g[2 * k:].sum(axis=1)
            da[t] = g
            da[t, 2 * k:] = dn
            dh = dh * z + self.u[way].T @ g
        order = np.argsort(x, axis=None, kind="stable")
        bytes_, at = np.unique(x.ravel()[order], return_index=True)
        dw = np.zeros_like(self.w[way])
        dw[bytes_] = np.add.reduceat(da.transpose(0, 2, 1).reshape(-1, 3 * k)[order], at, axis=0)
        return {"w": dw, "u": du, "b": db}

    def gradients(self, x: np.ndarray, length: np.ndarray, label: np.ndarray) -> tuple[float, dict]:
        """Mean cross-entropy at the letters of windows (steps, windows), and its gradients."""
        k, t = self.units, np.arange(len(x))[:, None]
        back = np.maximum(length - 1 - t, 0)
        xs = (x, np.take_along_axis(x, back, 0))
        runs = [self._forward(way, xs[way]) for way in (0, 1)]
        rear = np.take_along_axis(runs[1][0][1:], back[:, None, :], 0)
        states = np.concatenate([runs[0][0][1:], rear], axis=1)
        raw = np.matmul(self.v, states) + self.c[:, None]
        raw -= raw.max(axis=1, keepdims=True)
        p = np.exp(raw)
        p /= p.sum(axis=1, keepdims=True)
        weight = (_COUNTS[x] & (t < length)).astype(np.float32)
        weight /= max(weight.sum(), 1)
        loss = -float((np.log(np.take_along_axis(p, label[None, None, :], 1)[:, 0] + 1e-9) * weight).sum())
        d = p * weight[:, None, :]
        d[:, label, np.arange(len(label))] -= weight
        ds = np.matmul(self.v.T, d)
        # the backward layer's step back[t] gave position t; steps past a window's length get nothing
        dr = np.zeros_like(ds[:, k:])
        np.put_along_axis(dr, back[:, None, :], np.where((t < length)[:, None, :], ds[:, k:], 0), 0)
        first = np.take_along_axis(ds[:, k:], (length - 1)[None, None, :], 0)   # position length - 1 is its step 0
        dr[0] = first[0]
        parts = [self._backward(0, xs[0], runs[0], ds[:, :k]), self._backward(1, xs[1], runs[1], dr)]
        grads = {name: np.stack([q[name] for q in parts]) for name in ("w", "u", "b")}
        grads["v"] = np.einsum("tlb,tkb->lk", d, states)
        grads["c"] = d.sum(axis=(0, 2))
        return loss, grads


def fit(rows: list[tuple[str, bytes]], units: int = UNITS, steps: int = STEPS, seed: int = 5) -> Network:
    """The network of (language, window) rows; every language is drawn equally often."""
    net = Network(sorted({lang for lang, _ in rows}), units, seed)
    if len(net.langs) < 2:
        return net
    by_lang = [[b for a, b in rows if a == lang] for lang in net.langs]
    rng = np.random.default_rng(seed)
    slow = {p: (np.zeros_like(getattr(net, p)), np.zeros_like(getattr(net, p))) for p in net.PARTS}
    for step in range(1, steps + 1):
        label = rng.integers(0, len(by_lang), BATCH)
        chosen = [by_lang[i][rng.integers(len(by_lang[i]))] for i in label.tolist()]
        length = np.array([len(b) for b in chosen])
        x = np.zeros((int(length.max()), BATCH), np.uint8)
        for i, b in enumerate(chosen):
            x[:len(b), i] = np.frombuffer(b, np.uint8)
        _, grads = net.gradients(x, length, label)
        size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = RATE * min(1.0, 2.0 * (1 - (step - 1) / steps)) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
        for p in net.PARTS:
            g = grads[p] * min(1.0, 1.0 / max(size, 1e-12))
            m, s = slow[p]
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            getattr(net, p)[...] -= rate * m / (np.sqrt(s) + 1e-8)
    return net


# ------------------------------------------------------------------ Spark --

def sample_of(docs: DataFrame, per_lang: int, sample: int, view: int, views: int) -> DataFrame:
    """lang and windows of the documents to learn from.  A language with more
    than ``SPARE`` times the documents needed is first thinned by their hashes
    to about that many, so no task ranks more, however large the corpus."""
    docs = docs.filter("lang IS NOT NULL AND length(text) > 0").withColumn("lang", F.col("lang").cast("string"))
    sizes = (docs.groupBy("lang").agg(F.count(F.lit(1)).alias("in_lang"))
             .orderBy(F.desc("in_lang"), "lang").limit(sample))   # more languages than documents can't be learned
    n = f"least({views}, CAST(ceil(length(bytes) / {view}) AS INT))"
    spread = F.expr(f"transform(sequence(0, {n} - 1), i -> substring(bytes, 1 + CAST(i * greatest(0, length(bytes) - {view}) "
                    f"div greatest(1, {n} - 1) AS INT), {view}))")
    rows = (docs.select("lang", F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("h"),
                        F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").cast("binary").alias("bytes"))
            .join(F.broadcast(sizes), "lang")   # at most ``sample`` rows
            .filter(F.pmod("h", F.lit(1 << 30)) * F.col("in_lang").cast("double") < F.lit(float(SPARE * per_lang << 30)))
            .select("lang", "h", "doc_id", spread.alias("windows")))
    in_lang = Window.partitionBy("lang").orderBy("h", "doc_id", "windows")
    return (rows.withColumn("rank", F.row_number().over(in_lang)).filter(F.col("rank") <= per_lang)
            .orderBy("rank", "lang").limit(sample).select("lang", "windows"))


def train(docs: DataFrame, per_lang: int = PER_LANG, sample: int = SAMPLE, view: int = VIEW,
          views: int = VIEWS) -> DataFrame:
    """One row: the network as bytes.  ``docs`` holds the rows to learn from."""

    def fitted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted((lang, b) for batch in parts
                       for lang, some in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for b in some
                       if _COUNTS[np.frombuffer(b, np.uint8)].any())
        yield pa.RecordBatch.from_arrays([pa.array([fit(found).to_bytes()], pa.binary())], names=["model"])

    return sample_of(docs, per_lang, sample, view, views).repartition(1).mapInArrow(fitted, "model binary")


def _has_letter(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    some = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
    out = some[bounds[1:]] > some[bounds[:-1]]
    for i in np.flatnonzero(~out & (np.diff(bounds) > 0)).tolist():
        text = data[bounds[i]:bounds[i + 1]].tobytes().decode("utf-8", "replace")
        out[i] = any(c.isalpha() for c in text)
    return out


def _label(net: Network, data: np.ndarray, bounds: np.ndarray) -> tuple[list[str], list[float]]:
    """Languages and scores of the documents that begin and end at ``bounds``."""
    if not net.langs:
        return [UNKNOWN] * (len(bounds) - 1), [0.0] * (len(bounds) - 1)
    mean = net.pooled(data, bounds)
    best = mean.argmax(axis=1)
    known = _has_letter(data, bounds)
    return ([net.langs[i] if k else UNKNOWN for i, k in zip(best.tolist(), known.tolist())],
            np.where(known, np.clip(mean[np.arange(len(best)), best], 0, 1), 0.0).tolist())


def _pieces(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about SLICE bytes, a longer row by itself."""
    ends = np.cumsum(lengths)
    at = 0
    while at < len(lengths):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, "right")))
        yield at, to
        at = to


def predict(docs: DataFrame, model: DataFrame) -> DataFrame:
    """doc_id, lang_pred, score of each document."""
    row = model.first()   # none where Spark saw that there is nothing to learn from
    shared = docs.sparkSession.sparkContext.broadcast(bytes(row[0]) if row else Network([]).to_bytes())

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network.from_bytes(shared.value)
        for batch in parts:
            text = batch.column(1).cast(pa.large_binary())
            bounds = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, 8 * text.offset) if len(text) else np.zeros(1, int)
            data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
            langs, scores = [], []
            for a, b in _pieces(np.diff(bounds)):
                some = _label(net, data[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a])
                langs += some[0]
                scores += some[1]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64())], schema=LABELLED)

    return common.doc_columns(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def learnable(docs: DataFrame) -> DataFrame:
    """Rows that may be learned from: crc32(doc_id as text) mod 5 isn't 0."""
    return docs.filter(common.crc_remainder(5) != 0)


def classify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    return predict(docs, train(learnable(docs))).select(
        "doc_id", (common.crc_remainder(5) == 0).alias("held_out"), "lang_pred", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(common.read(spark, sf_dir, "documents"))
