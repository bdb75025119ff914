"""The byte network against a plain one, its gradients against differences,
and its predictions on held-out rows."""

import random
import zlib
from math import exp, tanh

import numpy as np
import pytest

import data
from conftest_paths import SF
from parity.llm import op12_language as L


def plain_labels(net, text):
    """Probabilities at each byte of a window, one number at a time."""
    k = net.units

    def layer(way, bytes_):
        h, out = [0.0] * k, []
        for byte in bytes_:
            a = [float(x) for x in net.w[way][byte]]
            g = [sum(float(net.u[way][i][j]) * h[j] for j in range(k)) for i in range(3 * k)]
            z, r = ([1 / (1 + exp(-(a[o + i] + g[o + i]))) for i in range(k)] for o in (0, k))
            n = [tanh(a[2 * k + i] + r[i] * (g[2 * k + i] + float(net.b[way][i]))) for i in range(k)]
            h = [(1 - z[i]) * n[i] + z[i] * h[i] for i in range(k)]
            out.append(h)
        return out

    fore, rear = layer(0, text), layer(1, text[::-1])[::-1]
    rows = []
    for f, b in zip(fore, rear):
        raw = [exp(float(net.c[i]) + sum(float(net.v[i][j]) * x for j, x in enumerate([*f, *b]))) for i in range(len(net.langs))]
        rows.append([x / sum(raw) for x in raw])
    return rows


def plain_pool(net, text):
    total, n = [0.0] * len(net.langs), 0
    for at in range(0, len(text), L.WINDOW):
        window = text[at:at + L.WINDOW]
        for byte, row in zip(window, plain_labels(net, window)):
            if byte >= 0x80 or chr(byte).isalpha():
                total, n = [a + b for a, b in zip(total, row)], n + 1
    return [x / max(n, 1) for x in total]


def network(langs=("de", "en", "fr"), units=5):
    net = L.Network(list(langs), units, seed=3)
    rng = np.random.default_rng(1)
    net.b += rng.normal(0, 0.3, net.b.shape).astype(np.float32)
    net.c += rng.normal(0, 0.3, net.c.shape).astype(np.float32)
    return net


def test_pooled_probabilities_are_those_of_a_plain_network(monkeypatch):
    net = L.Network.from_bytes(network().to_bytes())
    texts = ["", "Ünder", "12 3", "a" * 128, "two words, " * 30, "日本語 text", "x" * 129, "."]
    flat = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(b) for b in flat])])
    for side in (3072, 2):
        monkeypatch.setattr(L, "SIDE", side)
        got = net.pooled(np.frombuffer(b"".join(flat), np.uint8), bounds)
        for row, b in zip(got, flat):
            assert row == pytest.approx(plain_pool(net, b), abs=2e-5)


def test_gradients_are_those_of_differences():
    net = network(units=3)
    for p in net.PARTS:
        setattr(net, p, getattr(net, p).astype(np.float64))
    rnd = random.Random(4)
    windows = [bytes(rnd.choice(b"ab .\xc3\xa9") for _ in range(n)) for n in (9, 5, 1, 9)]
    length, x = np.array([len(w) for w in windows]), np.zeros((9, 4), np.uint8)
    for i, w in enumerate(windows):
        x[:len(w), i] = np.frombuffer(w, np.uint8)
    label = np.array([0, 2, 1, 1])
    _, grads = net.gradients(x, length, label)
    for p in net.PARTS:
        values = getattr(net, p)
        places = [i for i in np.ndindex(values.shape) if p != "w" or i[1] in (ord("a"), 0xC3)]
        for i in rnd.sample(places, min(12, len(places))):
            old, step = values[i], 1e-2
            values[i] = old + step
            up = net.gradients(x, length, label)[0]
            values[i] = old - step
            down = net.gradients(x, length, label)[0]
            values[i] = old
            assert grads[p][i] == pytest.approx((up - down) / (2 * step), abs=2e-3), (p, i)


def test_held_out_documents(spark):
    df = L.classify(spark.read.parquet(f"{SF}/sf0.01/documents.parquet"))
    rows = {r.doc_id: r for r in df.collect()}
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/sf0.01/documents.parquet").collect()}
    held = [d for d in rows if zlib.crc32(str(d).encode()) % 5 == 0]
    assert set(held) == {d for d, r in rows.items() if r.held_out}
    right = [rows[d].lang_pred == truth[d] for d in held if truth[d]]
    assert sum(right) >= 0.97 * len(right)
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_odd_rows(spark):
    rnd = random.Random(6)
    some = data.rows()
    for i in range(200):
        words = ("the", "river", "of", "stone") if i % 2 else ("über", "straße", "der", "und")
        some.append((1000 + i, " ".join(rnd.choice(words) for _ in range(20)), "xx" if i % 2 else "yy", "s", 1))
    some += [(1900, "1234 &&& ...", "xx", "s", 1), (1901, "— … ", "xx", "s", 1), (1902, "中", None, "s", 1), (1903, "Ⅷ", "yy", "s", 1)]
    df = L.classify(data.docs(spark, some))
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    got = sorted(map(tuple, df.collect()), key=repr)
    assert len(got) == len(some)
    by_id = {r[0]: r for r in got if r[0] is not None and r[0] >= 1000}
    learned = {r[2] for r in some if r[2] and r[1] and zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 5}
    for doc_id, text, lang, *_ in some:
        if doc_id is not None and doc_id >= 1000:
            known = any(c.isalpha() for c in text)
            assert by_id[doc_id][2] in learned if known else by_id[doc_id][2:] == ("und", 0.0)
    assert sum(by_id[d][2] == lang for d, _, lang, *_ in some if d is not None and 1000 <= d < 1900) >= 190
    assert got == sorted(map(tuple, L.classify(data.docs(spark, some, partitions=5)).collect()), key=repr)


def test_nothing_to_learn_from(spark):
    assert L.classify(data.empty(spark)).count() == 0
    rows = [(i, t, None, None, None) for i, t in enumerate(["some words", None, ""])]
    assert {tuple(r) for r in L.classify(data.docs(spark, rows)).select("lang_pred", "score").collect()} == {("und", 0.0)}


def test_sample_is_bounded_and_fair(spark):
    some = [(i, f"word{i} " * 50, "aa" if i % 10 else "bb", "s", 1) for i in range(400)] + [(7, "again " * 40, "aa", "s", 1)] * 300
    chosen = L.sample_of(data.docs(spark, some), per_lang=30, sample=50, view=64, views=3).collect()
    assert len(chosen) == 50 and sorted(r.lang for r in chosen) == ["aa"] * 25 + ["bb"] * 25
    assert all(len(r.windows) == 3 and max(map(len, r.windows)) <= 64 for r in chosen)
    text = {r[1].encode() for r in some}
    for r in chosen:   # the first window begins the text, the last one ends it
        assert any(t.startswith(bytes(r.windows[0])) and t.endswith(bytes(r.windows[-1])) for t in text)
