"""Toxicity, nearest neighbours and context-tree scores."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest

import data
from conftest_paths import SF
from parity.llm import common, op02_toxicity as T
from parity.llm import op05_nearest as N
from parity.llm import op09_context_tree as C


# ---------------------------------------------------------------- toxicity --

def test_pair_term_of_the_machine():
    rnd = np.random.default_rng(1)
    fm = T.FactorizationMachine(0.3, np.arange(6), rnd.normal(size=6), rnd.normal(size=(6, 3)))
    ids, x = np.array([0, 2, 5]), np.array([1.0, 0.5, 2.0])
    want = 0.3 + sum(fm.w[i] * a for i, a in zip(ids, x))
    want += sum(fm.v[ids[i]] @ fm.v[ids[j]] * x[i] * x[j] for i in range(3) for j in range(i))
    assert math.isclose(fm.raw(ids, x), want)
    again = T.FactorizationMachine.from_bytes(fm.to_bytes())
    assert again.raw(ids, x) == fm.raw(ids, x) and again.kept.tolist() == fm.kept.tolist()


def probe(kind, letters="", n=4200, seed=1):
    """Texts of random words, an insult and one of twenty group words, and labels:
    both of them (``and``), or both or neither (``same``)."""
    rnd = random.Random(seed)

    def word(a, b):
        return "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(a, b)))
    words, groups = [word(4, 9) for _ in range(2000)], [letters + word(7, 7) for _ in range(20)]
    rows = []
    for _ in range(n):
        if kind == "and":
            y = rnd.random() < .215
            insult = y or rnd.random() < .3
            group = y or (not insult and rnd.random() < .5)
        else:
            insult, group = rnd.random() < .5, rnd.random() < .5
            y = insult == group
        text = rnd.choices(words, k=rnd.randint(20, 60)) + ["insultword"] * insult + [rnd.choice(groups)] * group
        rnd.shuffle(text)
        rows.append((*T.Terms().values(" ".join(text)), int(y)))
    return rows


@pytest.mark.parametrize("kind,letters,recall", [("and", "", .9), ("and", "grou", .9), ("same", "", .7)])
def test_pairs_of_words_are_learned(kind, letters, recall):
    """Held-out recall with at most 1 % of the clean ones flagged: terms that say
    little (and ``same``: nothing) alone take part in pairs."""
    rows = probe(kind, letters)
    fm = T.fit(rows[:2800])
    place = {b: i for i, b in enumerate(fm.kept.tolist())}
    hit, wrong, toxic = 0, 0, 0
    for ids, x, y in rows[2800:]:
        has = np.array([b in place for b in ids.tolist()], bool)
        p = fm.score(np.array([place[b] for b in ids[has].tolist()], np.int64), x[has]) >= T.THRESHOLD
        toxic, hit, wrong = toxic + y, hit + (p and y), wrong + (p and not y)
    assert hit >= recall * toxic and wrong <= .01 * (1400 - toxic)
    if kind == "same":
        terms = T.Terms(fm.kept)
        assert np.abs(fm.v).max() > 0
        assert fm.raw(*terms.values("insultword")) < fm.raw(np.empty(0, np.int64), np.empty(0))


def plain_machine(z, rows, n, k):
    """Loss and gradient of a machine by sums over all pairs, one number at a time."""
    w0, w, v = z[0], z[1:1 + n], z[1 + n:].reshape(n, k)
    share = sum(y for *_, y in rows) / len(rows)
    loss, grad = 0.0, np.zeros(len(z))
    for ids, x, y in rows:
        raw = w0 + sum(w[i] * a for i, a in zip(ids, x))
        raw += sum(v[i] @ v[j] * a * b for p, (i, a) in enumerate(zip(ids, x)) for j, b in list(zip(ids, x))[:p])
        c = (.5 / share if y else .5 / (1 - share)) / len(rows)
        loss += c * math.log1p(math.exp(-raw if y else raw))
        d = c * (1 / (1 + math.exp(-raw)) - y)
        grad[0] += d
        for p, (i, a) in enumerate(zip(ids, x)):
            grad[1 + i] += d * a
            grad[1 + n + i * k:1 + n + (i + 1) * k] += d * a * sum((v[j] * b for q, (j, b) in enumerate(zip(ids, x)) if q != p),
                                                                  np.zeros(k))
    return loss, grad


def test_objective_is_that_of_a_plain_machine():
    rnd = np.random.default_rng(4)
    n, k = 7, 3
    rows = []
    for i in range(20):
        ids = np.sort(rnd.choice(n, rnd.integers(0, n), replace=False)).astype(np.int64)
        rows.append((ids, rnd.random(len(ids)) * 2, int(i % 3 == 0)))
    z = rnd.normal(0, .5, 1 + n + n * k)
    loss, grad = T.Objective(T.Samples(rows), n, k).gradient(z)
    want, want_grad = plain_machine(z, rows, n, k)
    assert math.isclose(loss, want, rel_tol=1e-5) and np.allclose(grad, want_grad, atol=1e-5)


def test_a_run_ends_where_plain_steps_end():
    """The minimum that the accelerated steps find against many small plain ones."""
    rnd = np.random.default_rng(6)
    n, k = 6, 2
    rows = []
    for _ in range(60):
        ids = np.sort(rnd.choice(n, 3, replace=False)).astype(np.int64)
        rows.append((ids, np.ones(3), int((0 in ids and 1 in ids) != (rnd.random() < .1))))
    f = T.Objective(T.Samples(rows), n, k)
    z0 = rnd.normal(0, .3, 1 + n + n * k)
    z0[:1 + n] = 0

    def value(z):
        _, w, v = f.parts(z)
        return f.loss(z) + .01 * np.abs(w).sum() + .01 * np.sqrt((v * v).sum(axis=1)).sum()
    z = z0
    for _ in range(4000):
        z = f.shrunk(z - .3 * plain_machine(z, rows, n, k)[1], .003, .003) if _ < 300 else f.shrunk(z - .3 * f.gradient(z)[1], .003, .003)
    seen = []
    old = T.PATIENCE
    T.PATIENCE = 10**6
    try:
        f.loss, real = (lambda q, rows=None: seen.append(q) or real(q, rows)), f.loss
        T.descend(f, z0, .01, .01, f.rows, steps=400)
    finally:
        T.PATIENCE = old
        f.loss = real
    assert min(map(value, seen)) <= value(z) + 1e-3


def test_scores_are_those_of_a_plain_machine(spark):
    """The query's scores against a plain sum over all pairs of a text's terms."""
    docs, labels = (common.read(spark, f"{SF}/sf0.001", t) for t in ("documents", "labels"))
    model = T.FactorizationMachine.from_bytes(bytes(T.train(docs, T.learnable(labels)).first()[0]))
    rnd = np.random.default_rng(3)
    some = np.sort(rnd.choice(T.BUCKETS, 20_000, replace=False))
    for fm in (model, T.FactorizationMachine(-1.0, some, rnd.normal(0, .02, len(some)), rnd.normal(0, .05, (len(some), 3)))):
        frame = spark.createDataFrame([(fm.to_bytes(),)], "model binary")
        place = {b: i for i, b in enumerate(fm.kept.tolist())}
        texts = {r.doc_id: r.text or "" for r in docs.limit(40).collect()}
        for r in T.score(docs.limit(40), frame).collect():
            x = Counter()
            for w in texts[r.doc_id].lower().split():
                for b in T.terms_of(w):
                    x[b] += 1
            terms = [(place[b], math.log1p(c)) for b, c in x.items() if b in place]
            raw = fm.w0 + sum(fm.w[i] * a for i, a in terms)
            if len(terms) < 300:
                raw += sum(fm.v[i] @ fm.v[j] * a * b for p, (i, a) in enumerate(terms) for j, b in terms[:p])
                assert math.isclose(r.score, 1 / (1 + math.exp(-max(-30, min(30, raw)))), rel_tol=1e-6, abs_tol=1e-9)


def test_held_out_accuracy(spark):
    docs, labels = (common.read(spark, f"{SF}/sf0.1", t) for t in ("documents", "labels"))
    got = T.classify(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    hit = sum(r.toxic and r.predicted for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= .7) for r in got)
    assert hit >= 0.9 * sum(r.toxic for r in got)
    assert sum(r.predicted and not r.toxic for r in got) <= 0.01 * sum(not r.toxic for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)


def test_held_out_labels_are_not_learned(spark):
    docs, labels = (common.read(spark, f"{SF}/sf0.01", t) for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1 "
                                                    "THEN 1 - toxic ELSE toxic END AS toxic")
    a, b = ({(r.doc_id, r.score) for r in T.classify(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(d, None, i % 2) for i, (d, *_) in enumerate(data.rows())] + [(9, 1, None), (3, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    df = data.docs(spark)
    got = T.classify(df, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, *_ in data.rows())
    assert all(0 <= r.score <= 1 for r in got)
    none = T.classify(df, labels.limit(0)).collect()
    assert all(r.score == 0.5 and r.predicted == 0 for r in none) and len(none) == len(data.rows())
    kept = T.keep_clean(df, labels.limit(0))
    assert kept.schema == df.schema and kept.count() == df.count()
    assert T.classify(data.empty(spark), labels).count() == 0


# ----------------------------------------------------------------- nearest --

def brute_near(rows, every, k):
    some = [(i, v) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for at, (q, v) in enumerate(some):
        if q % every == 0:
            found = sorted((-N.exact(np.array(v), np.array(u)), c) for other, (c, u) in enumerate(some)
                           if other != at and len(u) == len(v))
            out += [(q, r, c, -s) for r, (s, c) in enumerate(found[:k], 1)]
    return out


@pytest.mark.parametrize("tile,group", [(2048, 8), (7, 2)])
def test_nearest_equals_brute_force(spark, monkeypatch, tile, group):
    monkeypatch.setattr(N, "TILE", tile)
    monkeypatch.setattr(N, "GROUP", group)
    rnd = random.Random(6)
    rows = [(i, [rnd.choice([-1.0, 0.0, 0.5, 1.0, 2.0, 3.5]) for _ in range(6)]) for i in range(90)]
    rows += [(200, None), (201, []), (202, [0.0] * 6), (203, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
             (204, [float("nan")] * 6), (205, [float("inf")] * 6), (None, [1.0] * 6), (10, rows[10][1]), (10, [9.0] * 6),
             (300, [1.0, 2.0]), (301, [2.0, 4.0]), (302, [1e-200, 2e-200]), (310, [1e200] * 6), (400, [5.0] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS score", "2 AS grp")
    v = N.vectors(df)
    got = N.nearest(v.filter("vec_id % 10 = 0"), v).collect()
    want = brute_near(rows, 10, 5)
    assert Counter((r.query_id, r["rank"], r.vec_id, round(r.score, 12)) for r in got) == Counter(
        (q, r, c, round(s, 12)) for q, r, c, s in want)


def test_rows_that_share_an_id(spark):
    """Each row is a query and a candidate; only itself it isn't."""
    import duckdb
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (50, [1.0, 1.0]), (7, [3.0, 1.0]), (7, [1.0, 3.0])]
    v = N.vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = N.nearest(v.filter("vec_id % 50 = 0"), v).select("query_id", "rank", "vec_id", "score").collect()
    assert len(got) == 4 * 5

    def of(found):
        return Counter((q, r, c, round(s, 9)) for q, r, c, s in found)
    assert of(got) == of(brute_near(rows, 50, 5))
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    assert of(got) == of(con.execute(N.SQL).fetchall())


def test_nearest_of_nothing(spark):
    v = N.vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert N.nearest(v, v).count() == 0
    one = N.vectors(spark.createDataFrame([(0, [1.0, 2.0])], "vec_id long, embedding array<float>"))
    assert N.nearest(one, one).count() == 0


def test_codes_bound_the_error():
    rnd = np.random.default_rng(3)
    a, b = (rnd.normal(size=(50, 24)) * rnd.choice([1e-6, 1, 1e5], size=(50, 1)) for _ in range(2))
    tiles = [N.Tile(24, np.arange(50).tobytes(), np.arange(50).tobytes(), x.tobytes()) for x in (a, b)]
    cos, bound = tiles[0].cosines(tiles[1])
    true = (a / np.linalg.norm(a, axis=1, keepdims=True)) @ (b / np.linalg.norm(b, axis=1, keepdims=True)).T
    assert np.abs(cos - true).max() <= bound < 0.1


# ------------------------------------------------------------ context tree --

def test_log_gamma():
    x = np.array([0.5, 1.0, 1.5, 2.0, 10.5, 1e4 + .5, 1e9])
    assert np.allclose(C.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-11, atol=1e-10)


def test_krichevsky_trofimov():
    for bits in ("", "0", "01", "0010110", "1" * 30):
        p, n = 1.0, [0, 0]
        for b in map(int, bits):
            p *= (n[b] + .5) / (sum(n) + 1)
            n[b] += 1
        assert math.isclose(C.kt_log(np.array([n[0]]), np.array([n[1]]))[0], math.log(p), abs_tol=1e-9)


def ctw(sequence, depth, order=None):
    """Bit counts by (context, decision), and the recursive mixture they give."""
    counts = defaultdict(lambda: [0, 0])
    pad = b"\n" * depth
    for doc in sequence:
        data_ = pad + doc
        for i in range(depth, len(data_)):
            for k in range(8):
                node = (1 << k) | (data_[i] >> (8 - k))
                for d in range(depth + 1):
                    counts[data_[i - d:i], node][(data_[i] >> (7 - k)) & 1] += 1

    def kt(n):
        return C.kt_log(np.array([n[0]]), np.array([n[1]]))[0]

    kids = defaultdict(set)
    for c, node in counts:
        if c:
            kids[c[1:], node].add(c)

    @cache
    def weighted(c, node):
        own = kt(counts[c, node])
        if not kids[c, node]:
            return own
        return np.logaddexp(own, sum(weighted(x, node) for x in kids[c, node])) - math.log(2)

    @cache
    def p_one(context, node):
        p = None
        for d in range(depth, -1, -1):
            c = context[len(context) - d:]
            if (c, node) not in counts:
                continue
            n = counts[c, node]
            own = (n[1] + .5) / (sum(n) + 1)
            if not kids[c, node]:
                p = own
            else:
                children = sum(weighted(x, node) for x in kids[c, node])
                w = 1 / (1 + math.exp(min(700, children - kt(n))))
                p = w * own + (1 - w) * (0.5 if p is None else p)
        return 0.5 if p is None else p

    def log10(doc):
        data_, out = pad + doc, 0.0
        for i in range(depth, len(data_)):
            for k in range(8):
                p = p_one(data_[i - depth:i], (1 << k) | (data_[i] >> (8 - k)))
                out += math.log10(p if (data_[i] >> (7 - k)) & 1 else 1 - p)
        return out

    return log10


def score_rows(some):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)) for _, t, *_ in some]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, *_ in some]
    return words, held


def test_scores_equal_a_plain_context_tree(spark):
    some = [r for r in data.rows() if len(r[1] or "") < 400]
    words, held = score_rows(some)
    count = Counter(w for ws, h in zip(words, held) if not h for w in [*ws, "\n"])
    n, v = sum(count.values()), len(count)
    model = ctw([" ".join(w).encode() + b"\n" for w, h in zip(words, held) if not h], C.DEPTH)
    want = []
    for (d, *_), ws, h in zip(some, words, held):
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in [*ws, "\n"])
        want.append((d, h, len(ws) + 1, sum(count[w] > 0 for w in [*ws, "\n"]), n, round(base, 7),
                     round(model(" ".join(ws).encode() + b"\n"), 2)))
    for heavy in (1 << 20, 4, 1):      # every word, some and next to none broadcast
        got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 7), round(r.score, 2))
               for r in C.score(data.docs(spark, some), heavy_words=heavy).collect()]
        assert sorted(got, key=data.key) == sorted(want, key=data.key)


def test_every_node_is_kept(spark):
    """Contexts of one occurrence count in a larger corpus too, however it is dealt."""
    some = [r for r in data.rows() if len(r[1] or "") < 400]
    some += [(1000 + i, f"the river number {i % 9} runs by the old stone mill", "en", "s", 1) for i in range(3500)]
    words, held = score_rows(some)
    docs = [" ".join(w).encode() + b"\n" for w in words]
    train = [d for d, h in zip(docs, held) if not h]
    model = cache(ctw(train, C.DEPTH))
    want = sorted(((r[0], model(d)) for r, d in zip(some, docs)), key=data.key)
    got = sorted(((r.doc_id, r.score) for r in C.score(data.docs(spark, some, 7)).collect()), key=data.key)
    assert [d for d, _ in got] == [d for d, _ in want]
    assert all(math.isclose(a, b, abs_tol=1e-5) for (_, a), (_, b) in zip(got, want))


def test_many_groups_in_a_bucket(spark, monkeypatch):
    """Strings added up over several rounds of groups, buckets of several cells:
    the scores are the same."""
    some = [r for r in data.rows() if len(r[1] or "") < 400]
    some += [(1000 + i, f"mill {i % 7} by the river {i % 4}", "en", "s", 1) for i in range(60)]
    want = sorted(((r.doc_id, round(r.score, 6)) for r in C.score(data.docs(spark, some)).collect()), key=data.key)
    for group, fan, bucket in ((300, 2, 1 << 12), (150, 3, 1), (300, 4, 1 << 30)):
        for name, value in (("GROUP", group), ("FAN", fan), ("BUCKET", bucket), ("CHUNK", 100), ("FOLD", 50)):
            monkeypatch.setattr(C, name, value)
        made = C.gathered(data.docs(spark, some))
        strings_, buckets, groups = C.bucketed(made)
        assert groups > 8 and (buckets == 1 if bucket > 1 << 20 else buckets > 1)
        got = sorted(((r.doc_id, round(r.score, 6)) for r in C.score(data.docs(spark, some)).collect()), key=data.key)
        assert got == want


def test_packed_strings():
    rnd = np.random.default_rng(2)
    for n in (0, 1, 5000):
        key = np.unique(rnd.integers(0, 1 << 48, n).astype(np.uint64))
        assert (C.unpacked(C.packed(key), len(key)) == key).all()
        assert (C.restored(C.squeezed(key.astype(np.int64)), len(key)) == key.astype(np.int64)).all()


def test_tree_is_a_distribution():
    rnd = random.Random(3)
    docs = [bytes(rnd.choice(b"abc ") for _ in range(40)) + b"\n" for _ in range(50)]
    key, n = C.string_counts([(False, d) for d in docs])
    model = C.Model(C.build(C.nodes_of(key, n, 0)))
    for context in (0, 0x0A0A0A0A0A, 0x6161626320, 0x2074686520, 0xFFFFFFFFFF):
        key = (np.uint64(context) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert math.isclose((10 ** model.bits(key)).sum(), 1.0, rel_tol=1e-6)


def test_a_bit_never_seen_after_many_equal_ones_has_a_finite_code():
    n, byte = 1 << 25, ord("a")
    levels = []
    for d in range(C.DEPTH + 1):
        context = int.from_bytes(b"a" * d, "big")
        nodes = [(context << 8 | 1 << i | byte >> (8 - i), byte >> (7 - i) & 1) for i in range(8)]
        levels.append((np.array([k for k, _ in nodes]), *(np.array([n * (b == bit) for _, b in nodes]) for bit in (0, 1))))
    model = C.Model.from_bytes(C.Model(C.build(levels)).to_bytes())
    got = model.bits(np.array([int.from_bytes(b"aaaaa_", "big")], np.uint64))
    # "_" agrees with "a" in two bits, and after the third nothing was counted
    assert math.isclose(got[0], math.log10(.5 / (n + 1)) + 5 * math.log10(.5), rel_tol=1e-6)


def test_scores_of_nothing(spark):
    assert C.score(data.empty(spark)).count() == 0
    only_held = [r for r in [(i, "some text here", "en", "s", 1) for i in range(60)]
                 if zlib.crc32(str(r[0]).encode()) % 7 == 2]
    got = C.score(data.docs(spark, only_held)).collect()
    assert len(got) == len(only_held)
    for r in got:
        assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (4, 0, 0, 0.0)
        assert math.isclose(r.score, 15 * 8 * math.log10(.5))


def test_model_beats_the_base_on_held_out_texts(spark):
    rows = [r for r in C.score(common.read(spark, f"{SF}/sf0.1", "documents")).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_memory_of_added_strings():
    """Sums of sorted parts take a few numbers a string beside the parts; chunks
    are small beside a group."""
    import tracemalloc
    rnd = np.random.default_rng(5)
    parts = [np.unique(rnd.integers(0, 1 << 48, 200_000).astype(np.uint64)) for _ in range(4)]
    key, n = np.concatenate([*parts, parts[0]]), np.arange(sum(map(len, parts)) + len(parts[0]))
    tracemalloc.start()
    got = C.summed(key, n, n / 7)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60 * len(key)
    want, back = np.unique(key, return_inverse=True)
    assert (got[0] == want).all() and got[1].dtype == n.dtype
    assert (got[1] == np.bincount(back, n)).all() and (got[2] == np.bincount(back, n / 7)).all()
    assert [len(x) for x in C.summed(key[:0], n[:0])] == [0, 0]
    assert 60 * C.CHUNK <= C.GROUP


def test_strings_of_a_group_together():
    import pyarrow as pa
    rnd = np.random.default_rng(6)
    key = np.unique(rnd.integers(0, 1 << 48, 5000).astype(np.uint64))
    log, cell = rnd.random(len(key)), C.cell_of(key)
    rows = [(0, C.packed(key[cell == c]), log[cell == c].tobytes()) for c in rnd.permutation(np.unique(cell)).tolist()]
    found = pa.table([pa.array(x, f.type) for x, f in zip(zip(*rows), C.FOUND)], schema=C.FOUND)
    for got in (C.together(found), C.together(pa.concat_tables([found.slice(0, 7), found.slice(7)]))):
        assert (got[0] == key).all() and (got[1] == log).all()
    assert [len(x) for x in C.together(C.FOUND.empty_table())] == [0, 0]
