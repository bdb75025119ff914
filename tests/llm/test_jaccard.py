"""N-gram Jaccard join against comparing all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import data
from parity.llm import op03_jaccard_join as J


def grams(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return set()
    return {tuple(w)} if len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def linked(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 80 * len(a | b)


def brute(some):
    """(doc_id, size, component) of each row, in order."""
    sets = [grams(t) if d is not None else set() for d, t, *_ in some]
    parent = list(range(len(some)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(some)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    least = {}
    for i, (d, *_) in enumerate(some):
        if sets[i]:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(grams(t)), least[find(i)] if sets[i] else d) for i, (d, t, *_) in enumerate(some)]


def variants(seed, n_groups=12, most=9):
    """Groups of copies, each changed at a few words, around the threshold."""
    rnd = random.Random(seed)
    out, d = [], 0
    for g in range(n_groups):
        words = [f"g{g}w{rnd.randrange(500)}" for _ in range(rnd.choice([4, 6, 12, 30, 80, 300]))]
        for _ in range(rnd.randint(1, most)):
            copy = list(words)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, len(copy) // 25])):
                at = rnd.randrange(len(copy))
                copy[at:at + rnd.choice([0, 1])] = [f"new{rnd.randrange(9)}"] * rnd.choice([0, 1, 2])
                if not copy:
                    copy = ["x"]
            out.append((d, " ".join(copy), "en", "s", 1))
            d += rnd.randint(1, 3)
    rnd.shuffle(out)
    return out


def same(got, some):
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(brute(some))


def test_components(spark):
    same(J.components(data.docs(spark)).collect(), data.rows())


@pytest.mark.parametrize("seed", [1, 2])
def test_components_around_the_threshold(spark, seed):
    same(J.components(data.docs(spark, variants(seed))).collect(), variants(seed))


@pytest.mark.parametrize("block", [40, 400])
def test_large_blocks_in_chunks(spark, block):
    """The way that blocks take which no single task may hold."""
    some = variants(3, 4, 14)
    same(J.components(data.docs(spark, some), block).collect(), some)


def pages(n, seed=5):
    """Unlinked pages of sentences from one pool and words of their own, and a
    near copy of each tenth."""
    rnd = random.Random(seed)
    pool = [" ".join(f"p{rnd.randrange(3000)}" for _ in range(12)) for _ in range(40)]
    out = []
    for i in range(n):
        words = " ".join(rnd.sample(pool, 6)).split() + [f"own{i}x{k}" for k in range(40)]
        out.append((2 * i, " ".join(words), "en", "s", 1))
        if i % 10 == 0:
            out.append((2 * i + 1, " ".join(words[:50] + ["changed"] + words[51:]), "en", "s", 1))
    return out


def test_pages_from_one_pool_are_not_all_compared(spark, monkeypatch):
    """Passages that unlinked pages share make one block of them; what the
    search is sent must stay in proportion to the pages."""
    some, sent, search = pages(400), [], J.search
    monkeypatch.setattr(J, "search", lambda rows: (sent.append(rows.count()), search(rows))[1])
    same(J.components(data.docs(spark, some), 4000).collect(), some)
    assert sum(sent) <= len(some)


def test_keep_one_of_pages_from_one_pool(spark, monkeypatch):
    """The pipeline's stage: the near copies go, and no more texts are sent than there are."""
    some, sent, search = pages(150, 6), [], J.search
    monkeypatch.setattr(J, "search", lambda rows: (sent.append(rows.count()), search(rows))[1])
    out = J.keep_one(data.docs(spark, some), 3000).collect()
    assert Counter(r.doc_id for r in out) == left_of(some) == Counter(range(0, 300, 2))
    assert sum(sent) <= len(some)


def test_chains_are_one_component(spark):
    words = [f"w{i}" for i in range(100)]
    some = [(50 - i, " ".join(words[4 * i:] + [f"t{k}" for k in range(4 * i)]), "en", "s", 1) for i in range(12)]
    same(J.components(data.docs(spark, some)).collect(), some)
    assert {r.component_id for r in J.components(data.docs(spark, some)).collect()} == {39}


def test_nothing_and_no_links(spark):
    assert J.components(data.empty(spark)).count() == 0 and J.keep_one(data.empty(spark)).count() == 0
    some = [(i, f"text number {i} has words of its own {i * 7}", "en", "s", 1) for i in range(9)]
    same(J.components(data.docs(spark, some)).collect(), some)


def left_of(some):
    """How many documents stay under each id: one of each component, and all that link with nothing."""
    sets = [grams(t) if d is not None else set() for d, t, *_ in some]
    ids, groups = [d for d, *_ in some], []
    for i, s in enumerate(sets):
        joined = [g for g in groups if s and any(linked(s, sets[j]) for j in g)]
        groups = [g for g in groups if g not in joined] + [sum(joined, [i])]
    return Counter(min(ids[i] for i in g) if len(g) > 1 else ids[g[0]] for g in groups)


def test_keep_one(spark):
    text = " ".join(f"same{i}" for i in range(30))
    some = data.rows() + [(5000, text, "en", str(i), i) for i in range(40)] + [(5000, text + " more", "en", "s", 1),
                                                                           (5000, "other words " + text[::-1], "en", "s", 1),
                                                                           (5001, text, "en", "s", 1), (4999, "", "en", "a", 1),
                                                                           (4999, "", "en", "b", 1)]
    df = data.docs(spark, some)
    for c in ("_id", "_hash", "id", "hash", "row", "gone_id", "again", "place", "label", "a.b"):
        df = df.withColumn(c, F.lit(c))
    out = J.keep_one(df)
    assert out.schema == df.schema
    rows = out.collect()
    assert Counter(r.doc_id for r in rows) == left_of(some)
    assert sum(r.doc_id == 5000 for r in rows) == 2       # the copies' component, and a text of its own
    assert all(r["_id"] == "_id" and r["a.b"] == "a.b" for r in rows)


# ----------------------------------------------------------------- pieces --

sets_ = st.lists(st.lists(st.integers(0, 40), min_size=1, max_size=30, unique=True), min_size=1, max_size=14)


def arrays(lists):
    return [np.sort(J.mix(np.array(x, np.uint64))) for x in lists]


def pairs(sets):
    s = [set(x.tolist()) for x in sets]
    return {(i, j) for i in range(len(s)) for j in range(len(s)) if i != j and linked(s[i], s[j])}


@settings(max_examples=200, deadline=None)
@given(sets_)
def test_divide_skip_finds_every_link(lists):
    sets = arrays(lists)
    index = J.Lists(sets)
    for i, s in enumerate(sets):
        wanted = np.arange(len(sets)) != i
        want = {j for a, j in pairs(sets) if a == i}
        assert set(J.divide_skip(s, index, wanted)) == set(J.divide_skip(s, index, wanted, inside=True)) == want


@settings(max_examples=200, deadline=None)
@given(sets_)
def test_block_links_connect_the_components(lists):
    sets = arrays(lists)

    def parts(edges):
        label = list(range(len(sets)))
        for _ in sets:
            for a, b in edges:
                label[a] = label[b] = min(label[a], label[b])
        return label

    links = J.block_links(sets)
    assert set(links) <= pairs(sets) and parts(links) == parts(pairs(sets))


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10 ** 6), st.floats(0, 0.25))
def test_linked_sets_show_a_common_slice(n, seed, change):
    rnd = random.Random(seed)
    a = {rnd.randrange(2 ** 63) for _ in range(n)}
    b = set(a)
    for _ in range(int(change * n)):
        kind = rnd.random()
        if kind < .6 and len(b) > 1:
            b.discard(rnd.choice(sorted(b)))
        if kind > .3:
            b.add(rnd.randrange(2 ** 63))
    if linked(a, b):
        x, y = (np.sort(J.mix(np.array(sorted(s), np.uint64))) for s in (a, b))
        assert set(J.slices(x).tolist()) & set(J.slices(y).tolist())


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 700), st.integers(0, 10 ** 6), st.floats(0, 0.3))
def test_sketches_rule_out_no_link(n, seed, change):
    rnd = random.Random(seed)
    a = {rnd.randrange(2 ** 63) for _ in range(n)}
    b = {x for x in a if rnd.random() > change / 2} | {rnd.randrange(2 ** 63) for _ in range(int(change * n / 2))}
    x, y = (np.sort(J.mix(np.array(sorted(s), np.uint64))) for s in (a, b))
    p, q = J.sketch(x), J.sketch(y)
    w = min(len(p), len(q))
    near = bool(J.may_link(len(x), J.folded(p, w), np.array([len(y)]), J.folded(q, w)[None, :])[0]) if b else False
    assert near or not linked(a, b)
    if b:
        found = J.sketch_links(np.array([len(x), len(y)]), [p, q], np.arange(2))
        assert bool(found) == near and (not found or J.sketch_links(np.array([len(x), len(y)]), [p, q], np.zeros(2)) == [])


def test_sketch_links_connect_all_that_may_link():
    rnd = random.Random(8)
    base = [[rnd.randrange(2 ** 63) for _ in range(n)] for n in (5, 60, 80, 85, 90, 170, 180, 700)]
    sets = [np.sort(J.mix(np.array(sorted(set(x[rnd.randrange(4):] + [rnd.randrange(2 ** 63) for _ in range(rnd.randrange(9))])),
                                   np.uint64))) for x in base for _ in range(12)]
    rnd.shuffle(sets)
    label = list(range(len(sets)))
    for i, j in J.sketch_links(np.array([len(s) for s in sets]), [J.sketch(s) for s in sets], np.arange(len(sets))):
        label = [label[i] if k == label[j] else k for k in label]
    assert all(label[i] == label[j] for i, j in pairs(sets)) and len(set(label)) >= len(base) - 1


def test_a_slice_is_compared_over_all_batches():
    """Classes that meet in a batch, and those that meet only later, are all known of a slice."""
    def u(*x):
        return np.array(x, np.uint64) << np.uint64(1)
    one = J._stars(u(7, 7, 9, 5), np.array([3, 4, 4, 8]), False)
    two = J._stars(u(7, 9, 5), np.array([5, 6, 9]), False)
    end = J._stars(np.concatenate([one[0], two[0]]), np.concatenate([one[1], two[1]]), True)
    known = {tuple(x) for part in (one, two, end) for x in zip(part[4].tolist(), part[5].tolist())}
    assert known == {(7, 3), (7, 4), (7, 5)}
    edges = {tuple(x) for part in (one, two, end) for x in zip(part[2].tolist(), part[3].tolist())}
    assert edges == {(3, 4), (3, 5), (4, 6), (8, 9)}


def test_difference_bound_of_the_schemes():
    for a in range(1, 600):
        for b in range(a, 5 * a // 4 + 1):
            common = {s for s, _ in J.schemes(a)} & {s for s, _ in J.schemes(b)}
            most = a + b - 2 * J.needed(a, b)
            assert any(d >= most for s, d in J.schemes(a) if s in common), (a, b)


def test_connected_components(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    edges = [(min(e), max(e)) for e in edges if e[0] != e[1]]
    label = {x: x for e in edges for x in e}
    for _ in range(60):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.label for r in J.connected(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == label
    assert J.connected(spark.createDataFrame([], "a long, b long"), "t").count() == 0
