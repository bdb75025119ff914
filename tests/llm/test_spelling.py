"""Spelling variants against all pairs in plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

import data
from parity.llm import op13_spelling as S


def apart_by_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute(some, min_count=5, times=5):
    n = Counter()
    for doc_id, text, *_ in some:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    words = {w: k for w, k in n.items() if len(w) >= 6 and k >= min_count}
    near = {w: [v for v in words if apart_by_one(w, v)] for w in words}
    form = {}
    for w, some_near in near.items():
        best = min(some_near, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return sorted(out)


def corpus(seed=4, letters="abcéÿ", n_words=120, longest=14):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice(letters) for _ in range(rnd.randint(6, longest))) for _ in range(n_words)]
    for w in vocabulary[:]:
        for _ in range(rnd.randint(0, 5)):
            i = rnd.randrange(len(w) + 1)
            w = rnd.choice((w[:i] + rnd.choice(letters) + w[i:], w[:i] + w[i + 1:], w[:i] + rnd.choice(letters) + w[i + 1:]))
            vocabulary.append(w)
    vocabulary += ["a" * k for k in range(5, 13)] + ["x" * 300, "x" * 301, "x" * 150 + "y" + "x" * 150, "naïveté", "Ýnaïvet", "÷×÷×÷×"]
    some = data.rows()
    for i in range(150):
        text = " ".join(w if rnd.random() < .8 else w[0].upper() + w[1:]
                        for w in rnd.choices(vocabulary, [1 / (1 + k % 40) ** 2 for k in range(len(vocabulary))], k=90))
        some.append((i if i % 20 else None, text, "en", "s", 1))
    some.append((5000, "qrstuvwx " * 5 + "qrstuvw " * 30 + "qrstuv " * 200, "en", "s", 1))   # forms in a row
    return some + some[-30:]


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("seed,letters,shard", [(4, "abcéÿ", S.SHARD), (5, "ab", 7), (6, "abcdefghijklmnopqrstuvwxyzàéèü", 40)])
def test_variants_are_those_of_all_pairs(spark, seed, letters, shard):
    some = corpus(seed, letters)
    want = brute(some)
    assert len({w for w, f, *_ in want if f}) > 1 and any(f and f != r for _, f, r, *_ in want)
    assert got(S.variants(data.docs(spark, some), shard=shard)) == want


def test_columns_empty_table_and_no_words(spark):
    df = S.variants(data.empty(spark))
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    assert df.count() == 0
    assert S.variants(data.docs(spark, [(1, "short ones only", "en", "s", 1), (2, None, None, None, None)])).count() == 0


def test_index_finds_every_pair_with_either_half():
    rnd = random.Random(9)
    for letters, side in (("ab", 4096), ("abcdefg", 5), ("a", 2), ("àÿz", 4096)):
        words = sorted({"".join(rnd.choice(letters) for _ in range(rnd.randint(2, 9))) for _ in range(150)})
        queries = sorted(set(words) | {"".join(rnd.choice(letters + "q") for _ in range(rnd.randint(2, 9))) for _ in range(60)})
        old, S.SIDE = S.SIDE, side
        try:
            index = S.Index(words)
            found = set()
            for left in (True, False):
                q, hit = index.near(queries, left)
                pairs = {(queries[a], words[b]) for a, b in zip(q.tolist(), hit.tolist())}
                want = set()
                for a in queries:
                    half = a[:len(a) // 2] if left else a[len(a) // 2:]
                    for b in words:
                        rest = (a[len(half):], b[len(half):]) if left else (a[:len(a) - len(half)], b[:len(b) - len(half)])
                        if (b.startswith(half) if left else b.endswith(half)) and apart_by_one(*rest):
                            want.add((a, b))
                assert pairs == want
                found |= pairs
        finally:
            S.SIDE = old
        assert found == {(a, b) for a in queries for b in words if apart_by_one(a, b)}


def test_forms_that_follow_one_another(spark):
    base = "abcdefgh"
    chain = [base + "zzzzz"[:k] for k in range(5)]
    rows = [(w, 5 * 5 ** k) for k, w in enumerate(chain)]
    found = spark.createDataFrame([(w, n, None if i + 1 == len(rows) else rows[i + 1][0]) for i, (w, n) in enumerate(rows)],
                                  "word string, n long, form string")
    assert {tuple(r) for r in S.roots(found).select("word", "root").collect()} == {(w, chain[-1]) for w in chain[:-1]}


def test_counts_handed_on_early(monkeypatch):
    import pyarrow as pa
    some = corpus(7)
    batch = pa.RecordBatch.from_pydict({"doc_id": [r[0] for r in some], "text": [r[1] for r in some]})

    def counts():
        total = Counter()
        for b in S._count(iter([batch.slice(0, 70), batch.slice(70)])):
            for w, n in zip(*(c.to_pylist() for c in b.columns)):
                total[w] += n
        return total

    want = counts()
    monkeypatch.setattr(S, "TABLE", 10)
    monkeypatch.setattr(S, "LONG_TEXT", 50)
    assert counts() == want
