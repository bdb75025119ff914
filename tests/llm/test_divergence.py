"""Source divergence against plain Python, and its numpy parts against bytes."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import data
from parity.llm import op11_divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(some, min_docs, top=D.TOP_TERMS):
    group, docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, _ in some:
        lang, source, found = lang or "", source or "", terms(text)
        group[lang, source].update(found)
        docs[lang].update(set(found))
        langs[lang].update(found)
    out = []
    for (lang, source), counts in group.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v = len(kept)

        def share(c, term):
            return 1 + 10**9 * (c[term] + 2) // (sum(c[t] for t in kept) + 2 * v)

        def apart(a, b):
            return (a - b) ** 2 // (a + b)
        pairs = [(-sum(apart(share(counts, t), share(o, t)) for t in kept), other.encode("utf-8"), other)
                 for (al, other), o in group.items() if al == lang and other != source]
        over = [(-apart(share(counts, t), share(langs[lang], t)), t.encode("utf-8"), t) for t in kept
                if counts[t] > 0 and share(counts, t) > share(langs[lang], t)]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(over)[:top])):
            out += [(lang, source, part, item, -f, i) for i, (f, _, item) in enumerate(found, 1)]
    return sorted(out)


def corpus(seed=5):
    rnd = random.Random(seed)
    words = (["a", "Bc", "élan", "straße", "中文字", "x" * 8, "y" * 9, "z" * 16, "w" * 17, "w" * 16 + "é", "Ö" * 60, "😀", "KK"]
             + [f"{c}{d}ing" for c in "abcdef" for d in "lmnopq"])
    some = data.rows()
    for i in range(120):
        n = rnd.choice((0, 3, 30, 60))
        text = "".join(rnd.choice(words[:rnd.choice((5, len(words)))]) + rnd.choice((" ", "\n", "1", "_", ".[")) for _ in range(n))
        some.append((i, text, rnd.choice(("en", "de", "", None)), f"s{rnd.randint(0, 8)}" if rnd.random() < .9 else None, n))
    return some + [(1, "lone words only", "xx", "é", 1), (2, "", "xx", "z", 1), (3, None, "xx", "日", 1)]


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("block,tile", [(D.BLOCK, D.TILE), (7, 2)])
def test_divergence_is_that_of_plain_python(spark, block, tile):
    some = corpus()
    for min_docs in (3, 10):
        assert got(D.divergence(data.docs(spark, some), min_docs, block=block, tile=tile)) == brute(some, min_docs)


def test_columns_and_empty_table(spark):
    df = D.divergence(data.empty(spark))
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    assert df.count() == 0


def test_folding_and_flushing_change_nothing(monkeypatch):
    import pyarrow as pa
    some = corpus(8)
    batch = pa.RecordBatch.from_pydict({"lang": [r[2] or "" for r in some], "source": [r[3] or "" for r in some],
                                        "text": [r[1] or "" for r in some]})

    def counts():
        total = Counter()
        for b in D._count(iter([batch.slice(0, 50), batch.slice(50, 0), batch.slice(50)])):
            for lang, source, term, n, docs in zip(*(c.to_pylist() for c in b.columns)):
                total[lang, source, term, "n"] += n
                total[lang, source, term, "docs"] += docs
        return total

    want = Counter()
    for _, text, lang, source, _ in some:
        for t, n in Counter(terms(text)).items():
            want[lang or "", source or "", t, "n"] += n
            want[lang or "", source or "", t, "docs"] += 1
    assert counts() == want
    monkeypatch.setattr(D, "SLICE", 200)
    for fold, fold_bytes in ((20, 1 << 20), (1 << 20, 100)):
        monkeypatch.setattr(D, "FOLD", fold)
        monkeypatch.setattr(D, "FOLD_BYTES", fold_bytes)
        assert counts() == want


def test_radix_order_is_byte_order():
    rnd = random.Random(2)
    found = [bytes(rnd.choice(b"ab\xff\xc3z") for _ in range(rnd.randint(1, 16))) for _ in range(3000)]
    flat = np.frombuffer(b"".join(found), np.uint8)
    length = np.array([len(x) for x in found])
    start = np.cumsum(length) - length
    keys = D.packed(flat, start, length)
    order = D.radix_order(keys, np.arange(len(found)))
    assert [found[i] for i in order] == sorted(found)
    assert order.tolist() == sorted(range(len(found)), key=lambda i: found[i])  # stable


def test_shares_beyond_bigint(spark):
    row = spark.range(1).selectExpr("9000000000000L AS n", "9100000000000L AS t", "3L AS v").select(
        D._share("n", "t", "v")).first()
    assert row[0] == 1 + 10**9 * (9000000000000 + 2) // (9100000000000 + 6)
