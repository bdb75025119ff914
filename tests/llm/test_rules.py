"""Quality rules and licence scan against plain Python."""

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

import data
from parity.llm import op01_quality_lines as Q
from parity.llm import op06_licences as L

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = defaultdict(list)
    for i in range(len(w) - 7):
        grams[tuple(w[i:i + 8])].append(i)
    covered = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(8)}
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in Q.SYMBOLS), len(lines) - len(set(lines)), len(covered))


def normal(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", line.translate(str.maketrans(Q._UPPER, Q._LOWER))).strip(" ")


def removed_lines(some, max_docs, max_share, min_docs):
    """(host, normalised line) above the limits -> its first document."""
    docs, hosts, first = Counter(), Counter(), {}
    for d, t, _, h, _ in some:
        h = h or ""
        hosts[h] += 1
        for x in {normal(x) for x in (t or "").split("\n")} - {""}:
            docs[h, x] += 1
            if d is not None:
                first[h, x] = min(first.get((h, x), d), d)
    return {(h, x): first.get((h, x)) for (h, x), n in docs.items()
            if n > max_docs or n >= min_docs and 100 * n > max_share * hosts[h]}


def brute(some, max_docs=Q.MAX_DOCS, max_share=Q.MAX_SHARE, min_docs=Q.MIN_DOCS, min_left=Q.MIN_LEFT):
    above = removed_lines(some, max_docs, max_share, min_docs)
    out = []
    for d, t, _, h, _ in some:
        b = base(t or "")
        gone = sum(len(normal(x).split(" ")) for x in (t or "").split("\n")
                   if (h or "", normal(x)) in above and (d is None or above[h or "", normal(x)] != d))
        failed = b[0] < 20 or 100 * b[4] > 30 * b[0]
        out.append((d, *b, failed, not failed and 100 * (b[0] - gone) >= min_left * b[0], gone))
    return out


def cleaned(some, **limits):
    """The rows that stay, without the removed lines."""
    above = removed_lines(some, limits.get("max_docs", Q.MAX_DOCS), limits.get("max_share", Q.MAX_SHARE),
                          limits.get("min_docs", Q.MIN_DOCS))
    out = []
    for (d, t, lang, h, n), w in zip(some, brute(some, **limits)):
        if w[-2]:
            if w[-1]:
                t = "\n".join(x for x in t.split("\n") if not (
                    (h or "", normal(x)) in above and (d is None or above[h or "", normal(x)] != d)))
                n = len(t)
            out.append((d, t, lang, h, n))
    return out


def corpus():
    foot = "Home About 12 Contact us Terms of Use and so on for ever and ever amen"
    some = data.rows()
    for i in range(30):
        body = " ".join(f"u{i}x{k}" for k in range(3 if i % 2 else 60))
        some.append((1000 + i, f"{body}\n{foot.upper() if i % 3 else foot.replace('12', '99')}\n\n{body}", "en", "big", 1))
    some += [some[-1]] * 3 + [(None, f"solo\n{foot}", "en", "big", 1), (2000, f"{foot}\n{foot}", "en", "other", 1)]
    return some


def test_rules_equal_brute_force(spark):
    for limits in ((5, 1, 5, 30), (5, 99, 30, 30), (2, 1, 2, 60), (1000, 20, 3, 30), (100, 5, 5, 30)):
        got = Q.quality(data.docs(spark, corpus()), *limits).select("doc_id", *Q.BASE, "base_failed", "kept",
                                                                   "n_removed_words").collect()
        want = brute(corpus(), *limits)
        assert Counter(tuple(r) for r in got) == Counter(want), limits
        assert any(w[-1] for w in want)
    assert any(w[-1] and not w[-2] and not w[-3] for w in brute(corpus(), 5, 1, 5, 30))    # depleted


def page(i, n=60):
    return " ".join(f"body{i}x{k}" for k in range(n))


def kept_words(spark, some):
    return {r.doc_id: (r.kept, r.n_removed_words) for r in Q.quality(data.docs(spark, some)).collect()}


def test_footers_of_small_and_of_hot_hosts_go(spark):
    foot = "Home About Contact us Terms of Use"
    small = [(i, f"{page(i)}\n{foot}", "en", f"small{i % 2}", 1) for i in range(80)]
    hot = [(1000 + i, page(i, 25) + (f"\n{foot}" if i < 150 else ""), "en", "hot", 1) for i in range(4000)]   # under 4 %
    rare = [(9000 + i, page(i) + (f"\n{foot}" if i < 4 else ""), "en", "rare", 1) for i in range(30)]        # too few
    got = kept_words(spark, small + hot + rare)
    assert all(k for k, _ in got.values())
    assert sum(n for d, (_, n) in got.items() if d < 1000) == 78 * 7      # both hosts keep it in their first document
    assert sum(n for d, (_, n) in got.items() if 1000 <= d < 9000) == 149 * 7
    assert sum(n for d, (_, n) in got.items() if d >= 9000) == 0


def test_lines_that_differ_in_numbers_are_different_lines(spark):
    some = [(i, "\n".join(f"{i} {k} {i * 7 + k} {k}{i} 12 34" for k in range(10)), "en", "h", 1) for i in range(69)]
    assert set(kept_words(spark, some).values()) == {(True, 0)}


def test_of_many_copies_under_a_host_the_first_stays(spark):
    text = " ".join(f"w{i}" for i in range(40))
    some = [(i, text, "en", "h", 1) for i in range(90)] + [(100 + i, text, "en", f"other{i}", 1) for i in range(9)]
    got = kept_words(spark, some)
    assert {d for d, (k, _) in got.items() if k} == {0, *range(100, 109)}


def test_keep_good(spark):
    some = corpus() + [(3000 + i, f"{page(i)}\n\nSame   footer\tof all pages\n", None, None, 5) for i in range(8)]
    df = data.docs(spark, some)
    for limits in ({}, {"max_docs": 4}, {"max_docs": 1000, "min_docs": 3}):
        out = Q.keep_good(df, **limits)
        assert out.schema == df.schema
        want = cleaned(some, **limits)
        assert Counter(tuple(r[:5]) for r in out.select("doc_id", "text", "lang", "source", "n_chars").collect()) == Counter(want)
        assert any(t not in {r[1] for r in some} for _, t, *_ in want)
        left = Counter((h or "", x) for d, t, _, h, _ in want for x in {normal(x) for x in t.split("\n")} - {""})
        above = removed_lines(some, limits.get("max_docs", Q.MAX_DOCS), Q.MAX_SHARE, limits.get("min_docs", Q.MIN_DOCS))
        assert all(left[key] <= Counter(r[0] for r in some)[first] for key, first in above.items())


def test_clashing_columns(spark):
    df = data.docs(spark, corpus())
    for c in ("_id", "_hash", "_host", "id", "gone", "row", "lines", "text_hash", "changed_kept", "a.b"):
        df = df.withColumn(c, F.lit(c))
    out = Q.keep_good(df)
    assert out.schema == df.schema and out.count() == len(cleaned(corpus()))
    assert all(r["_id"] == "_id" and r["a.b"] == "a.b" for r in out.collect())


def test_empty_tables(spark):
    assert Q.quality(data.empty(spark)).count() == 0 and Q.keep_good(data.empty(spark)).count() == 0
    assert L.scan(data.empty(spark)).count() == 0


def dice(a, b):
    return 2 * len(a & b), len(a) + len(b)


def licences_of(text):
    found = []
    units = text.split("\n")
    units += [x for x in re.split(r"\n[\x20\x09-\x0D]*\n", text) if "\n" in x]
    for i, u in enumerate(units):
        a = set(L.bigrams_of(u))
        for name, templates in L.TEMPLATES.items():
            for t in templates:
                both, sizes = dice(a, set(L.bigrams_of(t)))
                if sizes and 100 * both >= L.MIN_DICE_PERCENT * sizes:
                    found.append((-both / sizes, name, i))
    return found


def test_licences_equal_brute_force(spark):
    mit = L.TEMPLATES["MIT"][2]
    some = data.rows() + [
        (500, "intro line\nReleased under the MIT License.\nmore", "en", "h", 1),
        (501, mit.replace("person", "human"), "en", "h", 1),
        (502, "x y z\n\n" + mit.replace(", to deal", ",\nto deal").replace("without limitation", "without\nlimitation"), "en", "h", 1),
        (503, "licensed  under THE apache license version 2.0", "en", "h", 1),
        (504, "Licensed under CC BY-NC 4.0.\nAll rights reserved.\nLicensed under CC BY 4.0.", "en", "h", 1),
        (505, "all rights reserved all rights reserved", "en", "h", 1),
        (506, "Licensed under the Apache License, Version 2.0 or later versions of it", "en", "h", 1),
    ]
    got = {}
    for r in L.scan(data.docs(spark, some)).collect():
        got.setdefault(r.doc_id, []).append((r.licence, None if r.dice is None else round(r.dice, 12), r.n_matches, r.licences))
    for d, t, *_ in some:
        found = sorted(licences_of(t or ""))
        want = ((found[0][1], round(-found[0][0], 12)) if found else (None, None)) + (
            len({i for *_, i in found}), ",".join(sorted({n for _, n, _ in found})))
        assert want in got[d], d
    assert got[502][0][0] == got[501][0][0] == "MIT" and got[503][0][0] == "Apache-2.0"


def test_size_bounds_never_cut_a_match():
    for a in range(1, 80):
        lo, hi = L.size_bounds(a, 80)
        for b in range(1, 200):
            if 200 * min(a, b) >= 80 * (a + b):
                assert lo <= b <= hi
