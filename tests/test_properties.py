"""Property tests: the pair-free counts and keys equal a brute-force
enumeration of every joined pair, on random small frames with NULLs,
duplicate keys and copies (SURVEY §5 (c))."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from parity.functions import columns as C
from parity.operators import checks

VAL = st.one_of(st.none(), st.integers(0, 2))
ROW = st.tuples(VAL, VAL, VAL)             # (k, a, b)
FRAME = st.lists(ROW, min_size=0, max_size=8)


def _differs(x, y):
    return x != y  # Python None == None mirrors NULL-safe equality


def _brute(src, dst, mode, key_col=0, key_name="k"):
    """(status, side) -> pairs, and the offending key texts (of the source
    column ``key_col``), by enumeration."""
    out, keys = Counter(), set()

    def status(s, d):
        sv, dv = (s[1], s[2]) if s else (None, None), (d[1], d[2]) if d else (None, None)
        if mode == "content" and any(_differs(x, y) for x, y in zip(sv, dv)):
            return C.NO_MATCH
        if all(v is None for v in dv):
            return C.ONLY_A
        if all(v is None for v in sv):
            return C.ONLY_B
        return C.MATCH

    def text(row):
        v = row[key_col] if row else None
        return f"{key_name} IS NULL" if v is None else f"{key_name}='{v}'"

    matched_d = set()
    for s in src:
        partners = [i for i, d in enumerate(dst) if s[0] is not None and d[0] == s[0]]
        if not partners:
            st_ = status(s, None)
            out[(st_, "src")] += 1
            keys.add(text(s))
        for i in partners:
            matched_d.add(i)
            st_ = status(s, dst[i])
            out[(st_, "both")] += 1
            if st_ != C.MATCH and mode == "content":
                keys.add(text(s))
    for i, d in enumerate(dst):
        if i not in matched_d:
            st_ = status(None, d)
            out[(st_, "dest")] += 1
            if mode == "content" or d[0] is None:
                keys.add(text(None))
    return +out, keys


SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(FRAME, FRAME)
def test_keyed_content_matches_enumeration(spark, src, dst):
    s = spark.createDataFrame(src, "k int, a int, b int")
    d = spark.createDataFrame(dst, "k int, a int, b int")
    res = checks.content(spark, s, d, "k = k", "a, b", "a, b", key_fields="k")
    want, want_keys = _brute(src, dst, "content")
    got = {(r.status, r.side): r.n for r in res.comparison.summary().collect()}
    assert got == dict(want)
    rows = Counter()
    for r in res.comparison.rows().collect():
        rows[(r.status, r.side)] += r.pairs
    assert rows == want
    assert {r[0] for r in res.keys.collect()} == want_keys


@SETTINGS
@given(FRAME, FRAME)
def test_keyed_reference_matches_enumeration(spark, src, dst):
    s = spark.createDataFrame(src, "k int, a int, b int")
    d = spark.createDataFrame(dst, "k int, a int, b int")
    res = checks.reference(spark, s, d, "k = k", "a, b", "a, b", key_fields="k")
    want, want_keys = _brute(src, dst, "reference")
    got = {(r.status, r.side): r.n for r in res.comparison.summary().collect()}
    assert got == dict(want)
    assert {r[0] for r in res.keys.collect()} == want_keys


@SETTINGS
@given(FRAME, FRAME)
def test_keyless_matches_enumeration(spark, src, dst):
    s = spark.createDataFrame(src, "k int, a int, b int")
    d = spark.createDataFrame(dst, "k int, a int, b int")
    res = checks.content(spark, s, d, None, "a, b", "a, b", key_fields="k")
    diff = [(x, y) for x in src for y in dst if (x[1], x[2]) != (y[1], y[2])]
    v = res.verdict.first()
    assert v.n_differences == len(diff)
    assert v.result == ("NOK" if diff else "OK")
    want_keys = {"k IS NULL" if x[0] is None else f"k='{x[0]}'" for x, _ in diff}
    assert {r[0] for r in res.keys.collect()} == want_keys


@SETTINGS
@given(FRAME, FRAME)
def test_keyed_content_keys_on_a_compared_column(spark, src, dst):
    s = spark.createDataFrame(src, "k int, a int, b int")
    d = spark.createDataFrame(dst, "k int, a int, b int")
    res = checks.content(spark, s, d, "k = k", "a, b", "a, b", key_fields="a")
    _, want_keys = _brute(src, dst, "content", key_col=1, key_name="a")
    assert {r[0] for r in res.keys.collect()} == want_keys
