"""Secret scans: keyword prefilter, anchored patterns near hits, checksums.

One Aho-Corasick pass over the ASCII-lower-cased text finds the keywords that
a secret must start with; a pattern is tried only at such a hit, anchored
there.  Long hexadecimal runs have no keyword: their prefilter maps bytes to
"hexadecimal digit or not" and looks for 24 digits in a row.

Kinds, in this order:

* ``assign``  a named value: ``password=...``, ``api_key: "..."`` (6+ characters)
* ``access``  ``AKIA`` and upper-case letters and digits (20+ characters)
* ``hex``     24+ hexadecimal digits
* ``github``  ``ghp_``/``gho_``/``ghu_``/``ghs_``/``ghr_`` tokens whose last six
  characters are the base-62 CRC-32 of the thirty before
* ``npm``     ``npm_`` tokens with the same checksum

Matches are leftmost and non-overlapping within a kind; one too short, or with
a wrong checksum, is dropped but still uses up its characters.  Spans are
``kind:start:end`` in code points, end exclusive, ordered by start and then by
kind as listed; spans of different kinds may overlap.

Nulls, ties, emptiness: a null text is empty (no span); a null doc_id stays
null; repeated rows each give their row; an empty table gives no rows; other
columns are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from parity.llm import common

# The kinds, their keywords and patterns.
KINDS = ("assign", "access", "hex", "github", "npm")
BASE_KINDS = KINDS[:3]
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
}
PATTERNS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                         re.IGNORECASE | re.ASCII),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "github": re.compile(r"gh[pousr]_[A-Za-z0-9]+"),
    "npm": re.compile(r"npm_[A-Za-z0-9]+"),
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
HEX_RUN = 24
MASK = "[SECRET]"

_HEX_TABLE = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_RUN = b"x" * HEX_RUN
_AUTOMATON = None

FOUND = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                   ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())])


def _automaton():
    global _AUTOMATON
    if _AUTOMATON is None:
        import ahocorasick
        made = ahocorasick.Automaton()
        for kind, words in KEYWORDS.items():
            for w in words:
                made.add_word(w, (KINDS.index(kind), len(w)))
        made.make_automaton()
        _AUTOMATON = made
    return _AUTOMATON


def checksum_holds(body: str) -> bool:
    """Thirty characters and the base-62 CRC-32 of them."""
    if len(body) != 36:
        return False
    crc, tail = zlib.crc32(body[:30].encode("ascii")), ""
    for _ in range(6):
        crc, digit = divmod(crc, 62)
        tail = BASE62[digit] + tail
    return tail == body[30:]


def _good(kind: str, m: re.Match) -> bool:
    if kind == "assign":
        return len(m.group(2)) >= 6
    if kind == "access":
        return m.end() - m.start() >= 20
    return checksum_holds(m.group()[4:])


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every secret, ordered."""
    spans = []
    done = [0] * len(KINDS)
    hits = sorted((end - n + 1, kind) for end, (kind, n) in _automaton().iter(common.lower_ascii(text)))
    for start, kind in hits:
        if start < done[kind]:
            continue
        m = PATTERNS[KINDS[kind]].match(text, start)
        if m:
            done[kind] = m.end()
            if _good(KINDS[kind], m):
                spans.append((start, kind, m.end()))
    data = text.encode("utf-8", "surrogatepass")
    marks = data.translate(_HEX_TABLE)
    at, upto, points = marks.find(_RUN), 0, 0      # code points before the byte ``upto``
    while at >= 0:
        end = at + HEX_RUN
        while marks[end:end + 1] == b"x":
            end += 1
        points += at - upto if len(data) == len(text) else len(data[upto:at].decode("utf-8", "surrogatepass"))
        upto = at
        spans.append((points, 2, points + end - at))
        at = marks.find(_RUN, end)
    spans.sort()
    return spans


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame) -> DataFrame:
    """One row a document: counts by base kind, digest of the base spans, all spans."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            rows: dict[str, list] = {f.name: [] for f in FOUND}
            for doc_id, text in zip(batch.column(0).to_pylist(), common.texts(batch)):
                spans = find(text)
                base = [x for x in spans if x[1] < len(BASE_KINDS)]
                n = [sum(x[1] == k for x in base) for k in range(len(BASE_KINDS))]
                for k, v in zip(rows, (doc_id, *n, hashlib.sha256(_joined(base).encode()).hexdigest(),
                                       _joined(spans), len(spans) - len(base))):
                    rows[k].append(v)
            yield common.batches(rows, FOUND)

    return common.doc_columns(docs).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long")


def mask(text: str) -> str:
    """The text with every secret (overlapping ones as one) replaced by MASK."""
    spans = find(text)
    if not spans:
        return text
    out, at, upto = [], 0, -1
    for start, _, end in spans:
        if start >= upto:
            if upto >= 0:
                at = upto
            out += [text[at:start], MASK]
        upto = max(upto, end)
    return "".join([*out, text[upto:]])


def redact(docs: DataFrame) -> DataFrame:
    """The same rows and columns with secrets masked in ``text`` (null stays
    null) and ``n_chars``, where the table has it, set to the new length of a
    changed text."""
    schema = docs.schema

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            at = batch.schema.get_field_index("text")
            old = batch.column(at).to_pylist()
            new = [t if t is None else mask(t) for t in old]
            batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
            size = batch.schema.get_field_index("n_chars")
            if size >= 0:
                kept = [n if a is b or a == b else len(b)
                        for n, a, b in zip(batch.column(size).to_pylist(), old, new)]
                batch = batch.set_column(size, batch.schema.field(size),
                                         pa.array(kept, batch.schema.field(size).type))
            yield batch

    return docs.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.read(spark, sf_dir, "documents"))
