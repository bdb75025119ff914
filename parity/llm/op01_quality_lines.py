"""Quality rules with cross-document line frequency, in DataFrame functions only.

1. One pass over the texts gives each document's counts (below) and, for each
   line with a word, the 64-bit hash of the normalised line and its number of
   words.  Normalised: A-Z to a-z, runs of white space to one space, trimmed;
   digits stay, so lines that differ in a number are different lines.  The
   profile (a few numbers a line, no text) is written to the shared folder, as
   several branches read it.
2. For each host (``source``) and line hash: the number of documents that have
   the line, each document counted once.  Partial counts are formed before
   each shuffle, so a frequent line is one row a task.
3. A line is above the limits if it is in more than ``max_docs`` documents of
   a host, or in at least ``min_docs`` of them that are more than ``max_share``
   percent of the host: the first limit holds for large hosts, where
   boilerplate may be a small share, the second for small ones.  It is removed
   from all documents of the host but the one with the smallest doc_id.
4. A document is depleted, and rejected, if less than ``min_left`` percent of
   its words are left.  Of copies under one host, once they are more than the
   limits allow, the first one stays.

Base counts: ``n_words`` words ``[^\\x20\\x09-\\x0D]+``; ``word_chars`` code
points in them; ``n_symbols`` characters of ``#*$%&|<>``; ``n_dup_lines``
lines with a word that equal an earlier line; ``n_repeat_words`` words in
8-word windows found twice or more in the text (windows are compared by
64-bit hashes).  ``base_failed``: fewer than 20 words, or more than 30 % of
them repeated in that sense.

Nulls, ties, emptiness: a null text is empty (no words, base_failed); a null
source is a host of its own (the empty one); a null doc_id stays null and
never is a line's first document; repeated rows are documents of their own,
each counted, and all first if they have the smallest doc_id; an empty table
gives no rows; other columns are ignored by ``quality`` and kept by
``keep_good``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parity.llm import common

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
#: Documents of a host that may have a line, however large the host.
MAX_DOCS = 100
#: Percent of a host's documents that may have a line, once MIN_DOCS have it.
MAX_SHARE = 5
MIN_DOCS = 5
MIN_LEFT = 30
SYMBOLS = "#*$%&|<>"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once (a name that a lambda binds is never
    copied into a loop by the optimizer)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, common.SPACE_RUN), "")


def _covered(positions: Column, window: int) -> Column:
    """Words covered by windows at these ascending positions."""
    return let(positions, lambda p: F.aggregate(
        F.transform(p, lambda x, i: F.when(i + 1 < F.size(p), F.least(F.lit(window), F.get(p, i + 1) - x))
                    .otherwise(F.lit(window))),
        F.lit(0), lambda a, x: a + x))


def repeat_words(words_: Column, window: int = REPEAT_WINDOW) -> Column:
    """Words in windows found twice or more, the first finding included."""
    def windows(h: Column) -> Column:
        return F.when(F.size(h) < window, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(1), F.greatest(F.size(h) - (window - 1), F.lit(1))),
                        lambda i: F.xxhash64(F.slice(h, i, window))))

    def repeated(w: Column) -> Column:
        in_order = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return let(in_order, lambda s: _covered(F.sort_array(F.transform(
            F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])),
            lambda x: x["p"])), window))

    return let(F.transform(words_, lambda x: F.xxhash64(x)),
               lambda h: let(windows(h), lambda w: F.when(
                   F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(repeated(w)))).cast("long")


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(line, _UPPER, _LOWER), common.SPACE_RUN, " "))


def profile(docs: DataFrame) -> DataFrame:
    """row_id, doc_id, host, text_hash, base counts, lines [(h, n_words)]."""
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, common.SPACES, "") != "")
    line_rows = F.transform(
        F.filter(F.transform(F.split(text, "\n"), normalised), lambda x: x != ""),
        lambda x: F.struct(F.xxhash64(x).alias("h"),
                           (F.length(x) - F.length(F.translate(x, " ", "")) + 1).cast("long").alias("n")))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return d.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", "host",
        F.xxhash64(text).alias("text_hash"),
        let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                            repeat_words(w).alias("n_repeat_words"))).alias("w"),
        F.length(F.translate(text, common.SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        line_rows.alias("lines"))


def above_limits(p: DataFrame, max_docs: int, max_share: float, min_docs: int) -> DataFrame:
    """host, h, first_doc of the lines to remove, from profiles."""
    hosts = p.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    once = p.select("host", "doc_id", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
    return (once.groupBy("host", "h").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first_doc"))
            .filter(F.col("docs") >= min(min_docs, max_docs + 1)).join(hosts, "host")
            .filter((F.col("docs") > max_docs) | ((F.col("docs") >= min_docs)
                                                  & (F.col("docs") * 100 > F.col("host_docs") * max_share)))
            .select("host", "h", "first_doc"))


def _decided(p: DataFrame, max_docs: int, max_share: float, min_docs: int, min_left: int) -> DataFrame:
    """The profiles with base_failed, kept, n_removed_words and ``gone``, the
    hashes of the removed lines."""
    lines = p.select("row_id", "doc_id", "host", F.inline("lines"))
    removed = (lines.join(above_limits(p, max_docs, max_share, min_docs), ["host", "h"])
               .filter(~F.coalesce(F.col("doc_id") == F.col("first_doc"), F.lit(False)))
               .groupBy("row_id").agg(F.sum("n").alias("n_removed_words"), F.collect_set("h").alias("gone")))
    n_words, n_repeat = F.col("w.n_words"), F.col("w.n_repeat_words")
    base_failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
    n_gone = F.coalesce(F.col("n_removed_words"), F.lit(0))
    return (p.drop("lines").join(removed, "row_id", "left")
            .select("row_id", "doc_id", "host", "text_hash", n_words.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
                    n_repeat.alias("n_repeat_words"), base_failed.alias("base_failed"),
                    (~base_failed & (100 * (n_words - n_gone) >= min_left * n_words)).alias("kept"),
                    n_gone.alias("n_removed_words"), "gone"))


def quality(docs: DataFrame, max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS,
            min_left: int = MIN_LEFT) -> DataFrame:
    """One row a document: row_id, doc_id, host, text_hash, base counts, base_failed, kept,
    n_removed_words."""
    return _decided(common.written(profile(docs), "line-profile"), max_docs, max_share, min_docs, min_left).drop("gone")


def _without(text: Column, gone: Column) -> Column:
    """A text without the lines whose normalised hash is in ``gone``."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(gone, F.xxhash64(normalised(x)))), "\n")


def keep_good(docs: DataFrame, max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS,
              min_left: int = MIN_LEFT) -> DataFrame:
    """The documents that ``quality`` keeps, with all their columns, their texts
    without the removed lines (``n_chars`` follows where a text changed).

    Decisions that change a document are found by (doc_id, host, text), which
    decide them; columns of the table are held in one, so none can clash."""
    decided = _decided(common.written(profile(docs), "line-profile"), max_docs, max_share, min_docs, min_left)
    changed = (decided.filter(~F.col("kept") | F.col("gone").isNotNull())
               .groupBy("doc_id", "host", "text_hash").agg(F.first("kept").alias("kept"), F.first("gone").alias("gone"))
               .select(*[F.col(c).alias(f"changed_{c}") for c in ("doc_id", "host", "text_hash", "kept", "gone")]))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, F.col("doc_id").cast("long").alias("id"),
                        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"),
                        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_hash"))
    gone = F.col("changed_gone")
    text = F.when(gone.isNull(), F.col("row.text")).otherwise(_without(F.col("row.text"), gone))
    out = {"text": text.cast(docs.schema["text"].dataType)}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(gone.isNull(), F.col("row.n_chars")).otherwise(F.length(text)).cast(
            docs.schema["n_chars"].dataType)
    return (keyed.join(changed, F.col("id").eqNullSafe(F.col("changed_doc_id")) & (F.col("host") == F.col("changed_host"))
                       & (F.col("text_hash") == F.col("changed_text_hash")), "left")
            .filter(F.coalesce("changed_kept", F.lit(True)))
            .select(*[out.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(common.read(spark, sf_dir, "documents")).select(
        "doc_id", *BASE, "base_failed", "kept", "n_removed_words")


SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, text FROM d),
b AS (SELECT doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM w),
l AS (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line FROM d),
lw AS (SELECT doc_id, host, line FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dl AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lw GROUP BY doc_id),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n_repeat_words
        FROM rep, (SELECT unnest(range(0, 8)) AS k) GROUP BY doc_id),
nl AS (SELECT doc_id, host, trim(regexp_replace(translate(line, '{_UPPER}', '{_LOWER}'),
         '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line FROM lw),
hd AS (SELECT host, count(*) AS host_docs FROM d GROUP BY host),
ab AS (SELECT host, line, min(doc_id) AS first_doc FROM nl JOIN hd USING (host) GROUP BY host, line, host_docs
       HAVING count(DISTINCT doc_id) > {MAX_DOCS}
         OR (count(DISTINCT doc_id) >= {MIN_DOCS} AND count(DISTINCT doc_id) * 100 > host_docs * {MAX_SHARE})),
rm AS (SELECT doc_id, sum(len(string_split(line, ' ')))::BIGINT AS n_removed_words
       FROM nl JOIN ab USING (host, line) WHERE doc_id <> first_doc GROUP BY doc_id),
c AS (SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        coalesce(n_removed_words, 0)::BIGINT AS n_removed_words
      FROM b LEFT JOIN dl USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN rm USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
    AND 100 * (n_words - n_removed_words) >= {MIN_LEFT} * n_words AS kept, n_removed_words
FROM c
"""
