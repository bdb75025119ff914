"""Column expressions shared by the checks: null-safe difference, all-NULL
tests, status labels and offending-key text.  All built-in functions, so
they stay inside whole-stage codegen."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status labels and verdicts as stored in result tables.
MATCH = "MATCH"
NO_MATCH = "NO MATCH"
ONLY_A = "NO MATCH @ ONLY TABELA A"
ONLY_B = "NO MATCH @ ONLY TABELA B"
OK = "OK"
NOK = "NOK"
NOT_OK = "NOT OK"          # verdict word of the duplicate-key check
SIDE_BOTH, SIDE_SRC, SIDE_DEST = "both", "src", "dest"

# Separators of the offending-key text.
KEY_SEP_COMPARE = " , "    # content / referential checks
KEY_SEP_GROUPED = ", "     # catalogue / format / mandatory / duplicate checks


def any_of(cols: list[Column]) -> Column:
    return reduce(or_, cols) if cols else F.lit(False)


def all_of(cols: list[Column]) -> Column:
    return reduce(and_, cols) if cols else F.lit(True)


def differs(pairs: list[tuple[Column, Column]]) -> Column:
    """True when any pair differs, NULL = NULL counting as equal."""
    return any_of([~a.eqNullSafe(b) for a, b in pairs])


def all_null(cols: list[Column]) -> Column:
    return all_of([c.isNull() for c in cols])


def any_null(cols: list[Column]) -> Column:
    return any_of([c.isNull() for c in cols])


def content_status(pairs: list[tuple[Column, Column]], src_cols: list[Column],
                   dest_cols: list[Column]) -> Column:
    """Status of a joined pair in a content check: a value difference wins,
    then an all-NULL destination, then an all-NULL source."""
    return (F.when(differs(pairs), NO_MATCH)
            .when(all_null(dest_cols), ONLY_A)
            .when(all_null(src_cols), ONLY_B)
            .otherwise(MATCH))


def reference_status(src_cols: list[Column], dest_cols: list[Column]) -> Column:
    """Status of a joined pair in a referential check (existence only)."""
    return (F.when(all_null(dest_cols), ONLY_A)
            .when(all_null(src_cols), ONLY_B)
            .otherwise(MATCH))


def cross_status(pairs: list[tuple[Column, Column]]) -> Column:
    return F.when(differs(pairs), NO_MATCH).otherwise(MATCH)


def _quoted(col: Column) -> Column:
    return F.concat(F.lit("'"), F.replace(col.cast("string"), F.lit("'"), F.lit("''")), F.lit("'"))


def key_text(names: list[str], cols: list[Column] | None = None, sep: str = KEY_SEP_COMPARE) -> Column:
    """``k1='v1' , k2 IS NULL`` -- a predicate that selects the offending record.
    Quotes inside values are doubled; NULL renders as ``k IS NULL``."""
    cols = cols if cols is not None else [F.col(n) for n in names]
    parts = [F.when(c.isNull(), F.lit(f"{n} IS NULL")).otherwise(F.concat(F.lit(f"{n}="), _quoted(c)))
             for n, c in zip(names, cols)]
    return F.concat_ws(sep, *parts)


def null_key_text(names: list[str], sep: str = KEY_SEP_COMPARE) -> str:
    """Key text of a record whose key fields are all NULL."""
    return sep.join(f"{n} IS NULL" for n in names)
