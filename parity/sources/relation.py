"""Resolve the source / destination of a check into a DataFrame.

A relation is a DataFrame, a catalogued table name (``db.table``), or a
query -- bare (``SELECT ...``) or parenthesised (``(SELECT ...)``) as the
definitions write it.  Everything stays lazy; Catalyst later pushes the
check's filters and column pruning into the scan.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from parity.functions.params import Bound, bind

_QUERY = re.compile(r"^\s*(select|with|from|values|table)\b", re.IGNORECASE)


def strip_parens(text: str) -> str:
    s = text.strip()
    while s.startswith("(") and s.endswith(")") and _balanced_outer(s):
        s = s[1:-1].strip()
    return s


def _balanced_outer(s: str) -> bool:
    depth, quote = 0, None
    for i, ch in enumerate(s):
        if quote:
            if ch == quote:
                quote = None
            continue
        if ch in "'\"`":
            quote = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
            if depth == 0 and i != len(s) - 1:
                return False
    return depth == 0


def is_query(text: str) -> bool:
    return bool(_QUERY.match(text))


def relation(spark: SparkSession, spec, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    if isinstance(spec, DataFrame):
        return spec
    if spec is None or not str(spec).strip():
        raise ValueError("empty relation")
    text = strip_parens(str(spec))
    if tables and text in tables:
        return tables[text]
    if is_query(text):
        return spark.sql(text)
    return spark.table(text)


def where(spark: SparkSession, df: DataFrame, predicate, params=None) -> tuple[DataFrame, Bound]:
    """Filter ``df`` by a SQL predicate text (or a Column).  ``field = ?``
    placeholders are bound as typed named parameters; a placeholder without
    a value raises before anything runs."""
    if predicate is None or (isinstance(predicate, str) and not predicate.strip()):
        return df, Bound(None)
    if not isinstance(predicate, str):
        return df.where(predicate), Bound(None)
    bound = bind(predicate, params)
    if bound.missing:
        raise ValueError(f"parameters missing for filter {predicate!r}: {', '.join(bound.missing)}")
    if not bound.args:
        return df.where(bound.text), bound
    safe = bound.text.replace("{", "{{").replace("}", "}}")
    return spark.sql("SELECT * FROM {rel} WHERE " + safe, args=bound.args, rel=df), bound


def columns_of(df: DataFrame, exclude=(), stop_before: str | None = None) -> list[str]:
    """Column names of a relation from its schema (no job runs), without the
    ``exclude`` names, cut just before ``stop_before`` when it is present."""
    names = [c for c in df.columns if c and c not in set(exclude)]
    if stop_before in names:
        names = names[:names.index(stop_before)]
    return names
