"""Runtime parameters for definition filters.

A definition filter may hold placeholders ``field = ?``.  They are rewritten
into Spark named parameter markers ``field = :field`` and bound with typed
values through ``spark.sql(..., args=...)``, so values are literals, never
spliced SQL text.  Names match case-insensitively and are bound lowercase.
What looks like a placeholder inside quotes or a comment is none.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from decimal import Decimal

# A quoted text, a comment, or a placeholder; only the last has a group.
_PLACEHOLDER = re.compile(r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|`[^`]*`|--[^\n]*|/\*.*?\*/"""
                          r"""|\b(\w+)\s*=\s*\?""", re.DOTALL)

# Fixed values of the parameter report.
NO_PARAMETERS = "N/A"
PARAMETER_SEPARATOR = " | "


@dataclass
class Bound:
    """A filter with its placeholders replaced by named markers."""

    text: str | None
    args: dict = field(default_factory=dict)
    used: list[str] = field(default_factory=list)      # parameter names, lowercase, in order
    missing: list[str] = field(default_factory=list)   # placeholders without a value


def placeholders(text: str | None) -> list[str]:
    """Field names of ``field = ?`` placeholders, lowercase, first occurrence order."""
    if not text:
        return []
    return list(dict.fromkeys(m.group(1).lower() for m in _PLACEHOLDER.finditer(text) if m.group(1)))


def _replaced(text: str, by) -> str:
    """``text`` with its placeholders replaced by ``by(match)``; quoted texts and
    comments stay as they are."""
    return _PLACEHOLDER.sub(lambda m: by(m) if m.group(1) else m.group(0), text)


def bind(text: str | None, params: Mapping[str, object] | None) -> Bound:
    params = {k.lower(): v for k, v in (params or {}).items()}
    names = placeholders(text)
    if not names:
        return Bound(text)
    missing = [n for n in names if n not in params]
    rewritten = _replaced(text, lambda m: f"{m.group(1)} = :{m.group(1).lower()}")
    used = [n for n in names if n in params]
    return Bound(rewritten, {n: params[n] for n in used}, used, missing)


def sql_literal(value: object) -> str:
    """SQL text of a parameter value, for the report only (never executed)."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, (_dt.date, _dt.datetime)):
        return "'" + value.isoformat(sep=" ") + "'" if isinstance(value, _dt.datetime) else f"'{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


def bound_text(text: str | None, params: Mapping[str, object] | None) -> str | None:
    """The filter with its placeholders' values written out: text to read and
    run again by hand, never what a check itself runs."""
    values = {k.lower(): v for k, v in (params or {}).items()}

    def value(m: re.Match) -> str:
        name = m.group(1).lower()
        return f"{m.group(1)} = {sql_literal(values[name])}" if name in values else m.group(0)

    return _replaced(text, value) if text else text


def report(params: Mapping[str, object] | None, *bounds: Bound) -> str:
    """``a=1 | b='x'`` for the parameters applied to any of the filters, in the
    order the caller supplied them, each once; ``N/A`` when none applied."""
    used = {n for b in bounds for n in b.used}
    parts = [f"{k}={sql_literal(v)}" for k, v in (params or {}).items() if k.lower() in used]
    return PARAMETER_SEPARATOR.join(parts) if parts else NO_PARAMETERS


def parse_parameter_text(text: str | None) -> dict[str, object]:
    """Turn the prompt-style text ``ref_date='2025-12-31', cod_visao=3`` into a
    typed dict: quoted values become strings, integers ints, decimals floats,
    ``true``/``false`` booleans; anything else is kept as its text.  Commas
    inside quotes or parentheses do not split.  An item may stand in
    parentheses, ``(a='x'),(b=2)``, and so may the whole text; an item that is
    no assignment raises."""
    from parity.functions.text import split_list

    out: dict[str, object] = {}
    items = split_list(text)
    while any(i.startswith("(") and i.endswith(")") for i in items):
        items = [x for i in items for x in (split_list(i[1:-1]) if i.startswith("(") and i.endswith(")") else [i])]
    for item in items:
        m = re.match(r"^\s*(\w+)\s*=\s*(.+?)\s*$", item, re.DOTALL)
        if not m:
            raise ValueError(f"not a parameter assignment: {item!r}")
        name, raw = m.group(1), m.group(2)
        if len(raw) >= 2 and raw[0] == raw[-1] and raw[0] in "'\"":
            value: object = raw[1:-1].replace(raw[0] * 2, raw[0])
        elif re.fullmatch(r"[+-]?\d+", raw):
            value = int(raw)
        elif re.fullmatch(r"[+-]?\d*\.\d+(e[+-]?\d+)?", raw, re.IGNORECASE):
            value = float(raw)
        elif raw.lower() in ("true", "false"):
            value = raw.lower() == "true"
        else:
            value = raw
        out[name] = value
    return out
