"""Parsing of the small text fragments a check definition carries.

Definitions are tiny driver-side rows, so this is plain Python; nothing here
touches data.  Column lists, group-bys and key-field lists are comma
separated, but a comma inside parentheses or quotes does not split
(``COALESCE(a, b)`` stays one item).  Join keys are ``a = b AND c = d``.
"""

from __future__ import annotations

import re

# Fixed values shared with the original framework's configuration dialect.
NO_JOIN_KEY = "1 = 1"   # blank / neutral join key and group-by
NEUTRAL_FILTER = "1 = 1"  # blank filter
ALL_COLUMNS = "*"       # blank select list

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")
_AND = re.compile(r"\s+and\s+", re.IGNORECASE)


def is_blank(text: str | None) -> bool:
    return text is None or not str(text).strip()


def split_list(text: str | None) -> list[str]:
    """Split a comma list at top level only; blanks are dropped."""
    if is_blank(text):
        return []
    items, depth, quote, cur = [], 0, None, []
    for ch in str(text):
        if quote:
            cur.append(ch)
            if ch == quote:
                quote = None
            continue
        if ch in ("'", '"', "`"):
            quote = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif ch == "," and depth == 0:
            items.append("".join(cur).strip())
            cur = []
            continue
        cur.append(ch)
    items.append("".join(cur).strip())
    return [i for i in items if i]


def unique(items: list[str]) -> list[str]:
    """Drop repeated names, keeping first occurrence (``GROUP BY c, c``)."""
    return list(dict.fromkeys(items))


def is_identifier(expr: str) -> bool:
    return bool(_IDENT.match(expr.strip()))


def output_name(expr: str) -> str:
    """Name of a select item: an identifier keeps its name, an expression is
    named by the original rule (``(`` -> ``_``, drop ``)``, ``,`` -> ``_``,
    drop spaces), then any other non-word character becomes ``_`` so the name
    is always a valid identifier (``SUM(x)`` -> ``SUM_x``, ``COUNT(*)`` ->
    ``COUNT__``)."""
    e = expr.strip()
    if is_identifier(e):
        return e
    name = e.replace("(", "_").replace(")", "").replace(",", "_").replace(" ", "")
    return re.sub(r"\W", "_", name)


def output_names(items: list[str], reserved=()) -> list[str]:
    """Names of select items, all different without regard to case.  An
    identifier keeps its name; an expression whose name is taken, by one or
    among ``reserved``, and a repeated identifier get a number: ``v_1``,
    ``v_1_2``."""
    names = [output_name(i) for i in items]
    taken, out = {r.lower() for r in reserved}, {}
    order = sorted(range(len(items)), key=lambda i: (not is_identifier(items[i]), i))
    for i in order:
        name, n = names[i], 1
        # a plain column may use the name reserved for it
        free = is_identifier(items[i]) and name.lower() not in {v.lower() for v in out.values()}
        while not free and name.lower() in taken:
            n += 1
            name = f"{names[i]}_{n}"
        taken.add(name.lower())
        out[i] = name
    return [out[i] for i in range(len(items))]


def parse_join_key(text: str | None) -> list[tuple[str, str]]:
    """``a = b AND c = d`` -> [(a, b), (c, d)]; blank or ``1 = 1`` -> [] (no key).

    Split on the word AND in any case (the substring ``and`` inside a column
    name such as ``brand`` does not split)."""
    if is_blank(text) or re.sub(r"\s", "", text) == re.sub(r"\s", "", NO_JOIN_KEY):
        return []
    pairs = []
    for seg in _AND.split(text.strip()):
        if "=" not in seg:
            raise ValueError(f"join key segment without '=': {seg!r}")
        left, right = (s.strip() for s in seg.split("=", 1))
        pairs.append((_strip_side(left), _strip_side(right)))
    return pairs


def _strip_side(name: str) -> str:
    # ``src.x`` / ``dest.x`` qualifiers are accepted and dropped
    for prefix in ("src.", "dest.", "a.", "b."):
        if name.lower().startswith(prefix):
            return name[len(prefix):]
    return name
