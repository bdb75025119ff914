"""One side of a check: relation -> filter -> (group) -> projected columns.

Items of the select list are SQL expressions; each gets an output name
(``output_name``), made unique where two items would share one.  Columns the check needs but the select list lacks
(join keys, key fields) are added as extra items, so a definition never
fails on an unresolved column.  With a group-by the extra items must be
grouping expressions, as in SQL.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parity.functions.params import Bound
from parity.functions.text import ALL_COLUMNS, NO_JOIN_KEY, is_blank, output_names, split_list, unique
from parity.sources.relation import relation, where

@dataclass
class Side:
    df: DataFrame
    names: list[str]                 # selected column names, in select-list order
    single_row: bool = False         # at most one row, by the analysed plan (a global aggregate)
    bound: Bound = field(default_factory=lambda: Bound(None))
    items: list[str] = field(default_factory=list)   # select expressions as written
    groups: list[str] = field(default_factory=list)  # grouping expressions as written
    all_items: list[str] = field(default_factory=list)  # with the columns added for keys
    all_names: list[str] = field(default_factory=list)

    def unique_by(self, columns: list[str]) -> bool:
        """Whether these columns hold every grouping expression, so that no two rows agree in them."""
        return bool(self.groups) and {g.lower() for g in self.groups} <= {c.lower() for c in columns}


def _items(select, df: DataFrame) -> list[str]:
    if select is None or (isinstance(select, str) and select.strip() in ("", ALL_COLUMNS)):
        return list(df.columns)
    items = split_list(select) if isinstance(select, str) else [s.strip() for s in select]
    if items == [ALL_COLUMNS]:
        return list(df.columns)
    return items


def _group(group_by) -> list[str]:
    if group_by is None:
        return []
    if isinstance(group_by, str):
        if is_blank(group_by) or re.sub(r"\s", "", group_by) == re.sub(r"\s", "", NO_JOIN_KEY):
            return []
        return unique(split_list(group_by))
    return unique([g.strip() for g in group_by if g and g.strip()])


def prepare(spark: SparkSession, rel, select=None, filter=None, group_by=None, params=None,
            extra: list[str] = (), optional_extra: list[str] = (), tables=None) -> Side:
    """``extra`` columns are added when the select list lacks them;
    ``optional_extra`` only when the relation has them."""
    df = relation(spark, rel, tables)
    df, bound = where(spark, df, filter, params)
    items = _items(select, df)
    present = {c.lower() for c in df.columns}
    wanted = list(extra) + [c for c in optional_extra if c.lower() in present]
    # a column that the check needs keeps its name, whatever expressions are named like it
    names = output_names(items, [c for c in wanted if c.lower() in present])
    # names match without regard to case, as Spark SQL resolves them
    have = {n.lower() for n in names}
    extras = []
    for e in wanted:
        if e.lower() not in have:
            have.add(e.lower())
            extras.append(e)
    all_items, all_names = items + extras, names + extras
    groups = _group(group_by)
    if groups:
        g = df.groupBy(*[F.expr(e).alias(f"__g{i}") for i, e in enumerate(groups)])
        out = g.agg(*[F.expr(e).alias(f"__c{j}") for j, e in enumerate(all_items)])
        out = out.select(*[F.col(f"__c{j}").alias(n) for j, n in enumerate(all_names)])
    else:
        out = df.select(*[F.expr(e).alias(n) for e, n in zip(all_items, all_names)])
    return Side(out, names, not groups and _single_row(out), bound, items, groups, all_items, all_names)


def _single_row(df: DataFrame) -> bool:
    """Whether the analysed plan has at most one row (an aggregate without
    grouping, whatever the text looks like)."""
    most = df._jdf.queryExecution().analyzed().maxRows()
    return most.isDefined() and most.get() <= 1
