"""Single-table checks over one relation, answered by one scan of it.

VOL counts rows that pass a filter, CAT / FORM / OBG count rows that violate a
rule: all of them are ``count_if`` of a predicate.  ``FusedScan`` holds the
predicates of many definitions over one relation:

* ``counts()``: one aggregate with a ``count_if`` per predicate.  Where every
  predicate is a condition, their disjunction is the scan's filter, so what all
  of them ask for (a partition, a date) still prunes files.
* ``keys()``: the offending keys of all definitions with key fields.  A row
  that violates some rules yields one (definition, key text) per rule, by one
  generator; distinct pairs are formed before the shuffle.  It is run only for
  definitions whose count isn't zero, on the rows that violate one of them.

A predicate may fail on the data (an ANSI cast, a division by zero) and takes
the scan with it.  ``run`` then halves the definitions until the faulty ones
stand alone: the others keep their counts, a fault among n costs O(log n) scans.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parity.functions import columns as C
from parity.functions.params import Bound
from parity.sources.local import literal_frame

KEYS_SCHEMA = "RESULT_ID long, KEY_FIELDS string"


@dataclass(frozen=True)
class Item:
    """One predicate of a definition: ``owner`` names what the count is for."""

    owner: tuple
    bound: Bound
    result_id: int = 0
    key_fields: tuple[str, ...] = ()

    @property
    def condition(self) -> str | None:
        """The predicate's text; None where it holds for every row."""
        text = self.bound.text
        if text is None or re.sub(r"\s", "", text) in ("", "1=1"):
            return None
        return f"(\n{text}\n)"


def first_line(e: Exception) -> str:
    return (str(e).strip().splitlines() or [type(e).__name__])[0]


class FusedScan:
    def __init__(self, spark: SparkSession, df: DataFrame, items: list[Item]):
        self.spark, self.df, self.items = spark, df, list(items)

    def _select(self, what: list[str], items: list[Item]) -> DataFrame:
        conditions = [i.condition for i in items]
        where = "" if None in conditions else " WHERE " + " OR ".join(conditions)
        args = {k: v for i in items for k, v in i.bound.args.items()}
        text = f"SELECT {', '.join(what)} FROM ".replace("{", "{{").replace("}", "}}") + "{rel}"
        return self.spark.sql(text + where.replace("{", "{{").replace("}", "}}"), args=args, rel=self.df)

    def counts(self, items: list[Item] | None = None) -> DataFrame:
        """One row: n0, n1, ... in the items' order."""
        items = self.items if items is None else items
        return self._select([f"count(1) AS n{j}" if i.condition is None else f"count_if({i.condition}) AS n{j}"
                             for j, i in enumerate(items)], items)

    def keys(self, items: list[Item] | None = None) -> DataFrame:
        """RESULT_ID, KEY_FIELDS: the distinct offending keys of the items with key fields."""
        items = [i for i in (self.items if items is None else items) if i.key_fields]
        if not items:
            return literal_frame(self.spark, [], KEYS_SCHEMA)
        marked = self._select(["*", *(f"{i.condition or 'true'} AS __v{j}" for j, i in enumerate(items))], items)
        found = [F.when(F.col(f"__v{j}"), F.struct(
            F.lit(i.result_id).cast("long").alias("RESULT_ID"),
            C.key_text(list(i.key_fields), sep=C.KEY_SEP_GROUPED).alias("KEY_FIELDS"))) for j, i in enumerate(items)]
        return marked.select(F.inline(F.filter(F.array(*found), lambda x: x.isNotNull()))).distinct()

    def accepts(self, item: Item) -> bool:
        """Whether Spark can plan the item's count and keys inside a fused scan
        (a sub-query or a random value in a predicate can't be aggregated)."""
        try:
            self.counts([item])
            self.keys([item])
            return True
        except Exception:  # noqa: BLE001 -- such a check runs, or reports its fault, on its own
            return False

    def run(self, items: list[Item] | None = None) -> dict[tuple, int | str]:
        """owner -> count, or the message of the predicate's fault."""
        items = self.items if items is None else items
        if not items:
            return {}
        try:
            row = self.counts(items).first()
            return {i.owner: row[j] for j, i in enumerate(items)}
        except Exception as e:  # noqa: BLE001 -- some predicate fails on the data
            if len(items) == 1:
                return {items[0].owner: first_line(e)}
            half = len(items) // 2
            return {**self.run(items[:half]), **self.run(items[half:])}
