"""parity -- table reconciliation and data-quality checks as Spark DataFrame operators."""

from parity.operators.checks import (  # noqa: F401
    CheckResult, volume, content, reference, violations, catalogue, format_check, mandatory,
    duplicates, outside_catalogue,
)
from parity.operators.compare import KeyedComparison, CrossComparison  # noqa: F401
from parity.operators.side import Side, prepare  # noqa: F401
from parity.plans.suite import Definition, SuiteRun, run_suite  # noqa: F401

__all__ = ["CheckResult", "volume", "content", "reference", "violations", "catalogue", "format_check",
           "mandatory", "duplicates", "outside_catalogue", "KeyedComparison", "CrossComparison",
           "Side", "prepare", "Definition", "SuiteRun", "run_suite"]
