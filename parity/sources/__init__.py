"""Sources: relations of a check, test tables, check definitions."""

from parity.sources.relation import columns_of, relation, where  # noqa: F401
