"""Data-quality rule vocabulary.

A rule names what it checks (``strategy``, ``check``, ``column``) and what to do
with a violating row (``action``).  Actions:

- ``quarantine``: the row is erroneous and goes to the quarantine table;
- ``failjob``: the row is erroneous and stops the load;
- ``quarantine,failjob``: both;
- ``report``: counted in the summary, the row stays good;
- ``None``: the row is erroneous with no further action.

Row rules are plain Spark expressions (all evaluated in one ``select``).
Set rules (``unique``, ``foreign_key``) need other rows; each says which keys
violate it, and ``operators.key_sets`` flags the rows that hold them.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Action names and the summary vocabulary used in reports.
QUARANTINE = "quarantine"
FAILJOB = "failjob"
REPORT = "report"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class Rule:
    """Base rule: summary labels and action."""

    strategy: str
    check: str
    column: str
    action: str | None

    @property
    def blocks(self) -> bool:
        """Does a violation make the row erroneous?"""
        return self.action != REPORT

    def violation(self) -> Column | None:
        """Row-level violation expression (True = violated); None for set rules."""
        return None


@dataclass(frozen=True)
class RowRule(Rule):
    """A rule decided by the row alone; null verdicts count as not violated."""

    expr: Column = field(default=None, compare=False)

    def violation(self) -> Column:
        return F.coalesce(self.expr, F.lit(False))


@dataclass(frozen=True)
class SetRule(Rule):
    """A rule decided by all rows that hold a key (see ``operators.key_sets``)."""

    keys: tuple[str, ...] = ()

    def flag_keys(self, counts: DataFrame, names: Sequence[str], count: str, flag: str) -> DataFrame:
        """``counts`` (distinct keys in the columns ``names`` and their row ``count``)
        with boolean column ``flag``: the key violates the rule."""
        raise NotImplementedError


@dataclass(frozen=True)
class UniqueRule(SetRule):
    """Rows whose key occurs more than once violate (nulls group together)."""

    def flag_keys(self, counts: DataFrame, names: Sequence[str], count: str, flag: str) -> DataFrame:
        return counts.withColumn(flag, F.col(count) > 1)


@dataclass(frozen=True)
class ForeignKeyRule(SetRule):
    """Non-null child keys with no parent key violate."""

    parent: DataFrame | None = field(default=None, compare=False)
    parent_key: str = ""

    def flag_keys(self, counts: DataFrame, names: Sequence[str], count: str, flag: str) -> DataFrame:
        # both sides have one row per key: neither a hot child key nor repeated
        # parent keys reach the join
        parent = f"{flag}_pk"
        known = self.parent.select(F.col(self.parent_key).alias(parent)).where(F.col(parent).isNotNull()).distinct()
        found = counts.join(known, F.col(names[0]) == F.col(parent), "left")
        return found.withColumn(flag, F.col(names[0]).isNotNull() & F.col(parent).isNull()).drop(parent)


# --------------------------------------------------------------------------
# Rule builders
# --------------------------------------------------------------------------


def not_null(column: str, action: str | None = QUARANTINE) -> Rule:
    return RowRule("Completeness", "not_null", column, action, F.col(column).isNull())


def not_blank(column: str, action: str | None = QUARANTINE) -> Rule:
    c = F.col(column)
    return RowRule("Completeness", "not_blank", column, action, c.isNull() | (F.trim(c) == ""))


def in_range(
    column: str,
    min_value: Any = None,
    max_value: Any = None,
    action: str | None = QUARANTINE,
) -> Rule:
    """Inclusive bounds; either may be omitted."""
    c = F.col(column)
    parts = []
    if min_value is not None:
        parts.append(c < F.lit(min_value))
    if max_value is not None:
        parts.append(c > F.lit(max_value))
    if not parts:
        raise ValueError("in_range needs min_value or max_value")
    expr = parts[0] if len(parts) == 1 else (parts[0] | parts[1])
    return RowRule("Validity", "range", column, action, expr)


def in_set(column: str, values: Iterable[Any], action: str | None = QUARANTINE) -> Rule:
    return RowRule("Validity", "in_set", column, action, ~F.col(column).isin(list(values)))


def matches(column: str, pattern: str, action: str | None = QUARANTINE) -> Rule:
    """Violated when the text does not contain a match of ``pattern``."""
    return RowRule("Validity", "regex", column, action, ~F.col(column).rlike(pattern))


def length_between(
    column: str,
    min_length: int | None = None,
    max_length: int | None = None,
    action: str | None = QUARANTINE,
) -> Rule:
    n = F.length(F.col(column))
    parts = []
    if min_length is not None:
        parts.append(n < F.lit(min_length))
    if max_length is not None:
        parts.append(n > F.lit(max_length))
    if not parts:
        raise ValueError("length_between needs min_length or max_length")
    expr = parts[0] if len(parts) == 1 else (parts[0] | parts[1])
    return RowRule("Validity", "length", column, action, expr)


def castable(column: str, data_type: str, action: str | None = QUARANTINE) -> Rule:
    """Violated when a non-null value cannot be cast (``try_cast`` gives null)."""
    c = F.col(column)
    return RowRule(
        "Validity", "type", column, action, c.isNotNull() & F.expr(
            f"try_cast(`{column}` AS {data_type})"
        ).isNull()
    )


def parsed(corrupt_column: str, action: str | None = QUARANTINE) -> Rule:
    """Violated when the source reader could not parse the row (its raw text
    is in ``corrupt_column``, see ``read_delimited(corrupt_column=...)``)."""
    return RowRule("Validity", "parsed", corrupt_column, action, F.col(corrupt_column).isNotNull())


def unique(*keys: str, action: str | None = QUARANTINE) -> Rule:
    return UniqueRule("Uniqueness", "unique", ",".join(keys), action, tuple(keys))


def foreign_key(
    column: str,
    parent: DataFrame,
    parent_key: str,
    action: str | None = QUARANTINE,
) -> Rule:
    return ForeignKeyRule("Integrity", "foreign_key", column, action, (column,), parent, parent_key)


def expression(
    condition: str | Column,
    column: str,
    action: str | None = QUARANTINE,
) -> Rule:
    """Rows must satisfy ``condition`` (SQL text or Column); null passes."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    return RowRule("Consistency", "expression", column, action, ~cond)


_BUILDERS = {
    "not_null": lambda d, p: not_null(d["column"], d.get("action")),
    "not_blank": lambda d, p: not_blank(d["column"], d.get("action")),
    "range": lambda d, p: in_range(d["column"], d.get("min"), d.get("max"), d.get("action")),
    "in_set": lambda d, p: in_set(d["column"], d["values"], d.get("action")),
    "regex": lambda d, p: matches(d["column"], d["pattern"], d.get("action")),
    "length": lambda d, p: length_between(
        d["column"], d.get("min"), d.get("max"), d.get("action")
    ),
    "type": lambda d, p: castable(d["column"], d["data_type"], d.get("action")),
    "parsed": lambda d, p: parsed(d["column"], d.get("action")),
    "unique": lambda d, p: unique(*_as_list(d["column"]), action=d.get("action")),
    "foreign_key": lambda d, p: foreign_key(
        d["column"], p[d["parent"]], d["parent_key"], d.get("action")
    ),
    "expression": lambda d, p: expression(
        d["condition"], d.get("column", d["condition"]), d.get("action")
    ),
}


def _as_list(v: str | Sequence[str]) -> list[str]:
    return [s.strip() for s in v.split(",")] if isinstance(v, str) else list(v)


def rule_from_dict(spec: dict, parents: dict[str, DataFrame] | None = None) -> Rule:
    """Build a rule from stored configuration, e.g.
    ``{"check": "range", "column": "amount", "min": 0, "action": "quarantine"}``.
    ``parents`` maps names used by ``foreign_key`` rules to DataFrames."""
    check = spec["check"].lower()
    if check not in _BUILDERS:
        raise ValueError(f"unknown check {spec['check']!r}")
    return _BUILDERS[check](spec, parents or {})


def rules_from_config(specs: Iterable[dict], parents: dict[str, DataFrame] | None = None) -> list[Rule]:
    return [rule_from_dict(s, parents) for s in specs]
