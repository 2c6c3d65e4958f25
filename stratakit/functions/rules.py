"""Columns and small helpers for null profiles and SQL rules."""

from __future__ import annotations

import logging
import re
from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

logger = logging.getLogger("stratakit")


class Rule(NamedTuple):
    name: str
    condition: str
    description: str


def usable_rules(rules: Iterable[Mapping[str, str]] | None) -> list[Rule]:
    """Rules that have a condition. Unnamed ones are numbered; a repeated name is an error."""
    usable: list[Rule] = []
    taken: set[str] = set()
    unnamed = 0
    for rule in rules or []:
        name, condition = rule.get("name"), rule.get("condition")
        if not condition:
            logger.warning("rule %s has no condition and is skipped", name or "without a name")
            continue
        if not name:
            unnamed += 1
            name = "unnamed_rule" if unnamed == 1 else f"unnamed_rule_{unnamed}"
        if name in taken:
            raise ValueError(f"two rules are named {name}")
        taken.add(name)
        usable.append(Rule(name, condition, rule.get("description") or ""))
    return usable


def tests_membership(df: DataFrame, rule: Rule) -> bool:
    """Whether the condition holds ``IN (<subquery>)``, by the plan that Spark makes of it.

    Spark gives NULL for an unknown membership in a filter, but false in a projection.
    """
    if not re.search(r"\bin\b", rule.condition, re.IGNORECASE):
        return False
    plan = df.where(F.expr(rule.condition))._jdf.queryExecution().analyzed()
    return any(_holds_membership(e) for e in _scala(plan.expressions()))


def _scala(sequence) -> list:
    return [sequence.apply(i) for i in range(sequence.size())]


def _holds_membership(expression) -> bool:
    if expression.nodeName().lower() in ("insubquery", "in-subquery", "listquery"):
        return True
    return any(map(_holds_membership, _scala(expression.children())))


def quoted(name: str) -> Column:
    """A top-level column by its exact name, also when the name holds dots or back-quotes."""
    return F.col("`" + name.replace("`", "``") + "`")


def breaks(condition: str) -> Column:
    """True for rows that break a rule. An unknown (NULL) condition does not break it."""
    return ~F.expr(condition)


def percentage(part: Column, total: Column) -> Column:
    return F.when(total > 0, part / total * F.lit(100.0)).otherwise(F.lit(0.0))
