"""Rows that break rules, told apart while they are written: one scan, one write, two readers.

Every row gets the list of the rules it breaks. Clean and broken rows go to different partitions of one table, so either
kind is read without the other, and counts per rule are taken in the write job itself.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stratakit.functions.rules import quoted, usable_rules
from stratakit.operators.quality import Rules, flagged
from stratakit.sources.tables import TableStore, Transform

BROKEN, CLEAN = "broken_rules", "is_clean"


def tag_rows(df: DataFrame, rules: Rules, column: str = BROKEN) -> DataFrame:
    """The frame with an array of the names of the rules that a row breaks, in the order of the rules.

    A condition that is NULL does not break its rule. Rules that are one membership test are mark joins; others with
    ``IN (<subquery>)`` have no form as a column and are refused.
    """
    usable = usable_rules(rules)
    if column.lower() in [c.lower() for c in df.columns]:
        raise ValueError(f"the frame has a column {column} already")
    frame, failing = flagged(df, usable)
    names = [F.when(flag, F.lit(rule.name)) for rule, flag in zip(usable, failing)]
    broken = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    own = [F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)]
    return frame.select(*own, broken.alias(column))


def quarantine(
    store: TableStore, df: DataFrame, table: str, rules: Rules, append: bool = True, consumed: Mapping[str, int] | None = None
) -> dict[str, Any]:
    """Write all rows to a table partitioned by whether they are clean, each with the rules it breaks.

    Gives the new version, the rows that are clean and broken, and the broken rows of each rule, all counted
    within the write.
    """
    usable = usable_rules(rules)
    if CLEAN in [c.lower() for c in df.columns]:
        raise ValueError(f"the frame has a column {CLEAN} already")
    tagged = tag_rows(df, rules)
    seen = Observation()
    broken = F.size(BROKEN) > 0
    counts = [F.count_if(F.array_contains(BROKEN, rule.name)).alias(f"r{i}") for i, rule in enumerate(usable)]
    tagged = tagged.observe(seen, F.count_if(~broken).alias("clean"), F.count_if(broken).alias("broken"), *counts)
    write = store.append if append else store.overwrite
    version = write(tagged.withColumn(CLEAN, F.size(BROKEN) == 0), table, partition_by=[CLEAN], consumed=consumed)
    found = seen.get
    return {
        "version": version, "clean_rows": found["clean"], "broken_rows": found["broken"],
        "rules": {rule.name: found[f"r{i}"] for i, rule in enumerate(usable)},
    }


def quarantine_writer(store: TableStore, rules: Rules, append: bool = True) -> Callable[..., dict[str, Any]]:
    """A layer writer that applies the transform, if there is one, and keeps clean and broken rows apart."""

    def write(df: DataFrame, table: str, transform: Transform | None = None) -> dict[str, Any]:
        return quarantine(store, df.transform(transform) if transform else df, table, rules, append)

    return write


def clean_rows(store: TableStore, table: str, version: int | None = None) -> DataFrame:
    """The clean rows of a table that ``quarantine`` wrote; the broken ones are not scanned."""
    return store.read(table, version).where(quoted(CLEAN)).drop(CLEAN, BROKEN)


def broken_rows(store: TableStore, table: str, version: int | None = None) -> DataFrame:
    """The rows that break a rule, with the names of those that they break."""
    return store.read(table, version).where(~quoted(CLEAN)).drop(CLEAN)
