"""Membership in a set of values as a column, with SQL's three outcomes, for any number of sets in one scan.

Spark answers ``x IN (SELECT ...)`` with NULL where SQL does only inside of a filter; in a projection an unknown
membership comes out as false. A mark join gives it as a column: true if the value is a member; false if it is not, or
the set is empty; NULL if the value is NULL, or not found in a set that holds a NULL.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratakit.functions.rules import quoted
from stratakit.functions.schemas import holds_map

NULL_SALTS = 1024


class Membership(NamedTuple):
    """``value [NOT] IN (members)``; the members are the only column of a frame."""

    value: Column
    members: DataFrame
    negated: bool


def mark_members(df: DataFrame, column: str, members: DataFrame, name: str | None = None, negated: bool = False) -> DataFrame:
    """The frame with a boolean column that says whether ``column`` is among the members (or is not).

    The set is reduced to its distinct values, so no row is doubled, and whether it is empty or holds a NULL is one
    aggregate of it. Spark broadcasts the set if it is small and shuffles both sides if not; a value in very many rows
    is split by its skew handling, and rows without a value, which would all meet in one task, are dealt by their
    other columns. By default the mark takes the place of the column.
    """
    if len(members.columns) != 1:
        raise ValueError("the members are one column")
    members = members.toDF("__member")
    facts = members.agg(
        F.struct((F.count(F.lit(1)) == 0).alias("empty"), (F.count_if(F.col("__member").isNull()) > 0).alias("has_null"))
    ).scalar()
    distinct = members.where("__member is not null").distinct().withColumns({"__hit": F.lit(True), "__on": F.lit(0).cast("long")})
    value = quoted(column)
    able = [quoted(f.name) for f in df.schema.fields if not holds_map(f.dataType)]
    salt = F.when(value.isNull(), F.pmod(F.xxhash64(*able), F.lit(NULL_SALTS))).otherwise(F.lit(0).cast("long"))
    salted = df.withColumn("__salt", salt)
    joined = salted.join(distinct, (value == F.col("__member")) & (F.col("__salt") == F.col("__on")), "left")
    unknown = value.isNull() | facts.getField("has_null")
    mark = F.when(facts.getField("empty"), False).when(F.col("__hit"), True).when(~unknown, False)
    kept = [quoted(c) for c in df.columns if c != column or name not in (None, column)]
    marked = joined.select(*kept, (~mark if negated else mark).alias(name or column))
    return marked if name not in (None, column) else marked.select(*[quoted(c) for c in df.columns])


def as_membership(df: DataFrame, condition: str) -> Membership | None:
    """What a condition asks for, if all of it is one ``[NOT] IN`` with a subquery of its own; else None.

    That is told by Spark's analysis of it. Subqueries that refer to the frame's rows are not taken apart.
    """
    plan = df.where(F.expr(condition))._jdf.queryExecution().analyzed()
    while plan.nodeName() != "Filter":
        if plan.children().size() != 1:
            return None
        plan = plan.children().apply(0)
    test, negated = plan.condition(), False
    while test.nodeName() == "Not":
        test, negated = test.children().apply(0), not negated
    if test.nodeName() != "InSubquery" or test.values().size() != 1 or test.query().isCorrelated():
        return None
    session = df.sparkSession
    rows = session._jvm.org.apache.spark.sql.classic.Dataset.ofRows(session._jsparkSession, test.query().plan())
    return Membership(F.expr(test.values().apply(0).sql()), DataFrame(rows, session), negated)
