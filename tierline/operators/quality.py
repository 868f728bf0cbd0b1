"""Rule tagging and the split into valid and rejected rows.

The list of reasons is a string built per row; only the rejected side keeps it.
Validity is therefore its own boolean, and where the reasons are not selected
Catalyst drops them from the plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.trips import Rule, quality_rules

SEPARATOR = ", "


def issues(rules: Sequence[Rule]) -> Column:
    """Names of the broken rules in rule order; empty when there are none."""
    return F.concat_ws(SEPARATOR, *(F.when(F.expr(r.breach), F.lit(r.name)) for r in rules))


def breaks_any(rules: Sequence[Rule]) -> Column:
    """True when at least one rule is broken, never NULL."""
    broken = (F.coalesce(F.expr(r.breach), F.lit(False)) for r in rules)
    return reduce(Column.__or__, broken, F.lit(False))


def tag(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Add ``dq_issues`` and ``is_valid``."""
    rules = quality_rules() if rules is None else rules
    return df.withColumns({"dq_issues": issues(rules), "is_valid": ~breaks_any(rules)})


def valid_rows(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Rows that break no rule, without the tag columns."""
    return tag(df, rules).filter("is_valid").drop("dq_issues", "is_valid")


def rejected_rows(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Rows that break a rule, with the tag columns."""
    return tag(df, rules).filter(~F.col("is_valid"))


def issue_counts(tagged: DataFrame) -> DataFrame:
    """Rows per reason list, the empty one included."""
    return tagged.groupBy("dq_issues").agg(F.count(F.lit(1)).alias("n_rows"))


def split_summary(tagged: DataFrame) -> DataFrame:
    """One row: valid and rejected counts and their shares (NULL without rows)."""
    counts = tagged.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if("is_valid").alias("valid_rows")
    )
    rejected = F.col("total_rows") - F.col("valid_rows")
    return counts.select(
        "total_rows",
        "valid_rows",
        rejected.alias("rejected_rows"),
        F.try_divide("valid_rows", "total_rows").alias("valid_share"),
        F.try_divide(rejected, F.col("total_rows")).alias("rejected_share"),
    )
