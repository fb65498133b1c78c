"""Streams steered by a second stream: block-lists and rules that change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.running import Fold, running
from tideline.operators.skew import HOT_ROWS, lookup_join


def blocklist_anti(words: DataFrame, control: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is nowhere in the control table."""
    return lookup_join(words, control.select(*on).distinct(), on, "left_anti")


def blocklist_ordered(words: DataFrame, control: DataFrame, on: str, seq: str) -> DataFrame:
    """Rows whose key was not in the control stream before them, in arrival order ``seq``."""
    first = control.groupBy(on).agg(F.min(seq).alias("_blocked_at"))
    rows = lookup_join(words, first, [on], "left")
    passes = F.col("_blocked_at").isNull() | (F.col(seq) < F.col("_blocked_at"))
    return rows.filter(passes).drop("_blocked_at")


def dynamic_rule_filter(
    rows: DataFrame,
    is_control: Column,
    rule: Column,
    size: Column,
    order: Sequence[str],
    start: Column | None = None,
) -> DataFrame:
    """Rows whose ``size`` is within the newest rule that arrived before them.

    ``rows`` holds control and data rows in one arrival order; ``rule`` is the control row's
    limit. Rows before the first rule pass, unless ``start`` is a rule of earlier data. The
    rule in force comes out as ``rule``.
    """
    stamp = F.struct(*[F.col(name) for name in order], rule.alias("_rule"))
    newest = Fold("max", F.when(is_control, stamp), inclusive=False)
    ruled = running(rows.withColumn("_control", is_control), [], order, {"_newest": newest})
    ruled = ruled.filter(~F.coalesce(F.col("_control"), F.lit(False)))
    limit, none = F.col("_newest._rule"), F.col("_newest").isNull()
    if start is not None:
        limit, none = F.when(none, start).otherwise(limit), F.lit(False)
    passes = none | (size <= limit)
    return ruled.filter(passes).withColumn("rule", limit).drop("_control", "_newest")


def rules_asof(
    rows: DataFrame,
    is_control: Column,
    name: str,
    rule: Column,
    size: Column,
    order: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows whose ``size`` is within the newest rule of their ``name`` that arrived before them.

    Many named rules are in force at once, each changes on its own; control rows set the rule of
    their name from their arrival on. Rows pass where their name has no rule yet, or a null one, and
    where they have no name. The rule in force comes out as ``rule``. A name with very many rows is
    split along the arrival order (see ``running``).
    """
    stamp = F.struct(*[F.col(c) for c in order], rule.alias("_limit"))
    newest = Fold("max", F.when(is_control, stamp), inclusive=False)
    ruled = running(
        rows.withColumn("_sets", F.coalesce(is_control, F.lit(False))),
        [name],
        order,
        {"_newest": newest},
        hot_rows=hot_rows,
    )
    limit = F.when(F.col(name).isNotNull(), F.col("_newest._limit"))
    passes = limit.isNull() | (size <= limit)
    return ruled.filter(~F.col("_sets") & passes).withColumn("rule", limit).drop("_sets", "_newest")
