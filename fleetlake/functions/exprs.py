"""Small scalar helpers shared by the plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_ratio(num, den) -> Column:
    """``num / nullif(den, 0)``: null instead of an ANSI divide-by-zero error."""
    return col(num) / F.nullif(col(den), F.lit(0))


def composite_key(device, qubit, sep: str = ":q") -> Column:
    """``device || ':q' || qubit`` -- null if either part is null (not concat_ws)."""
    return F.concat(col(device), F.lit(sep), col(qubit).cast("string"))


def any_true(cond: Column) -> Column:
    """Group-level 'any': ``max(case when cond then 1 else 0 end) = 1``; null cond counts as false."""
    return F.max(F.when(cond, F.lit(1)).otherwise(F.lit(0))) == 1


def count_if(cond: Column) -> Column:
    """``sum(case when cond then 1 else 0 end)`` as BIGINT."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def non_null(*items: Column) -> Column:
    """``array(items...)`` without its nulls, in order (items are distinct names).

    ``array_except(..., array(null))`` instead of ``array_compact``: the latter is a
    lambda (``filter``), which keeps the whole projection out of whole-stage codegen.
    """
    return F.array_except(F.array(*items), F.array(F.lit(None).cast("string")))
