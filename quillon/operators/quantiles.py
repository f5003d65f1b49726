"""Exact quantiles of groups of any size by counting.

Equal values of a group are one row with a count, summed before they are shuffled; running sums over all groups' sorted values, in ranges, say which ranks a value has, and a quantile takes the one or two values whose
ranks it needs. No task holds a group's values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.operators.ranges import ROWS, running


def quantiles(df: DataFrame, by: list[str], value: str, shares: dict[str, float], rows: int = ROWS) -> DataFrame:
    """(by, a column for each share): between the two values beside it, a quantile lies in proportion, as in Spark's percentile. Nulls don't count; a group of nulls has null quantiles, as has a table without rows where there is no group."""
    keys = [F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(by)]
    names = [f"_k{i}" for i in range(len(by))]
    each = df.select(*keys, F.col(f"`{value}`").alias("_v")).where("_v IS NOT NULL").groupBy(*names, "_v").agg(F.count("*").alias("_n"))
    upto = running(each, "_upto", "_n", *names, "_v", rows=rows)
    per = upto.groupBy(*names).agg(F.max("_upto").alias("_end"), F.sum("_n").alias("_size"))
    if by:
        other = per.withColumnsRenamed({k: f"{k}r" for k in names})
        met = upto.join(other, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}r")) for k in names]))
    else:
        met = upto.crossJoin(F.broadcast(per))  # one row
    last = F.col("_upto") - F.col("_end") + F.col("_size") - 1  # ranks from 0 in the group, of the value's last and first row
    first = last - F.col("_n") + 1
    picks = []
    for i, p in enumerate(shares.values()):
        at = F.lit(float(p)) * (F.col("_size") - 1)
        picks += [F.max(F.when(F.floor(at).between(first, last), F.col("_v"))).alias(f"_lo{i}"), F.max(F.when(F.ceil(at).between(first, last), F.col("_v"))).alias(f"_hi{i}"), F.max(at - F.floor(at)).alias(f"_part{i}")]
    found = met.groupBy(*names).agg(*picks)
    lie = [(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_part{i}")).cast("double").alias(name) for i, name in enumerate(shares)]
    if not by:
        return found.select(*lie)
    groups = df.select(*keys).distinct().withColumnsRenamed({k: f"{k}r" for k in names})
    out = groups.join(found, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}r")) for k in names]), "left")
    return out.select(*[F.col(f"_k{i}r").alias(c) for i, c in enumerate(by)], *lie)
