"""Steps that may be off or find nothing: what comes after gets tables of the right columns without rows, and a status says why.

A step names the tables it needs, its own table's columns, and the table without whose rows there is nothing to do. Steps behind one that ended early end too, without a status of their own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from quillon.operators import metrics


@dataclass(frozen=True)
class Step:
    """make gets the tables named by needs, in this order. must: the one of them that must have rows, or else the reason is reported."""

    name: str
    needs: tuple[str, ...]
    make: Callable[..., DataFrame]
    columns: str
    must: str | None = None
    reason: str = "NO_CELLS"
    message: str = ""
    on: bool = True


def checked(df: DataFrame, step: Step) -> DataFrame:
    """df, if its columns are those that the step declares."""
    want = [(f.name, f.dataType.simpleString()) for f in StructType.fromDDL(step.columns).fields]
    if df.dtypes != want:
        raise ValueError(f"{step.name} has columns {df.dtypes}, not {want}")
    return df


def run(spark: SparkSession, steps: list[Step], given: dict[str, DataFrame], source_id: str, library_type: str, modality: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """All tables by name, those of steps that are off or ended early without rows, and the status rows. Tables that must have rows are looked at for one row; write them before, if that is dear."""
    tables, absent = dict(given), set()
    status = spark.createDataFrame([], metrics.STATUS)
    for step in steps:
        if unknown := [n for n in step.needs if n not in tables]:
            raise ValueError(f"{step.name} needs {', '.join(unknown)}, which no step before makes")
        if not step.on or absent & set(step.needs):
            absent.add(step.name)
        elif step.must and tables[step.must].isEmpty():
            absent.add(step.name)
            status = metrics.extend(status, metrics.status(spark, source_id, library_type, modality, step.name, step.reason, step.message))
        else:
            tables[step.name] = checked(step.make(*[tables[n] for n in step.needs]), step)
        if step.name in absent:
            tables[step.name] = spark.createDataFrame([], step.columns)
    return tables, status
