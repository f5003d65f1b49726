"""Global ranks, running sums and nearest keys without a task that sees all rows.

Spark's range partitioner deals the sorted rows to ranges by a sample of rows, so a frequent key gets as many ranges as its share: rows of one key are told apart by a hash of all their
columns. A range is a sorted partition; what it needs of those before it (their rows, sums or last values) is one row for each. The number of ranges grows with the number of rows, which is
observed while the input is written; a table of up to `ROWS` rows is one range. Input and sorted rows are tables in the shared folder, so each is computed once, and reading them again gives the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, LongType, MapType, StructField, StructType

from quillon.sources.tables import materialise, observed

#: Rows of a range, about.
ROWS = 250_000


def _before() -> WindowSpec:
    return W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)


def counted(df: DataFrame) -> tuple[DataFrame, int]:
    """df as a table, and how many rows were written."""
    table, seen = observed(df, n=F.count(F.lit(1)))
    return table, seen["n"]


def _hashed(kind: DataType) -> bool:
    """Whether Spark hashes values of the type."""
    if isinstance(kind, StructType):
        return all(_hashed(f.dataType) for f in kind.fields)
    return _hashed(kind.elementType) if isinstance(kind, ArrayType) else not isinstance(kind, MapType)


def ranged(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """df in n ranges, each a sorted partition, with the range's number as _range."""
    tie = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if _hashed(f.dataType)])
    placed = df.withColumn("_tie", tie).repartitionByRange(n, *order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    return placed.withColumn("_range", F.spark_partition_id())


def _order(keys: tuple[str, ...], desc: tuple[str, ...]) -> list[Column]:
    return [F.col(k).desc() if k in desc else F.col(k).asc() for k in keys]


def _ranges(n: int, rows: int) -> int:
    return max(1, -(-n // rows))


def _kept(df: DataFrame, name: str) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns if c != name]


def ranked(df: DataFrame, name: str, *keys: str, desc: tuple[str, ...] = (), rows: int = ROWS) -> DataFrame:
    """df with a rank from 1 in the order of keys (those in desc from the largest on): the place in the row's range, behind the ranges before."""
    order = _order(keys, desc)
    table, n = counted(df)
    if n <= rows:
        return table.withColumn(name, F.row_number().over(W.orderBy(*order)).cast("long"))  # one range
    placed = materialise(ranged(table, order, _ranges(n, rows)).withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    size = placed.groupBy("_range").agg(F.count("*").alias("_n"))
    before = size.select("_range", F.coalesce(F.sum("_n").over(_before()), F.lit(0)).alias("_before"))  # a row for each range
    return placed.join(before, "_range").select(*_kept(df, name), (F.col("_at") + 1 + F.col("_before")).alias(name))  # name may be that of a column made here


def _cumulative(value: str, kind: str):
    """Adds the running sum of a column over a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upto = None
        for b in batches:
            if not b.num_rows:
                continue
            own = b.column(value).cast(pa.int64() if kind == "bigint" else pa.float64())
            sums = pc.fill_null_forward(pc.cumulative_sum(own, start=upto, skip_nulls=True))
            if upto is not None:
                sums = pc.fill_null(sums, upto)
            upto = sums[-1] if sums[-1].is_valid else upto
            yield b.append_column("_sum", sums)

    return run


def running(df: DataFrame, name: str, value: str, *keys: str, desc: tuple[str, ...] = (), rows: int = ROWS) -> DataFrame:
    """df with the sum of value, a whole number or a double, up to each row in the order of keys; null before the first value."""
    order, kind = _order(keys, desc), "bigint" if df.schema[value].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint") else "double"
    table, n = counted(df)
    if n <= rows:
        return table.withColumn(name, F.sum(value).over(W.orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))
    placed = ranged(table, order, _ranges(n, rows))
    placed = materialise(placed.mapInArrow(_cumulative(value, kind), StructType([*placed.schema.fields, StructField("_sum", LongType() if kind == "bigint" else DoubleType())])))
    size = placed.groupBy("_range").agg(F.sum(value).cast(kind).alias("_n"))
    before = size.select("_range", F.sum("_n").over(_before()).alias("_before"))
    total = F.when(F.col("_sum").isNotNull() | F.col("_before").isNotNull(), F.coalesce("_sum", F.lit(0).cast(kind)) + F.coalesce("_before", F.lit(0).cast(kind)))
    return placed.join(before, "_range").select(*_kept(df, name), total.alias(name))


def _begins(b: pa.RecordBatch, by: tuple[str, ...], last: str | None) -> tuple[np.ndarray, str]:
    """Which rows are of another group than the row before, and the last row's group."""
    group = lambda i: repr(tuple(b.column(c)[i].as_py() for c in by))
    new = np.zeros(b.num_rows, bool)
    for c in by:
        of = pc.dictionary_encode(b.column(c), null_encoding="encode").indices.to_numpy()
        new[1:] |= of[1:] != of[:-1]
    new[0] = last is not None and group(0) != last
    return new, group(b.num_rows - 1)


def _filled(value: str, by: tuple[str, ...] = ()):
    """Fills a column's nulls from the row before of the same group in a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = group = None
        for b in batches:
            if not b.num_rows:
                continue
            own, (new, group) = b.column(value), _begins(b, by, group)
            here = np.arange(b.num_rows)
            at = np.maximum.accumulate(np.where(own.is_valid().to_numpy(zero_copy_only=False), here, -1))
            first = np.maximum.accumulate(np.where(new, here, -1))
            own = own.take(pa.array(at, pa.int64(), mask=at < np.maximum(first, 0)))
            if last is not None:
                own = pc.if_else(pa.array((at < 0) & (first < 0)), last, own)
            last = own[-1] if own[-1].is_valid else None
            yield b.set_column(b.schema.get_field_index(value), b.schema.field(value), own)

    return run


def nearest(rows_: DataFrame, key: str, value: str, side: str, backward: bool = True, rows: int = ROWS, by: tuple[str, ...] = ()) -> DataFrame:
    """rows_ with `value` filled from the last row (or the next one) of the same `by` columns in the order of (key, side) that has it. Values stand in the order of keys."""
    order = [F.col(key).asc(), F.col(side).asc()] if backward else [F.col(key).desc(), F.col(side).asc()]
    table, n = counted(rows_)
    # the next value is the last one of the reversed order: Spark computes a frame that is open ahead anew for each row
    upto = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    if n <= rows:
        return table.withColumn(value, F.last(value, ignorenulls=True).over(upto))
    placed = ranged(table, [*[F.col(c) for c in by], *order], _ranges(n, rows))
    placed = materialise(placed.mapInArrow(_filled(value, by), placed.schema))
    # so a range's last value of a group is its largest, or its least where the next one counts
    end = F.max(value) if backward else F.min(value)
    before = W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    far = placed.groupBy("_range", *by).agg(end.alias("_end")).withColumn("_far", F.last("_end", ignorenulls=True).over(before))
    far = far.where("_far IS NOT NULL").select(F.col("_range").alias("_r"), *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], "_far")  # of each range, at most the group that it begins with
    same = F.col("_range") == F.col("_r")
    for i, c in enumerate(by):
        same &= F.col(c).eqNullSafe(F.col(f"_by{i}"))
    return placed.join(far, same, "left").withColumn(value, F.coalesce(value, "_far")).select(*table.columns)
