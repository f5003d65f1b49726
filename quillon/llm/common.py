"""Helpers shared by the training-data operators: scratch tables, components, word splitting."""

from __future__ import annotations

import atexit
import gc
import re
import tempfile
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: White space between words: space and the characters 9 to 13.
WS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a local one where it is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = getattr(spark.sparkContext, "_quillon_dir", None)
        if not found:
            if not re.match(r"local(\[|$)", spark.sparkContext.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            holder = tempfile.TemporaryDirectory(prefix="quillon-")
            atexit.register(holder.cleanup)
            found = spark.sparkContext._quillon_dir = f"file://{holder.name}"
    return found.rstrip("/")


#: Lists of the folders that scratch_path() names, for those who delete them together. The first has all that are left; they go when the driver ends.
_LISTS: list[list[str]] = [[]]


def scratch_path(spark: SparkSession, what: str) -> str:
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    for made in _LISTS:
        made.append(path)
    return path


@contextmanager
def listing() -> Iterator[list[str]]:
    """The paths of the folders that scratch_path() names meanwhile, cut()'s tables among them."""
    _LISTS.append([])
    try:
        yield _LISTS[-1]
    finally:
        _LISTS.pop()


def cut(df: DataFrame, what: str = "cut") -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends there and a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, paths: list[str]) -> None:
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
    _LISTS[0][:] = [p for p in _LISTS[0] if p not in set(paths)]


@atexit.register
def _delete_the_rest() -> None:
    """Tables that results were read from until the driver's end."""
    gateway = SparkContext._gateway
    if gateway and _LISTS[0]:
        with suppress(Exception):  # the driver is ending, and a shared folder may be gone before it
            conf = gateway.jvm.org.apache.hadoop.conf.Configuration()
            for path in _LISTS[0]:
                where = gateway.jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(conf).delete(where, True)


def drop_scratch(df: DataFrame) -> None:
    """Delete the files of a table made by cut() that no later result reads."""
    plain = lambda p: re.sub("^file:/+", "/", p)
    found = {plain(f).rpartition("/")[0] for f in df.inputFiles()}
    delete(df.sparkSession, [p for p in _LISTS[0] if plain(p) in found])


def release(spark: SparkSession) -> None:
    """Has Spark delete the shuffle files of steps that no DataFrame refers to any more, which it does when the driver collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def keep(**columns: Column) -> Column:
    """Generator of one row with these columns; the optimiser can't merge it into later projections, so each is computed once."""
    return F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))


def name(c: str) -> str:
    """A column's name as functions take it, whatever its characters."""
    return "`" + c.replace("`", "``") + "`"


def packed(df: DataFrame, made: list[str], drop: tuple[str, ...] = (), **named: Column) -> tuple[DataFrame, list[str]]:
    """One column _row with all columns of df but those that are made anew or dropped, and the named ones beside it: so no name of df clashes with another. Also the names in _row."""
    kept = [c for c in df.columns if c not in made and c not in drop]
    row = F.struct(*[F.col(name(c)) for c in kept]) if kept else F.struct(F.lit(0).alias("_"))
    return df.select(row.alias("_row"), *[c.alias(n) for n, c in named.items()]), kept


def unpacked(df: DataFrame, kept: list[str], *made: str | Column) -> DataFrame:
    """packed()'s columns again, and the made ones."""
    return df.select(*[F.col("_row").getField(c).alias(c) for c in kept], *made)


def with_fields(df: DataFrame, row: str, made: str) -> StructType:
    """The schema of a column of df, and of the columns made."""
    return StructType([df.schema[row], *StructType.fromDDL(made).fields])


def split_join(left: DataFrame, right: DataFrame, on: list[str], count: str, total: int, how: str = "inner") -> DataFrame:
    """left joined with right by keys of which right knows how many rows of left have them. Keys of more than a thousandth of `total` rows, fewer than 1000, are broadcast, so that none goes to one task as a whole."""
    hot, rest = F.broadcast(right.where(F.col(count) > total / 1000)), right.where(F.col(count) <= total / 1000)
    return left.join(hot, on, how).unionByName(left.join(hot, on, "left_anti").join(rest, on, how))


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), WS + "+"), lambda w: w != "")


def portions(b: pa.RecordBatch, at: int, rows: int = 800, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of bounded numbers of rows and of bytes of column at, one row at least."""
    each = np.nan_to_num(pc.binary_length(b.column(at)).to_numpy(zero_copy_only=False).astype(float))
    lo = 0
    while lo < b.num_rows:
        hi = lo + max(1, int(np.searchsorted(np.cumsum(each[lo : lo + rows]), size)))
        yield b.slice(lo, min(hi, b.num_rows) - lo)
        lo = hi


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bits of a map of ids, and ids it is used for at most.
MAP_BITS, MAP_IDS = 1 << 24, 1 << 22


def bit_map(ids: DataFrame, column: str) -> bytes:
    """A map of fixed size with a bit for each id; other ids may share one. It comes as at most MAP_BITS / 64 rows."""
    at = ids.select((F.crc32(F.col(column).cast("string")) % MAP_BITS).alias("k")).groupBy(F.expr("k div 64").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, int(k % 64))")).alias("v")).toArrow()
    out = np.zeros(MAP_BITS // 64, "<i8")
    out[at.column("w").to_numpy()] = at.column("v").to_numpy()
    return out.tobytes()


def in_map(bits: bytes, value: int) -> bool:
    k = zlib.crc32(str(value).encode()) % MAP_BITS
    return bool(bits[k >> 3] >> (k & 7) & 1)


def components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """(id, component) of every vertex of the undirected edges; component is the smallest id reachable.

    Alternates large-star and small-star steps: each edge list is a table in the shared folder, each
    step one aggregation and one join, and the number of steps grows with the logarithm of the longest path.
    """
    now = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).where("u <> v").distinct()
    now, seen = cut(now, "edges"), None
    while True:
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.where("u <> v").distinct(), "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        small = cut(small.where("u <> v").distinct(), "edges")
        mark = small.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_scratch(large)
        drop_scratch(now)
        now = small
        if mark == seen:
            break
        seen = mark
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots).distinct()
