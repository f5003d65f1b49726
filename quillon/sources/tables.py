"""Tables as files: written and read back, text and YAML, files copied, CSV without a header."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from contextlib import suppress

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a local one of this session where it is unset and the master is local."""
    found = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark.sparkContext, "_quillon_tables", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        holder = tempfile.TemporaryDirectory(prefix="quillon-tables-")
        atexit.register(holder.cleanup)
        found = spark.sparkContext._quillon_tables = f"file://{holder.name}"
    return found.rstrip("/")


#: Tables in the shared folder that results may still be read from; they go when the driver ends.
_MADE: list[str] = []


def scratch_path(spark: SparkSession, what: str = "table") -> str:
    """A new place in the shared folder, which is deleted when the driver ends."""
    _MADE.append(f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}")
    return _MADE[-1]


@atexit.register
def _delete_the_rest() -> None:
    gateway = SparkContext._gateway
    if gateway and _MADE:
        with suppress(Exception):  # the driver is ending, and a shared folder may be gone before it
            conf = gateway.jvm.org.apache.hadoop.conf.Configuration()
            for path in _MADE:
                where = gateway.jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(conf).delete(where, True)


def materialise(df: DataFrame, path: str | None = None) -> DataFrame:
    """df written as Parquet and read back: what follows reads it as often as it likes and a lost executor recomputes nothing before it. Without a path, the table goes when the driver ends."""
    path = path or scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def observed(df: DataFrame, path: str | None = None, **metrics: Column) -> tuple[DataFrame, dict]:
    """materialise(), and aggregates of the rows, taken while they are written."""
    seen = Observation()
    table = materialise(df.observe(seen, *[c.alias(n) for n, c in metrics.items()]), path)
    return table, seen.get


def write_table(df: DataFrame, path: str, *partitions: str) -> None:
    own = df.write.mode("overwrite")
    (own.partitionBy(*partitions) if partitions else own).parquet(path)


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Text as one file, on any file system that Spark knows."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_text(spark: SparkSession, text: str, path: str) -> None:
    _put(spark, path, text)


def write_yaml(spark: SparkSession, value: dict, path: str) -> None:
    import yaml

    _put(spark, path, yaml.safe_dump(value, sort_keys=False, allow_unicode=True))


def copy_file(spark: SparkSession, source: str, target: str) -> None:
    """A file or folder as it is: what a step without work passes on."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    if not jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, True, conf):
        raise OSError(f"{source} was not copied to {target}")


def read_headerless(spark: SparkSession, path: str, columns: list[str], sep: str = ",") -> DataFrame:
    """CSV without a header, all columns text; a line with more or fewer fields than columns is an error."""
    found = spark.read.text(path).where("value <> ''")
    fields = F.split("value", re.escape(sep), -1)
    ok = F.when(F.size(fields) == len(columns), fields).otherwise(F.raise_error(F.concat(F.lit(f"not {len(columns)} fields: "), F.col("value"))).cast("array<string>"))
    return found.select(ok.alias("_f")).select(*[F.nullif(F.get("_f", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(columns)])


def write_fastq(reads: DataFrame, path: str) -> None:
    """Reads (read_id, sequence, quality) as gzipped FASTQ, a file for each partition."""
    reads.select(F.concat_ws("\n", F.concat(F.lit("@"), "read_id"), "sequence", F.lit("+"), "quality")).write.mode("overwrite").option("compression", "gzip").text(path)
