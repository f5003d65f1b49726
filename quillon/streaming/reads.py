"""An addition of this engine: barcode parts counted from a growing folder of sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.operators.reads import LAYOUT_DNA, compose_barcode, extract_parts


def barcodes(spark: SparkSession, folder: str, layout: dict[str, tuple[int, int]] = LAYOUT_DNA) -> DataFrame:
    """A stream of (read_id, barcode) from Parquet files of (read_id, sequence); reads shorter than the layout stop it."""
    reads = spark.readStream.schema("read_id string, sequence string").parquet(folder)
    return compose_barcode(extract_parts(reads, layout))


def counts(stream: DataFrame) -> DataFrame:
    """Reads of each barcode so far."""
    return stream.groupBy("barcode").agg(F.count("*").alias("reads"))
