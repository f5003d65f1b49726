"""Reads: barcode parts, whitelists, mapping, demultiplexing, filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.columns import col

#: First base, from 1, and bases of each part.
LAYOUT_DNA = {"D": (1, 8), "C": (13, 8), "B": (25, 8), "A": (37, 8)}
LAYOUT_RNA = LAYOUT_DNA | {"primer": (45, 18), "umi": (63, 8)}
PARTS = ("D", "C", "B", "A")
NOT_PRIMARY = 0x900


def extract_parts(reads: DataFrame, layout: dict[str, tuple[int, int]], sequence: str = "sequence", strict: bool = True) -> DataFrame:
    """The parts of a layout as columns in upper case; a read too short for it is an error (strict) or gives short parts."""
    need = max(a + n - 1 for a, n in layout.values())
    s = col(sequence)
    if strict:
        s = F.when(F.length(s) >= need, s).otherwise(F.raise_error(F.concat(F.lit(f"read shorter than {need} bases: "), F.coalesce(s, F.lit("null")))).cast("string"))
    return reads.select(*[c for c in reads.columns if c != sequence], *[F.upper(F.substring(s, a, n)).alias(p) for p, (a, n) in layout.items()])


def layout_of(parts: list[dict]) -> dict[str, tuple[int, int]]:
    """A layout from declared parts (name, start from 0, length)."""
    return {p["name"]: (p["start"] + 1, p["length"]) for p in parts}


def whitelist_filter(reads: DataFrame, whitelist: DataFrame, parts: tuple[str, ...] = PARTS) -> DataFrame:
    """Reads of which every part is listed for its position. Four semi joins: Spark broadcasts lists that are small and shuffles others."""
    for p in parts:
        own = whitelist.where(F.col("barcode_position") == p).select(F.col("barcode").alias(p)).distinct()
        reads = reads.join(own, p, "left_semi")
    return reads


def compose_barcode(reads: DataFrame, parts: tuple[str, ...] = PARTS) -> DataFrame:
    """barcode of the parts, null if one is; the parts go."""
    whole = reduce(lambda a, b: a & b, [F.col(p).isNotNull() for p in parts])
    kept = [c for c in reads.columns if c not in parts and c != "barcode"]
    return reads.select(*kept, F.when(whole, F.concat_ws("_", *parts)).alias("barcode"))


def merge_reads(alignments: DataFrame, mapping: DataFrame, unique: bool = False) -> DataFrame:
    """Alignments with their read's barcode. unique: a read with two barcodes is an error instead of two rows."""
    if unique:
        mapping = assert_unique(mapping, "read_name")
    return alignments.join(mapping, "read_name", "left")


def demultiplex(mapping: DataFrame, sheet: DataFrame) -> DataFrame:
    """Reads with the sample of their last barcode part."""
    key = F.get(F.split("barcode", "_"), F.lit(3))
    return mapping.withColumn("_a", key).join(sheet.select(F.col("barcode").alias("_a"), "sample_name"), "_a").drop("_a")


def take_reads(reads: DataFrame, names: DataFrame, key: str = "read_id") -> DataFrame:
    """The reads on a list of names, as when a file is dealt to samples."""
    return reads.join(names.select(F.col(names.columns[0]).alias(key)), key, "left_semi")


def trimmed(reads: DataFrame, n: int = 100) -> DataFrame:
    """Reads cut to their first n bases, and qualities with them."""
    return reads.withColumns({c: F.substring(c, 1, n) for c in ("sequence", "quality") if c in reads.columns})


def combined(left: DataFrame, right: DataFrame, key: str = "sample_name") -> DataFrame:
    """Every pair of rows of one sample."""
    return left.join(right, key)


def joined_or_empty(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Rows of either side; values of a sample come as a list, empty where the right side has none."""
    lists = right.groupBy(key).agg(F.sort_array(F.collect_list(value)).alias(value))
    return left.join(lists, key, "full").withColumn(value, F.coalesce(value, F.array().cast(dict(lists.dtypes)[value])))


def sample_index(sheet: DataFrame, plate: DataFrame) -> DataFrame:
    """The sheet's wells (joined by semicolons) with the plate's barcodes; a well that the plate lacks has a null barcode."""
    wells = sheet.select("*", F.explode(F.split("demultiplexing_indices", ";")).alias("_well")).drop("demultiplexing_indices")
    return plate.join(wells, plate["index"] == wells["_well"], "right").select(plate["barcode"], F.col("_well").alias("index"), *[c for c in wells.columns if c != "_well"])


def primary(flags: str = "flags") -> Column:
    return F.col(flags).bitwiseAND(NOT_PRIMARY) == 0


def valid_rna(reads: DataFrame, unique_mapq: int = 255) -> DataFrame:
    """Reads with a gene, a molecule, a unique place and a barcode."""
    return reads.where((F.col("GN") != "-") & (F.col("UB") != "-") & (F.col("mapping_quality") == unique_mapq) & F.col("barcode").isNotNull())


def assert_unique(df: DataFrame, *keys: str) -> DataFrame:
    """df, with an error at run time where two rows share the keys."""
    more = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select(F.raise_error(F.concat(F.lit(f"repeated {', '.join(keys)}: "), F.concat_ws(",", *keys))).cast("boolean").alias("_bad"))
    return df.join(F.broadcast(more.limit(1)), F.lit(True) & F.col("_bad"), "left_anti")


def normalise_contigs(alignments: DataFrame, contig: str = "chrom") -> DataFrame:
    """Read table of amplicon alignments: contig names normalised, name as read_name, mate columns gone."""
    from quillon.functions.columns import plain_contig

    out = alignments.withColumn(contig, plain_contig(contig)).drop("mate_chrom", "mate_start")
    return out.withColumnRenamed("name", "read_name")


def reads_per_step(raw: DataFrame, whitelist: DataFrame) -> DataFrame:
    """Boolean per part, whether it is listed, all of them, and reads of each combination."""
    for p in PARTS:
        own = whitelist.where(F.col("barcode_position") == p).select(F.col("barcode").alias(p)).distinct().withColumn(f"valid_{p}", F.lit(True))
        raw = raw.join(own, p, "left")
    flags = [F.coalesce(f"valid_{p}", F.lit(False)).alias(f"valid_{p}") for p in PARTS]
    return raw.select(*flags).withColumn("valid_all", reduce(lambda a, b: a & b, [F.col(f"valid_{p}") for p in PARTS])).groupBy(*[f"valid_{p}" for p in PARTS], "valid_all").agg(F.count("*").alias("reads"))
