"""Counts: anchors, on-target reads, molecules, flag tables, cell calls, coverage, saturation."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quillon.operators.quantiles import quantiles
from quillon.operators.ranges import ROWS, ranked, running
from quillon.sources.tables import materialise
from quillon.operators.reads import primary

#: Mapping quality of on-target reads; least counts and features, and score of a cell, by library.
MIN_MAPQ = 20
FLOORS = {"DNA": (20, 1), "RNA": (200, 1)}
MIN_SCORE, FEW_ROWS = 0.7, 20
#: Caps of the sweep and upper ends of the depth bins; the last is open.
CAPS = (10, 25, 50, 100, 200, 500, 1000)
DEPTH_BINS = (("1-5", 1, 5), ("6-10", 6, 10), ("11-20", 11, 20), ("21-50", 21, 50), ("51-100", 51, 100), ("101-200", 101, 200), ("200+", 201, None))


# anchors and amplicon counts


def positions(reads: DataFrame) -> DataFrame:
    """Reads and mean mapping quality by start, over all mapped alignments."""
    return reads.where("chrom IS NOT NULL").groupBy("chrom", "start").agg(F.count("*").alias("reads"), F.avg("mapping_quality").alias("mean_mapq"))


def modal(reads: DataFrame, place: str) -> DataFrame:
    """The most frequent place of each contig; of several, the smallest."""
    each = reads.where("chrom IS NOT NULL").groupBy("chrom", place).agg(F.count("*").alias("_n"))
    return each.groupBy("chrom").agg(F.max_by(place, F.struct("_n", -F.col(place))).alias(f"modal_{place}"))


def anchored(reads: DataFrame, how: str = "inner") -> DataFrame:
    """reads with the modal start and end of their contig; one row a contig, so Spark broadcasts them while they are small."""
    return reads.join(modal(reads, "start"), "chrom", how).join(modal(reads, "end"), "chrom", how)


def at_anchor() -> Column:
    return (F.col("start") == F.col("modal_start")) | (F.col("end") == F.col("modal_end"))


def on_target(reads: DataFrame, min_mapq: int = MIN_MAPQ) -> DataFrame:
    return anchored(reads).where(primary() & (F.col("mapping_quality") >= min_mapq) & at_anchor()).drop("modal_start", "modal_end")


def amplicon_counts(reads: DataFrame) -> DataFrame:
    return reads.where("barcode IS NOT NULL").groupBy("barcode", "chrom").agg(F.count("*").alias("reads"))


def flag_table(reads: DataFrame, min_mapq: int = MIN_MAPQ) -> DataFrame:
    """Reads of each combination of flags."""
    no = F.lit(False)
    flags = {"is_anchored": F.coalesce(at_anchor(), no), "has_barcode": F.col("barcode").isNotNull(), "mapped": F.col("chrom").isNotNull(), "high_quality_mapped": F.coalesce(F.col("mapping_quality") >= min_mapq, no)}
    return anchored(reads, "left").select(*[c.alias(n) for n, c in flags.items()]).groupBy(*flags).agg(F.count("*").alias("reads"))


def fractions(table: DataFrame, value: str = "reads") -> DataFrame:
    """A flag table with each row's share. The table has a row for each combination only, so its total is one row."""
    total = table.agg(F.sum(value).alias("_all"))
    return table.crossJoin(F.broadcast(total)).withColumn("fraction", F.round(F.col(value) / F.col("_all"), 6)).drop("_all")


def carryover(amplicon: DataFrame, genome: DataFrame, cells: DataFrame, min_mapq: int = MIN_MAPQ) -> DataFrame:
    """Reads aligned to both amplicons and the genome, by flags."""
    both = amplicon.select("read_name", "chrom", "mapping_quality").join(genome.select("read_name", "barcode", "GN", F.col("mapping_quality").alias("genome_mapq")), "read_name")
    both = both.join(cells.select("barcode").distinct().withColumn("_c", F.lit(True)), "barcode", "left")
    no = F.lit(False)
    flags = {"maps_amplicon": F.coalesce(F.col("chrom").isNotNull() & (F.col("mapping_quality") >= min_mapq), no), "maps_gene": F.coalesce((F.col("GN") != "-") & (F.col("genome_mapq") == 255), no), "in_cell": F.coalesce("_c", no)}
    return both.select(*[c.alias(n) for n, c in flags.items()]).groupBy(*flags).agg(F.count("*").alias("reads"))


# molecules and cells


def usable_reads(table: DataFrame, good: list[str], bad: list[str], in_cell: str = "in_cell") -> DataFrame:
    """One row: reads and fraction of the combinations with all good and no bad flags, in cells and in all; 0 if there are none."""
    own = table
    for c in good:
        own = own.where(F.col(c))
    for c in bad:
        own = own.where(~F.col(c))
    zero = lambda c, when: F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0))
    cell = F.col(in_cell)
    return own.agg(zero("reads", F.lit(True)).alias("total_usable_reads"), F.round(zero("fraction", F.lit(True)), 6).alias("fraction_usable_reads"), zero("reads", cell).alias("total_usable_reads_in_cell"), F.round(zero("fraction", cell), 6).alias("fraction_usable_reads_in_cell"))


def pivot_counts(counts: DataFrame, features: list[str], feature: str = "chrom", value: str = "reads") -> DataFrame:
    """A row for each barcode, a column for each of the given features; those without counts have 0. For few features: keep others long."""
    return counts.groupBy("barcode").pivot(feature, features).agg(F.sum(value)).na.fill(0, features)


def most_frequent(df: DataFrame, c: str, n: int = 1) -> DataFrame:
    """The n most frequent values, with how often they occur; of several the least."""
    return df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n")).orderBy(F.desc("n"), c).limit(n)


def last_row(df: DataFrame, *keys: str) -> DataFrame:
    """The row that an ascending sort puts last."""
    return df.orderBy(*[F.desc(k) for k in keys]).limit(1)


def first_rows(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The first n rows in the order of keys, so that a preview doesn't depend on partitions."""
    return df.orderBy(*keys).limit(n)


def gather(df: DataFrame, ranks: list[int], *keys: str) -> DataFrame:
    """The rows at the given ranks, from 1, in the order of keys; a rank given twice gives its row twice."""
    at = df.sparkSession.createDataFrame([(r,) for r in ranks], "_at long")
    placed = ranked(df, "_place", *keys)
    return placed.join(F.broadcast(at), F.col("_place") == F.col("_at")).drop("_place", "_at")


def complete(counts: DataFrame, listed: DataFrame, key: str, value: str) -> DataFrame:
    """A row for every listed key; those without counts have 0, and counts of other keys go."""
    return counts.join(listed.select(key).distinct(), key, "right").withColumn(value, F.coalesce(value, F.lit(0)))


def umi_counts(reads: DataFrame) -> DataFrame:
    """Distinct molecules by barcode and gene."""
    return reads.groupBy("barcode", F.col("GN").alias("gene")).agg(F.count_distinct("UB").alias("counts"))


def barcode_metrics(counts: DataFrame, feature: str, value: str) -> DataFrame:
    return counts.groupBy("barcode").agg(F.count_distinct(feature).alias("n_features"), F.sum(value).alias("total_counts"))


OTSU_BINS = 256


def otsu(lo: int | None, hi: int | None, counts: np.ndarray, floor: int) -> int:
    """Otsu's threshold from the least and the largest value, and how many values there are in each of `OTSU_BINS` bins of log10(value + 1): the first bin with the largest variance between classes."""
    if lo is None:
        return floor
    if lo == hi:
        return max(floor, lo)
    first, last = math.log10(lo + 1), math.log10(hi + 1)
    centre = first + (last - first) * (np.arange(OTSU_BINS) + 0.5) / OTSU_BINS
    total = counts.sum()
    below = np.cumsum(counts)[:-1]
    above = total - below
    sums = np.cumsum(counts * centre)
    with np.errstate(divide="ignore", invalid="ignore"):
        between = below * above * (sums[:-1] / below - (sums[-1] - sums[:-1]) / above) ** 2
    best = int(np.argmax(np.nan_to_num(between, nan=-1.0)))
    return int(min(max(np.rint(10 ** centre[best] - 1), floor), hi))


def otsu_of(df: DataFrame, **floors: int) -> dict[str, int]:
    """otsu() of columns, by their floors: one pass for their ends, one for the bins of all."""
    ends = df.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in floors for f in (F.min, F.max)]).first()
    known = {c: (ends[f"min_{c}"], ends[f"max_{c}"]) for c in floors}
    wide = {c: e for c, e in known.items() if e[0] is not None and e[0] < e[1]}
    bins = {c: np.zeros(OTSU_BINS) for c in floors}
    if wide:
        def place(c: str) -> Column:
            first, last = (math.log10(x + 1) for x in wide[c])
            return F.least(F.lit(OTSU_BINS - 1), F.floor((F.log10(F.col(c) + 1) - first) / F.lit((last - first) / OTSU_BINS))).cast("int")

        each = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), place(c).alias("b")) for c in wide])).alias("x"))
        for r in each.groupBy("x.c", "x.b").agg(F.count("*").alias("n")).collect():  # a row for each bin at most
            bins[r["c"]][max(r["b"], 0)] = r["n"]
    return {c: otsu(*known[c], bins[c], f) for c, f in floors.items()}


def call_cells(metrics: DataFrame, counts_at: Column | int, features_at: Column | int, min_score: float = MIN_SCORE) -> DataFrame:
    """metrics with confidence_score, the mean of two logistic curves, and is_cell."""
    def score(x: str, t: Column | int) -> Column:
        t = t if isinstance(t, Column) else F.lit(float(t))
        return 1 / (1 + F.exp(-2 * F.log10((F.col(x) + 1) / (t + 1))))

    both = (score("total_counts", counts_at) + score("n_features", features_at)) / 2
    return metrics.withColumn("confidence_score", both).withColumn("is_cell", F.col("confidence_score") >= min_score)


def cells(counts: DataFrame, feature: str = "chrom", value: str = "reads", library: str = "DNA") -> DataFrame:
    """Scores and calls of all barcodes."""
    metrics = barcode_metrics(counts, feature, value)
    floor = FLOORS[library]
    at = otsu_of(metrics, total_counts=floor[0], n_features=floor[1])
    return call_cells(metrics, at["total_counts"], at["n_features"])


def force_cells(metrics: DataFrame, k: int) -> DataFrame:
    """The k barcodes with most counts; ties by barcode."""
    return metrics.orderBy(F.desc("total_counts"), "barcode").limit(k)


def confidence_summary(scores: DataFrame) -> DataFrame:
    """Mean and median score of cells and others; a group that is empty has nulls."""
    scores = materialise(scores.select("is_cell", "confidence_score"))
    middle = quantiles(scores, ["is_cell"], "confidence_score", {"median_score": 0.5}).withColumn("median_score", F.round("median_score", 6))
    both = scores.groupBy("is_cell").agg(F.round(F.avg("confidence_score"), 6).alias("mean_score"), F.count("*").alias("barcodes")).join(middle, "is_cell")
    groups = scores.sparkSession.createDataFrame([(True,), (False,)], "is_cell boolean")
    return groups.join(both, "is_cell", "left").withColumn("barcodes", F.coalesce("barcodes", F.lit(0)))


def knee_rank(metrics: DataFrame) -> DataFrame:
    """Rank of barcodes by counts."""
    return ranked(metrics, "rank", "total_counts", "barcode", desc=("total_counts",))


def cumulative(metrics: DataFrame, share: float = 0.9) -> DataFrame:
    """Barcodes by counts, with running sums, as long as these are below the share of all, rounded down."""
    total = metrics.agg(F.sum("total_counts").alias("_all"))
    return running(metrics, "cumulative", "total_counts", "total_counts", "barcode", desc=("total_counts",)).crossJoin(F.broadcast(total)).where(F.col("cumulative") < F.floor(F.col("_all") * share)).drop("_all")


def memberships(gene_cells: DataFrame, amplicon_cells: DataFrame) -> DataFrame:
    """Barcodes found in both, one or neither of the modalities."""
    both = gene_cells.select("barcode", F.col("is_cell").alias("g")).join(amplicon_cells.select("barcode", F.col("is_cell").alias("a")), "barcode", "full")
    g, a = F.coalesce("g", F.lit(False)), F.coalesce("a", F.lit(False))
    kind = F.when(g & a, "double_positive").when(a, "amplicon_only").when(g, "gene_only").otherwise("double_negative")
    return both.groupBy(kind.alias("membership")).agg(F.count("*").alias("barcodes"))


#: Ranks that a rank's bend depends on, on each side: two of the smoothing, one of each derivative.
HALO = 4


def knee_point(metrics: DataFrame, value: str = "total_counts", tie: str = "barcode", block: int = ROWS) -> DataFrame:
    """One row (rank): the sharpest bend of the log-log rank curve, within its inner 1 to 90 percent; null for fewer than 10 rows.

    Ranks lie in blocks, and each block also gets the ranks that its first and last bends depend on, so smoothing and derivatives are windows within blocks.
    """
    curve = materialise(ranked(metrics.select(F.col(value).alias("_v"), F.col(tie).alias("_t")), "rank", "_v", "_t", desc=("_v",)).select("rank", "_v"))
    n = curve.agg(F.max("rank")).first()[0] or 0
    at = F.col("rank") - 1
    own = F.floor(at / block)
    halo = curve.withColumn("_block", F.explode(F.sequence(F.floor(F.greatest(at - HALO, F.lit(0)) / block), F.floor(F.least(at + HALO, F.lit(n - 1)) / block))))
    w = W.partitionBy("_block").orderBy("rank")
    near = lambda c, k: F.lag(c, -k).over(w) if k < 0 else F.lead(c, k).over(w)
    rows = halo.withColumns({"x": F.log10("rank"), "y": F.log10(F.col("_v") + 1)})
    before, after = F.coalesce(near("y", -1), F.col("y")), F.coalesce(near("y", 1), F.col("y"))  # the curve's ends go on as they are
    rows = rows.withColumn("s", (F.coalesce(near("y", -2), before) + before + F.col("y") + after + F.coalesce(near("y", 2), after)) / 5)

    def slope(c: str) -> Column:
        """The derivative by x, from three points of uneven distances, or from two at the ends."""
        lo, hi = F.col("x") - near("x", -1), near("x", 1) - F.col("x")
        mid = -hi / (lo * (lo + hi)) * near(c, -1) + (hi - lo) / (lo * hi) * F.col(c) + lo / (hi * (lo + hi)) * near(c, 1)
        return F.coalesce(mid, (near(c, 1) - F.col(c)) / hi, (F.col(c) - near(c, -1)) / lo)

    rows = rows.withColumn("d", slope("s")).withColumn("dd", slope("d"))
    bend = F.abs("dd") / F.pow(1 + F.col("d") * F.col("d"), 1.5)
    inner = rows.where((F.col("_block") == own) & at.between(int(n * 0.01), int(n * 0.9) - 1) & F.lit(n >= 10))
    return inner.agg(F.max_by("rank", F.struct(bend, -F.col("rank"))).alias("rank"))


def log_bins(df: DataFrame, value: str, n: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Rows in n even bins of log10(value + 1) between its ends, and the bins' centres: n rows come to the driver."""
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    first, last = (math.log10((ends[k] or 0) + 1) for k in ("lo", "hi"))
    counts, width = np.zeros(n), (last - first) / n or 1.0
    at = F.least(F.lit(n - 1), F.floor((F.log10(F.col(value) + 1) - first) / F.lit(width))).cast("int")
    for r in df.where(F.col(value).isNotNull()).groupBy(at.alias("b")).agg(F.count("*").alias("n")).collect():
        counts[max(r["b"], 0)] = r["n"]
    return counts, first + width * (np.arange(n) + 0.5)


def inflection_minimum(counts: np.ndarray, centres: np.ndarray, sigma: float = 2.0, default: float = 100.0) -> float:
    """The count at the first valley behind the highest bin of a smoothed histogram (or the first valley, or a default if there is none)."""
    reach = int(4 * sigma + 0.5)
    bell = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    smooth = np.convolve(np.pad(counts.astype(float), reach, mode="symmetric"), bell / bell.sum(), "valid")
    low = np.flatnonzero((smooth[1:-1] < smooth[:-2]) & (smooth[1:-1] < smooth[2:])) + 1
    if not len(low):
        return default
    after = low[low > int(np.argmax(smooth))]
    return float(10 ** centres[after[0] if len(after) else low[0]])


# caps and coverage


def eligible(merged: DataFrame, filtered: DataFrame, cells: DataFrame) -> DataFrame:
    """Distinct (chrom, barcode, read_name) of mapped reads that passed, in called cells; semi joins, so repeated names on the right multiply nothing."""
    own = merged.where("chrom IS NOT NULL").join(filtered.select("read_name"), "read_name", "left_semi").join(cells.select("barcode"), "barcode", "left_semi")
    return own.select("chrom", "barcode", "read_name").distinct()


def keep_list(reads: DataFrame, cap: int, order: Column, by: tuple[str, ...] = ("chrom", "barcode")) -> DataFrame:
    """At most `cap` reads of each group, the first in an order that depends on the read alone."""
    w = W.partitionBy(*by).orderBy(order, "read_name")
    return reads.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= cap)


def seeded(seed: int, name: str = "read_name") -> Column:
    """An order of reads by a seeded hash."""
    return F.xxhash64(F.col(name), F.lit(seed))


def apply_keep_list(alignments: DataFrame, keep: DataFrame) -> DataFrame:
    """Alignments of the reads on the list, all of each read."""
    return alignments.join(keep.select("read_name"), "read_name", "left_semi")


def subsample_stats(eligible: DataFrame, cap: int) -> DataFrame:
    raw = eligible.groupBy("chrom", "barcode").agg(F.count("*").alias("n_reads_raw"))
    return raw.select("chrom", "barcode", "n_reads_raw", F.least("n_reads_raw", F.lit(cap)).alias("n_reads_used"), (F.col("n_reads_raw") > 0).alias("covered"), (F.col("n_reads_raw") > cap).alias("capped"))


def subsample_summary(stats: DataFrame) -> DataFrame:
    return stats.agg(F.count("*").alias("cell_amplicons"), F.coalesce(F.sum("n_reads_raw"), F.lit(0)).alias("reads_raw"), F.coalesce(F.sum("n_reads_used"), F.lit(0)).alias("reads_used"), F.count_if("capped").alias("capped"))


def per_cell_depth(reads: DataFrame) -> DataFrame:
    return reads.groupBy("chrom", "barcode").agg(F.count_distinct("read_name").alias("n_reads"))


def per_amplicon(depth: DataFrame, cap: int) -> DataFrame:
    """By contig: cells, median and most reads of a cell, and the share of cells below the cap."""
    depth = materialise(depth)
    middle = quantiles(depth, ["chrom"], "n_reads", {"median_reads": 0.5}).select(F.col("chrom").alias("_c"), F.round("median_reads", 6).alias("median_reads"))
    plain = depth.groupBy("chrom").agg(F.count("*").alias("cells"), F.max("n_reads").alias("max_reads"), F.round(F.avg((F.col("n_reads") < cap).cast("int")), 6).alias("fraction_below_cap"))
    return plain.join(middle, F.col("chrom").eqNullSafe(F.col("_c"))).drop("_c")


def depth_quantiles(depth: DataFrame) -> DataFrame:
    """Least, median, nine tenths and most of all groups' reads."""
    ends = {"min_reads": 0.0, "p50": 0.5, "p90": 0.9, "max_reads": 1.0}
    found = quantiles(depth, [], "n_reads", ends)
    return found.select(*[F.round(c, 6).alias(c) if c.startswith("p") else F.col(c).cast("long").alias(c) for c in ends])


def cap_sweep(depth: DataFrame, caps: tuple[int, ...] = CAPS) -> DataFrame:
    """Groups capped and reads removed for each cap, in one pass over the depths."""
    aggs = [F.count("*").alias("_g"), F.sum("n_reads").alias("_r")]
    for n in caps:
        aggs += [F.count_if(F.col("n_reads") > n).alias(f"_c{n}"), F.sum(F.greatest(F.col("n_reads") - n, F.lit(0))).alias(f"_x{n}")]
    row = depth.agg(*aggs)
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("N"), F.col(f"_c{n}").alias("c"), F.coalesce(F.col(f"_x{n}"), F.lit(0)).alias("x")) for n in caps])).alias("s")
    out = row.select("_g", F.coalesce("_r", F.lit(0)).alias("_r"), each)
    pct = lambda a, b: F.round(F.coalesce(F.try_divide(100.0 * a, b), F.lit(0.0)), 4)
    return out.select("s.N", F.col("s.c").alias("n_capped"), pct(F.col("s.c"), F.col("_g")).alias("pct_capped"), F.col("_r").alias("reads_total"), F.col("s.x").alias("reads_removed"), pct(F.col("s.x"), F.col("_r")).alias("pct_removed"))


def _binned(value: Column, bins) -> Column:
    return reduce(lambda c, b: c.when(value <= b[2], b[0]) if b[2] is not None else c.otherwise(b[0]), bins[1:], F.when(value <= bins[0][2], bins[0][0]))


def depth_histogram(depth: DataFrame, bins=DEPTH_BINS) -> DataFrame:
    """Groups in each bin, with percent and running percent; bins without any have 0."""
    spark = depth.sparkSession
    listed = spark.createDataFrame([(i, b[0]) for i, b in enumerate(bins)], "bin_order int, bin string")
    n = depth.groupBy(_binned(F.col("n_reads"), bins).alias("bin")).agg(F.count("*").alias("_n"))
    rows = listed.join(n, "bin", "left").withColumn("n_cell_amplicons", F.coalesce("_n", F.lit(0)))
    upto, whole = W.orderBy("bin_order").rowsBetween(W.unboundedPreceding, 0), W.orderBy("bin_order").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)  # as many rows as bins
    total = F.sum("n_cell_amplicons").over(whole)
    return rows.select("bin_order", "bin", "n_cell_amplicons", F.round(F.coalesce(F.try_divide(100.0 * F.col("n_cell_amplicons"), total), F.lit(0.0)), 4).alias("pct"), F.round(F.coalesce(F.try_divide(100.0 * F.sum("n_cell_amplicons").over(upto), total), F.lit(0.0)), 4).alias("cumulative_pct"))


def log_edges(cap: int, top: int, per_decade: int = 10) -> list[int]:
    """Integer edges spaced evenly in logarithms, one of them the cap."""
    lo, hi = math.ceil(math.log10(max(cap, 1)) * per_decade), math.ceil(math.log10(max(top / max(cap, 1), 1)) * per_decade) + 1
    return sorted({max(1, round(cap * 10 ** (k / per_decade))) for k in range(-lo, hi + 1)})


def log_histogram(depth: DataFrame, cap: int, top: int, value: str = "n_reads") -> DataFrame:
    """Groups between neighbouring log_edges, lower edge included."""
    edges = log_edges(cap, top)
    at = reduce(lambda c, e: c.when(F.col(value) >= e, F.lit(e)), reversed(edges[:-1]), F.when(F.col(value) >= edges[-1], F.lit(edges[-1])))
    return depth.groupBy(F.coalesce(at, F.lit(0)).alias("edge")).agg(F.count("*").alias("n_cell_amplicons"), F.count_if(F.col(value) >= cap).alias("at_cap"))


def complete_grid(counts: DataFrame, row: str, bins: list[str], bin_column: str, value: str) -> DataFrame:
    """Every row with every bin; those without counts have 0."""
    grid = counts.select(row).distinct().withColumn(bin_column, F.explode(F.array(*map(F.lit, bins))))
    return grid.join(counts, [row, bin_column], "left").withColumn(value, F.coalesce(value, F.lit(0)))


COUNT_BINS = (("0", 0, 0), ("1-10", 1, 10), ("11-100", 11, 100), ("101-1000", 101, 1000), ("1000+", 1001, None))


def binned_counts(counts: DataFrame, row: str = "chrom", value: str = "reads", bins=COUNT_BINS) -> DataFrame:
    """Barcodes of each row by size of their counts, all bins present."""
    n = counts.groupBy(row, _binned(F.col(value), bins).alias("bin")).agg(F.count("*").alias("barcodes"))
    return complete_grid(n, row, [b[0] for b in bins], "bin", "barcodes")


def contig_coverage(reads: DataFrame) -> DataFrame:
    """Mean depth and breadth of each contig, from starts and ends: depth changes only there, so no base is a row."""
    edges = reads.select("chrom", F.explode(F.array(F.struct(F.col("start").alias("p"), F.lit(1).alias("d")), F.struct(F.col("end").alias("p"), F.lit(-1).alias("d")))).alias("e")).groupBy("chrom", "e.p").agg(F.sum("e.d").alias("d"))
    w = W.partitionBy("chrom").orderBy("p")
    runs = edges.select("chrom", (F.lead("p").over(w) - F.col("p")).alias("n"), F.sum("d").over(w).alias("depth"))
    return runs.groupBy("chrom").agg(F.coalesce(F.sum(F.col("n") * F.col("depth")), F.lit(0)).alias("bases"), F.coalesce(F.sum(F.when(F.col("depth") > 0, F.col("n"))), F.lit(0)).alias("covered"))


def whole_contigs(contigs: DataFrame) -> DataFrame:
    """One interval over all of each contig (feature, length)."""
    return contigs.select(F.col("feature").alias("contig"), F.lit(0).cast("long").alias("start"), F.col("length").cast("long").alias("end"))


def flag_statistics(reads: DataFrame) -> DataFrame:
    """Alignments by flag bit."""
    bits = {"paired": 1, "unmapped": 4, "secondary": 256, "duplicates": 1024, "supplementary": 2048}
    return reads.agg(F.count("*").alias("total"), *[F.count_if(F.col("flags").bitwiseAND(b) != 0).alias(n) for n, b in bits.items()], F.count_if(primary()).alias("primary_reads"))


# saturation


def saturation_depths(total: int, n_cells: int, below: int | None = None) -> list[int]:
    """Mean reads a cell: all, multiples of 5000 above 5000 in falling order, then 2500, 1000 and 500; with below, samples of fewer reads a cell only."""
    top = total // n_cells if n_cells else 0
    end = top if below is None else min(top, below)
    return [top, *range((end - 1) // 5000 * 5000, 5000, -5000), *[d for d in (2500, 1000, 500) if d < end]]


def _first_sample(sizes: list[int]):
    """Adds the number of the first sample that has a rank, in the order of the samples' sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upto = np.array(sizes, np.int64)
        for b in batches:
            at = b.schema.get_field_index("_rank")
            yield b.set_column(at, "_j", pa.array(np.searchsorted(upto, b.column(at).to_numpy(zero_copy_only=False)).astype(np.int64)))

    return run


def saturation_curve(reads: DataFrame, depths: list[int], n_cells: int, order: Column, total: int | None = None) -> DataFrame:
    """Median molecules and genes a cell, and saturation, at each depth. Samples are the first reads of one order, so they are nested and of exact size; reads of one name follow by what is counted of them, so any partitioning gives the same.
    A molecule is in all samples from the first that has a read of it on, so each is counted once, there, and counts are summed up over the depths: rows are those of the reads, however many depths there are, and one for each cell and depth.
    With total, the number of reads, the first depth stands for all of them, also those that its product with n_cells leaves over."""
    key = ["barcode", "GN", "UB", "mapping_quality"]
    at = ranked(reads.select("read_name", *key, order.alias("_order")), "_rank", "_order", "read_name", *key)
    size = [d * n_cells for d in depths] if total is None else [total, *[d * n_cells for d in depths[1:]]]
    samples = sorted(zip(size, depths, strict=True))
    first = at.groupBy(*key).agg(F.min("_rank").alias("_rank"), F.count("*").alias("_reads"))
    kinds = StructType([*[first.schema[c] for c in key], StructField("_j", LongType()), first.schema["_reads"]])
    held = materialise(first.mapInArrow(_first_sample([n for n, _ in samples]), kinds))
    n_reads = held.agg(F.sum("_reads")).first()[0] or 0
    known = lambda *c: reduce(Column.__and__, [F.col(x).isNotNull() for x in c])
    new = lambda df, *c: df.where(known(*c))
    seen = held.where(F.col("_j") < len(samples))
    molecules = seen.groupBy("barcode", "GN", "UB").agg(F.min("_j").alias("_j"))
    genes = molecules.groupBy("barcode", "GN").agg(F.min("_j").alias("_j"))
    cells = genes.groupBy("barcode").agg(F.min("_j").alias("_j")).withColumn("_j", F.explode(F.sequence("_j", F.lit(len(samples) - 1).cast("long"))))
    counts = lambda df, umis, genes: df.select("barcode", "_j", F.lit(umis).alias("umis"), F.lit(genes).alias("genes"))
    each = counts(new(molecules, "GN", "UB"), 1, 0).union(counts(new(genes, "GN"), 0, 1)).union(counts(cells, 0, 0)).groupBy("barcode", "_j").agg(F.sum("umis").alias("umis"), F.sum("genes").alias("genes"))
    upto = W.partitionBy("barcode").orderBy("_j").rowsBetween(W.unboundedPreceding, 0)  # a row for each depth
    cell = materialise(each.select(F.col("_j"), *[F.sum(c).over(upto).alias(c) for c in ("umis", "genes")]))
    cell = quantiles(cell, ["_j"], "umis", {"median_counts_per_cell": 0.5}).join(quantiles(cell, ["_j"], "genes", {"median_genes_per_cell": 0.5}), "_j")
    every = reads.sparkSession.createDataFrame([(j, d, min(n, n_reads)) for j, (n, d) in enumerate(samples)], "_j long, depth int, _n long")
    whole = every.join(new(seen, *key).groupBy("_j").agg(F.count("*").alias("_d")), "_j", "left").withColumn("_d", F.sum(F.coalesce("_d", F.lit(0))).over(W.orderBy("_j").rowsBetween(W.unboundedPreceding, 0)))  # a row for each depth
    millionths = F.round((1 - F.col("_d") / F.col("_n")) * 1e6, 0)  # DuckDB's way to round: halves after the product
    return cell.join(whole, "_j").select("depth", "median_counts_per_cell", "median_genes_per_cell", (millionths / 1e6).alias("saturation"))


def saturation_of(reads: DataFrame, cells: DataFrame, order: Column, below: int | None = None) -> DataFrame:
    """saturation_curve of the cells' reads at saturation_depths of their number: a row of zeros, one of all reads, and the depths below. cells has each barcode once."""
    own = reads.join(cells.select("barcode"), "barcode", "left_semi")
    n_cells, total = cells.count(), own.count()
    zeros = reads.sparkSession.range(1).select(F.lit(0).alias("depth"), *[F.lit(0.0).alias(c) for c in ("median_counts_per_cell", "median_genes_per_cell", "saturation")])
    return zeros.union(saturation_curve(own, saturation_depths(total, n_cells, below), n_cells, order, total))


def saturation_at(curve: DataFrame, depths: tuple[int, ...] = (10000, 20000)) -> DataFrame:
    return curve.agg(*[F.max(F.when(F.col("depth") == d, F.col("saturation"))).alias(f"saturation_{d}") for d in depths])


def exact_sample(df: DataFrame, n: int, order: Column, tie: str) -> DataFrame:
    """Exactly n rows (all, if there are fewer); a larger sample holds a smaller one."""
    return df.orderBy(order, tie).limit(n)
