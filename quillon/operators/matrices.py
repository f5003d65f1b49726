"""Matrices of cells by sites or events, in long form: entries with row and column numbers, tables of rows (obs) and columns (var), layers as triplets or dense rows.

An entry that is missing means 0 in a layer of counts, and the sentinel in a layer of calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.functions import columns as C
from quillon.operators import variants as V
from quillon.operators.ranges import ranked
from quillon.operators.reads import assert_unique

#: Code and quality of entries without a call, and the layers.
NO_CALL, NO_QUALITY = -1, float("nan")
SNV_LAYERS, INDEL_LAYERS = ("AD_A", "AD_C", "AD_G", "AD_T", "AD_N", "DP"), ("AD", "DP", "REF_AD", "OTHER_INDEL")


def rows_of(entries: DataFrame) -> DataFrame:
    """(barcode, row): cells numbered from 0 in their order."""
    return ranked(entries.select("barcode").distinct(), "_i", "barcode").select("barcode", (F.col("_i") - 1).alias("row"))


def measured_columns(axis: DataFrame, composition: DataFrame) -> DataFrame:
    """The axis' positions that reads reached, numbered anew from 0 as col; pos counts from 1. The axis may have an index, which isn't used."""
    return ranked(V.measured(axis, composition).drop("column_index"), "_i", "feature", "pos").withColumn("col", F.col("_i") - 1).drop("_i")


def _checked(df: DataFrame, *keys: str) -> DataFrame:
    """Triplets of one place would add up, so they must not repeat."""
    return assert_unique(df, *keys)


def snv_entries(composition: DataFrame, rows: DataFrame, columns: DataFrame, called: DataFrame) -> DataFrame:
    """An entry for each cell and measured position, with its place in the matrix, all layers and the call; a position that the axis lacks is an error, as is a repeated key on any side."""
    place = _checked(columns.select("feature", (F.col("pos") - 1).alias("pos_local_0based"), "col"), *V.SITE)
    calls = _checked(called.select("barcode", *V.SITE, "gt_code", F.col("gq").cast("float").alias("gq")), "barcode", *V.SITE)
    out = composition.join(rows, "barcode", "left").join(place, list(V.SITE), "left").join(calls, ["barcode", *V.SITE], "left")
    known = F.when(F.col("col").isNotNull(), F.col("col")).otherwise(F.raise_error(F.concat(F.lit("position without a reference: "), F.col("feature"), F.lit(":"), F.col("pos_local_0based").cast("string"))).cast("long"))
    return out.withColumns({"col": known, "gt_code": F.coalesce("gt_code", F.lit(NO_CALL).cast("tinyint")), "gq": F.coalesce("gq", F.lit(NO_QUALITY).cast("float"))})


def snv_obs(entries: DataFrame) -> DataFrame:
    """By cell: depth, sites covered, mean and median depth of these, sites that show another base, and their share."""
    return V.cell_summary(entries).withColumnsRenamed({"total": "total_depth", "covered": "n_sites_covered", "mean": "mean_site_depth", "median": "median_site_depth", "n_signal": "n_sites_nonref", "fraction_signal": "fraction_sites_nonref"})


def snv_var(columns: DataFrame, catalog: DataFrame, entries: DataFrame) -> DataFrame:
    """By column: the position, what the callers found there, and cells that cover it or show another base."""
    found = V.snv_site_evidence(catalog).withColumnsRenamed({"chrom": "feature", "site_dp": "pseudobulk_depth", "site_ad": "pseudobulk_nonref_count", "pseudobulk_vaf": "pseudobulk_nonref_vaf", "top_alt": "pseudobulk_major_nonref"})
    cells = entries.groupBy("col").agg(F.count_if(F.col("DP") > 0).alias("n_cells_covered"), F.count_if(F.col("nonref") > 0).alias("n_cells_nonref"))
    out = columns.join(found, ["feature", "pos"], "left").join(cells, "col", "left")
    return out.withColumns({"is_candidate_variant": F.col("n_callers").isNotNull(), "n_callers": F.coalesce("n_callers", F.lit(0)), "is_measured": F.lit(True), "n_cells_covered": F.coalesce("n_cells_covered", F.lit(0)), "n_cells_nonref": F.coalesce("n_cells_nonref", F.lit(0))})


def declared_targets(axis: DataFrame, columns: DataFrame) -> DataFrame:
    """Every position that the references declare a target, and whether reads reached it."""
    seen = columns.select("feature", "pos").withColumn("is_measured", F.lit(True))
    return axis.where("is_target").select("feature", "pos").join(seen, ["feature", "pos"], "left").withColumn("is_measured", F.coalesce("is_measured", F.lit(False)))


def indel_columns(alleles: DataFrame) -> DataFrame:
    """Called insertions and deletions as events, numbered from 0 as col; events that share a name are an error."""
    events = V.indel_event(alleles.withColumn("pos", F.col("pos_local_0based") + 1))
    return ranked(_checked(events, "event_id"), "_i", "feature", "pos_local_0based", "ref", "alt").withColumn("col", F.col("_i") - 1).drop("_i", "pos")


def indel_entries(coverage: DataFrame, rows: DataFrame, columns: DataFrame, long: DataFrame, called: DataFrame) -> DataFrame:
    """An entry for each event at an anchor that a cell covers, carriers or not. Support and calls are those of the event; calls without a read of either allele are none."""
    key = ["barcode", *V.ALLELE]
    support = _checked(long.select(*key, "alt_reads"), *key)
    calls = _checked(called.where("ref_reads + alt_reads > 0").select(*key, "gt_code", F.col("gq").cast("float").alias("gq")), *key)
    out = coverage.join(rows, "barcode", "left").join(columns.select(*V.ALLELE, "col"), list(V.SITE)).join(support, key, "left").join(calls, key, "left")
    ad = F.coalesce("alt_reads", F.lit(0))
    return out.select("barcode", *V.ALLELE, "row", "col", ad.alias("AD"), F.col("total_reads").alias("DP"), F.col("ref_reads").alias("REF_AD"), (F.col("total_reads") - F.col("ref_reads") - ad).alias("OTHER_INDEL"),
                      F.round(C.ratio(ad, "total_reads"), 6).alias("X"), F.coalesce("gt_code", F.lit(NO_CALL).cast("tinyint")).alias("gt_code"), F.coalesce("gq", F.lit(NO_QUALITY).cast("float")).alias("gq"))


def indel_obs(entries: DataFrame, signatures: DataFrame) -> DataFrame:
    """By cell: reads over distinct anchors, events covered and supported, reads that support one, mean and median depth of an event."""
    own = V.cell_summary(entries, "DP", "AD").drop("total").withColumnsRenamed({"covered": "n_events_covered", "mean": "mean_event_depth", "median": "median_event_depth", "n_signal": "n_events_supported", "fraction_signal": "fraction_events_supported"})
    reads = entries.groupBy("barcode").agg(F.sum("AD").alias("total_indel_support"))
    return V.anchor_depth(signatures).select("barcode", F.col("anchor_depth").alias("total_depth")).join(reads, "barcode").join(own, "barcode", "left").na.fill(0)


def indel_var(columns: DataFrame, catalog: DataFrame, entries: DataFrame) -> DataFrame:
    """By event: what the callers found, cells that cover its anchor and that carry it. event_qc_pass is null where no cell covers it; whether an indel is a target isn't known."""
    found = V.indel_site_evidence(catalog).select(F.col("chrom").alias("feature"), (F.col("pos") - 1).alias("pos_local_0based"), "ref", "alt", F.col("dp").alias("pseudobulk_depth"), F.col("ad").alias("pseudobulk_nonref_count"), F.col("vaf").alias("pseudobulk_nonref_vaf"))
    cells = entries.groupBy("col").agg(F.count_if(F.col("DP") > 0).alias("n_cells_covered"), F.count_if(F.col("AD") > 0).alias("n_cells_indel"))
    out = columns.join(found, list(V.ALLELE), "left").join(cells, "col", "left").na.fill(0, ["n_cells_covered", "n_cells_indel"])
    name = F.concat(F.col("feature"), F.lit(":"), F.col("pos_local_0based").cast("string"), F.lit(":"), F.col("ref"), F.lit(">"), F.col("alt"))
    return out.withColumns({"event_len": F.abs(F.length("alt") - F.length("ref")), "is_candidate_indel": F.lit(True), "indel_feature": name, "event_qc_pass": F.when(F.col("n_cells_covered") > 0, F.col("n_cells_indel") > 0), "is_measured": F.col("n_cells_covered") > 0, "is_target_site": F.lit(None).cast("boolean")})


def triplets(entries: DataFrame, *layers: str) -> DataFrame:
    """(layer, row, col, value) of what isn't 0: a sparse matrix for each layer."""
    return entries.select("row", "col", *[F.col(x).cast("double").alias(x) for x in layers]).unpivot(["row", "col"], list(layers), "layer", "value").where("value <> 0")


def dense(entries: DataFrame, layer: str, n_columns: int, missing: float) -> DataFrame:
    """(row, values): of each row the values of all columns, those without an entry as `missing`; a row whose col is null has no entry. A row is its sorted entries with the gaps between neighbours filled.

    An entry beyond the columns, or two of one place, are an error.
    """
    held = entries.groupBy("row").agg(F.sort_array(F.collect_list(F.when(F.col("col").isNotNull(), F.struct(F.col("col").cast("long").alias("col"), F.col(layer).cast("double").alias("v"))))).alias("e"))
    gap = lambda n: F.array_repeat(F.lit(missing).cast("double"), n.cast("int"))
    end = F.lit(n_columns).cast("long")
    first = F.coalesce(F.get("e", F.lit(0))["col"], end)
    filled = F.transform("e", lambda x, i: F.concat(F.array(F.coalesce(x["v"], F.lit(missing))), gap(F.coalesce(F.get("e", i + 1)["col"], end) - x["col"] - 1)))
    out = F.concat(gap(first), F.flatten(filled))
    return held.select("row", F.when(F.size(out) == n_columns, out).otherwise(F.raise_error(F.lit("entries beyond the columns, or two of one place")).cast("array<double>")).alias("values"))
