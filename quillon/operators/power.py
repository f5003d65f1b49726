"""What depth can show: callable cells, false carriers, the least clone, as one long table and as text.

Sums over cells and sites are Spark aggregates. What a depth can show is worked out once for each distinct depth, in the executors and exactly, however deep it is; the closing arithmetic is over single rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.functions.columns import EPS, GQ_CAP, MIN_GQ, RHO
from quillon.operators.variants import SITE, measure_ado

#: How the overdispersion was found, what can limit a run, and defaults of the report.
CALIBRATIONS = ("truth-calibrated", "inherited")
BULK, NOISE, DEPTH, DROPOUT, COUNTING = "bulk discovery floor", "eps (false carrier-cell noise at the chosen GQ)", "per-cell depth", "allelic dropout", "Poisson counting"
THETA_HET, FAMILY_ALPHA, MIN_CALLERS, BULK_MIN_VAF, BULK_MIN_ALT, DEFAULT_ADO, ADO_BAND, CALLABLE_TARGET = 0.5, 0.05, 2, 1e-4, 20, 0.14, 0.1, 0.9
SCHEMA = "sample string, quantity string, value double, text string, unit string, provenance string"


def _steps(start: float, n: int) -> np.ndarray:
    """Logarithms of the gamma function at start, start + 1, ..., start + n."""
    return math.lgamma(start) + np.concatenate(([0.0], np.cumsum(np.log(start + np.arange(n))))) if n else np.array([math.lgamma(start)])


def _log_beta(n: int, theta: float, rho: float) -> np.ndarray:
    """Logarithms of the chance of one order of k of n, for every k."""
    s = (1 - rho) / rho
    a, b = theta * s, (1 - theta) * s
    up, down = _steps(a, n), _steps(b, n)
    return up + down[::-1] - math.lgamma(n + s) - (math.lgamma(a) + math.lgamma(b) - math.lgamma(s))


def pmf(n: int, theta: float, rho: float = RHO) -> np.ndarray:
    """Chances of 0 to n of n."""
    if theta in (0.0, 1.0):
        return (np.arange(n + 1) == n * theta).astype(float)
    f = _steps(1.0, n)
    return np.exp(f[n] - f - f[::-1] + _log_beta(n, theta, rho))


def calls(n: int, eps: float = EPS, rho: float = RHO, het: float = THETA_HET) -> tuple[np.ndarray, np.ndarray]:
    """Genotype (0: reference, 1: both, 2: alternative) and quality of every k of n."""
    if n <= 0:
        return np.zeros(1, int), np.zeros(1)
    ls = np.stack([_log_beta(n, t, rho) for t in (eps, het, 1 - eps)]) / math.log(10)
    pls = np.round(-10 * (ls - ls.max(0)), 9)
    return pls.argmin(0), np.minimum(GQ_CAP, np.sort(pls, 0)[1])


def best_quality(n: int, state: int, eps: float = EPS, rho: float = RHO, het: float = THETA_HET) -> float:
    """The best quality with which n reads can show a state; 0 if they can't."""
    g, q = calls(n, eps, rho, het)
    return float(q[g == state].max(initial=0.0)) if n > 0 else 0.0


def depth_for(quality: float, state: int, eps: float = EPS, rho: float = RHO, het: float = THETA_HET, most: int = 5000) -> int | None:
    """The least depth at which a state can reach a quality; it is looked for one by one up to 64, then by doubling up to `most` and back."""
    n = 1
    while n <= most and best_quality(n, state, eps, rho, het) < quality:
        n = n * 2 if n >= 64 else n + 1
    if n > most:
        return None
    while n > 1 and best_quality(n - 1, state, eps, rho, het) >= quality:
        n -= 1
    return n


def false_carriers(n: int, min_gq: float = MIN_GQ, eps: float = EPS, rho: float = RHO, het: float = THETA_HET) -> float:
    """Chance that a cell without the allele is called a carrier."""
    if n <= 0:
        return 0.0
    g, q = calls(n, eps, rho, het)
    return float(pmf(n, eps, rho)[(g != 0) & (q >= min_gq)].sum())


def poisson_tail(c: int, mean: float) -> float:
    """Chance of c or more: terms from c up where they fall, or one less those below c."""
    if c <= 0:
        return 1.0
    if mean <= 0:
        return 0.0
    up = c > mean
    k = c if up else c - 1
    term, total = math.exp(k * math.log(mean) - mean - math.lgamma(k + 1)), 0.0
    while term > 1e-17 * total and k >= 0:
        total += term
        term, k = (term * mean / (k + 1), k + 1) if up else (term * k / mean, k - 1)
    return total if up else max(0.0, 1 - total)


def poisson_count(mean: float, alpha: float) -> int:
    """The least count of 1 or more whose tail is alpha or less, found by doubling and halving."""
    if alpha <= 0 and mean > 0:
        raise ValueError("no count has a tail of nothing")
    lo, hi = 0, 1
    while poisson_tail(hi, mean) > alpha:
        lo, hi = hi, 2 * hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if poisson_tail(mid, mean) > alpha else (lo, mid)
    return hi


def by_depth(depths: DataFrame, min_gq: float = MIN_GQ, eps: float = EPS, rho: float = RHO, het: float = THETA_HET) -> DataFrame:
    """depths (n) with rate of false carriers, and the best qualities hom and het."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(n, false_carriers(n, min_gq, eps, rho, het), best_quality(n, 0, eps, rho, het), best_quality(n, 1, eps, rho, het)) for n in f["n"].tolist()]
            yield pd.DataFrame(rows, columns=["n", "rate", "hom", "het"])

    return depths.select(F.col("n").cast("long")).distinct().mapInPandas(run, "n long, rate double, hom double, het double")


def compute(called: DataFrame, sample: str = "", eps: float = EPS, rho: float = RHO, min_gq: float = MIN_GQ, het: float = THETA_HET, bulk_min_vaf: float = BULK_MIN_VAF, bulk_min_alt: int = BULK_MIN_ALT, family_alpha: float = FAMILY_ALPHA, min_callers: int = MIN_CALLERS, ado: float | None = None, gq_calibration: str = "inherited") -> dict:
    """All quantities of the report; those of an empty table are null."""
    if gq_calibration not in CALIBRATIONS:
        raise ValueError(f"gq_calibration is one of {CALIBRATIONS}")
    notes = []
    if gq_calibration == "inherited":
        notes.append("Qualities rest on another run's overdispersion; genotypes and outlier odds don't, but qualities, callable shares and depth targets are too good if this sample varies more.")
    work = called.withColumn("n", F.coalesce("ref_reads", F.lit(0)) + F.coalesce("alt_reads", F.lit(0)))
    has_gq, has_callers = "gq" in called.columns, "n_callers" in called.columns
    one = work.agg(F.count_distinct("barcode").alias("cells"), F.count("*").alias("all"), F.percentile("n", F.array(*map(F.lit, (0.1, 0.25, 0.5, 0.75, 0.9)))).alias("q"), F.avg("n").alias("mean"), F.max("n").alias("max"),
                   (F.avg((F.coalesce("gq", F.lit(0.0)) >= min_gq).cast("int")) if has_gq else F.lit(None)).alias("passed")).first()
    shown = by_depth(work.select("n"), min_gq, eps, rho, het)
    site = work.join(shown.select("n", "rate"), "n").groupBy(*SITE).agg(F.sum("rate").alias("lam"), F.max(F.coalesce("n_callers", F.lit(0)) if has_callers else F.lit(0)).alias("support"))
    per = site.agg(F.count("*").alias("sites"), F.median("lam").alias("median"), F.max("lam").alias("max"), F.sum("lam").alias("sum"), *[f(F.when(F.col("support") >= min_callers, F.col("lam"))).alias(f"few_{f.__name__}") for f in (F.count, F.max, F.sum)]).first()
    can = work.groupBy("n").agg(F.count("*").alias("c")).join(shown, "n").agg(F.sum(F.when(F.col("hom") >= min_gq, F.col("c"))).alias("hom"), F.sum(F.when(F.col("het") >= min_gq, F.col("c"))).alias("het")).first()
    total, sites = one["all"], per["sites"]
    share = {k: (can[k] or 0) / total if total else 0.0 for k in ("hom", "het")}
    if total and not share["het"]:
        notes.append("No depth of this run can show a heterozygote at the target quality.")
    c_min = poisson_count(per["max"] or 0.0, family_alpha / max(sites, 1))
    scoped = has_callers and per["few_count"] > 0
    if ado is not None:
        dropout, measured, ado_sites, ado_seen = ado, False, 0, 0
        notes.append(f"Allelic dropout was given as {ado:.3f}.")
    else:
        found = measure_ado(work).first()
        ado_sites, ado_seen, measured = found["sites"], found["observations"], found["ado_rate"] is not None
        dropout = found["ado_rate"] if measured else DEFAULT_ADO
        if not measured:
            notes.append(f"Allelic dropout can't be measured on {ado_sites} sites and {ado_seen} cells; {DEFAULT_ADO:.3f} is assumed.")
    over = lambda a, b: a / b if b else math.inf
    counting = over(c_min, (1 - dropout) * share["het"])
    by_vaf, by_reads = bulk_min_vaf * one["cells"] / het, over(bulk_min_alt, het * (one["mean"] or 0.0))
    bulk = over(max(by_vaf, by_reads), 1 - dropout) if dropout < 1 else math.inf
    least = max(counting, bulk)
    binding = BULK if bulk >= counting else NOISE if c_min > 1 else DEPTH if share["het"] < CALLABLE_TARGET else DROPOUT if dropout > ADO_BAND else COUNTING
    q = one["q"] or [None] * 5
    return {
        "sample": sample, "n_cells": one["cells"], "n_sites": sites, "n_observations": total, "eps": eps, "rho": rho, "theta_het": het, "min_gq": float(min_gq), "gq_calibration": gq_calibration, "depth_p10": q[0], "depth_p25": q[1],
        "depth_median": q[2], "depth_p75": q[3], "depth_p90": q[4], "depth_mean": one["mean"], "depth_max": one["max"], "depth_for_target_gq_homref": depth_for(min_gq, 0, eps, rho, het), "depth_for_target_gq_het": depth_for(min_gq, 1, eps, rho, het),
        "callable_fraction_homref": share["hom"], "callable_fraction_het": share["het"], "observed_pass_fraction": one["passed"], "het_gq_ceiling": best_quality(one["max"] or 0, 1, eps, rho, het),
        "false_carrier_rate": (per["sum"] or 0.0) / total if total else 0.0, "expected_false_carriers": per["sum"] or 0.0, "false_carriers_per_site_median": per["median"] or 0.0, "false_carriers_per_site_max": per["max"] or 0.0,
        "family_alpha": family_alpha, "alpha_per_site": family_alpha / max(sites, 1), "c_min_observed": c_min, "min_callers": min_callers, "scoped_n_sites": per["few_count"] if scoped else None,
        "scoped_alpha_per_site": family_alpha / per["few_count"] if scoped else None, "scoped_c_min_observed": poisson_count(per["few_max"], family_alpha / per["few_count"]) if scoped else None, "scoped_expected_false_carriers": per["few_sum"] if scoped else None,
        "ado": dropout, "ado_measured": measured, "ado_sites": ado_sites, "ado_observations": ado_seen, "c_true_counting": counting, "clonal_fraction_counting": over(counting, one["cells"]), "bulk_min_vaf": bulk_min_vaf, "bulk_min_alt_reads": bulk_min_alt,
        "c_bulk_vaf": by_vaf, "c_bulk_alt_reads": by_reads, "c_true_bulk": bulk, "c_true_min": least, "clonal_fraction_min": over(least, one["cells"]), "binding_constraint": binding, "notes": notes,
    }


#: Unit and provenance of each quantity of the table.
ROWS = {
    "n_cells": ("cells", "measured"), "n_sites": ("sites", "measured"), "n_observations": ("cell-sites", "measured"), "eps": ("fraction", "configured"), "rho": ("fraction", None), "theta_het": ("fraction", "fixed"), "min_gq": ("phred", "configured"),
    "depth_median": ("reads", "measured"), "depth_mean": ("reads", "measured"), "depth_p10": ("reads", "measured"), "depth_p90": ("reads", "measured"), "depth_for_target_gq_homref": ("reads", "derived"), "depth_for_target_gq_het": ("reads", "derived"),
    "callable_fraction_homref": ("fraction", "derived"), "callable_fraction_het": ("fraction", "derived"), "observed_pass_fraction": ("fraction", "measured"), "het_gq_ceiling": ("phred", "derived"), "false_carrier_rate": ("per cell-site", "derived"),
    "expected_false_carriers": ("cells", "derived"), "false_carriers_per_site_median": ("cells", "derived"), "false_carriers_per_site_max": ("cells", "derived"), "family_alpha": ("probability", "configured"), "alpha_per_site": ("probability", "derived"),
    "c_min_observed": ("cells", "derived"), "min_callers": ("callers", "configured"), "scoped_n_sites": ("sites", "measured"), "scoped_alpha_per_site": ("probability", "derived"), "scoped_c_min_observed": ("cells", "derived"),
    "scoped_expected_false_carriers": ("cells", "derived"), "ado": ("fraction", None), "ado_sites": ("sites", "measured"), "ado_observations": ("cell-sites", "measured"), "c_true_counting": ("cells", "derived"), "clonal_fraction_counting": ("fraction", "derived"),
    "bulk_min_vaf": ("fraction", "configured"), "bulk_min_alt_reads": ("reads", "configured"), "c_bulk_vaf": ("cells", "derived"), "c_bulk_alt_reads": ("cells", "derived"), "c_true_bulk": ("cells", "derived"), "c_true_min": ("cells", "derived"),
    "clonal_fraction_min": ("fraction", "derived"),
}


def table(spark, found: dict) -> DataFrame:
    """A row for each quantity, and the limiting one as text."""
    source = {"rho": found["gq_calibration"], "ado": "measured" if found["ado_measured"] else "assumed"}
    rows = [(found["sample"], k, None if found[k] is None else float(found[k]), None, unit, how or source[k]) for k, (unit, how) in ROWS.items()]
    return spark.createDataFrame([*rows, (found["sample"], "binding_constraint", None, found["binding_constraint"], "name", "derived")], SCHEMA)


def text(found: dict) -> str:
    """The report for a reader."""
    show = lambda v, spec=".4g": "unreachable" if v is None else "inf" if math.isinf(v) else format(v, spec)
    f = found
    parts = [
        f"Detection power: {f['sample']}",
        f"{f['n_cells']} cells, {f['n_sites']} sites, {f['n_observations']} cell-sites; eps {f['eps']:.3g}, rho {f['rho']:.3g} ({f['gq_calibration']}), quality {f['min_gq']:.0f}",
        "1 Depth: " + ", ".join(f"{k} {show(f['depth_' + k])}" for k in ("p10", "p25", "median", "p75", "p90", "max")),
        f"  needed: {show(f['depth_for_target_gq_homref'])} for the reference, {show(f['depth_for_target_gq_het'])} for both alleles; reached by {f['callable_fraction_homref']:.2%} and {f['callable_fraction_het']:.2%}; ceiling {f['het_gq_ceiling']:.1f}",
        *([f"  passed: {f['observed_pass_fraction']:.2%}"] if f["observed_pass_fraction"] is not None else []),
        f"2 False carriers: {f['false_carrier_rate']:.3g} a cell-site, {f['expected_false_carriers']:.2f} in all; a site {f['false_carriers_per_site_median']:.3g} (median), {f['false_carriers_per_site_max']:.3g} (worst)",
        f"3 Carriers needed at the worst site: {f['c_min_observed']}, at {f['alpha_per_site']:.3g} a site",
        *([f"  of sites with {f['min_callers']} callers: {f['scoped_n_sites']} sites, {f['scoped_c_min_observed']} carriers, {f['scoped_expected_false_carriers']:.2f} false ones"] if f["scoped_n_sites"] is not None else []),
        f"4 Dropout {f['ado']:.3f} ({'measured' if f['ado_measured'] else 'assumed'}): least clone by counting {show(f['c_true_counting'], '.1f')} cells",
        f"5 Bulk: {show(f['c_bulk_vaf'], '.1f')} cells by share, {show(f['c_bulk_alt_reads'], '.1f')} by reads; least clone {show(f['c_true_bulk'], '.1f')} cells",
        f"6 Limit: {f['binding_constraint']}; least clone {show(f['c_true_min'], '.1f')} cells, {show(100 * f['clonal_fraction_min'], '.3g')} % of all",
        *[f"Note: {x}" for x in f["notes"]],
    ]
    return "\n".join(parts) + "\n"


def report(called: DataFrame, sample: str = "", **how) -> DataFrame:
    return table(called.sparkSession, compute(called, sample, **how))


def callable_by_depth(called: DataFrame, min_gq: float = MIN_GQ) -> DataFrame:
    """(n, cells, rate, hom, het) of every depth: what the report's sums are made of."""
    each = called.groupBy((F.coalesce("ref_reads", F.lit(0)) + F.coalesce("alt_reads", F.lit(0))).alias("n")).agg(F.count("*").alias("cells"))
    return each.join(by_depth(each, min_gq), "n").select("n", "cells", *[F.round(c, 6).alias(c) for c in ("rate", "hom", "het")])
