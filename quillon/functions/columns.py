"""Column expressions: sequences, qualities, likelihoods, labels. All stay inside the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# sequences


def hamming(a: ColumnLike, b: ColumnLike) -> Column:
    """Number of places at which two strings of one length differ; null if the lengths differ."""
    a, b = col(a), col(b)
    apart = F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.when(F.length(a) == F.length(b), apart)


def reverse_complement(s: ColumnLike) -> Column:
    return F.translate(F.reverse(col(s)), "ACGTacgt", "TGCAtgca")


def canonical(s: ColumnLike) -> Column:
    """The smaller of a sequence and its reverse complement."""
    return F.least(col(s), reverse_complement(s))


def masked(s: ColumnLike, i: ColumnLike) -> Column:
    """The string with the i-th character, from 1, replaced by an underscore."""
    s, i = col(s), col(i)
    return F.concat(F.substring(s, F.lit(1), i - 1), F.lit("_"), F.substring(s, i + 1, F.length(s)))


def slug(s: ColumnLike) -> Column:
    """Lower case, with runs of other characters than letters and digits as one underscore."""
    return F.regexp_replace(F.regexp_replace(F.lower(col(s)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def plain_contig(c: ColumnLike) -> Column:
    """Contig name in upper case without a leading chr."""
    return F.upper(F.regexp_replace(col(c), "^chr", ""))


# qualities and ratios


def mean_phred(q: ColumnLike) -> Column:
    """Aggregate: the quality of the mean error of qualities; nulls don't count."""
    return -10 * F.log10(F.avg(F.pow(F.lit(10.0), -col(q) / 10)))


def error_of(q: ColumnLike) -> Column:
    """Error of a quality; no quality counts as no error."""
    return F.coalesce(F.pow(F.lit(10.0), -col(q) / 10), F.lit(0.0))


def ratio(a: ColumnLike, b: ColumnLike) -> Column:
    """a / b, and 0 where b is 0."""
    return F.coalesce(F.try_divide(col(a).cast("double"), col(b).cast("double")), F.lit(0.0))


# likelihoods


def lgamma(x: ColumnLike) -> Column:
    """Logarithm of the gamma function of x > 0: Stirling's series at x + 8, stepped back."""
    x = col(x).cast("double")
    y = x + 8
    steps = x
    for i in range(1, 8):
        steps = steps * (x + i)
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3.0))) + 1 / (1260 * F.pow(y, F.lit(5.0))) - 1 / (1680 * F.pow(y, F.lit(7.0)))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(steps)


def beta_binomial_terms(theta: float, rho: float) -> tuple[float, float, float]:
    """Both parameters, and the logarithm of their beta function."""
    s = (1 - rho) / rho
    a, b = theta * s, (1 - theta) * s
    return a, b, math.lgamma(a) + math.lgamma(b) - math.lgamma(s)


# variants

#: Fixed values of the runs: depth, allele share, base and mapping quality below which a site is flagged; genotype quality, error, overdispersion.
MIN_DP, MIN_VAF, MIN_BQ, MIN_MQ = 5, 0.01, 15, 30
MIN_GQ, EPS, RHO, GQ_CAP = 30, 0.00045, 0.091, 99.0


def variant_type(ref: ColumnLike, alt: ColumnLike) -> Column:
    r, a = F.length(col(ref)), F.length(col(alt))
    return F.when((r == a) & (r == 1), "SNV").when(r == a, "MNV").when(a > r, "INS").otherwise("DEL")


def soft_filter(dp: ColumnLike, vaf: ColumnLike, bq: ColumnLike | None = None, mq: ColumnLike | None = None, min_dp: int = MIN_DP, min_vaf: float = MIN_VAF, min_bq: float = MIN_BQ, min_mq: float = MIN_MQ) -> Column:
    """Reasons joined by semicolons, or PASS. A missing depth or share is low; a missing quality isn't."""
    reasons = [F.when(F.coalesce(col(dp) < min_dp, F.lit(True)), "lowDP"), F.when(F.coalesce(col(vaf) < min_vaf, F.lit(True)), "lowVAF")]
    if bq is not None:
        reasons.append(F.when(col(bq) < min_bq, "lowBQ"))
    if mq is not None:
        reasons.append(F.when(col(mq) < min_mq, "lowMQ"))
    found = F.concat_ws(";", *reasons)
    return F.when(found == "", "PASS").otherwise(found)


def genotype_filter(gq: ColumnLike, min_gq: float = MIN_GQ) -> Column:
    return F.when(F.coalesce(col(gq), F.lit(0.0)) < min_gq, "lowGQ").otherwise("PASS")


def zygosity(gt: ColumnLike, passed: ColumnLike) -> Column:
    return F.when(col(passed) == "PASS", F.when(col(gt) == "0/1", "het").when(col(gt) == "0/0", "homref").when(col(gt) == "1/1", "hom"))


def variant_name(gt: ColumnLike, passed: ColumnLike, ref: ColumnLike, alt: ColumnLike) -> Column:
    named = F.when(col(gt) == "1/1", F.concat(F.lit("homo"), col(ref), F.lit(">"), col(alt))).when(col(gt) == "0/0", F.concat(F.lit("homo"), col(ref), F.lit(">"), col(ref))).when(col(gt) == "0/1", "hete")
    return F.when(col(passed) == "PASS", named).otherwise("lowqual")


def gt_code(gt: ColumnLike) -> Column:
    return F.when(col(gt) == "0/0", 1).when(col(gt) == "0/1", 2).when(col(gt) == "1/1", 3).otherwise(-1).cast("tinyint")


def likelihood_arguments(ref: ColumnLike, alt: ColumnLike, err: ColumnLike, eps: float = EPS, rho: float = RHO) -> Column:
    """The arguments of the gamma functions that likelihoods() needs, as an array, so that one lambda computes them all."""
    k, r = col(alt).cast("double"), col(ref).cast("double")
    s = (1 - rho) / rho
    low = F.greatest(F.lit(eps), col(err).cast("double") / 3)
    out = [r + k + s, k + low * s, r + (1 - low) * s, low * s, (1 - low) * s]
    for theta in (0.5, 1 - eps):
        a, b, _ = beta_binomial_terms(theta, rho)
        out += [k + a, r + b]
    return F.array(*out, r + k + 1, k + 1, r + 1)


def likelihoods(g: str, eps: float = EPS, rho: float = RHO) -> dict[str, Column]:
    """log10 of the three genotypes' likelihoods and of the binomial coefficient, from the logarithms of likelihood_arguments()'s gamma functions."""
    at = lambda i: F.get(g, F.lit(i))
    s = math.lgamma((1 - rho) / rho)
    ln10 = math.log(10)
    out = {"l_homref": (at(1) + at(2) - at(0) - at(3) - at(4) + s) / ln10}
    for i, (name, theta) in enumerate((("l_het", 0.5), ("l_homalt", 1 - eps))):
        out[name] = (at(5 + 2 * i) + at(6 + 2 * i) - at(0) - beta_binomial_terms(theta, rho)[2]) / ln10
    return out | {"l_choose": (at(9) - at(10) - at(11)) / ln10}
