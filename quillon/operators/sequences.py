"""Sequences and sheets: k-mers, similarity, rules, variant records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.columns import canonical


#: Places of a piece of a sequence whose k-mers are made at once, and places of a task, about.
PIECE, PLACES = 4096, 1 << 20


def kmers(sequences: DataFrame, k: int, both_strands: bool = True, places: int = PLACES) -> DataFrame:
    """(id, kmer): distinct k-mers, each the smaller of its two strands. Sequences are dealt to tasks in pieces before k-mers are made, as many tasks as the number of places needs, so that none has more than its share however few files they come from."""
    own = sequences.where(F.length("sequence") >= k)
    n = own.agg(F.sum(F.length("sequence").cast("long") - k + 1)).first()[0] or 0
    starts = F.sequence(F.lit(1), F.length("sequence") - k + 1, F.lit(PIECE))
    own = own.select("id", F.explode(F.transform(starts, lambda i: F.substring("sequence", i, F.lit(PIECE + k - 1)))).alias("_s")).repartition(max(1, -(-n // places)))
    own = own.select("id", F.explode(F.transform(F.sequence(F.lit(1), F.length("_s") - k + 1), lambda i: F.substring("_s", i, F.lit(k)))).alias("kmer"))
    return (own.withColumn("kmer", canonical("kmer")) if both_strands else own).distinct()


def similarity(sequences: DataFrame, k: int = 31, both_strands: bool = True, common: int = 64) -> DataFrame:
    """Of pairs that share a k-mer: the share of the smaller set that both have.

    Sequences that hold a k-mer come as one sorted list, and pairs as slices of it. A list of more than `common` sequences is cut into blocks, and each pair of blocks is a row of its own, so no task has all pairs of a k-mer.
    """
    own = kmers(sequences, k, both_strands)
    n = own.groupBy("id").agg(F.count("*").alias("n"))
    placed = own.withColumn("_b", F.pmod(F.xxhash64("id"), F.lit(1 << 20)))
    size = own.groupBy("kmer").agg(F.count("*").alias("_c")).where("_c > 1")
    blocks = placed.join(size, "kmer").withColumn("_b", F.pmod("_b", F.ceil(F.col("_c") / common)).cast("int"))
    lists = blocks.groupBy("kmer", "_b").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    inside = lists.select(F.explode(F.flatten(F.transform("ids", lambda x, i: F.transform(F.slice("ids", i + 2, F.size("ids")), lambda y: F.struct(x.alias("ref_1"), y.alias("ref_2")))))).alias("p"))
    left, right = lists.select("kmer", F.col("_b").alias("b1"), F.col("ids").alias("i1")), lists.where("_b > 0").select("kmer", F.col("_b").alias("b2"), F.col("ids").alias("i2"))
    across = left.join(right, "kmer").where("b1 < b2").select(F.explode(F.flatten(F.transform("i1", lambda x: F.transform("i2", lambda y: F.struct(F.least(x, y).alias("ref_1"), F.greatest(x, y).alias("ref_2")))))).alias("p"))
    shared = inside.union(across).groupBy("p.ref_1", "p.ref_2").agg(F.count("*").alias("s"))
    both = shared.join(n.select(F.col("id").alias("ref_1"), F.col("n").alias("n1")), "ref_1").join(n.select(F.col("id").alias("ref_2"), F.col("n").alias("n2")), "ref_2")
    return both.select("ref_1", "ref_2", F.round(F.col("s") / F.least("n1", "n2"), 6).alias("similarity"))


#: Description keys that are known, those that hold coordinates, and the least similarity that is worth a warning.
KNOWN_KEYS = ("as", "chrom", "g0", "amplicon_start", "amplicon_end", "snp_pos", "legacy_name", "m5")
COORDINATES = ("g0", "amplicon_start", "amplicon_end")
SIMILAR = 0.3


def reference_problems(fasta: DataFrame) -> DataFrame:
    """(id, level, rule, detail): every rule that a record of amplicons (id, fields, bad, sequence) breaks, error or warning."""
    seq = F.coalesce("sequence", F.lit(""))
    upper = F.upper(seq)
    field = lambda k: F.element_at("fields", k)
    whole = lambda x: x.rlike("^[0-9]+$")
    number = lambda k: F.when(whole(field(k)), field(k).cast("long"))
    error, warning = "error", "warning"
    row = lambda level, rule, detail: F.struct(F.lit(level).alias("level"), F.lit(rule).alias("rule"), detail.cast("string").alias("detail"))
    some = lambda when, level, rule, detail: F.when(when, F.array(row(level, rule, detail))).otherwise(F.array().cast("array<struct<level:string,rule:string,detail:string>>"))
    each = lambda values, level, rule: F.transform(values, lambda x: row(level, rule, x))
    snps = F.filter(F.split(F.coalesce(field("snp_pos"), F.lit("")), r"\|"), lambda x: x != "")
    start, end, g0 = number("amplicon_start"), number("amplicon_end"), number("g0")
    ordered = F.coalesce(end >= start, F.lit(False))
    digest = F.md5(upper)
    found = F.concat(
        each(F.coalesce("bad", F.array().cast("array<string>")), error, "token"),
        some(~F.col("id").rlike("^[A-Za-z0-9_]+$"), error, "id", F.col("id")),
        each(F.array_sort(F.array_except(F.map_keys("fields"), F.array(*map(F.lit, KNOWN_KEYS)))), warning, "key"),
        some(seq == "", error, "empty", F.lit("")),
        each(F.array_sort(F.array_distinct(F.filter(F.split(upper, ""), lambda b: (b != "") & ~b.isin(*"ACGTN")))), error, "base"),
        some(seq != upper, warning, "lowercase", F.lit("")),
        *[some(F.coalesce(~whole(field(k)), F.lit(False)), error, k, field(k)) for k in COORDINATES],
        each(F.filter(snps, lambda x: ~whole(x)), error, "snp_pos"),
        some(F.coalesce(end < start, F.lit(False)), error, "range", F.concat_ws("-", start.cast("string"), end.cast("string"))),
        each(F.filter(snps, lambda x: ordered & whole(x) & ~F.coalesce(x.try_cast("long").between(start, end), F.lit(False))), error, "snp_outside"),
        some(F.coalesce(g0 > start, F.lit(False)), warning, "g0_after_start", g0),
        some(F.coalesce(digest != F.lower(field("m5")), F.lit(False)), error, "m5", digest),
    )
    single = fasta.select("id", F.explode(found).alias("p")).select("id", "p.*")
    again = fasta.groupBy("id").agg(F.count("*").alias("_n")).where("_n > 1").select("id", F.lit(error), F.lit("duplicate"), F.col("_n").cast("string"))
    none = fasta.agg(F.count("*").alias("_n")).where("_n = 0").select(F.lit("-"), F.lit(error), F.lit("no records"), F.lit(""))
    return single.union(again).union(none)


def similarity_warnings(pairs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """similarity()'s pairs that reads may confuse, as problems of the first sequence."""
    return pairs.where(F.col("similarity") >= least).select(F.col("ref_1").alias("id"), F.lit("warning").alias("level"), F.lit("similar").alias("rule"), F.concat_ws(" ", "ref_2", F.col("similarity").cast("string")).alias("detail"))


def problems(sequences: DataFrame, forbidden: str = "[^ACGTNacgtn]") -> DataFrame:
    """(id, problem): every rule that a sequence breaks."""
    again = sequences.groupBy(F.md5(F.coalesce("sequence", F.lit(""))).alias("_h")).agg(F.count("*").alias("_n")).where("_n > 1")
    both = sequences.withColumn("_h", F.md5(F.coalesce("sequence", F.lit("")))).join(again, "_h", "left")
    found = F.array(F.when(F.coalesce(F.length("sequence"), F.lit(0)) == 0, "empty"), F.when(F.col("sequence").rlike(forbidden), "letters"), F.when(F.col("_n") > 1, "repeated"))
    return both.select("id", F.explode(F.array_compact(found)).alias("problem"))


def repeated(sheet: DataFrame, *keys: str) -> DataFrame:
    return sheet.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def position_profile(reads: DataFrame, sequence: str = "sequence") -> DataFrame:
    """Of each place in the reads, from 1: bases and their shares, as a sequencing report has them."""
    each = reads.select(F.posexplode(F.split(F.upper(sequence), "")).alias("_p", "b")).where("b <> ''")
    out = each.groupBy((F.col("_p") + 1).alias("position")).agg(F.count("*").alias("reads"), *[F.count_if(F.col("b") == b).alias(f"n_{b}") for b in "ACGT"])
    return out.withColumn("fraction_gc", F.round((F.col("n_G") + F.col("n_C")) / F.col("reads"), 6))


def vcf_rows(lines: DataFrame, callers: Column | None = None) -> DataFrame:
    """A row for each record and caller with depth: the first alternative, depth, allele depths, share. callers: names of the sample columns."""
    f = F.split("value", "\t")
    own = lines.where(~F.col("value").startswith("#")).select(f[0].alias("chrom"), f[1].cast("long").alias("pos"), f[3].alias("ref"), F.split(f[4], ",")[0].alias("alt"), F.try_to_number(f[5], F.lit("999999.99")).cast("double").alias("qual"), F.split(f[8], ":").alias("_k"), (callers if callers is not None else F.array().cast("array<string>")).alias("_c"), F.posexplode(F.slice(f, F.lit(10), F.size(f))).alias("_i", "_s"))
    fields = F.map_from_arrays("_k", F.slice(F.concat(F.split("_s", ":"), F.array_repeat(F.lit(None).cast("string"), F.size("_k"))), F.lit(1), F.size("_k")))
    own = own.withColumn("_m", fields)
    ad = F.split(F.element_at("_m", "AD"), ",")
    number = lambda k, t: F.expr(f"try_cast(_m['{k}'] AS {t})")
    out = own.select("chrom", "pos", "ref", "alt", "qual", F.coalesce(F.get("_c", F.col("_i")), F.col("_i").cast("string")).alias("caller"), number("DP", "BIGINT").alias("dp"), F.expr("try_cast(get(split(_m['AD'], ','), 0) AS BIGINT)").alias("ad_ref"), F.expr("try_cast(get(split(_m['AD'], ','), 1) AS BIGINT)").alias("ad_alt"), number("VAF", "DOUBLE").alias("af"))
    return out.where("dp IS NOT NULL AND dp <> 0")
