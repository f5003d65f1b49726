"""Line deduplication: a suffix array over line numbers by distributed prefix doubling, in DataFrame functions only.

The suffixes are the places (document, line) of lines that occur twice or more; other lines end every repeated run. A suffix's rank at depth m is the number of suffixes whose first m lines come before
its own in the order of line ids, so suffixes of one rank form the interval of the suffix array whose longest common prefix has m lines or more. Ranks at depth 2m come from pairs of ranks at depth m, of a
place and of the place m lines on: equal pairs are counted, pairs are put in order, and running sums of the counts are the new ranks. Suffixes alone in their interval leave, as do those whose runs need no such depth.
The interval of any other depth is given by the ranks of the run's first and last 2**p lines.

A run counts if it has `min_words` words or more. Maximal repeated runs are the unions of the shortest runs of that many words that start or end at each of their lines (at most `min_words` lines deep), so
intervals at these depths suffice. Of each interval the first place in the order of the table stays; in later ones the run's lines are deleted.

Defined cases: the order is (doc_id, hash of the text, line), a null doc_id comes last; rows alike in id and text count as one
row and are returned each, alike; blank lines belong to no run but go with a deleted run around them; null texts stay null, empty ones empty;
an empty table gives an empty table; other columns pass through, whatever their names, unless they are named as a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillon.llm.common import WORD, cut, name, packed, split_join

LAST = (1 << 63) - 1
#: Ranges of the order in which running sums are taken; their own sums are one row each.
RANGES = 4096


def _key(doc_id: str, text: str) -> list[Column]:
    return [F.coalesce(F.col(name(doc_id)).cast("long"), F.lit(LAST)).alias("_d"), F.xxhash64(F.col(name(text))).alias("_t")]


def line_ids(df: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(_d, _t, k, line, a, b, w): the k-th line with a word, its number among all lines, its 128-bit id and its words."""
    parts = F.transform(F.split(F.col(name(text)), "\n"), lambda x, i: F.struct(i.alias("line"), F.xxhash64(x).alias("a"), F.xxhash64(F.lit(7), x).alias("b"), F.regexp_count(x, F.lit(WORD)).cast("long").alias("w")))
    return df.select(*_key(doc_id, text), F.posexplode(F.filter(parts, lambda s: s["w"] > 0)).alias("k", "_s")).select("_d", "_t", "k", "_s.*")


def _ranks(groups: DataFrame, place: Column, order: list[str]) -> DataFrame:
    """groups (columns of order, c) with rank: the sum of c of those before. place: from 0 to 1, growing with the order; it deals groups to ranges."""
    groups = cut(groups.withColumn("range", F.least(F.lit(RANGES - 1), F.floor(place * RANGES)).cast("int")), "groups")
    line = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # at most RANGES rows
    before = groups.groupBy("range").agg(F.sum("c").alias("_n")).select("range", F.coalesce(F.sum("_n").over(line), F.lit(0)).alias("_before"))
    inside = W.partitionBy("range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return groups.join(F.broadcast(before), "range").withColumn("rank", F.coalesce(F.sum("c").over(inside), F.lit(0)) + F.col("_before")).drop("range", "_before")


def _doubled(now: DataFrame, total: int, depth: int) -> DataFrame:
    """Of suffixes with ranks r of intervals of s suffixes, at `depth` lines: those repeated at twice the depth, with r and s there."""
    ahead = F.first("r").over(W.partitionBy("_d", "_t", "_g").orderBy("k").rangeBetween(depth, depth))
    pairs = cut(now.withColumn("next", ahead).where(F.col("next").isNotNull() & (F.col("deep") >= 2 * depth)), "pairs")
    place = (F.col("r") + F.col("s") * (F.col("next") / F.lit(float(max(total, 1))))) / F.lit(float(max(total, 1)))
    ranks = _ranks(pairs.groupBy("r", "s", "next").agg(F.count("*").alias("c")).where("c > 1"), place, ["r", "next"])
    both = split_join(pairs, ranks.drop("s"), ["r", "next"], "c", pairs.count())
    return both.select("_d", "_t", "_g", "k", "deep", F.col("rank").alias("r"), F.col("c").alias("s"))


def repeated_runs(df: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = 50) -> DataFrame:
    """(_d, _t, s, e): maximal runs of lines s to e (numbers among all lines of a document) that occur earlier in the table."""
    lines = cut(line_ids(df, text, doc_id), "lines")
    total = lines.count()
    # ids are hashes, so their first bits are places in their order
    twice = _ranks(lines.groupBy("a", "b").agg(F.count("*").alias("c")).where("c > 1"), F.col("a") / F.lit(2.0**64) + 0.5, ["a", "b"])
    alive = split_join(lines, twice, ["a", "b"], "c", total).select("_d", "_t", "k", "line", "w", F.col("rank").alias("r"), F.col("c").alias("s"))
    alive = alive.repartition("_d", "_t").dropDuplicates(["_d", "_t", "k"])
    doc = W.partitionBy("_d", "_t")
    # an unbroken stretch of repeated lines has one value of k - row number
    alive = alive.withColumn("_g", F.col("k") - F.row_number().over(doc.orderBy("k")))
    part = W.partitionBy("_d", "_t", "_g")
    alive = alive.withColumn("_to", F.sum("w").over(part.orderBy("k").rowsBetween(W.unboundedPreceding, 0)))
    # the shortest runs of min_words words that start, and that end, at each line
    forth, back = part.orderBy(F.col("_to") - F.col("w")).rangeBetween(0, min_words - 1), part.orderBy("_to").rangeBetween(-(min_words - 1), 0)
    alive = alive.withColumns({"k1": F.max("k").over(forth), "e1": F.max("line").over(forth), "w1": F.sum("w").over(forth), "k0": F.min("k").over(back), "s0": F.min("line").over(back), "w0": F.sum("w").over(back)})
    ones, zeros = F.when(F.col("w1") >= min_words, F.col("k1") - F.col("k") + 1), F.when(F.col("w0") >= min_words, F.col("k") - F.col("k0") + 1)
    # the depth of the longest of these runs that a line may be in
    deep = F.greatest(F.max(ones).over(part.orderBy("k").rowsBetween(-min_words, 0)), F.max(zeros).over(part.orderBy("k").rowsBetween(0, min_words)))
    alive = cut(alive.withColumn("deep", deep).where("deep IS NOT NULL").drop("_to", "w"), "suffixes")
    now, depth = alive.select("_d", "_t", "_g", "k", "deep", "r", "s"), 1
    ranks = now.select("_d", "_t", "k", F.lit(0).alias("p"), "r")
    while 2 * depth <= min_words:
        now = cut(_doubled(now, total, depth), "ranks")
        if now.isEmpty():
            break
        depth *= 2
        ranks = ranks.union(now.select("_d", "_t", "k", F.lit(depth.bit_length() - 1), "r"))
    runs = alive.where(F.col("w1") >= min_words).select("_d", "_t", "k", F.col("k1").alias("z"), F.col("line").alias("s"), F.col("e1").alias("e")).union(alive.where(F.col("w0") >= min_words).select("_d", "_t", "k0", "k", "s0", "line")).distinct()
    runs = runs.withColumn("m", F.col("z") - F.col("k") + 1).withColumn("p", F.floor(F.log2(F.col("m") + F.lit(0.5))).cast("int"))
    # the interval of a depth between two powers has the ranks of both ends: of the first and the last 2^p lines of the run
    runs = runs.withColumn("k2", (F.col("z") + 1 - F.pow(F.lit(2), "p")).cast("int"))
    runs = runs.join(ranks.withColumnRenamed("r", "x"), ["_d", "_t", "k", "p"]).join(ranks.withColumnsRenamed({"k": "k2", "r": "y"}), ["_d", "_t", "k2", "p"])
    runs = cut(runs.select("_d", "_t", "k", "s", "e", "m", "x", "y"), "runs")
    first = runs.groupBy("m", "x", "y").agg(F.min(F.struct("_d", "_t", "k")).alias("f"), F.count("*").alias("c")).where("c > 1")
    later = split_join(runs, first, ["m", "x", "y"], "c", runs.count()).where(F.struct("_d", "_t", "k") > F.col("f")).select("_d", "_t", "s", "e")
    upto = F.max("e").over(doc.orderBy("s", "e").rowsBetween(W.unboundedPreceding, -1))
    later = later.withColumn("_n", F.when(upto.isNull() | (F.col("s") > upto + 1), 1).otherwise(0)).withColumn("_i", F.sum("_n").over(doc.orderBy("s", "e").rowsBetween(W.unboundedPreceding, 0)))
    return later.groupBy("_d", "_t", "_i").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("_i")


MADE = ["n_lines", "n_deleted", "n_runs"]


def dedup_lines(df: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = 50) -> DataFrame:
    """df with the lines of later copies deleted from text, and n_lines, n_deleted, n_runs (long)."""
    runs = repeated_runs(df, text, doc_id, min_words).groupBy("_d", "_t").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("_r"))
    d, t = _key(doc_id, text)
    rows, kept = packed(df, [*MADE, text], _text=F.col(name(text)), _d=d, _t=t)
    both = rows.join(runs, ["_d", "_t"], "left")
    # one flag for each line: gaps before runs, then the runs
    k = F.size("_r")
    before = F.concat(F.array(F.lit(-1)), F.transform("_r", lambda x: x["e"]))
    flags = F.flatten(F.zip_with("_r", F.slice(before, F.lit(1), k), lambda x, p: F.concat(F.array_repeat(F.lit(True), x["s"] - p - 1), F.array_repeat(F.lit(False), x["e"] - x["s"] + 1))))
    both = both.select("*", F.inline(F.array(F.struct(F.split("_text", "\n").alias("_l"), F.when(F.col("_r").isNotNull(), flags).alias("_f")))))
    left = F.filter(F.zip_with("_l", "_f", lambda x, f: F.when(F.coalesce(f, F.lit(True)), x)), lambda x: x.isNotNull())
    new = F.when(F.col("_r").isNull(), F.col("_text")).otherwise(F.array_join(left, "\n"))
    gone = F.aggregate(F.coalesce("_r", F.array().cast("array<struct<s:int,e:int>>")), F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["s"] + 1)
    n_lines = F.when(F.col("_text").isNull(), F.lit(0)).otherwise(F.size("_l")).cast("long")
    n_runs = F.when(F.col("_r").isNull(), F.lit(0)).otherwise(F.size("_r")).cast("long")
    out = both.select("_row", new.alias("_text"), n_lines.alias("_n1"), gone.alias("_n2"), n_runs.alias("_n3"))
    made = dict(zip(MADE, ("_n1", "_n2", "_n3"), strict=True)) | {text: "_text"}
    return out.select(*[F.col(made[c]).alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in df.columns if c not in MADE], *[F.col(made[c]).alias(c) for c in MADE])


def line_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: texts without later copies of runs; documents with no word left go."""
    done = dedup_lines(docs)
    return done.where(F.col("text").rlike(WORD) | (F.col("n_deleted") == 0)).withColumn("n_chars", F.when(F.col("n_deleted") == 0, F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*map(name, docs.columns))
