"""Mixing sources to target weights by temperature, in DataFrame functions only.

A source's weight is its share of all tokens to the power of an exponent between 0 (all alike) and 1 (as they are), normalised. The exponent is bisected
until the weights meet a target entropy, or no source is seen more often than a limit; where both are given and clash, the limit holds.
Weights times the budget give each source's tokens. Unless it is given, the budget is the least with which no source is cut, so all documents stay.

A source's tokens are dealt as passes over blocks: whole passes take every document; the last one takes blocks, in an order of its own, until the
source's tokens are used up, and of the block in which they end the documents that still fit. Documents have an order of their own in each block and pass.
Blocks hold about `BLOCK` documents, so no step orders more rows of a source than a block has, or than it has blocks.

Defined cases: null sources are one source; a null or empty text has no tokens and a source without tokens is taken once; rows
alike in id, source and text are taken together; equal hashes of an order go by id; an empty table gives an empty table; other columns pass through `mix`, whatever their names, unless they are named as one of its results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillon.llm.common import WORD, cut, name, packed, unpacked

BLOCK = 4096
#: The exponent is a multiple of 2 to the power of minus this; each round of the search halves the range `STEP` times.
BITS, STEP = 30, 6
PLAN = ["weight", "epoch", "block_rank", "place"]


def _order(seed: int, *parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def exponent(sources: DataFrame, max_repetition: float | None = None, entropy: float | None = None, budget: float | None = None) -> float:
    """The exponent for sources (tokens, positive). The sums over sources come for `2**STEP` exponents at a time, so few small jobs do."""
    total, top = sources.agg(F.sum("tokens"), F.max("tokens")).first()
    if not total:
        return 1.0
    p = F.col("tokens") / F.lit(float(total))

    def meets(alphas: list[float]) -> dict[float, tuple[bool, bool]]:
        at = sources.select("tokens", F.explode(F.array(*map(F.lit, alphas))).alias("x"))
        at = at.groupBy("x").agg(F.sum(F.pow(p, F.col("x"))).alias("z"), F.sum(F.pow(p, F.col("x")) * F.log(p) * F.col("x")).alias("l"), F.max(F.pow(p, F.col("x")) / F.col("tokens")).alias("m"))
        out = {}
        for r in at.collect():  # as many rows as exponents
            all_of = budget if budget is not None else top * r["z"] / math.pow(top / total, r["x"])
            out[r["x"]] = (max_repetition is None or r["m"] / r["z"] * all_of <= max_repetition, entropy is None or math.log(r["z"]) - r["l"] / r["z"] >= entropy)
        return out

    def search(good) -> float:
        """Least multiple of 2**-BITS in [0, 1] that is good, if larger ones are too; 1 if none is."""
        lo, hi = -1, 1 << BITS
        while hi - lo > 1:
            step = max(1, (hi - lo) >> STEP)
            ks = [k for k in range(lo + step, hi, step)]
            found = meets([k / (1 << BITS) for k in ks])
            oks = [k for k in ks if good(found[k / (1 << BITS)])]
            hi = min(oks, default=hi)
            lo = max([k for k in ks if k < hi], default=lo)
        return hi / (1 << BITS)

    least = search(lambda x: x[0]) if max_repetition is not None else 0.0
    # weights lose entropy as the exponent grows: the largest that still has enough
    most = max(0.0, search(lambda x: not x[1]) - 2.0**-BITS) if entropy is not None else None
    return least if most is None else max(least, most)


def plan(rows: DataFrame, max_repetition: float | None = 2.0, entropy: float | None = None, budget: float | None = None, seed: int = 1) -> DataFrame:
    """rows (doc_id, source, tokens, other keys) once for each time a document is taken, with PLAN."""
    names = rows.columns
    keys = ["_k", "doc_id", "source", "tokens"]
    rows = cut(rows.select(F.struct(*map(name, names)).alias("_k"), "doc_id", "source", "tokens"), "tokens")
    sources = cut(rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")), "sources")
    real = sources.where("tokens > 0")
    alpha = exponent(real, max_repetition, entropy, budget)
    total, top = real.agg(F.sum("tokens"), F.max("tokens")).first()
    p = F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(alpha))
    z = real.agg(F.sum(p)).first()[0] or 1.0
    all_of = budget if budget is not None else (top * z / math.pow(top / total, alpha) if total else 0.0)
    weight = F.when(F.col("tokens") > 0, F.round(p / F.lit(z), 9)).otherwise(F.lit(0.0))
    # from the share itself: the rounded weight is off by tokens at large budgets, and the budget that cuts no source would cut the largest
    due = F.round(p / F.lit(z) * F.lit(float(all_of))).cast("long")
    due = F.when(F.col("tokens") > 0, F.greatest(due, F.col("tokens")) if budget is None else due).otherwise(F.lit(0).cast("long"))
    sources = cut(sources.select(F.col("source").alias("_s"), weight.alias("weight"), F.greatest(F.lit(1), F.ceil(F.col("docs") / BLOCK)).cast("long").alias("_n"),
                             F.when(F.col("tokens") > 0, F.floor(due / F.col("tokens"))).otherwise(F.lit(1)).cast("int").alias("_full"), F.when(F.col("tokens") > 0, due % F.col("tokens")).otherwise(F.lit(0)).cast("long").alias("_rest")), "sources")
    placed = rows.join(sources, F.col("source").eqNullSafe(F.col("_s")), "left")
    placed = cut(placed.withColumn("_block", F.conv(F.substring(_order(seed, F.lit("block"), F.col("doc_id")), 1, 8), 16, 10).cast("long") % F.col("_n")), "placed")
    # the last pass: blocks in its order, with the tokens of those before
    blocks = placed.where("_rest > 0").groupBy("source", "_full", "_rest", "_block").agg(F.sum("tokens").alias("_t"))
    line = W.partitionBy("source").orderBy(_order(seed, F.lit("rank"), F.col("_full"), F.col("_block")), "_block")
    blocks = blocks.withColumn("_before", F.sum("_t").over(line.rowsBetween(W.unboundedPreceding, -1))).withColumn("_before", F.coalesce("_before", F.lit(0)))
    blocks = blocks.where("_before < _rest").select(F.col("source").alias("_bs"), F.col("_block").alias("_b"), "_before")
    last = placed.where("_rest > 0").join(blocks, F.col("source").eqNullSafe(F.col("_bs")) & (F.col("_block") == F.col("_b")))
    here = W.partitionBy("source", "_block").orderBy(_order(seed, F.lit("place"), F.col("_full"), F.col("doc_id")), "doc_id")
    last = last.withColumn("_in", F.sum("tokens").over(here.rowsBetween(W.unboundedPreceding, 0)) + F.col("_before")).where("_in <= _rest")
    whole = placed.where("_full > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("_full") - 1)))
    taken = whole.select(*keys, "weight", "_block", "epoch").union(last.select(*keys, "weight", "_block", F.col("_full")))
    ranks = placed.select("source", "_block").distinct().join(sources.select(F.col("_s").alias("_s3"), F.explode(F.sequence(F.lit(0), F.col("_full"))).alias("epoch")), F.col("source").eqNullSafe(F.col("_s3")))
    order = W.partitionBy("source", "epoch").orderBy(_order(seed, F.lit("rank"), F.col("epoch"), F.col("_block")), "_block")
    ranks = ranks.select(F.col("source").alias("_s"), F.col("_block").alias("_b"), F.col("epoch").alias("_e"), F.row_number().over(order).alias("block_rank"))
    taken = taken.join(ranks, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b")) & (F.col("epoch") == F.col("_e")))
    inside = W.partitionBy("source", "_block", "epoch").orderBy(_order(seed, F.lit("place"), F.col("epoch"), F.col("doc_id")), "doc_id")
    return taken.select("_k", "weight", "epoch", "block_rank", F.row_number().over(inside).alias("place")).select("_k.*", *PLAN)


def token_rows(df: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, source, th, tokens); tokens are words."""
    rows = df.select(F.col(name(doc_id)).alias("doc_id"), F.col(name(source)).alias("source"), F.xxhash64(F.col(name(text))).alias("th"), F.coalesce(F.regexp_count(F.col(name(text)), F.lit(WORD)), F.lit(0)).cast("long").alias("tokens"))
    return rows.groupBy("doc_id", "source", "th").agg(F.sum("tokens").alias("tokens"))


def mix(df: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", **how) -> DataFrame:
    """df's rows once for each time they are taken, with PLAN."""
    taken = plan(token_rows(df, text, source, doc_id), **how).select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("th").alias("_t"), *PLAN)
    rows, kept = packed(df, PLAN, _d2=F.col(name(doc_id)), _s2=F.col(name(source)), _t2=F.xxhash64(F.col(name(text))))
    same = F.col("_d2").eqNullSafe(F.col("_d")) & F.col("_s2").eqNullSafe(F.col("_s")) & (F.col("_t2") == F.col("_t"))
    return unpacked(rows.join(taken, same), kept, *PLAN)


def mixing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: every document stays, and documents of small sources come up to twice."""
    return mix(docs, max_repetition=2.0).select(*map(name, docs.columns))
