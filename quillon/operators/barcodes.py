"""Barcode correction against a whitelist, nearest neighbours in string order, substitution rates."""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillon.functions.columns import hamming, masked
from quillon.operators.ranges import ROWS, counted, nearest, running
from quillon.sources.tables import materialise


def asof(left: DataFrame, right: DataFrame, key: str, by: list[str] = (), backward: bool = True) -> DataFrame:
    """Every left row with match, the nearest right key at or before (or after) its own, in string order, within the `by` columns.

    Both sides are one table in the order of `by` and keys, cut into ranges where it is large, so there is no join and no task has a whole group.
    """
    rows = left.select(*by, key, F.lit(1).alias("_side"), F.lit(None).cast("string").alias("match")).unionByName(right.select(*by, key, F.lit(0).alias("_side"), F.col(key).alias("match")).distinct())
    return nearest(rows, key, "match", "_side", backward, by=tuple(by)).where("_side = 1").drop("_side")


def neighbours(a: DataFrame, b: DataFrame, left: str, right: str, by: list[str] = (), distance: int = 1) -> DataFrame:
    """Pairs of distinct strings of one length, and of the same `by` columns, that differ at `distance` places or less. Strings meet under each of their forms with so many places masked, so no cross join is needed."""
    def forms(df: DataFrame, c: str) -> DataFrame:
        out = df.select(*by, c).distinct().withColumns({"_m": F.col(c), "_i": F.lit(0)})
        for k in range(distance, 0, -1):  # places in rising order; shorter strings are masked as a whole
            last = F.greatest(F.length(c) - k + 1, F.lit(1))
            out = out.withColumn("_i", F.explode(F.sequence(F.least(F.col("_i") + 1, last), last))).withColumn("_m", masked("_m", "_i"))
        return out.drop("_i").distinct() if distance > 1 else out.drop("_i")

    return forms(a, left).join(forms(b, right), [*by, "_m"]).select(*by, left, right).distinct().withColumn("distance", hamming(left, right)).where(F.col("distance") <= distance)


def correct_complete(observed: DataFrame, whitelist: DataFrame) -> DataFrame:
    """(barcode, corrected): listed barcodes as they are, others as the listed one at distance 1, the first in string order; null if there is none."""
    known, seen = whitelist.select(F.col("barcode").alias("corrected")).distinct(), observed.select("barcode").distinct()
    near = neighbours(seen, known, "barcode", "corrected").groupBy("barcode").agg(F.min_by("corrected", F.struct("distance", "corrected")).alias("corrected"))
    return seen.join(near, "barcode", "left")


def _matches(part: str, pairs: list[tuple[str, str]]) -> list[tuple[str, str, str, int, bool]]:
    """(part, barcode, listed one, round, whether it was found ahead) of the rounds over near pairs (barcode, listed one); a listed one near none comes with null. Only listed barcodes whose neighbour in the pool has changed are looked at again."""
    order = {x: i for i, x in enumerate(sorted({x for p in pairs for x in p if x is not None}))}
    near: dict[str, list[str]] = {to: [] for _, to in pairs}
    for barcode, to in sorted(p for p in pairs if p[0] is not None):
        near[to].append(barcode)
    pool = sorted(near)
    end = len(pool)
    place = [order[x] for x in pool]
    before, after = list(range(-1, end - 1)), list(range(1, end + 1))
    rows = [[order[x] for x in near[t]] for t in pool]
    back = [bisect_right(r, p) for r, p in zip(rows, place, strict=True)]  # the first barcode behind that was not looked at
    ahead = [i - 1 for i in back]  # the last one in front
    done: dict[str, tuple[str, str, str, int, bool]] = {}
    looked, n = set(range(end)), 0
    while looked:
        n += 1
        used = set()
        for is_ahead in (False, True):  # a barcode takes the listed one before it, if that is near
            for t in sorted(looked):
                if is_ahead:
                    least = place[before[t]] if before[t] >= 0 else -1
                    while ahead[t] >= 0 and rows[t][ahead[t]] > least:
                        own = near[pool[t]][ahead[t]]
                        ahead[t] -= 1
                        if own not in done:
                            done[own] = (part, own, pool[t], n, True)
                            used.add(t)
                else:
                    most = place[after[t]] if after[t] < end else len(order)
                    while back[t] < len(rows[t]) and rows[t][back[t]] < most:
                        own = near[pool[t]][back[t]]
                        back[t] += 1
                        if own not in done:
                            done[own] = (part, own, pool[t], n, False)
                            used.add(t)
        looked = set()
        for t in used:
            if before[t] >= 0:
                after[before[t]] = after[t]
                looked.add(before[t])
            if after[t] < end:
                before[after[t]] = before[t]
                looked.add(after[t])
        looked -= used
    return list(done.values())


_FOUND = "part string, barcode string, to string, round int, ahead boolean"


def _rounds(key: tuple, pairs: pa.Table) -> pa.Table:
    found = _matches(key[0].as_py(), list(zip(pairs["barcode"].to_pylist(), pairs["to"].to_pylist(), strict=True)))
    kinds = {"part": pa.string(), "barcode": pa.string(), "to": pa.string(), "round": pa.int32(), "ahead": pa.bool_()}
    return pa.table([pa.array([x[i] for x in found], t) for i, t in enumerate(kinds.values())], list(kinds))


def _stretches(pairs: DataFrame, listed: DataFrame) -> DataFrame:
    """Near pairs (part, barcode, to) that can meet, with the stretch of the order they lie in. A listed barcode that is near none never leaves the pool, so no pair reaches over it; pairs that do are dropped, after which more listed ones may be near none. Those that this leaves inside a stretch come without a barcode."""
    pairs, n = counted(pairs)
    while True:
        wanted = pairs.select("part", F.col("to").alias("barcode")).distinct().withColumn("_w", F.lit(0))
        fixed = listed.join(wanted, ["part", "barcode"], "left").select("part", "barcode", F.coalesce("_w", F.lit(1)).alias("_w"))
        points = fixed.union(pairs.select("part", "barcode", F.lit(0)).distinct())
        place = materialise(running(points, "_s", "_w", "part", "barcode", rows=ROWS).drop("_w"))
        to = place.withColumnsRenamed({"barcode": "to", "_s": "_t"})
        kept, m = counted(pairs.join(place, ["part", "barcode"]).join(to, ["part", "to"]).where("_s = _t").select("part", "barcode", "to", F.col("_s").alias("stretch")))
        if m >= 0.9 * n:
            alone = wanted.select("part", F.col("barcode").alias("to")).join(kept, ["part", "to"], "left_anti").join(to, ["part", "to"])
            return kept.union(alone.select("part", F.lit(None).cast("string"), "to", "_t"))
        pairs, n = kept.drop("stretch"), m


def correct_compat(observed: DataFrame, whitelist: DataFrame, distance: int = 1) -> DataFrame:
    """(barcode_position, barcode, corrected) by neighbours in string order alone: first those before, then those after; listed barcodes once matched leave, until no barcode of the part finds one after.

    Rounds may be as many as there are barcodes, so they are not passes over tables: near pairs are found by masked forms, listed barcodes that never leave cut the order into stretches that don't touch each
    other, and each stretch goes through its rounds at once in one task. A part ends with its first round in which no stretch found a barcode ahead; later matches don't count.
    """
    listed = materialise(whitelist.select(F.col("barcode_position").alias("part"), "barcode").where("barcode IS NOT NULL").distinct())
    seen = materialise(observed.select(F.col("barcode_position").alias("part"), "barcode").where("barcode IS NOT NULL").distinct())
    unknown = seen.join(listed, ["part", "barcode"], "left_anti")
    pairs = neighbours(unknown, listed.withColumnRenamed("barcode", "to"), "barcode", "to", ["part"], distance).select("part", "barcode", "to")
    found = materialise(_stretches(pairs, listed).groupBy("part", "stretch").applyInArrow(_rounds, _FOUND))
    on = found.where("ahead").select("part", "round").distinct().withColumn("_i", F.row_number().over(W.partitionBy("part").orderBy("round")))  # a row for each round
    last = on.groupBy("part").agg((F.count_if(F.col("round") == F.col("_i")) + 1).alias("_last"))
    own = found.join(last, "part", "left").where(F.col("round") <= F.coalesce("_last", F.lit(1))).select("part", "barcode", "to")
    out = seen.join(listed.withColumn("listed", F.lit(True)), ["part", "barcode"], "left").join(own, ["part", "barcode"], "left")
    return out.select(F.col("part").alias("barcode_position"), "barcode", F.when(F.col("listed"), F.col("barcode")).otherwise(F.col("to")).alias("corrected"))


def apply_corrections(reads: DataFrame, corrections: DataFrame, part: str) -> DataFrame:
    """reads with the part's corrections applied; barcodes without one stay."""
    own = corrections.where((F.col("barcode_position") == part) & F.col("corrected").isNotNull()).select(F.col("barcode").alias(part), F.col("corrected").alias("_to"))
    return reads.join(own, part, "left").withColumn(part, F.coalesce("_to", part)).drop("_to")


def substitution_rates(pairs: DataFrame, total: DataFrame) -> DataFrame:
    """Of corrections (barcode, corrected, reads): by place and pair of bases, corrections and their share of all bases read. total: one row (total_reads)."""
    each = pairs.where("barcode <> corrected").withColumn("position", F.explode(F.sequence(F.lit(1), F.length("barcode"))))
    each = each.where(masked("barcode", "position") == masked("corrected", "position"))
    each = each.select("position", F.substring("corrected", F.col("position"), F.lit(1)).alias("original_base"), F.substring("barcode", F.col("position"), F.lit(1)).alias("mutated_base"), "reads", F.length("barcode").alias("n"))
    each = each.groupBy("position", "original_base", "mutated_base").agg(F.count("*").alias("occurrences"), F.sum("reads").alias("reads"), F.max("n").alias("n"))
    return each.crossJoin(F.broadcast(total)).select("position", F.concat_ws(">", "original_base", "mutated_base").alias("feature_id"), "occurrences", "reads", F.round(F.col("reads") / (F.col("total_reads") * F.col("n")), 9).alias("substitution_frequency"))


def marginal_substitutions(rates: DataFrame, total: DataFrame) -> DataFrame:
    """Of substitution_rates(): corrections over all positions by pair of bases, and their share of all reads. total: one row (total_reads)."""
    each = rates.groupBy("feature_id").agg(F.sum("reads").alias("total_counts"))
    return each.crossJoin(F.broadcast(total)).select("feature_id", "total_counts", F.round(F.col("total_counts") / F.col("total_reads"), 9).alias("substitution_frequency"))


def base_frequencies(barcodes: DataFrame, c: str = "barcode") -> DataFrame:
    """Counts of A, C, G and T at each place."""
    each = barcodes.select(F.posexplode(F.split(c, "")).alias("position", "base")).where(F.col("base") != "")
    return each.groupBy("position").agg(*[F.count_if(F.col("base") == b).alias(f"n_{b}") for b in "ACGT"])


def plate_occupancy(barcodes: DataFrame, well: str = "index", weight: str = "reads") -> DataFrame:
    """Reads by row letter and column number of wells such as B7."""
    return barcodes.groupBy(F.regexp_extract(well, "^([A-Z]+)", 1).alias("plate_row"), F.regexp_extract(well, "([0-9]+)$", 1).cast("int").alias("plate_column")).agg(F.sum(weight).alias(weight))
