"""Variants in their leftmost, shortest form.

An insertion or deletion of a repeat's unit is the same change wherever in the repeat it is written. The changed bases turn and move left while the base before them is their last one. The reference lies in tiles that
overlap to the left, and a variant meets the tile with the base before it, so no task needs a whole contig; in one round a variant moves as far as the overlap reaches, or four times as far where the tile has that, and
those that could move on take part in the next round, with the tile they have come to. All variants are read and joined once, and each further round has only those that move on.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from quillon.sources.tables import materialise, observed

#: Bases of a tile, and bases before it that it also has, which are what a round can pass.
TILE, REACH = 4096, 64


def tiles(contigs: DataFrame, size: int = TILE, reach: int = REACH) -> DataFrame:
    """(_chrom, _tile, _first, _bases) of contigs (chrom, sequence): bases of a tile and `reach` before, and the place of the first of them, from 0."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_chrom", "_tile", "_first", "_bases"]
        made, held = [], 0
        for b in batches:
            bases = pc.fill_null(b.column(1), "")
            if pc.all(pc.less_equal(pc.utf8_length(bases), size)).as_py() and pc.all(pc.string_is_ascii(bases)).as_py():  # one tile each
                none = pa.array(np.zeros(b.num_rows, np.int64))
                yield pa.RecordBatch.from_arrays([b.column(0), none, none, pc.ascii_upper(bases)], names)
                continue
            for chrom, seq in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                seq = seq.as_py() or ""
                for a in range(0, max(len(seq), 1), size):
                    made.append((chrom, a // size, max(a - reach, 0), seq[max(a - reach, 0) : a + size].upper()))
                    held += len(made[-1][3]) + 64
                    if held > 256 * TILE:  # short contigs share a batch
                        yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*made, strict=True), strict=True)))
                        made, held = [], 0
        if made:
            yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*made, strict=True), strict=True)))

    return contigs.select("chrom", "sequence").mapInArrow(cut, "_chrom string, _tile long, _first long, _bases string")


def alike_upto(a: Column, b: Column, most: int) -> Column:
    """How many characters of two texts of at most so many are alike from the beginning, by halves: a step for each bit of the number instead of one for each character."""
    n = F.least(F.length(a), F.length(b))
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda k, s: F.when((k + s <= n) & (F.substr(a, k + 1, s) == F.substr(b, k + 1, s)), k + s).otherwise(k))


def alike(a: Column, b: Column) -> Column:
    """How many characters of two texts are alike from the beginning."""
    n = F.least(F.length(a), F.length(b))
    same = F.zip_with(F.split(F.substr(a, F.lit(1), n), ""), F.split(F.substr(b, F.lit(1), n), ""), lambda x, y: x == y)
    end = F.array_position(same, False)
    return F.when(n == 0, 0).when(n < 64, alike_upto(a, b, 63)).when(end == 0, n).otherwise(end - 1).cast("int")


def trimmed(variants: DataFrame) -> DataFrame:
    """variants with _p, the place from 0, and _r and _a, the alleles without common ends. Where an allele has a single base, as most have, an end is one comparison."""
    def common(r: Column, a: Column, end: int, more: Column) -> Column:
        n = F.least(F.length(r), F.length(a))
        one = F.substr(r, F.lit(end), F.lit(1)) == F.substr(a, F.lit(end), F.lit(1))
        return F.when(n == 0, 0).when(~one, 0).when(n == 1, 1).otherwise(more)

    tail = common(F.col("ref"), F.col("alt"), -1, alike(F.reverse("ref"), F.reverse("alt")))
    cut = lambda c: F.substr(F.col(c), F.lit(1), F.length(c) - F.col("_n"))
    out = variants.withColumn("_n", tail).withColumns({"_r": cut("ref"), "_a": cut("alt")}).withColumn("_n", common(F.col("_r"), F.col("_a"), 1, alike(F.col("_r"), F.col("_a"))))
    rest = lambda c: F.substr(F.col(c), F.col("_n") + 1)
    return out.withColumns({"_p": F.col("pos") - 1 + F.col("_n"), "_r": rest("_r"), "_a": rest("_a")}).drop("_n")


def _placed(rows: DataFrame, held: DataFrame, place: Column, size: int) -> DataFrame:
    """rows with the tile that a place is in; null bases where the reference ends before."""
    return rows.withColumn("_t", F.floor(place / size)).join(held, (F.col("chrom") == F.col("_chrom")) & (F.col("_t") == F.col("_tile")), "left").drop("_chrom", "_tile", "_t")


def _characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All characters of texts as numbers, and where each text begins among them, and the last one ends."""
    if pc.all(pc.string_is_ascii(texts)).as_py() is not False:
        texts = texts.cast(pa.large_string())
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        return np.frombuffer(texts.buffers()[2] or b"", np.uint8), at
    return np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32), np.concatenate([[0], np.cumsum(pc.utf8_length(texts).to_numpy())])


@F.arrow_udf(IntegerType())
def passed(left: pa.Array, unit: pa.Array) -> pa.Array:
    """How many characters at the end of a text are those of a unit that repeats up to that end."""
    (text, at), (turn, of) = _characters(left), _characters(unit)
    k = np.diff(of)
    n = np.where(k > 0, np.diff(at), 0)
    m, on, step = np.zeros(len(n), np.int64), np.flatnonzero(n), 4
    while len(on):
        i = m[on, None] + np.arange(step)
        same = text[at[on + 1, None] - 1 - np.minimum(i, n[on, None] - 1)] == turn[of[on + 1, None] - 1 - i % k[on, None]]
        same &= i < n[on, None]
        far = np.where(same.all(1), step, same.argmin(1))
        m[on] += far
        on, step = on[far == step], min(2 * step, 64)
    return pa.array(m, pa.int32())


def _round(rows: DataFrame, held: DataFrame, own: list[str], size: int, most: int) -> DataFrame:
    """rows (own columns, _p, _s, _gone) moved by up to `most` bases: own columns in the new form, or as they were with _p and _s where there is more to do. A null _s stays."""
    k, gone = F.length("_s"), F.col("_gone")
    behind = F.when(gone, k).otherwise(0).cast("long")  # the base that counts at a contig's beginning
    place = F.when(F.col("_s").isNull(), F.lit(0)).when(F.col("_p") > 0, F.col("_p") - 1).otherwise(behind)
    met = _placed(rows, held, place, size)
    upto = F.col("_p") - F.col("_first")
    there = F.col("_s").isNotNull() & (F.col("_p") > 0) & (upto <= F.length("_bases"))
    n = F.least(F.lit(most), upto).cast("int")
    left = F.when(there, F.substr("_bases", (upto - n + 1).cast("int"), n)).otherwise("")
    end = F.when(behind >= F.col("_first"), F.substr("_bases", (behind - F.col("_first") + 1).cast("int"), F.lit(1)))
    met = met.select(*own, "_gone", "_p", "_s", left.alias("_l"), end.alias("_end"))  # a tile goes no further than this
    moves = F.substr("_l", F.lit(-1)) == F.substr("_s", F.lit(-1))
    met = met.withColumn("_m", passed(F.when(moves, F.col("_l")).otherwise(""), F.when(moves, F.col("_s")).otherwise("")))
    met = met.withColumns({"_to": F.col("_p") - F.col("_m"), "_turn": F.col("_m") % k})
    moved = F.concat(F.substr("_s", k - F.col("_turn") + 1), F.substr("_s", F.lit(1), k - F.col("_turn")))
    far = F.when(F.col("_to") > 0, (F.col("_m") > 0) & (F.col("_m") == F.length("_l"))).otherwise((F.col("_p") > 0) & (F.coalesce(F.length("_end"), F.lit(0)) == 0))
    base = F.when(F.col("_to") == 0, F.col("_end")).when(F.col("_m") < F.length("_l"), F.substr("_l", F.length("_l") - F.col("_m"), F.lit(1)))
    met = met.select(*own, "_gone", "_to", moved.alias("_s"), base.alias("_base"), F.coalesce(far, F.lit(False)).alias("_on"))
    long = F.when(F.col("_to") > 0, F.concat("_base", "_s")).otherwise(F.concat("_s", "_base"))
    kind = rows.schema["pos"].dataType
    made = {"pos": F.greatest(F.col("_to"), F.lit(1)).cast(kind), "ref": F.when(gone, long).otherwise(F.col("_base")), "alt": F.when(gone, F.col("_base")).otherwise(long)}
    known = ~F.col("_on") & F.coalesce(F.length("_base") == 1, F.lit(False))
    on = lambda c: F.when(F.col("_on"), F.col(c))
    return met.select(*[F.when(known, made[c]).otherwise(F.col(c)).alias(c) if c in made else F.col(c) for c in own], on("_to").alias("_p"), on("_s").alias("_s"), on("_gone").alias("_gone"))


def left_aligned(variants: DataFrame, contigs: DataFrame, size: int = TILE, reach: int = REACH) -> DataFrame:
    """variants (chrom, pos from 1, ref, alt, other columns) in their leftmost, shortest form. A change before a contig's first base has the base behind it; variants whose contig or place the reference lacks, and those that change nothing, stay as they are."""
    held = materialise(tiles(contigs, size, reach))
    own, every = list(variants.columns), trimmed(variants)
    r, a = F.length("_r"), F.length("_a")
    indel = F.coalesce((r == 0) != (a == 0), F.lit(False)) & F.col("pos").isNotNull()
    other = ~indel & (F.greatest(r, a) > 0) & F.col("pos").isNotNull()
    plain = {"pos": (F.col("_p") + 1).cast(variants.schema["pos"].dataType), "ref": F.col("_r"), "alt": F.col("_a")}
    rows = every.select(*[F.when(other, plain[c]).otherwise(F.col(c)).alias(c) if c in plain else F.col(c) for c in own], F.when(indel, F.col("_p").cast("long")).alias("_p"), F.when(indel, F.concat("_r", "_a")).alias("_s"), (r > 0).alias("_gone"))
    done, n = [], 1
    while n:
        met, told = observed(_round(rows, held, own, size, 4 * reach), on=F.count("_s"))
        n = told["on"]
        done.append((met.where("_s IS NULL") if n else met).select(*own))
        rows = met.where("_s IS NOT NULL")
    return reduce(DataFrame.unionByName, done)


def without_repeats(variants: DataFrame, keys: list[str], best: Column) -> DataFrame:
    """Of the variants with the same keys, the one with the largest value of best."""
    rest = [c for c in variants.columns if c not in keys]
    return variants.groupBy(*keys).agg(F.max_by(F.struct(*rest), best).alias("_x")).select(*keys, *[F.col("_x")[c].alias(c) for c in rest])
