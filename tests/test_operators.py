import hashlib
import itertools
import math
import os
import random
import time
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.functions import columns as C
from quillon.operators import barcodes, chemistry, counts, matrices, metrics, power, ranges, reads, sequences, variants
from quillon.plans.queries import QUERIES, SQL
from quillon.plans.views import view
from quillon.sources import tables as tables_module

SF, SF_MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

#: Reads of both alleles, error, call, quality, likelihoods, log odds: computed from the model with math.lgamma.
GOLDEN = [
    (0, 0, 0.0, "0/0", 0, (0, 0, 0), 0),
    (3, 0, 0.0, "0/0", 7.977256, (0, 7.977256, 51.620406), -0.601524),
    (20, 0, 0.0, "0/0", 29.707009, (0, 29.707009, 106.344067), -1.320006),
    (1, 1, 0.0, "0/1", 27.449230, (27.44923, 0, 27.44923), -0.134655),
    (50, 50, 0.0, "0/1", 49.388191, (49.388191, 0, 49.388191), -0.374398),
    (99, 1, 1e-4, "0/0", 28.921258, (0, 28.921258, 135.621802), 0.385082),
    (99, 1, 10**-0.9, "0/0", 44.193437, (0, 44.193437, 150.893981), -1.142136),
    (0, 21, 0.0, "1/1", 30.497534, (108.101761, 30.497534, 0), -1.340145),
    (90, 10, 0.0, "0/1", 5.938542, (5.938542, 0, 88.054947), 1.139157),
]


def test_genotypes(spark):
    df = spark.createDataFrame([(r, a, e) for r, a, e, *_ in GOLDEN], "ref_reads long, alt_reads long, e double")
    got = {(r.ref_reads, r.alt_reads, r.e): r for r in variants.genotype(df, err=F.col("e")).collect()}
    for r, a, e, gt, gq, pls, lod in GOLDEN:
        x = got[r, a, e]
        assert x.gt == gt and abs(x.gq - gq) < 1e-5 and abs(x.outlier_lod - lod) < 1e-5
        assert all(abs(p - q) < 1e-5 for p, q in zip((x.pl_homref, x.pl_het, x.pl_homalt), pls, strict=True))


def test_lgamma(spark):
    xs = [0.001, 0.5, 1.0, 2.0, 3.7, 10.0, 1e3, 1e5]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(C.lgamma("x").alias("y")).collect()
    assert all(abs(r.y - math.lgamma(x)) < 1e-8 * max(1, abs(math.lgamma(x))) for r, x in zip(got, xs, strict=True))


def test_soft_filter(spark):
    rows = [(5, 0.01, 15.0, 30.0), (4, 0.5, 20.0, 40.0), (None, None, None, None), (9, 0.001, 3.0, 1.0)]
    df = spark.createDataFrame(rows, "dp int, vaf double, bq double, mq double")
    assert [r.f for r in df.select(C.soft_filter("dp", "vaf", "bq", "mq").alias("f")).collect()] == ["PASS", "lowDP", "lowDP;lowVAF", "lowVAF;lowBQ;lowMQ"]


def rounds_by_force(observed, listed, distance=1):
    """The rounds with sorted lists, one string at a time."""
    apart = lambda a, b: sum(x != y for x, y in zip(a, b, strict=True)) if len(a) == len(b) else 99
    found, pool = {}, sorted(set(listed))
    unknown = sorted(set(observed) - set(pool))
    while pool and unknown:
        hits = {b: p[-1] for b in unknown if (p := [w for w in pool if w <= b]) and apart(b, p[-1]) <= distance}
        after = {b: p[0] for b in unknown if b not in hits and (p := [w for w in pool if w >= b]) and apart(b, p[0]) <= distance}
        found |= hits | after
        pool = [w for w in pool if w not in {*hits.values(), *after.values()}]
        unknown = [b for b in unknown if b not in hits and b not in after]
        if not after:
            break
    return found


@pytest.mark.parametrize("rows", [barcodes.ROWS, 50])
def test_rounds_of_neighbours(spark, rows, monkeypatch):
    """Each part by itself, in one window or in ranges."""
    monkeypatch.setattr(barcodes, "ROWS", rows)
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("ACN") for _ in range(rng.choice([3, 4, 4, 4])))
    parts = {f"p{n}": ([word() for _ in range(rng.randint(0, 60))], [word() for _ in range(rng.randint(0, 30))]) for n in range(10)}
    parts["D"] = ["AAAAAAAA", "AAAAAAAC", "ACCCCCCC", "CCCCCCCA", "GGGGGGGT", "TTTTTTTN", "TAAAAAAA", "NNNNNNNN"], ["AAAAAAAA", "CCCCCCCC", "GGGGGGGG", "TTTTTTTT"]
    schema = "barcode_position string, barcode string"
    seen, listed = ([(p, b) for p, both in parts.items() for b in both[k]] for k in (0, 1))
    got = barcodes.correct_compat(spark.createDataFrame([*seen, ("D", None)], schema), spark.createDataFrame([*listed, ("D", None)], schema)).collect()
    want = {(p, b): b if b in own else rounds_by_force(found, own).get(b) for p, (found, own) in parts.items() for b in found}
    assert len(got) == len(want) and {(r.barcode_position, r.barcode): r.corrected for r in got} == want
    assert want["D", "CCCCCCCA"] == "CCCCCCCC" and want["D", "TAAAAAAA"] is None and sum(v is not None and v != k[1] for k, v in want.items()) > 30
    assert barcodes.correct_compat(spark.createDataFrame([], schema), spark.createDataFrame(listed, schema)).count() == 0


def test_many_rounds(spark):
    """Each round takes one listed barcode on either side of the unknown ones, so there are hundreds of rounds; a middle one near none ends a chain."""
    words = ["".join(x) for x in itertools.product("ACGT", repeat=4)]
    rng = random.Random(4)
    for gap in (0.0, 0.1):
        listed = [c + w for c in "GT" for w in words if rng.random() >= gap]
        seen = ["N" + w for w in words] + [w[:3] + "N" + w[3] for w in words[::3]]
        schema = "barcode_position string, barcode string"
        got = barcodes.correct_compat(spark.createDataFrame([("D", x) for x in seen], schema), spark.createDataFrame([("D", x) for x in listed], schema))
        want = rounds_by_force(seen, listed)
        assert {r.barcode: r.corrected for r in got.collect()} == {x: want.get(x) for x in seen}
        assert gap or len(want) > 200


def test_neighbours_at_larger_distances(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("AC") for _ in range(rng.choice([1, 2, 5, 6]))) for _ in range(60)]
    a, b = (spark.createDataFrame([(x,) for x in w], f"{c} string") for c, w in (("a", words[:30]), ("b", words[30:])))
    for d in (0, 1, 2, 3):
        want = {(x, y, n) for x in words[:30] for y in words[30:] if len(x) == len(y) and (n := sum(p != q for p, q in zip(x, y, strict=True))) <= d}
        got = barcodes.neighbours(a, b, "a", "b", distance=d).collect()
        assert len(got) == len(want) and set(map(tuple, got)) == want


def test_complete_correction(spark):
    listed = spark.createDataFrame([(x,) for x in ("AAAAAAAA", "CCCCCCCC")], "barcode string")
    seen = spark.createDataFrame([(x,) for x in ("AAAAAAAA", "CAAAAAAA", "GGAAAAAA", None)], "barcode string")
    assert {r.barcode: r.corrected for r in barcodes.correct_complete(seen, listed).collect()} == {"AAAAAAAA": "AAAAAAAA", "CAAAAAAA": "AAAAAAAA", "GGAAAAAA": None, None: None}


def test_short_read_fails(spark):
    df = spark.createDataFrame([("a", "ACGT")], "read_id string, sequence string")
    with pytest.raises(Exception, match="shorter"):
        reads.extract_parts(df, reads.LAYOUT_DNA).collect()


def test_assert_unique(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert reads.assert_unique(df, "k").count() == 2
    with pytest.raises(Exception, match="repeated k"):
        reads.assert_unique(df.union(df), "k").collect()


def test_compose_needs_all_parts(spark):
    df = spark.createDataFrame([("D", "C", "B", "A"), ("D", None, "B", "A")], "D string, C string, B string, A string")
    assert [r.barcode for r in reads.compose_barcode(df).collect()] == ["D_C_B_A", None]


def otsu_by_force(values, floor):
    """The threshold from every value, with bins counted one by one."""
    if not values:
        return floor
    lo, hi = min(values), max(values)
    if lo == hi:
        return max(floor, lo)
    x = [math.log10(v + 1) for v in values]
    first, width = min(x), (max(x) - min(x)) / 256
    at = [min(255, int((v - first) / width)) for v in x]
    best = (-1.0, 0)
    for cut in range(255):
        low, high = ([first + width * (b + 0.5) for b in at if (b <= cut) == side] for side in (True, False))
        if low and high:
            best = max(best, (len(low) * len(high) * (sum(low) / len(low) - sum(high) / len(high)) ** 2, -cut))
    return int(min(max(round(10 ** (first + width * (0.5 - best[1])) - 1), floor), hi))


def test_otsu(spark):
    rng = random.Random(3)
    for values in ([], [7] * 5, [70] * 5, [1] * 50 + [2] * 40 + [3] * 30 + [1000] * 10 + [1100] * 9, [rng.randint(1, 30) for _ in range(200)] + [rng.randint(300, 4000) for _ in range(60)]):
        df = spark.createDataFrame([(v, v % 3) for v in values], "a long, b long")
        assert counts.otsu_of(df, a=20, b=1) == {"a": otsu_by_force(values, 20), "b": otsu_by_force([v % 3 for v in values], 1)}


def test_empty_counts(spark):
    none = spark.createDataFrame([], "barcode string, chrom string, reads long")
    assert counts.cells(none).count() == 0 and counts.per_amplicon(none.withColumnRenamed("reads", "n_reads"), 5).count() == 0
    assert counts.depth_histogram(none.withColumnRenamed("reads", "n_reads")).agg(F.sum("n_cell_amplicons")).first()[0] == 0


def test_saturation_depths():
    assert counts.saturation_depths(12_000, 1) == [12000, 10000, 2500, 1000, 500]
    assert counts.saturation_depths(5000, 1) == [5000, 2500, 1000, 500] and counts.saturation_depths(5, 0) == [0]


def saturation_by_force(rows, depths):
    """rows (read_name, barcode, GN, UB) against the depths: depth to medians and saturation; the first depth has all rows."""
    rows = sorted(rows, key=lambda r: (hashlib.md5(f"{r[0]}:42".encode()).hexdigest(), r[0]))
    n_cells, out = len({r[1] for r in rows}), {0: (0.0, 0.0, 0.0)}
    for d in depths:
        own = rows if d == depths[0] else rows[: d * n_cells]
        umis, genes = defaultdict(set), defaultdict(set)
        for _, b, g, u in own:
            umis[b].add((g, u))
            genes[b].add(g)
        out[d] = (float(np.median([*map(len, umis.values())])), float(np.median([*map(len, genes.values())])), round(1 - sum(map(len, umis.values())) / len(own), 6))
    return out


def test_saturation_of_all_reads(spark):
    rng = random.Random(4)
    rows = [(f"r{i}", f"c{rng.randint(0, 2)}", f"g{rng.randint(0, 40)}", f"u{rng.randint(0, 60)}") for i in range(31_001)]
    df = spark.createDataFrame(rows, "read_name string, barcode string, GN string, UB string").withColumn("mapping_quality", F.lit(255))
    other = df.limit(50).withColumn("barcode", F.lit("no cell"))
    curve = counts.saturation_of(df.union(other), df.select("barcode").distinct(), F.md5(F.concat_ws(":", "read_name", F.lit("42"))))
    got = {r[0]: tuple(r)[1:] for r in curve.collect()}
    assert got == saturation_by_force(rows, [10333, 10000, 2500, 1000, 500])
    assert counts.saturation_at(curve).first().asDict() == {"saturation_10000": got[10000][2], "saturation_20000": None}
    assert [tuple(r) for r in counts.saturation_of(df.limit(0), df.limit(0).select("barcode"), F.col("read_name")).collect()] == [(0, 0.0, 0.0, 0.0)]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_saturation_query_sees_all_reads(spark):
    valid = reads.valid_rna(view(spark, SF, "umis")).select("read_name", "barcode", "GN", "UB").collect()
    top = len(valid) // len({r.barcode for r in valid})
    assert {r[0]: tuple(r)[1:] for r in QUERIES["saturation_curve"](spark, SF).collect()} == saturation_by_force(list(map(tuple, valid)), [top])


def test_reads_of_one_name(spark):
    """Reads that share their name are sampled in the same order however they lie, by barcode, gene and molecule."""
    rows = sorted(("r", "c", f"g{i % 7}", f"u{min(i, 400)}") for i in range(600))
    want = saturation_by_force(rows, [600, 500])
    for own in (rows, rows[::-1]):
        df = spark.createDataFrame(own, "read_name string, barcode string, GN string, UB string").withColumn("mapping_quality", F.lit(255)).coalesce(1)
        assert {r[0]: tuple(r)[1:] for r in counts.saturation_of(df, df.select("barcode").distinct(), F.md5("read_name")).collect()} == want


def test_saturation_rounds_as_sql(spark):
    """333 of 640 reads bring no molecule: 0.5203125, where SQL rounds down, as it does after the product with 10^6."""
    df = spark.range(640).select(F.format_string("r%04d", "id").alias("read_name"), F.lit("c").alias("barcode"), F.lit("g").alias("GN"), F.concat(F.lit("u"), F.col("id") % 307).alias("UB"), F.lit(255).alias("mapping_quality"))
    assert counts.saturation_curve(df, [640], 1, F.col("read_name")).first().saturation == duckdb.sql("SELECT round(1 - 307 / 640, 6)").fetchall()[0][0]


def test_samples_below():
    assert counts.saturation_depths(1_730_000, 1, 1_000_000)[:3] == [1_730_000, 995_000, 990_000] and counts.saturation_depths(12_000, 1, 1_000_000) == counts.saturation_depths(12_000, 1)
    assert counts.saturation_depths(1_730_000, 1)[1] == 1_725_000


@pytest.mark.skipif(not os.path.isdir(SF_MORE), reason="no test tables")
def test_nested_samples_as_sql(spark):
    """saturation_nested has its SQL's rows once the order of reads that share a name, which the SQL leaves open, is set."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{SF_MORE}/lineitem.parquet')")
    sql = SQL["saturation_nested"].replace("read_name) AS r", 'read_name, barcode, "GN", "UB", mapping_quality) AS r')
    assert sql != SQL["saturation_nested"]
    assert sorted(map(tuple, QUERIES["saturation_nested"](spark, SF_MORE).collect())) == sorted(con.execute(sql).fetchall())


def test_samples_are_nested(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("read_name"))
    few, many = ({r.read_name for r in counts.exact_sample(df, n, counts.seeded(1), "read_name").collect()} for n in (50, 200))
    assert len(few) == 50 and len(many) == 200 and few < many


def test_ranks(spark):
    df = spark.createDataFrame([(i % 7, f"b{i}") for i in range(100)], "total_counts long, barcode string")
    got = sorted((r["rank"], -r.total_counts, r.barcode) for r in counts.knee_rank(df).collect())
    assert [g[0] for g in got] == list(range(1, 101)) and [g[1:] for g in got] == sorted(g[1:] for g in got)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_ranks_of_many_rows(spark, adaptive):
    """More rows than any sample, carried columns, partitions that Spark merges or not: no rank is missing or taken twice."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
        n = 2_000_000
        df = spark.range(n).select((F.pmod(F.xxhash64("id"), F.lit(1000)) * F.pmod("id", F.lit(3))).alias("total_counts"), F.md5(F.col("id").cast("string")).alias("barcode"), F.repeat(F.lit("x"), 20).alias("more"))
        got = counts.knee_rank(df).agg(F.count("*"), F.count_distinct("rank"), F.min("rank"), F.max("rank")).first()
        assert tuple(got) == (n, n, 1, n)
        some = counts.knee_rank(df).where("rank <= 200").select("rank", "total_counts", "barcode").collect()
        want = df.orderBy(F.desc("total_counts"), "barcode").limit(200).collect()
        assert [(r.total_counts, r.barcode) for r in sorted(some, key=lambda r: r["rank"])] == [(r.total_counts, r.barcode) for r in want]
        total = df.agg(F.sum("total_counts")).first()[0]
        sums = counts.cumulative(df.withColumn("total_counts", F.col("total_counts") + 1), 2.0).agg(F.max("cumulative"), F.count("*")).first()
        assert tuple(sums) == (total + n, n)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_ranges_with_nulls_and_hot_keys(spark):
    rows = [(None, f"n{i}") for i in range(30)] + [(1, f"k{i:03}") for i in range(400)] + [(i, "z") for i in range(2, 60)]
    df = spark.createDataFrame(rows, "a long, b string").repartition(7)
    got = [r for r in sorted(ranges.ranked(df, "i", "a", "b").collect(), key=lambda r: r.i)]
    assert [r.i for r in got] == list(range(1, len(rows) + 1)) and [(r.a, r.b) for r in got] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    sums = {r.b: r.s for r in ranges.running(df.where("a = 1"), "s", "a", "b").collect()}
    assert sums == {f"k{i:03}": i + 1 for i in range(400)}
    assert ranges.ranked(df.limit(0), "i", "a").count() == 0


def test_many_ranges(spark):
    """Ranks, sums and nearest keys over many ranges are those of one sorted list."""
    rng = random.Random(6)
    rows = [(rng.choice([None, 7, 7, 7, rng.randint(-50, 50)]), f"k{i:04}", rng.choice([None, rng.randint(-5, 5)]), rng.random()) for i in range(1500)]
    df = spark.createDataFrame(rows, "a long, b string, v int, w double").repartition(5)
    for desc in ((), ("a",)):
        want = sorted(rows, key=lambda r: ((r[0] is not None, r[0] or 0) if not desc else (r[0] is None, -(r[0] or 0)), r[1]))
        got = ranges.ranked(df, "i", "a", "b", desc=desc, rows=40)
        assert got.columns == [*df.columns, "i"] and dict(got.dtypes)["i"] == "bigint"
        assert [tuple(r) for r in sorted(got.collect(), key=lambda r: r.i)] == [(*r, i) for i, r in enumerate(want, 1)]
        for value, kind in (("v", "bigint"), ("w", "double")):
            out = ranges.running(df, "s", value, "a", "b", desc=desc, rows=40)
            assert dict(out.dtypes)["s"] == kind
            sums, total, at = {r.b: r.s for r in out.collect()}, None, df.columns.index(value)
            for r in want:
                total = total if r[at] is None else (total or 0) + r[at]
                assert (sums[r[1]] is None) == (total is None) and (total is None or abs(sums[r[1]] - total) < 1e-9)
    keys = [f"{rng.randint(0, 3)}{rng.randint(0, 400):03}" for _ in range(800)]
    both = spark.createDataFrame([(k, 1, None) for k in keys] + [(k, 0, k) for k in sorted(set(keys[::7])) if k[0] != "2"], "k string, side int, m string")
    known = sorted(r.k for r in both.where("side = 0").collect())
    for backward in (True, False):
        got = {(r.k, r.m) for r in ranges.nearest(both, "k", "m", "side", backward, rows=30).where("side = 1").collect()}
        assert got == {(k, max((x for x in known if x <= k), default=None) if backward else min((x for x in known if x >= k), default=None)) for k in keys}


@pytest.mark.parametrize("name", ["_at", "_range", "_before", "_sum", "_tie"])
def test_names_of_ranks(spark, name):
    """A rank or a sum may have any name, also over many ranges."""
    df = spark.range(300).select("id", F.lit(2).alias("v"))
    got = ranges.ranked(df, name, "id", rows=50)
    assert got.columns == ["id", "v", name] and {(r[0], r[2]) for r in got.collect()} == {(i, i + 1) for i in range(300)}
    got = ranges.running(df, name, "v", "id", rows=50)
    assert got.columns == ["id", "v", name] and {(r[0], r[2]) for r in got.collect()} == {(i, 2 * i + 2) for i in range(300)}


def test_many_depths(spark):
    """Counts at each of 400 depths are those of the sample itself, with nulls; rows don't multiply by the depths."""
    rng = random.Random(12)
    rows = [(f"r{i:04}", rng.choice("abc"), rng.choice(["g1", "g2", "g3", None]), rng.choice(["u1", "u2", None]), rng.choice([3, 255, None])) for i in range(1200)]
    df = spark.createDataFrame(rows, "read_name string, barcode string, GN string, UB string, mapping_quality int")
    got = counts.saturation_curve(df, list(range(1, 401)), 3, F.col("read_name"))
    got = {r.depth: (r.median_counts_per_cell, r.median_genes_per_cell, r.saturation) for r in got.collect()}
    for d in range(1, 401):
        own = rows[: 3 * d]
        cells = [[r for r in own if r[1] == c] for c in sorted({r[1] for r in own})]
        molecules = [len({r[2:4] for r in c if None not in r[2:4]}) for c in cells]
        genes = [len({r[2] for r in c} - {None}) for c in cells]
        distinct = len({r[1:] for r in own if None not in r[1:]})
        assert got[d] == (float(np.median(molecules)), float(np.median(genes)), pytest.approx(round(1 - distinct / len(own), 6), abs=1.1e-6))
    assert len(got) == 400


def test_kmers_are_dealt_by_their_number(spark):
    """k-mers of one file's sequences, one of them long, are made in as many tasks as they need, and are those of the whole sequences."""
    rng = random.Random(13)
    seqs = {f"s{i}": "".join(rng.choice("ACGT") for _ in range(n)) for i, n in enumerate([5, 6, 7, 300, sequences.PIECE + 5, sequences.PIECE + 6, 20_000])}
    df = spark.createDataFrame(list(seqs.items()), "id string, sequence string").coalesce(1)
    got = sequences.kmers(df, 6, both_strands=False, places=1000)
    assert {(r.id, r.kmer) for r in got.collect()} == {(i, x[p : p + 6]) for i, x in seqs.items() for p in range(len(x) - 5)}
    seen = sequences.kmers(df, 6, both_strands=False, places=1000).groupBy("id", "kmer").count().where("count > 1").count()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert seen == 0 and "Repartition 29" in plan


def test_nearest_by_groups(spark, monkeypatch):
    """Nearest keys of a group, over one range and over many, with empty groups, groups of many ranges and a null group."""
    rng = random.Random(8)
    group = lambda: rng.choice(["a", "b", "b", "b", "c", None])
    left = [(group(), f"{rng.randint(0, 9999):04}") for _ in range(900)] + [("d", "0001"), ("d", "9999")]
    right = [(g, f"{rng.randint(0, 9999):04}") for g in rng.choices(["a", "b", "b", None], k=60)]
    a, b = (spark.createDataFrame(x, "g string, k string") for x in (left, right))
    for backward in (True, False):
        want = sorted((str(g), k, str(max((x for h, x in right if h == g and x <= k), default=None) if backward else min((x for h, x in right if h == g and x >= k), default=None))) for g, k in left)
        for rows in (10_000, 50):
            monkeypatch.setattr(ranges.nearest, "__defaults__", (True, rows, ()))
            got = barcodes.asof(a, b, "k", ["g"], backward)
            assert got.columns == ["g", "k", "match"] and sorted((str(r.g), r.k, str(r.match)) for r in got.collect()) == want


def test_next_keys_take_one_pass(spark):
    """Half a minute is more than enough for one group of 200,000 keys; looking ahead anew from each key takes far longer."""
    own = spark.range(200_000).select(F.lit(0).alias("g"), F.format_string("%06d", "id").alias("k"))
    start = time.monotonic()
    got = barcodes.asof(own, own.where("k = '199990'"), "k", ["g"], backward=False)
    assert got.where("match = '199990'").count() == 199_991 and time.monotonic() - start < 30


def test_ranges_grow_with_the_rows(spark):
    """Ten times the rows have ten times the ranges, and a key with half the rows has half of them."""
    seen = []
    for n in (3000, 30_000):
        df = spark.range(n).select(F.when(F.col("id") % 2 == 0, F.lit(5)).otherwise(F.col("id") % 1000).alias("k"), "id")
        table, rows = ranges.counted(df)
        assert rows == n
        sizes = [r["count"] for r in ranges.ranged(table, [F.col("k")], ranges._ranges(rows, 100)).groupBy("_range").count().collect()]
        seen.append(len(sizes))
        assert max(sizes) < 0.05 * n
    assert seen[1] > 8 * seen[0]
    assert ranges._ranges(20_000_000, ranges.ROWS) > 64


def test_asof_without_columns(spark):
    rng = random.Random(2)
    left, right = sorted({f"{rng.randrange(10**6):06}" for _ in range(3000)}), sorted({f"{rng.randrange(10**6):06}" for _ in range(40)})
    a, b = (spark.createDataFrame([(x,) for x in v], "k string") for v in (left, right))
    for backward in (True, False):
        got = {r.k: r.match for r in barcodes.asof(a, b, "k", backward=backward).collect()}
        near = lambda x: max((y for y in right if y <= x), default=None) if backward else min((y for y in right if y >= x), default=None)  # noqa: B023, E731
        assert got == {x: near(x) for x in left}


def knee_of_array(counted, window=5):
    """The sharpest bend of a whole curve."""
    x, y = np.log10(np.arange(1, len(counted) + 1)), np.log10(np.asarray(counted, float) + 1)
    y = np.convolve(np.pad(y, window // 2, mode="edge"), np.ones(window) / window, "valid")[: len(x)]
    d1 = np.gradient(y, x)
    bend = np.abs(np.gradient(d1, x)) / (1 + d1**2) ** 1.5
    lo, hi = int(len(x) * 0.01), int(len(x) * 0.9)
    return lo + int(np.argmax(bend[lo:hi])) + 1


def test_knee_over_blocks(spark):
    """Blocks of any size, down to less than what a bend depends on, give the whole curve's bend."""
    rng = random.Random(3)
    for n in (10, 57, 1000):
        curve = sorted((rng.choice([rng.randint(900, 1100), rng.randint(1, 9)]) for _ in range(n)), reverse=True)
        df = spark.createDataFrame([(v, f"b{i}") for i, v in enumerate(curve)], "total_counts long, barcode string")
        for block in (3, 64, counts.ROWS):
            assert counts.knee_point(df, block=block).first()["rank"] == knee_of_array(curve)
    assert counts.knee_point(df.limit(9)).first()["rank"] is None and counts.knee_point(df.limit(0)).first()["rank"] is None


def test_knee_and_inflection(spark):
    curve = np.array([5000 - i for i in range(200)] + [max(1, 50 - i // 40) for i in range(800)])
    assert abs(knee_of_array(curve) - 200) < 25
    df = spark.createDataFrame([(int(v),) for v in curve], "n long")
    bins, centres = counts.log_bins(df, "n")
    assert bins.tolist() == np.histogram(np.log10(curve + 1.0), 100)[0].tolist()
    assert 50 < counts.inflection_minimum(bins, centres) < 4800 and counts.inflection_minimum(np.arange(100.0), centres) == 100.0


def test_similarity_of_common_kmers(spark):
    """A k-mer in every sequence: the same pairs whatever the blocks."""
    rows = [(i, "ACGTACGTAC" + "".join(random.Random(i).choice("ACGT") for _ in range(30))) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, sequence string")
    sets = {i: {min(s[j : j + 8], s[j : j + 8][::-1].translate(str.maketrans("ACGT", "TGCA"))) for j in range(len(s) - 7)} for i, s in rows}
    want = {(a, b): round(len(sets[a] & sets[b]) / min(len(sets[a]), len(sets[b])), 6) for a, b in itertools.combinations(sets, 2) if sets[a] & sets[b]}
    for common in (64, 5):
        assert {(r.ref_1, r.ref_2): r.similarity for r in sequences.similarity(df, 8, common=common).collect()} == want


def test_references(spark):
    fasta = spark.createDataFrame([("A1", {"m5": hashlib.md5(b"ACGT").hexdigest(), "snp_pos": "5|"}, [], "acgt"), ("A1", {}, ["x"], ""), ("b-1", {"amplicon_start": "-3", "zz": "1"}, None, "ACN")], "id string, fields map<string,string>, bad array<string>, sequence string")
    got = sorted((r.id, r.level, r.rule) for r in sequences.reference_problems(fasta).collect())
    assert got == sorted([("A1", "warning", "lowercase"), ("A1", "error", "token"), ("A1", "error", "empty"), ("A1", "error", "duplicate"), ("b-1", "error", "id"), ("b-1", "warning", "key"), ("b-1", "error", "amplicon_start")])
    assert [tuple(r) for r in sequences.reference_problems(fasta.limit(0)).collect()] == [("-", "error", "no records", "")]


CHEMISTRY = """
c1:
  description: one
  structure:
    rna: {pattern: DDDDOOAAAAHHUU, mappings: {barcode: {D: Barcode D, A: Barcode A}, handle: {H: Handle}, UMI: {U: UMI}, linker: {O: Linker}}}
    dna: {offset: 2, pattern: DDDDOOAAAA, mappings: {barcode: {D: Barcode D, A: Barcode A}, linker: {O: Linker}}}
  references: {barcode: {path: b.csv}, sample_index: {path: none.csv}}
  demultiplexing: {parts: A}
"""


def test_chemistry(spark):
    ref = spark.createDataFrame([("D", "ACGT", "A1"), ("A", "AAAA", "B1")], "symbol string, sequence string, well_coordinate string")
    found = chemistry.compiled(chemistry.load(CHEMISTRY), lambda path: (500, ref))["c1"]
    assert chemistry.layout(found, "dna", "barcode") == {"D": (3, 4), "A": (9, 4)} and chemistry.least_length(found, "dna") == 12 and chemistry.least_length(found, "rna") == 14
    assert found["demultiplexing_strategy"] == {"type": "full", "symbols": ["A"]} and list(found["references"]) == ["barcode"]
    only = chemistry.load(CHEMISTRY.replace("dna: {offset: 2, pattern: DDDDOOAAAA, mappings: {barcode: {D: Barcode D, A: Barcode A}", "dna: {offset: 2, pattern: DDDDOO, mappings: {barcode: {D: Barcode D}"))
    assert chemistry.compiled(only)["c1"]["demultiplexing_strategy"]["type"] == "partial" and '"id": "c1"' in chemistry.to_json(chemistry.compiled(only))
    got = reads.extract_parts(spark.createDataFrame([("r", "ttAAAACCGGGG")], "id string, sequence string"), chemistry.layout(found, "dna", "barcode")).first()
    assert (got.D, got.A) == ("AAAA", "GGGG")
    for pattern, why in (("DDOODD", "stretches"), ("DDOOX", "nothing is mapped"), ("DD", "pattern lacks")):
        with pytest.raises(ValueError, match=why):
            chemistry.parts_of(pattern, {"barcode": {"D": "d"}, "linker": {"O": "o"}})
    with pytest.raises(ValueError, match="unknown types"):
        chemistry.parts_of("D", {"odd": {"D": "d"}})
    for size, table, why in ((200_000, ref, "bytes"), (5, ref.drop("sequence"), "columns"), (5, ref.where("symbol = 'D'"), "symbols")):
        with pytest.raises(ValueError, match=why):
            chemistry.compiled(chemistry.load(CHEMISTRY), lambda path, s=size, t=table: (s, t))
    with pytest.raises(ValueError, match="pattern is missing"):
        chemistry.load("c: {structure: {dna: {}}}")
    with pytest.raises(ValueError, match="aren't mapped"):
        chemistry.compiled(chemistry.load(CHEMISTRY.replace("parts: A", "parts: Z")))


def test_matrix_errors(spark):
    comp = spark.createDataFrame([("c1", "A1", 0, 3, 1), ("c1", "A1", 9, 2, 0)], "barcode string, feature string, pos_local_0based long, DP long, nonref long")
    cols = spark.createDataFrame([("A1", 1, 0)], "feature string, pos long, col long")
    calls = spark.createDataFrame([("c1", "A1", 0, 2, 40.0)], "barcode string, feature string, pos_local_0based long, gt_code byte, gq double")
    rows = matrices.rows_of(comp)
    ok = matrices.snv_entries(comp.where("pos_local_0based = 0"), rows, cols, calls).first()
    assert (ok["row"], ok.col, ok.gt_code, ok.gq) == (0, 0, 2, 40.0)
    none = matrices.snv_entries(comp.where("pos_local_0based = 0"), rows, cols, calls.limit(0)).first()
    assert none.gt_code == -1 and math.isnan(none.gq)
    with pytest.raises(Exception, match="without a reference"):
        matrices.snv_entries(comp, rows, cols, calls).collect()
    with pytest.raises(Exception, match="repeated"):
        matrices.snv_entries(comp.where("pos_local_0based = 0"), rows, cols, calls.union(calls)).collect()


def test_reports(spark, tmp_path):
    dictionary = spark.createDataFrame([("DNA", "barcode", "fraction_x", "X", "d", "Both", True, "0.5", None, None, "0.9", None), ("DNA", "barcode", "n", "N", "d", "single", True, None, None, None, None, None), ("DNA", "gene_expression", "n", "N", "d", "both", False, None, "3", None, None, "{:.1f}")],
                                       "library_type string, modality string, metric_key string, human_readable_name string, description string, report string, customer_facing boolean, min_warning_threshold string, max_warning_threshold string, min_failure_threshold string, max_failure_threshold string, format string")
    own = metrics.records(spark, "s1", "DNA", "none", "p", {"fraction_x": 0.25, "n": 1234.0, "other": 1}).unionByName(metrics.records(spark, "s2", "DNA", "gene_expression", "p", {"n": 7.0}))
    config, tables = metrics.sections(own, dictionary, "aggregated", True)
    assert config["custom_content"]["order"] == ["metrics_dna_barcode", "metrics_dna_gene_expression"] and config["sp"]["metrics_dna_barcode"] == {"fn": "metrics_dna_barcode.tsv"}
    head = config["custom_data"]["metrics_dna_barcode"]["headers"]
    assert list(head) == ["Sample", "fraction_x"] and head["fraction_x"]["format"] == "{:.3f}" and head["fraction_x"]["cond_formatting_rules"] == {"warn": [{"lt": 0.5}], "fail": [{"gt": 0.9}]}
    assert config["custom_data"]["metrics_dna_gene_expression"]["headers"]["n"]["format"] == "{:.1f}" and config["custom_data"]["metrics_dna_gene_expression"]["section_name"] == "DNA Gene Expression Metrics"
    assert [tuple(r) for r in tables["metrics_dna_barcode"].collect()] == [("s1", 0.25)]
    assert metrics.sections(own, dictionary, "single", False)[0]["custom_content"]["order"] == ["metrics_dna_barcode"]
    shown = {(r.section, r.metric_key): r.shown for r in metrics.section_rows(own, dictionary, "single", True).collect()}
    assert shown == {("metrics_dna_barcode", "fraction_x"): "0.250", ("metrics_dna_barcode", "n"): "1,234", ("metrics_dna_gene_expression", "n"): "7.0"}
    with pytest.raises(ValueError):
        metrics.visible(dictionary, "all", True)
    tables_module.write_yaml(spark, config, f"file://{tmp_path}/c.yaml")
    import yaml

    assert yaml.safe_load((tmp_path / "c.yaml").read_text()) == config


def test_records(spark, tmp_path):
    one = metrics.records(spark, "s", "DNA", "m", "p", {"b": 2, "a": 1.5})
    assert [r.metric_key for r in one.collect()] == ["a", "b"] and metrics.extend(one, one).count() == 4
    for wrong in (lambda: metrics.records(spark, "s", "XNA", "m", "p", {}), lambda: metrics.extend(one, one.drop("value")), lambda: metrics.status(spark, "s", "DNA", "m", "p", "NO_SUCH", "x"), lambda: metrics.write_records(one, "x", "txt")):
        with pytest.raises(ValueError):
            wrong()
    for wrong in (lambda: metrics.records(spark, "s", "DNA", "m", "p", {"a": "text"}), lambda: metrics.status(spark, "s", "DNA", "m", "p", "NO_CELLS", 5)):
        with pytest.raises(TypeError):
            wrong()
    assert metrics.status(spark, "s", "DNA", "m", "p", "NO_CELLS", "none").first().reason_code == "NO_CELLS"
    assert not metrics.write_records(one.limit(0), f"{tmp_path}/none") and metrics.write_records(one, f"{tmp_path}/some") and spark.read.parquet(f"{tmp_path}/some").count() == 2


def test_metrics(spark):
    assert metrics.records(spark, "s", "DNA", "m", "p", {}).count() == 0
    both = metrics.records(spark, "s", "DNA", "m", "p", {"a": 1, "b": None})
    assert [r.value for r in metrics.aggregate(both).collect()] == [1.0, None]


def plain_call(k, n, eps=C.EPS, rho=C.RHO):
    """Genotype and quality of k of n from the model, term by term."""
    if not n:
        return 0, 0.0
    s = (1 - rho) / rho
    ln = lambda x, y: math.lgamma(x) + math.lgamma(y) - math.lgamma(x + y)
    ls = [(ln(k + t * s, n - k + (1 - t) * s) - ln(t * s, (1 - t) * s)) / math.log(10) for t in (eps, 0.5, 1 - eps)]
    pls = [round(-10 * (x - max(ls)), 9) for x in ls]
    return pls.index(0.0), min(99.0, sorted(pls)[1])


def plain_pmf(n, t, rho=C.RHO):
    s = (1 - rho) / rho
    ln = lambda x, y: math.lgamma(x) + math.lgamma(y) - math.lgamma(x + y)
    return [math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + ln(k + t * s, n - k + (1 - t) * s) - ln(t * s, (1 - t) * s)) for k in range(n + 1)]


def test_power_of_a_depth():
    assert abs(sum(power.pmf(30, 0.3)) - 1) < 1e-9 and list(power.pmf(3, 1.0)) == [0, 0, 0, 1] and list(power.pmf(2, 0.0)) == [1, 0, 0]
    assert power.depth_for(30, 0) == 21 and power.depth_for(30, 1) == 4 and power.depth_for(98, 1) is None
    assert power.poisson_count(1.0, 0.05) == 4 and power.poisson_tail(0, 0.0) == 1.0 and power.poisson_tail(1, 0.0) == 0.0
    for n in (0, 1, 3, 20, 77, 2500):
        g, q = power.calls(n)
        want = [plain_call(k, n) for k in range(n + 1)]
        assert g.tolist() == [w[0] for w in want] and np.allclose(q, [w[1] for w in want], atol=1e-6)
        if n:
            p = plain_pmf(n, C.EPS)
            assert np.allclose(power.pmf(n, C.EPS), p)
            assert abs(power.false_carriers(n) - sum(x for x, (s, v) in zip(p, want, strict=True) if s and v >= 30)) < 1e-9


def test_power_report(spark):
    rng = random.Random(6)
    rows = []
    for c in range(40):
        for site in range(12):
            n = rng.choice([0, 3, 8, 25, 40, 3000])
            k = sum(rng.random() < (0.5 if site < 6 else 0.001) for _ in range(n)) if n < 3000 else (1500 if site < 6 else 2)
            if site < 6 and rng.random() < 0.08:
                k = 0
            rows.append((f"c{c}", "A1", site, n - k, k, rng.uniform(0, 60), 1 + site % 3))
    df = spark.createDataFrame(rows, "barcode string, feature string, pos_local_0based long, ref_reads long, alt_reads long, gq double, n_callers int")
    f = power.compute(df, "s")
    depth = [r[3] + r[4] for r in rows]
    rate = {n: power.false_carriers(n) for n in set(depth)}
    lam = defaultdict(float)
    for r in rows:
        lam[r[2]] += rate[r[3] + r[4]]
    assert (f["n_cells"], f["n_sites"], f["n_observations"], f["depth_max"]) == (40, 12, 480, 3000)
    assert np.allclose([f["depth_p10"], f["depth_median"], f["depth_p90"]], np.quantile(depth, [0.1, 0.5, 0.9])) and abs(f["depth_mean"] - np.mean(depth)) < 1e-9
    assert abs(f["expected_false_carriers"] - sum(lam.values())) < 1e-9 and abs(f["false_carriers_per_site_max"] - max(lam.values())) < 1e-12
    assert abs(f["callable_fraction_het"] - np.mean([max([q for g, q in (plain_call(k, n) for k in range(n + 1)) if g == 1], default=0) >= 30 for n in depth])) < 1e-9
    few = {k: v for k, v in lam.items() if 1 + k % 3 >= 2}
    assert f["scoped_n_sites"] == len(few) and abs(f["scoped_expected_false_carriers"] - sum(few.values())) < 1e-9
    assert f["c_min_observed"] == power.poisson_count(max(lam.values()), 0.05 / 12) and abs(f["observed_pass_fraction"] - np.mean([r[5] >= 30 for r in rows])) < 1e-9
    pool = {s: sum(r[4] for r in rows if r[2] == s) / max(1, sum(r[3] + r[4] for r in rows if r[2] == s)) for s in range(12)}
    seen = [r[4] / (r[3] + r[4]) for r in rows if r[3] + r[4] >= 20 and 0.35 <= pool[r[2]] <= 0.65]
    assert f["ado_measured"] and f["ado_observations"] == len(seen) and abs(f["ado"] - np.mean([v <= 0.1 or v >= 0.9 for v in seen])) < 1e-5
    assert f["c_true_min"] == max(f["c_true_counting"], f["c_true_bulk"]) and f["binding_constraint"] in (power.BULK, power.NOISE, power.DEPTH, power.DROPOUT, power.COUNTING)
    assert power.compute(df, "s", ado=1.0)["c_true_bulk"] == math.inf and "inf" in power.text(power.compute(df, "s", ado=1.0))
    t = {r.quantity: r for r in power.table(spark, f).collect()}
    assert t["n_cells"].value == 40 and t["binding_constraint"].text == f["binding_constraint"] and t["rho"].provenance == "inherited" and len(t) == len(power.ROWS) + 1
    assert f["binding_constraint"] in power.text(f)
    with pytest.raises(ValueError):
        power.compute(df, gq_calibration="guessed")
    empty = power.compute(df.limit(0), "none")
    assert empty["n_cells"] == 0 and empty["ado"] == power.DEFAULT_ADO and power.text(empty)


def test_padding(spark):
    obs = spark.createDataFrame([("a", 3, 0.5, True, "x", 2, 40.0)], "barcode string, n long, f double, b boolean, s string, gt_code int, gq double")
    axis = spark.createDataFrame([("a",), ("z",)], "barcode string")
    z = variants.pad_cells(obs, axis).where("barcode = 'z'").first()
    assert (z.n, z.f, z.b, z.s, z.gt_code) == (0, 0.0, False, "na", -1) and math.isnan(z.gq)


def test_poisson_counts_of_any_mean():
    for mean, alpha in ((0.0, 0.05), (3.5, 1e-9), (20_000.0, 0.05), (3e5, 1e-12)):
        c = power.poisson_count(mean, alpha)
        assert power.poisson_tail(c, mean) <= alpha and (c == 1 or power.poisson_tail(c - 1, mean) > alpha)
    assert power.poisson_count(20_000.0, 0.05) > 20_000 and abs(power.poisson_tail(4, 1.0) - (1 - sum(math.exp(-1) / math.factorial(k) for k in range(4)))) < 1e-15
    assert abs(power.poisson_tail(2, 50.0) - 1) < 1e-12 and 0 < power.poisson_tail(200, 20.0) < 1e-100
    with pytest.raises(ValueError, match="nothing"):
        power.poisson_count(1.0, 0.0)


def test_dense_rows(spark):
    df = spark.createDataFrame([(0, 1, 5.0), (0, 4, 6.0), (1, 0, None), (2, None, None)], "row long, col long, v double")
    got = {r.row: r["values"] for r in matrices.dense(df, "v", 6, -1.0).collect()}
    assert got == {0: [-1, 5, -1, -1, 6, -1], 1: [-1] * 6, 2: [-1] * 6}
    assert {r.row: r["values"] for r in matrices.dense(df.where("col IS NULL"), "v", 0, 0.0).collect()} == {2: []}
    for bad in (df, df.where("row = 0").union(df.where("col = 1"))):
        with pytest.raises(Exception, match="beyond the columns"):
            matrices.dense(bad, "v", 3 if bad is df else 6, 0.0).collect()


def test_types_that_hold_both(spark):
    import datetime
    from decimal import Decimal

    one = spark.createDataFrame([(1 << 60, datetime.date(2020, 1, 2), True, Decimal("1.50"), 1)], "a long, d date, b boolean, m decimal(5,2), `x.y` int")
    two = spark.createDataFrame([(0.5, "text", 3, 7, "z")], "a float, d string, b int, m long, `x.y` string")
    got = metrics.union_relaxed(one, two, spark.createDataFrame([(datetime.datetime(2020, 1, 2),)], "d timestamp"))
    kinds = dict(got.dtypes)
    assert (kinds["a"], kinds["d"], kinds["b"], kinds["x.y"]) == ("double", "string", "string", "string") and kinds["m"].startswith("decimal")
    assert sorted((str(r.a), r.d, r.b, str(r.m)) for r in got.collect())[:2] == [("0.5", "text", "3", "7.00"), ("1.152921504606847e+18", "2020-01-02", "true", "1.50")]
    assert metrics.wider_type(spark, "date", "timestamp") == "timestamp" and metrics.wider_type(spark, "int", "double") == "double"


def test_repeated_signatures_are_an_error(spark):
    sig = spark.createDataFrame([("c", "A", 5, 2, "AC", 3, 9, 6, 30.0)] * 2, "barcode string, feature string, pos_local_0based long, indel_len long, inserted_seq string, reads long, total_reads long, ref_reads long, mean_mq double")
    called = spark.createDataFrame([("A", 5, "G", "GAC", 2, "AC")], "feature string, pos_local_0based long, ref string, alt string, indel_len long, inserted_seq string")
    assert variants.indel_alt_long(sig.distinct(), called).first()["alt_reads"] == 3
    with pytest.raises(Exception, match="repeated barcode"):
        variants.indel_alt_long(sig, called).collect()
