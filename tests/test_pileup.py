"""Bases at sites against a walk along each read."""

import random
import re

import pytest

from quillon.operators import pileup

READS = "read_name string, feature string, start long, cigar string, sequence string, qualities array<int>, mapping_quality int"


def walked(start, cigar, sequence, qualities):
    """(place, base, quality, signed length of an indel after it, inserted bases) of each base on the reference; a deleted base has no base."""
    ops = [(int(n), o) for n, o in re.findall(r"(\d+)([MIDNSHP=X])", cigar)]
    at, q = start, 0
    for i, (n, o) in enumerate(ops):
        for k in range(n if o in "M=X" else 0):
            size = 0
            if k == n - 1 and i + 1 < len(ops) and ops[i + 1][1] in "ID":
                size = ops[i + 1][0] * (1 if ops[i + 1][1] == "I" else -1)
            yield at + k, sequence[q + k], qualities[q + k] if qualities else None, size, sequence[q + k + 1 : q + k + 1 + max(size, 0)]
        for k in range(n if o == "D" else 0):
            yield at + k, "", None, None, ""
        at += n * (o in "M=XDN")
        q += n * (o in "M=XIS")


def some_reads(rng, many, longest=40):
    rows = []
    for i in range(many):
        ops = [rng.choice("MMM=XIDSNHP") for _ in range(rng.randint(1, 8))]
        cigar = "".join(f"{rng.randint(1, longest)}{o}" for o in ops)
        n = sum(int(k) for k, o in re.findall(r"(\d+)(.)", cigar) if o in "M=XIS")
        qualities = [rng.randint(2, 40) for _ in range(n)] if rng.random() < 0.7 else None
        rows.append((f"r{i}", rng.choice(["A", "B", "C"]), rng.randint(0, 900), cigar, "".join(rng.choice("ACGT") for _ in range(n)), qualities, rng.randint(0, 60)))
    return rows


@pytest.mark.parametrize("size", [7, 64, pileup.BIN])
def test_pairs_of_reads_and_sites(spark, size, monkeypatch):
    """As many rows as there are pairs, none for other bases."""
    rng = random.Random(size)
    reads = [*some_reads(rng, 300), ("no", "A", 5, None, None, None, 1), ("none", "A", 5, "*", "ACG", None, 1), ("clip", "A", 5, "9S3I", "A" * 12, None, 1), (None, "B", 2, "30M", "C" * 30, [9] * 30, None)]
    sites = [(rng.choice("ABD"), rng.randint(0, 1100)) for _ in range(400)]
    want = [(name, f, *x, mapq) for name, f, start, cigar, seq, qual, mapq in reads for x in walked(start, cigar or "", seq or "", qual) if (f, x[0]) in set(sites)]
    monkeypatch.setattr(pileup, "PAIRS", 50)
    got = pileup.met(spark.createDataFrame(reads, READS), spark.createDataFrame(sites, "feature string, pos_local_0based long"), size)
    rows = [(r.read_name, r.feature, r.pos_local_0based, r.read_base, r.base_qual, r.indel_len, r.inserted_seq, r.map_qual) for r in got.collect()]
    assert len(want) > 1000 and sorted(rows, key=str) == sorted(want, key=str)


def test_coverage_and_short_sequences(spark):
    rows = [("r1", "A", 4, "3M2I2M", "ACGTTGA", None, 60), ("r2", "A", 5, "1M2D2M", "CTT", [7, 8, 9], 50), ("r3", "A", 6, "1M", "G", [1], 20), ("r4", "B", 6, "1M", "G", [1], 20), ("r5", "B", 6, "4M", "", None, 20), ("r6", "C", 0, "2M", "AC", [3], 1)]
    df = spark.createDataFrame(rows, READS)
    sites = spark.createDataFrame([("A", 6), ("A", 5), ("B", 6), ("C", 1)], "feature string, pos_local_0based long")
    got = sorted(tuple(r) for r in pileup.pileup_snv(df, sites, 3).select("read_name", "pos_local_0based", "read_base", "base_qual", "map_qual").collect())
    assert got == [("r1", 6, "G", None, 60), ("r3", 6, "G", 1, 20)]
    got = sorted((r.read_name, r.pos_local_0based, r.indel_len, r.inserted_seq) for r in pileup.pileup_indel(df, sites.where("feature = 'A'"), 2).collect())
    assert got == [("r1", 5, 0, ""), ("r1", 6, 2, "TT"), ("r2", 5, -2, ""), ("r2", 6, None, ""), ("r3", 6, 0, "")]
    assert sorted((r.read_name, r.read_base, r.base_qual) for r in pileup.pileup_snv(df, sites.where("feature <> 'A'")).collect()) == [("r4", "G", 1), ("r6", "C", None)]
    assert pileup.piled(df, sites.limit(0)).count() == 0 == pileup.piled(df.limit(0), sites).count()


def test_ways_are_walked_once(spark):
    """A thousand reads that lie alike are one way, and each of its sites is one row."""
    df = spark.range(1000).selectExpr("cast(id AS string) AS read_name", "'A' AS feature", "5 AS start", "'4M1I3M' AS cigar", "'ACGTACGT' AS sequence", "cast(null AS array<int>) AS qualities", "9 AS mapping_quality")
    sites = spark.createDataFrame([("A", 5), ("A", 8), ("A", 30)], "feature string, pos_local_0based long")
    assert sorted(tuple(r)[3:] for r in pileup.walked(df, sites).collect()) == [(1000, 5, 0, 0), (1000, 8, 3, 1)]
    got = pileup.pileup_indel(df, sites, 1000).groupBy("pos_local_0based", "indel_len", "inserted_seq").count()
    assert sorted(map(tuple, got.collect())) == [(5, 0, "", 1000), (8, 1, "A", 1000)]
    assert pileup.piled(df, sites, 1001).count() == 0
